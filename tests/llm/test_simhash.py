import random

import xxhash
from pyspark.sql import functions as F

from trendlens.llm import simhash
from trendlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [words] if len(words) < 3 else [words[i:i + 3] for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(marked):
    """{fingerprint: lowest id}, by comparing all fingerprints."""
    prints = sorted({f for _, f in marked})
    parent = {f: f for f in prints}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    lowest = {}
    for i, f in marked:
        if i is not None:
            lowest[root(f)] = min(i, lowest.get(root(f), i))
    return {f: lowest.get(root(f)) for f in prints}


def plain(rows):
    marked = [(i, plain_fingerprint(t)) for i, t in rows]
    component = plain_components(marked)
    return sorted(((i, f"{f:016x}", component[f]) for i, f in marked), key=repr)


def got(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.select(
        "doc_id", simhash.as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id").collect()), key=repr)


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = QUERIES["op11_simhash"](spark, SF).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in found), key=repr) == plain(rows)


def test_awkward_rows(spark, awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert got(simhash.cluster(awkward)) == plain(rows)
    assert simhash.cluster(nothing).collect() == []


def test_words_of_long_texts_in_blocks():
    rng = random.Random(1)
    text = " ".join(rng.choice(["Ab", "é", "x" * 40, "c\td"]) for _ in range(3000))
    for block in (1, 7, 100, 1 << 20):
        assert simhash.fingerprint(text.encode(), block) == plain_fingerprint(text)
    assert simhash.fingerprint(b"") == simhash.fingerprint(b" \n ") == 0


def around(rng, centre, n, flips):
    return {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, flips))) for _ in range(n)}


def test_links_are_exact_in_small_and_large_buckets(spark):
    rng = random.Random(7)
    prints = {rng.getrandbits(64) for _ in range(300)} | {0, 1, 2**64 - 1}
    for flips in (1, 2, 3, 6):
        prints |= around(rng, rng.getrandbits(64), 150, flips)
    want = plain_components([(f, f) for f in prints])
    signed = [(f - 2**64 if f >> 63 else f,) for f in prints]
    nodes = spark.createDataFrame(signed, "fingerprint long")
    for blocks, big in ((5, 64), (5, 2), (4, 10**6), (8, 8)):
        found = simhash.links(nodes, blocks, big).collect()
        assert all(1 <= ((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 2 for r in found)
        assert joined(prints, found) == want


def joined(prints, links):
    parent = {f: f for f in prints}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for r in links:
        a, b = sorted((root(r.a % 2**64), root(r.b % 2**64)))
        parent[b] = a
    return {f: root(f) for f in prints}


def test_a_large_bucket_makes_no_pairs(spark):
    """4,000 fingerprints within one bucket: as many links as nodes times a
    constant, though some 10^5 pairs are close."""
    rng = random.Random(3)
    nodes = spark.createDataFrame([(f,) for f in {rng.getrandbits(13) for _ in range(9000)}], "fingerprint long")
    n = nodes.count()
    assert n > 4000
    assert simhash.links(nodes).count() <= 66 * n


def test_copies_of_one_text_are_not_dealt_to_one_task(spark, monkeypatch):
    """Fingerprints that are hot and others, with and without ids, give the same rows
    by either way."""
    rows = [(i if i % 7 else None, "the same text of a few words") for i in range(60)]
    rows += [(100 + i, f"text {i} of its own {i * i}") for i in range(20)] + [(None, None), (200, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain(rows)
    for hot in (10**9, 4, 0):
        monkeypatch.setattr(simhash, "HOT", hot)
        assert got(simhash.cluster(df)) == want
