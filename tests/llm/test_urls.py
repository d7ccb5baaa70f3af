import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from trendlens.llm import urls


def test_rules_hosts_and_slices(spark):
    rows = ["http://A.B.org/x?y", "https://example.org/es/1", "http://x.example.org/en/12#z", "http://example.org/en/2",
            "http://a.com/fr/", "http://a.com/de/?q", "http://a.com/fr", "http://ads-track.example.com/en/",
            "http://sub.spam-farm.example.net", "http://spam-farm.example.org/", "notorg/", None, "", "http://org", "x://org/",
            "http://myorg/", "http://a://b/c"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(rows)], "page_id long, url string").withColumn(
        "host", urls.F.lit("clash"))
    expect = ["allow org/", "block example.org/es/", "block example.org/en/1", "allow org/", "allow com/fr/",
              "block com/de/", "allow None", "block None", "block None", "allow org/", "allow None", "allow None",
              "allow None", "allow None", "allow org/", "allow None", "allow None"]
    for size in (1 << 20, 60):
        got = {r.page_id: r for r in urls.judge(df, slice_bytes=size).collect()}
        assert [f"{got[i].verdict} {got[i].rule}" for i in range(len(rows))] == expect
    assert (got[0].host, got[0].path) == ("a.b.org", "/x") and (got[11].host, got[11].path) == ("", "")
    assert (got[16].host, got[16].path) == ("a:", "//b/c")
    assert urls.judge(df.limit(0)).count() == 0
    assert urls.allowed(df).count() == sum(x.startswith("allow") for x in expect)


def stored(entries):
    """A digest array of (text, key, block), sorted by key."""
    entries = sorted(entries, key=lambda e: e[1])
    texts = [t.encode() for t, _, _ in entries]
    return urls.DigestArray(np.array([k for _, k, _ in entries], "<i8").tobytes(),
                            np.append(0, np.cumsum([len(t) for t in texts])).astype("<i8").tobytes(), b"".join(texts),
                            bytes(b for _, _, b in entries))


def test_colliding_keys_are_told_apart():
    d = stored([("aa", 2, 1), ("bb", 2, 0), ("ccc", 3, 1), ("é", 2, 1)])
    assert isinstance(d.keys, np.memmap)
    probe = ["aa", "bb", "cc", "ccc", "dddd", "", "é"]
    hits, places = d.find(pa.array(probe), np.array([2, 2, 2, 3, 4, 0, 2]))
    assert hits.tolist() == [0, 1, 3, 6] and [int(d.block[j]) for j in places] == [1, 0, 1, 1]
    empty = stored([])
    assert empty.find(pa.array(["x"]), np.array([1]))[0].tolist() == []


def plain(url, rules, blocked):
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", "", None, "allow"
    rest = rest.split("#", 1)[0].split("?", 1)[0]
    host, slash, tail = rest.partition("/")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = slash + tail
    fits = lambda h: host != "" and (host == h or host.endswith("." + h))
    best = max(((len(h + p), v == "block", h + p, v) for h, p, v in rules if fits(h) and path.startswith(p)), default=None)
    if best:
        return host, path, best[2], best[3]
    return host, path, None, "block" if any(map(fits, blocked)) else "allow"


def test_random_urls_and_lists(spark):
    rng = random.Random(3)
    name = lambda: ".".join(rng.choice(["a", "b", "é", "com", "x-y", ""]) for _ in range(rng.randint(1, 4)))
    path = lambda: "".join(rng.choice(["/", "a", "/b", "中", "?q", "#f", "//"]) for _ in range(rng.randint(0, 5)))
    rules = [(name(), path().split("?")[0].split("#")[0], rng.choice(["allow", "block"])) for _ in range(60)]
    rules = [(h, p if not p or p[0] == "/" else "/" + p, v) for h, p, v in rules]
    blocked = [name() for _ in range(30)]
    rows = [rng.choice(["http://", "HTTPS://", "", "://", "x"]) + rng.choice([name(), name().upper()]) + path() for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate([None, *rows])), "page_id long, url string").withColumn("rule", F.lit(1))
    r = spark.createDataFrame([*rules, (None, "/", "block"), ("a", None, "block"), ("a", "/", None)],
                              "host string, path string, verdict string")
    b = spark.createDataFrame([(h,) for h in [*blocked, None]], "host string")
    # A host of rules is given in lower case, so equal texts with both verdicts are blocked.
    for size in (1 << 20, 300):
        got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in urls.judge(df, r, b, slice_bytes=size).collect()}
        for i, u in enumerate([None, *rows]):
            assert got[i] == plain(u, rules, blocked), (u, size)


def test_a_large_list_is_cut_into_sorted_slices(spark):
    hosts = spark.range(20_000).select(F.concat(F.lit("h"), "id", F.lit(".Example.net")).alias("host"))
    found = urls.entries(urls.default_rules(spark), hosts.union(hosts))
    assert found.count() == 20_005
    rows = urls.slices(found, 100_000).orderBy("slice").collect()
    keys = [np.frombuffer(r["keys"], "<i8") for r in rows]
    assert len(rows) > 5 and sum(map(len, keys)) == 20_005 and all(len(r["texts"]) <= 100_000 for r in rows)
    assert all((np.diff(k) >= 0).all() for k in keys)
    pages = spark.createDataFrame([(i, f"http://www.h{i}.example.net/") for i in (0, 7, 19_999, 20_000)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judge(pages, blocked=hosts, slice_bytes=100_000).collect()}
    assert got == {0: "block", 7: "block", 19_999: "block", 20_000: "allow"}
