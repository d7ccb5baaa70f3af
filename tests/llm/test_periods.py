import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings, strategies as st

from trendlens.llm import periods
from trendlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain_runs(words):
    """Every maximal stretch of every period, kept if no smaller period fits it."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                part = words[i:i + length]
                if not any(part[:-p] == part[p:] for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = QUERIES["op12_periods"](spark, SF)
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                             "collapsed_sha256"]
    got = sorted(map(tuple, found.collect()))
    want = sorted((plain_row(i, t) for i, t in rows))
    assert got == want
    assert sum(r[1] for r in got) > 50


@settings(max_examples=400, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 5), st.integers(0, 260))
def test_runs_equal_brute_force(seed, letters, n):
    rng = random.Random(seed)
    words = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(4) if n > 20 else 0):
        p, a = rng.randint(1, 40), rng.randrange(n)
        b = min(n, a + p * rng.randint(2, 9) + rng.randrange(p))
        words[a:b] = [words[a + (i - a) % p] for i in range(a, b)]
    assert periods.runs_of(np.array(words, np.int32)) == plain_runs(words)


def test_nested_and_touching_runs():
    a = list("aaaaaab" * 5 + "cd" * 4 + "dc" * 4 + "x" + "xyz" * 4)
    numbers = {c: i for i, c in enumerate(dict.fromkeys(a))}
    assert periods.runs_of(np.array([numbers[c] for c in a], np.int32)) == plain_runs(a)


def test_splitting_drops_what_no_run_can_hold():
    rng = np.random.default_rng(5)
    assert periods.segments(np.arange(1000, dtype=np.int32)) == []
    words = np.concatenate([rng.permutation(500), np.tile([7, 8, 9], 6), rng.permutation(400)]).astype(np.int32)
    assert sum(b - a for a, b in periods.segments(words)) <= 20
    for a, b in periods.segments(words):
        assert np.bincount(words[a:b])[np.unique(words[a:b])].min() >= periods.TIMES


def test_work_stays_near_linear(monkeypatch):
    """A long text of one word, one of two words, and one whose parts fall apart
    one word at a time."""
    looked = []
    real = np.searchsorted
    n = 40_000
    chain = np.repeat(np.arange(n // 4), 4)
    chain[4:] = np.where(np.arange(4, n) % 4 == 0, chain[4:] - 1, chain[4:])
    monkeypatch.setattr(periods.np, "searchsorted", lambda a, v: looked.append(len(v)) or real(a, v))
    periods.segments(chain.astype(np.int32))
    assert sum(looked) < 40 * n
    monkeypatch.undo()
    assert periods.runs_of(np.zeros(200_000, np.int32)) == [(0, 200_000, 1)]
    binary = np.random.default_rng(1).integers(0, 2, 20_000).astype(np.int32)
    assert periods.runs_of(binary)[:3] == plain_runs(binary[:400].tolist())[:3]


def test_words_read_in_blocks():
    text = "aa é\tb  aa \x0b cc\n" * 50 + "last"
    for block in (1, 3, 64, 1 << 20):
        words, different = periods.numbered(text.encode(), block)
        assert [different[i] for i in words] == text.encode().split()


def test_awkward_rows(spark, awkward, nothing):
    from pyspark.sql import functions as F

    got = {}
    for r in periods.find(awkward).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, r.runs, r.collapsed))
    assert got[3] == [(0, [], None)] and got[4] == [(0, [], "")] and got[5] == [(0, [], "")]
    assert len(got[2]) == 2 and got[2][0][0] == 80
    assert got[8][0][0] == 20_000 and got[9][0][2] == "y" * 500 and None in got
    assert periods.find(nothing).collect() == []
    rows = [(i, "a b " * 30) for i in range(40)] + [(None, "a b " * 30), (41, None), (42, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit("clash"))
    for r in df.select("doc_id", "text", periods.planted().alias("new")).collect():
        changed = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 10 == 0
        assert (r.text or "").split() == (r.new or "").split() or changed
        assert (r.text is None) == (r.new is None)
