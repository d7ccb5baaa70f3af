import numpy as np
from hypothesis import HealthCheck, given, settings, strategies as st

from trendlens.llm import tokens
from trendlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def encoding():
    with open(tokens.VOCABULARY, "rb") as f:
        return tokens._encoding(f.read(), tokens.PATTERN)


def test_query_equals_counting_each_text(spark):
    enc = encoding()
    expect = {r.doc_id: len(enc.encode_ordinary(r.text or ""))
              for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id: r.n_tokens for r in QUERIES["op8_tokens"](spark, SF).collect()} == expect


def blocks_of(spark, files, size):
    rows = [(f, b, np.array(t[b * size:(b + 1) * size], "<u2").tobytes())
            for f, t in files.items() for b in range(-(-len(t) // size))]
    return spark.createDataFrame(rows, "file long, block long, tokens binary")


def expected(files, eod):
    out = []
    for f, t in files.items():
        at = n = 0
        for i, x in enumerate(t):
            if x == eod:
                out.append((f, n, at, i - at, True))
                at, n = i + 1, n + 1
        if at < len(t):
            out.append((f, n, at, len(t) - at, False))
    return sorted(out)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 3), st.lists(st.sampled_from([1, 2, 9]), max_size=60), min_size=1), st.integers(1, 7))
def test_documents_that_cross_blocks(spark, files, size):
    got = tokens.scan(blocks_of(spark, files, size), eod=9, segment=2)
    assert sorted(tuple(r) for r in got.select("file", "ordinal", "start", "n_tokens", "closed").collect()) == expected(files, 9)


def test_awkward_and_empty(spark, awkward, nothing):
    flat, manifest = tokens.write_files(awkward, block=64)
    got = tokens.scan(flat).join(manifest, ["file", "ordinal"])
    enc = encoding()
    expect = sorted((r.doc_id or 0, len(enc.encode_ordinary(r.text or ""))) for r in awkward.collect())
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got.collect()) == expect
    flat, manifest = tokens.write_files(nothing)
    assert tokens.scan(flat).count() == 0 and manifest.count() == 0
