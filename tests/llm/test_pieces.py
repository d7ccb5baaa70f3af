import hashlib

import pyarrow as pa
import pytest
import sentencepiece

from trendlens.llm import pieces as P
from trendlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=P.MODEL)


def test_query_equals_library(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op10_pieces"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id])
        assert r.round_trip and r.n_pieces == len(ids)
        assert r.pieces_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_odd_texts_and_round_trip(spark, library):
    texts = ["", "  Hello  world\nfoo\tbar  ", " ", None, "a" * 300, "中文字符 테스트 ﬁ² x². ½ \x00", " " * 40 + "x",
             "x=1;y=2  -- ok!!!\r\n", "▁a▁ b", "é" * 60 + " " * 70 + "z", "http://example.com/a?c=d&e=f#g " * 3]
    model = P.Model.load()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in P.decode(P.encode(df, model), model).collect()}
    for i, t in enumerate(texts):
        if t is None:
            assert got[i].pieces is None and got[i].text is None
        else:
            assert got[i].pieces == library.encode(t) and got[i].text == t.replace("▁", " ")


def best_path(word, scores, unknown):
    best = [(0.0, [])]
    for j in range(1, len(word) + 1):
        ways = [(best[i][0] + scores.get(word[i:j], unknown if j == i + 1 else None), best[i][1] + [(i, j)])
                for i in range(j) if word[i:j] in scores or j == i + 1]
        best.append(max(ways, key=lambda w: (w[0], w[1][-1][0] * -1)))
    return best[-1]


def test_viterbi_fold_for_unigram_tables(spark):
    scores = {"a": -2.0, "b": -2.5, "ab": -3.0, "abc": -4.25, "c": -1.5, "bc": -3.5, "cab": -5.0}
    model = P.Model("unigram", tuple((p, s, i) for i, (p, s) in enumerate(scores.items())), 0, (), "", 3)
    words = ["abcab", "a", "zz", "cabcabab", "xabcx", "bcbcaabc"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r.word: P._parts(r.word, r.joints) for r in P.segmented(df, model, spark).collect()}
    for w in words:
        score, path = best_path(w, scores, -15.0)
        parts = got.get(w, list(w))  # words without any piece have no lattice
        assert "".join(parts) == w
        assert sum(scores.get(p, -15.0) for p in parts) == pytest.approx(score)


def test_merge_fold_equals_heap(spark, library):
    import random

    rng = random.Random(5)
    model = P.Model.load()
    score = {p: s for p, s, _ in model.rows}
    words = {"".join(rng.choice("aeionrstlhx▁" if i else "▁a") for i in range(rng.randint(2, P.LONGEST))) for _ in range(400)}
    words |= {"▁" * n for n in range(2, 40)} | {"a" * P.LONGEST, "zq", "ab" * 20}
    df = spark.createDataFrame([(w,) for w in sorted(words)], "word string")
    got = {r.word: P._parts(r.word, r.joints) for r in P.segmented(df, model, spark).collect()}
    for w in words:
        assert got.get(w, list(w)) == P.merged_by_heap(w, score), w


def test_long_words_of_unigram_tables(spark):
    """Runs of any length get the path of the lattice fold, beyond its bound too."""
    import random

    rng = random.Random(9)
    scores = {"a": -2.0, "b": -2.5, "ab": -1.0, "abc": -4.25, "c": -1.5, "bc": -3.5, "cab": -2.0}
    model = P.Model("unigram", tuple((p, s, i) for i, (p, s) in enumerate(scores.items())), 100,
                    tuple(p.encode() for p in scores), r"[^▁]+|▁", 3)
    texts = ["ab" * n for n in (24, 25, 26, 500_000)] + ["".join(rng.choice("abcx") for _ in range(n)) for n in (47, 48, 49, 300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.pieces for r in P.encode(df, model).collect()}
    ids = {p: [i] for i, p in enumerate(scores)}
    for i, t in enumerate(texts):
        path = best_path(t, scores, model.unknown)[1] if len(t) < 1000 else [(k, k + 2) for k in range(0, len(t), 2)]
        want = [i for a, b in path for i in ids.get(t[a:b], [100 + c for c in t[a:b].encode()])]
        assert got[i][0] == 100 + "▁".encode()[0] and got[i][3:] == want, (i, len(t))


def test_decoding_of_any_ids(spark):
    """Ids that are no whole UTF-8, unknown and empty lists; alone and in the encoder."""
    model = P.Model.load()
    rows = [(1, [model.byte_base + 0xC3]), (2, []), (3, None), (4, [0, 1, 2]), (5, [model.byte_base + b for b in " é".encode()]),
            (6, [model.byte_base + b for b in b"  x"])]
    df = spark.createDataFrame(rows, "doc_id long, pieces array<int>").coalesce(1)
    got = {r.doc_id: r.text for r in P.decode(df, model).collect()}
    assert got == {1: "\ufffd", 2: "", 3: None, 4: "", 5: "é", 6: " x"}
    texts = [(1, "a  b"), (2, None), (3, ""), (4, "é中 \x00")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in P.encode(docs, model, round_trip=True).collect()) == texts


def test_ids_of_words_equal_their_parts():
    import random

    import numpy as np

    rng = random.Random(2)
    words = ["".join(rng.choice("aé中b▁") for _ in range(rng.choice([1, 2, 5, 48, 49, 70]))) for _ in range(300)]
    joints = [rng.getrandbits(48) & ((1 << min(len(w), 48)) - 2) for w in words]
    ids = {c: i for i, c in enumerate(["a", "b", "▁", "ab", "aa", "中b"])}
    for some, bits in ((words, joints), (["a"], [0]), (["中"], [0])):
        per, flat = P.ids_of_words(pa.array(some), np.array(bits, np.int64), ids, 100, list)
        want = [P._ids_of_parts(P._parts(w, x) if len(w) <= P.LONGEST else list(w), ids, 100) for w, x in zip(some, bits)]
        assert per.tolist() == [len(w) for w in want] and flat.tolist() == [i for w in want for i in w]


def test_words_and_numbers_survive_packing():
    import numpy as np

    words = ["", "é▁", "a\nb", "\x00", "中" * 50]
    assert P._unpack_words(5, P._pack_words(pa.array(words))).to_pylist() == words
    assert P._unpack_words(0, P._pack_words(pa.array([], pa.string()))).to_pylist() == []
    for numbers in ([0, 1, 65535, 65536, 2**31 - 1], [], [7]):
        numbers = np.array(numbers, np.int32)
        assert P._unpack_numbers(P._pack_numbers(numbers)).tolist() == numbers.tolist()


def test_small_chunks_give_the_same(spark, library, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(P, "CHUNK_CHARS", 5000)
    monkeypatch.setattr(P, "BATCH_WORDS", 64)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in P.encode(docs, P.Model.load()).collect():
        assert r.pieces == (None if texts[r.doc_id] is None else library.encode(texts[r.doc_id]))


def test_awkward_and_empty(spark, library, awkward, nothing):
    model = P.Model.load()
    got = P.encode(awkward, model).collect()
    expect = sorted((r.doc_id or 0, -1 if r.text is None else len(library.encode(r.text))) for r in awkward.collect())
    assert sorted((r.doc_id or 0, -1 if r.pieces is None else len(r.pieces)) for r in got) == expect
    assert P.encode(nothing, model).count() == 0
