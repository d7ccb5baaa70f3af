import re
from collections import Counter

from trendlens.llm import quality

SF = "/root/testdata/sf0.01"


def repeat_words(words):
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    return len({i + k for i, w in enumerate(windows) if w in often for k in range(3)})


def test_awkward_rows(spark, awkward):
    got = {r.doc_id: r for r in quality.judge(awkward).collect()}
    for i in (3, 4, 5):
        assert (got[i].n_words, got[i].word_chars, got[i].n_lines, got[i].n_repeat_words) == (0, 0, 0, 0)
        assert got[i].base_failed and not got[i].kept
    assert got[8].n_words == 20_000 and got[8].n_repeat_words == 0
    assert got[10].n_symbols == 4
    kept = quality.keep_good(awkward)
    assert kept.columns == awkward.columns
    assert quality.judge(awkward.limit(0)).count() == 0


def test_repeats_lines_and_null_bytes(spark):
    texts = ["a b c a b c a", "a a a a a", "a b", "x y z w", "l1\nl1\n\n  \nl1 \nl2", "a b c d a b c"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in quality.measure(df).collect()}
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert got[i].n_repeat_words == repeat_words(words), t
        assert got[i].n_dup_lines == len(lines) - len(set(lines))


def test_labelled_documents(spark):
    """Labelled good documents that pass the base are kept, bad ones are not."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = quality.judge(spark.read.parquet(f"{SF}/documents.parquet")).join(labels, "doc_id").filter("not base_failed")
    n = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert n[(1, True)] > 300 and n.get((1, False), 0) == 0 and n.get((0, True), 0) <= 1


def test_no_python_and_no_shuffle_in_the_plan(spark, awkward):
    plan = quality.judge(awkward)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_own_threshold_table(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "a")], "doc_id long, text string")
    got = quality.measure(df).withColumn("broken", quality.compile_rules([quality.Rule("few", "n_words", 2, None)]))
    assert {r.doc_id: r.broken for r in got.collect()} == {1: [], 2: ["few"]}


def test_size_and_spacing_do_not_matter(spark):
    """A book is judged like a page, and words are words whatever stands between them."""
    page = "the river and of the old house was for a long time " * 8 + " ".join(f"leaf{i} stone{i} water{i}" for i in range(60))
    book = " ".join(f"{page} chapter{i}x{j}" for i in range(10) for j in range(50)) + " ".join(f" w{i}" for i in range(180_000))
    rows = [(1, page), (2, page.replace(" ", "\n")), (3, page.replace(" ", "\t")), (4, book), (5, page.upper())]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[4].n_words > 200_000 and got[4].broken_rules == []
    assert len({got[i].n_stop_words for i in (1, 2, 3, 4, 5)}) == 1 and got[1].n_stop_words == 5
    assert got[2].broken_rules == got[3].broken_rules == got[1].broken_rules == []
    other = quality.measure(spark.createDataFrame([(1, "og det er en bog")], "doc_id long, text string"), stop_words=("og det er",))
    assert other.first().n_stop_words == 3
