from trendlens.llm import lines


def test_ratio_is_relative_to_the_host(spark):
    rows = [(i, "h1", f"own {i}\nfooter\n\nfooter") for i in range(20)]
    rows += [(100 + i, "h2", f"own {i}" + ("\nfooter" if i < 3 else "")) for i in range(60)]
    rows += [(200, None, "footer"), (201, "h1", None), (202, "h3", "footer"), (203, "h1", "")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: r for r in lines.drop_boilerplate(df, min_pages=3, max_ratio=0.06).collect()}
    assert got[0].text == "own 0\n" and (got[0].n_lines, got[0].n_dropped) == (3, 2)
    assert got[100].text == "own 0\nfooter" and got[200].text == "footer" and got[202].text == "footer"
    assert got[201].text is None and got[203].text == ""
    assert lines.drop_boilerplate(df, min_pages=3, max_ratio=0.05).filter("doc_id = 100").first().text == "own 0\nfooter"
    assert lines.drop_boilerplate(df, min_pages=3, max_ratio=0.04).filter("doc_id = 100").first().text == "own 0"


def test_awkward_and_empty(spark, awkward, nothing):
    got = lines.drop_boilerplate(awkward)
    assert got.columns == [c for c in awkward.columns] + ["n_lines", "n_dropped"]
    assert got.count() == awkward.count() and got.filter("n_dropped > 0").count() == 0
    assert lines.drop_boilerplate(nothing).count() == 0


def test_native_plan(spark, awkward):
    plan = lines.drop_boilerplate(awkward)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_hosts_of_any_size_are_judged(spark):
    """A footer on every page goes, also where a host has few; chance repeats stay."""
    rows = [(100 * n + i, f"h{n}", f"own {n} {i}\nfooter {n}" + ("\nshared" if i < n // 2 else ""))
            for n in (1, 2, 3, 9, 12) for i in range(n)]
    got = lines.drop_boilerplate(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    kept = {r.doc_id: r.text for r in got}
    for n in (2, 3, 9, 12):
        assert all(f"footer {n}" not in kept[100 * n + i] and f"own {n} {i}" in kept[100 * n + i] for i in range(n)), n
        assert all(("shared" in kept[100 * n + i]) == (i < n // 2) for i in range(n)), n
    assert kept[100] == "own 1 0\nfooter 1"
