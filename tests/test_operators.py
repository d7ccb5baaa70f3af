import datetime as dt

from pyspark.sql import functions as F

from trendlens.operators import (
    overlap_with,
    period_delta,
    windowed_agg,
)


def _events(spark):
    t = dt.datetime(2026, 1, 1, 10, 0, 0)
    rows = [(t + dt.timedelta(seconds=s), k) for s, k in [(1, "a"), (20, "b"), (31, "a"), (95, "c")]]
    return spark.createDataFrame(rows, "ts timestamp, k string")


def test_windowed_agg_tumbling_and_sliding(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = _events(spark)
    tumble = {r["window_start"]: r["n"] for r in
              windowed_agg(df, "ts", "30 seconds", aggs=[F.count("*").alias("n")]).collect()}
    assert tumble == {"2026-01-01 10:00:00": 2, "2026-01-01 10:00:30": 1, "2026-01-01 10:01:30": 1}
    slide = {r["window_start"]: r["n"] for r in
             windowed_agg(df, "ts", "60 seconds", slide="30 seconds",
                          aggs=[F.count("*").alias("n")]).collect()}
    assert slide["2026-01-01 10:00:00"] == 3 and slide["2026-01-01 09:59:30"] == 2
    keyed = windowed_agg(df, "ts", "30 seconds", keys=["k"], aggs=[F.count("*").alias("n")])
    assert keyed.columns == ["k", "n", "window_start", "window_end"] and keyed.count() == 4


def test_overlap_with_flags_without_multiplying(spark):
    left = spark.createDataFrame([("w1", "a"), ("w1", "b"), ("w2", "a")], "w string, c string")
    ref = spark.createDataFrame([("a",), ("a",), ("z",)], "c string")
    for bc in (True, False):
        got = sorted((r["w"], r["c"], r["flag"]) for r in overlap_with(left, "c", ref, "flag", bc).collect())
        assert got == [("w1", "a", True), ("w1", "b", None), ("w2", "a", True)]


def test_period_delta_gap_and_bounds(spark):
    rows = [("a", dt.date(2026, 1, d), v) for d, v in [(1, 10), (2, 15), (4, 30), (5, 20)]]
    df = spark.createDataFrame(rows, "k string, d date, v bigint")
    all_rows = period_delta(df, "k", "d", "v").orderBy("d").collect()
    assert [r["delta"] for r in all_rows] == [None, 5, 15, -10]
    kept = period_delta(df, "k", "d", "v", gap_days=1, bounds=(0, 100)).collect()
    assert [(str(r["d"]), r["delta"]) for r in kept] == [("2026-01-02", 5)]
    assert "_prev_order" not in period_delta(df, "k", "d", "v", gap_days=1).columns
