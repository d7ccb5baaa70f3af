"""No input row may fail a job: extreme numbers through the preparation, the
questions and a real stream."""

import datetime as dt
import json

from pyspark.sql import functions as F

from trendlens import plans
from trendlens.functions import prepared_duration_seconds, stream_duration_seconds
from trendlens.operators.series import period_delta
from trendlens.session import shared_dir
from trendlens.sources import ENVELOPE_SCHEMA, replay_stream
from trendlens.streaming import NAMES, TrendStreams, parse_messages

BIG = 2**63 - 1
NUMBERS = ["0", "-1", str(BIG), str(-BIG - 1), str(BIG + 1), "1e400", "NaN", "-Infinity", "9" * 60, "1.5", "", None]
DURATIONS = ["PT999999999999999999H", "PT9223372036854775807S", "PT9223372036854775807M1S", "PT2562047788015215H99M",
             "PT" + "9" * 40 + "H5M", "PT1H1M1S", "", None, "-PT5S"]


def test_durations_of_any_length(spark):
    df = spark.createDataFrame([(d,) for d in DURATIONS], "d string")
    got = df.select("d", stream_duration_seconds("d").alias("s"), prepared_duration_seconds("d").alias("p")).collect()
    want = {"PT999999999999999999H": (0, 0), "PT9223372036854775807S": (BIG, 0), "PT9223372036854775807M1S": (0, 1),
            "PT2562047788015215H99M": (0, 5940), "PT" + "9" * 40 + "H5M": (300, 300), "PT1H1M1S": (3661, 3661), "": (0, 0),
            None: (0, 0), "-PT5S": (5, 5)}
    assert {r.d: (r.s, r.p) for r in got} == want


def raw_rows():
    rows = []
    for i, a in enumerate(NUMBERS):
        for j, b in enumerate(NUMBERS):
            rows.append(("US", f"v{i % 3}", "t", "2020-01-01", "c", "C", "10", f"2020-01-{1 + j:02d}", "a|b|c", a, b, b, b,
                         DURATIONS[(i + j) % len(DURATIONS)]))
    return rows


COLUMNS = "region_code video_id title publishedAt channelId channelTitle categoryId trending_date tags view_count likes " \
          "dislikes comment_count duration".split()


def test_every_question_survives_extreme_counts(spark):
    raw = spark.createDataFrame(raw_rows(), ", ".join(f"{c} string" for c in COLUMNS))
    obs = plans.prepare(raw)
    kept = obs.collect()
    assert kept and all(r.view_count is not None for r in kept)
    assert any(r.likes == BIG and r.comment_count == BIG and r.view_count > 0 and r.engagement is None for r in kept)
    for name in ("popularity_over_time", "top_categories", "top_engagement", "fastest_growth_videos", "engagement_by_region",
                 "regional_engagement", "top_tags", "avg_comments_per_category", "trending_by_day_of_week",
                 "duration_vs_popularity", "hist_region_stats", "hist_channel_ids"):
        getattr(plans, name)(obs).collect()
    plans.view_count_change_per_day(obs, region="US").collect()
    plans.top_tag_combinations(obs, region="US", min_videos=1).collect()


def test_a_delta_too_large_is_null(spark):
    df = spark.createDataFrame([("k", 1, BIG), ("k", 2, -BIG), ("k", 3, 5)], "k string, o int, v bigint")
    got = {r.o: r.delta for r in period_delta(df, "k", "o", "v").collect()}
    assert got == {1: None, 2: None, 3: None if 5 + BIG > BIG else 0}


def test_a_stream_outlives_poison_messages(spark):
    """Every query runs on after messages of extreme durations and counts, and the
    windows of the others stay right."""
    root = shared_dir(spark, "test-poison", fresh=True)
    at = dt.datetime(2026, 1, 1, 10, 0, 0)
    for b in range(3):
        rows = []
        for i, d in enumerate(DURATIONS):
            t = at + dt.timedelta(seconds=40 * b + i)
            body = {"collected_at": t.isoformat(sep=" "), "video_id": f"v{i}", "channel_id": "c", "channel_title": "C",
                    "region_code": "US", "view_count": [1e308, -1e308, 1.0][i % 3], "duration": d}
            rows.append((b"k", json.dumps(body).encode(), t))
        spark.createDataFrame(rows, ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/input")
    app = TrendStreams(spark, root, window="30 seconds", state_partitions=2)
    for name in NAMES:
        app.start(name, parse_messages(replay_stream(spark, f"{root}/input")), trigger={"availableNow": True}).awaitTermination()
        assert app.result(name).count() > 0, name
    total = app.result("duration_distribution").agg(F.sum("short_videos_count"), F.sum("long_videos_count")).first()
    assert tuple(total) == (3 * 6, 3 * 2)  # "PT1H1M1S" and the longest seconds are long; 300 s is medium
