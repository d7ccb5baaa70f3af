import pytest
from pyspark.sql import functions as F

from trendlens.functions import (
    category_name,
    engagement_rate,
    event_time,
    half_up_hundredths,
    prepared_duration_bucket,
    prepared_duration_seconds,
    stream_duration_seconds,
    to_snake_case,
)


@pytest.mark.parametrize("name,expected", [
    ("channelTitle", "channel_title"),
    ("publishedAt", "published_at"),
    ("videoID", "video_id"),
    ("HTTPResponse", "http_response"),
    ("view_count", "view_count"),
    ("categoryId", "category_id"),
    ("aBcDe", "a_bc_de"),
    ("ABcDEf", "a_bc_d_ef"),
    ("a1B", "a1_b"),
    ("a_Bc", "a__bc"),
    ("Abc", "abc"),
    ("xAbBc", "x_ab_bc"),
])
def test_snake_case(name, expected):
    assert to_snake_case(name) == expected


def test_category_lookup(spark):
    df = spark.createDataFrame([(23,), (34,), (3,), (None,), (10,)], "c int")
    got = [r[0] for r in df.select(category_name("c")).collect()]
    assert got == ["Comedy", "Comedy", "Unknown", "Unknown", "Music"]


def test_prepared_durations(spark):
    rows = [("PT1H2M3S",), ("PT45S",), ("PT4M",), ("PT1H5S",), ("P1DT2H3M",), ("P0D",), ("",), (None,)]
    df = spark.createDataFrame(rows, "d string")
    got = [r[0] for r in df.select(prepared_duration_seconds("d")).collect()]
    assert got == [3723, 45, 240, 3605, 0, 0, 0, 0]
    assert df.select(prepared_duration_seconds("d")).schema[0].dataType.simpleString() == "int"


def test_stream_durations(spark):
    df = spark.createDataFrame([("P1DT2H3M",), ("PT1H2M3S",), (None,), ("junk",)], "d string")
    got = [r[0] for r in df.select(stream_duration_seconds("d")).collect()]
    assert got == [7380, 3723, 0, 0]


def test_buckets(spark):
    df = spark.createDataFrame([(239,), (240,), (1200,), (1201,), (None,)], "s int")
    got = [r[0] for r in df.select(prepared_duration_bucket("s")).collect()]
    assert got == ["short (< 4 min)", "medium (4-20 min)", "medium (4-20 min)",
                   "long (> 20 min)", "long (> 20 min)"]


def test_engagement(spark):
    df = spark.createDataFrame([(0, 5, 5), (100, None, 5), (200, 10, 10), (None, 1, 1)],
                               "v bigint, l bigint, c bigint")
    got = [r[0] for r in df.select(engagement_rate("v", "l", "c")).collect()]
    assert got == [0.0, None, 0.1, 0.0]


def test_half_up(spark):
    df = spark.createDataFrame([(125, 10), (124, 10), (5, 2), (0, 0), (1, 3)], "s bigint, n bigint")
    got = [r[0] for r in df.select(half_up_hundredths(F.col("s"), F.col("n"))).collect()]
    # 12.5 cents -> 13 -> 0.13; 12.4 -> 0.12; 2.5 -> 0.03; no rows -> NULL; 0.33 -> 0.0
    assert got == [0.13, 0.12, 0.03, None, 0.0]


def test_event_time(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.createDataFrame(
        [("2026-01-01 10:00:00",), ("2026-01-01T10:00:00.123456+00:00",), ("garbage",), (None,)],
        "s string").withColumn("k", F.lit("2020-05-05 05:05:05").cast("timestamp"))
    got = [str(r[0]) for r in df.select(event_time("s", "k")).collect()]
    assert got == ["2026-01-01 10:00:00", "2026-01-01 10:00:00.123456",
                   "2020-05-05 05:05:05", "2020-05-05 05:05:05"]
