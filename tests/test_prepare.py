import os
import tempfile

from trendlens.plans import OBSERVATION_COLUMNS, prepare
from trendlens.sources import read_raw_csv

HEADER = ("video_id,title,publishedAt,channelId,channelTitle,categoryId,trending_date,tags,"
          "view_count,likes,dislikes,comment_count,duration,region_code,description\n")


def _csv(rows):
    d = tempfile.mkdtemp(prefix="csv-")
    with open(os.path.join(d, "raw.csv"), "w") as f:
        f.write(HEADER)
        for r in rows:
            f.write(r + "\n")
    return d


def test_csv_roundtrip_and_prepare(spark):
    rows = [
        'v1,"He said ""hi"", then\nleft",2026-01-01T10:00:00Z,c1,Chan,23,2026-01-02T00:00:00Z,a|b,'
        '100,5,1,5,PT1H2M3S,US,"multi\nline"',
        'v2,plain,2026-01-01T10:00:00Z,c2,Chan2,34,2026-01-02T00:00:00Z,x,0,5,1,5,PT45S,US,d',
        'v3,nulls,2026-01-01T10:00:00Z,c3,Chan3,3,2026-01-02T00:00:00Z,,200,,1,5,PT4M,GB,d',
        'v4,noviews,2026-01-01T10:00:00Z,c4,Chan4,,2026-01-02T00:00:00Z,x,,5,1,5,PT1H5S,GB,d',
        'v5,edge,2026-01-01T10:00:00Z,c5,Chan5,10,2026-01-02T00:00:00Z,x,25000000000,0,0,0,P1DT2H3M,GB,d',
        'v6,over,2026-01-01T10:00:00Z,c6,Chan6,10,2026-01-02T00:00:00Z,x,25000000001,0,0,0,,GB,d',
    ]
    raw = read_raw_csv(spark, _csv(rows))
    out = prepare(raw)
    assert tuple(out.columns) == OBSERVATION_COLUMNS
    got = {r["video_id"]: r for r in out.collect()}
    assert sorted(got) == ["v1", "v2", "v3", "v5"]  # NULL views and > 25e9 dropped
    assert got["v1"]["title"] == 'He said "hi", then\nleft'
    assert got["v1"]["category_name"] == "Comedy" and got["v2"]["category_name"] == "Comedy"
    assert got["v3"]["category_name"] == "Unknown"
    assert got["v1"]["duration_seconds"] == 3723 and got["v2"]["duration_seconds"] == 45
    assert got["v3"]["duration_seconds"] == 240 and got["v5"]["duration_seconds"] == 0
    assert got["v1"]["engagement"] == 0.1
    assert got["v2"]["engagement"] == 0.0
    assert got["v3"]["engagement"] is None
    assert str(got["v1"]["trending_date"]) == "2026-01-02"
    types = dict(out.dtypes)
    assert types["view_count"] == "bigint" and types["category_id"] == "int"
    assert types["trending_date"] == "date" and types["published_at"] == "timestamp"


def test_numbers_written_as_decimals(spark):
    from trendlens.plans.prepare import drop_outliers, select_typed
    texts = ["100", "100.0", "1e5", "", "abc", None, "2.9", "1e40", " 7 "]
    cols = ["region_code", "video_id", "title", "published_at", "channel_id", "channel_title", "trending_date",
            "tags", "likes", "dislikes", "comment_count", "duration"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, view_count string").selectExpr(
        "cast(n as string) as category_id", "view_count", *[f"view_count as {c}" for c in cols])
    got = {r.category_id: r.view_count for r in select_typed(df).collect()}
    assert got == {0: 100, 1: 100, 2: 100000, 3: None, 4: None, 5: None, 6: 2, 7: None, 8: 7}
    assert drop_outliers(select_typed(df)).count() == 5


def test_duration_units_overflow_one_by_one(spark):
    from trendlens.functions import prepared_duration_seconds
    df = spark.createDataFrame([("PT1H99999999999S",), ("PT99999999999999999999H2M",), ("PT2000000000H",)], "d string")
    assert [r[0] for r in df.select(prepared_duration_seconds("d")).collect()] == [3600, 120, 0]
