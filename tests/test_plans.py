"""Physical-plan checks: pushdown, pruning, top-k fusion, broadcast of bounded sides."""

import tempfile

from trendlens import plans
from trendlens.sources import observations, read_observations, write_observations
from trendlens.streaming import processors as S

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _prepared(spark):
    path = tempfile.mkdtemp(prefix="obs-") + "/obs"
    write_observations(observations(spark, SF), path, files_per_partition=2)
    return read_observations(spark, path)


def test_region_filter_prunes_partitions_and_columns(spark):
    obs = _prepared(spark)
    df = plans.view_count_change_per_day(obs, region="ASIA")
    text = df._jdf.queryExecution().sparkPlan().toString()
    assert "PartitionFilters: [isnotnull(region_code" in text and "ASIA" in text
    assert "ReadSchema: struct<video_id:string,title:string,trending_date:date,view_count:bigint>" in text
    assert "BroadcastHashJoin" in text and "LeftSemi" in text


def test_topk_fuses(spark):
    obs = _prepared(spark)
    for df in (plans.top_tags(obs), plans.top_categories(obs), plans.fastest_growth_videos(obs)):
        assert "TakeOrderedAndProject" in df._jdf.queryExecution().sparkPlan().toString()


def test_tags_read_one_column(spark):
    obs = _prepared(spark)
    text = plans.top_tags(obs)._jdf.queryExecution().sparkPlan().toString()
    assert "ReadSchema: struct<tags:string>" in text


def test_pairs_sort_each_item_once(spark):
    from trendlens.operators import sorted_pairs
    df = spark.createDataFrame([(["b", "a", "c"],), (["x"],), (None,)], "t array<string>")
    out = df.select(sorted_pairs("t").alias("p"))
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("array_sort") == 1
    inner = text[text.index("lambdafunction"):]
    assert "array_sort" not in inner.split("array(array_sort")[0]
    assert [r.p for r in out.collect()][:2] == [["a|b", "a|c", "b|c"], []]


def test_fastest_growth_aggregates_all_rows_by_hash(spark):
    obs = _prepared(spark)
    text = plans.fastest_growth_videos(obs)._jdf.queryExecution().sparkPlan().toString()
    assert text.count("SortAggregate") <= 2  # titles of the surviving days only
    assert "HashAggregate(keys=[video_id" in text


def test_reach_topk_has_no_unpartitioned_window(spark):
    from trendlens.sources import stream_messages
    from trendlens.streaming import parse_messages
    msgs = parse_messages(stream_messages(spark, SF))
    text = S.channel_regional_reach(msgs, "1 hour")._jdf.queryExecution().sparkPlan().toString()
    assert "Window" not in text
