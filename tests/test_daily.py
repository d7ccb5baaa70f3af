"""Daily loads, co-located storage, sessions, sketches: stored forms of the questions."""

import datetime as dt
import json
import os
import random
import re
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fixtures import obs_frame, obs_row
from trendlens import plans, registered
from trendlens.operators.tags import frequent_tags
from trendlens.plans import daily
from trendlens.session import shared_dir
from trendlens.sources import ENVELOPE_SCHEMA, observations, read_raw_csv, replay_stream, write_bucketed, write_observations
from trendlens.streaming import BatchLog, item_sessions, parse_messages, reach_over, reach_sketch_updates

SF = "/root/testdata/sf0.001"
D = dt.date


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root)
            for f in names if f.endswith(".parquet")}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def close(a, b):
    return len(a) == len(b) and all(x == pytest.approx(y) if isinstance(x, float) else x == y
                                    for r, s in zip(a, b) for x, y in zip(r, s))


def test_one_day_rewrites_and_reads_one_day(spark):
    obs = observations(spark, SF)
    first = [r[0] for r in obs.select("trending_date").distinct().orderBy("trending_date").limit(60).collect()]
    few = obs.where(F.col("trending_date").isin(first)).unionByName(
        obs.limit(3).withColumn("trending_date", F.lit(None).cast("date")))
    tables = daily.DailyTables(spark, shared_dir(spark, "test-daily", fresh=True))
    days = tables.load(few.withColumn("view_count", F.col("view_count") + 1))
    assert None in days and len(days) > 50
    day = days[len(days) // 2]
    before = {name: files(f"{tables.root}/{name}") for name in ("observations", "cube")}
    assert tables.load(few.where(F.col("trending_date") == day)) == [day]
    for name, old in before.items():
        new = files(f"{tables.root}/{name}")
        gone, came = set(old) - set(new), set(new) - set(old)
        assert gone and came and all(f"trending_date={day}" in f for f in gone | came)
        assert all(new[f] == old[f] for f in set(new) & set(old))
    assert all(f"trending_date={day}" in f for f in tables._days("observations", [day]).inputFiles())
    tables.load(few)
    tables.load(few.where(F.col("trending_date").isNull()))
    assert tables.load(few.limit(0)) == []
    assert rows(tables.observations().select(*few.columns)) == rows(few)
    for name, question in daily.QUESTIONS.items():
        assert close(rows(question(tables.cube())), rows(getattr(plans, name)(few))), name


def test_growth_over_buckets_needs_no_shuffle_below_its_window(spark):
    obs = observations(spark, SF)
    name = f"obs_{uuid.uuid4().hex}"
    write_bucketed(obs, name, shared_dir(spark, "test-bucketed", fresh=True), n_buckets=4)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plans.fastest_growth_videos(spark.table(name))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    # The k items that are broadcast are found by a shuffle of their peaks; the observations
    # themselves reach both windows without one.
    lines = [x for x in plan.split("\n") if x.strip()]
    depth = [re.search(r"\w", x.replace("*", " ")).start() for x in lines]

    def below(i):
        end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
        at = i + 1
        while at < end:
            if "BroadcastExchange" in lines[at]:
                at = next((j for j in range(at + 1, end) if depth[j] <= depth[at]), end)
                continue
            yield lines[at]
            at += 1

    windows = [i for i, x in enumerate(lines) if re.search(r"[-+] (\*\(\d+\) )?Window ", x)]
    assert len(windows) == 2
    for i in windows:
        assert any("FileScan" in x for x in below(i)) and not any("Exchange" in x for x in below(i))
    assert rows(plans.fastest_growth_videos(spark.table(name))) == rows(plans.fastest_growth_videos(obs))


def test_stored_forms_get_more_files_as_they_grow(spark):
    """No file, so no task, holds several times the rows asked for (keys may meet in a task); the rows are the same."""
    some = [obs_row(video=f"v{i % 400}", day=1 + i % 28, region="A" if i % 4 else None, views=i) for i in range(4000)]
    obs = obs_frame(spark, some).repartition(3)
    path, name = shared_dir(spark, "test-grown", fresh=True), f"obs_{uuid.uuid4().hex}"
    sizes = lambda at: sorted(r[0] for r in spark.read.parquet(at).groupBy(
        F.input_file_name()).count().select("count").collect())
    write_observations(obs, f"{path}/few", files_per_partition=2)
    write_observations(obs, f"{path}/many", files_per_partition=2, rows_per_file=300)
    assert len(sizes(f"{path}/few")) <= 4 and 11 <= len(sizes(f"{path}/many")) <= 20
    assert sizes(f"{path}/many")[-1] < 4 * 300 and sizes(f"{path}/few")[-1] > 1000
    assert rows(spark.read.parquet(f"{path}/many").select(*obs.columns)) == rows(obs)
    write_bucketed(obs, name, f"{path}/bucketed", n_buckets=4, rows_per_bucket=300)
    buckets = spark.sql(f"describe extended {name}").where("col_name = 'Num Buckets'").first()[1]
    assert buckets == "16" and sizes(f"{path}/bucketed")[-1] < 2 * 300
    assert rows(spark.table(name).select(*obs.columns)) == rows(obs)


def test_sums_of_the_cube_are_exact(spark):
    values = [2**63 - 1, 2**63 - 1, -2**63, -1, 5, None, 2**62 + 3]
    got = daily.cube_rows(obs_frame(spark, [obs_row(views=v, likes=-7, comments=None) for v in values])).first()
    assert (int(got.view_count_sum), got.view_count_n) == (sum(v for v in values if v is not None), 6)
    assert int(got.likes_sum) == -49 and got.comment_count_sum is None


def test_the_newest_day_is_looked_up_once(spark, monkeypatch):
    """The second load reads its day by a plain date, which the scan can use."""
    plans_seen = []
    load = daily.DailyTables.load
    monkeypatch.setattr(daily.DailyTables, "load", lambda self, obs: (
        plans_seen.append(obs._jdf.queryExecution().optimizedPlan().toString()), load(self, obs))[1])
    registered._daily(spark, SF)
    assert len(plans_seen) == 2 and not any("subquery" in p for p in plans_seen)


def test_a_csv_file_without_quoted_newlines_is_split(spark, tmp_path):
    text = "a,b\n" + "".join(f"{i},\"x,{i}\"\n" for i in range(60_000))
    (tmp_path / "raw.csv").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        whole = read_raw_csv(spark, str(tmp_path))
        split = read_raw_csv(spark, str(tmp_path), multi_line=False)
        assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() > 4
        assert rows(whole) == rows(split)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


AT = dt.datetime(2026, 1, 1)


def message(item, second, region="r", views=1.0):
    t = AT + dt.timedelta(seconds=second)
    body = {"collected_at": t.isoformat(sep=" "), "video_id": item, "view_count": views, "region_code": region,
            "channel_id": "c", "channel_title": "C"}
    return (b"k", json.dumps(body).encode(), t)


def test_late_messages_join_two_sessions(spark):
    """20 s apart is one session, inclusive; a message of 12 comes late and joins."""
    batches = [[message("a", 0), message("b", 0), message("a", 24, views=7.0)], [message("b", 20)],
               [message("a", 12, views=3.0), message("b", 41)], [message(None, 40), message("c", 300)], [message("c", 301)]]
    root = shared_dir(spark, "test-sessions", fresh=True)
    for some in batches:
        spark.createDataFrame(some, ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/input")
    log = BatchLog(f"{root}/out")
    stream = item_sessions(parse_messages(replay_stream(spark, f"{root}/input")), "20 seconds")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        stream.writeStream.outputMode("append").foreachBatch(log).option(
            "checkpointLocation", f"{root}/c").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got = sorted((r.video_id, (r.first_at - AT).seconds, (r.last_at - AT).seconds, r.n_messages, r.max_views)
                 for r in log.read(spark).collect())
    assert got == [("a", 0, 24, 3, 7.0), ("b", 0, 20, 2, 1.0), ("b", 41, 41, 1, 1.0)]


def test_sketches_of_any_span_equal_exact_counts(spark):
    rng = random.Random(2)
    some = [message("v", rng.randrange(3000), rng.choice(["r1", "r2", "r3", "r4", None])) for _ in range(400)]
    parsed = parse_messages(spark.createDataFrame([*some, message("v", 1, None)], ENVELOPE_SCHEMA), watermark=None)
    sketches = reach_sketch_updates(parsed, "1 minute")
    assert dict(sketches.dtypes)["regions"] == "binary"
    for low, high in ((0, 3000), (600, 1200), (60, 120)):
        inside = sketches.where(F.col("window_start").between(*(str(AT + dt.timedelta(seconds=s)) for s in (low, high - 60))))
        exact = {json.loads(v)["region_code"] for _, v, t in some if low <= (t - AT).total_seconds() < high} - {None}
        assert [r.regional_reach for r in reach_over(inside).collect()] == [len(exact)]
    assert reach_over(sketches.limit(0)).collect() == []


def test_frequent_tags_of_a_large_vocabulary(spark):
    """30,000 different tags and 1,024 counters: every tag above the share comes back,
    counts lie within the bound, and the sketch stays small."""
    rng = random.Random(3)
    tags = [f"t{min(int(rng.paretovariate(0.7)), 10**9) % 30_000}" for _ in range(120_000)]
    df = spark.createDataFrame([("|".join(tags[i:i + 4]),) for i in range(0, len(tags), 4)], "tags string").repartition(6)
    true, total = Counter(tags), len(tags)
    got = {r.tag: r for r in frequent_tags(df, 0.01, tracked=1024).collect()}
    bound = -(-total * 3.5 // 2048)
    assert {t for t, n in true.items() if n >= 0.01 * total} <= set(got)
    assert all(abs(r.estimate - true[t]) <= bound and r.least <= true[t] and r.total == total for t, r in got.items())
    assert all(true[t] >= 0.01 * total - 2 * bound for t in got)
    small = frequent_tags(df.limit(0), 0.5).collect()
    assert small == []
    sketch = df.select(F.explode(F.split("tags", r"\|")).alias("tag")).agg(F.expr("approx_top_k_accumulate(tag, 1024)").alias("s"))
    assert sketch.select(F.length(F.col("s.sketch"))).first()[0] < 100_000
    with pytest.raises(ValueError):
        frequent_tags(df, 0.0001, tracked=64)
