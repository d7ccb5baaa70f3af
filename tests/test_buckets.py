"""The bucketed upsert table."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from trendlens.session import shared_dir
from trendlens.sources import land_as_stream, replay_stream, stream_messages
from trendlens.streaming import BucketedTable, TrendStreams, parse_messages
from trendlens.streaming import processors as S

SCHEMA = "k string, best bigint, first bigint"
MERGE = {"best": F.max, "first": F.min}


def table(spark, n_buckets=16):
    return BucketedTable(shared_dir(spark, "test-buckets", fresh=True), SCHEMA, ["k"], MERGE, n_buckets)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def state(t, spark):
    return sorted(((r.k, r.best, r.first) for r in t.read(spark).collect()), key=repr)


def folders(t, spark):
    return t.manifest(spark)["folders"]


def test_a_batch_of_one_bucket_rewrites_one_bucket(spark):
    t = table(spark)
    assert t.read(spark).collect() == []
    t.upsert(frame(spark, [(f"k{i}", i, i) for i in range(3000)]), 0)
    bucket = {r.k: r.b for r in t.read(spark).select("k", t._bucket(16).alias("b")).collect()}
    mine = [k for k in bucket if bucket[k] == 5]
    before, files = folders(t, spark), file_set(t)
    touched = t.upsert(frame(spark, [(k, 10_000, 0) for k in mine[:max(1, len(mine) // 100)]]), 1)
    after = folders(t, spark)
    assert touched == [5] and len(after) == 16
    assert {b for b in after if after[b] != before[b]} == {"5"}
    assert len(file_set(t) - files) == 1  # one new file; the others are left alone
    assert t.read(spark).where("best = 10000").count() == max(1, len(mine) // 100)


def file_set(t):
    return {os.path.join(d, f) for d, _, names in os.walk(t.path) for f in names if f.endswith(".parquet")}


def test_equals_union_and_fold_and_replay_changes_nothing(spark):
    rng, t, rows = random.Random(1), table(spark, 4), []
    for b in range(6):
        batch = [(rng.choice([None, *(f"k{i}" for i in range(40))]), rng.randrange(1000), rng.randrange(1000))
                 for _ in range(rng.choice([0, 1, 60]))]
        rows += batch
        t.upsert(frame(spark, batch), b)
        now = state(t, spark)
        assert t.upsert(frame(spark, [("k0", 10**6, -1)]), b) == [] and state(t, spark) == now
        want = {}
        for k, x, y in rows:
            want[k] = (max(x, want.get(k, (x, y))[0]), min(y, want.get(k, (x, y))[1]))
        assert now == sorted(((k, *v) for k, v in want.items()), key=repr)


def test_a_crash_before_the_manifest_moved(spark, monkeypatch):
    """The batch's files are there but nothing names them: readers see the table
    before, the retry brings it up to date, and the orphan goes."""
    from trendlens.streaming.sinks import Folder

    t = table(spark, 4)
    t.upsert(frame(spark, [("a", 1, 1), ("b", 1, 1)]), 0)
    with monkeypatch.context() as m:
        m.setattr(Folder, "replace_text", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            t.upsert(frame(spark, [("a", 9, 0)]), 1)
    assert state(t, spark) == [("a", 1, 1), ("b", 1, 1)]
    t.upsert(frame(spark, [("a", 9, 0)]), 1)
    assert state(t, spark) == [("a", 9, 0), ("b", 1, 1)]
    t.upsert(frame(spark, [("c", 1, 1)]), 2)
    t.upsert(frame(spark, [("c", 2, 1)]), 3)
    live = set(folders(t, spark).values()) | set(t.manifest(spark)["kept"])
    assert {n for n in os.listdir(t.path) if n.startswith("v=")} == live


def test_readers_that_have_begun_keep_their_version(spark):
    t = table(spark, 2)
    t.upsert(frame(spark, [("a", 1, 1)]), 0)
    old = t.read(spark)
    t.upsert(frame(spark, [("a", 2, 0)]), 1)
    assert [tuple(r) for r in old.collect()] == [("a", 1, 1)] and state(t, spark) == [("a", 2, 0)]
    assert json.loads(open(f"{t.path}/manifest.json").read())["batch"] == 1


def test_the_app_keeps_reach_in_buckets(spark):
    """S2 as a table that is current after every batch, through a crash between the
    table and the commit too."""
    sf = "/root/testdata/sf0.001"
    root = shared_dir(spark, "test-reach", fresh=True)
    land_as_stream(stream_messages(spark, sf), f"{root}/input", 3)
    app = TrendStreams(spark, root, window="1 hour", state_partitions=2, reach_buckets=4)
    want = sorted(map(tuple, S.channel_regional_reach(parse_messages(stream_messages(spark, sf)), "1 hour").collect()))
    for _ in range(2):
        app.start("channel_regional_reach", parse_messages(replay_stream(spark, f"{root}/input")),
                  {"availableNow": True}).awaitTermination()
        assert sorted(map(tuple, app.result("channel_regional_reach").collect())) == want
        commits = f"{root}/checkpoints/channel_regional_reach/commits"
        last = max(int(f) for f in os.listdir(commits) if f.isdigit())
        for f in (f"{commits}/{last}", f"{commits}/.{last}.crc"):
            if os.path.exists(f):
                os.remove(f)
    app.publish("channel_regional_reach")
    assert sorted(map(tuple, app.published("channel_regional_reach").read(spark).collect())) == want
