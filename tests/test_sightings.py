"""Sightings with state that expires, and freshness by chained operators."""

import datetime as dt
import json
import os
import random

import pytest

from trendlens import registered
from trendlens.session import session_conf, shared_dir
from trendlens.sources import ENVELOPE_SCHEMA, replay_stream
from trendlens.streaming import BatchLog, fresh_sightings, fresh_windows, parse_messages, state_rows
from trendlens.streaming.sightings import microseconds, partial_runs

AT = dt.datetime(2026, 1, 1)


def sighting(item, second):
    t = AT + dt.timedelta(seconds=second)
    body = {"collected_at": t.isoformat(sep=" "), "video_id": item}
    return ("k".encode(), json.dumps(body).encode(), t)


def land(spark, root, batches):
    for rows in batches:
        spark.createDataFrame(rows, ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/input")


def drained(spark, root, build, name="q"):
    log = BatchLog(f"{root}/out/{name}")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        q = build(parse_messages(replay_stream(spark, f"{root}/input"), watermark=None)).writeStream.outputMode("append") \
            .foreachBatch(log).option("checkpointLocation", f"{root}/checkpoints/{name}").trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    return log.read(spark)


def plain_fresh(times, ttl):
    """{(item, second)} of the fresh sightings."""
    out = set()
    for item, some in times.items():
        some = sorted(some)
        out |= {(item, t) for i, t in enumerate(some) if i == 0 or ttl is not None and t - some[i - 1] > ttl}
    return out


@pytest.mark.parametrize("ttl", [60, None])
def test_any_order_within_the_watermark(spark, ttl):
    """Messages out of order by up to 25 s, repeated ones, ties, an item in every second."""
    rng = random.Random(11)
    batches, times, upto = [], {}, 0
    for k in range(4):
        rows = []
        for second in range(upto, upto + 150):
            for item in ["hot"] + [f"v{rng.randrange(12)}" for _ in range(second % 40 == 0 and 3)]:
                times.setdefault(item, []).append(second)
                rows.append((second + rng.uniform(0, 25), sighting(item, second)))
        upto += 150
        batches.append(rows)
    # A message arrives up to 25 s after its time, so a batch holds some of the time before.
    arrival = sorted(r for rows in batches for r in rows)
    n = len(arrival) // 4
    root = shared_dir(spark, "test-sightings", fresh=True)
    land(spark, root, [[m for _, m in arrival[i * n:(i + 1) * n if i < 3 else None]] for i in range(4)])
    got = drained(spark, root, lambda s: fresh_sightings(s, None if ttl is None else f"{ttl} seconds"))
    last = max(max(t) for t in times.values())
    want = {(i, AT + dt.timedelta(seconds=s)) for i, s in plain_fresh(times, ttl) if s <= last - 30}
    rows = [(r.item, r.fresh_at) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    # The state holds no item that was not seen within the TTL of the watermark.
    held = {r.key.video_id for r in state_rows(spark, f"{root}/checkpoints/q", "runs").collect()}
    live = {i for i, t in times.items() if ttl is None or max(t) + ttl > last - 30 - 1}
    assert held <= live and (ttl is None or len(held) < len(times))


def test_state_is_bounded_by_the_live_items(spark):
    """2,000 items that come once each: after the run the state holds the last ones only."""
    rows = [[sighting(f"v{500 * k + i}", 1000 * k + i) for i in range(500)] for k in range(4)]
    root = shared_dir(spark, "test-ttl", fresh=True)
    land(spark, root, rows)
    got = drained(spark, root, lambda s: fresh_sightings(s, "100 seconds"))
    assert got.count() == 2000 - 30  # those beyond the watermark are not final
    state = state_rows(spark, f"{root}/checkpoints/q", "runs")
    assert 100 <= state.count() <= 132


def test_windows_come_out_once_and_final(spark):
    root = shared_dir(spark, "test-append", fresh=True)
    land(spark, root, [[sighting("a", 5), sighting("b", 6), sighting("a", 35)], [sighting("c", 20), sighting("d", 95)],
                       [sighting("a", 130), sighting("e", 131), sighting("f", 200)], [sighting("g", 400)]])
    got = drained(spark, root, lambda s: fresh_windows(s, None, "30 seconds"))
    found = {r.window_start[14:]: (r.fresh_count, r.batch_id) for r in got.collect()}
    assert {w: n for w, (n, _) in found.items()} == {"00:00": 3, "01:30": 1, "02:00": 1, "03:00": 1}
    assert got.count() == len(found)
    again = drained(spark, root, lambda s: fresh_windows(s, "1 minute", "30 seconds"), "ttl")
    assert {r.window_start[14:]: r.fresh_count for r in again.collect()} == {"00:00": 3, "01:30": 1, "02:00": 2, "03:00": 1}


def test_a_restart_goes_on_from_the_state(spark):
    root = shared_dir(spark, "test-sightings-restart", fresh=True)
    land(spark, root, [[sighting("a", 0), sighting("b", 100)]])
    drained(spark, root, lambda s: fresh_sightings(s, "90 seconds"))
    land(spark, root, [[sighting("a", 130), sighting("b", 180), sighting("c", 400)]])
    drained(spark, root, lambda s: fresh_sightings(s, "90 seconds"))
    # The last commit is lost: its batch is run again and replaces its own output.
    commits = f"{root}/checkpoints/q/commits"
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    for f in (f"{commits}/{last}", f"{commits}/.{last}.crc"):
        if os.path.exists(f):
            os.remove(f)
    got = drained(spark, root, lambda s: fresh_sightings(s, "90 seconds"))
    seconds = sorted((r.item, int((r.fresh_at - AT).total_seconds())) for r in got.collect())
    assert seconds == [("a", 0), ("a", 130), ("b", 100)]


def test_a_hot_item_costs_a_few_rows(spark):
    rows = [(f"v{i}" if i % 3 else "hot", AT + dt.timedelta(seconds=i)) for i in range(30_000)]
    rows += [(None, AT), ("x", None)]
    df = spark.createDataFrame(rows, "video_id string, event_time timestamp").repartition(4)
    runs = partial_runs(df, "1 hour")
    assert runs.where("video_id = 'hot'").count() <= 8
    assert runs.where("video_id is null").count() == 0
    assert partial_runs(df.limit(0), None).collect() == []
    assert microseconds("1500 ms") == 1_500_000 and microseconds(None) is None


def test_static_frames_give_the_same(spark):
    times = {"a": [0, 50, 111, 500], "b": [7], "c": [1, 1, 61, 122]}
    rows = [sighting(i, s) for i, some in times.items() for s in some]
    df = parse_messages(spark.createDataFrame(rows, ENVELOPE_SCHEMA), watermark=None)
    for ttl in (60, None):
        got = fresh_sightings(df, None if ttl is None else f"{ttl} seconds").collect()
        assert {(r.item, int((r.fresh_at - AT).total_seconds())) for r in got} == plain_fresh(times, ttl)
        assert len(got) == len(plain_fresh(times, ttl))


def test_the_queries_run_in_a_session_with_another_state_store(spark, tmp_path):
    """A session that was not built here keeps its state store, and both queries run."""
    hours = [(1, 0), (1, 1), (2, 0.5), (1, 14), (2, 20), (3, 45), (1, 80)]
    rows = [(i, AT + dt.timedelta(hours=h), user, "r", 1.0, '{"k": 3}') for i, (user, h) in enumerate(hours)]
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string") \
        .coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    key = "spark.sql.streaming.stateStore.providerClass"
    other = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    with session_conf(spark, {key: other}):
        again = registered.fresh_within_ttl_stream(spark, str(tmp_path)).collect()
        once = registered.trending_freshness_append_stream(spark, str(tmp_path)).collect()
        assert spark.conf.get(key) == other
    found = lambda some: {r.window_start[5:16]: r.fresh_count for r in some}
    assert found(again) == {"01-01 00:00": 2, "01-01 14:00": 1, "01-01 20:00": 1, "01-02 21:00": 1}
    assert found(once) == {"01-01 00:00": 2, "01-02 21:00": 1}
