"""Streams: replay equals batch, chunking invariance, idempotent batches,
restart from checkpoint, late data."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from trendlens.session import shared_dir
from trendlens.sources import (
    ENVELOPE_SCHEMA,
    land_as_stream,
    replay_stream,
    stream_history,
    stream_messages,
)
from trendlens.streaming import NAMES, BatchLog, TrendStreams, parse_messages
from trendlens.streaming import processors as S

SF = "/root/testdata/sf0.001"
W = "1 hour"
UNTIL = "2024-01-01 06:00:00"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _replay(spark, name, n_files, window=W, sf=SF, compact_every=None):
    root = shared_dir(spark, "test-streams", name, fresh=True)
    land_as_stream(stream_messages(spark, sf), f"{root}/input", n_files)
    app = TrendStreams(spark, root, history=stream_history(spark, sf, UNTIL), window=window,
                       compact_every=compact_every)
    q = app.start(name, parse_messages(replay_stream(spark, f"{root}/input")),
                  trigger={"availableNow": True})
    q.awaitTermination()
    return app.result(name)


def _batch(spark, name, sf=SF):
    msgs = parse_messages(stream_messages(spark, sf))
    hist = stream_history(spark, sf, UNTIL)
    fns = {
        "duration_distribution": lambda: S.duration_distribution(msgs, W),
        "channel_regional_reach": lambda: S.channel_regional_reach(msgs, W),
        "trending_freshness": lambda: S.trending_freshness(msgs, W),
        "historical_overlap": lambda: S.historical_overlap(msgs, hist, W),
        "current_vs_historical_views": lambda: S.current_vs_historical_views(msgs, hist, W),
    }
    return fns[name]()


def test_each_stream_equals_batch_and_is_chunking_invariant(spark):
    for name in ("duration_distribution", "channel_regional_reach", "trending_freshness",
                 "historical_overlap", "current_vs_historical_views"):
        want = _rows(_batch(spark, name))
        assert _rows(_replay(spark, name, 1)) == want, name
        assert _rows(_replay(spark, name, 3, compact_every=2)) == want, name


def test_freshness_by_arrival_equals_earliest_on_ordered_input(spark):
    want = _rows(_batch(spark, "trending_freshness"))
    root = shared_dir(spark, "test-arrival", fresh=True)
    land_as_stream(stream_messages(spark, SF), f"{root}/input", 3)
    app = TrendStreams(spark, root, window=W, freshness="arrival")
    app.start("trending_freshness", parse_messages(replay_stream(spark, f"{root}/input")),
              trigger={"availableNow": True}).awaitTermination()
    assert _rows(app.result("trending_freshness")) == want
    logged = app.log("trending_freshness").read(spark)
    assert logged.count() == logged.select("video_id").distinct().count()  # one row per item


def test_batch_log_compaction(spark):
    from trendlens.streaming.sinks import fold_per_key
    root = shared_dir(spark, "test-compact", fresh=True)
    log = BatchLog(root, merge=fold_per_key(["k"], v=F.max), compact_every=2)
    for i, rows in enumerate([[("a", 1), ("b", 2)], [("a", 3)], [("b", 1)], [("c", 7)]]):
        df = spark.createDataFrame(rows, "k string, v int")
        log(df, i)
        if i % 2:
            log(df, i)  # a replayed batch leaves its snapshot as it is
    merged = log.read(spark)
    got = sorted(tuple(r) for r in merged.groupBy("k").agg(F.max("v")).collect())
    assert got == [("a", 3), ("b", 2), ("c", 7)]
    # snapshot up to batch 3 holds everything; no batch folder is read after it
    assert merged.count() == 3
    # what the first snapshot superseded is gone
    assert sorted(n for n in os.listdir(root) if n.startswith("batch_id=")) == ["batch_id=2", "batch_id=3"]
    assert len(os.listdir(f"{root}/_snapshots")) == 2


def test_batch_log_replay_is_idempotent(spark):
    root = shared_dir(spark, "test-log", fresh=True)
    log = BatchLog(root)
    df = spark.createDataFrame([("w1", 1), ("w2", 2)], "k string, v int")
    log(df, 0)
    log(df, 0)  # a retried batch replaces its own output
    log(spark.createDataFrame([("w1", 5)], "k string, v int"), 1)
    from trendlens.streaming import latest_per_key
    got = sorted(tuple(r) for r in latest_per_key(log.read(spark), ["k"]).collect())
    assert got == [("w1", 5), ("w2", 2)]


def test_restart_from_checkpoint(spark):
    root = shared_dir(spark, "test-restart", fresh=True)
    msgs = stream_messages(spark, SF)
    edges = msgs.select(F.col("timestamp").cast("double").alias("t")).approxQuantile("t", [0.5], 0.0)
    first = msgs.where(F.col("timestamp").cast("double") < edges[0])
    second = msgs.where(F.col("timestamp").cast("double") >= edges[0])
    app = TrendStreams(spark, root, history=stream_history(spark, SF, UNTIL), window=W)
    land_as_stream(first, f"{root}/input", 2)
    app.start("duration_distribution", parse_messages(replay_stream(spark, f"{root}/input")),
              trigger={"availableNow": True}).awaitTermination()
    land_as_stream(second, f"{root}/input", 2)  # more data arrives; the query restarts
    app.start("duration_distribution", parse_messages(replay_stream(spark, f"{root}/input")),
              trigger={"availableNow": True}).awaitTermination()
    assert _rows(app.result("duration_distribution")) == _rows(_batch(spark, "duration_distribution"))


def _msg(ts: str, vid: str, seconds: int):
    body = {"collected_at": ts, "video_id": vid, "channel_id": "c", "channel_title": "C",
            "region_code": "US", "view_count": 1.0, "duration": f"PT{seconds}S"}
    return (vid.encode(), json.dumps(body).encode(), dt.datetime.fromisoformat(ts))


def test_late_row_does_not_change_closed_window(spark):
    root = shared_dir(spark, "test-late", fresh=True)
    batches = [
        [_msg("2026-01-01 10:00:05", "a", 10)],
        [_msg("2026-01-01 10:02:00", "b", 10)],   # watermark moves to 10:01:30
        [_msg("2026-01-01 10:03:00", "c", 10)],
        [_msg("2026-01-01 10:00:07", "late", 10)],  # two batches after the advance: dropped
    ]
    for rows in batches:
        spark.createDataFrame(rows, ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/input")
    app = TrendStreams(spark, root, window="30 seconds")
    app.start("duration_distribution", parse_messages(replay_stream(spark, f"{root}/input")),
              trigger={"availableNow": True}).awaitTermination()
    got = {r["window_start"]: r["short_videos_count"] for r in app.result("duration_distribution").collect()}
    assert got["2026-01-01 10:00:00"] == 1
    assert set(got) == {"2026-01-01 10:00:00", "2026-01-01 10:02:00", "2026-01-01 10:03:00"}


def test_parse_malformed_and_types(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    kafka_ts = dt.datetime(2026, 1, 1, 9, 0, 0)
    rows = [(b"k", b"{not json", kafka_ts),
            (b"k", b'{"category_id": 10, "view_count": "7", "collected_at": "nope"}', kafka_ts)]
    out = parse_messages(spark.createDataFrame(rows, ENVELOPE_SCHEMA), watermark=None).collect()
    assert out[0]["video_id"] is None and out[0]["event_time"] == kafka_ts
    assert out[1]["category_id"] == "10" and out[1]["view_count"] is None
    assert out[1]["event_time"] == kafka_ts


def test_empty_history_gives_null_baseline(spark):
    msgs = parse_messages(stream_messages(spark, SF))
    empty = stream_history(spark, SF, UNTIL).limit(0)
    rows = S.current_vs_historical_views(msgs, empty, W).collect()
    assert rows and all(r["hist_max_views"] is None and r["hist_avg_views"] is None for r in rows)
    ov = S.historical_overlap(msgs, empty, W).collect()
    assert all(r["hist_overlap"] == 0 for r in ov)


def test_freshness_counts_each_item_once(spark):
    msgs = parse_messages(stream_messages(spark, SF))
    total = S.trending_freshness(msgs, W).agg(F.sum("fresh_count")).first()[0]
    assert total == msgs.select("video_id").distinct().count()


@pytest.mark.parametrize("compact_every", [None, 1])
def test_crash_after_sink_write_is_exactly_once(spark, compact_every):
    """Drop the last commit marker (as if the driver died after the sink wrote
    batch N but before Spark committed it): the restart re-runs batch N, which
    overwrites its own output, and the final tables stay equal to batch, also if
    that batch compacted its log, and if it happens twice."""
    for name in NAMES if compact_every == 1 else NAMES[:1]:
        root = shared_dir(spark, "test-crash", name, fresh=True)
        land_as_stream(stream_messages(spark, SF), f"{root}/input", 3)
        app = TrendStreams(spark, root, history=stream_history(spark, SF, UNTIL), window=W,
                           compact_every=compact_every)

        def run():
            app.start(name, parse_messages(replay_stream(spark, f"{root}/input")),
                      trigger={"availableNow": True}).awaitTermination()

        run()
        want = _rows(_batch(spark, name))
        for _ in range(2):
            commits = f"{root}/checkpoints/{name}/commits"
            last = max(int(f) for f in os.listdir(commits) if f.isdigit())
            os.remove(f"{commits}/{last}")
            if os.path.exists(f"{commits}/.{last}.crc"):  # the local file system's checksum sidecar
                os.remove(f"{commits}/.{last}.crc")
            run()
            assert str(last) in os.listdir(commits)
            assert _rows(app.result(name)) == want, name


def test_message_without_any_time_changes_no_window(spark):
    root = shared_dir(spark, "test-no-time", fresh=True)
    key, value, _ = _msg("2026-01-01 10:00:05", "x", 10)
    timeless = (key, json.dumps({"video_id": "x", "duration": "PT10S"}).encode(), None)
    batches = [[_msg("2026-01-01 10:00:05", "a", 10), timeless], [_msg("2026-01-01 10:02:00", "b", 10)],
               [timeless], [_msg("2026-01-01 10:03:00", "c", 10)]]
    for rows in batches:
        spark.createDataFrame(rows, ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/input")
    app = TrendStreams(spark, root, window="30 seconds")
    app.start("duration_distribution", parse_messages(replay_stream(spark, f"{root}/input")),
              trigger={"availableNow": True}).awaitTermination()
    got = {r["window_start"]: r["short_videos_count"] for r in app.result("duration_distribution").collect()}
    assert got == {"2026-01-01 10:00:00": 1, "2026-01-01 10:02:00": 1, "2026-01-01 10:03:00": 1}


def test_landing_keeps_every_row(spark):
    root = shared_dir(spark, "test-landing", fresh=True)
    rows = [(b"k", b"v", None if i % 3 == 0 else dt.datetime(2026, 1, 1, 0, i)) for i in range(30)]
    df = spark.createDataFrame(rows, ENVELOPE_SCHEMA)
    assert land_as_stream(df, f"{root}/input", 4, rows_per_file=2) == 4
    assert spark.read.parquet(f"{root}/input").count() == 30


def test_views_of_any_size(spark):
    """Huge values and NaN neither stop the question nor change other windows,
    static and streamed."""
    views = [("2026-01-01 10:00:05", 1.5), ("2026-01-01 10:00:06", 2.0), ("2026-01-01 10:01:05", 1e30),
             ("2026-01-01 10:01:06", 4.0), ("2026-01-01 10:02:05", 1e40), ("2026-01-01 10:03:05", float("nan"))]
    rows = []
    for t, v in views:
        body = {"collected_at": t, "video_id": "v", "view_count": v}
        rows.append((b"v", json.dumps(body).encode(), dt.datetime.fromisoformat(t)))
    df = spark.createDataFrame(rows, ENVELOPE_SCHEMA)
    hist = spark.createDataFrame([("US", "c", 1e40), ("US", "c", 3.0)], "region_code string, channel_id string, view_count double")
    static = S.current_vs_historical_views(parse_messages(df), hist, "30 seconds")
    got = {r["window_start"][11:16]: r for r in static.collect()}
    assert (got["10:00"]["current_max_views"], got["10:00"]["current_avg_views"]) == (2.0, 1.75)
    assert got["10:01"]["current_avg_views"] == pytest.approx(5e29) and got["10:02"]["current_avg_views"] == 1e40
    assert got["10:00"]["hist_max_views"] == 1e40 and got["10:00"]["hist_avg_views"] == pytest.approx(5e39)
    root = shared_dir(spark, "test-huge", fresh=True)
    land_as_stream(df, f"{root}/input", 2)
    app = TrendStreams(spark, root, history=hist, window="30 seconds")
    app.start("current_vs_historical_views", parse_messages(replay_stream(spark, f"{root}/input")),
              trigger={"availableNow": True}).awaitTermination()
    assert str(_rows(app.result("current_vs_historical_views"))) == str(_rows(static))


def test_decoding_runs_once_and_below_no_shuffle(spark):
    plan = S.duration_distribution(parse_messages(stream_messages(spark, SF)), W)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json") == 1
    assert "Exchange" not in text[text.index("from_json"):]


def test_history_join_has_no_second_distinct(spark):
    keyed = spark.createDataFrame([("w", "c")], "window_start string, channel_id string")
    root = shared_dir(spark, "test-hist", fresh=True)
    app = TrendStreams(spark, root, history=stream_history(spark, SF, UNTIL))
    channels, small = app._hist_channels()
    text = S.flag_history(keyed, channels, small)._jdf.queryExecution().executedPlan().toString()
    assert small and "BroadcastHashJoin" in text and "Aggregate" not in text
    tight = TrendStreams(spark, root, history=stream_history(spark, SF, UNTIL), max_broadcast_bytes=1)
    channels, small = tight._hist_channels()
    assert not small
    both = [S.flag_history(keyed, channels, b).collect() for b in (True, False)]
    assert both[0] == both[1]


def test_run_with_processing_time_triggers(spark):
    """All five queries start on their triggers; run() returns when one stops."""
    import threading
    import time

    root = shared_dir(spark, "test-run", fresh=True)
    land_as_stream(stream_messages(spark, SF), f"{root}/input", 1)
    app = TrendStreams(spark, root, history=stream_history(spark, SF, UNTIL), window=W, state_partitions=2)
    done = threading.Event()
    spark.streams.resetTerminated()

    def target():
        app.run(parse_messages(replay_stream(spark, f"{root}/input")), {"processingTime": "1 second"})
        done.set()

    worker = threading.Thread(target=target, daemon=True)
    worker.start()
    deadline = time.time() + 90
    while time.time() < deadline and not (len(spark.streams.active) == 5 and all(
            q.lastProgress and q.lastProgress["batchId"] >= 0 and not q.status["isTriggerActive"]
            for q in spark.streams.active)):
        time.sleep(0.5)
    assert len(spark.streams.active) == 5 and not done.is_set()
    for q in spark.streams.active:
        q.processAllAvailable()
        q.stop()
    assert done.wait(30)
    worker.join(5)
    assert _rows(app.result("duration_distribution")) == _rows(_batch(spark, "duration_distribution"))


def test_a_restart_with_a_newer_history_has_one_baseline(spark):
    root = shared_dir(spark, "test-baseline", fresh=True)
    land_as_stream(stream_messages(spark, SF), f"{root}/input", 1)
    for views in (5.0, 7.0):
        hist = spark.createDataFrame([("US", "c", views)], "region_code string, channel_id string, view_count double")
        app = TrendStreams(spark, root, history=hist, window=W)
        app.start("current_vs_historical_views", parse_messages(replay_stream(spark, f"{root}/input")),
                  trigger={"availableNow": True}).awaitTermination()
        found = app.result("current_vs_historical_views").select("hist_max_views", "hist_avg_views").distinct().collect()
        assert [tuple(r) for r in found] == [(views, views)]
        land_as_stream(stream_messages(spark, SF), f"{root}/input", 1)


def test_the_manifest_stays_one_file(spark):
    from trendlens.streaming.sinks import fold_per_key
    root = shared_dir(spark, "test-manifest", fresh=True)
    log = BatchLog(root, merge=fold_per_key(["k"], v=F.max), compact_every=1)
    for i in range(5):
        log(spark.createDataFrame([("a", i)], "k string, v int"), i)
    assert sorted(n for n in os.listdir(root) if "manifest" in n and not n.startswith(".")) == ["manifest.json"]
    assert [tuple(r) for r in log.read(spark).select("k", "v").collect()] == [("a", 4)]
