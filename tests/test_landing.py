"""Messages judged and landed once: the side table of rejected ones, the guard of
the watermark, redelivered messages, and a crash between landing and commit."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from trendlens.session import shared_dir
from trendlens.sources import ENVELOPE_SCHEMA, land_as_stream, replay_stream, stream_history, stream_messages
from trendlens.streaming import NAMES, TrendStreams, first_seen_state, keyed_state, parse_messages
from trendlens.streaming import landing as L
from trendlens.streaming import processors as S

SF = "/root/testdata/sf0.001"
W = "1 hour"
UNTIL = "2024-01-01 06:00:00"
NOW = {"availableNow": True}
AT = dt.datetime(2026, 1, 1, 10, 0, 0)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def message(stamp, sent=AT, **more):
    return (b"k", json.dumps({"collected_at": stamp, "video_id": "v", "duration": "PT10S", **more}).encode(), sent)


def test_verdicts(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    cases = [
        (message("2026-01-01 10:00:00"), "accepted"), (message("nonsense"), "accepted"), (message(None), "accepted"),
        (message("2026-01-01 10:05:00"), "accepted"), (message("2026-01-01 10:05:01"), "future"),
        (message("9999-12-31 23:59:59"), "future"), (message("2025-12-31 10:00:00"), "accepted"),
        (message("2025-12-31 09:59:59"), "late"), (message("2026-01-01 10:00:00", None), "untimed"),
        (message(None, None), "untimed"), (message("2026-01-01 10:00:00", view_count="7"), "accepted"),
        ((b"k", b"{broken", AT), "malformed"), ((b"k", None, AT), "malformed"), ((None, b"", AT), "malformed"),
        ((None, b"[1, 2]", None), "malformed"), ((b"k", b'"text"', AT), "malformed"), ((b"k", b"{}", AT), "accepted"),
        ((b"k", b"\xff\xfe", AT), "malformed"),
    ]
    df = spark.createDataFrame([c for c, _ in cases], ENVELOPE_SCHEMA).coalesce(1)
    got = L.judge_messages(df).collect()
    assert [r.verdict for r in got] == [v for _, v in cases]
    assert all((r.value is None) == (r.verdict == "accepted" or c[1] is None) for r, (c, _) in zip(got, cases))
    assert L.judge_messages(df.limit(0)).collect() == []


def test_every_question_streams_from_one_decoding(spark):
    """The five results from the landed table equal the batch results; the landing
    plan decodes once and the questions' plans do not."""
    root = shared_dir(spark, "test-landing-five", fresh=True)
    envelope = stream_messages(spark, SF)
    files = land_as_stream(envelope, f"{root}/input", 3)
    L.land_messages(replay_stream(spark, f"{root}/input", files_per_trigger=files), root, NOW).awaitTermination()
    assert L.rejected_messages(spark, root).count() == 0
    plan = L.judge_messages(envelope)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    hist = stream_history(spark, SF, UNTIL)
    msgs = parse_messages(envelope)
    want = {
        "duration_distribution": S.duration_distribution(msgs, W), "channel_regional_reach": S.channel_regional_reach(msgs, W),
        "trending_freshness": S.trending_freshness(msgs, W), "historical_overlap": S.historical_overlap(msgs, hist, W),
        "current_vs_historical_views": S.current_vs_historical_views(msgs, hist, W)}
    app = TrendStreams(spark, root, history=hist, window=W, state_partitions=4)
    for name in NAMES:
        landed = L.landed_messages(spark, root)
        assert "from_json" not in landed._jdf.queryExecution().analyzed().toString()
        app.start(name, landed, NOW).awaitTermination()
        assert rows(app.result(name)) == rows(want[name]), name


def drop_last_commit(folder):
    last = max(int(f) for f in os.listdir(folder) if f.isdigit())
    for f in (f"{folder}/{last}", f"{folder}/.{last}.crc"):
        if os.path.exists(f):
            os.remove(f)


def test_crash_between_landing_and_commit(spark):
    root = shared_dir(spark, "test-landing-crash", fresh=True)
    files = land_as_stream(stream_messages(spark, SF), f"{root}/input", 3)
    for _ in range(3):
        L.land_messages(replay_stream(spark, f"{root}/input", files_per_trigger=files), root, NOW).awaitTermination()
        drop_last_commit(f"{root}/checkpoints/messages/commits")
    app = TrendStreams(spark, root, window=W, state_partitions=4)
    app.start("duration_distribution", L.landed_messages(spark, root), NOW).awaitTermination()
    want = rows(S.duration_distribution(parse_messages(stream_messages(spark, SF)), W))
    assert rows(app.result("duration_distribution")) == want


def test_a_message_of_the_year_9999_changes_no_window(spark):
    root = shared_dir(spark, "test-landing-9999", fresh=True)
    good = [[message(f"2026-01-01 10:0{m}:05", AT + dt.timedelta(minutes=m)) for _ in range(m + 1)] for m in range(4)]
    bad = [message("9999-12-31 23:59:59"), (b"k", b"{", AT), message("2020-01-01 00:00:00")]
    for k, batch in enumerate(good):
        spark.createDataFrame(batch + (bad if k == 1 else []), ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(
            f"{root}/input")
    L.land_messages(replay_stream(spark, f"{root}/input"), root, NOW).awaitTermination()
    app = TrendStreams(spark, root, window="30 seconds", state_partitions=2)
    app.start("duration_distribution", L.landed_messages(spark, root, files_per_trigger=1), NOW).awaitTermination()
    got = {r.window_start[14:16]: r.short_videos_count for r in app.result("duration_distribution").collect()}
    assert got == {"00": 1, "01": 2, "02": 3, "03": 4}
    rejected = L.rejected_messages(spark, root)
    assert sorted(r.reason for r in rejected.collect()) == ["future", "late", "malformed"]
    assert {bytes(r.value) for r in rejected.collect()} == {v for _, v, _ in bad}
    # rows in = rows used + rows rejected
    assert sum(got.values()) + rejected.count() == sum(map(len, good)) + len(bad)


def test_redelivered_messages_count_once(spark):
    """Every message twice, the second time later: windows as if once, and the
    ids do not stay in the state."""
    root = shared_dir(spark, "test-landing-twice", fresh=True)
    once = stream_messages(spark, SF)
    again = once.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 20 SECONDS"))
    files = land_as_stream(once.union(again).union(once), f"{root}/input", 4)
    L.land_messages(replay_stream(spark, f"{root}/input", files_per_trigger=files), root, NOW).awaitTermination()
    n_files = len([f for f in os.listdir(f"{root}/messages/verdict=accepted") if f.endswith(".parquet")])
    app = TrendStreams(spark, root, window=W, state_partitions=2)
    landed = L.landed_messages(spark, root, files_per_trigger=-(-n_files // 4))
    query = app.start("duration_distribution", L.each_once(landed), NOW)
    query.awaitTermination()
    want = S.duration_distribution(parse_messages(once), W)
    assert rows(app.result("duration_distribution")) == rows(want)
    kept = [s["numRowsTotal"] for p in query.recentProgress[-1:] for s in p["stateOperators"]
            if "dedupe" in s["operatorName"].lower()]
    assert len(kept) == 1 and kept[0] < once.count() / 10
    assert L.each_once(L.judge_messages(once.union(again))).count() == once.count()


def test_state_is_read_back_at_any_batch(spark):
    """The first sightings in the state equal the published ones, and after an earlier
    batch those of the messages until then."""
    root = shared_dir(spark, "test-state", fresh=True)
    batches = [[message("2026-01-01 10:00:05", video_id="a"), message("2026-01-01 10:00:01", video_id="b")],
               [message("2026-01-01 10:00:03", video_id="a"), message("2026-01-01 10:00:09", video_id="c")]]
    for some in batches:
        spark.createDataFrame(some, ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/input")
    app = TrendStreams(spark, root, window="30 seconds", state_partitions=2)
    app.start("trending_freshness", parse_messages(replay_stream(spark, f"{root}/input")), NOW).awaitTermination()
    checkpoint = f"{root}/checkpoints/trending_freshness"
    seen = lambda df: {r.video_id: (r.first_seen - AT).seconds for r in df.collect()}
    assert seen(first_seen_state(spark, checkpoint, 0)) == {"a": 5, "b": 1}
    assert seen(first_seen_state(spark, checkpoint)) == {"a": 3, "b": 1, "c": 9}
    logged = app.log("trending_freshness").read(spark).groupBy("video_id").agg(F.min("first_seen").alias("first_seen"))
    assert seen(first_seen_state(spark, checkpoint)) == seen(logged)
    assert set(keyed_state(spark, checkpoint).columns) > {"video_id"}
