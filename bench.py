"""Benchmark: prepare the observation table once, then time every question.

Mirrors the reference's flow (a preparation job writes Parquet; each
analytical job reads it): ``prepare`` maps the driver tables to raw
observations, prepares and writes them partitioned by region; the batch
questions read that table; the stream questions run their processors over the
parsed event envelopes (static form) and, for ``streams_replay``, as a real
file stream of all five queries at once.

Prints one JSON line. Each query time is the median of ``BENCH_REPEAT`` warm
runs (default 3), measured as a full execution into the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from trendlens.plans import analytics as A
from trendlens.plans import history as H
from trendlens.session import build_session, pin_utc, shared_dir
from trendlens.sources import (
    land_as_stream,
    raw_observations,
    read_observations,
    replay_stream,
    stream_history,
    stream_messages,
    write_observations,
)
from trendlens.plans.prepare import prepare
from trendlens.streaming import NAMES, TrendStreams, parse_messages
from trendlens.streaming import processors as S

REGION = "ASIA"
WINDOW = "1 hour"
HISTORY_UNTIL = "2024-01-01 06:00:00"
# The reference runs its streaming session with 4 shuffle (= state) partitions.
STREAM_STATE_PARTITIONS = 4


def _timed(fn, repeat):
    runs = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        runs.append(time.perf_counter() - t0)
    return statistics.median(runs)


def _run(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(f"local[{cpus}]", "trendlens-bench", shuffle_partitions=2 * cpus,
                          **{"spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    pin_utc(spark)
    root = shared_dir(spark, "bench", fresh=True)
    times: dict[str, float] = {}

    obs_path = f"{root}/observations"
    write_observations(prepare(raw_observations(spark, sf_dir)), f"{root}/warmup")
    times["prepare"] = _timed(
        lambda: write_observations(prepare(raw_observations(spark, sf_dir)), obs_path), 1)
    obs = read_observations(spark, obs_path)

    batch = {
        "popularity_over_time": lambda: A.popularity_over_time(obs),
        "top_categories": lambda: A.top_categories(obs),
        "top_engagement": lambda: A.top_engagement(obs),
        "view_count_change_per_day": lambda: A.view_count_change_per_day(obs, region=REGION),
        "fastest_growth_videos": lambda: A.fastest_growth_videos(obs),
        "engagement_by_region": lambda: A.engagement_by_region(obs),
        "regional_engagement": lambda: A.regional_engagement(obs),
        "top_tags": lambda: A.top_tags(obs),
        "top_tag_combinations": lambda: A.top_tag_combinations(obs, region=REGION),
        "avg_comments_per_category": lambda: A.avg_comments_per_category(obs),
        "trending_by_day_of_week": lambda: A.trending_by_day_of_week(obs),
        "duration_vs_popularity": lambda: A.duration_vs_popularity(obs),
        "hist_region_stats": lambda: H.hist_region_stats(obs),
        "hist_channel_ids": lambda: H.hist_channel_ids(obs),
    }
    # The envelopes are landed once; the stream questions decode them.
    envelopes = f"{root}/envelopes"
    stream_messages(spark, sf_dir, partitions=cpus).write.parquet(envelopes)
    msgs = parse_messages(spark.read.parquet(envelopes))
    hist = stream_history(spark, sf_dir, HISTORY_UNTIL)
    streams = {
        "duration_distribution": lambda: S.duration_distribution(msgs, WINDOW),
        "channel_regional_reach": lambda: S.channel_regional_reach(msgs, WINDOW),
        "trending_freshness": lambda: S.trending_freshness(msgs, WINDOW),
        "historical_overlap": lambda: S.historical_overlap(msgs, hist, WINDOW),
        "current_vs_historical_views": lambda: S.current_vs_historical_views(msgs, hist, WINDOW),
    }
    for name, build in {**batch, **streams}.items():
        _run(build())  # warm-up
        times[name] = _timed(lambda: _run(build()), repeat)

    # All five queries as real streams over the events landed as 8 files
    # (8 micro-batches each, running concurrently), then their final tables.
    run_root = shared_dir(spark, "bench-replay", fresh=True)
    files = land_as_stream(spark.read.parquet(envelopes), f"{run_root}/input", 8)

    def replay():
        app = TrendStreams(spark, shared_dir(spark, "bench-replay-run", fresh=True), history=hist,
                           window=WINDOW, state_partitions=STREAM_STATE_PARTITIONS)
        parsed = parse_messages(replay_stream(spark, f"{run_root}/input", files_per_trigger=files))
        for q in app.start_all(parsed, trigger={"availableNow": True}):
            q.awaitTermination()
        for name in NAMES:
            _run(app.result(name))
    times["streams_replay"] = _timed(replay, 1)

    total = sum(times.values())
    print(json.dumps({
        "metric": "total_time_prepare_plus_all_queries",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
