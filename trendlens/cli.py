"""Command line: the preparation job, any batch question, the stream app.

  python -m trendlens prepare RAW_CSV OBSERVATIONS_DIR [--files-per-region N] [--single-line]
  python -m trendlens query NAME OBSERVATIONS_DIR RESULT_PATH [--region US] [--format parquet]
  python -m trendlens land --root SHARED_DIR (--kafka SERVERS --topic TOPIC | --files DIR) [--drain]
  python -m trendlens stream --history OBSERVATIONS_DIR --root SHARED_DIR
                             (--kafka SERVERS --topic TOPIC | --files DIR | --landed [--once])
                             [--window "30 seconds"] [--drain]
  python -m trendlens publish NAME --root SHARED_DIR [--window "30 seconds"]

``land`` judges and decodes messages once, into SHARED_DIR/messages; ``stream --landed``
answers from there, with ``--once`` each message once, however often it was delivered.
``stream`` runs until a query stops; with ``--drain`` it takes what has arrived
and ends. ``publish`` replaces the result table ``SHARED_DIR/published/NAME`` by
the current result of a stream question.

Each job runs in the session ``spark-submit`` provides; results replace the
target (Parquet unless ``--format`` names another writer format).
"""

from __future__ import annotations

import argparse
import sys

from trendlens import plans
from trendlens.session import build_session
from trendlens.sources import (
    kafka_source,
    read_observations,
    read_raw_csv,
    replay_stream,
    write_observations,
    write_result,
)
from trendlens.streaming import NAMES, TrendStreams, each_once, land_messages, landed_messages, parse_messages
from trendlens.streaming.processors import DEFAULT_WINDOW

REGIONAL = {"view_count_change_per_day", "top_tag_combinations"}
QUESTIONS = {
    "popularity_over_time": plans.popularity_over_time,
    "top_categories": plans.top_categories,
    "top_engagement": plans.top_engagement,
    "view_count_change_per_day": plans.view_count_change_per_day,
    "fastest_growth_videos": plans.fastest_growth_videos,
    "engagement_by_region": plans.engagement_by_region,
    "regional_engagement": plans.regional_engagement,
    "top_tags": plans.top_tags,
    "top_tag_combinations": plans.top_tag_combinations,
    "avg_comments_per_category": plans.avg_comments_per_category,
    "trending_by_day_of_week": plans.trending_by_day_of_week,
    "duration_vs_popularity": plans.duration_vs_popularity,
    "hist_region_stats": plans.hist_region_stats,
    "hist_channel_ids": plans.hist_channel_ids,
}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="trendlens")
    sub = p.add_subparsers(dest="cmd", required=True)
    pr = sub.add_parser("prepare")
    pr.add_argument("raw")
    pr.add_argument("out")
    pr.add_argument("--files-per-region", type=int, default=None)
    pr.add_argument("--single-line", action="store_true", help="no quoted newlines: large files are split")
    q = sub.add_parser("query")
    q.add_argument("name", choices=sorted(QUESTIONS))
    q.add_argument("observations")
    q.add_argument("out")
    q.add_argument("--region", default="US")
    q.add_argument("--format", default="parquet")
    st = sub.add_parser("stream")
    st.add_argument("--history", default=None)
    st.add_argument("--root", required=True)
    st.add_argument("--kafka", default=None)
    st.add_argument("--topic", default=None)
    st.add_argument("--files", default=None)
    st.add_argument("--window", default=DEFAULT_WINDOW)
    st.add_argument("--state-partitions", type=int, default=None)
    st.add_argument("--drain", action="store_true")
    st.add_argument("--landed", action="store_true")
    st.add_argument("--once", action="store_true")
    ld = sub.add_parser("land")
    ld.add_argument("--root", required=True)
    ld.add_argument("--kafka", default=None)
    ld.add_argument("--topic", default=None)
    ld.add_argument("--files", default=None)
    ld.add_argument("--drain", action="store_true")
    pb = sub.add_parser("publish")
    pb.add_argument("name", choices=NAMES)
    pb.add_argument("--root", required=True)
    pb.add_argument("--window", default=DEFAULT_WINDOW)
    return p


def _source(spark, args):
    if args.kafka:
        return kafka_source(spark, args.kafka, args.topic)
    if args.files:
        return replay_stream(spark, args.files)
    raise SystemExit(f"{args.cmd} needs --kafka/--topic or --files")


def main(argv: list[str] | None = None, spark=None) -> None:
    args = _parser().parse_args(argv)
    spark = spark or build_session(app_name=f"trendlens-{args.cmd}")
    if args.cmd == "prepare":
        obs = plans.prepare(read_raw_csv(spark, args.raw, multi_line=not args.single_line))
        write_observations(obs, args.out, files_per_partition=args.files_per_region)
    elif args.cmd == "query":
        obs = read_observations(spark, args.observations)
        kw = {"region": args.region} if args.name in REGIONAL else {}
        write_result(QUESTIONS[args.name](obs, **kw), args.out, fmt=args.format)
    elif args.cmd == "publish":
        TrendStreams(spark, args.root, window=args.window).publish(args.name)
    elif args.cmd == "land":
        land_messages(_source(spark, args), args.root, {"availableNow": True} if args.drain else None).awaitTermination()
    else:
        if args.landed:
            parsed = landed_messages(spark, args.root)
            parsed = each_once(parsed) if args.once else parsed
        else:
            parsed = parse_messages(_source(spark, args))
        history = read_observations(spark, args.history) if args.history else None
        app = TrendStreams(spark, args.root, history=history, window=args.window,
                           state_partitions=args.state_partitions)
        app.run(parsed, {"availableNow": True} if args.drain else None, drain=args.drain)


if __name__ == "__main__":
    main(sys.argv[1:])
