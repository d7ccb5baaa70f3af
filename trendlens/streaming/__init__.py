from trendlens.streaming.app import NAMES, TRIGGERS, TrendStreams
from trendlens.streaming.buckets import BucketedTable
from trendlens.streaming.landing import each_once, judge_messages, land_messages, landed_messages, rejected_messages
from trendlens.streaming.parse import MESSAGE_SCHEMA, parse_messages
from trendlens.streaming.processors import (
    channel_regional_reach,
    current_vs_historical_views,
    duration_distribution,
    first_seen,
    historical_overlap,
    item_sessions,
    reach_over,
    reach_sketch_updates,
    trending_freshness,
)
from trendlens.streaming.sightings import fresh_sightings, fresh_windows
from trendlens.streaming.sinks import BatchLog, PublishedTable, latest_per_key
from trendlens.streaming.state import first_seen_state, keyed_state, state_rows

__all__ = [
    "NAMES", "TRIGGERS", "TrendStreams", "MESSAGE_SCHEMA", "parse_messages",
    "channel_regional_reach", "current_vs_historical_views", "duration_distribution",
    "first_seen", "historical_overlap", "trending_freshness", "BatchLog", "PublishedTable", "latest_per_key",
    "each_once", "judge_messages", "land_messages", "landed_messages", "rejected_messages",
    "fresh_sightings", "fresh_windows", "BucketedTable", "item_sessions", "reach_over", "reach_sketch_updates",
    "first_seen_state", "keyed_state", "state_rows",
]
