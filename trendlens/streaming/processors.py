"""S1-S5 as DataFrame -> DataFrame functions over parsed messages.

Each ``*_updates`` function is the stateful streaming part (a windowed or
keyed aggregation that runs in ``update`` mode); each public processor is the
final table, and runs unchanged on a static frame. The stream app feeds the
updates through a keyed sink and reads the same final table back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from trendlens.functions.durations import LONG_EDGE_SECONDS, SHORT_EDGE_SECONDS
from trendlens.functions.metrics import average_of, beyond_exact, cents, half_up_hundredths
from trendlens.operators.joins import overlap_with
from trendlens.operators.windows import windowed_agg
from trendlens.operators.topk import top_k_with_ties
from trendlens.plans.history import hist_channel_ids, views_baseline

DEFAULT_WINDOW = "30 seconds"
DEFAULT_REACH_K = 15


def _window(size: str, time: str = "event_time") -> Column:
    return F.window(time, size).alias("window")


def _labels(*extra) -> list:
    return [F.col("window.start").cast("string").alias("window_start"), *extra]


# S1 ---------------------------------------------------------------------------------------

def duration_distribution(parsed: DataFrame, window: str = DEFAULT_WINDOW) -> DataFrame:
    """Per window: items under 4 min, in [4, 20) min, and 20 min or more."""
    d = F.col("duration_sec")
    return windowed_agg(parsed, "event_time", window, aggs=[
        F.count_if(d < SHORT_EDGE_SECONDS).alias("short_videos_count"),
        F.count_if((d >= SHORT_EDGE_SECONDS) & (d < LONG_EDGE_SECONDS)).alias("medium_videos_count"),
        F.count_if(d >= LONG_EDGE_SECONDS).alias("long_videos_count")])


# S2 ---------------------------------------------------------------------------------------

def channel_reach_updates(parsed: DataFrame, window: str = DEFAULT_WINDOW) -> DataFrame:
    """Per (window, channel): approximate number of distinct regions."""
    return (parsed.groupBy(_window(window), "channel_id", "channel_title")
            .agg(F.approx_count_distinct("region_code").alias("regional_reach"))
            .select("channel_title", "regional_reach", *_labels()))


def merge_channel_reach(updates: DataFrame, k: int = DEFAULT_REACH_K) -> DataFrame:
    """Best reach per channel title over all windows (channels sharing a title
    merge), then the titles ranked within the top ``k``, ties kept."""
    best = updates.groupBy("channel_title").agg(F.max("regional_reach").alias("regional_reach"))
    return top_k_with_ties(best, "regional_reach", k)


def channel_regional_reach(parsed: DataFrame, window: str = DEFAULT_WINDOW,
                           k: int = DEFAULT_REACH_K) -> DataFrame:
    return merge_channel_reach(channel_reach_updates(parsed, window), k)


# S3 ---------------------------------------------------------------------------------------

def first_seen(parsed: DataFrame, key: str = "video_id", time: str = "event_time") -> DataFrame:
    """Earliest event time per key. As a stream this is a keyed aggregation
    whose state is never evicted: "never seen before" is unbounded by nature."""
    return (parsed.where(F.col(key).isNotNull())
            .groupBy(key).agg(F.min(time).alias("first_seen")))


def first_arrival(parsed: DataFrame, key: str = "video_id", time: str = "event_time") -> DataFrame:
    """The first message per key in arrival order (streaming deduplication,
    state kept for every key ever seen). Each key leaves the operator exactly
    once, so a sink logs O(distinct keys); equals ``first_seen`` when the
    input arrives in event-time order."""
    return (parsed.where(F.col(key).isNotNull()).dropDuplicates([key])
            .select(key, F.col(time).alias("first_seen")))


def fresh_counts(seen: DataFrame, window: str = DEFAULT_WINDOW) -> DataFrame:
    """Number of keys whose first sighting falls in each window."""
    return (seen.groupBy(_window(window, "first_seen"))
            .agg(F.count("*").alias("fresh_count"))
            .select("fresh_count", *_labels()))


def trending_freshness(parsed: DataFrame, window: str = DEFAULT_WINDOW) -> DataFrame:
    return fresh_counts(first_seen(parsed), window)


# S4 ---------------------------------------------------------------------------------------

def window_channel_updates(parsed: DataFrame, window: str = DEFAULT_WINDOW) -> DataFrame:
    """Distinct (window, channel) keys, carried by a max-views aggregate."""
    return (parsed.groupBy(_window(window), "channel_id")
            .agg(F.max("view_count").alias("view_count"))
            .select("channel_id", *_labels()))


def flag_history(keyed: DataFrame, hist_channels: DataFrame, broadcast: bool = False) -> DataFrame:
    """Left join of (window, channel) keys to the distinct history channels.
    ``broadcast`` must come from a size check of ``hist_channels``."""
    return overlap_with(keyed, "channel_id", hist_channels, flag="in_hist", broadcast=broadcast, unique=True)


def overlap_summary(flagged: DataFrame) -> DataFrame:
    """Per window: channels, channels present in history, new channels, and
    the overlap percentage (two decimals, half-up)."""
    total, hist = F.col("total_channels"), F.col("hist_overlap")
    return (flagged.groupBy("window_start").agg(
        F.count("*").alias("total_channels"),
        F.count("in_hist").alias("hist_overlap"))
        .select("window_start", total, hist,
                (total - hist).alias("new_channels"),
                half_up_hundredths(hist * 10000, total).alias("overlap_pct")))


def historical_overlap(parsed: DataFrame, hist: DataFrame, window: str = DEFAULT_WINDOW) -> DataFrame:
    """The join carries no hint: in a batch, adaptive execution broadcasts the
    history's channels when they prove small."""
    return overlap_summary(flag_history(window_channel_updates(parsed, window), hist_channel_ids(hist)))


# S5 ---------------------------------------------------------------------------------------

def window_view_updates(parsed: DataFrame, window: str = DEFAULT_WINDOW) -> DataFrame:
    """Per window: max views, and the exact pieces of the average."""
    v = F.col("view_count")
    return windowed_agg(parsed, "event_time", window, aggs=[
        F.max(v).alias("current_max_views"),
        F.sum(cents(v)).alias("sum_cents"),
        F.sum(beyond_exact(v)).alias("sum_beyond"),
        F.count(v).alias("n_views")]).drop("window_end")


def finish_window_views(updates: DataFrame, hist_max: Column, hist_avg: Column) -> DataFrame:
    return updates.select(
        "window_start", "current_max_views",
        average_of(F.col("sum_cents"), F.col("sum_beyond"), F.col("n_views")).alias("current_avg_views"),
        hist_max.cast("double").alias("hist_max_views"),
        hist_avg.cast("double").alias("hist_avg_views"))


def current_vs_historical_views(parsed: DataFrame, hist: DataFrame,
                                window: str = DEFAULT_WINDOW) -> DataFrame:
    """Per window: max and average views next to the history's max and
    average. The one-row baseline enters as a scalar subquery, not a join."""
    base = views_baseline(hist).select(F.struct("hist_max_views", "hist_avg_views").alias("b")).scalar()
    return finish_window_views(window_view_updates(parsed, window),
                               base.getField("hist_max_views"), base.getField("hist_avg_views"))


# Sessions ----------------------------------------------------------------------------------

def item_sessions(parsed: DataFrame, gap: str, key: str = "video_id", time: str = "event_time") -> DataFrame:
    """Per item its sessions: messages of which each follows the one before within
    ``gap``. As a stream (append mode) a session is emitted once the watermark has
    passed its last message by the gap; late messages may join two sessions until
    then. Messages without a key or a time take no part."""
    known = parsed.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    sessions = known.groupBy(key, F.session_window(time, gap).alias("session")).agg(
        F.count("*").alias("n_messages"), F.min(time).alias("first_at"), F.max(time).alias("last_at"),
        F.max("view_count").alias("max_views"))
    return sessions.select(key, "first_at", "last_at", "n_messages", "max_views")


# Mergeable distinct counts -----------------------------------------------------------------

REACH_LG_K = 12  # 4,096 buckets: a standard error of 1.6 %, and exact for small counts


def reach_sketch_updates(parsed: DataFrame, window: str = DEFAULT_WINDOW, lg_k: int = REACH_LG_K) -> DataFrame:
    """Per (window, channel) a sketch of the distinct regions, as stored bytes."""
    return (parsed.groupBy(_window(window), "channel_id", "channel_title")
            .agg(F.hll_sketch_agg("region_code", lg_k).alias("regions"))
            .select("channel_id", "channel_title", "regions", *_labels()))


def reach_over(sketches: DataFrame, *by) -> DataFrame:
    """Distinct regions per channel title and ``by`` over any span of windows, from
    stored sketches alone: their union counts a region once however many windows hold
    it, which sums or maxima of counts cannot. Rows are merged map-side first."""
    merged = sketches.groupBy(*by, "channel_title").agg(F.hll_union_agg("regions").alias("regions"))
    return merged.withColumn("regional_reach", F.hll_sketch_estimate("regions")).drop("regions")
