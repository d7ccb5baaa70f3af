"""The batch questions over the observation table.

Every function takes the observation DataFrame and returns a DataFrame; no
action runs inside. Each top-k breaks ties on its group key ascending so the
result is deterministic. Fixed values: the names of the result columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from trendlens.functions.durations import prepared_duration_bucket
from trendlens.operators.series import moving_average, one_per_period, period_delta
from trendlens.operators.tags import explode_tags, keep_pairable_tags, sorted_pairs, tag_pairs
from trendlens.operators.topk import top_k

DEFAULT_REGION = "US"
# Fixed value: day-over-day growth above this is treated as a data error.
MAX_DAILY_GROWTH = 200_000_000


def popularity_over_time(obs: DataFrame, window_rows: int = 7) -> DataFrame:
    """A1: per trending day average/total views (NULL if too large for a BIGINT)
    and row count, plus the average of the daily averages over the last
    ``window_rows`` days present."""
    daily = obs.groupBy("trending_date").agg(
        F.avg("view_count").alias("average_views"),
        F.try_sum("view_count").alias("total_views"),
        F.count("video_id").alias("video_count"),
    )
    return moving_average(daily, "average_views", "trending_date", window_rows,
                          name="moving_avg_7d").orderBy("trending_date")


def top_categories(obs: DataFrame, k: int = 10) -> DataFrame:
    """A2: the ``k`` categories with most rows."""
    counts = obs.groupBy("category_id", "category_name").agg(F.count("*").alias("number_of_videos"))
    return top_k(counts, "number_of_videos", k, ["category_id", "category_name"])


def top_engagement(obs: DataFrame, k: int = 20) -> DataFrame:
    """A3: the ``k`` channels with the highest single engagement."""
    peaks = obs.groupBy("channel_id", "channel_title").agg(F.max("engagement").alias("peak_engagement"))
    return top_k(peaks, "peak_engagement", k, ["channel_id", "channel_title"])


def view_count_change_per_day(obs: DataFrame, region: str = DEFAULT_REGION, k: int = 10) -> DataFrame:
    """A4: for the ``k`` items with most rows in ``region``, each day's views,
    the previous observed day's views and the difference.

    The top-k list has at most ``k`` rows, so it is broadcast into a semi join
    (a retitled item cannot duplicate rows, Q-3). Rows are reduced to one per
    (item, day) before ``lag`` (Q-14), which also bounds every window
    partition by the number of days.
    """
    r = obs.where(F.col("region_code") == region)
    most = top_k(r.groupBy("video_id", "title").agg(F.count("*").alias("trending_days")),
                 "trending_days", k, ["video_id", "title"])
    chosen = r.join(F.broadcast(most.select("video_id")), "video_id", "left_semi")
    daily = one_per_period(chosen.withColumnRenamed("trending_date", "date"),
                           "video_id", "date", "view_count", carry=["title"])
    return (period_delta(daily, "video_id", "date", "view_count",
                         prev_value="previous_day_views", delta="views_difference")
            .select("video_id", "title", "date", "view_count", "previous_day_views",
                    "views_difference")
            .orderBy("video_id", "date"))


def fastest_growth_videos(obs: DataFrame, k: int = 20, max_growth: int = MAX_DAILY_GROWTH) -> DataFrame:
    """A5: largest growth between two consecutive calendar days of the same
    (item, region), within [0, ``max_growth``], per (item, title); top ``k``.

    Only the ``k`` items of the largest growth (of equal ones the first by id) can have
    a group in the top: each other group comes after one group of each of these. So
    all rows are reduced on numbers alone (a hash aggregation), and titles are read for
    those ``k`` items only, which are broadcast."""
    keys = ["video_id", "region_code"]

    def growth(rows: DataFrame, carry=()) -> DataFrame:
        daily = one_per_period(rows, keys, "trending_date", "view_count", carry=carry)
        return period_delta(daily, keys, "trending_date", "view_count", prev_value="prev_views",
                            delta="daily_views_growth", gap_days=1, bounds=(0, max_growth))

    def peaks(rows: DataFrame, *by: str) -> DataFrame:
        return rows.groupBy(*by).agg(F.max("daily_views_growth").alias("max_daily_views_growth"))

    items = top_k(peaks(growth(obs), "video_id"), "max_daily_views_growth", k, ["video_id"]).select("video_id").alias("i")
    chosen = obs.alias("o").join(F.broadcast(items), F.col("o.video_id").eqNullSafe(F.col("i.video_id")), "left_semi")
    best = peaks(growth(chosen, carry=["title"]), "video_id", "title")
    return top_k(best, "max_daily_views_growth", k, ["video_id", "title"])


def engagement_by_region(obs: DataFrame) -> DataFrame:
    """Average engagement, likes, comments and views per region."""
    return (obs.groupBy("region_code").agg(
        F.avg("engagement").alias("average_engagement"),
        F.avg("likes").alias("average_likes"),
        F.avg("comment_count").alias("average_comments"),
        F.avg("view_count").alias("average_views"),
    ).orderBy(F.col("average_engagement").desc_nulls_last(), "region_code"))


def regional_engagement(obs: DataFrame, k: int = 20) -> DataFrame:
    """Average engagement per region, top ``k``."""
    avg = obs.groupBy("region_code").agg(F.avg("engagement").alias("average_engagement"))
    return top_k(avg, "average_engagement", k, ["region_code"])


def top_tags(obs: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` most frequent tags (one count per row carrying the tag)."""
    counts = explode_tags(obs.select("tags")).groupBy("tag").agg(F.count("*").alias("number_of_videos"))
    return top_k(counts, "number_of_videos", k, ["tag"])


def top_tag_combinations(obs: DataFrame, region: str = DEFAULT_REGION, min_videos: int = 20,
                         k: int = 20, distinct_tags: bool = False, prune: bool = True) -> DataFrame:
    """Per tag pair of the items of ``region``, the average number of
    distinct trending days of the items carrying it; pairs on at least
    ``min_videos`` items, top ``k`` by that average.

    One tag text per item (the smallest, so the survivor is deterministic);
    pairs come from that item's sorted tag array, single-tag items give none
    (Q-1), rows without an item id take no part, duplicated tags give repeated pairs unless ``distinct_tags`` (Q-15).
    With ``prune`` tags that cannot reach ``min_videos`` in any pair are
    dropped before pairing (exact, see ``keep_pairable_tags``).
    """
    r = obs.where((F.col("region_code") == region) & F.col("video_id").isNotNull())
    items = r.groupBy("video_id").agg(
        F.countDistinct("trending_date").alias("trending_days"),
        F.min("tags").alias("tags"))
    if prune:
        kept = keep_pairable_tags(items, "video_id", "tags", min_videos, distinct_tags=distinct_tags)
        pairs = kept.withColumn("tag_pair", F.explode(sorted_pairs("tag_list")))
    else:
        pairs = tag_pairs(items, "tags", distinct_tags=distinct_tags)
    stats = (pairs.groupBy("tag_pair").agg(
        F.avg("trending_days").alias("average_trending_days"),
        F.count("*").alias("video_count"))
        .where(F.col("video_count") >= min_videos))
    return top_k(stats, "average_trending_days", k, ["tag_pair"])


def avg_comments_per_category(obs: DataFrame, k: int = 20) -> DataFrame:
    """A10: average comment count per category, top ``k``."""
    avg = obs.groupBy("category_id", "category_name").agg(F.avg("comment_count").alias("average_comments"))
    return top_k(avg, "average_comments", k, ["category_id", "category_name"])


def trending_by_day_of_week(obs: DataFrame) -> DataFrame:
    """Per weekday (1 = Sunday ... 7 = Saturday) row count and averages."""
    return (obs.groupBy(F.dayofweek("trending_date").alias("day_of_week")).agg(
        F.count("video_id").alias("video_count"),
        F.avg("view_count").alias("average_views"),
        F.avg("likes").alias("average_likes"),
        F.avg("dislikes").alias("average_dislikes"),
        F.avg("comment_count").alias("average_comments"),
        F.avg("engagement").alias("average_engagement"),
    ).orderBy("day_of_week"))


def duration_vs_popularity(obs: DataFrame) -> DataFrame:
    """Average views per duration bucket (240..1200 s inclusive is medium)."""
    return (obs.groupBy(prepared_duration_bucket("duration_seconds").alias("duration_length"))
            .agg(F.avg("view_count").alias("average_views"))
            .orderBy("duration_length"))
