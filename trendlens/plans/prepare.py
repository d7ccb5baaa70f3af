"""Raw observations -> typed, cleaned observation table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from trendlens.functions.categories import category_name
from trendlens.functions.durations import prepared_duration_seconds
from trendlens.functions.metrics import engagement_rate
from trendlens.functions.naming import snake_case_columns

# Fixed value: observations above this many views are treated as outliers.
MAX_REALISTIC_VIEWS = 25_000_000_000

OBSERVATION_COLUMNS = (
    "region_code", "video_id", "title", "published_at", "channel_id", "channel_title",
    "category_id", "category_name", "trending_date", "tags", "view_count", "likes",
    "dislikes", "comment_count", "duration_seconds", "engagement",
)


def _whole(df: DataFrame, name: str, kind: str) -> Column:
    """A whole number. Text may write it as a decimal (``100.0``, ``1e5``), which
    is truncated; text that is no number, or out of range, gives NULL."""
    c = F.col(name)
    if not isinstance(df.schema[name].dataType, StringType):
        return c.try_cast(kind).alias(name)
    return F.coalesce(c.try_cast(kind), c.try_cast("double").try_cast(kind)).alias(name)


def select_typed(df: DataFrame) -> DataFrame:
    """Keep the input columns the table needs, each as its type.

    Every conversion is a ``try_cast``, so a bad value becomes NULL instead of
    failing the job under ANSI mode; extra columns are dropped.
    """
    return df.select(
        F.col("region_code").cast("string").alias("region_code"),
        F.col("video_id").cast("string").alias("video_id"),
        F.col("title").cast("string").alias("title"),
        F.col("published_at").try_cast("timestamp").alias("published_at"),
        F.col("channel_id").cast("string").alias("channel_id"),
        F.col("channel_title").cast("string").alias("channel_title"),
        _whole(df, "category_id", "int"),
        F.col("trending_date").try_cast("date").alias("trending_date"),
        F.col("tags").cast("string").alias("tags"),
        *[_whole(df, c, "bigint") for c in ("view_count", "likes", "dislikes", "comment_count")],
        F.col("duration").cast("string").alias("duration"),
    )


def drop_outliers(df: DataFrame, max_views: int = MAX_REALISTIC_VIEWS) -> DataFrame:
    """P5: keep rows with at most ``max_views`` views; NULL views drop too."""
    return df.where(F.col("view_count") <= F.lit(max_views))


def add_derived(df: DataFrame, category_names: dict[int, str] | None = None) -> DataFrame:
    """Category name, duration in seconds (replacing the text) and
    engagement rate, in the observation column order."""
    return df.select(
        *[c for c in df.columns if c != "duration"],
        category_name("category_id", category_names).alias("category_name"),
        prepared_duration_seconds("duration").alias("duration_seconds"),
        engagement_rate("view_count", "likes", "comment_count").alias("engagement"),
    ).select(*OBSERVATION_COLUMNS)


def prepare(raw: DataFrame, category_names: dict[int, str] | None = None,
            max_views: int = MAX_REALISTIC_VIEWS) -> DataFrame:
    """Normalise names, type every column, drop outliers, derive
    ``category_name``, ``duration_seconds`` and ``engagement``.

    Works on all-text input (a CSV read without inference) and on typed input
    alike. Rows with NULL or more than ``max_views`` views are dropped.
    """
    typed = select_typed(snake_case_columns(raw))
    return add_derived(drop_outliers(typed, max_views), category_names)
