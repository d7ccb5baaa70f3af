"""S6/S7 and the history baseline: static summaries of the stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from trendlens.functions.metrics import avg_hundredths


def hist_region_stats(hist: DataFrame) -> DataFrame:
    """Per region average and sample standard deviation of views."""
    return hist.groupBy("region_code").agg(
        F.avg("view_count").alias("hist_avg_views"),
        F.stddev("view_count").alias("hist_stddev_views"))


def hist_channel_ids(hist: DataFrame) -> DataFrame:
    """Distinct channel ids of the history."""
    return hist.select("channel_id").distinct()


def views_baseline(hist: DataFrame) -> DataFrame:
    """One row: maximum views and average views (two decimals, half-up).
    Empty history gives one row of NULLs (Q-6)."""
    return hist.agg(F.max(F.col("view_count").cast("double")).alias("hist_max_views"),
                    avg_hundredths("view_count").alias("hist_avg_views"))
