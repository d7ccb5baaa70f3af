"""Event-time windows shared by the streaming processors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def windowed_agg(df: DataFrame, time: str, size: str, keys: Sequence[str] = (),
                 aggs: Sequence[Column] = (), slide: str | None = None,
                 label: bool = True) -> DataFrame:
    """Aggregate per tumbling (or, with ``slide``, sliding) event-time window
    and ``keys``. With ``label`` the window struct becomes ``window_start`` and
    ``window_end`` strings (session time zone); otherwise ``window`` stays.

    On a stream with a watermark on ``time`` the window state is evicted once
    the watermark passes the window end.
    """
    win = (F.window(time, size, slide) if slide else F.window(time, size)).alias("window")
    out = df.groupBy(win, *keys).agg(*aggs)
    if not label:
        return out
    rest = [c for c in out.columns if c != "window"]
    return out.select(*rest,
                      F.col("window.start").cast("string").alias("window_start"),
                      F.col("window.end").cast("string").alias("window_end"))
