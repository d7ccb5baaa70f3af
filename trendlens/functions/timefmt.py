"""P10: event time from a collection stamp, falling back to the transport time."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from trendlens.functions._cols import as_col

# Fixed value: the stamp layout the reference parses first.
PLAIN_STAMP = "yyyy-MM-dd HH:mm:ss"
_PLAIN_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
_ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}T"


def event_time(stamp, fallback) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` first, then an ISO-8601 instant (with fraction
    and offset, as the producer writes it), then ``fallback`` (the transport
    time). NULL if none gives a time: such a row belongs to no window.

    Each parse only runs on text of its shape: a failed pattern parse costs a
    JVM exception per row, a shape test does not.
    """
    s = as_col(stamp)
    return F.coalesce(
        F.when(s.rlike(_PLAIN_SHAPE), F.try_to_timestamp(s, F.lit(PLAIN_STAMP))),
        F.when(s.rlike(_ISO_SHAPE), s.try_cast("timestamp")),
        as_col(fallback).cast("timestamp"),
    )
