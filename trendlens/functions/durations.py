"""ISO-8601 durations to seconds, and duration buckets (Q-4)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from trendlens.functions._cols import as_col

# The patterns the reference extracts each unit with.
# Preparation anchors every unit on the "PT" prefix, so "P1DT2H3M" gives 0 there.
PREPARED_HOURS = r"PT(\d+)H"
PREPARED_MINUTES = r"PT(?:\d+H)?(\d+)M"
PREPARED_SECONDS = r"PT(?:\d+H)?(?:\d+M)?(\d+)S"
# The stream side searches each unit anywhere, so "P1DT2H3M" gives 7380 there.
STREAM_HOURS = r"(\d+)H"
STREAM_MINUTES = r"(\d+)M"
STREAM_SECONDS = r"(\d+)S"


def _unit(text: Column, pattern: str, kind: str) -> Column:
    # regexp_extract yields '' when nothing matches. That becomes NULL before
    # the cast: a failing cast costs a JVM exception per row even inside
    # try_cast. try_cast still guards digit runs too long for ``kind``.
    digits = F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    return F.coalesce(digits.try_cast(kind), F.lit(0)).cast("bigint")


def _seconds(text, h: str, m: str, s: str, kind: str) -> Column:
    """NULL if the sum is too large for a BIGINT."""
    t = as_col(text)
    hours, minutes = F.try_multiply(_unit(t, h, kind), F.lit(3600)), F.try_multiply(_unit(t, m, kind), F.lit(60))
    return F.try_add(F.try_add(hours, minutes), _unit(t, s, kind))


def prepared_duration_seconds(text) -> Column:
    """Seconds as INT; absent units count 0, NULL/unparsable text gives 0. A
    unit too long for an INT counts 0 by itself."""
    return F.coalesce(_seconds(text, PREPARED_HOURS, PREPARED_MINUTES, PREPARED_SECONDS, "int")
                      .try_cast("int"), F.lit(0))


def stream_duration_seconds(text) -> Column:
    """Seconds as BIGINT with unanchored unit patterns. A unit too long for a
    BIGINT counts 0 by itself; a total too large for one gives 0."""
    return F.coalesce(_seconds(text, STREAM_HOURS, STREAM_MINUTES, STREAM_SECONDS, "bigint"), F.lit(0).cast("bigint"))


# The reference's bucket labels and edges (seconds).
PREPARED_BUCKET_LABELS = ("short (< 4 min)", "medium (4-20 min)", "long (> 20 min)")
SHORT_EDGE_SECONDS = 240
LONG_EDGE_SECONDS = 1200


def prepared_duration_bucket(seconds) -> Column:
    """Batch buckets: < 240 short, 240..1200 inclusive medium, > 1200 long."""
    v = as_col(seconds)
    return (F.when(v < SHORT_EDGE_SECONDS, F.lit(PREPARED_BUCKET_LABELS[0]))
            .when(v <= LONG_EDGE_SECONDS, F.lit(PREPARED_BUCKET_LABELS[1]))
            .otherwise(F.lit(PREPARED_BUCKET_LABELS[2])))
