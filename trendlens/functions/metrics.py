"""P7 engagement and exact two-decimal rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from trendlens.functions._cols import as_col


def engagement_rate(views="view_count", likes="likes", comments="comment_count") -> Column:
    """``(likes + comments) / views`` when views > 0, else 0.0.

    A NULL likes or comments count gives NULL, as do counts whose sum is too
    large for their type; dislikes play no part.
    """
    v = as_col(views)
    return F.when(v > 0, F.try_add(as_col(likes), as_col(comments)) / v).otherwise(F.lit(0.0))


# Up to this size values are summed exactly, in hundredths; beyond it (and for
# NaN) as doubles, as a plain average does.
EXACT_LIMIT = 1e15


def is_exact(value) -> Column:
    """TRUE for a value that ``cents`` represents; NULL for NULL."""
    return F.abs(as_col(value).cast("double")) <= EXACT_LIMIT


def cents(value) -> Column:
    """A money-like double in integer hundredths, as an overflow-free decimal;
    NULL for values beyond ``EXACT_LIMIT``."""
    v = as_col(value).cast("double")
    return F.when(is_exact(v), F.round(v * 100).try_cast("decimal(38,0)"))


def beyond_exact(value) -> Column:
    """The value, if ``cents`` cannot represent it, else NULL."""
    v = as_col(value).cast("double")
    return F.when(~is_exact(v), v)


def average_of(total_cents: Column, beyond: Column, n: Column) -> Column:
    """The average from the sums of ``cents`` and ``beyond_exact``: exact and
    half-up while nothing lies beyond, else that of doubles, rounded."""
    exact = half_up_hundredths(total_cents, n)
    rough = F.round((F.coalesce(total_cents.cast("double") / 100, F.lit(0.0)) + beyond) / n, 2)
    return F.when(beyond.isNull(), exact).otherwise(rough)


def half_up_hundredths(total_cents: Column, n: Column) -> Column:
    """``total_cents / n / 100`` rounded half-up to two decimals, as a double.

    Exact integer arithmetic on decimal(38,0) (no overflow, no float error):
    ``floor((2 * total + n) / (2 * n))`` taken as ``(a - pmod(a, b)) / b``, so
    both engines agree on exact halves. NULL when there are no rows.
    """
    a = total_cents.cast("decimal(38,0)") * 2 + n.cast("decimal(38,0)")
    b = (n * 2).cast("decimal(38,0)")
    q = ((a - F.pmod(a, b)) / b).cast("decimal(38,0)")
    return F.when(n > 0, (q / F.lit(100)).cast("double"))


def avg_hundredths(value) -> Column:
    """Aggregate: average of ``value`` rounded half-up to two decimals."""
    return average_of(F.sum(cents(value)), F.sum(beyond_exact(value)), F.count(as_col(value)))
