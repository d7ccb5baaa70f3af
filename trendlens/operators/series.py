"""Ordered-series operators: daily reduction, moving averages, period deltas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def _list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def one_per_period(df: DataFrame, keys, period: str, value: str,
                   carry: Sequence[str] = ()) -> DataFrame:
    """One row per (keys, period): ``max(value)``, and ``max`` of each carried
    column (Q-14). Makes the order of a following ``lag`` total.

    This is a plain aggregation, so Spark combines map-side first: a key that
    holds a third of all rows still reaches the shuffle as one row per
    (key, period) per input partition.
    """
    aggs = [F.max(value).alias(value)] + [F.max(c).alias(c) for c in carry]
    return df.groupBy(*_list(keys), period).agg(*aggs)


def moving_average(df: DataFrame, value: str, order: str, rows: int,
                   partition=None, name: str | None = None) -> DataFrame:
    """Average of ``value`` over the current row and the ``rows - 1`` rows
    before it in ``order`` (row-based: gaps in the order are not filled).

    Without ``partition`` the frame spans the whole input, so Spark moves it
    into one task; call it on an already aggregated series (one row per day)
    whose length is bounded by the calendar, not by the data volume.
    """
    w = Window.orderBy(order).rowsBetween(-(rows - 1), Window.currentRow)
    if partition:
        w = Window.partitionBy(*_list(partition)).orderBy(order).rowsBetween(-(rows - 1), 0)
    return df.withColumn(name or f"moving_avg_{rows}", F.avg(value).over(w))


def period_delta(df: DataFrame, keys, order: str, value: str,
                 prev_value: str = "prev_value", prev_order: str | None = None,
                 delta: str = "delta", gap_days: int | None = None,
                 bounds: tuple | None = None) -> DataFrame:
    """Previous row's ``value`` (and optionally ``order``) within ``keys`` and
    the difference (NULL if it is too large for its type). Both lags share one
    window, so Spark sorts once.

    ``gap_days`` keeps only rows whose previous row lies exactly that many
    days earlier (``order`` a date); ``bounds`` keeps deltas within
    ``[low, high]``. Either filter drops the first row of every series.
    """
    w = Window.partitionBy(*_list(keys)).orderBy(order)
    prev_o = prev_order or "_prev_order"
    out = df.withColumn(prev_value, F.lag(value).over(w))
    if prev_order or gap_days is not None:
        out = out.withColumn(prev_o, F.lag(order).over(w))
    out = out.withColumn(delta, F.try_subtract(F.col(value), F.col(prev_value)))
    if gap_days is not None:
        out = out.where(F.col(prev_value).isNotNull()
                        & (F.datediff(order, prev_o) == gap_days))
    if bounds is not None:
        out = out.where(F.col(delta).between(*bounds))
    return out if prev_order else out.drop("_prev_order")
