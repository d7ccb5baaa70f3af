"""Top-k with deterministic tie-breaks, and top-k keeping ties (rank <= k).

``top_k`` is ``orderBy(...).limit(k)``, which Spark runs as
TakeOrderedAndProject: every partition keeps its own k best rows and only
those k x partitions rows travel, so no task ever holds the whole input.

``top_k_with_ties`` returns the rows of ``rank() <= k`` without an
unpartitioned window: the k-th best value is found the same way (a distributed
top-k reduced to a one-row scalar subquery), and every row at least that good
is kept by a plain filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from trendlens.functions._cols import as_col


def _names(cols) -> list:
    if cols is None:
        return []
    if isinstance(cols, (str, Column)):
        return [cols]
    return list(cols)


def top_k(df: DataFrame, by, k: int, tie_break=None, ascending: bool = False) -> DataFrame:
    """The ``k`` best rows by ``by`` (descending unless ``ascending``); equal
    values are ordered by the ``tie_break`` columns ascending."""
    order = [as_col(c).asc_nulls_last() if ascending else as_col(c).desc_nulls_last()
             for c in _names(by)]
    order += [as_col(c).asc_nulls_first() for c in _names(tie_break)]
    return df.orderBy(*order).limit(k)


def kth_best(df: DataFrame, by: str, k: int) -> Column:
    """Scalar subquery: the k-th largest value of ``by`` (or the smallest, if
    there are fewer than k non-NULL rows)."""
    best = df.select(by).where(F.col(by).isNotNull()).orderBy(F.col(by).desc()).limit(k)
    return best.agg(F.min(by)).scalar()


def top_k_with_ties(df: DataFrame, by: str, k: int) -> DataFrame:
    """Rows with ``rank() over (order by by desc) <= k``.

    A row's rank is 1 + the number of rows strictly better; it is <= k exactly
    when the row is at least as good as the k-th best value.
    """
    return df.where(F.col(by) >= kth_best(df, by, k))
