"""Joins against a reference set."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def overlap_with(df: DataFrame, keys, reference: DataFrame, flag: str = "in_reference",
                 broadcast: bool = False, unique: bool = False) -> DataFrame:
    """``df`` with a boolean ``flag``: TRUE where its ``keys`` occur in
    ``reference``, NULL otherwise (a left join to the distinct reference keys,
    so ``df`` rows are never multiplied).

    ``unique`` says that the reference's keys are distinct already, which spares
    a shuffle of it. ``broadcast`` must come from a check of the reference's size
    (micro-batches are not re-planned); without it the planner decides, in batch
    jobs by the size that adaptive execution measures.
    """
    cols = [keys] if isinstance(keys, str) else list(keys)
    ref = reference.select(*cols)
    ref = (ref if unique else ref.distinct()).withColumn(flag, F.lit(True))
    return df.join(F.broadcast(ref) if broadcast else ref, cols, "left")
