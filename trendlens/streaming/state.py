"""K8: reading the state of a query back from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def keyed_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None, operator_id: int = 0) -> DataFrame:
    """The keys and aggregate values that a keyed aggregation holds after a batch
    (the last committed one by default), as flat columns and without running it."""
    reader = spark.read.format("statestore").option("operatorId", operator_id)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint).select("key.*", "value.*")


def first_seen_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None, key: str = "video_id") -> DataFrame:
    """(key, first_seen) of the first-seen query, from its state."""
    state = keyed_state(spark, checkpoint, batch_id)
    value = next(c for c in state.columns if c != key)
    return state.select(key, F.col(value).alias("first_seen"))


def state_rows(spark: SparkSession, checkpoint: str, variable: str, batch_id: int | None = None) -> DataFrame:
    """The rows of one state variable of a ``transformWithState`` query."""
    reader = spark.read.format("statestore").option("stateVarName", variable)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint)
