"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trendlens.session import shared_dir


def written(df: DataFrame, *name: str) -> DataFrame:
    """Write ``df`` as Parquet in a fresh folder of the shared checkpoint
    directory and read it back: the lineage ends there, and a lost executor
    costs a re-read instead of a recomputation."""
    path = shared_dir(df.sparkSession, "llm", *name, fresh=True)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
