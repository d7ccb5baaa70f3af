"""K9: land a table as a time-ordered file stream, and read it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType, TimestampType

ENVELOPE_SCHEMA = StructType([
    StructField("key", BinaryType()),
    StructField("value", BinaryType()),
    StructField("timestamp", TimestampType()),
])


def land_as_stream(df: DataFrame, path: str, n_files: int, time_col: str = "timestamp",
                   relative_error: float = 0.001, rows_per_file: int = 1_000_000) -> int:
    """Write ``df`` as ``n_files`` consecutive time slices, so that file
    modification times follow event time and a file stream replays one slice per
    micro-batch, in order. Returns the files of a slice, which is what
    ``maxFilesPerTrigger`` must be for that.

    The input is computed once, into a staging table partitioned by slice; each
    slice is then copied from there in files of about ``rows_per_file`` rows, so
    no slice passes through one task. Slice edges come from ``approxQuantile``;
    any edges give time-ordered slices, so an approximate sketch is enough. Rows
    without a time are in the first slice."""
    spark = df.sparkSession
    secs = F.col(time_col).cast("double")
    probs = [i / n_files for i in range(1, n_files)]
    edges = df.select(secs.alias("_t")).approxQuantile("_t", probs, relative_error) if probs else []
    number = F.lit(0)
    for edge in edges:
        number = number + F.when(secs >= edge, 1).otherwise(0)
    staged = f"{path.rstrip('/')}_staged"
    df.withColumn("_slice", number).write.mode("overwrite").partitionBy("_slice").parquet(staged)
    slices = spark.read.schema(StructType([*df.schema.fields, StructField("_slice", IntegerType())])).parquet(staged)
    files = max(1, -(-slices.count() // (n_files * rows_per_file)))
    for k in range(n_files):
        (slices.where(F.col("_slice") == k).drop("_slice").repartition(files).sortWithinPartitions(time_col)
         .write.mode("append").parquet(path))
    return files


def replay_stream(spark: SparkSession, path: str, schema: StructType = ENVELOPE_SCHEMA,
                  files_per_trigger: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema)
            .option("maxFilesPerTrigger", files_per_trigger)
            .option("pathGlobFilter", "*.parquet")
            .parquet(path))
