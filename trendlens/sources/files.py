"""K1 CSV scan, K2 Parquet scan, K3 observation sink, K4 result sink."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# A task that writes a file sorts its rows; so many take it some hundred MB.
ROWS_PER_FILE = 1_000_000


@contextmanager
def _computed_once(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` kept on the executors' disks while the block runs (if it is not kept already)."""
    if df.storageLevel.useDisk or df.storageLevel.useMemory:
        yield df
        return
    df.persist(StorageLevel.DISK_ONLY)
    try:
        yield df
    finally:
        df.unpersist()



def read_raw_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
                 multi_line: bool = True) -> DataFrame:
    """Raw CSV with a header, ``"`` quotes, ``""`` escapes and, with
    ``multi_line``, quoted newlines. Without ``schema`` every column is read as text
    (no inference pass); ``prepare`` types them. A file that may hold quoted newlines
    cannot be split: it is one task. Turn ``multi_line`` off for files without them,
    and a large file is read by as many tasks as it has splits."""
    reader = (spark.read.option("header", "true").option("quote", '"')
              .option("escape", '"').option("multiLine", str(multi_line).lower()))
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", "false")
    return reader.csv(path)


def write_observations(df: DataFrame, path: str, partition_by: str | None = "region_code",
                       files_per_partition: int | None = None, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Overwrite the observation table, partitioned by region so region
    filters prune whole directories.

    With ``files_per_partition`` the rows are first hash-distributed on
    (region, item bucket): a file then holds one region's rows of some items, a
    region that holds a third of all rows is still spread over that many
    tasks, and all rows of an item sit in one file per region. If the largest region
    has more than ``rows_per_file`` rows for each of them, there are as many more
    buckets, so that a task does not grow with the table; the rows are kept on disk
    for that count. Without it the
    upstream partitioning is kept (one file per region per task). Inside each
    task rows are sorted by region, item and day: the region prefix is the
    order the partitioned writer needs anyway, and item/day keep row-group
    statistics selective.
    """
    order = ([partition_by] if partition_by else []) + ["video_id", "trending_date"]

    def written(out: DataFrame) -> None:
        w = out.sortWithinPartitions(*order).write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(partition_by)
        w.parquet(path)

    if not (files_per_partition and partition_by):
        written(df)
        return
    with _computed_once(df) as rows:
        sizes = rows.groupBy(partition_by).agg(F.count("*").alias("n"))
        largest, regions = sizes.agg(F.max("n"), F.count("*")).first()
        files = max(files_per_partition, -(-(largest or 0) // rows_per_file))
        bucket = F.pmod(F.xxhash64("video_id"), F.lit(files))
        if files == files_per_partition:
            written(rows.repartition(partition_by, bucket))
        else:  # so many tasks that few of them get two
            written(rows.repartition(2 * regions * files, partition_by, bucket))


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str] = ("video_id", "region_code"),
                   order: str = "trending_date", n_buckets: int = 64, rows_per_bucket: int = ROWS_PER_FILE) -> None:
    """Replace the table ``table`` (files under ``path``), bucketed by ``keys`` and sorted
    within the buckets. Aggregations, windows and joins on these keys then need no
    shuffle: the rows of one key lie in one bucket, read by one task. Choose as many
    buckets as tasks that the largest reader should have. Where they would hold more
    than ``rows_per_bucket`` rows each, their number is doubled until they do not (so
    that it stays a multiple), and neither a writing nor a reading task grows with the
    table; the rows are kept on disk for that count. Rows are dealt by the keys
    first, so each bucket is one file."""
    with _computed_once(df) as rows:
        n, buckets = rows.count(), n_buckets
        while n > buckets * rows_per_bucket:
            buckets *= 2
        (rows.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
         .bucketBy(buckets, *keys).sortBy(*keys, order).saveAsTable(table))


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_result(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    """Replace a result table. ``fmt`` passes through to ``DataFrameWriter``
    (a document-store connector, when one is on the classpath)."""
    df.write.format(fmt).mode("overwrite").options(**options).save(path)
