"""K7: a keyed table whose upsert rewrites only the buckets that a batch touches.

Rows lie in ``n_buckets`` buckets by a hash of their key; each bucket is one folder
of files, and a small manifest names the current folder of every bucket. An upsert
reads the touched buckets, folds them with the batch, writes them to a fresh folder,
and moves a new manifest into place in one step. Readers see the table before a
batch or after it, at any time, without a separate publishing step.

The manifest records the last batch, so a batch that is run again changes nothing;
a crash before the manifest moved leaves an orphaned folder that the next upsert
removes. The version before the current one is kept for readers that have begun.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from trendlens.streaming.sinks import Folder

BUCKET_COL = "_bucket"


class BucketedTable:
    """``merge`` maps column names to aggregate functions (``{"reach": F.max}``); all
    other columns of ``schema`` are the key. The fold must be monotone or otherwise
    associative, as a max, a min, or a sum over batches that are applied once."""

    def __init__(self, path: str, schema: StructType | str, keys: Sequence[str], merge: dict[str, Callable],
                 n_buckets: int = 64):
        self.path = path.rstrip("/")
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.keys = list(keys)
        self.merge = merge
        self.n_buckets = n_buckets

    def manifest(self, spark: SparkSession) -> dict:
        if not Folder(spark, f"{self.path}/manifest.json").exists():
            return {"batch": -1, "n_buckets": self.n_buckets, "folders": {}, "kept": []}
        return json.loads("\n".join(r[0] for r in spark.read.text(f"{self.path}/manifest.json").collect()))

    def _bucket(self, n_buckets: int):
        return F.pmod(F.xxhash64(*self.keys), F.lit(n_buckets)).cast("int")

    def _files(self, spark: SparkSession, folders: dict[str, str], buckets) -> DataFrame:
        paths = [f"{self.path}/{folders[str(b)]}/{BUCKET_COL}={b}" for b in buckets if str(b) in folders]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)

    def upsert(self, rows: DataFrame, batch_id: int) -> list[int]:
        """Fold a batch into the table; the buckets that were rewritten."""
        spark = rows.sparkSession
        now = self.manifest(spark)
        if batch_id <= now["batch"]:
            return []
        bucket = self._bucket(now["n_buckets"])
        # A batch is folded once, map-side first, and both steps below read that.
        rows = self._folded(rows.select(*self.schema.names)).persist()
        try:
            touched = sorted(r[0] for r in rows.select(bucket.alias("b")).distinct().collect())  # at most n_buckets
            folder = f"v={batch_id}-{uuid.uuid4().hex}"
            if touched:
                old = self._files(spark, now["folders"], touched)
                merged = self._folded(old.unionByName(rows)).withColumn(BUCKET_COL, bucket)
                merged.repartition(min(len(touched), now["n_buckets"]), BUCKET_COL).write.partitionBy(BUCKET_COL).parquet(
                    f"{self.path}/{folder}")
        finally:
            rows.unpersist()
        folders = now["folders"] | {str(b): folder for b in touched}
        before = sorted(set(now["folders"].values()))
        Folder(spark, self.path).replace_text("manifest.json", json.dumps(
            {"batch": batch_id, "n_buckets": now["n_buckets"], "folders": folders, "kept": before}))
        live = {*folders.values(), *before}
        for name in Folder(spark, self.path).names():
            if name.startswith("v=") and name not in live:
                Folder(spark, f"{self.path}/{name}").delete()
        return touched

    def _folded(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[fn(c).alias(c) for c, fn in self.merge.items()]).select(*self.schema.names)

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        """As a ``foreachBatch`` sink. A batch that is run again is computed but not
        folded: a stateful query commits its state by running its plan."""
        if batch_id <= self.manifest(batch_df.sparkSession)["batch"]:
            batch_df.write.format("noop").mode("overwrite").save()
        else:
            self.upsert(batch_df, batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        now = self.manifest(spark)
        return self._files(spark, now["folders"], sorted(map(int, now["folders"])))
