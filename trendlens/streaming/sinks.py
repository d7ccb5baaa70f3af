"""K6/K7/K8: replay-safe micro-batch sinks and their read-back.

A ``BatchLog`` stores the rows each micro-batch emits under
``<root>/batch_id=<id>``, written with ``overwrite``: a batch that is replayed
after a failure replaces its own folder, so the log is exactly-once without a
read-modify-write of shared state. Readers merge the log by key:
``latest_per_key`` (last batch wins, K6) or any monotone merge such as a max
(the upsert of K7). Each batch's write costs O(rows it emitted).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

VERSION_COL = "batch_id"


class Folder:
    """A folder of the shared file system, through Spark's own client."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self.path = path
        self._p = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._p.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self._fs.exists(self._p)

    def names(self) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._p)] if self.exists() else []

    def size(self) -> int:
        return self._fs.getContentSummary(self._p).getLength()

    def delete(self) -> None:
        self._fs.delete(self._p, True)

    def replace_text(self, name: str, text: str) -> None:
        """Write a small file beside the folder's others and move it into place
        in one step, over an earlier one."""
        path = self._jvm.org.apache.hadoop.fs.Path
        fresh, target = path(self._p, f".{name}-{uuid.uuid4().hex}"), path(self._p, name)
        out = self._fs.create(fresh, True)
        out.write(bytearray(text.encode()))
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._p.toUri(), self._fs.getConf())
        options = self._jvm.org.apache.hadoop.fs.Options.Rename
        overwrite = SparkContext._gateway.new_array(options, 1)
        overwrite[0] = options.OVERWRITE
        context.rename(fresh, target, overwrite)


class BatchLog:
    """``merge`` (optional) folds a log into an equivalent smaller one -- it
    must keep the columns, ``batch_id`` included, and give the same final
    table when the reader's merge runs on top. With ``compact_every`` the sink
    then writes a snapshot of everything up to batch N every that many batches
    and records N and the snapshot's folder in ``<root>/manifest.json``, one small file
    that is replaced in one step. Readers take the recorded snapshot plus the batch
    folders after it.

    A snapshot is made from an earlier one and never from itself: its folder is
    new each time and counts only once the manifest names it, and a replayed
    batch that the manifest covers already is not compacted again. Folders that
    the *previous* snapshot superseded are deleted then, so listing costs what
    is live, and readers that began before the compaction still find theirs.
    """

    def __init__(self, root: str,
                 prepare: Callable[[DataFrame, int], DataFrame] | None = None,
                 merge: Callable[[DataFrame], DataFrame] | None = None,
                 compact_every: int | None = None):
        self.root = root.rstrip("/")
        self.prepare = prepare
        self.merge = merge
        self.compact_every = compact_every if merge is not None else None

    def path(self, batch_id: int) -> str:
        return f"{self.root}/{VERSION_COL}={batch_id}"

    @property
    def _snapshots(self) -> str:
        return f"{self.root}/_snapshots"

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        out = self.prepare(batch_df, batch_id) if self.prepare else batch_df
        out.write.mode("overwrite").parquet(self.path(batch_id))
        if self.compact_every and (batch_id + 1) % self.compact_every == 0:
            self.compact(batch_df.sparkSession, batch_id)

    def _latest_snapshot(self, spark: SparkSession) -> tuple[int, str] | None:
        """(last batch, folder name); only a missing manifest means none."""
        if not Folder(spark, f"{self.root}/manifest.json").exists():
            return None
        newest = json.loads(spark.read.text(f"{self.root}/manifest.json").first()[0])
        return newest["upto"], newest["folder"]

    def _batches(self, spark: SparkSession) -> list[int]:
        prefix = f"{VERSION_COL}="
        return sorted(int(n[len(prefix):]) for n in Folder(spark, self.root).names() if n.startswith(prefix))

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Write the merged log up to batch ``upto``, record it, and delete what
        the snapshot before had superseded."""
        before = self._latest_snapshot(spark)
        if before is not None and before[0] >= upto:
            return
        folder = f"upto={upto}-{uuid.uuid4().hex}"
        self.merge(self._read(spark, max_batch=upto)).write.parquet(f"{self._snapshots}/{folder}")
        Folder(spark, self.root).replace_text("manifest.json", json.dumps({"upto": upto, "folder": folder}))
        if before is None:
            return
        for batch in self._batches(spark):
            if batch <= before[0]:
                Folder(spark, self.path(batch)).delete()
        for name in Folder(spark, self._snapshots).names():
            if name not in (folder, before[1]):
                Folder(spark, f"{self._snapshots}/{name}").delete()

    def _read(self, spark: SparkSession, max_batch: int | None = None) -> DataFrame | None:
        snap = self._latest_snapshot(spark)
        live = [b for b in self._batches(spark)
                if (snap is None or b > snap[0]) and (max_batch is None or b <= max_batch)]
        log = None
        if live:
            log = spark.read.option("basePath", self.root).parquet(*[self.path(b) for b in live])
        if snap is not None:
            base = spark.read.parquet(f"{self._snapshots}/{snap[1]}")
            log = base if log is None else base.unionByName(log)
        return log

    def read(self, spark: SparkSession, schema: StructType | None = None) -> DataFrame:
        """All logged rows (or their compacted equivalent) plus ``batch_id``;
        empty (with ``schema``) when no batch has been written yet."""
        log = self._read(spark)
        if log is None:
            if schema is None:
                raise FileNotFoundError(f"no batch has been written under {self.root}")
            return spark.createDataFrame([], StructType([*schema.fields, StructField(VERSION_COL, IntegerType())]))
        return log


class PublishedTable:
    """A result table that is replaced as a whole: each version is written to a
    folder of its own, and then one small file, moved into place in one step,
    names it. Readers see the old version or the new one. The version before the
    current one is kept for readers that have begun; older ones are deleted."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def _current(self, spark: SparkSession) -> str | None:
        if not Folder(spark, f"{self.path}/current.txt").exists():
            return None
        return spark.read.text(f"{self.path}/current.txt").first()[0]

    def replace(self, df: DataFrame) -> None:
        spark = df.sparkSession
        before, version = self._current(spark), f"v={uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{version}")
        Folder(spark, self.path).replace_text("current.txt", version)
        for name in Folder(spark, self.path).names():
            if name.startswith("v=") and name not in (version, before):
                Folder(spark, f"{self.path}/{name}").delete()

    def read(self, spark: SparkSession) -> DataFrame:
        version = self._current(spark)
        if version is None:
            raise FileNotFoundError(f"nothing has been published under {self.path}")
        return spark.read.parquet(f"{self.path}/{version}")


def latest_per_key(log: DataFrame, keys: list[str], version: str = VERSION_COL,
                   keep_version: bool = False) -> DataFrame:
    """For every key the row of its highest batch id, as an aggregation (map-
    side combined, no sort): keys emitted by many batches stay cheap."""
    values = [c for c in log.columns if c not in keys and c != version]
    out = (log.groupBy(*keys)
           .agg(F.max_by(F.struct(*values), F.col(version)).alias("_row"),
                F.max(version).alias(version)))
    cols = [*keys, *[F.col(f"_row.{c}").alias(c) for c in values]]
    return out.select(*cols, version) if keep_version else out.select(*cols)


def fold_per_key(keys: list[str], **aggs) -> Callable[[DataFrame], DataFrame]:
    """A log merge: one row per key with the given aggregate per column
    (e.g. ``regional_reach=F.max``) and the newest batch id."""
    def merge(log: DataFrame) -> DataFrame:
        return log.groupBy(*keys).agg(*[fn(c).alias(c) for c, fn in aggs.items()],
                                      F.max(VERSION_COL).alias(VERSION_COL))
    return merge
