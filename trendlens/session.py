"""Session construction and the shared scratch location.

Everything that must outlive a task (stream checkpoints, landed stream files,
sink tables) goes under the folder named by ``spark.checkpoint.dir``, which on a
cluster points at shared storage. A local fallback is created only when the
setting is absent *and* Spark runs in one process (tests, the bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What ``transformWithState`` needs, whatever session it runs in.
ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Commit only the changelog each micro-batch; snapshots are taken in the background.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    **ROCKSDB_STATE,
}


def build_session(master: str | None = None, app_name: str = "trendlens",
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Window labels are rendered as strings; render them in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """``conf`` holds within the block; a streaming query keeps what held when it started."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running "
                           "streaming or checkpointing jobs on a cluster")
    root = tempfile.mkdtemp(prefix="trendlens-")
    spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd"))
    return root


def shared_dir(spark: SparkSession, *parts: str, fresh: bool = False) -> str:
    """A path under the shared checkpoint folder; ``fresh`` appends a unique id."""
    segs = [_checkpoint_root(spark), *parts]
    if fresh:
        segs.append(uuid.uuid4().hex)
    return "/".join(segs)
