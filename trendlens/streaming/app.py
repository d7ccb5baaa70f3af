"""The streaming application: five queries over one parsed message stream.

Layout under ``root`` (a shared folder): ``out/<name>`` batch logs,
``checkpoints/<name>`` query checkpoints, ``state/`` tables materialised once
at start, ``published/<name>`` result tables. Outputs and checkpoints never share a folder with the observation
table (Q-12). Every query runs in ``update`` mode into a ``BatchLog``; the
``result`` readers turn the logs into the final tables, which equal the batch
processors on the same input.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from trendlens.operators.topk import top_k_with_ties
from trendlens.plans.history import hist_channel_ids, views_baseline
from trendlens.streaming import processors as P
from trendlens.streaming.buckets import BucketedTable
from trendlens.streaming.sinks import BatchLog, Folder, PublishedTable, fold_per_key, latest_per_key

# The processing-time trigger of each query.
TRIGGERS = {
    "duration_distribution": "10 seconds",
    "channel_regional_reach": "10 seconds",
    "trending_freshness": "15 seconds",
    "historical_overlap": "30 seconds",
    "current_vs_historical_views": "30 seconds",
}
NAMES = tuple(TRIGGERS)
# A history's channels are broadcast to micro-batches up to this size of their
# written table; beyond it the join shuffles. The results are the same.
MAX_BROADCAST_BYTES = 32 << 20

# How each sink folds its log without changing the final table.
LOG_MERGES = {
    "duration_distribution": lambda log: latest_per_key(log, ["window_start"], keep_version=True),
    "channel_regional_reach": fold_per_key(["channel_title"], regional_reach=F.max,
                                           window_start=F.max),
    "trending_freshness": fold_per_key(["video_id"], first_seen=F.min),
    "historical_overlap": fold_per_key(["window_start", "channel_id"], in_hist=F.max),
    "current_vs_historical_views": lambda log: latest_per_key(log, ["window_start"],
                                                              keep_version=True),
}


class TrendStreams:
    def __init__(self, spark: SparkSession, root: str, history: DataFrame | None = None,
                 window: str = P.DEFAULT_WINDOW, reach_k: int = P.DEFAULT_REACH_K,
                 max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
                 state_partitions: int | None = None, compact_every: int | None = 50,
                 freshness: str = "earliest", reach_buckets: int | None = None):
        """``state_partitions`` fixes the number of state-store partitions of
        every query (size it to the key volume: it cannot change once a
        checkpoint exists); ``None`` takes the session's shuffle setting.
        ``compact_every`` batches each sink folds its log into a snapshot.
        ``freshness`` picks the first-seen state of S3: ``"earliest"`` (minimum
        event time per item, order-independent; every batch re-emits the items
        it touched) or ``"arrival"`` (first message per item via streaming
        deduplication; each item is emitted once; equal for in-order input).
        ``reach_buckets`` keeps S2 in a table of that many buckets, which every batch
        brings up to date by rewriting the buckets it touches, instead of a log that
        readers fold: results are current after each batch, at the price of a read and
        a write of those buckets."""
        if freshness not in ("earliest", "arrival"):
            raise ValueError("freshness must be 'earliest' or 'arrival'")
        self.freshness = freshness
        self.reach_buckets = reach_buckets
        self.spark = spark
        self.state_partitions = state_partitions
        self.compact_every = compact_every
        self.root = root.rstrip("/")
        self.history = history
        self.window = window
        self.reach_k = reach_k
        self.max_broadcast_bytes = max_broadcast_bytes

    def log(self, name: str, prepare=None) -> BatchLog:
        return BatchLog(f"{self.root}/out/{name}", prepare, LOG_MERGES[name], self.compact_every)

    @property
    def reach_table(self) -> BucketedTable:
        """Best reach per channel title, as a table (see ``reach_buckets``)."""
        return BucketedTable(f"{self.root}/out/channel_regional_reach_table", "channel_title string, regional_reach bigint",
                             ["channel_title"], {"regional_reach": F.max}, self.reach_buckets)

    def _start(self, name: str, updates: DataFrame, sink: Callable[[DataFrame, int], None],
               trigger: dict | None) -> StreamingQuery:
        trig = trigger if trigger is not None else {"processingTime": TRIGGERS[name]}
        writer = (updates.writeStream.outputMode("update").foreachBatch(sink)
                  .option("checkpointLocation", f"{self.root}/checkpoints/{name}")
                  .queryName(f"{name}_{zlib.crc32(self.root.encode()):08x}")
                  .trigger(**trig))
        if self.state_partitions is None:
            return writer.start()
        # A query copies the session conf when it starts; the partition count
        # is then recorded in its checkpoint.
        key = "spark.sql.shuffle.partitions"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, str(self.state_partitions))
        try:
            return writer.start()
        finally:
            self.spark.conf.set(key, before)

    # history, materialised once per start ---------------------------------------------------
    def _history(self) -> DataFrame:
        if self.history is not None:
            return self.history
        return self.spark.createDataFrame([], "region_code string, channel_id string, view_count double")

    def _hist_channels(self) -> tuple[DataFrame, bool]:
        path = f"{self.root}/state/hist_channels"
        hist_channel_ids(self._history()).write.mode("overwrite").parquet(path)
        table = self.spark.read.parquet(path)
        return table, Folder(self.spark, path).size() <= self.max_broadcast_bytes

    @property
    def _baseline(self) -> PublishedTable:
        """The history's one-row baseline, replaced whenever S5 starts. The result
        takes it as it is now, for all windows alike, so windows from before a restart
        with a newer history are compared with the newer one too."""
        return PublishedTable(f"{self.root}/state/views_baseline")

    # starting -------------------------------------------------------------------------------
    def start(self, name: str, parsed: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        w = self.window
        if name == "duration_distribution":
            return self._start(name, P.duration_distribution(parsed, w), self.log(name), trigger)
        if name == "channel_regional_reach":
            sink = self.reach_table if self.reach_buckets else self.log(name)
            return self._start(name, P.channel_reach_updates(parsed, w), sink, trigger)
        if name == "trending_freshness":
            seen = P.first_seen(parsed) if self.freshness == "earliest" else P.first_arrival(parsed)
            return self._start(name, seen, self.log(name), trigger)
        if name == "historical_overlap":
            channels, small = self._hist_channels()
            sink = self.log(name, lambda df, _id: P.flag_history(df, channels, small))
            return self._start(name, P.window_channel_updates(parsed, w), sink, trigger)
        if name == "current_vs_historical_views":
            self._baseline.replace(views_baseline(self._history()))
            return self._start(name, P.window_view_updates(parsed, w), self.log(name), trigger)
        raise KeyError(name)

    def start_all(self, parsed: DataFrame, trigger: dict | None = None) -> list[StreamingQuery]:
        return [self.start(n, parsed, trigger) for n in NAMES]

    def run(self, parsed: DataFrame, trigger: dict | None = None, drain: bool = False) -> None:
        """Start all five queries and block until any of them stops (or fails);
        with ``drain`` until all have ended by themselves."""
        queries = self.start_all(parsed, trigger)
        if not drain:
            self.spark.streams.awaitAnyTermination()
            return
        for q in queries:
            q.awaitTermination()

    # publishing -----------------------------------------------------------------------------
    def published(self, name: str) -> PublishedTable:
        return PublishedTable(f"{self.root}/published/{name}")

    def publish(self, name: str) -> None:
        """Replace the result table that others read by the current result."""
        self.published(name).replace(self.result(name))

    # reading the final tables ---------------------------------------------------------------
    def result(self, name: str) -> DataFrame:
        if name == "channel_regional_reach" and self.reach_buckets:
            return top_k_with_ties(self.reach_table.read(self.spark), "regional_reach", self.reach_k)
        log = self.log(name).read(self.spark)
        if name == "duration_distribution":
            return latest_per_key(log, ["window_start"]).select(
                "short_videos_count", "medium_videos_count", "long_videos_count",
                "window_start", "window_end")
        if name == "channel_regional_reach":
            return P.merge_channel_reach(log, self.reach_k)
        if name == "trending_freshness":
            seen = log.groupBy("video_id").agg(F.min("first_seen").alias("first_seen"))
            return P.fresh_counts(seen, self.window)
        if name == "historical_overlap":
            keyed = log.groupBy("window_start", "channel_id").agg(F.max("in_hist").alias("in_hist"))
            return P.overlap_summary(keyed)
        if name == "current_vs_historical_views":
            base = self._baseline.read(self.spark).select(F.struct("hist_max_views", "hist_avg_views").alias("b")).scalar()
            last = latest_per_key(log, ["window_start"])
            return P.finish_window_views(last, base.getField("hist_max_views"), base.getField("hist_avg_views"))
        raise KeyError(name)
