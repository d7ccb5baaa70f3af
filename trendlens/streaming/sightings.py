"""Sightings of items with state that expires, and freshness in append mode.

An item's sightings fall into runs: two sightings of one run have no more than the
time to live between one and the next. A run's first sighting is fresh; so is the
first of all. With a TTL an item is fresh again after it was not seen for that long;
without one it is fresh once.

State: one small list of open runs (start, end, emitted) for each item, on RocksDB
(``transformWithState``; start the query under ``session.ROCKSDB_STATE`` if the session
has another store). One event-time timer for each item drives it, set for the first of
what is due:

* When the watermark passes a run's start, no earlier sighting can come, so the
  start is final and is emitted, once. The order in which messages arrive within the
  watermark does not matter.
* When it passes a run's end by the TTL, nothing can join the run any more, and it
  is dropped. So the state holds the items seen within the TTL, not all ever seen.

Before the shuffle each task joins its sightings of an item to runs, so an item that
holds a third of all messages costs a few rows for each task and batch.

``fresh_windows`` counts the fresh sightings in windows, in the same query: two
stateful operators, in append mode, each window emitted once and final.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from trendlens.streaming.parse import DEFAULT_WATERMARK
from trendlens.streaming.processors import DEFAULT_WINDOW, fresh_counts

_RUN_SCHEMA = "starts array<bigint>, ends array<bigint>, emitted array<boolean>"
_FOREVER = 2**62


def microseconds(ttl: str | None) -> int | None:
    """An interval such as ``"2 hours"`` in microseconds."""
    return None if ttl is None else int(pd.Timedelta(ttl).value // 1000)


def _joined_runs(keys: np.ndarray, times: np.ndarray, ttl: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, start, end) of the runs of sightings (key number, time)."""
    order = np.lexsort((times, keys))
    keys, times = keys[order], times[order]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]) | (times[1:] - times[:-1] > ttl)
    heads = np.flatnonzero(first)
    return keys[heads], times[heads], times[np.append(heads[1:], len(times)) - 1] if len(heads) else times[:0]


def partial_runs(messages: DataFrame, ttl: str | None, key: str = "video_id", time: str = "event_time") -> DataFrame:
    """(key, start_us, end_us, seen): each Arrow batch's sightings as runs; ``seen`` is
    the start as a timestamp. The batch's last sighting is there by itself too, so that
    the watermark follows it and not the start of its run. Sightings without a key or
    a time take no part."""
    gap = microseconds(ttl) or _FOREVER

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            number, start, end = _joined_runs(coded.indices.to_numpy(), batch.column(1).to_numpy(), gap)
            if len(end):
                last = int(np.argmax(end))
                number, start, end = np.append(number, number[last]), np.append(start, end[last]), np.append(end, end[last])
            yield pa.RecordBatch.from_arrays(
                [coded.dictionary.take(pa.array(number)), pa.array(start), pa.array(end),
                 pa.array(start).cast(pa.timestamp("us", "UTC"))], names=[key, "start_us", "end_us", "seen"])

    seen = messages.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    return seen.select(F.col(key).cast("string").alias(key), F.unix_micros(time).alias("at")).mapInArrow(
        run, f"{key} string, start_us bigint, end_us bigint, seen timestamp")


class _Runs(StatefulProcessor):
    """The open runs of one item."""

    def __init__(self, ttl: int | None):
        self.ttl = ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = handle.getValueState("runs", _RUN_SCHEMA)

    def _load(self) -> list[list]:
        held = self.runs.get()
        return [] if held is None else [list(r) for r in zip(*held)]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        gap = self.ttl if self.ttl is not None else _FOREVER
        runs: list[list] = []
        held = self._load()
        known = held + [[s, e, False] for part in rows for s, e in zip(part["start_us"].tolist(), part["end_us"].tolist())]
        for start, end, emitted in sorted(known):
            if runs and start - runs[-1][1] <= gap:
                runs[-1][1] = max(runs[-1][1], end)
                # What was emitted is final, so nothing unemitted can lie before it.
                runs[-1][2] = runs[-1][2] or emitted
            else:
                runs.append([start, end, emitted])
        self._set(runs, self._next(held))
        return iter(())

    def _set(self, runs: list[list], timer: int | None) -> None:
        """Keep the runs, and one timer: when the first of them can be emitted or dropped.
        ``timer`` is the one that is set."""
        if runs:
            self.runs.update(tuple(list(c) for c in zip(*runs)))
        else:
            self.runs.clear()
        due = self._next(runs)
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)

    def _next(self, runs: list[list]) -> int | None:
        due = [self._due(start) for start, _, emitted in runs if not emitted]
        if self.ttl is not None:
            due += [self._due(end + self.ttl) for _, end, _ in runs]
        return min(due, default=None)

    @staticmethod
    def _due(us: int) -> int:
        return -(-us // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """All that the watermark has passed, not only what the timer was set for: the
        next timer lies beyond it, so an item has one call for each batch."""
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        fresh, left = [], []
        held = self._load()
        for start, end, emitted in held:
            if not emitted and self._due(start) <= now:
                fresh.append(start)
                emitted = True
            if not (emitted and self.ttl is not None and self._due(end + self.ttl) <= now):
                left.append([start, end, emitted])
        if left != held:  # the timer that is called is taken off by Spark
            self._set(left, None)
        if fresh:
            yield pd.DataFrame({"item": [str(key[0])] * len(fresh),
                                "fresh_at": pd.to_datetime(pd.Series(fresh, dtype="int64"), unit="us")})

    def close(self) -> None:
        pass


def fresh_sightings(messages: DataFrame, ttl: str | None, key: str = "video_id", time: str = "event_time",
                    watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """(item, fresh_at): the fresh sightings of a stream, each once, as soon as the
    watermark makes it final. On a static frame, all of them, by a window function."""
    gap = microseconds(ttl)
    if not messages.isStreaming:
        from pyspark.sql import Window

        at = F.unix_micros(time)
        by = Window.partitionBy(key).orderBy(time)
        since = at - F.lag(at).over(by)
        seen = messages.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
            F.col(key).cast("string").alias("item"), F.col(time).alias("fresh_at"), since.alias("since"))
        fresh = F.col("since").isNull() if gap is None else F.col("since").isNull() | (F.col("since") > gap)
        return seen.where(fresh).drop("since")
    runs = partial_runs(messages, ttl, key, time).withWatermark("seen", watermark)
    return runs.groupBy(key).transformWithStateInPandas(
        _Runs(gap), "item string, fresh_at timestamp", "Append", "EventTime", eventTimeColumnName="fresh_at")


def fresh_windows(messages: DataFrame, ttl: str | None = None, window: str = DEFAULT_WINDOW, **names) -> DataFrame:
    """(fresh_count, window_start) of the fresh sightings. As a stream: append mode,
    windows that the watermark has passed, each once."""
    return fresh_counts(fresh_sightings(messages, ttl, **names).withColumnRenamed("fresh_at", "first_seen"), window)
