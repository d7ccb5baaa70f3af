"""Operator 7, URL filters: a sorted digest array of 64-bit xxhash keys, probed
by vectorised binary search, with the stored strings checked on a match.

Two lists come as DataFrames: rules (host, path, verdict) and blocked hosts (host).
Spark merges equal entries, hashes them, range-partitions them by key and sorts them,
so neither list is ever whole on the driver; each partition is packed to one slice
of at most ``SLICE_BYTES``: sorted keys, offsets and strings. For each slice the pages
are passed once (written between passes): a worker maps the slice from an unlinked
temporary file and compares strings where they lie, as bytes.

For each URL the candidate strings are its host's suffixes of as many labels as some
entry has, alone and with every path prefix as long as that of some rule of so many
labels. Spark makes and hashes them; a batch's keys are searched at once. The longest
fitting rule decides; without one, a blocked host (or a subdomain of it) is blocked and
anything else allowed.

Defined results: NULL URLs and URLs without "://" have empty host and path, fit
no rule and are allowed; repeated rows are judged each; of equal rules with
different verdicts, block wins; NULL entries fit nothing, an entry's host counts as
written in lower case. Columns named like a result are replaced.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trendlens.llm.common import written

SLICE_BYTES = 64 << 20
# The rules of the contract, as (host, path, verdict).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
# Hosts that the method blocks: advertising, gambling and spam names of the corpus.
BLOCKED_LABELS = ("ads-track", "casino-win", "spam-farm", "adult-x", "cheap-pills", "free-bets")
BLOCKED_HOSTS = tuple(f"{label}.example.{top}" for label in BLOCKED_LABELS for top in ("com", "net", "org"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RESULT = ("host", "path", "rule", "verdict")


def default_rules(spark: SparkSession) -> DataFrame:
    rows = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(("host", "path", "verdict"), r)]) for r in RULES])
    return spark.range(1).select(F.inline(rows))


def default_blocked(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.explode(F.lit(list(BLOCKED_HOSTS))).alias("host"))


def entries(rules: DataFrame, blocked: DataFrame) -> DataFrame:
    """(text, block, labels, length): both lists as one, equal texts merged; block wins.
    ``length`` is that of a rule's path, -1 for a blocked host."""
    host = F.translate("host", UPPER, LOWER)
    kinds = rules.select(F.concat(F.lit("rule "), host, F.col("path")).alias("text"), (F.col("verdict") == "block").alias("block"),
                         host.alias("h"), F.length("path").alias("length"))
    hosts = blocked.select(F.concat(F.lit("host "), host).alias("text"), F.lit(True).alias("block"), host.alias("h"),
                           F.lit(-1).alias("length"))
    return kinds.unionByName(hosts).filter("text is not null and block is not null").groupBy("text").agg(
        F.max("block").alias("block"), F.max(F.size(F.split("h", r"\."))).alias("labels"), F.max("length").alias("length"))


def slices(found: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(slice, keys, offsets, texts, block): the entries in order of their keys, packed
    to slices of at most ``slice_bytes`` of text."""
    keyed = found.select(F.xxhash64("text").alias("key"), "text", "block")
    size = found.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    parts = -(-size // slice_bytes) or 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, n = TaskContext.get().partitionId() << 32, [], 0

        def packed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            texts = table.column("text").cast(pa.large_binary()).combine_chunks()
            offsets = np.append(0, np.cumsum(pc.binary_length(texts).to_numpy()))
            cells = (number, table.column("key").to_numpy().astype("<i8").tobytes(), offsets.astype("<i8").tobytes(),
                     b"".join(texts.to_pylist()), table.column("block").to_numpy().astype(np.uint8).tobytes())
            return pa.RecordBatch.from_arrays([pa.array([c]) for c in cells], names=["slice", "keys", "offsets", "texts", "block"])

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                piece = batch.slice(at, 1024)
                size = pc.sum(pc.binary_length(piece.column("text"))).as_py() + 16 * piece.num_rows
                if held and n + size > slice_bytes:
                    yield packed()
                    number, held, n = number + 1, [], 0
                held.append(piece)
                n += size
        if held:
            yield packed()

    return keyed.repartitionByRange(parts, "key").sortWithinPartitions("key").mapInArrow(
        run, "slice long, keys binary, offsets binary, texts binary, block binary")


class DigestArray:
    """One slice in a memory-mapped file: sorted keys, and the strings that they stand for."""

    def __init__(self, keys: bytes, offsets: bytes, texts: bytes, block: bytes):
        self.file = tempfile.TemporaryFile()
        for part in (keys, offsets, block, texts):
            self.file.write(part)
        self.file.flush()
        raw = np.memmap(self.file, np.uint8, "r") if keys else np.zeros(8, np.uint8)
        n = len(keys) // 8
        self.keys = raw[:8 * n].view("<i8")
        self.offsets = raw[8 * n:16 * n + 8].view("<i8")
        self.block = raw[16 * n + 8:17 * n + 8]
        self.texts = raw[17 * n + 8:]

    def find(self, texts: pa.Array, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which texts are stored, where) by their keys, found by binary search and
        compared as bytes; texts of one key stand side by side."""
        at = np.searchsorted(self.keys, keys)
        which = np.flatnonzero((at < len(self.keys)) & (self.keys[np.minimum(at, max(len(self.keys) - 1, 0))] == keys)
                               if len(self.keys) else np.zeros(0, bool))
        hits, places = [], []
        for i in which.tolist():
            text, j = texts[i].as_py().encode(), int(at[i])
            while j < len(self.keys) and self.keys[j] == keys[i]:  # keys may collide; strings decide
                a, b = int(self.offsets[j]), int(self.offsets[j + 1])
                if b - a == len(text) and self.texts[a:b].tobytes() == text:
                    hits.append(i)
                    places.append(j)
                    break
                j += 1
        return np.array(hits, np.int64), np.array(places, np.int64)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z in lower case, and the path of a URL."""
    whole = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(whole, "://") > 0, F.substr(whole, F.instr(whole, "://") + 3)).otherwise(F.lit(""))
    rest = F.substring_index(F.substring_index(rest, "#", 1), "?", 1)
    host = F.substring_index(rest, "/", 1)
    return F.translate(host, UPPER, LOWER), F.substr(rest, F.length(host) + 1)


def _candidates(shapes: list[tuple[int, int]]) -> Column:
    """The strings that entries of these (labels, path length) may equal."""
    n = F.size(F.split("host", r"\."))

    def one(labels: int, length: int) -> Column:
        suffix = F.substring_index("host", ".", -labels)
        if length < 0:
            return F.when((F.col("host") != "") & (n >= labels), F.concat(F.lit("host "), suffix))
        fits = (F.col("host") != "") & (n >= labels) & (F.length("path") >= length)
        return F.when(fits, F.concat(F.lit("rule "), suffix, F.substr("path", F.lit(1), F.lit(length))))

    found = [one(*s) for s in shapes]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def _pass(pages: DataFrame, part: tuple, texts: Column) -> DataFrame:
    """One pass over the pages with one slice."""
    shared = pages.sparkSession.sparkContext.broadcast(part)
    probing = pages.withColumn("texts", texts).withColumn("keys", F.transform("texts", lambda t: F.xxhash64(t)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = DigestArray(*shared.value)
        for batch in batches:
            cols = dict(zip(batch.schema.names, batch.columns))
            lists = cols.pop("texts")
            texts, keys = lists.flatten(), cols.pop("keys").flatten().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy())
            hits, places = digests.find(texts, keys)
            rule, rule_block = cols["rule"].to_pylist(), cols["rule_block"].to_pylist()
            blocked = cols["blocked"].to_pylist()
            for i, hit, j in zip(owner[hits].tolist(), hits.tolist(), places.tolist()):
                text = texts[hit].as_py()
                if text.startswith("host "):
                    blocked[i] = True
                    continue
                new = (len(text) - 5, bool(digests.block[j]), text[5:])
                if rule[i] is None or new > (len(rule[i]), rule_block[i], rule[i]):
                    rule[i], rule_block[i] = new[2], new[1]
            cols |= {"rule": pa.array(rule, pa.string()), "rule_block": pa.array(rule_block, pa.bool_()),
                     "blocked": pa.array(blocked, pa.bool_())}
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return probing.mapInArrow(run, pages.schema)


def judge(pages: DataFrame, rules: DataFrame | None = None, blocked: DataFrame | None = None, url: str = "url",
          slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``pages`` with host, path, rule and verdict."""
    spark = pages.sparkSession
    found = written(entries(default_rules(spark) if rules is None else rules,
                            default_blocked(spark) if blocked is None else blocked), "url-entries")
    # The shapes of entries: as many labels as a host has, by as many path lengths.
    shapes = sorted(tuple(r) for r in found.select("labels", "length").distinct().collect())
    packed = written(slices(found, slice_bytes), "url-slices")
    host, path = host_and_path(pages[url])
    names = [c for c in pages.columns if c not in RESULT]
    state = pages.select(F.struct(*[pages[c] for c in names]).alias("_row"), host.alias("host"), path.alias("path"),
                         F.lit(None).cast("string").alias("rule"), F.lit(None).cast("boolean").alias("rule_block"),
                         F.lit(False).alias("blocked"))
    numbers = sorted(r[0] for r in packed.select("slice").collect())
    for k, number in enumerate(numbers):
        part = packed.filter(F.col("slice") == number).select("keys", "offsets", "texts", "block").first()
        state = _pass(state, tuple(bytes(x) for x in part), _candidates(shapes))
        if k + 1 < len(numbers):
            state = written(state, "urls")
    verdict = F.when(F.coalesce("rule_block", "blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return state.select("_row.*", "host", "path", "rule", verdict.alias("verdict"))


def allowed(pages: DataFrame, **options) -> DataFrame:
    """The pages whose verdict is to allow."""
    return judge(pages, **options).filter(F.col("verdict") == "allow")
