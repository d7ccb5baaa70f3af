"""Operator 8, token counts of flat token files by separator scan.

A flat file is a run of token identifiers in which an end-of-document (EOD)
identifier closes each document; nothing records where documents begin. It is
stored as rows (file, block, tokens): little-endian unsigned integers, blocks of
a fixed length that ignore document boundaries.

``scan`` searches each block's identifiers for EOD at once (numpy). A prefix scan
over block summaries then gives each block its first token's position, the number
of documents closed before it, and the place of the last EOD before it, which
stitches documents that cross blocks. The scan has two levels (blocks within
segments, segments within files), so one huge file is no single task's work.

``write_files`` makes such files from texts with a public byte-level BPE, beside
a manifest of the document ids in file order (kept apart: the scan never reads it).

Defined results: NULL and empty texts are documents of 0 tokens; tokens after the
last EOD are a document that is not ``closed``; an empty block closes nothing; a
missing table has no documents; repeated ids are counted each. Special-token
strings inside texts are encoded as ordinary text. Extra columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from trendlens.session import shared_dir

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern that belongs to that vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
EOD = 50256
BLOCK = 1 << 16
SEGMENT = 1 << 10
FILE_SCHEMA = "kind string, file long, block long, tokens binary, ids array<long>"
MANIFEST_CHUNK = 4096


def _encoding(vocabulary: bytes, pattern: str):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def write_files(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN, eod: int = EOD,
                block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(tokens, manifest), written to the shared folder and read back. Each task
    writes one file; a block and the texts of one batch are all it holds."""
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, file = _encoding(shared.value, pattern), TaskContext.get().partitionId()
        rest, n_blocks, n_ids = np.zeros(0, "<u2"), 0, 0

        def rows(kind, at, tokens, ids):
            return pa.RecordBatch.from_arrays([
                pa.array([kind] * len(at)), pa.array([file] * len(at), pa.int64()), pa.array(at, pa.int64()),
                pa.array(tokens, pa.binary()), pa.array(ids, pa.list_(pa.int64()))],
                names=["kind", "file", "block", "tokens", "ids"])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i in range(0, len(ids), 256):
                texts = [t or "" for t in batch.column(1)[i:i + 256].to_pylist()]
                parts = [rest]
                for text in texts:
                    parts += [np.array(enc.encode_ordinary(text), "<u2"), np.array([eod], "<u2")]
                flat = np.concatenate(parts)
                full = len(flat) // block
                if full:
                    yield rows("tokens", range(n_blocks, n_blocks + full),
                               [flat[b * block:(b + 1) * block].tobytes() for b in range(full)], [None] * full)
                n_blocks, rest = n_blocks + full, flat[full * block:]
            for i in range(0, len(ids), MANIFEST_CHUNK):
                yield rows("manifest", [n_ids + i], [None], [ids[i:i + MANIFEST_CHUNK]])
            n_ids += len(ids)
        if len(rest):
            yield rows("tokens", [n_blocks], [rest.tobytes()], [None])

    path = shared_dir(spark, "llm", "tokens", fresh=True)
    docs.select(docs[id_col].cast("long"), docs[text_col]).mapInArrow(run, FILE_SCHEMA) \
        .write.partitionBy("kind").option("compression", "zstd").parquet(path)
    back = spark.read.schema(FILE_SCHEMA).parquet(path)
    manifest = back.filter("kind = 'manifest'").select("file", F.col("block").alias("first"), F.posexplode("ids")) \
        .select("file", (F.col("first") + F.col("pos")).alias("ordinal"), F.col("col").alias(id_col))
    return back.filter("kind = 'tokens'").select("file", "block", "tokens"), manifest


def separators(tokens: DataFrame, eod: int = EOD, dtype: str = "<u2") -> DataFrame:
    """(file, block, n, ends): the block's length and the places of its EODs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [np.frombuffer(b or b"", dtype) for b in batch.column(2).to_pylist()]
            sizes = [len(c) for c in cells]
            flat = np.concatenate(cells) if cells else np.zeros(0, dtype)
            found = np.flatnonzero(flat == eod)
            first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            cut = np.searchsorted(found, first)
            ends = found - np.repeat(first[:-1], np.diff(cut))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(ends, pa.int64()))],
                names=["file", "block", "n", "ends"])

    return tokens.select("file", "block", "tokens").mapInArrow(
        run, "file long, block long, n long, ends array<long>")


def _prefix(df: DataFrame, by: list[str], order: str, n: str, k: str, last: str) -> DataFrame:
    """Exclusive prefix sums of ``n`` and ``k``, and the last EOD before (-1:
    none) from places ``last`` relative to the row."""
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    based = df.withColumn("_base", F.coalesce(F.sum(n).over(before), F.lit(0))).withColumn(
        "_closed", F.coalesce(F.sum(k).over(before), F.lit(0)))
    return based.withColumn("_prev", F.max(F.col("_base") + F.col(last)).over(before))


def scan(tokens: DataFrame, eod: int = EOD, dtype: str = "<u2", segment: int = SEGMENT) -> DataFrame:
    """(file, ordinal, start, n_tokens, closed): one row per document of the files."""
    found = separators(tokens, eod, dtype).withColumn("segment", F.floor(F.col("block") / segment)) \
        .withColumn("k", F.size("ends").cast("long")).withColumn("last", F.element_at("ends", -1)) \
        .withColumn("last", F.when(F.col("k") > 0, F.col("last")))
    inner = _prefix(found, ["file", "segment"], "block", "n", "k", "last")
    totals = inner.groupBy("file", "segment").agg(
        F.sum("n").alias("n"), F.sum("k").alias("k"), F.max(F.col("_base") + F.col("last")).alias("last"))
    outer = _prefix(totals, ["file"], "segment", "n", "k", "last").select(
        "file", "segment", F.col("_base").alias("seg_base"), F.col("_closed").alias("seg_closed"),
        F.col("_prev").alias("seg_prev"))
    base = F.col("seg_base") + F.col("_base")
    placed = inner.join(outer, ["file", "segment"]).select(
        "file", F.transform("ends", lambda e: e + base).alias("ends"),
        (F.col("seg_closed") + F.col("_closed")).alias("closed"),
        F.coalesce(F.col("_prev") + F.col("seg_base"), "seg_prev", F.lit(-1)).alias("prev"))
    docs = placed.select("file", "closed", F.posexplode(F.zip_with(
        "ends", F.concat(F.array("prev"), "ends"), lambda e, p: F.struct(e.alias("end"), p.alias("prev"))))) \
        .filter(F.col("col.end").isNotNull())
    whole = docs.select(
        "file", (F.col("closed") + F.col("pos")).alias("ordinal"), (F.col("col.prev") + 1).alias("start"),
        (F.col("col.end") - F.col("col.prev") - 1).alias("n_tokens"), F.lit(True).alias("closed"))
    tail = totals.groupBy("file").agg(F.sum("k").alias("k"), F.sum("n").alias("n")).join(
        outer.join(totals, ["file", "segment"]).groupBy("file").agg(
            F.max(F.coalesce(F.col("seg_base") + F.col("last"), F.lit(-1))).alias("end")), "file") \
        .filter(F.col("n") > F.col("end") + 1).select(
            "file", F.col("k").alias("ordinal"), (F.col("end") + 1).alias("start"),
            (F.col("n") - F.col("end") - 1).alias("n_tokens"), F.lit(False).alias("closed"))
    return whole.unionByName(tail)
