"""Operator 11, near-duplicate components by SimHash and pigeonhole blocks.

A text's features are its ``SHINGLE``-word shingles, repeats included; bit j of
its fingerprint is set if over half of the shingles' hashes have it set.
Fingerprints that differ in at most ``DISTANCE`` bits are linked.

1. Equal fingerprints are one node, so copies cost nothing from here on.
2. The 64 bits are cut into ``BLOCKS`` blocks. Two close fingerprints agree in all
   blocks but ``DISTANCE`` at least, so each node goes to one bucket for every
   choice of the other blocks (10 buckets of 38 or 39 bits each); buckets of one
   node are dropped.
3. In buckets of at most ``BIG`` nodes, nodes are joined on the bucket and the
   Hamming distance is verified by the join's condition.
4. A larger bucket (many fingerprints in one small region) would cost its square.
   Its nodes are cut again, to blocks of one bit: each goes to the 65 points
   within one bit of it. Two nodes share a point exactly if they differ in at most
   two bits, and a point has at most 65 nodes, which are linked in a star.
5. Links are contracted to components.
6. Documents take the component of their fingerprint. Fingerprints that more than
   one in ``HOT`` documents share are fewer than ``HOT``; these are broadcast, so the
   copies of one text are never dealt to one task.

Every step is exact: no link between two fingerprints is lost, and nothing
grows with the square of a group.

Defined results: NULL, empty and blank texts have fingerprint zero, which links
like any other; texts of one or two words have one shingle, the whole sequence.
``component_id`` is the lowest doc_id that has a fingerprint of the component, NULL
if none has one; a row without a doc_id keeps its fingerprint and its component.
Rows of one doc_id are judged apart, each by its own text. Extra columns are
ignored.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from trendlens.llm import bytescan
from trendlens.llm.common import written
from trendlens.llm.minhash import components

SHINGLE = 3
SEED = 42
DISTANCE = 2
BLOCKS = 5
BIG = 64
HOT = 1000
BITS = 64
BLOCK_BYTES = 1 << 20

_WHITE = re.compile(rb"[\x20\x09-\x0D]")
_LANES = np.uint64(0x0101010101010101)
_SHIFTS = np.arange(8, dtype=np.uint64)[:, None]


def word_blocks(raw: bytes, size: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The words of a text in lower case, in blocks of about ``size`` bytes, so
    that the words of a very long text are never all held as objects."""
    at = 0
    while at < len(raw):
        cut = _WHITE.search(raw, at + size) if at + size < len(raw) else None
        stop = cut.start() if cut else len(raw)
        yield raw[at:stop].lower().split()
        at = stop


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set. Eight bits at a time are summed
    in the bytes of one integer, over at most 255 hashes."""
    lanes = (hashes[None, :] >> _SHIFTS) & _LANES
    sums = np.add.reduceat(lanes, np.arange(0, len(hashes), 255), axis=1)
    return sums.view(np.uint8).reshape(8, -1, 8).sum(axis=1, dtype=np.int64).T.ravel()


def fingerprint(raw: bytes, block: int = BLOCK_BYTES) -> int:
    """The fingerprint of a text in UTF-8, as an unsigned integer."""
    digest = xxhash.xxh64_intdigest
    total, n, held = np.zeros(BITS, np.int64), 0, []

    def add(shingles) -> None:
        nonlocal n
        hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
        if len(hashes):
            total[:] += bit_counts(hashes)
            n += len(hashes)

    for words in word_blocks(raw, block):
        held += words
        add(map(b" ".join, zip(held, held[1:], held[2:])))
        held = held[-(SHINGLE - 1):]
    if not n and held:
        add([b" ".join(held)])
    return int.from_bytes(np.packbits(2 * total > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint): one row for each row, the fingerprint as a long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in bytescan.pieces(b, 1)):
            texts = pc.fill_null(batch.column(1).cast(pa.large_binary()), b"")
            found = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))],
                                             names=["doc_id", "fingerprint"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text].alias("text")).mapInArrow(
        run, "doc_id long, fingerprint long")


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def block_masks(blocks: int = BLOCKS, distance: int = DISTANCE) -> list[int]:
    """One mask for each choice of all blocks but ``distance``."""
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    own = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in itertools.combinations(own, blocks - distance)]


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def in_blocks(nodes: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """(bucket, fingerprint, n): the buckets of two nodes or more."""
    keys = [F.struct(F.lit(i).alias("choice"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("bits"))
            for i, m in enumerate(block_masks(blocks))]
    rows = nodes.select("fingerprint", F.explode(F.array(*keys)).alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    return written(rows.join(shared, "bucket"), "simhash-blocks")


def close_pairs(rows: DataFrame) -> DataFrame:
    """(a, b): nodes that share a bucket and differ in at most ``DISTANCE`` bits."""
    left = rows.select("bucket", F.col("fingerprint").alias("a"))
    right = rows.select("bucket", F.col("fingerprint").alias("b"))
    return left.join(right, "bucket").filter((F.col("a") < F.col("b")) & (_apart("a", "b") <= DISTANCE)).select("a", "b")


def stars(nodes: DataFrame) -> DataFrame:
    """(a, b): links that join all nodes at most two bits apart, through the
    points within one bit of a node."""
    points = [F.col("fingerprint"), *(F.col("fingerprint").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(BITS))]
    met = nodes.select("fingerprint", F.explode(F.array(*points)).alias("point")).groupBy("point").agg(
        F.collect_list("fingerprint").alias("around")).filter(F.size("around") > 1)
    return met.select(F.array_min("around").alias("a"), F.explode("around").alias("b")).filter("a <> b")


def links(nodes: DataFrame, blocks: int = BLOCKS, big: int = BIG) -> DataFrame:
    """(a, b): links between different fingerprints that join every two nodes at
    most ``DISTANCE`` bits apart."""
    rows = in_blocks(nodes, blocks)
    pairs = close_pairs(rows.filter(F.col("n") <= big))
    return pairs.unionByName(stars(rows.filter(F.col("n") > big).select("fingerprint").distinct())).distinct()


def cluster(docs: DataFrame, id_col: str = "doc_id", text: str = "text", blocks: int = BLOCKS,
            big: int = BIG) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row for each row of ``docs``."""
    marked = written(fingerprints(docs, id_col, text), "simhash-fingerprints")
    nodes = written(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "simhash-nodes")
    joined = written(links(nodes.select("fingerprint"), blocks, big).select(
        F.col("a").alias("doc_id"), F.col("b").alias("leader")), "simhash-links")
    labelled = nodes.join(components(joined).withColumnRenamed("node", "fingerprint"), "fingerprint")
    lowest = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    linked = labelled.join(lowest, "label").select("fingerprint", "component_id")
    table = nodes.join(linked, "fingerprint", "left").select(
        "fingerprint", F.coalesce("component_id", "first").alias("component_id"), "n")
    return _with_components(marked, written(table, "simhash-components"))


def _with_components(marked: DataFrame, table: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) of all documents."""
    hot = F.broadcast(table.filter(F.col("n") * HOT > marked.count()).select("fingerprint", "component_id"))
    copies = marked.join(hot, "fingerprint")
    others = marked.join(hot, "fingerprint", "left_anti").join(table, "fingerprint")
    return copies.select("doc_id", "fingerprint", "component_id").unionByName(
        others.select("doc_id", "fingerprint", "component_id"))


def as_hex(c: Column) -> Column:
    return F.lpad(F.lower(F.hex(c)), 16, "0")
