"""Operator 5, benchmark decontamination: hashed windows of the test items,
broadcast, and probed by every window of the training texts.

A word is a run of letters, digits and non-ASCII bytes after lower-casing A-Z.
An item's windows are its runs of ``n`` words; an item of fewer words, but not
none, is one window. Hash hits are verified word by word, so the result is exact.

The hash set is broadcast in slices of at most ``SLICE_BYTES`` of item text (the
size is measured first): a benchmark beyond one slice takes as many passes, each
written to the shared folder, so what a worker holds never grows with it.

Defined results: NULL and word-less texts have no hits; NULL item ids stand as
the string "null"; repeated items each count; repeated documents are judged each
on their own. Columns of the input survive, except those named like a result
(n_words, hits, items), which are replaced. No items: no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from trendlens.llm import bytescan
from trendlens.llm.common import written

WINDOW = 10
SLICE_BYTES = 16 << 20

# The bytes of words; A-Z become a-z, all others separate.
_MAP = bytescan.LOWER_WORDS

HIT = StructType([StructField(c, LongType()) for c in ("first", "last", "start", "stop")])
FOUND = [StructField("n_words", LongType()), StructField("hits", ArrayType(HIT)),
         StructField("items", ArrayType(StringType()))]
HIT_ARROW = pa.struct([(c, pa.int64()) for c in ("first", "last", "start", "stop")])


class Windows:
    """The windows of a slice of items: per length, sorted hashes to probe and
    the windows' words with their items to verify."""

    def __init__(self, items: list[tuple[str, str]], n: int):
        self.by_length: dict[int, tuple[np.ndarray, dict[bytes, list[str]]]] = {}
        exact: dict[int, dict[bytes, list[str]]] = {}
        for item, text in items:
            words = bytes(_MAP[np.frombuffer(text.encode(), np.uint8)]).replace(b"\0", b" ").split()
            size = min(n, len(words))
            for w in {b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)} if size else ():
                exact.setdefault(size, {}).setdefault(w, []).append(item)
        for size, known in exact.items():
            texts = pa.array(list(known), pa.large_binary())
            data, offsets = bytescan.flat(texts)
            mapped = _MAP[data]
            hashes = bytescan.word_hashes(mapped, *bytescan.word_spans(mapped, offsets))
            self.by_length[size] = (np.unique(bytescan.window_hashes(hashes, size)[::size]), known)

    def probe(self, column) -> tuple[list[int], list[list[dict]], list[list[str]]]:
        """For each text: its words, hit runs (words first..last, bytes
        start..stop, ends exclusive) and the items found."""
        data, offsets = bytescan.flat(column)
        mapped = _MAP[data]
        starts, ends = bytescan.word_spans(mapped, offsets)
        hashes = bytescan.word_hashes(mapped, starts, ends)
        text_words = np.searchsorted(starts, offsets)
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(text_words))
        marks = np.zeros(len(starts) + 1, np.int64)
        items: list[set[str]] = [set() for _ in range(len(offsets) - 1)]
        for size, (keys, known) in self.by_length.items():
            probes = bytescan.window_hashes(hashes, size)
            at = np.searchsorted(keys, probes)
            at[at == len(keys)] = 0
            hit = (keys[at] == probes) & (owner[:len(probes)] == owner[size - 1:])
            for i in np.flatnonzero(hit):
                window = b" ".join(mapped[s:e].tobytes() for s, e in zip(starts[i:i + size], ends[i:i + size]))
                if found := known.get(window):
                    marks[i] += 1
                    marks[i + size] -= 1
                    items[owner[i]].update(found)
        covered = np.cumsum(marks[:-1]) > 0
        edge = covered.copy()
        edge[1:] &= ~covered[:-1] | (owner[1:] != owner[:-1])
        over = covered.copy()
        over[:-1] &= ~covered[1:] | (owner[1:] != owner[:-1])
        hits: list[list[dict]] = [[] for _ in items]
        for a, b in zip(np.flatnonzero(edge), np.flatnonzero(over)):
            t = owner[a]
            hits[t].append({"first": int(a - text_words[t]), "last": int(b + 1 - text_words[t]),
                            "start": int(starts[a] - offsets[t]), "stop": int(ends[b] - offsets[t])})
        return np.diff(text_words).tolist(), hits, [sorted(x) for x in items]


def _merged(a: list[dict], b: list[dict]) -> list[dict]:
    out: list[dict] = []
    for h in sorted([*(a or ()), *b], key=lambda h: (h["first"], h["last"])):
        if out and h["first"] <= out[-1]["last"]:
            if h["last"] > out[-1]["last"]:
                out[-1] = out[-1] | {"last": h["last"], "stop": h["stop"]}
        else:
            out.append(h)
    return out


def _pass(docs: DataFrame, items: list[tuple[str, str]], n: int, text: str, schema: StructType) -> DataFrame:
    """One pass over the documents with one slice of the items."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(shared.value, n)
        for batch in (p for b in batches for p in bytescan.pieces(b, text)):
            counts, hits, found = windows.probe(batch.column(text))
            cols = dict(zip(batch.schema.names, batch.columns))
            if "hits" in cols:  # of earlier slices
                hits = [_merged(a, b) for a, b in zip(cols["hits"].to_pylist(), hits)]
                found = [sorted({*(a or ()), *b}) for a, b in zip(cols["items"].to_pylist(), found)]
            cols |= {"n_words": pa.array(counts, pa.int64()), "hits": pa.array(hits, pa.list_(HIT_ARROW)),
                     "items": pa.array(found, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([cols[c] for c in names], names=names)

    return docs.mapInArrow(run, schema)


def find(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, text: str = "text",
         item_id: str = "item_id", item_text: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``docs`` with n_words, hits and items."""
    items = benchmark.select(F.coalesce(benchmark[item_id].cast("string"), F.lit("null")).alias("id"),
                             F.coalesce(benchmark[item_text], F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = -(-size // slice_bytes) or 1
    docs = docs.drop("n_words", "hits", "items")
    schema = StructType([*docs.schema.fields, *FOUND])
    part = F.pmod(F.xxhash64("id", "text"), F.lit(slices))
    for k in range(slices):
        rows = [tuple(r) for r in items.filter(part == k).collect()]
        docs = _pass(docs, rows, n, text, schema)
        if k + 1 < slices:
            docs = written(docs, "decontaminate")
    return docs


def cut(found: DataFrame, text: str = "text") -> DataFrame:
    """The texts without their hit runs (result columns of ``find`` dropped)."""
    whole = F.encode(F.col(text), "UTF-8")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(b"").alias("out"))
    rest = F.aggregate(
        "hits", start,
        lambda s, h: F.struct(h["stop"].alias("at"), F.concat(
            s["out"], F.substr(whole, (s["at"] + 1).cast("int"), (h["start"] - s["at"]).cast("int"))).alias("out")),
        lambda s: F.concat(s["out"], F.substr(whole, (s["at"] + 1).cast("int"))))
    kept = F.when(F.size("hits") > 0, F.decode(rest, "UTF-8")).otherwise(F.col(text))
    return found.withColumn(text, kept).drop("n_words", "hits", "items")


def n_hit() -> F.Column:
    return F.aggregate("hits", F.lit(0).cast("long"), lambda s, h: s + h["last"] - h["first"])


def remove(docs: DataFrame, benchmark: DataFrame, action: str = "span", max_hit_ratio: float = 0.5,
           **names) -> DataFrame:
    """``document``: drop contaminated documents. ``span``: cut the hit runs, and
    drop documents of which more than ``max_hit_ratio`` of the words are hit."""
    found = find(docs, benchmark, **names)
    if action == "document":
        return found.filter(F.size("hits") == 0).drop("n_words", "hits", "items")
    return cut(found.filter(n_hit() <= max_hit_ratio * F.col("n_words")), names.get("text", "text"))
