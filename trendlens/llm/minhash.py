"""Operator 3, near-duplicate groups by DartMinHash.

A document is the multiset of its five-word shingles. Darts are thrown into the
plane of (shingle weight x rank) by a hash, so equal weighted regions receive
equal darts in every document; each of ``COORDS`` coordinates keeps its earliest
dart. Two documents agree in a coordinate with the probability of their weighted
Jaccard similarity. Ranks are scanned in doubling layers until every coordinate
has a dart, which costs about COORDS x ln(COORDS) darts for a text of any length.

1. Equal word sequences are one text: its lowest doc_id goes on alone.
2. ``BANDS`` bands of ``ROWS`` coordinates put texts into buckets.
3. Each text of a bucket is compared with one leader, the text that shares most
   buckets with others; the comparison uses four bits of each coordinate.
4. Candidates are verified exactly on the whole texts: weighted Jaccard >= 0.8.
5. Links are contracted to classes by minimum labels and pointer jumping.
6. Two texts of a bucket that are of one class by verified links need no further
   comparison; all others do, in the first bucket that they share. In each bucket the
   texts outside its most frequent class are compared with all of another class: by the same codes, and those
   that pass by a sketch (the shingles in ``BINS`` bins, four bits of the least hash
   of each), which is about exact for short texts. Candidates are verified exactly.
   Of one text's candidates in one class the most similar come first (``MOST``); if
   some were put off, the classes are made anew and all that is left is taken.

A text never leaves a bucket by an estimate, so recall is that of the bands and of
the two comparisons: a pair of similarity 0.8 shares no bucket with probability
(1 - 0.8**5)**25 = 5e-5, agrees in fewer than ``CANDIDATE`` codes with 1e-4, and has
a sketch below ``CLOSE`` with 1e-5. Nothing is capped or sampled. Equal or near
copies of one text meet their leader only; texts that are alike but not linked (0.7,
say) are compared in pairs, by codes and sketches, as far as they share buckets. A
bucket of up to ``BLOCK`` texts is compared where it lies, each of its texts one row;
a larger one is dealt to tiles of ``BLOCK`` by ``BLOCK`` texts, so that a hot bucket is
many tasks.

Defined results: texts without a word (NULL, empty, symbols only) are classes of
their own; texts of one to four words have one shingle, all their words; NULL
doc_ids take no part; repeated doc_ids are one document (the least of its texts
stands for it). ``class_id`` is the lowest doc_id of the class.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from trendlens.llm import bytescan
from trendlens.llm.bytescan import mix
from trendlens.llm.common import written

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
COORDS = BANDS * ROWS
CODE_WORDS = 8  # 16 four-bit codes each
# Agreeing codes (of 125): a pair of similarity 0.8 has 101.6 +- 4.4.
CANDIDATE = 85
BINS = 1024
FINE_WORDS = BINS // 16
# The least similarity by sketches: a pair of 0.8 has 0.8 +- 0.0125, or less of an error.
CLOSE = 0.745
BLOCK = 4096
MOST = (4, None)

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_NIBBLES = np.uint64(0x1111111111111111)
_MASK = 2**64 - 1
_FIRST_LAYER = -6  # ranks [0, 2**-6), then doubling layers


def _layer_cdf(layer: int) -> np.ndarray:
    """The Poisson distribution of the darts that a unit weight has in a layer."""
    rate = 2.0 ** (_FIRST_LAYER + max(0, layer - 1))
    out, p, total = [], math.exp(-rate), 0.0
    for n in range(int(rate + 12 * math.sqrt(rate) + 20)):
        total += p
        out.append(total)
        p *= rate / (n + 1)
    return np.array(out)


def shingles(column) -> tuple[np.ndarray, np.ndarray, list[bytes | None]]:
    """(text number, shingle hash) of every shingle, repeats included, and each
    text's 16-byte key of its word sequence (None without words)."""
    data, offsets = bytescan.flat(column)
    mapped = bytescan.LOWER_WORDS[data]
    starts, ends = bytescan.word_spans(mapped, offsets)
    words = bytescan.word_hashes(mapped, starts, ends)
    at = np.searchsorted(starts, offsets)
    count = np.diff(at)
    owner = np.repeat(np.arange(len(count)), count)
    windows = bytescan.window_hashes(words, SHINGLE)
    inside = owner[:len(windows)] == owner[SHINGLE - 1:] if len(windows) else np.zeros(0, bool)
    texts, hashes = [owner[:len(windows)][inside]], [windows[inside]]
    for n in range(1, SHINGLE):
        short = np.flatnonzero(count == n)
        if len(short):
            texts.append(short)
            hashes.append(bytescan.window_hashes(words, n)[at[short]] + np.uint64(n))
    keys = [hashlib.blake2b(b" ".join(mapped[offsets[i]:offsets[i + 1]].tobytes().replace(b"\0", b" ").split()),
                            digest_size=16).digest() if count[i] else None for i in range(len(count))]
    return np.concatenate(texts), np.concatenate(hashes), keys


def _weighted(texts: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight), sorted by text and shingle."""
    order = np.lexsort((hashes, texts))
    t, h = texts[order], hashes[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    first = np.flatnonzero(new)
    return t[first], h[first], np.diff(np.append(first, len(t)))


def cells(texts: np.ndarray, hashes: np.ndarray, weights: np.ndarray | None = None):
    """(text, hash, height) of the weighted elements cut into cells of weight one
    (and a last, lower one where a weight is no whole number). Without ``weights`` an
    element weighs as often as it occurs."""
    if weights is None:
        t, h, w = _weighted(texts, hashes)
        full, rest = w, np.zeros(0)
    else:
        t, h, w = texts, hashes, np.asarray(weights, float)
        full, rest = np.ceil(w).astype(np.int64), np.floor(w) < w
    unit = np.arange(int(full.sum())) - np.repeat(np.cumsum(full) - full, full)
    height = np.ones(len(unit))
    if len(rest):
        last = np.cumsum(full)[rest] - 1
        height[last] = (w - np.floor(w))[rest]
    return np.repeat(t, full), mix(np.repeat(h, full) + unit.astype(np.uint64) * _GOLD), height


def darts(texts: np.ndarray, hashes: np.ndarray, n_texts: int, coords: int = COORDS,
          weights: np.ndarray | None = None) -> np.ndarray:
    """The earliest dart of each coordinate, (n_texts, coords); 0 rows for texts
    without shingles."""
    return _thrown(*cells(texts, hashes, weights), n_texts, coords)


def _thrown(t: np.ndarray, h: np.ndarray, height: np.ndarray, n_texts: int, coords: int) -> np.ndarray:
    signature = np.zeros(n_texts * coords, np.uint64)
    whole = bool((height == 1).all())
    layer = 0
    while len(t):
        u = mix(h ^ np.uint64((layer + 1) * 0xD6E8FEB86659FD93 & _MASK))
        n = np.searchsorted(_layer_cdf(layer), (u >> np.uint64(11)) * 2.0 ** -53, side="right")
        some = np.flatnonzero(n)
        n = n[some]
        nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        dart = mix(np.repeat(u[some], n) + (nth.astype(np.uint64) + np.uint64(1)) * _GOLD) | np.uint64(1)
        owner = np.repeat(t[some], n)
        if not whole:  # a dart counts if it lies below the height of its cell
            low = (mix(dart + _GOLD) >> np.uint64(11)) * 2.0 ** -53 < np.repeat(height[some], n)
            dart, owner = dart[low], owner[low]
        slot = owner * coords + ((dart >> np.uint64(32)) % np.uint64(coords)).astype(np.int64)
        free = signature[slot] == 0
        slot, dart = slot[free], dart[free]
        order = np.lexsort((mix(dart), slot))  # ranks within a layer are uniform
        slot, dart = slot[order], dart[order]
        first = np.ones(len(slot), bool)
        first[1:] = slot[1:] != slot[:-1]
        signature[slot[first]] = dart[first]
        open_texts = (signature.reshape(n_texts, coords) == 0).any(axis=1)
        left = open_texts[t]
        t, h, height = t[left], h[left], height[left]
        layer += 1
    return signature.reshape(n_texts, coords)


def sketches(t: np.ndarray, h: np.ndarray, n_texts: int) -> np.ndarray:
    """For each text the cells' hashes in ``BINS`` bins: four bits of each bin's least
    one, 0 for an empty bin, 16 to a word."""
    least = np.full(n_texts * BINS, _MASK, np.uint64)
    np.minimum.at(least, t * BINS + (h >> np.uint64(54)).astype(np.int64), h)
    nibble = np.where(least == np.uint64(_MASK), np.uint64(0), np.uint64(1) + mix(least) % np.uint64(15))
    shift = np.arange(16, dtype=np.uint64) * np.uint64(4)
    return (nibble.reshape(n_texts, FINE_WORDS, 16) << shift).sum(axis=2, dtype=np.uint64)


def _marked(words: np.ndarray) -> np.ndarray:
    """One bit for each nibble that is not zero."""
    words = words | words >> np.uint64(2)
    return (words | words >> np.uint64(1)) & _NIBBLES


def close_by_sketch(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The estimated similarity of texts, row by row of their sketches: of the bins
    that either fills, the share that agrees."""
    in_a, in_b = _marked(a), _marked(b)
    same = np.bitwise_count(in_a & in_b & ~_marked(a ^ b)).sum(axis=1, dtype=np.int64)
    return same / np.maximum(np.bitwise_count(in_a | in_b).sum(axis=1, dtype=np.int64), 1)


def _bands(signature: np.ndarray) -> np.ndarray:
    parts = signature.reshape(len(signature), BANDS, ROWS)
    out = np.zeros(parts.shape[:2], np.uint64)
    for j in range(ROWS):
        out = out * _GOLD + parts[:, :, j]
    return mix(out + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _codes(signature: np.ndarray) -> np.ndarray:
    nibbles = np.zeros((len(signature), CODE_WORDS * 16), np.uint64)
    nibbles[:, :signature.shape[1]] = (mix(signature) >> np.uint64(8)) & np.uint64(15)
    shift = np.arange(16, dtype=np.uint64) * np.uint64(4)
    return (nibbles.reshape(-1, CODE_WORDS, 16) << shift).sum(axis=2, dtype=np.uint64).view(np.int64)


def _lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel()))


def signatures(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, key, bands, code, fine) of every document that has a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in bytescan.pieces(b, 1)):
            texts, hashes, keys = shingles(batch.column(1))
            t, h, height = cells(texts, hashes)
            sig, fine = _thrown(t, h, height, batch.num_rows, COORDS), sketches(t, h, batch.num_rows)
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), _lists(_bands(sig)), _lists(_codes(sig)),
                 _lists(fine.view(np.int64))], names=["doc_id", "key", "bands", "code", "fine"])
            yield out.filter(pa.array([k is not None for k in keys]))

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text].alias("text")).filter(
        F.col("doc_id").isNotNull()).mapInArrow(run, "doc_id long, key binary, bands array<long>, code array<long>, fine array<long>")


def _agreeing(a: str, b: str) -> Column:
    """Equal four-bit codes of two code arrays (the padding always agrees)."""
    total = F.lit(COORDS - CODE_WORDS * 16)
    for i in range(CODE_WORDS):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        total = total + 16 - F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return total


def _buckets(texts: DataFrame) -> DataFrame:
    """(bucket, band, doc_id, n) of the buckets of two texts or more."""
    rows = texts.select("doc_id", F.posexplode("bands").alias("band", "h"))
    shared = rows.groupBy("band", "h").agg(F.count("*").alias("n")).filter("n > 1")
    return written(rows.join(shared, ["band", "h"]).select(F.xxhash64("band", "h").alias("bucket"), "band", "doc_id", "n"),
                   "minhash-buckets")


def candidates(texts: DataFrame, met: DataFrame | None = None) -> DataFrame:
    """Pairs (doc_id, leader) of texts (doc_id, bands, code) with their buckets' leaders."""
    met = _buckets(texts) if met is None else met
    score = met.groupBy("doc_id").agg(F.sum(F.log2("n")).alias("score"))
    rows = met.join(texts.select("doc_id", "code").join(score, "doc_id"), "doc_id")
    leader = rows.groupBy("bucket").agg(
        F.max(F.struct("score", (-F.col("doc_id")).alias("neg"), F.col("code").alias("leader_code"))).alias("l"))
    return rows.join(leader, "bucket").select(
        "doc_id", "code", (-F.col("l.neg")).alias("leader"), F.col("l.leader_code").alias("leader_code")) \
        .filter("doc_id <> leader").filter(_agreeing("code", "leader_code") >= CANDIDATE) \
        .select("doc_id", "leader").distinct()


LEFT, RIGHT = 1, 2
SLICE = 256  # texts of the left side compared at once


def _across(ids: np.ndarray, labels: np.ndarray, role: np.ndarray, band: np.ndarray, codes: np.ndarray, fine: np.ndarray,
            bands: np.ndarray, most: int | None):
    """(doc, other, more) of the candidates of one tile: left texts with right
    texts of another label that share no bucket of an earlier band (there they have
    met already). ``more`` marks a place after the ``most`` best that a text has in one
    label."""
    left, right = np.flatnonzero(role & LEFT), np.flatnonzero(role & RIGHT)
    found = []
    for at in range(0, len(left), SLICE):
        li = left[at:at + SLICE]
        agree = np.full((len(li), len(right)), COORDS - CODE_WORDS * 16, np.int16)
        for i in range(CODE_WORDS):
            x = codes[li, i][:, None] ^ codes[right, i][None, :]
            x |= x >> np.uint64(2)
            x |= x >> np.uint64(1)
            agree += 16 - np.bitwise_count(x & _NIBBLES).astype(np.int16)
        a, b = np.nonzero((agree >= CANDIDATE) & (labels[li][:, None] != labels[right][None, :]))
        a, b = li[a], right[b]
        for k in range(0, len(a), 1 << 14):
            x, y = a[k:k + (1 << 14)], b[k:k + (1 << 14)]
            here = ~(bands[x, :band[0]] == bands[y, :band[0]]).any(axis=1)
            x, y = x[here], y[here]
            near = close_by_sketch(fine[x], fine[y])
            good = near >= CLOSE
            found.append((x[good], y[good], near[good]))
    a, b, near = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    order = np.lexsort((ids[b], -near, labels[b], a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (labels[b[1:]] != labels[b[:-1]])
    first = np.flatnonzero(new)
    rank = np.arange(len(a)) - np.repeat(first, np.diff(np.append(first, len(a))))
    most = len(a) if most is None else most
    kept = rank <= most
    return ids[a[kept]], ids[b[kept]], rank[kept] == most


def across(texts: DataFrame, met: DataFrame, labels: DataFrame, most: int | None) -> DataFrame:
    """(doc_id, leader, more): candidates of different labels within a bucket.

    Buckets of two texts are done by their leader. Of the others, texts outside
    the most frequent label (k of n) are compared with all. Up to ``BLOCK`` texts are
    one tile and each text one row; of more, the k are dealt to k / BLOCK rows of tiles
    and the n to n / BLOCK columns."""
    rows = met.filter("n > 2").join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "bucket", "band", "doc_id", "n", F.coalesce("label", "doc_id").alias("label"))
    home = rows.groupBy("bucket", "label").agg(F.count("*").alias("c")).groupBy("bucket").agg(
        F.max(F.struct("c", "label")).alias("most"), F.count("*").alias("labels")).filter("labels > 1").select(
        "bucket", F.col("most.label").alias("home"), F.col("most.c").alias("c"))

    def blocks(n):
        return F.ceil(n / F.lit(BLOCK)).cast("int")

    def tile(i, j, role):
        return F.struct(F.xxhash64("bucket", i, j).alias("tile"), F.lit(role).alias("role"))

    at_home = F.col("label") == F.col("home")
    down, along = blocks(F.col("n") - F.col("c")), blocks(F.col("n"))
    own = F.xxhash64("doc_id")
    row, column = F.pmod(own, down).cast("int"), F.pmod(own, along).cast("int")
    as_right = F.transform(F.sequence(F.lit(0), down - 1), lambda i: tile(i, column, RIGHT))
    as_left = F.transform(F.sequence(F.lit(0), along - 1), lambda j: tile(row, j, LEFT))
    here = F.array(F.struct(F.col("bucket").alias("tile"), F.when(at_home, RIGHT).otherwise(LEFT | RIGHT).alias("role")))
    dealt = rows.join(home, "bucket").select(
        "band", "doc_id", "label", F.explode(F.when(F.col("n") <= BLOCK, here).when(at_home, as_right)
                                     .otherwise(F.concat(as_right, as_left))).alias("t")) \
        .join(texts.select("doc_id", "code", "fine", "bands"), "doc_id") \
        .select("t.tile", "t.role", "band", "doc_id", "label", "code", "fine", "bands").repartition("tile") \
        .sortWithinPartitions("tile")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(tiles, *columns):
            cuts = [0, *(np.flatnonzero(np.diff(tiles)) + 1).tolist(), len(tiles)]
            parts = [_across(*(c[a:b] for c in columns), most) for a, b in zip(cuts, cuts[1:])]
            a, b, more = (np.concatenate(x) for x in zip(*parts))
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b)), pa.array(more)],
                                              names=["doc_id", "leader", "more"])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            tiles, role, band, ids, labels = (batch.column(i).to_numpy() for i in range(5))
            codes, fine, bands = (batch.column(i).flatten().to_numpy().view(np.uint64).reshape(len(ids), -1) for i in (5, 6, 7))
            now = (tiles, ids, labels, role, band, codes, fine, bands)
            if held is not None:
                now = tuple(np.concatenate(x) for x in zip(held, now))
            last = int(np.searchsorted(now[0], now[0][-1]))  # the last tile may go on
            if last:
                yield found(*(x[:last] for x in now))
            held = tuple(x[last:].copy() for x in now)
        if held is not None:
            yield found(*held)

    return dealt.mapInArrow(run, "doc_id long, leader long, more boolean")


def linked(texts: DataFrame, docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """Verified links (doc_id, leader) that join all texts of a class."""
    met = _buckets(texts)
    tested = written(candidates(texts, met), "minhash-pairs")
    links = written(verified(tested, docs, id_col, text), "minhash-links")
    for most in MOST:
        found = written(across(texts, met, components(links), most), "minhash-across")
        pairs = found.filter("not more").select("doc_id", "leader").distinct()
        before = tested.select(F.greatest("doc_id", "leader").alias("doc_id"), F.least("doc_id", "leader").alias("leader"))
        pairs = written(pairs.join(before, ["doc_id", "leader"], "left_anti"), "minhash-pairs")
        links = links.unionByName(written(verified(pairs, docs, id_col, text), "minhash-links"))
        if found.filter("more").isEmpty():
            break
        tested = tested.unionByName(pairs)
    return links


def similarity(left, right) -> np.ndarray:
    """Weighted Jaccard similarity of two columns of texts, row by row."""
    a_t, a_h, _ = shingles(left)
    b_t, b_h, _ = shingles(right)
    n = len(left)
    sides = []
    for t, h in ((a_t, a_h), (b_t, b_h)):
        sides.append(_weighted(t, h))
    t = np.concatenate([s[0] for s in sides])
    h = np.concatenate([s[1] for s in sides])
    w = np.concatenate([s[2] for s in sides])
    order = np.lexsort((h, t))
    t, h, w = t[order], h[order], w[order]
    same = np.flatnonzero((t[1:] == t[:-1]) & (h[1:] == h[:-1]))
    both = np.bincount(t[same], np.minimum(w[same], w[same + 1]), n)
    total = np.bincount(t, w, n)
    return both / np.maximum(total - both, 1)


def verified(pairs: DataFrame, docs: DataFrame, id_col: str, text: str, least: float = SIMILARITY) -> DataFrame:
    """The pairs whose whole texts have that similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in bytescan.pieces(b, 2, 1 << 20)):
            good = similarity(batch.column(2), batch.column(3)) >= least
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)],
                                             names=["doc_id", "leader"]).filter(pa.array(good))

    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text].alias("text"))
    own = pairs.join(texts, "doc_id")
    both = own.join(texts.select(F.col("doc_id").alias("leader"), F.col("text").alias("leader_text")), "leader")
    return both.select("doc_id", "leader", "text", "leader_text").mapInArrow(run, "doc_id long, leader long")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the lowest node of each linked node's component. Every
    round's labels are written; rounds end when no label changes."""
    edges = written(links.unionByName(links.select(F.col("leader").alias("doc_id"), F.col("doc_id").alias("leader")))
                    .distinct().toDF("a", "b"), "components-edges")
    labels = edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    labels = written(labels, "components")
    while True:
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        step = lower.alias("s").join(labels.select(F.col("node").alias("n"), F.col("label").alias("far")),
                                     F.col("s.label") == F.col("n"), "left")
        after = written(step.select("node", "old", F.least("s.label", F.coalesce("far", "s.label")).alias("label")),
                        "components")
        labels = after.select("node", "label")
        if after.filter("label <> old").isEmpty():
            return labels


def one_text(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(doc_id, text): one row for each doc_id that is not NULL, with the least of its
    texts."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text].alias("text")).filter("doc_id is not null")
    again = rows.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if again.isEmpty():
        return rows
    again = written(again, "minhash-repeated-ids")
    least = rows.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    return rows.join(again, "doc_id", "left_anti").unionByName(least)


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id): one row for each doc_id."""
    docs = one_text(docs, id_col, text)
    sigs = written(signatures(docs), "minhash-signatures")
    texts = sigs.groupBy("key").agg(F.min(F.struct("doc_id", "bands", "code", "fine")).alias("m")).select("key", "m.*")
    found = linked(texts.select("doc_id", "bands", "code", "fine"), docs, "doc_id", "text")
    copies = sigs.select("doc_id", "key").join(
        texts.select("key", F.col("doc_id").alias("leader")), "key").select("doc_id", "leader").filter("doc_id <> leader")
    labels = components(written(found.unionByName(copies), "minhash-links"))
    ids = docs.select("doc_id")
    return ids.join(labels, ids["doc_id"] == labels["node"], "left").select(
        "doc_id", F.coalesce("label", "doc_id").alias("class_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class (that of the lowest doc_id; of several such rows,
    the least by text), with all columns. Rows without a doc_id stay."""
    first = classes(docs, id_col, text).filter("doc_id = class_id").select(F.col("doc_id").alias("_kept"))
    kept = docs.join(first, docs[id_col].cast("long") == first["_kept"], "left_semi")
    if not docs.groupBy(id_col).count().filter((F.col("count") > 1) & docs[id_col].isNotNull()).isEmpty():
        by = Window.partitionBy(docs[id_col]).orderBy(F.asc_nulls_last(docs[text]))
        kept = kept.withColumn("_nth", F.row_number().over(by)).filter("_nth = 1").drop("_nth")
    return kept.unionByName(docs.filter(docs[id_col].isNull()))
