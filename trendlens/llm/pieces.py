"""Operator 10, SentencePiece encoding and decoding over a relational lattice.

Texts are read once, into chunks of word numbers; the different words of all
chunks make one table. The lattice of a word is built by Spark: its bounded
substrings are exploded, joined by equality to the piece table (by a 64-bit key,
and then by the string itself), and grouped by word. A higher-order ``aggregate``
then folds each word's edges:

* ``viterbi``: the path of the highest total score, for unigram piece tables;
* ``merges``: for BPE piece tables, whose scores are merge ranks, not
  likelihoods: each step takes the best edge that joins two neighbours, and the
  edges that cross it disappear. This gives the public library's own result,
  which a highest-scoring path does not (see README).

The model's own type picks the fold. The segmented words go back to the chunks
that hold them, and the word numbers are replaced by piece ids there.

A word is a run of letters or of other characters with the spaces before it; no
piece crosses such a boundary (checked against the table when it is loaded), so
words can be segmented apart. Runs of over ``LONGEST`` characters would make
lattices without bound; they are segmented in the task, with the same result, by a
heap (BPE) or a running Viterbi (unigram). Characters without a piece become byte
pieces.

Defined results: NULL texts have NULL pieces and decode to NULL; empty texts have
no pieces; U+2581 in a text decodes to a space, as in the library; repeated rows
are encoded each. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
LONGEST = 48
CHUNK_CHARS = 32 << 20  # the larger the chunks, the fewer times a word travels
NTH_BITS, COUNTER_BITS = 30, 13  # of a word's place: partition, chunk in it, word in that
BATCH_WORDS = 1 << 16  # words replaced at once
PLANE = 1 << 20  # numbers packed at once
MAX_BROADCAST_BYTES = 64 << 20  # a larger piece table is joined by a shuffle
UNKNOWN = 10.0  # a character without a piece is that much below the lowest score
_LETTER = r"[^\W\d_{not_letters}]"


@dataclass(frozen=True)
class Model:
    """A piece table: (piece, score, id) of the ordinary pieces, the id of byte
    0, the bytes that each id decodes to, and the pattern of words."""
    kind: str
    rows: tuple[tuple[str, float, int], ...]
    byte_base: int
    decoded: tuple[bytes, ...]
    words: str
    longest_piece: int

    @property
    def unknown(self) -> float:
        """The score of a character without a piece."""
        return min(s for _, s, _ in self.rows) - UNKNOWN

    @property
    def size(self) -> int:
        """Bytes of the piece table, as a bound of what a broadcast of it holds."""
        return sum(len(p.encode()) + 64 for p, _, _ in self.rows)

    @classmethod
    def load(cls, path: str = MODEL) -> "Model":
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        rows = [(sp.id_to_piece(i), sp.get_score(i), i) for i in ids
                if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        known = {i: p.replace(SPACE, " ").encode() for p, _, i in rows}
        byte_ids = [i for i in ids if sp.is_byte(i)]
        known |= {i: bytes([n]) for n, i in enumerate(byte_ids)}
        # A BPE table's scores are its ranks: whole, falling numbers.
        ranked = all(float(s).is_integer() for _, s, _ in rows)
        return cls("bpe" if ranked else "unigram", tuple(rows), byte_ids[0], tuple(known.get(i, b"") for i in ids),
                   _word_pattern([p for p, _, _ in rows]), max(len(p) for p, _, _ in rows))


def _word_pattern(pieces: list[str]) -> str:
    """Runs of letters or of others, with the spaces before them, such that each
    piece is one run: letters that pieces join to others count as others."""
    not_letters: set[str] = set()
    while True:
        letter = _LETTER.replace("{not_letters}", re.escape("".join(sorted(not_letters))))
        other = rf"(?:(?!{letter})[^{SPACE}])"
        pattern = f"{SPACE}*{letter}+|{SPACE}*{other}+|{SPACE}+"
        split = [p for p in pieces if len(p) > 1 and len(re.findall(pattern, p, re.S)) > 1]
        if not split:
            return pattern
        more = {c for p in split for c in p if re.match(letter, c)} - not_letters
        if not more:
            raise ValueError(f"pieces hold spaces after other characters: {split[:5]}")
        not_letters |= more


def prepared(text: str) -> str:
    """The text as pieces see it: spaces are marks, and one stands before it."""
    return SPACE + text.replace(" ", SPACE) if text else ""


class _Numbers(dict):
    """Numbers for keys, by first appearance."""

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        return n


def _opened(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompressobj().decompress(blob)


def _pack_words(words: pa.StringArray) -> bytes:
    _, offsets, data = words.buffers()
    press = zstandard.ZstdCompressor(level=3).compressobj()
    return press.compress(memoryview(offsets)[:4 * (len(words) + 1)]) + \
        press.compress(memoryview(data) if data else b"") + press.flush()


def _unpack_words(n: int, blob: bytes) -> pa.StringArray:
    raw = pa.py_buffer(_opened(blob))
    return pa.StringArray.from_buffers(n, raw.slice(0, 4 * (n + 1)), raw.slice(4 * (n + 1)))


def _pack_numbers(numbers: np.ndarray, rank: np.ndarray | None = None) -> bytes:
    """The four bytes of the numbers (or of their ranks) apart; the upper ones are
    nearly all alike."""
    press = zstandard.ZstdCompressor(level=3).compressobj()
    out = []
    for shift in (0, 8, 16, 24):
        for i in range(0, len(numbers), PLANE):
            some = numbers[i:i + PLANE] if rank is None else rank[numbers[i:i + PLANE]]
            out.append(press.compress((some >> shift).astype(np.uint8).tobytes()))
    return b"".join(out) + press.flush()


def _unpack_numbers(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(_opened(blob), np.uint8).reshape(4, -1)
    out = planes[3].astype(np.int32)
    for plane in planes[2::-1]:
        out <<= 8
        out |= plane
    return out


class _Chunk:
    """Texts as numbers of their words."""

    def __init__(self) -> None:
        self.numbers, self.ids, self.counts, self.digests, self.words, self.size = _Numbers(), [], [], [], [], 0

    def add(self, row_id, text: str | None, find) -> None:
        self.ids.append(row_id)
        if text is None:
            self.counts.append(-1)
            self.digests.append(None)
            return
        found = find(prepared(text))
        self.words.append(np.fromiter(map(self.numbers.__getitem__, found), np.int32, len(found)))
        self.counts.append(len(found))
        self.digests.append(hashlib.sha256(text.replace(SPACE, " ").encode()).digest())
        self.size += len(text)

    def row(self, number: int) -> pa.RecordBatch:
        """The chunk as one row. In the texts words go by frequency and in the list
        by order, which both compress well; ``places`` leads from one to the other."""
        whole = np.concatenate(self.words) if self.words else np.zeros(0, np.int32)
        self.words.clear()
        names = list(self.numbers)
        self.numbers.clear()
        by_count = np.argsort(-np.bincount(whole, minlength=len(names)), kind="stable").astype(np.int32)
        words = pa.array(names, pa.string())
        by_name = pc.array_sort_indices(words).to_numpy().astype(np.int32)
        rank, place = np.empty_like(by_count), np.empty_like(by_name)
        rank[by_count] = np.arange(len(names), dtype=np.int32)
        place[by_name] = np.arange(len(names), dtype=np.int32)
        cells = (number, self.ids, self.counts, self.digests, len(names), _pack_words(words.take(pa.array(by_name))),
                 _pack_numbers(place[by_count]), _pack_numbers(whole, rank))
        return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(cells, _CHUNK)], schema=_CHUNK)


_CHUNK = pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())),
                    ("digests", pa.list_(pa.binary())), ("n_words", pa.int32()), ("words", pa.binary()),
                    ("places", pa.binary()), ("numbers", pa.binary())])


def _chunks(docs: DataFrame, id_col: str, text_col: str, pattern: str) -> DataFrame:
    """One row for each chunk of texts: their ids, how many words each has (-1:
    NULL), the digest of what they must decode to, the chunk's different words, and
    the texts as numbers of these. A chunk is bounded but for a single longer text,
    and numbered by input partition, so a recomputed task makes the same."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(pattern, re.S).findall
        partition = TaskContext.get().partitionId()
        number, chunk = partition << COUNTER_BITS, _Chunk()
        if partition >> (63 - NTH_BITS - COUNTER_BITS):
            raise ValueError("too many input partitions for chunk numbers")
        for batch in batches:
            column = batch.column(1).cast(pa.large_string())
            for i in range(batch.num_rows):
                text = column[i].as_py()
                if chunk.ids and chunk.size + len(text or "") > CHUNK_CHARS:
                    yield chunk.row(number)
                    number, chunk = number + 1, _Chunk()
                    if number >> COUNTER_BITS != partition:
                        raise ValueError("an input partition is too large for chunk numbers")
                chunk.add(batch.column(0)[i].as_py(), text, find)
        if chunk.ids:
            yield chunk.row(number)
        pa.default_memory_pool().release_unused()  # the worker lives on, idle, while others run

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")).mapInArrow(
        run, "chunk long, ids array<long>, counts array<int>, digests array<binary>, n_words int, words binary, "
             "places binary, numbers binary").repartition("chunk")


def _words(chunks: DataFrame) -> DataFrame:
    """(at, word): the words of each chunk that get a lattice, and their places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, n, blob in zip(*(batch.column(c).to_pylist() for c in ("chunk", "n_words", "words"))):
                words = _unpack_words(n, blob)
                length = pc.utf8_length(words)
                nth = np.flatnonzero(pc.and_(pc.greater(length, 1), pc.less_equal(length, LONGEST)).to_numpy(
                    zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([pa.array((chunk << NTH_BITS) + nth), words.take(pa.array(nth))],
                                                 names=["at", "word"])

    # All columns go in, so that this and the assembly read one and the same shuffle.
    return chunks.mapInArrow(run, "at long, word string").repartition("word")


def lattice(words: DataFrame, table: DataFrame, longest: int, least: int = 2, small: bool = False) -> DataFrame:
    """``words`` (different words, and what belongs to each) that hold pieces of
    at least ``least`` characters, with their edges; an edge is (score,
    neg_start, stop, inside, ends): sets of places as bits, those inside the
    piece and those at its two ends. A ``small`` table is broadcast."""
    n = F.length("word")
    begins = words.filter(n >= least).select("*", F.explode(F.sequence(F.lit(0), n - least)).alias("i"))
    spans = begins.select("*", F.explode(F.sequence(F.lit(least), F.least(F.lit(longest), n - F.col("i")))).alias("k"))
    at = spans.select("*", F.substr("word", F.col("i") + 1, F.col("k")).alias("part")).withColumn("key", F.xxhash64("part"))
    keyed = table.select(F.xxhash64("piece").alias("key"), "piece", "score")
    # One long key makes the probe cheap; that part and piece are equal is checked
    # on a match (as a prefix that is as long, for an equality would join the key).
    edges = at.join(F.broadcast(keyed) if small else keyed, "key").filter((F.instr("piece", F.col("part")) == 1) & (F.length("piece") <= F.col("k")))
    i, stop = F.col("i"), F.col("i") + F.col("k")
    edge = F.struct("score", (-i).alias("neg_start"), stop.alias("stop"),
                    (_bit(stop) - _bit(i + 1)).alias("inside"), (_bit(i) + _bit(stop)).alias("ends"))
    return edges.groupBy(*words.columns).agg(F.collect_list(edge).alias("edges"))


def _bit(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), n)


def _let(value: Column, use) -> Column:
    return F.get(F.transform(F.array(value), use), F.lit(0))


_IDLE = -2**63


def merges(edges: str, word: str) -> Column:
    """The joints of a word by the best merge at each step. The state is the set
    of joints so far. An edge can merge if its ends are no joints and all places
    inside it but one are; the best (leftmost of equals) makes that one a joint.
    A word has no more merges than places, nor than edges."""
    def step(joints, _):
        left = F.bitwise_not(joints)

        def can_merge(x):
            return (x["ends"].bitwiseAND(joints) == 0) & (F.bit_count(x["inside"].bitwiseAND(left)) == 1)

        best = F.array_max(F.filter(F.col(edges), can_merge))
        # Once nothing can merge, the sign marks the rest of the steps as idle.
        return F.when(joints < 0, joints).otherwise(F.coalesce(joints.bitwiseOR(best["inside"]), joints.bitwiseOR(F.lit(_IDLE))))

    steps = F.sequence(F.lit(1), F.least(F.length(word) - 1, F.size(edges)))
    return F.aggregate(steps, F.lit(0).cast("long"), step, lambda joints: joints.bitwiseAND(F.lit(~_IDLE)))


def viterbi(edges: str, word: str, unknown: float) -> Column:
    """The spans of the path of the highest total score; a character without a
    piece costs ``unknown``. Of equal paths, the one whose last piece is longer
    wins. The fold walks the ends 1..n and keeps the best score and the start of
    the last piece for each."""
    zero = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("neg_start")))

    def step(best, end):
        ways = F.transform(F.filter(F.col(edges), lambda x: x["stop"] == end), lambda x: F.struct(
            (F.get(best, -x["neg_start"])["score"] + x["score"]).alias("score"), x["neg_start"].alias("neg_start")))
        alone = F.array(F.struct((F.get(best, end - 1)["score"] + unknown).alias("score"), (1 - end).alias("neg_start")))
        return F.concat(best, F.array(F.array_max(F.concat(ways, alone))))

    best = F.aggregate(F.sequence(F.lit(1), F.length(word)), zero, step)
    start = F.struct(F.length(word).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))

    def back(best):
        def one(s, _):
            left = -F.get(best, s["at"])["neg_start"]
            return F.when(s["at"] == 0, s).otherwise(F.struct(left.alias("at"), F.concat(F.array(
                F.struct(left.alias("start"), s["at"].alias("stop"))), s["spans"]).alias("spans")))

        return F.aggregate(F.sequence(F.lit(1), F.length(word)), start, one, lambda s: s["spans"])

    return _let(best, back)


def joints(spans: Column) -> Column:
    """The places inside the spans, as bits."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda bits, s: bits + _bit(s["stop"]) - _bit(s["start"] + 1))


def segmented(words: DataFrame, model: Model, spark: SparkSession) -> DataFrame:
    """``words`` that have a lattice, with their joints: bit i is set if no piece
    begins at character i of the word (which has at most LONGEST)."""
    table = spark.createDataFrame(list(model.rows), "piece string, score double, id int").select("piece", "score")
    small = model.size <= MAX_BROADCAST_BYTES
    if model.kind == "bpe":
        cut = lattice(words, table, model.longest_piece, 2, small)
        return cut.select(*words.columns, merges("edges", "word").alias("joints"))
    cut = lattice(words, table, model.longest_piece, 1, small)
    return cut.select(*words.columns, joints(viterbi("edges", "word", model.unknown)).alias("joints"))


def merged_by_heap(word: str, score: dict[str, float]) -> list[str]:
    """The same merges as the fold, for words without a length bound."""
    n = len(word)
    left, right, piece = list(range(-1, n - 1)), [*range(1, n), -1], list(word)
    heap: list[tuple[float, int, int, str]] = []

    def offer(i: int) -> None:
        if i >= 0 and right[i] >= 0 and (s := score.get(joined := piece[i] + piece[right[i]])) is not None:
            heapq.heappush(heap, (-s, i, right[i], joined))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, j, joined = heapq.heappop(heap)
        if right[i] != j or piece[i] + piece[j] != joined:
            continue
        piece[i], piece[j] = joined, ""
        right[i], right[j] = right[j], -1
        if right[i] >= 0:
            left[right[i]] = i
        offer(left[i])
        offer(i)
    return [p for p in piece if p]


def best_path(word: str, score: dict[str, float], longest: int, unknown: float) -> list[str]:
    """The same path as the Viterbi fold, for words without a length bound."""
    best, start = [0.0], [0]
    for stop in range(1, len(word) + 1):
        ways = [(best[i] + s, -i) for i in range(max(0, stop - longest), stop) if (s := score.get(word[i:stop])) is not None]
        value, neg = max([*ways, (best[stop - 1] + unknown, 1 - stop)])
        best.append(value)
        start.append(-neg)
    parts, stop = [], len(word)
    while stop:
        parts.append(word[start[stop]:stop])
        stop = start[stop]
    return parts[::-1]


def _parts(word: str, bits: int) -> list[str]:
    """The pieces of a word, by its joints."""
    cuts = [i for i in range(1, len(word)) if not bits >> i & 1]
    return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])]


def _gathered(size: np.ndarray, flat: np.ndarray, pick: np.ndarray, begin: np.ndarray):
    """(lengths, values) of the chosen lists, one after the other; list i has
    ``size[i]`` values in ``flat``, from ``begin[i]`` on."""
    length = size[pick]
    places = np.cumsum(length) - length
    at = np.repeat(begin[pick] - places, length)
    at += np.arange(len(at))
    return length, flat[at]


def _ids_of_parts(parts: list[str], ids: dict[str, int], byte_base: int) -> list[int]:
    out: list[int] = []
    for p in parts:
        if (i := ids.get(p)) is not None:
            out.append(i)
        else:
            out += [byte_base + b for b in p.encode()]
    return out


def ids_of_words(words: pa.StringArray, joints: np.ndarray, ids: dict[str, int], byte_base: int, long_word):
    """(how many ids each word has, all ids): words are cut at the places that are no
    joints. ``long_word`` gives the parts of a word of more than ``LONGEST``."""
    n = pc.utf8_length(words).to_numpy().astype(np.int64)
    whole = "".join(words.to_pylist())
    start = np.cumsum(n) - n
    place = np.arange(len(whole)) - np.repeat(start, n)
    long = n > LONGEST
    joined = (np.repeat(joints, n) >> np.minimum(place, LONGEST)) & 1 == 1
    joined |= np.repeat(long, n) & (place > 0)  # one part for now
    begin = np.flatnonzero(~joined)
    parts = [whole[a:b] for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(whole)])]
    found = list(map(ids.get, parts))
    size = np.ones(len(parts), np.int64)
    if None in found or long.any():
        owner = np.searchsorted(start, begin, side="right") - 1
        flat: list[int] = []
        for k, (part, i) in enumerate(zip(parts, found)):
            if i is not None and len(part) <= LONGEST:
                flat.append(i)
                continue
            more = _ids_of_parts(long_word(part) if long[owner[k]] else [part], ids, byte_base)
            size[k] = len(more)
            flat += more
        found = flat
    per_word = np.add.reduceat(size, np.searchsorted(begin, start)) if len(n) else size
    return per_word, np.array(found, np.int32)


class _Bytes:
    """The bytes that each id decodes to, in one array."""

    def __init__(self, decoded: tuple[bytes, ...]):
        self.data = np.frombuffer(b"".join(decoded) or b"\0", np.uint8)
        self.size = np.fromiter(map(len, decoded), np.int64, len(decoded))
        self.begin = np.cumsum(self.size) - self.size

    def texts(self, cells: pa.ListArray) -> pa.Array:
        """The texts that lists of ids decode to: their bytes, without the space that
        stands before each text; what is no UTF-8 becomes U+FFFD."""
        ids, edge = cells.flatten().to_numpy(), np.append(0, np.cumsum(_list_sizes(cells)))
        begin, size = self.begin[ids], self.size[ids]
        first = edge[:-1][edge[:-1] < edge[1:]]
        first = first[(size[first] > 0) & (self.data[np.minimum(begin[first], len(self.data) - 1)] == 32)]
        begin[first] += 1
        size[first] -= 1
        ends = np.append(0, np.cumsum(size))
        offsets = ends[edge]
        at = np.repeat((begin - ends[:-1]).astype(np.int32), size)
        at += np.arange(len(at), dtype=np.int32)
        raw = self.data[at]
        mask = None if not cells.null_count else pa.py_buffer(np.packbits(
            cells.is_valid().to_numpy(zero_copy_only=False), bitorder="little").tobytes())
        found = pa.Array.from_buffers(pa.large_binary(), len(cells), [mask, pa.py_buffer(offsets), pa.py_buffer(raw)])
        try:
            return found.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([None if t is None else t.decode("utf-8", "replace") for t in found.to_pylist()], pa.string())


def _list_sizes(cells: pa.ListArray) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(cells), 0).to_numpy(zero_copy_only=False)


def encode(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
           round_trip: bool = False) -> DataFrame:
    """(id, pieces, text_sha256): the piece ids of each text, and the digest of
    what they must decode to. With ``round_trip`` also ``text``, decoded from the
    pieces in the same task, as ``decode`` does in one of its own."""
    spark = docs.sparkSession
    chunks = _chunks(docs, id_col, text_col, model.words)
    pairs = _words(chunks)
    # The word table keeps one place of each word. It is of no use but to make both
    # sides of the join read the same shuffle of the pairs.
    words = pairs.groupBy("word").agg(F.min("at").alias("any"))
    cut = segmented(words, model, spark).select("word", "any", "joints")
    # (A chunk that may be NULL would put a filter below that shuffle on one side.)
    chunk = F.coalesce(F.shiftright("at", NTH_BITS), F.lit(-1).cast("long"))
    found = pairs.join(cut, "word").filter("joints <> 0 and any >= 0").select(
        chunk.alias("chunk"), F.col("at").bitwiseAND(F.lit((1 << NTH_BITS) - 1)).cast("int").alias("nth"),
        "joints")
    # Two lists in one aggregation keep the same order. A list is bounded by its chunk.
    reply = found.groupBy("chunk").agg(F.collect_list("nth").alias("nth"), F.collect_list("joints").alias("joints"))
    shared = spark.sparkContext.broadcast(({p: i for p, _, i in model.rows}, {p: s for p, s, _ in model.rows},
                                           model.kind, model.longest_piece, model.unknown, model.byte_base, model.decoded))

    schema = pa.schema([("id", pa.int64()), ("pieces", pa.list_(pa.int32())), ("text_sha256", pa.string()),
                        *([("text", pa.string())] if round_trip else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, score, kind, longest, unknown, byte_base, decoded = shared.value
        back = _Bytes(decoded) if round_trip else None

        def long_word(word: str) -> list[str]:
            return merged_by_heap(word, score) if kind == "bpe" else best_path(word, score, longest, unknown)

        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                row_ids, counts, digests, n = (row[c].as_py() for c in ("ids", "counts", "digests", "n_words"))
                joints = np.zeros(n, np.int64)
                if row["nth"].is_valid:
                    joints[row["nth"].values.to_numpy()] = row["joints"].values.to_numpy()
                words = _unpack_words(n, row["words"].as_py())
                found = [ids_of_words(words[k:k + BATCH_WORDS], joints[k:k + BATCH_WORDS], ids, byte_base, long_word)
                         for k in range(0, n, BATCH_WORDS)] or [(np.zeros(0, np.int64), np.zeros(0, np.int32))]
                size, flat = (np.concatenate(x) for x in zip(*found))
                begin, places = np.cumsum(size) - size, _unpack_numbers(row["places"].as_py())
                begin, size, numbers = begin[places], size[places], _unpack_numbers(row["numbers"].as_py())
                edge = np.concatenate([[0], np.cumsum(np.maximum(counts, 0))])  # of the words of each text
                first = 0
                while first < len(row_ids):  # texts of about BATCH_WORDS words at a time
                    last = max(first + 1, int(np.searchsorted(edge, edge[first] + BATCH_WORDS, side="right")) - 1)
                    length, pieces = _gathered(size, flat, numbers[edge[first]:edge[last]], begin)
                    places = np.append(0, np.cumsum(length))[edge[first:last + 1] - edge[first]]
                    cells = pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(pieces, pa.int32()),
                                                     mask=pa.array([c < 0 for c in counts[first:last]]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row_ids[first:last], pa.int64()), cells,
                         pa.array([None if d is None else d.hex() for d in digests[first:last]], pa.string()),
                         *([back.texts(cells)] if round_trip else [])], schema=schema)
                    first = last

    return chunks.join(reply, "chunk", "left").mapInArrow(
        run, "id long, pieces array<int>, text_sha256 string" + (", text string" if round_trip else "")) \
        .withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, model: Model, pieces: str = "pieces", text: str = "text") -> DataFrame:
    """``encoded`` with its decoded texts added."""
    shared = encoded.sparkSession.sparkContext.broadcast(model.decoded)
    encoded = encoded.drop(text)
    schema = encoded.withColumn(text, F.lit(None).cast("string")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Bytes(shared.value)
        for batch in batches:
            size = np.cumsum(_list_sizes(batch.column(pieces))) // BATCH_WORDS
            cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), batch.num_rows]
            for part in (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:])):
                yield pa.RecordBatch.from_arrays([*part.columns, table.texts(part.column(pieces))], names=schema.names)

    return encoded.mapInArrow(run, schema)
