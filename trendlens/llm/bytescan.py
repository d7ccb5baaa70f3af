"""Vectorised word scanning over Arrow string columns (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RNG = np.random.default_rng(20240607)
BYTE_KEYS = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


# Bytes of words in lower case: digits, a-z and non-ASCII; others separate.
LOWER_WORDS = np.zeros(256, np.uint8)
for _b in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    LOWER_WORDS[_b] = _b
LOWER_WORDS[0x41:0x5B] = np.arange(0x61, 0x7B)

PIECE_BYTES = 4 << 20
BLOCK_BYTES = 1 << 20


def pieces(batch: pa.RecordBatch, text: int | str, max_bytes: int = PIECE_BYTES):
    """The batch in row slices of at most ``max_bytes`` of text (one row at
    least), so that working arrays stay small."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // max_bytes
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_spans(mapped: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of non-zero bytes; no run crosses a text."""
    if not len(mapped):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    on = mapped != 0
    first = on.copy()
    first[1:] &= ~on[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < len(mapped)]
    first[cuts] = on[cuts]
    starts = np.flatnonzero(first)
    last = on.copy()
    last[:-1] &= ~on[1:]
    before = cuts[cuts > 0] - 1
    last[before] = on[before]
    return starts, np.flatnonzero(last) + 1


def word_hashes(mapped: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, by its bytes; made in blocks of words."""
    out = np.zeros(len(starts), np.uint64)
    lens = ends - starts
    block = np.cumsum(lens) // BLOCK_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(starts)]
    for a, b in zip(cuts, cuts[1:]):
        if a == b:
            continue
        text, n = mapped[starts[a]:ends[b - 1]], lens[a:b]
        compact = np.zeros(b - a, np.int64)
        np.cumsum(n[:-1], out=compact[1:])
        letters = text[text != 0]
        place = np.arange(len(letters)) - np.repeat(compact, n)
        powers = np.full(int(n.max()), BASE, np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        out[a:b] = mix(np.add.reduceat(BYTE_KEYS[letters] * powers[place], compact) ^ n.astype(np.uint64))
    return out


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of n consecutive words (over the whole array)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for j in range(n):
        out *= BASE
        out += words[j:j + len(out)]
    return mix(out)
