"""Operator 12, periodic runs of words by recursive frequency splitting.

A run is a stretch of consecutive words whose smallest period is q, at least
max(``SHORTEST``, ``TIMES`` * q) words long, that cannot be extended keeping q.

1. Splitting. A word of a run occurs in it ``TIMES`` times at least, so a word that
   occurs more rarely within a segment belongs to none of its runs and splits it.
   Each part is a segment of its own, and is split again until all its words
   occur often enough. Only words whose count may have changed are looked at
   again: all words of the smaller parts, and in the largest part those that also
   stood outside of it, so a text of n words takes about n log n steps however
   deep the recursion goes.
2. Lag scan of the segments that survive. For a short lag all words are compared
   with those one lag away; for a longer lag q only every q-th word (a run holds
   four such places in a row), and what agrees there is compared in full. Stretches
   inside a run of a smaller period are that run's multiples and are left out.

Every text is handled on its own, so there is no shuffle; a task holds one block
of texts. A text is read in blocks and held as four-byte word numbers.

Defined results: NULL texts have no words and no runs and stay NULL; empty and
blank texts collapse to an empty text; a NULL doc_id is kept; repeated rows are
judged each. Runs may overlap; they come sorted by start, then period. Extra
columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from trendlens.llm import bytescan

SHORTEST = 6
TIMES = 4
SHORT_LAG = 16
BLOCK_BYTES = 1 << 20
WHITE = r"[\x20\x09-\x0D]+"

_WHITE = re.compile(rb"[\x20\x09-\x0D]")
_RUNS = "array<struct<start:long,length:long,period:long>>"
_RUN_TYPE = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])


def numbered(raw: bytes, block: int = BLOCK_BYTES) -> tuple[np.ndarray, list[bytes]]:
    """The words of a text as numbers, and the different words by number."""
    numbers: dict[bytes, int] = {}
    out, at = array("i"), 0
    while at < len(raw):
        cut = _WHITE.search(raw, at + block) if at + block < len(raw) else None
        stop = cut.start() if cut else len(raw)
        out.extend([numbers.setdefault(w, len(numbers)) for w in raw[at:stop].split()])
        at = stop
    return np.frombuffer(out, np.int32) if out else np.zeros(0, np.int32), list(numbers)


def segments(words: np.ndarray) -> list[tuple[int, int]]:
    """The stretches [start, stop) that can hold runs: all words of one occur in
    it ``TIMES`` times at least."""
    n = len(words)
    if n < SHORTEST or np.bincount(words).max() < TIMES:
        return []
    places = np.argsort(words, kind="stable")
    key = words[places].astype(np.int64) * (n + 1) + places  # sorted by word, then place
    done, work = [], [(0, n, np.unique(words))]
    while work:
        start, stop, suspects = work.pop()
        at = suspects.astype(np.int64) * (n + 1)
        low, high = np.searchsorted(key, at + start), np.searchsorted(key, at + stop)
        count = high - low
        rare = (count > 0) & (count < TIMES)
        if not rare.any():
            done.append((start, stop))
            continue
        low, count = low[rare], count[rare]
        nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        cuts = np.sort(places[np.repeat(low, count) + nth])
        starts, stops = np.append(start, cuts + 1), np.append(cuts, stop)
        largest = int(np.argmax(stops - starts))
        for i in np.flatnonzero(stops - starts >= SHORTEST).tolist():
            a, b = int(starts[i]), int(stops[i])
            inside = words[a:b] if i != largest else np.concatenate([words[start:a], words[b:stop]])
            work.append((a, b, np.unique(inside)))
    return sorted(done)


def _agreeing(words: np.ndarray, lag: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the maximal stretches of words equal to those one lag on."""
    same = np.zeros(len(words) - lag + 2, np.int8)
    same[1:-1] = words[:-lag] == words[lag:]
    step = np.diff(same)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _extended(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The maximal stretch around ``at`` of words equal to those one lag on. Its
    start is sought one lag back at most."""
    low = max(0, at - lag)
    other = np.flatnonzero(words[low:at] != words[low + lag:at + lag])
    start = low + int(other[-1]) + 1 if len(other) else low
    stop, step, end = at, lag, len(words) - lag
    while stop < end:
        piece = words[stop:min(end, stop + step)] != words[stop + lag:min(end, stop + step) + lag]
        first = int(piece.argmax())
        if piece[first]:
            return start, stop + first
        stop, step = stop + len(piece), step * 2
    return start, stop


def lag_scan(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by period."""
    n, runs = len(words), []
    covered = np.zeros(n, np.int64)  # for each place, how far runs that hold it go

    def add(start: int, stop: int, lag: int) -> None:
        if stop - start >= max(SHORTEST, TIMES * lag) and covered[start] < stop:
            runs.append((start, stop - start, lag))
            found.append((start, stop))

    for lag in range(1, n // TIMES + 1):
        found: list[tuple[int, int]] = []
        if lag <= SHORT_LAG:
            starts, stops = _agreeing(words, lag)
            long = stops - starts + lag >= max(SHORTEST, TIMES * lag)
            for start, stop in zip(starts[long].tolist(), stops[long].tolist()):
                add(start, stop + lag, lag)
        else:
            every = words[::lag]
            same = every[1:] == every[:-1]
            at = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * lag
            at = at[covered[at] < at + 2 * lag]
            for shift in (lag // 2, lag + lag // 3, 1, 2 * lag - 1, lag // 5, lag + lag // 7):
                if not len(at):
                    break
                at = at[words[at + shift] == words[at + shift + lag]]
            upto = -1
            for place in at.tolist():
                if place >= upto:
                    start, stop = _extended(words, place, lag)
                    upto = max(upto, stop)
                    add(start, stop + lag, lag)
        for start, stop in found:
            np.maximum(covered[start:stop], stop, out=covered[start:stop])
    return runs


def runs_of(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a text, by start, then period."""
    found = [(a + start, length, period) for a, b in segments(words) for start, length, period in lag_scan(words[a:b])]
    return sorted(found, key=lambda run: (run[0], run[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay: those that no run holds after its first period."""
    kept = np.ones(n, bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return kept


def find(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the runs of each text, and the text
    with every run cut to its first period, its words joined by one space."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in bytescan.pieces(b, 1)):
            counts, ends, flat, collapsed = [], [0], [], []
            for cell in batch.column(1).cast(pa.large_binary()):
                raw = cell.as_py()
                words, different = numbered(raw or b"")
                runs = runs_of(words)
                counts.append(len(words))
                flat += runs
                ends.append(len(flat))
                if raw is None:
                    collapsed.append(None)
                    continue
                stay = words[kept_words(len(words), runs)] if runs else words
                collapsed.append(b" ".join([different[i] for i in stay.tolist()]))
            columns = np.array(flat, np.int64).reshape(-1, 3)
            parts = pa.StructArray.from_arrays([pa.array(columns[:, i]) for i in range(3)], fields=list(_RUN_TYPE))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts),
                 pa.array(collapsed, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text].alias("text")).mapInArrow(
        run, f"doc_id long, n_words long, runs {_RUNS}, collapsed string")


def greatest(runs: str = "runs") -> Column:
    """The run of the greatest exact length / period, of equals the first."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.aggregate(F.col(runs), none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def planted(id_col: str = "doc_id", text: str = "text") -> Column:
    """The text in which the words from a place on are made periodic, in the tenth
    of documents whose id's CRC-32 is divisible by ten; other texts are left alone."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeat(words):
        n = F.size(words).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1),
                                                      lambda i: F.get(words, place(i))), " "))

    words = F.filter(F.split(F.col(text), WHITE), lambda w: w != "")
    return F.when(F.pmod(h, F.lit(10)) == 0, F.coalesce(_let(words, repeat), F.col(text))).otherwise(F.col(text))
