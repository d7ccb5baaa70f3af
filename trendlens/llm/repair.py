"""Operator 13, repair of conversation structure by depth-first branch-and-bound.

A sound conversation's role initials are ``(s?(ua)+)?``: nothing, or an optional
system message and user and assistant in turn. Edits lead there: Keep a row (free),
Rerole it to user or assistant (1), Delete it (2; a must for blank and duplicate
rows), Insert an empty message of user or assistant (5). A truncated row that is not
deleted costs 5 more. The cheapest edits win; of equal ones, those whose initials
in order (the audit) are least in ASCII.

The search walks the rows of a segment depth-first with an explicit stack. A node
is a place and a state of the grammar, reached by a prefix (cost, audit).

* Bounds: the least that the rows still to come can cost from each state, if
  truncated rows that are kept could change their role for nothing.
* Incumbent: the best whole (cost, audit) so far; a prefix goes if its bound is
  above it, or equal with an audit that is greater already.
* Dominance: for each node the best prefix so far; a worse one goes, for both can be
  continued alike. (Audits of one node hold as many rows, so neither begins
  the other; and an audit fixes the roles that it gives.)

The search ends when the stack is empty: the incumbent is proved.

A conversation of any length is cut into segments of ``SEGMENT`` rows. Segments are
searched apart, on all executors, for each state that may come in and go out, and
a running fold puts their answers together; it keeps one path for each state.
Rows, texts and repaired messages of a long conversation are never held together.

Defined results: NULL roles and texts are empty, so such a row is blank. Rows go by
turn (NULLs first), then role, then text. NULL conv_ids are one conversation. An
empty table has no conversations. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from trendlens.llm.common import written

SEGMENT = 128
RELABEL, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

# States of the grammar. Nothing yet, after s, after u, after a.
EMPTY, OPENED, ASKED, ANSWERED = range(4)
_ROLE_NEXT = {EMPTY: "u", OPENED: "u", ASKED: "a", ANSWERED: "u"}  # of a rerole or insert
_AFTER = {"s": OPENED, "u": ASKED, "a": ANSWERED}
_FITS = {EMPTY: "su", OPENED: "u", ASKED: "a", ANSWERED: "u"}
_NEVER = 1 << 60

VISIBLE = r"[^\x20\x09-\x0D]"
WHOLE = r"[.!?][\x20\x09-\x0D]*\z"


def _successors(state: int, row: str) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, state) of all that can be done with a row (its code)."""
    yield "D", DELETE, state
    if row == "-":
        return
    extra, initial = (TRUNCATED if row.isupper() else 0), row.lower()
    if initial in _FITS[state]:
        yield "K", extra, _AFTER[initial]
    yield "R", RELABEL + extra, _AFTER[_ROLE_NEXT[state]]


def bounds(rows: str, goals: set[int], last: bool) -> list[list[int]]:
    """For each place and state, a cost that no way from there to a goal is below."""
    here = [0 if s in goals else _NEVER for s in range(4)]
    if last:
        here = _with_inserts(here)
    out = [here]
    for row in reversed(rows):
        after = out[-1]
        if row.isupper():  # relaxed: once kept, any role is free
            here = [min((DELETE if e == "D" else TRUNCATED) + after[t] for e, _, t in _successors(s, row)) for s in range(4)]
        else:
            here = [min(cost + after[t] for _, cost, t in _successors(s, row)) for s in range(4)]
        out.append(_with_inserts(here))
    return out[::-1]


def _with_inserts(cost: list[int]) -> list[int]:
    once = [min(cost[s], INSERT + cost[_AFTER[_ROLE_NEXT[s]]]) for s in range(4)]
    return [min(cost[s], INSERT + once[_AFTER[_ROLE_NEXT[s]]]) for s in range(4)]


def search(rows: str, entry: int, goals: set[int], last: bool) -> tuple[int, str, int, int] | None:
    """(cost, audit, state, visited nodes) of the least edits that lead from
    ``entry`` through all rows to a goal, None if nothing does. A message is
    inserted before a row, or after all rows if these are the ``last``."""
    bound, n = bounds(rows, goals, last), len(rows)
    best: tuple[int, str] = (_NEVER, "")
    end = None
    table: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")] if bound[0][entry] < _NEVER else []
    visited = 0

    def hopeless(place: int, state: int, cost: int, audit: str) -> bool:
        least = cost + bound[place][state]
        return least > best[0] or least == best[0] and audit > best[1][:len(audit)] or least >= _NEVER

    while stack:
        place, state, cost, audit = stack.pop()
        if hopeless(place, state, cost, audit) or table.get((place, state), (cost, audit)) < (cost, audit):
            continue
        visited += 1
        if place == n and state in goals and (cost, audit) < best:
            best, end = (cost, audit), state
        ways = [("I", INSERT, _AFTER[_ROLE_NEXT[state]])] if place < n or last else []
        if place < n:
            ways += _successors(state, rows[place])
        children = []
        for edit, price, then in ways:
            at = place if edit == "I" else place + 1
            child = (cost + price, audit + edit)
            if hopeless(at, then, *child) or table.get((at, then), (_NEVER, "")) <= child:
                continue
            table[at, then] = child
            children.append((child[0] + bound[at][then], edit, at, then, child))
        for _, _, at, then, child in sorted(children, reverse=True):  # the most promising is popped first
            stack.append((at, then, *child))
    return None if end is None else (*best, end, visited)


def opens(rows: str, audit: str) -> bool:
    """Whether the first message that is left is a kept system row."""
    first = next((i for i, edit in enumerate(audit) if edit != "D"), None)
    return first is not None and audit[first] == "K" and rows[first].lower() == "s"


def roles(audit: str, opened: bool) -> Iterator[tuple[int | None, str | None]]:
    """(row, new role) of each message that the edits leave, in order; no row for
    an inserted one, no new role for a kept one."""
    state, row = EMPTY, 0
    for edit in audit:
        if edit != "D":
            initial = "s" if edit == "K" and state == EMPTY and opened else _ROLE_NEXT[state]
            state = _AFTER[initial]
            yield (None if edit == "I" else row, None if edit == "K" else "user" if initial == "u" else "assistant")
        row += edit != "I"


# In Spark -----------------------------------------------------------------------------------

def judge(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """(conv_id, place, turn, role, text, fault, illegal, new_turn, code, last): the
    rows in order from 0, each with its first fault (blank, duplicate, truncated or
    NULL), whether its initial may not follow the one before, whether its turn is a
    new one, its code for the search, and whether it ends its conversation. Written,
    for several steps read it."""
    rows = rows.select(rows[conv].alias("conv_id"), rows[turn].alias("turn"),
                       F.coalesce(rows[role], F.lit("")).alias("role"), F.coalesce(rows[text], F.lit("")).alias("text"))
    by = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    same = Window.partitionBy("conv_id", "role", "text").orderBy("place")
    initial = F.substring("role", 1, 1)
    pair = F.concat(F.lag(initial).over(by), initial)
    placed = rows.select(
        "*", (F.row_number().over(by) - 1).cast("long").alias("place"),
        (F.lag("role").over(by).isNotNull() & ~pair.isin("su", "ua", "au")).alias("illegal"),
        (F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.lag("turn").over(by))).alias("new_turn"),
        F.lead("role").over(by).isNull().alias("last"))
    faulty = placed.withColumn("fault", F.when(~F.col("text").rlike(VISIBLE), "blank")
                               .when(F.row_number().over(same) > 1, "duplicate")
                               .when(~F.col("text").rlike(WHOLE), "truncated"))
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    code = F.when(F.col("fault").isin("blank", "duplicate"), "-").when(F.col("fault") == "truncated", F.upper(letter)) \
        .otherwise(letter)
    return written(faulty.withColumn("code", code), "repair-rows")


def summary(judged: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal): counts of each conversation."""
    def count(c: Column, name: str) -> Column:
        return F.count_if(c).alias(name)

    return judged.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_if("new_turn"), F.lit(0)).cast("long").alias("gaps"),
        *(count(F.col("fault") == name, name) for name in ("blank", "duplicate", "truncated")),
        count(F.col("illegal"), "illegal"))


_WAYS = "array<struct<entry:int,exit:int,cost:long,audit:string,opened:boolean>>"


def segments(judged: DataFrame, size: int = SEGMENT) -> DataFrame:
    """(conv_id, segment, codes, last): the codes of each ``size`` rows in order."""
    return judged.groupBy("conv_id", F.floor(F.col("place") / size).cast("long").alias("segment")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "code"))), lambda r: r["code"]), "")
        .alias("codes"), F.max("last").alias("last"))


def ways(parts: DataFrame) -> DataFrame:
    """(conv_id, segment, last, ways): the least edits of each segment for each
    state before and after it that its conversation may need."""
    def found(codes: str, first: bool, last: bool) -> list[dict]:
        out = []
        for entry in (EMPTY,) if first else range(4):
            for goals in ({EMPTY, ANSWERED},) if last else ({0}, {1}, {2}, {3}):
                if (answer := search(codes, entry, goals, last)) is not None:
                    cost, audit, end, _ = answer
                    out.append({"entry": entry, "exit": end, "cost": cost, "audit": audit,
                                "opened": entry == EMPTY and opens(codes, audit)})
        return out

    kind = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()),
                               ("audit", pa.string()), ("opened", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            answers = [found(codes, segment == 0, last) for segment, codes, last in
                       zip(*(batch.column(c).to_pylist() for c in ("segment", "codes", "last")))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(answers, kind)],
                                             names=["conv_id", "segment", "last", "ways"])

    head = [f for f in parts.schema if f.name == "conv_id"][0].dataType.simpleString()
    return parts.select("conv_id", "segment", "codes", "last").mapInArrow(
        run, f"conv_id {head}, segment long, last boolean, ways {_WAYS}")


def plans(judged: DataFrame, size: int = SEGMENT) -> DataFrame:
    """(conv_id, cost, audit, opened): the least edits of each conversation.

    Segments of a conversation come in order; for each state the fold keeps the
    cheapest way so far and how its audit ranks among the others (at a boundary
    all audits hold as many rows and end with one, so none begins another)."""
    searched = ways(segments(judged, size)).repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    head = searched.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = {EMPTY: (0, 0, False, None)}  # state: cost, rank, opened, (the way before, audit)
        paths = start
        for batch in batches:
            out: list[tuple] = []
            for conv, last, some in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "last", "ways"))):
                after: dict[int, tuple] = {}
                for w in some:
                    if w["entry"] not in paths:
                        continue
                    cost, rank, opened, before = paths[w["entry"]]
                    new = (cost + w["cost"], (rank, w["audit"]), opened or w["opened"], (before, w["audit"]))
                    if w["exit"] not in after or new[:2] < after[w["exit"]][:2]:
                        after[w["exit"]] = new
                if not last:
                    order = sorted(way[1] for way in after.values())
                    paths = {s: (c, order.index(rank), o, link) for s, (c, rank, o, link) in after.items()}
                    continue
                cost, _, opened, link = min(after.values(), key=lambda way: way[:2])
                pieces = []
                while link is not None:
                    pieces.append(link[1])
                    link = link[0]
                out.append((conv, cost, "".join(reversed(pieces)), opened))
                paths = start
            columns = list(zip(*out)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], batch.schema.field("conv_id").type), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.string()), pa.array(columns[3], pa.bool_())],
                names=["conv_id", "cost", "audit", "opened"])

    return written(searched.mapInArrow(run, f"conv_id {head}, cost long, audit string, opened boolean"), "repair-plans")


def repaired(judged: DataFrame, planned: DataFrame) -> DataFrame:
    """(conv_id, nth, role, text): the messages that the edits leave. Edits meet
    their rows by conversation and place, so a long conversation is spread."""
    head = planned.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for conv, audit, opened in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "opened"))):
                left = list(roles(audit, opened))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([conv] * len(left), kind), pa.array(range(len(left)), pa.int64()),
                     pa.array([p for p, _ in left], pa.int64()), pa.array([r for _, r in left], pa.string())],
                    names=["conv_id", "nth", "place", "new_role"])

    steps = planned.select("conv_id", "audit", "opened").mapInArrow(
        run, f"conv_id {head}, nth long, place long, new_role string").alias("e")
    rows = judged.select("conv_id", "place", "role", "text").alias("r")
    met = steps.join(rows, F.col("e.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("e.place") == F.col("r.place")), "left")
    return met.select("e.conv_id", "nth", F.coalesce("new_role", "role").alias("role"),
                      F.coalesce("text", F.lit("")).alias("text"))


def digests(messages: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): of ``role:text`` of all messages in order, joined
    by newlines; read as a stream, so no conversation is held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        kind = None

        def out(found):
            return pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], kind), pa.array([d for _, d in found], pa.string())],
                                              names=["conv_id", "repaired_sha256"])

        for batch in batches:
            kind, done = batch.schema.field("conv_id").type, []
            for conv, nth, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "nth", "role", "text"))):
                if nth == 0:
                    if state is not None:
                        done.append((held, state.hexdigest()))
                    held, state = conv, hashlib.sha256()
                state.update(f"{chr(10) if nth else ''}{role}:{text}".encode())
            yield out(done)
        if state is not None:
            yield out([(held, state.hexdigest())])

    head = messages.schema["conv_id"].dataType.simpleString()
    return messages.repartition("conv_id").sortWithinPartitions("conv_id", "nth").mapInArrow(
        run, f"conv_id {head}, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows (conv_id, turn, role, text) with faults planted by the
    CRC-32 of ``conv_id:turn``; NULLs become one space, but for a turn's own value."""
    def spaced(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.pmod(F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")), F.lit(20))
    rows = rows.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")) \
        .otherwise(F.col("text"))
    return rows.filter("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
        .alias("copy")).drop("copy")
