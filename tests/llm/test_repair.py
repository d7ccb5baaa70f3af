import hashlib
import random
import re
import zlib

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from trendlens.llm import repair
from trendlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def plain_search(codes, inserts=2):
    """The least (cost, audit, initials) by trying every edit of every row, the
    best of each string of initials' tail kept: (s?) and what came last."""
    def grown(ways):
        for _ in range(inserts):
            more = {(c + 5, a + "I", o + r) for c, a, o in ways for r in "ua"}
            ways = ways | {w for w in more if re.fullmatch("(s?(ua)*u?)?", w[2])}
        return ways

    ways = {(0, "", "")}
    for row in codes:
        ways, new = grown(ways), set()
        for c, a, o in ways:
            new.add((c + 2, a + "D", o))
            if row != "-":
                extra = 5 if row.isupper() else 0
                new.add((c + extra, a + "K", o + row.lower()))
                new |= {(c + extra + 1, a + "R", o + r) for r in "ua"}
        new = {w for w in new if re.fullmatch("(s?(ua)*u?)?", w[2])}
        best = {}
        for w in new:  # what follows depends on the last letter, and on whether there is one
            best[w[2][-1:]] = min(best.get(w[2][-1:], w), w)
        ways = set(best.values())
    return min(w for w in grown(ways) if re.fullmatch("(s?(ua)+)?", w[2]))


def plain_roles(codes, audit):
    return [(p, r) for p, r in repair.roles(audit, repair.opens(codes, audit))]


codes_of = st.text("suaxSUAX-", max_size=14)


@settings(max_examples=600, deadline=None)
@given(codes_of)
def test_search_equals_every_edit(codes):
    cost, audit, initials = plain_search(codes)
    got = repair.search(codes, repair.EMPTY, {repair.EMPTY, repair.ANSWERED}, True)
    assert got[:2] == (cost, audit)
    left = "".join(codes[p].lower() if r is None else r[0] for p, r in plain_roles(codes, audit))
    assert left == initials


def folded(codes, size):
    """Segments searched apart and put together, as ``plans`` does."""
    paths = {repair.EMPTY: (0, "")}
    pieces = [codes[i:i + size] for i in range(0, len(codes), size)] or [""]
    for i, piece in enumerate(pieces):
        last, after = i == len(pieces) - 1, {}
        for entry, (cost, audit) in paths.items():
            for goals in ({0, 3},) if last else ({0}, {1}, {2}, {3}):
                if (w := repair.search(piece, entry, goals, last)) is not None:
                    after[w[2]] = min(after.get(w[2], (10**9, "")), (cost + w[0], audit + w[1]))
        paths = after
    return min(paths.values())


@settings(max_examples=200, deadline=None)
@given(st.text("suaxSUA-", max_size=40), st.integers(1, 9))
def test_segments_give_the_whole(codes, size):
    whole = repair.search(codes, repair.EMPTY, {repair.EMPTY, repair.ANSWERED}, True)
    assert folded(codes, size) == whole[:2]


def test_search_stays_small():
    """Nodes visited in segments of full length, the awkward ones included."""
    rng = random.Random(2)
    for letters in ("uaUA", "suaxSUAX-", "UA", "uA", "sU", "u", "A", "ua", "uuUAa-", "S", "x", "X-"):
        for _ in range(20):
            codes = "".join(rng.choice(letters) for _ in range(repair.SEGMENT))
            for goals, last in (({0, 3}, True), ({2}, False), ({1}, False)):
                got = repair.search(codes, repair.EMPTY, goals, last)
                assert got is None or got[3] <= 3 * len(codes), (letters, got[3])


def plain_rows(rows):
    """The result for (conv_id, turn, role, text) rows after damage, one conversation."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    codes, counts, seen = "", dict.fromkeys(("blank", "duplicate", "truncated"), 0), set()
    for _, _, role, text in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else \
            "truncated" if shown[-1] not in ".!?" else None
        seen.add((role, text))
        letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
        codes += "-" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        if fault:
            counts[fault] += 1
    turns = [r[1] for r in rows if r[1] is not None]
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, initials = plain_search(codes, 1)
    names, left, at = {"u": "user", "a": "assistant"}, [], 0
    for edit in audit:
        if edit == "I":
            left.append(names[initials[len(left)]] + ":")
            continue
        if edit != "D":
            role = rows[at][2] if edit == "K" else names[initials[len(left)]]
            left.append(f"{role}:{rows[at][3]}")
        at += 1
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts.values(), illegal, cost, audit,
            hashlib.sha256("\n".join(left).encode()).hexdigest())


def plain_damage(rows):
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        yield from [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)


def plain(rows):
    by = {r[0]: [] for r in rows}
    for r in plain_damage(rows):
        by[r[0]].append(r)
    return sorted(((c, *plain_rows(some)) for c, some in by.items()), key=repr)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    found = QUERIES["op13_repair"](spark, SF)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect()), key=repr) == plain(rows)


def awkward_rows():
    rng = random.Random(4)
    texts = ["Yes.", "No", "", " \n", "Why?\t", "é!", "a.b", "ok…", None, "x" * 100_000 + "."]
    rows = [(c, rng.choice([None, 0, 1, 2, 3, 9]), rng.choice(["user", "assistant", "system", "tool", "", None, "User"]),
             rng.choice(texts)) for c in (1, 2, 3, None) for _ in range(12)]
    rows += [(5, i, "user" if i % 2 else "assistant", f"turn {i}." if i % 7 else "turn") for i in range(700)]
    return rows + [(6, 1, "user", "same."), (6, 1, "user", "same.")] + [(7, None, "assistant", None)]


def test_awkward_rows(spark, tmp_path, nothing):
    rows = awkward_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("place", "fault", "code", "copy", "kind", "nth", "id"):
        df = df.withColumn(name, F.lit("clash"))
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["op13_repair"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows)


def test_messages_and_undamaged_rows(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Hm?"), (1, 2, "assistant", "Yes."), (2, 0, None, None)],
                               "conv_id long, turn long, role string, text string")
    judged = repair.judge(df)
    planned = repair.plans(judged)
    assert {r.conv_id: (r.cost, r.audit) for r in planned.collect()} == {1: (2, "DKK"), 2: (2, "D")}
    left = repair.repaired(judged, planned).orderBy("conv_id", "nth").collect()
    assert [tuple(r) for r in left] == [(1, 0, "user", "Hm?"), (1, 1, "assistant", "Yes.")]
    assert repair.digests(repair.repaired(judged, planned)).count() == 1
    empty = repair.judge(df.limit(0))
    assert repair.plans(empty).collect() == [] and repair.summary(empty).collect() == []
