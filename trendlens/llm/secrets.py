"""Operator 9, secret scans (DataFrame functions only).

Base patterns find keyed assignments, access keys and long hexadecimal runs. The
method adds tokens that look random: two character Markov models, one of random
strings and one of ordinary identifiers, score every long token by the ratio of
their log-likelihoods, character by character. A token that base spans touch is cut
there, and each part of ``LEAST_TOKEN`` characters or more is scored by itself.

The models are trained from labelled samples of the corpus itself: the values
that the base patterns match are labelled random, the other identifier-like
tokens ordinary. Each sample is bounded (``SAMPLE`` different tokens, the lowest
by hash); transition counts are made by Spark, and only the table of
``CODES``**2 ratios reaches the driver. Scanning covers every whole text.

Defined results: NULL and empty texts have no spans; repeated documents are
scanned each; without random samples both models are uniform and nothing is
added; equal spans of two kinds are both listed, in the order of ``KINDS``. Columns
named like a result are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# The base patterns, and the least length of what counts.
ASSIGN = r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
LEAST = {"assign": 8, "access": 16, "hex": 32}
# The hexadecimal runs of words are many and short; this finds the same long runs.
LONG_HEX = r"[0-9a-f]{32,}"
LONG_ACCESS = r"AKIA[A-Z0-9]{12,}"

TOKEN = r"[A-Za-z0-9_+/=-]{20,}"
LEAST_TOKEN = 20
IDENTIFIER = r"[A-Za-z0-9_+/=-]{8,}"
ALPHABET = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_+/=.-")
SAMPLE = 20_000
CODES = 128
SMOOTHING = 0.5
# A token is random if the mean log-likelihood ratio of its steps exceeds this.
MARGIN = 0.5

SPAN = "array<struct<start:int,kind:int,stop:int>>"


def _matches(text: Column, pattern: str, kind: int, value_group: int = 0, least: int = 1) -> Column:
    """Spans of the matches whose group has at least ``least`` characters. Places
    come from the lengths of the matches and of the pieces between them."""
    lengths = F.zip_with(
        F.split(text, pattern, -1),
        F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("v")),
        lambda piece, m: F.struct(F.length(piece).alias("gap"), F.length(m["m"]).alias("len"),
                                  F.length(m["v"]).alias("value")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(s, x):
        begin = s["at"] + x["gap"]
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), (begin + x["len"]).alias("stop"))
        return F.struct((begin + F.coalesce(x["len"], F.lit(0))).alias("at"),
                        F.when(x["value"] >= least, F.concat(s["spans"], F.array(span)))
                        .otherwise(s["spans"]).alias("spans"))

    return F.when(text.rlike(pattern), F.aggregate(lengths, start, step, lambda s: s["spans"])) \
        .otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    return F.concat(_matches(text, ASSIGN, 0, 2, LEAST["assign"]), _matches(text, LONG_ACCESS, 1),
                    _matches(text, LONG_HEX, 2))


def train(docs: DataFrame, text: str = "text", sample: int = SAMPLE, labelled: DataFrame | None = None) -> list[float]:
    """The table of log-likelihood ratios, indexed by CODES * first + second
    (code 0 stands before the token). ``labelled`` (token string, random
    boolean) adds samples of other origin to those of the corpus."""
    t = F.coalesce(F.col(text), F.lit(""))
    values = docs.filter(t.rlike(f"{ASSIGN}|{LONG_ACCESS}|{LONG_HEX}")).select(F.explode(F.concat(
        F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2)), F.regexp_extract_all(t, F.lit(LONG_ACCESS), F.lit(0)),
        F.regexp_extract_all(t, F.lit(LONG_HEX), F.lit(0)))).alias("token")).filter(F.length("token") >= 8)
    bare = F.regexp_replace(t, f"{ASSIGN}|{LONG_ACCESS}|{LONG_HEX}", " ")
    plain = docs.select(F.explode(F.regexp_extract_all(bare, F.lit(IDENTIFIER), F.lit(0))).alias("token"))

    if labelled is not None:
        values = values.union(labelled.filter("random").select("token"))
        plain = plain.union(labelled.filter("not random").select("token"))

    def counts(tokens: DataFrame) -> dict[tuple[int, int], int]:
        chosen = tokens.groupBy("token").agg(F.lit(1).alias("one")) \
            .orderBy(F.xxhash64("token"), "token").limit(sample)
        chars = F.concat(F.array(F.lit(0)), F.transform(F.split("token", ""), lambda c: F.ascii(c)))
        steps = F.explode(F.zip_with(chars, F.slice(chars, 2, F.size(chars)),
                                     lambda a, b: F.struct(a.alias("a"), b.alias("b"))))
        rows = chosen.select(steps.alias("s")).filter("s.b is not null").groupBy("s.a", "s.b").count().collect()
        return {(r["a"], r["b"]): r["count"] for r in rows}

    return ratios(counts(values), counts(plain))


def ratios(random: dict[tuple[int, int], int], ordinary: dict[tuple[int, int], int]) -> list[float]:
    """Smoothed log ratios of the two models' transition probabilities."""
    # Both models share one alphabet: what tokens may hold, and what else was seen.
    symbols = len(ALPHABET | {b for _, b in [*random, *ordinary]})

    def logs(steps):
        totals = [0.0] * CODES
        for (a, _), n in steps.items():
            totals[a] += n
        return lambda a, b: math.log((steps.get((a, b), 0) + SMOOTHING) / (totals[a] + SMOOTHING * symbols))

    if not random:
        return [0.0] * (CODES * CODES)
    r, o = logs(random), logs(ordinary)
    return [round(r(a, b) - o(a, b), 6) for a in range(CODES) for b in range(CODES)]


def _score(token: Column, table: Column) -> Column:
    """The mean ratio of a token's steps."""
    start = F.struct(F.lit(0).alias("before"), F.lit(0.0).alias("sum"))
    total = F.aggregate(
        F.transform(F.split(token, ""), lambda c: F.ascii(c)), start,
        lambda s, c: F.struct(c.alias("before"), (s["sum"] + F.get(table, s["before"] * CODES + c)).alias("sum")),
        lambda s: s["sum"])
    return total / F.length(token)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _outside(token: Column, base: Column) -> Column:
    """The parts of a token that no base span covers, those of ``LEAST_TOKEN``
    characters or more, as spans. ``base`` is sorted."""
    start = F.struct(token["start"].alias("at"), F.array().cast(SPAN).alias("parts"))

    def with_part(s, stop):
        span = F.struct(s["at"].alias("start"), F.lit(3).alias("kind"), stop.alias("stop"))
        return F.when(stop - s["at"] >= LEAST_TOKEN, F.concat(s["parts"], F.array(span))).otherwise(s["parts"])

    def step(s, b):
        cut = (b["start"] < token["stop"]) & (s["at"] < b["stop"])
        return F.when(cut, F.struct(b["stop"].alias("at"), with_part(s, b["start"]).alias("parts"))).otherwise(s)

    return F.aggregate(base, start, step, lambda s: with_part(s, token["stop"]))


def scan(docs: DataFrame, table: list[float], text: str = "text", margin: float = MARGIN) -> DataFrame:
    """``docs`` with base and extra: arrays of (start, kind, stop) in code points."""
    ratio = F.split(F.lit(",".join(map(str, table))), ",").cast("array<double>")
    t = F.coalesce(F.col(text), F.lit(""))
    found = docs.withColumn("base", base_spans(t)).withColumn(
        "_tokens", F.when(t.rlike(TOKEN), _matches(t, TOKEN, 3)).otherwise(F.array().cast(SPAN)))
    apart = F.flatten(F.transform("_tokens", lambda c: _outside(c, F.sort_array("base"))))
    extra = F.filter(apart, lambda c: _score(F.substr(t, c["start"] + 1, c["stop"] - c["start"]), ratio) > margin)
    return found.withColumn("extra", F.when(F.size("_tokens") > 0, extra).otherwise(F.array().cast(SPAN))).drop("_tokens")


def digest(found: DataFrame) -> DataFrame:
    def n(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "extra")).alias("spans"))


def redact(found: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The texts with every span (overlapping ones as one) replaced by ``mark``."""
    t = F.col(text)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = F.aggregate(
        F.sort_array(F.concat("base", "extra")), start,
        lambda s, x: F.struct(F.greatest(s["at"], x["stop"]).alias("at"), F.when(x["start"] >= s["at"], F.concat(
            s["out"], F.substr(t, s["at"] + 1, x["start"] - s["at"]), F.lit(mark))).otherwise(s["out"]).alias("out")),
        lambda s: F.concat(s["out"], F.substr(t, s["at"] + 1)))
    return found.withColumn(text, F.when(F.size("base") + F.size("extra") > 0, rest).otherwise(t)).drop("base", "extra")
