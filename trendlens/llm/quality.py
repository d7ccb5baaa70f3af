"""Operator 4, quality rules: a threshold table compiled into one projection.

``METRICS`` names per-document measures, ``RULES`` is the table of allowed
ranges over them. ``apply_rules`` turns both into Spark expressions: no user
function, no shuffle, and every document is judged on its own row.

Defined results: a NULL or empty text has no words, lines or symbols, so all
measures are 0, ratios over nothing are 0, and the base check fails it. Rows are
never merged, so repeated documents are judged once each, and no ties arise. A
document is never rejected for its size alone, above the least number of words.
Extra columns of the input are kept after the operator's own; a clashing one is
replaced.

The stop words are those of four languages (``STOP_WORDS``); text of any other
language holds too few of them and is rejected, unless its own are given.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# The word definition, its complement, and the counted symbols.
WORD = r"[^\x20\x09-\x0D]"
WHITE = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"

# Function words of the four languages of the corpus.
STOP_WORDS = (
    "the be to of and that have with is in it for on was are this by an as at",
    "der die das und ist in zu den von mit ein eine nicht auf für",
    "le la les de des et est un une que dans pour en du qui",
    "el la los las de que y en un una es por con para del",
)


@dataclass(frozen=True)
class Rule:
    """Keep documents whose ``metric`` lies within [low, high]; None is open."""
    name: str
    metric: str
    low: float | None = None
    high: float | None = None


# The threshold table. Ratios are per word, per line or per character.
RULES = (
    Rule("length", "n_words", 50, None),
    Rule("mean_word_length", "mean_word_chars", 2, 12),
    Rule("symbol_ratio", "symbols_per_word", None, 0.1),
    Rule("stop_words", "n_stop_words", 2, None),  # different ones
    Rule("duplicate_lines", "dup_line_ratio", None, 0.5),
    Rule("ellipsis_lines", "ellipsis_line_ratio", None, 0.3),
    Rule("bullet_lines", "bullet_line_ratio", None, 0.9),
    Rule("exclaimed_words", "exclaimed_word_ratio", None, 0.2),
)

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _ratio(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeat_words(words: str) -> Column:
    """Words lying in a 3-word window that the text holds at least twice.

    Windows (as 64-bit hashes, compared within one text only) are sorted with
    their positions, so equal ones stand side by side; the positions of repeated
    windows, sorted again, are intervals of three words, and the length of their
    union is a fold over them."""
    w, n = F.col(words), F.size(words)
    placed = F.sort_array(F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))))
    # Neighbours that are equal, as pairs of positions.
    pairs = _let(placed, lambda s: F.zip_with(
        s, F.slice(s, 2, n), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))))
    places = F.sort_array(F.array_distinct(F.flatten(F.array_compact(pairs))))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("sum"))
    union = F.aggregate(
        places, start,
        lambda s, p: F.struct(p.alias("last"), (s["sum"] + F.least(p - s["last"], F.lit(3))).alias("sum")),
        lambda s: s["sum"])
    return F.when(n < 4, F.lit(0)).otherwise(union)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stop_words=STOP_WORDS) -> DataFrame:
    """One row per input row: the id and every measure that rules can use. The
    stop words are given as lists of words in lower case, separated by spaces."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    spaced = F.trim(F.regexp_replace(text, f"{WHITE}+", " "))
    split = docs.select(
        F.col(id_col).alias("_id"), text.alias("_text"),
        F.filter(F.split(spaced, " "), lambda w: w != "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)).alias("_lines"))
    stops = sorted({w for row in stop_words for w in row.split()})
    # One generated row for each document: filters on the measures stay above the
    # generator, so that no measure (nor the words) is computed a second time.
    counted = split.select("_id", F.inline(F.array(F.struct(
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words("_words").cast("long").alias("n_repeat_words"),
        F.size(F.array_intersect(F.transform("_words", F.lower), F.lit(stops))).cast("long").alias("n_stop_words"),
        F.regexp_count("_text", F.lit(r"!!(?=\s|$)")).cast("long").alias("n_exclaimed_words"),
        F.size(F.filter("_lines", lambda x: x.endswith("...") | x.endswith("…"))).alias("n_ellipsis_lines"),
        F.size(F.filter("_lines", lambda x: x.rlike(r"^\s*[-*•]"))).alias("n_bullet_lines"),
    ))))
    return counted.select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "n_lines", "n_stop_words",
        _ratio("word_chars", "n_words").alias("mean_word_chars"),
        _ratio("n_symbols", "n_words").alias("symbols_per_word"),
        _ratio("n_exclaimed_words", "n_words").alias("exclaimed_word_ratio"),
        _ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        _ratio("n_ellipsis_lines", "n_lines").alias("ellipsis_line_ratio"),
        _ratio("n_bullet_lines", "n_lines").alias("bullet_line_ratio"),
    )


def compile_rules(rules=RULES) -> Column:
    """The names of the broken rules, as one array expression over measures. A rule
    open at both ends is never broken."""
    def broken(r: Rule) -> Column:
        m = F.col(r.metric)
        tests = [m < r.low] if r.low is not None else []
        tests += [m > r.high] if r.high is not None else []
        out = tests[0]
        for t in tests[1:]:
            out = out | t
        return F.when(out, F.lit(r.name))

    return F.filter(F.array(*[broken(r) for r in rules if r.low is not None or r.high is not None]),
                    lambda x: x.isNotNull())


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | \
        (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judge(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text",
          stop_words=STOP_WORDS) -> DataFrame:
    """Measures, the base check, the names of broken rules and the verdict."""
    judged = measure(docs, id_col, text_col, stop_words).withColumn("base_failed", base_failed()) \
        .withColumn("broken_rules", compile_rules(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))


def keep_good(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text",
              stop_words=STOP_WORDS) -> DataFrame:
    """The input rows (all their columns) whose verdict is to keep.

    The whole row travels beside the measures as one struct, so no join back
    and no shuffle is needed and clashing column names cannot matter."""
    row = F.struct(*[docs[c] for c in docs.columns])
    carried = docs.select(docs[text_col].alias("text"), row.alias("doc_id"))
    kept = judge(carried, rules, stop_words=stop_words).filter("kept")
    return kept.select("doc_id.*")
