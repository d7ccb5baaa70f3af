"""Operator 6, line dedup by site-relative frequency (DataFrame functions only).

For each host, a line's ratio is the number of its pages that hold the line,
divided by the number of its pages. Lines above ``max_ratio`` are boilerplate and
leave every page of that host. On a small host a ratio may be chance: a line on
fewer than ``min_pages`` pages must be above ``SMALL_RATIO``, and on one page alone
it is never boilerplate. So a host of any size of two pages or more is judged.

Defined results: NULL hosts form one host; a NULL text stays NULL and counts as
a page without lines; lines without a word are neither counted nor dropped; a
line repeated in one page counts once there, and all its repeats go. Repeated
rows are pages of their own. A page that loses all lines keeps its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from trendlens.llm.common import written

MAX_RATIO = 0.05
MIN_PAGES = 10
SMALL_RATIO = 0.8
BLANK = r"^\s*$"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _key(line: Column) -> Column:
    """A 128-bit key of a line; the lines themselves are not shuffled."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def boilerplate(pages: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, keys): the keys of each host's boilerplate lines.

    ``pages`` has columns host and text. Pages are counted before the shuffle
    (one partial count for each line, host and task), so a hot host or line
    reaches a reducer as one row for each task. A host has at most
    (mean lines of its pages) / ``max_ratio`` keys."""
    pages = pages.select(F.coalesce("host", F.lit("")).alias("host"), "text")
    line = F.explode(F.array_distinct(F.filter(_lines(F.col("text")), lambda x: ~x.rlike(BLANK))))
    counts = pages.select("host", line.alias("line")).groupBy("host", _key(F.col("line")).alias("key")) \
        .agg(F.count("*").alias("n")).filter("n > 1")
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    n, pages = F.col("n"), F.col("pages")
    above = (n > max_ratio * pages) & ((n >= min_pages) | (n > SMALL_RATIO * pages))
    return counts.join(totals, "host").filter(above) \
        .groupBy("host").agg(F.collect_list("key").alias("keys"))


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text",
                     max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """All columns of ``pages`` with the text rewritten, then n_lines (with a
    word) and n_dropped. The boilerplate table is written first, so Spark joins
    by its true size: broadcast if it is small, else a shuffle join, in which a
    hot host's pages are split (adaptive skew join)."""
    found = written(boilerplate(pages.select(pages[host].alias("host"), pages[text].alias("text")),
                                max_ratio, min_pages), "lines")
    row = F.struct(*[pages[c] for c in pages.columns])
    carried = pages.select(row.alias("row"), F.coalesce(pages[host], F.lit("")).alias("host"),
                           pages[text].alias("text"))
    joined = carried.join(found, "host", "left").select(
        "row", "text", _lines(F.col("text")).alias("lines"), F.coalesce("keys", F.array()).alias("keys"))
    kept = F.when(F.size("keys") == 0, F.col("lines")).otherwise(
        F.filter("lines", lambda x: x.rlike(BLANK) | ~F.array_contains(F.col("keys"), _key(x))))
    out = joined.select("row", "text", "lines", kept.alias("kept"))
    n = F.size(F.filter("lines", lambda x: ~x.rlike(BLANK))).cast("long")
    rewritten = F.when(F.col("text").isNotNull(), F.array_join("kept", "\n"))
    names = [c for c in pages.columns if c not in ("n_lines", "n_dropped")]
    return out.select(
        *[rewritten.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in names],
        n.alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"))
