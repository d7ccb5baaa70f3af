"""Delimited tag lists: one row per tag, and ordered tag pairs per row."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from trendlens.functions._cols import as_col

# Fixed value: tags are separated by a vertical bar.
TAG_SEPARATOR = "|"


def tag_array(col, sep: str = TAG_SEPARATOR) -> Column:
    """``split`` on a literal separator: ``''`` gives ``['']`` and an empty item
    between two separators is kept; NULL stays NULL."""
    return F.split(as_col(col), re.escape(sep))


def explode_tags(df: DataFrame, col: str = "tags", sep: str = TAG_SEPARATOR,
                 name: str = "tag") -> DataFrame:
    """One output row per tag occurrence; rows with NULL tags give none."""
    return df.withColumn(name, F.explode(tag_array(col, sep)))


def frequent_tags(df: DataFrame, share: float, col: str = "tags", sep: str = TAG_SEPARATOR,
                  tracked: int = 4096) -> DataFrame:
    """(tag, estimate, least, total): the tags that may hold at least ``share`` of all
    tag occurrences, from a sketch of bounded size, whatever the vocabulary.

    Each task keeps at most ``tracked`` counters, and the counters of all tasks are
    merged into one sketch of that size: memory does not grow with the number of
    different tags, nor does what is shuffled. The sketch drops counts when it is full;
    a tag is off by at most ``max_error`` = 3.5 / (its map's size) of the total. So every
    tag that truly reaches ``share`` is returned, and a returned tag occurs at least
    ``least`` times. With at most ``tracked`` different tags the counts are exact (then
    ``least`` is still the guaranteed bound, not the count)."""
    if not 0 < share <= 1:
        raise ValueError("share must be within (0, 1]")
    slots = 1 << max(3, -(-4 * tracked // 3) - 1).bit_length()  # the size of the sketch's map
    max_error = 3.5 / slots
    if max_error >= share:
        raise ValueError(f"{tracked} tracked tags cannot tell a share of {share}")
    k = min(tracked, int(1 / (share - max_error)) + 1)  # no more tags can look that frequent
    found = explode_tags(df.select(col), col, sep).agg(
        F.expr(f"approx_top_k(tag, {k}, {tracked})").alias("top"), F.count("*").alias("total"))
    rows = found.select("total", F.inline("top")).withColumnRenamed("item", "tag")
    error = F.ceil(F.col("total") * max_error).cast("bigint")
    return rows.where(F.col("count") + error >= F.col("total") * share).select(
        "tag", F.col("count").alias("estimate"), F.greatest(F.col("count") - error, F.lit(0)).alias("least"), "total")


def sorted_pairs(arr, joiner: str = TAG_SEPARATOR) -> Column:
    """All ``a[i] || joiner || a[j]`` with i < j of a sorted copy of ``arr``.

    Arrays with fewer than two items give an empty array (no NULL pair);
    duplicates in the array produce repeated pairs. The sorted copy is bound as
    the one item of an array, so it is made once per row and not once per pair.
    """
    def pairs(a: Column) -> Column:
        n = F.size(a)
        every = F.flatten(F.transform(
            F.sequence(F.lit(1), n - 1),
            lambda i: F.transform(F.slice(a, i + 1, n),
                                  lambda x: F.concat(F.element_at(a, i), F.lit(joiner), x))))
        return F.when(n >= 2, every).otherwise(F.array().cast("array<string>"))

    return F.element_at(F.transform(F.array(F.array_sort(as_col(arr))), pairs), 1)


def tag_pairs(df: DataFrame, col: str = "tags", sep: str = TAG_SEPARATOR,
              distinct_tags: bool = False, name: str = "tag_pair") -> DataFrame:
    """One output row per unordered tag pair of each input row (Q-1, Q-15).

    The pairs of a row are generated inside that row's array by JVM
    expressions; nothing is grouped or shuffled to build them.
    """
    arr = tag_array(col, sep)
    if distinct_tags:
        arr = F.array_distinct(arr)
    return df.withColumn(name, F.explode(sorted_pairs(arr, sep)))


def keep_pairable_tags(items: DataFrame, key: str, col: str = "tags", min_count: int = 1,
                       sep: str = TAG_SEPARATOR, distinct_tags: bool = False,
                       name: str = "tag_list") -> DataFrame:
    """Each item's sorted tag array, without the tags that cannot be part of
    any pair emitted at least ``min_count`` times (exact pruning).

    A pair (a, b) emitted c times satisfies c <= sum over a's occurrences of
    (tags in that item - 1) -- and, with distinct tags, c <= number of items
    carrying a. Tags under the bound are dropped; every pair that can reach
    ``min_count`` keeps exactly the same occurrences, so pair counts and their
    averages are unchanged. Rare long-tail tags, the bulk of a real tag
    vocabulary, never enter the quadratic pair step.

    The pruned set is joined back without a hint: AQE broadcasts it when the
    shuffle shows it small and splits a skewed (hot) tag otherwise. Items are
    regrouped by ``key``; a group holds one item's own tags.
    """
    arr = tag_array(col, sep)
    if distinct_tags:
        arr = F.array_distinct(arr)
    other = [c for c in items.columns if c not in (key, col)]
    exploded = (items.select(key, *other, arr.alias("_arr"))
                .select(key, *other, (F.size("_arr") - 1).alias("_others"),
                        F.explode("_arr").alias("_tag")))
    bound = F.count("*") if distinct_tags else F.sum("_others")
    pairable = (exploded.where(F.col("_others") > 0).groupBy("_tag").agg(bound.alias("_bound"))
                .where(F.col("_bound") >= min_count).select("_tag"))
    kept = exploded.join(pairable, "_tag", "left_semi")
    return (kept.groupBy(key).agg(*[F.max(c).alias(c) for c in other],
                                  F.array_sort(F.collect_list("_tag")).alias(name)))
