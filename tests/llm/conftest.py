"""Small awkward tables for the operators of the llm folder."""

import pytest

PROSE = ("The quick brown fox jumps over the lazy dog while seventeen sailors of the northern fleet "
         "count the silver coins that a merchant left in the old wooden house by the river and ")


def words(n, salt):
    """n different invented words; equal salts give equal words."""
    return " ".join(f"w{salt}x{i}" for i in range(n))


@pytest.fixture
def awkward(spark):
    """NULLs, empty, short, very long, repeated and tied rows, and extra columns
    whose names clash with those that operators use."""
    base = words(80, 1)
    rows = [
        (1, base, "a"), (2, base, "a"), (2, base, "a"), (3, None, None), (4, "", "a"), (5, " \n\t \n", "b"),
        (6, "one two three", "b"), (7, base.replace("w1x40", "other"), "a"),
        (8, words(20_000, 2), "b"), (None, base, "a"), (9, "y" * 500, "b"), (10, "é ß ñ 中文 \x00 ▁ <|end|> \\", None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    from pyspark.sql import functions as F
    for name in ("n_words", "hits", "items", "host", "keys", "key", "lines", "rule", "label", "base", "kept", "_id"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")
