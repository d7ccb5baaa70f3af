"""The corpus pipeline: documents in, cleaned and tokenised documents out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result to the shared checkpoint folder and reads it again as the next
stage's documents. All stages but the last return the columns of ``documents``.

1. quality_rules: rejected documents go.
2. line_dedup: boilerplate lines of each source go from the texts.
3. near_dedup: of each group of near-duplicates the lowest doc_id stays.
4. decontaminate: runs that benchmark items share go from the texts; documents
   that are mostly such runs go.
5. sentencepiece: (doc_id, text, n_pieces, pieces); the text is decoded back from
   the pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trendlens.llm import decontaminate, lines, minhash, pieces, quality
from trendlens.llm.common import read, written


def _carried(docs: DataFrame, operate) -> DataFrame:
    """The result of an operator with all columns of ``docs``, whatever their names:
    the operator sees doc_id, source and text, and all other columns travel in one
    struct. n_chars, where there is one, is that of the new text."""
    rest = [c for c in docs.columns if c != "text"]
    result = operate(docs.select("doc_id", "source", "text", F.struct(*rest).alias("row")))

    def column(c: str):
        if c == "text":
            return F.col("text")
        return (F.length("text").cast(docs.schema[c].dataType) if c == "n_chars" else F.col("row").getField(c)).alias(c)

    return result.select(*[column(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _carried(docs, lines.drop_boilerplate)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _carried(docs, minhash.keep_first)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _carried(docs, lambda d: decontaminate.remove(d, read(spark, sf_dir, "benchmark")))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = pieces.Model.load()
    back = pieces.encode(docs, model, round_trip=True)
    return back.select("doc_id", "text", F.size(F.coalesce("pieces", F.array())).cast("long").alias("n_pieces"),
                       "pieces")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminated),
    ("sentencepiece", sentencepiece),
]

# The near-duplicate classes (signatures, components) and the piece folds are not
# expressible in SQL; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
