"""op5, op9: queries that learn from labels and score all documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.quality import fit_quality, score_quality
from tickloom.llm.registry import query, table
from tickloom.llm.samples import in_fold
from tickloom.llm.toxicity import fit_lexicon, score_texts

#: Folds of the keys' CRC-32 that no label is learned from: how many folds, and which.
TOXIC_FOLD, QUALITY_FOLD = (4, 2), (5, 0)
LEAST = 0.3


def _held_out(fold: tuple[int, int]) -> Column:
    return in_fold(F.col("doc_id"), *fold)


def _result(scored: DataFrame, fold: tuple[int, int]) -> DataFrame:
    return scored.select(
        "doc_id", _held_out(fold).alias("held_out"), "score", (F.col("score") >= LEAST).cast("int").alias("predicted")
    )


@query("op5_toxicity")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    lexicon = fit_lexicon(docs, table(spark, folder, "labels"), _held_out(TOXIC_FOLD))
    return _result(score_texts(docs, lexicon, name="score"), TOXIC_FOLD)


@query("op9_quality")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, folder, "labels"), _held_out(QUALITY_FOLD))
    return _result(score_quality(docs, model, name="score"), QUALITY_FOLD)
