"""Difficulty by rule, and the output rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Levels and the order of the output columns.
LEVELS = ("easy", "medium", "hard")
OUTPUT_COLUMNS = ("id", "question", "answer", "source_passage", "source_item", "source_section", "source_page", "question_type", "difficulty", "context_recall_score", "faithfulness_pass", "numeric_check_pass", "verbatim_match_score", "verifier_confidence", "verifier_reason", "source_chunk_ids")


def difficulty(question_type: Column, chunk_ids: Column) -> Column:
    """Several sources or a type that combines statements: hard; arithmetic: medium; one fact: easy; else medium."""
    return F.when((F.coalesce(F.size(chunk_ids), F.lit(0)) >= 2) | question_type.isin("multi_step_reasoning", "comparison"), "hard").when(question_type == "numeric_calculation", "medium").when(question_type == "fact_extraction", "easy").otherwise("medium")


def difficulty_distribution(labelled: DataFrame, column: str = "difficulty") -> DataFrame:
    """Rows of each level, 0 for levels without any. Three counts in one pass, no join."""
    counts = labelled.agg(*[F.count_if(F.col(column) == level).alias(level) for level in LEVELS])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(level).alias("difficulty"), F.col(level).alias("n_rows")) for level in LEVELS])).alias("r")).select("r.*")


def output_rows(qa: DataFrame) -> DataFrame:
    """Verified pairs as flat rows, in the order of the output's columns."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    out = qa.select(
        "id", "question", "answer", "source_passage", text("item").alias("source_item"), F.col("heading_path").alias("source_section"), F.lit("").alias("source_page"), "question_type",
        difficulty(F.col("question_type"), F.col("source_chunk_ids")).alias("difficulty"), F.round("context_recall_score", 4).alias("context_recall_score"), "faithfulness_pass", "numeric_check_pass",
        F.round("verbatim_match_score", 4).alias("verbatim_match_score"), text("verifier_confidence").alias("verifier_confidence"), "verifier_reason", F.array_join("source_chunk_ids", ";").alias("source_chunk_ids"),
    )
    return out.select(*OUTPUT_COLUMNS)
