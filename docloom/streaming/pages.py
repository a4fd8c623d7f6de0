"""An extension: the page stages as a stream. Parsing is stateless; exact repeats of a question are dropped with state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.chunking import heading_level
from ..sources.html import scan_pages


def page_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Pages (doc_id, html, seen_at) as they appear as parquet files in a folder."""
    return spark.readStream.schema("doc_id bigint, html string, seen_at timestamp").parquet(folder)


def block_stream(pages: DataFrame) -> DataFrame:
    """Blocks and tables of a stream of pages, with heading levels."""
    scanned = scan_pages(pages)
    return scanned.withColumn("level", F.when(F.col("kind") == "block", heading_level(F.col("text"), F.col("bold_ul"), F.col("italic"))))


def first_questions(questions: DataFrame, delay: str = "1 day") -> DataFrame:
    """Questions (question, asked_at) without exact repeats within the watermark's delay, in any case or spacing."""
    key = F.sha2(F.lower(F.regexp_replace(F.trim("question"), r"\s+", " ")), 256)
    return questions.withColumn("question_key", key).withWatermark("asked_at", delay).dropDuplicatesWithinWatermark(["question_key"]).drop("question_key")


def question_counts(questions: DataFrame, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Questions by type and window of time."""
    return questions.withWatermark("asked_at", delay).groupBy(F.window("asked_at", window), "question_type").agg(F.count("*").alias("n_questions")).select(F.col("window.start").alias("window_start"), "question_type", "n_questions")
