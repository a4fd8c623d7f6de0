"""Verification of candidates: embeddings and recall, faithfulness by a model, arithmetic for numeric questions."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.numeric import numeric_check
from ..functions.schema import with_fields
from ..functions.text import json_text
from ..sources.providers import FAITHFULNESS_PROMPT, Completion, Embedder, complete_with_retry, split_prompt


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors in double precision; 0 if either has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms).otherwise(0.0)


def embed(texts: DataFrame, embedder: Embedder, text: str = "text", name: str = "vector", batch: int = 32) -> DataFrame:
    """Adds the vector of each text; null texts count as empty."""
    schema = with_fields(texts, f"{name} array<float>")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = ["" if v is None else v for v in frame[text].tolist()]
            vectors: list[list[float]] = []
            for i in range(0, len(values), batch):
                vectors += embedder.embed(values[i : i + batch])
            yield frame.assign(**{name: vectors})

    return texts.mapInPandas(run, schema)


def context_recall(qa: DataFrame, embedder: Embedder, batch: int = 32) -> DataFrame:
    """Adds context_recall_score, the cosine of answer and passage. Both are embedded in one stage, without a shuffle."""
    answered = embed(qa, embedder, "answer", "_a", batch)
    both = embed(answered, embedder, "source_passage", "_p", batch)
    return both.withColumn("context_recall_score", cosine(F.col("_a"), F.col("_p"))).drop("_a", "_p")


def read_verdict(reached: bool, found: str | None) -> tuple[bool | None, str | None, str]:
    """Match, confidence and reason by the JSON of a verifier's reply; unreadable replies and other values say nothing."""
    if not reached:
        return None, None, "the verifier could not be reached"
    parsed = json.loads(found) if found else None
    if not isinstance(parsed, dict):
        return None, None, "the verifier's reply could not be read"
    match = parsed.get("matches_claimed_answer")
    if isinstance(match, str):
        match = match.strip().lower() == "true"
    confidence, reason = parsed.get("confidence"), parsed.get("reason")
    return (None if match is None else bool(match)), (None if confidence is None else str(confidence)), "" if reason is None else str(reason)


def faithfulness(qa: DataFrame, provider: Completion, config: Config = DEFAULT, prompt: str = FAITHFULNESS_PROMPT) -> DataFrame:
    """Adds faithfulness_pass, verifier_confidence and verifier_reason, one call with retries for each row."""

    def call(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, user = split_prompt(prompt)
        for frame in frames:
            texts = zip(frame["source_passage"], frame["question"], frame["answer"])
            yield frame.assign(_reply=[complete_with_retry(provider, system, user.format(source_passage=p, question=q, answer=a), config.verify_retries, config.verify_backoff_s) for p, q, a in texts])

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [read_verdict(reached, text) for reached, text in zip(frame["_reached"], frame["_json"])]
            passed = pd.Series([f[0] for f in found], dtype=object, index=frame.index)
            yield frame.drop(columns=["_reached", "_json"]).assign(faithfulness_pass=passed, verifier_confidence=[f[1] for f in found], verifier_reason=[f[2] for f in found])

    called = qa.mapInPandas(call, with_fields(qa, "_reply string"))
    cleaned = called.select(*qa.columns, F.col("_reply").isNotNull().alias("_reached"), json_text(F.col("_reply"), "{}").alias("_json"))
    return cleaned.mapInPandas(read, with_fields(qa, "faithfulness_pass boolean, verifier_confidence string, verifier_reason string"))


def keep(passed: Column, recall: Column, config: Config = DEFAULT) -> Column:
    """Kept if it passed and its recall is high enough; an unknown verdict or recall is no pass."""
    return F.coalesce(passed & (recall >= config.recall_from), F.lit(False))


def verify(qa: DataFrame, verifier: Completion, embedder: Embedder, config: Config = DEFAULT, prompt: str = FAITHFULNESS_PROMPT) -> DataFrame:
    """All candidates with their verification; numeric questions are split off before, so no model sees them."""
    scored = context_recall(qa, embedder, config.embed_batch)
    numeric = F.coalesce(F.col("question_type") == "numeric_calculation", F.lit(False))
    checked = scored.where(numeric).withColumn("_c", numeric_check(F.col("source_passage"), F.col("answer"), config.numeric_tolerance_pct))
    by_arithmetic = checked.select(*scored.columns, F.lit(None).cast("boolean").alias("faithfulness_pass"), F.col("_c.pass").alias("numeric_check_pass"), F.lit(None).cast("string").alias("verifier_confidence"), F.col("_c.reason").alias("verifier_reason"))
    by_model = faithfulness(scored.where(~numeric), verifier, config, prompt).withColumn("numeric_check_pass", F.lit(None).cast("boolean"))
    both = by_arithmetic.unionByName(by_model)
    return both.withColumn("keep", keep(F.coalesce("numeric_check_pass", "faithfulness_pass"), F.col("context_recall_score"), config))


def skip_verification(qa: DataFrame) -> DataFrame:
    """All candidates kept, unverified."""
    none = lambda kind: F.lit(None).cast(kind)
    return qa.select("*", F.lit(1.0).alias("context_recall_score"), none("boolean").alias("faithfulness_pass"), none("boolean").alias("numeric_check_pass"), none("string").alias("verifier_confidence"), F.lit("SKIPPED").alias("verifier_reason"), F.lit(True).alias("keep"))
