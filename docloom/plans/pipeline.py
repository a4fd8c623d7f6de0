"""The pipeline: pages to chunks and tables, candidates, verification, deduplication, labels and output."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..config import DEFAULT, Config, logger
from ..operators.chunking import chunk_pages
from ..operators.dedup import deduplicate, drop_rate
from ..operators.generation import checked_candidates, chunk_groups, read_replies, replies
from ..operators.labels import difficulty_distribution, output_rows
from ..operators.tables import extract_tables, table_passages
from ..operators.verification import skip_verification, verify
from ..sources.files import CHUNK_SCHEMA, TABLE_SCHEMA, read_json, write_json, write_output
from ..sources.html import scan_pages
from ..sources.providers import Completion, Embedder, load_prompts, providers_of
from ..storage import materialize


class EmptyStage(RuntimeError):
    """A stage left no rows to go on with."""


@dataclass
class Result:
    chunks: DataFrame
    tables: DataFrame
    candidates: DataFrame
    verified: DataFrame
    deduplicated: DataFrame
    output: DataFrame
    #: Figures of the stages: candidates, kept share, drop rate in percent, rows by difficulty.
    figures: dict[str, float | int | dict[str, int]]


def passages(pages: DataFrame, config: Config = DEFAULT, stage_path: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Chunks, tables, and both as passages to generate from. Pages are parsed once, to the shared folder.

    With a ``stage_path``, chunks and tables are written there as JSON lines, and read from there if both are there.
    """
    spark = pages.sparkSession
    if stage_path and _exists(spark, f"{stage_path}/chunks/_SUCCESS") and _exists(spark, f"{stage_path}/tables/_SUCCESS"):
        chunks, tables = read_json(spark, f"{stage_path}/chunks", CHUNK_SCHEMA), read_json(spark, f"{stage_path}/tables", TABLE_SCHEMA)
    else:
        scanned = materialize(scan_pages(pages), "blocks")
        chunks, tables = chunk_pages(scanned, config), extract_tables(scanned, config)
        if stage_path:
            write_json(chunks, f"{stage_path}/chunks")
            write_json(tables, f"{stage_path}/tables")
            chunks, tables = read_json(spark, f"{stage_path}/chunks", CHUNK_SCHEMA), read_json(spark, f"{stage_path}/tables", TABLE_SCHEMA)
    return chunks, tables, chunks.unionByName(table_passages(tables))


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def run(
    pages: DataFrame,
    generator: Completion | None = None,
    verifier: Completion | None = None,
    embedder: Embedder | None = None,
    skip_verify: bool = False,
    out_path: str | None = None,
    config: Config = DEFAULT,
    stage_path: str | None = None,
) -> Result:
    """All stages, with the providers of the settings unless others are given.

    Model calls are costly and may differ from call to call: their results are written before they are used. Raises
    EmptyStage if no candidate is found or none is kept; fewer rows than ``min_rows`` only warn.
    """
    log = logger(__name__)
    own = providers_of(config)
    generator, verifier, embedder = generator or own[0], verifier or own[1], embedder or own[2]
    prompts, check = load_prompts(config.prompts_folder)
    chunks, tables, both = passages(pages, config, stage_path)
    groups = chunk_groups(materialize(both, "passages"), config=config)
    answered = materialize(replies(groups, generator, config, prompts), "replies")
    candidates = materialize(checked_candidates(read_replies(answered), config=config), "candidates")
    n_candidates = candidates.count()
    if not n_candidates:
        raise EmptyStage("no candidate passed the check of its quotation")
    verified = materialize(skip_verification(candidates) if skip_verify else verify(candidates, verifier, embedder, config, check), "verified")
    kept = verified.where("keep")
    n_kept = kept.count()
    log.info("%d candidates, %d kept", n_candidates, n_kept)
    if not n_kept:
        raise EmptyStage("no candidate passed verification")
    marked = materialize(deduplicate(kept, embedder, config=config), "deduplicated")
    output = materialize(output_rows(marked.where("is_kept")), "output")
    dropped = drop_rate(marked).first()
    levels = {r["difficulty"]: r["n_rows"] for r in difficulty_distribution(output).collect()}
    figures = {"candidates": n_candidates, "kept_share": n_kept / n_candidates, "drop_pct": dropped["drop_pct"], "rows": dropped["n_rows"] - dropped["n_dropped"], "by_difficulty": levels}
    log.info("figures: %s", figures)
    if figures["rows"] < config.min_rows:
        log.warning("only %d rows, %d were aimed at", figures["rows"], config.min_rows)
    if out_path:
        write_output(output, out_path, config.output_format)
    return Result(chunks, tables, candidates, verified, marked, output, figures)
