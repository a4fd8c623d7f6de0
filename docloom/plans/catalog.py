"""Queries of the engine over the test tables, each with its SQL twin where SQL can say the same."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions import numeric, text
from ..operators import chunking, dedup, fuzzy, generation, labels, sampling, tables, verification
from ..sources import files
from ..sources.html import scan_pages
from ..storage import work_path
from . import catalog_sql


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each chunk once; a second delivery repeats its content."""
    return _read(spark, sf_dir, "chunks").select("filing_id", "chunk_id", "heading_path", "part", "item", "text", "order_index").dropDuplicates(["chunk_id"])


def _qa(spark: SparkSession, sf_dir: str, only: str = "true") -> DataFrame:
    """Each pair once. A condition goes before the deduplication, so that it reaches the scan."""
    return _read(spark, sf_dir, "generated_qa").where(only).drop("loaded_at").dropDuplicates(["id"])


def _tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "extracted_tables").drop("loaded_at").dropDuplicates(["table_id"])


def q_numeric_check(spark, sf_dir):
    qa = _qa(spark, sf_dir, "question_type = 'numeric_calculation'")
    checked = qa.select("id", numeric.numeric_check(F.col("source_passage"), F.col("answer")).alias("c"))
    return checked.select("id", F.col("c.pass").alias("passed"), F.round("c.claimed", 6).alias("claimed"), F.col("c.relationship").alias("relationship"), F.size("c.numbers").alias("n_numbers"))


def q_numbers(spark, sf_dir):
    return _qa(spark, sf_dir).select("id", F.posexplode(numeric.numbers(F.col("source_passage"))).alias("pos", "value"))


def q_claimed_value(spark, sf_dir):
    return _qa(spark, sf_dir).select("id", numeric.claimed_value(F.col("answer")).alias("claimed")).where("claimed is not null")


def q_tokens(spark, sf_dir):
    return _chunks(spark, sf_dir).select("chunk_id", text.token_estimate(F.coalesce("text", F.lit(""))).alias("tokens"))


def _lines(spark, sf_dir):
    """Lines of all documents as blocks: short lines in capitals and lines of few words stand for styled headings."""
    docs = _read(spark, sf_dir, "documents").where("text is not null")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "text"))
    return lines.where(F.length(text.strip(F.col("text"))) > 0).withColumns({"bold_ul": F.length("text") < 60, "italic": F.lit(False)})


def q_heading_level(spark, sf_dir):
    lines = _lines(spark, sf_dir)
    return lines.select("doc_id", "pos", chunking.heading_level(F.col("text"), F.col("bold_ul"), F.col("italic")).alias("level"))


def _marked_lines(spark, sf_dir):
    level = F.when(F.length("text") < 40, F.pmod(F.length("text"), F.lit(5))).cast("int")
    return _lines(spark, sf_dir).select("doc_id", "pos", "text", F.when(level < 4, level).alias("level"))


def q_heading_path(spark, sf_dir):
    return chunking.with_heading_state(_marked_lines(spark, sf_dir)).select("doc_id", "pos", "part", "item", "heading_path")


def q_sections(spark, sf_dir):
    return chunking.sections(_marked_lines(spark, sf_dir)).select("doc_id", F.col("section").cast("long").alias("section"), "heading_path", "text")


def q_pack_paragraphs(spark, sf_dir):
    return _chunks(spark, sf_dir).where("text is not null").select("chunk_id", F.posexplode(chunking.pack_paragraphs(F.col("text"))).alias("piece", "piece_text"))


def q_merge_small(spark, sf_dir):
    base = _chunks(spark, sf_dir).where("text is not null").withColumn("token_estimate", text.token_estimate(F.col("text")))
    return chunking.merge_small(base, "filing_id").select("filing_id", "chunk_id", "heading_path", "text", "token_estimate", "order_index")


def _pages(spark, sf_dir):
    """Pages made of the test tables: headings, chunk texts in paragraphs, and the tables' own HTML, in order."""
    block = F.concat(F.lit("<p><b>"), F.coalesce("part", F.lit("")), F.lit("</b></p><p><b>"), F.coalesce("item", F.lit("")), F.lit("</b></p><p>"), F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("</p>"))
    parts = _chunks(spark, sf_dir).select("filing_id", "order_index", F.lit(0).alias("kind"), F.col("chunk_id").alias("key"), block.alias("html"))
    grids = _tables(spark, sf_dir).where("raw_html is not null").select("filing_id", "order_index", F.lit(1).alias("kind"), F.col("table_id").alias("key"), F.col("raw_html").alias("html"))
    pages = parts.unionByName(grids).groupBy(F.col("filing_id").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("order_index", "kind", "key", "html"))).alias("all"))
    return pages.select("doc_id", F.array_join(F.transform("all", lambda x: x["html"]), "\n").alias("html"))


def q_page_blocks(spark, sf_dir):
    blocks = scan_pages(_pages(spark, sf_dir)).where("kind = 'block'")
    return blocks.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), F.count_if("bold_ul").alias("n_bold"))


def q_page_chunks(spark, sf_dir):
    return chunking.chunk_pages(scan_pages(_pages(spark, sf_dir))).select("doc_id", "chunk_id", "heading_path", "token_estimate", "order_index")


def q_page_tables(spark, sf_dir):
    return tables.extract_tables(scan_pages(_pages(spark, sf_dir))).select("doc_id", "table_id", "heading_path", "n_rows", "n_cols")


def q_table_grid(spark, sf_dir):
    """Cells read from the tables' HTML, by row."""
    grids = _tables(spark, sf_dir).where("raw_html is not null").select(F.xxhash64("table_id").alias("doc_id"), "table_id", F.col("raw_html").alias("html"))
    found = scan_pages(grids).where("kind = 'table'").select("doc_id", F.posexplode("rows").alias("row", "cells"))
    return found.join(grids.select("doc_id", "table_id"), "doc_id").select("table_id", "row", F.array_join("cells", " | ").alias("cells"))


def q_pipe_text(spark, sf_dir):
    return _tables(spark, sf_dir).select("table_id", tables.pipe_text(F.col("col_names"), F.col("cell_rows")).alias("passage"))


def q_drop_empty(spark, sf_dir):
    names, rows = tables.drop_empty(F.col("col_names"), F.col("cell_rows"))
    return _tables(spark, sf_dir).select("table_id", F.size(names).alias("n_cols"), F.size(rows).alias("n_rows"))


def q_passages(spark, sf_dir):
    """Chunks and tables as passages of one kind, with their place in the filing."""
    chunks = _chunks(spark, sf_dir).select("filing_id", "chunk_id", text.token_estimate(F.coalesce("text", F.lit(""))).alias("token_estimate"), "order_index")
    made = tables.table_passages(_tables(spark, sf_dir), "filing_id", "col_names", "cell_rows").select("filing_id", "chunk_id", "token_estimate", "order_index")
    return chunks.unionByName(made)


def q_pairs(spark, sf_dir):
    return sampling.pair_chunks(_chunks(spark, sf_dir), "comparison", "filing_id")


def q_stride_sample(spark, sf_dir):
    """A sample of the groups of each type, paired where the type takes two passages."""
    chunks = _chunks(spark, sf_dir)
    sampled = [sampling.stride_sample(sampling.pair_chunks(chunks, t, "filing_id"), 7, "filing_id").withColumn("question_type", F.lit(t)) for t in DEFAULT.question_types]
    return reduce(DataFrame.unionByName, sampled).select("filing_id", "question_type", "chunk_id", "position")


def q_pair_text(spark, sf_dir):
    """Texts of the groups of comparisons, one or two passages each, cut to the budget."""
    chunks = _chunks(spark, sf_dir)
    first = chunks.select("chunk_id", F.col("text").alias("a"))
    second = chunks.select(F.col("chunk_id").alias("second_id"), F.col("text").alias("b"))
    joined = sampling.pair_chunks(chunks, "comparison", "filing_id").join(first, "chunk_id").join(second, "second_id", "left")
    return joined.where("a is not null and (second_id is null or b is not null)").select("filing_id", "chunk_id", text.truncate_to_budget(text.pair_text(F.col("a"), F.col("b")), 3000).alias("passage"))


def q_truncate(spark, sf_dir):
    return _chunks(spark, sf_dir).where("text is not null").select("chunk_id", text.truncate_to_budget(F.col("text"), 3000).alias("passage"))


def q_generated(spark, sf_dir):
    """Offline candidates of all chunks, checked for their quotations."""
    made = tables.table_passages(_tables(spark, sf_dir), "filing_id", "col_names", "cell_rows").withColumn("chunk_id", F.concat(F.lit("table_"), "chunk_id"))
    passages = _chunks(spark, sf_dir).where("text is not null")
    groups = generation.chunk_groups(passages.unionByName(made.select(*passages.columns)), "filing_id")
    from ..sources.providers import OfflineGenerator

    return generation.checked_candidates(generation.generate(groups, OfflineGenerator(), "filing_id"), "filing_id").select("id", "question_type", "answer", "verbatim_match_score")


def _replies(spark, sf_dir):
    """Model replies in every shape the recovery knows, made of the pairs."""
    body = F.to_json(F.struct("question", "answer", "source_passage"), {"ignoreNullFields": "false"})
    return _qa(spark, sf_dir).select("id", "answer", F.when(F.pmod(F.length("id") + F.length(F.coalesce("question", F.lit(""))), F.lit(4)) == 0, F.concat(F.lit("```json\n["), body, F.lit("]\n```"))).when(F.pmod(F.length(F.coalesce("question", F.lit(""))), F.lit(3)) == 0, F.concat(F.lit("Here you are: ["), body, F.lit("] as asked."))).otherwise(body).alias("raw"))


def q_json_recovery(spark, sf_dir):
    """Answers read back from the replies."""
    clean = text.json_text(F.col("raw"))
    listed = F.when(F.startswith(F.ltrim(clean), F.lit("[")), clean).otherwise(F.concat(F.lit("["), clean, F.lit("]")))
    parsed = F.from_json(listed, "array<struct<question:string,answer:string,source_passage:string>>")
    return _replies(spark, sf_dir).select("id", F.explode(parsed).alias("c")).select("id", F.col("c.answer").alias("answer"))


def q_required_fields(spark, sf_dir):
    """Candidates read from the replies: those with all their texts, without blanks around them."""
    found = generation.read_replies(_replies(spark, sf_dir).select("id", F.col("raw").alias("reply")))
    return found.select("id", "number", "question", "answer", "source_passage")


def q_number_overlap(spark, sf_dir):
    """Share of the passage's figures that the cited table or chunk has."""
    source = _chunks(spark, sf_dir).select(F.col("chunk_id").alias("src"), "text").unionByName(_tables(spark, sf_dir).select(F.col("table_id").alias("src"), tables.pipe_text(F.col("col_names"), F.col("cell_rows")).alias("text")))
    qa = _qa(spark, sf_dir).select("id", "source_passage", F.try_element_at("source_chunk_ids", F.lit(1)).alias("src"))
    scored = qa.join(source, "src").select("id", fuzzy.number_overlap(F.col("source_passage"), F.col("text")).alias("overlap"))
    return scored.where("overlap is not null").withColumn("overlap", F.round("overlap", 6))


def _with_source(spark, sf_dir):
    """Pairs with the text of the first chunk or table they cite."""
    qa = _qa(spark, sf_dir).select("id", "source_passage", F.try_element_at("source_chunk_ids", F.lit(1)).alias("src"))
    chunks = _chunks(spark, sf_dir).select(F.col("chunk_id").alias("src"), F.col("text").alias("passage_text"), F.lit(False).alias("is_table"))
    made = _tables(spark, sf_dir).select(F.col("table_id").alias("src"), tables.pipe_text(F.col("col_names"), F.col("cell_rows")).alias("passage_text"), F.lit(True).alias("is_table"))
    return qa.join(chunks.unionByName(made), "src")


def q_verbatim_exact(spark, sf_dir):
    """Passages that stand in their cited chunk or table letter by letter."""
    exact = F.when(F.length(text.strip(F.col("source_passage"))) > 0, F.contains("passage_text", "source_passage"))
    return _with_source(spark, sf_dir).where("source_passage is not null and passage_text is not null").select("id", F.coalesce(exact, F.lit(False)).alias("is_exact"))


def q_verbatim_score(spark, sf_dir):
    return fuzzy.with_table_aware_score(_with_source(spark, sf_dir)).select("id", F.round("verbatim_match_score", 6).alias("score"))


def q_faithfulness(spark, sf_dir):
    """Keep decisions made again from the stored verdicts: the latest of each pair."""
    results = _read(spark, sf_dir, "verification_results").groupBy("qa_id").agg(F.max_by(F.struct("faithfulness_pass", "numeric_check_pass", "context_recall_score"), F.struct("verified_at", "context_recall_score")).alias("v"))
    return results.select("qa_id", verification.keep(F.coalesce("v.numeric_check_pass", "v.faithfulness_pass"), F.col("v.context_recall_score")).alias("keep"))


def q_cosine(spark, sf_dir):
    """Cosine of each vector to the first of its label."""
    vectors = _read(spark, sf_dir, "embeddings")
    first = vectors.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("first"))
    return vectors.join(first, "label").select("vec_id", F.round(verification.cosine(F.col("embedding"), F.col("first")), 6).alias("cosine"))


def q_verify(spark, sf_dir):
    """Offline verification of all pairs."""
    from ..sources.providers import HashingEmbedder, OfflineVerifier

    qa = _qa(spark, sf_dir).select("id", "question", F.coalesce("answer", F.lit("")).alias("answer"), F.coalesce("source_passage", F.lit("")).alias("source_passage"), "question_type")
    return verification.verify(qa, OfflineVerifier(), HashingEmbedder()).select("id", "faithfulness_pass", "numeric_check_pass", F.round("context_recall_score", 6).alias("recall"), "keep")


def q_verify_numeric(spark, sf_dir):
    """Verdicts on numeric questions, which no model sees."""
    from ..sources.providers import HashingEmbedder, OfflineVerifier

    qa = _qa(spark, sf_dir, "question_type = 'numeric_calculation'").select("id", "question", "answer", "source_passage", "question_type")
    return verification.verify(qa, OfflineVerifier(), HashingEmbedder()).select("id", "faithfulness_pass", "numeric_check_pass")


def q_skip_verification(spark, sf_dir):
    """All pairs kept, unverified."""
    return verification.skip_verification(_qa(spark, sf_dir).select("id")).select("id", "context_recall_score", "faithfulness_pass", "numeric_check_pass", "verifier_reason", "keep")


def _vectors(spark, sf_dir):
    return _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")


def q_similar_pairs(spark, sf_dir):
    return dedup.similar_pairs(_vectors(spark, sf_dir), 0.30, None, "vec_id", "vec_id", "embedding").select("a", "b")


def q_dedup_greedy(spark, sf_dir):
    nodes = _vectors(spark, sf_dir)
    pairs = dedup.similar_pairs(nodes, 0.30, None, "vec_id", "vec_id", "embedding")
    return dedup.keep_first(nodes.select("vec_id"), pairs, "vec_id").select("vec_id", "is_kept", "dup_of")


def q_drop_rate(spark, sf_dir):
    return dedup.drop_rate(q_dedup_greedy(spark, sf_dir))


def q_dedup_questions(spark, sf_dir):
    """Questions of each filing, with hashed word vectors."""
    from ..sources.providers import HashingEmbedder

    qa = _qa(spark, sf_dir, "question is not null").select(F.col("filing_id").alias("doc_id"), "id", "question", F.col("id").alias("generation_order"))
    return dedup.deduplicate(qa, HashingEmbedder()).select("id", "is_kept", "dup_of")


def q_difficulty(spark, sf_dir):
    return _qa(spark, sf_dir).select("id", labels.difficulty(F.col("question_type"), F.col("source_chunk_ids")).alias("difficulty"))


def q_difficulty_distribution(spark, sf_dir):
    return labels.difficulty_distribution(q_difficulty(spark, sf_dir))


def q_output_rows(spark, sf_dir):
    """Finished rows of the pairs kept, joined with their latest verdicts."""
    latest = _read(spark, sf_dir, "verification_results").groupBy("qa_id").agg(F.max_by(F.struct("faithfulness_pass", "numeric_check_pass", "context_recall_score", "verifier_confidence", "verifier_reason", "keep"), F.struct("verified_at", "context_recall_score")).alias("v"))
    joined = _qa(spark, sf_dir).join(latest, F.col("id") == F.col("qa_id")).select(*[c for c in generation.QA_COLUMNS], "v.*")
    return labels.output_rows(joined.where("keep"))


def q_jsonl_round_trip(spark, sf_dir):
    """The finished rows, written as JSON lines and read again."""
    rows = q_output_rows(spark, sf_dir)
    path = work_path(spark, "jsonl")
    files.write_json(rows, path)
    return files.read_json(spark, path, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema))


def q_stage_round_trip(spark, sf_dir):
    """Tables in their stage format, written and read strictly."""
    rows = _tables(spark, sf_dir).select(F.col("filing_id").alias("doc_id"), "table_id", "heading_path", "part", "item", "order_index", "n_rows", "n_cols", F.col("col_names").alias("columns"), F.col("cell_rows").alias("rows"), "raw_html")
    path = work_path(spark, "tables")
    files.write_json(rows, path)
    return files.read_json(spark, path, files.TABLE_SCHEMA).drop("columns", "rows")


QUERIES = {name: value for name, value in list(globals().items()) if name.startswith("q_")}
SQL = catalog_sql.SQL
