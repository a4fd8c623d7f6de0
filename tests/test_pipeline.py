import random
import shutil

import numpy as np
import pytest

from docloom.config import Config, require_env
from docloom.operators.dedup import deduplicate, keep_first, similar_pairs
from docloom.plans.pipeline import EmptyStage, run
from docloom.sources.files import CHUNK_SCHEMA, FetchError, cache_name, fetch_page, read_csv, read_json, read_pages, write_csv, write_json
from docloom.sources.providers import HashingEmbedder
from docloom.streaming.pages import block_stream, first_questions, page_stream, question_counts


def greedy(vectors, above):
    unit = [np.array(v) / (np.linalg.norm(v) or 1) for v in vectors]
    kept = []
    for i, v in enumerate(unit):
        if not any(float(unit[k] @ v) > above for k in kept):
            kept.append(i)
    return kept


def test_greedy_keeps_what_the_sequential_rule_keeps(spark):
    rng = random.Random(1)
    for blocks in (7, 1000):
        vectors = [[rng.gauss(0, 1) for _ in range(3)] for _ in range(60)] + [[0.0, 0.0, 0.0]] * 2
        df = spark.createDataFrame([(i, i, v) for i, v in enumerate(vectors)] + [(0, 0, vectors[0]), (None, 1, vectors[0]), (99, 99, None)], "id long, ord long, vector array<float>")
        pairs = similar_pairs(df, 0.8, block_rows=blocks)
        marked = keep_first(df.select("id").distinct(), pairs).where("id is not null and id < 90").collect()
        kept = greedy(vectors, 0.8)
        assert sorted(r["id"] for r in marked if r["is_kept"]) == kept
        unit = [np.array(v) / (np.linalg.norm(v) or 1) for v in vectors]
        for r in marked:
            if not r["is_kept"]:
                assert r["dup_of"] == next(k for k in kept if float(unit[k] @ unit[r["id"]]) > 0.8)


def test_chain_is_not_a_group(spark):
    close = lambda deg: [float(np.cos(np.radians(deg))), float(np.sin(np.radians(deg)))]
    df = spark.createDataFrame([(1, 1, close(0)), (2, 2, close(20)), (3, 3, close(40))], "id long, ord long, vector array<float>")
    marked = {r["id"]: r["is_kept"] for r in keep_first(df.select("id"), similar_pairs(df, 0.9)).collect()}
    assert marked == {1: True, 2: False, 3: True}
    exact = spark.createDataFrame([(1, 1, [1.0, 0.0]), (2, 2, [0.5, 0.5])], "id long, ord long, vector array<float>")
    assert similar_pairs(exact, float(np.sqrt(0.5)) + 1e-12).count() == 0
    assert similar_pairs(df.limit(0), 0.9).count() == 0


def test_long_chains_settle(spark):
    """Each node is like the one before only: every other one is kept, whether decided in rounds or in one task."""
    n = 10_000
    pairs = spark.range(1, n).selectExpr("id - 1 as a", "id as b", "id - 1 as a_ord", "id as b_ord", "0.9D as cosine")
    marked = keep_first(spark.range(n), pairs)
    assert marked.where("is_kept != (id % 2 = 0)").count() == 0 and marked.where("not is_kept and dup_of != id - 1").count() == 0
    short = pairs.where("b < 12")
    assert sorted(keep_first(spark.range(12), short, finish_edges=0).collect()) == sorted(keep_first(spark.range(12), short).collect())


def test_questions_are_compared_within_a_document(spark):
    rows = [(1, "a", 1, "What is the net revenue?"), (1, "b", 2, "What is the net revenue?"), (2, "c", 3, "What is the net revenue?"), (1, "d", 4, None)]
    got = {r["id"]: (r["is_kept"], r["dup_of"]) for r in deduplicate(spark.createDataFrame(rows, "doc_id long, id string, generation_order int, question string"), HashingEmbedder(64)).collect()}
    assert got == {"a": (True, None), "b": (False, "a"), "c": (True, None), "d": (True, None)}


PAGE = "<p>PART I</p><p>Item 1. Business</p>" + "".join(f"<p><b>Unit {c}</b></p><p>Unit {c} sold {i}0,000 pumps in 20{i:02}. Its costs were ${i}.5 million, after ${i}.1 million before. It is based in Dale and employs many people who build pumps and sell them.</p>" for i, c in enumerate("ABCDEFGH", 11)) + "<table><tr><th>Item</th><th>2020</th><th>2019</th></tr><tr><td>Cost</td><td>1,200</td><td>900</td></tr></table>"


def test_pipeline_end_to_end(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    for n in "ab":
        (pages / f"{n}.htm").write_text(PAGE.replace("Dale", n * 4), encoding="utf-8")
    source = read_pages(spark, str(pages))
    result = run(source, out_path=str(tmp_path / "out"), config=Config(min_rows=1, recall_from=0.05))
    rows = result.output.collect()
    assert rows and len({r["id"] for r in rows}) == len(rows)
    checked = result.verified.collect()
    assert {r["question_type"] for r in checked} == {"fact_extraction", "numeric_calculation", "comparison", "multi_step_reasoning"}
    assert all((r["numeric_check_pass"] is None) == (r["question_type"] != "numeric_calculation") for r in checked)
    assert all((r["faithfulness_pass"] is None) == (r["question_type"] == "numeric_calculation") for r in checked)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in result.output.schema)
    back = read_csv(spark, str(tmp_path / "out"), schema)
    assert back.count() == len(rows) and back.columns == result.output.columns
    assert any("True" in p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    assert result.figures["rows"] == len(rows) == sum(result.figures["by_difficulty"].values()) and 0 < result.figures["kept_share"] <= 1
    unverified = run(source, skip_verify=True, config=Config())
    assert unverified.verified.where("not keep or verifier_reason <> 'SKIPPED'").count() == 0
    with pytest.raises(EmptyStage):
        run(source.limit(0))
    with pytest.raises(EmptyStage):
        run(source, config=Config(recall_from=2.0))


def test_stage_files_are_reused(spark, tmp_path):
    pages = spark.createDataFrame([(1, PAGE)], "doc_id long, html string")
    first = run(pages, config=Config(min_rows=1, recall_from=0.05), stage_path=str(tmp_path / "stages"))
    again = run(pages.limit(0), config=Config(min_rows=1, recall_from=0.05), stage_path=str(tmp_path / "stages"))
    assert first.chunks.count() == again.chunks.count() > 0 and sorted(again.output.collect()) == sorted(first.output.collect())


def test_files(spark, tmp_path):
    rows = spark.createDataFrame([(1, "chunk_00000", "A", None, None, 'x "q"\ny, z', 3, 0)], CHUNK_SCHEMA)
    write_json(rows, str(tmp_path / "j"))
    assert read_json(spark, str(tmp_path / "j"), CHUNK_SCHEMA).collect() == rows.collect()
    assert '"part":null' in "".join(p.read_text() for p in (tmp_path / "j").glob("*.json"))
    write_csv(rows, str(tmp_path / "c"))
    assert read_csv(spark, str(tmp_path / "c"), CHUNK_SCHEMA).first()["text"] == 'x "q"\ny, z'


def test_fetch(tmp_path):
    calls, waits = [], []

    class Reply:
        def __enter__(self):
            return self

        def __exit__(self, *_):
            return None

        def read(self):
            return b"<p>x</p>"

    def opener(request, timeout):
        calls.append(request)
        if len(calls) == 1:
            raise OSError("reset")
        return Reply()

    path = fetch_page("http://h/x", tmp_path, "ABC", "1-2", "me", opener=opener, sleep=waits.append)
    assert path.name == cache_name("ABC", "1-2") == "abc_1-2.htm" and path.read_bytes() == b"<p>x</p>" and waits == [2.0]
    fetch_page("http://h/x", tmp_path, "ABC", "1-2", "me", opener=opener)
    assert len(calls) == 2
    fetch_page("http://h/x", tmp_path, "ABC", "1-2", "me", force=True, opener=opener)
    assert len(calls) == 3

    def down(request, timeout):
        raise OSError("down")

    with pytest.raises(FetchError):
        fetch_page("http://h/y", tmp_path, "D", "3", "example agent", opener=down, sleep=waits.append)
    with pytest.raises(OSError):
        require_env("DOCLOOM_NOT_SET")
    with pytest.raises(TypeError):
        Config.from_mapping({"misspelt": 1})
    (tmp_path / "config.json").write_text('{"min_rows": 5, "question_types": ["comparison"]}')
    assert Config.load(str(tmp_path / "config.json")) == Config(min_rows=5, question_types=("comparison",))


def test_streams(spark, tmp_path):
    spark.createDataFrame([(1, PAGE, None), (2, None, None)], "doc_id long, html string, seen_at timestamp").write.parquet(str(tmp_path / "in"))
    query = block_stream(page_stream(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("blocks").option("checkpointLocation", str(tmp_path / "c1")).start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("blocks").where("kind = 'table'").count() == 1 and spark.table("blocks").where("level = 1").count() == 1
    spark.sql("select * from values ('Q one?', 'fact', timestamp '2024-01-01 00:10:00'), ('q  ONE?', 'fact', timestamp '2024-01-01 00:20:00'), ('Q two?', 'fact', timestamp '2024-01-01 02:00:00') as t(question, question_type, asked_at)").write.parquet(str(tmp_path / "q"))
    stream = lambda: spark.readStream.schema("question string, question_type string, asked_at timestamp").parquet(str(tmp_path / "q"))
    query = first_questions(stream()).writeStream.format("memory").queryName("firsts").option("checkpointLocation", str(tmp_path / "c2")).start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("firsts").count() == 2
    query = question_counts(stream()).writeStream.outputMode("complete").format("memory").queryName("counts").option("checkpointLocation", str(tmp_path / "c3")).start()
    query.processAllAvailable()
    query.stop()
    assert {r["n_questions"] for r in spark.table("counts").collect()} == {2, 1}
    shutil.rmtree(tmp_path / "c1")
