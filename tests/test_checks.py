import random

import pytest
from pyspark.sql import functions as F

from docloom.config import DEFAULT
from docloom.functions.numeric import claimed_value, numbers, numeric_check, within_tolerance
from docloom.functions.text import number_set, pair_text, strip_fences, truncate_to_budget
from docloom.operators.fuzzy import partial_ratio, with_table_aware_score, with_verbatim_score
from docloom.functions.text import json_text
from docloom.operators.generation import as_text, objects
from docloom.operators.labels import difficulty, difficulty_distribution
from docloom.operators.sampling import pair_chunks, stride_sample
from docloom.operators.verification import cosine, read_verdict
from docloom.sources.providers import complete_with_retry, split_prompt


def one(spark, column, **values):
    names = list(values)
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in names)).select(column).first()[0]


@pytest.mark.parametrize(
    ("text", "values"),
    [
        ("from $45,000 to (1,234.5)", [45000, -1234.5]), ("(1,234)% and -7", [1234, -7]), ("-$5", []), ("5 5 5", [5, 5, 5]), ("35% vs 30.", [35, 30]), ("none", []), ("", []), (None, []), ("$1,2,3", [123]), ("é4٣", [4]),
    ],
)
def test_numbers(spark, text, values):
    assert one(spark, numbers(F.col("t")), t=text) == values


@pytest.mark.parametrize(("answer", "value"), [("10 - 4 = 6 or 7", 6), ("= nothing 5", 5), ("5 = ", 5), ("$50,000 million", 50000), ("a = b = 3%", 3), ("none", None), (None, None)])
def test_claimed_value(spark, answer, value):
    assert one(spark, claimed_value(F.col("a")), a=answer) == value


@pytest.mark.parametrize(
    ("passage", "answer", "passed", "relationship"),
    [
        ("rose from $45,000 to $50,000", "5000", True, "abs_difference"), ("50,000 after 45,000", "5,000", True, "difference"), ("50,000 after 45,000", "11.1%", True, "percent_change"), ("20 and 30", "600", True, "product"),
        ("120 and 80", "200", True, "sum"), ("120 and 80", "1.5", True, "ratio"), ("only 7", "7.05", True, "direct_match"), ("only 7", "8", False, None), ("none", "8", False, None), ("1 and 2", "none", False, None),
        ("0 and 5", "0", True, "ratio"), ("4 and 9", "77", False, None), (None, "5", False, None), ("5 and 6", None, False, None),
    ],
)
def test_numeric_check(spark, passage, answer, passed, relationship):
    got = one(spark, numeric_check(F.col("p"), F.col("a")), p=passage, a=answer)
    assert (got["pass"], got["relationship"]) == (passed, relationship)


def test_tolerance(spark):
    rows = [(1.0099, 1.0, True), (1.011, 1.0, False), (0.0, 0.0, True), (1e-5, 0.0, False), (-99.0, -100.0, True)]
    for a, b, want in rows:
        assert spark.range(1).select(within_tolerance(F.lit(a), F.lit(b), 1.0)).first()[0] == want


def test_text_functions(spark):
    cut = lambda t, n: one(spark, truncate_to_budget(F.col("t"), n), t=t)
    mark = "\n[... truncated for length ...]"
    assert cut("short", 10) == "short" and cut("x" * 11, 10) == "x" * 10 + mark and cut("abcdef\nghijkl", 10) == "abcdef" + mark and cut("a\nbcdefghijk", 10) == "a\nbcdefghi" + mark and cut("a😀" * 5, 10) == "a😀" * 5
    assert one(spark, strip_fences(F.col("t")), t="```json\n[1]\n```") == "[1]"
    assert one(spark, number_set(F.col("t")), t="1,000 and 1000 and 5.") == ["1000", "5."]
    assert one(spark, pair_text(F.col("a"), F.col("b")), a="x", b=None) == "x" and one(spark, pair_text(F.col("a"), F.col("b")), a="x", b="y") == "x\n--- NEXT PASSAGE ---\ny"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for c in a:
        new = [0]
        for j, d in enumerate(b):
            new.append(row[j] + 1 if c == d else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def brute_ratio(a, b):
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 1.0 if not b else 0.0

    def best(a, b):
        n, m, signs = len(a), len(b), set(a)
        spans = [b[:k] for k in range(1, n) if b[k - 1] in signs] + [b[s : s + n] for s in range(m - n + 1) if b[s + n - 1] in signs] + [b[s:] for s in range(m - n + 1, m) if b[s] in signs]
        return max((2 * lcs(a, w) / (n + len(w)) for w in spans), default=0.0)

    return 1.0 if a in b else max(best(a, b), best(b, a) if len(a) == len(b) else 0.0)


def test_partial_ratio_against_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        signs = rng.choice(["ab", "abcd", "abcdefgh "])
        a, b = ("".join(rng.choice(s) for _ in range(rng.randint(0, n))) for s, n in ((signs, 14), (signs + "z", 30)))
        assert abs(partial_ratio(a, b) - brute_ratio(a, b)) < 1e-9, (a, b)


def test_scores(spark):
    text = "Revenue was 50,000 in the year and costs fell."
    rows = [(1, "Revenue was 50,000", text, False), (2, "", text, False), (3, "Nothing alike %%%", text, False), (4, "Segment revenue 50000 and 7", "R | 50,000 | 45", True), (5, "R |  50,000", "R | 50,000", False), (6, None, text, False), (7, "no figures", "no figures", True), (8, "x", None, False)]
    df = spark.createDataFrame(rows, "id int, source_passage string, passage_text string, is_table boolean")
    got = {r["id"]: r["verbatim_match_score"] for r in with_table_aware_score(df).collect()}
    assert got[1] == 1 and got[2] == 0 and got[3] < 0.5 and got[4] == 0.5 and 0.9 <= got[5] < 1 and got[6] == 0 and got[7] == 1 and got[8] == 0
    assert with_verbatim_score(df.limit(0)).count() == 0


def test_json_recovery(spark):
    raws = ['[{"a": 1}]', '```json\n{"a": 1}\n```', 'Sure: [{"a": 1}] ok', "none", "5", "[1", None, '[1, {"a": 1}, null]']
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw string")
    found = [objects(r["j"]) for r in df.select("i", json_text(F.col("raw")).alias("j")).orderBy("i").collect()]
    assert found == [[{"a": 1}]] * 3 + [[]] * 4 + [[{"a": 1}]]
    assert as_text(None) == "" and as_text([" a", ["b", 3]]) == "a b 3" and as_text(0.32) == "0.32" and as_text(True) == "True"
    assert spark.createDataFrame([('x {"a": 1} y',)], "raw string").select(json_text(F.col("raw"), "{}").alias("j")).first()["j"] == '{"a": 1}'
    assert split_prompt("SYSTEM:\nBe.\n\nUSER:\nAsk {n}") == ("Be.", "Ask {n}")
    with pytest.raises(ValueError):
        split_prompt("no marker")


def test_verdicts():
    assert read_verdict(True, '{"matches_claimed_answer": "True", "confidence": "high", "reason": "r"}') == (True, "high", "r")
    assert read_verdict(True, '{"matches_claimed_answer": null}') == (None, None, "") and read_verdict(True, "[1]")[0] is None and read_verdict(False, None)[2].endswith("reached") and read_verdict(True, '{"matches_claimed_answer": 0}')[0] is False
    waits, calls = [], []

    class Down:
        def complete(self, system, user):
            calls.append(1)
            raise OSError("down")

    assert complete_with_retry(Down(), "", "", 3, 2.0, waits.append) is None and waits == [2.0, 4.0, 6.0] and len(calls) == 3


def test_cosine_and_labels(spark):
    v = spark.createDataFrame([([1.0, 0.0], [3.0, 4.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    assert [round(r[0], 6) for r in v.select(cosine(F.col("a"), F.col("b"))).collect()] == [0.6, 0.0]
    rows = [("fact_extraction", ["a"]), ("fact_extraction", ["a", "b"]), ("numeric_calculation", ["a"]), ("comparison", []), ("odd", None), (None, ["a"])]
    df = spark.createDataFrame(rows, "t string, c array<string>").withColumn("difficulty", difficulty(F.col("t"), F.col("c")))
    assert [r["difficulty"] for r in df.collect()] == ["easy", "hard", "medium", "hard", "medium", "medium"]
    assert {tuple(r) for r in difficulty_distribution(df.where("difficulty = 'easy'")).collect()} == {("easy", 1), ("medium", 0), ("hard", 0)}
    assert difficulty_distribution(df.limit(0)).count() == 3


def test_stride(spark):
    for n in (0, 5, 7, 8, 40, 484, 500):
        df = spark.createDataFrame([(1, i) for i in range(n)], "doc_id int, position int")
        for cap in (7, 40):
            want = list(range(n)) if n <= cap else [int(i * (n / cap)) for i in range(cap)]
            assert sorted(r["position"] for r in stride_sample(df, cap).collect()) == want


def test_pairs(spark):
    rows = [(1, f"c{i}", None if i < 60 else "P", None if i < 60 else f"I{i // 30}", i) for i in range(120)] + [(2, "solo", "P", None, 0)]
    df = spark.createDataFrame(rows, "doc_id int, chunk_id string, part string, item string, order_index int")
    got = pair_chunks(df, "comparison").collect()
    assert len(got) == 121 and sorted(got, key=lambda r: (r["doc_id"], r["position"])) == pair_chunks(df.repartition(3), "comparison").orderBy("doc_id", "position").collect()
    section = {r[1]: r[2:4] for r in rows}
    second = [r["second_id"] for r in got if r["second_id"]]
    assert len(second) == len(set(second)) and 20 < len(second) < 60
    assert all(r["second_id"] != r["chunk_id"] and section[r["second_id"]] == section[r["chunk_id"]] for r in got if r["second_id"])
    assert all(r["second_id"] is None for r in pair_chunks(df, "fact_extraction").collect())
    assert DEFAULT.pair_probability == 0.4
