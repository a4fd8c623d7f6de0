import random

from docloom.llm.shared_spans import shared_runs, shared_spans

SCHEMA = "record_kind string, record_id string, filing_id long, text string, digest string"


def brute(rows, run):
    owners = {}
    for _, _, f, text, _ in rows:
        words = (text or "").split()
        for a in range(len(words) - run + 1):
            owners.setdefault(tuple(words[a : a + run]), set()).add(f)
    out = set()
    for kind, i, _, text, _ in rows:
        words = (text or "").split()
        out |= {(kind, i, a, len(words)) for a in range(len(words) - run + 1) if len(owners[tuple(words[a : a + run])]) > 1}
    return out


def sample(seed, size=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(rng.choice([2, 5, 40, 1000]))]
    texts = [[rng.choice(vocabulary) for _ in range(rng.randint(0, 160))] for _ in range(size)]
    for _ in range(40):  # copy stretches around
        a, b = rng.choice(texts), rng.choice(texts)
        n = rng.randint(20, 60)
        at = rng.randint(0, max(0, len(a) - n))
        to = rng.randint(0, len(b))
        b[to:to] = a[at : at + n]
    return [("chunk" if i % 2 else "passage", f"id{i}", i % 7, " ".join(t), "x") for i, t in enumerate(texts)]


def test_same_runs_as_brute_force(spark):
    for seed in range(5):
        rows = sample(seed)
        got = {tuple(r) for r in shared_runs(spark.createDataFrame(rows, SCHEMA)).collect()}
        assert got == brute(rows, 30), seed


def test_spans_and_shares(spark):
    common = " ".join(f"c{i}" for i in range(40))
    rows = [("chunk", "a", 1, common, ""), ("passage", "b", 2, "x y " + common + " z", ""), ("passage", "b", 2, "x y " + common + " z", ""), ("chunk", "c", 1, common, "")]
    got = {r["record_id"]: r for r in shared_spans(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got["a"]["shared_share"] == 1.0 and got["b"]["spans"] == "2-42" and got["b"]["shared_words"] == 40 and set(got) == {"a", "b", "c"}


def test_odd_rows(spark):
    text = " ".join(f"c{i}" for i in range(35))
    rows = [("chunk", "n", 1, None, ""), ("chunk", "e", 1, "", ""), ("chunk", "s", 2, "short", ""), ("chunk", "o", None, text, ""), ("chunk", "p", None, text, ""), ("chunk", "own", 5, text + " " + text, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r["record_id"] for r in shared_runs(df).select("record_id").collect()} == {"o", "p", "own"}
    assert shared_runs(df.limit(0)).count() == 0 and shared_spans(df.limit(0)).count() == 0
    assert shared_runs(df.where("filing_id is null")).count() == 0  # one owner
    assert shared_runs(df.where("filing_id = 5")).count() == 0  # repeats within a record


def test_a_text_in_most_records(spark):
    text = " ".join(f"c{i}" for i in range(50))
    rows = [("chunk", f"r{i}", i % 3, text, "") for i in range(300)]
    assert shared_runs(spark.createDataFrame(rows, SCHEMA)).select("record_id").distinct().count() == 300


def test_slices_keep_all_rows_in_order():
    import pyarrow as pa

    from docloom.llm.common import slices

    texts = ["a" * n for n in (3, 0, 50, 4, 4, 4, 0, 9)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(texts)], ["k", "t"])
    parts = list(slices(batch, 1, most=10))
    assert [k for p in parts for k in p.column(0).to_pylist()] == list(range(9))
    assert len(parts) > 3 and all(sum(sorted(len(t or "") for t in p.column(1).to_pylist())[:-1]) <= 10 for p in parts)
    assert list(slices(batch.slice(0, 0), 1)) == []
