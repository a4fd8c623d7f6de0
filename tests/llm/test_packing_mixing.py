import random

from docloom.llm.mixing import largest_exact_total, mix, reached, water_fill
from docloom.llm.packing import BestFit, containers, pack, pack_sizes
from docloom.llm.tokens import with_tokens


def test_best_fit_takes_the_fullest_that_holds_the_item():
    rng = random.Random(1)
    for capacity, bins in [(10, 3), (100, 8), (1, 1)]:
        packer, free, made = BestFit(capacity, bins), {}, 0
        for _ in range(600):
            size = rng.randint(0, capacity)
            fitting = [f for f in free.values() if f >= size]
            number = packer.add(size)
            if fitting:
                assert free[number] == min(fitting)
            else:
                assert number == made
                made += 1
                if len(free) >= bins:
                    least = min(free.values())
                    closed = next(k for k in sorted(free, reverse=True) if free[k] == least and k not in [x for v in packer.bins.values() for x in v])
                    del free[closed]
                free[number] = capacity
            free[number] -= size
            if not free[number]:
                del free[number]
            assert sorted(free.values()) == sorted(f for f, v in packer.bins.items() for _ in v)


def test_items_are_divided_only_beyond_the_capacity():
    placed = pack_sizes([25, 10, 0, 7, 3], capacity=10, open_bins=4)
    assert [sum(s for _, s in p) for p in placed] == [25, 10, 0, 7, 3]
    assert [len(p) for p in placed] == [3, 1, 1, 1, 1]


def test_pack_loses_nothing_whatever_the_partitions(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([0, 1, 5, 400, 4096, 9000, None]), 1) for i in range(800)] + [(5, 3, 1)]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long, container int")
    one = pack(df, shard_tokens=300_000).orderBy("doc_id", "piece_index").collect()
    two = pack(df.repartition(7), shard_tokens=300_000).orderBy("doc_id", "piece_index").collect()
    assert one == two
    want = df.groupBy("doc_id").agg({"n_tokens": "max"}).collect()
    got = {}
    for r in one:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["size"]
    assert got == {r[0]: r[1] or 0 for r in want}
    full = containers(pack(df, shard_tokens=300_000))
    assert full.where("used > 4096").count() == 0 and full.agg({"unused_share": "avg"}).first()[0] < 0.05
    assert pack(df.limit(0)).count() == 0


def test_tokens(spark):
    df = spark.createDataFrame([(1, "Hello world", 5), (2, None, 5), (3, "", 5)], "id int, text string, n_tokens int")
    assert {r["id"]: r["n_tokens"] for r in with_tokens(df).collect()} == {1: 2, 2: 0, 3: 0}


def test_water_filling():
    wanted = {s.source: s.wanted for s in water_fill([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 4), ("gone", 0.1, 3)], {"a": 1000, "b": 50, "c": 100, "x": 9}, total=1000)}
    assert wanted["b"] == 100 and wanted["gone"] == 0  # b is clamped at its cap, the rest shared 5 to 2
    assert abs(wanted["a"] - 900 * 5 / 7) < 1e-6 and abs(wanted["c"] - 900 * 2 / 7) < 1e-6
    everything = water_fill([("a", 0.5, 1), ("b", 0.5, 1)], {"a": 10, "b": 10}, total=1e9)
    assert [s.wanted for s in everything] == [10, 10]
    assert all(s.wanted == 0 for s in water_fill([("a", 0.0, 1), ("b", 1.0, 0)], {"a": 5, "b": 5}))
    assert water_fill([], {}) == []


def test_largest_total_with_exact_shares():
    targets, available = [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 4), ("gone", 0.1, 3)], {"a": 1000, "b": 50, "c": 100}
    total = largest_exact_total(targets, available)
    assert abs(total - 100 / 0.3) < 1e-6  # b ends first: 100 tokens are 0.3 of the weights of those there are
    wanted = {s.source: s.wanted for s in water_fill(targets, available, total)}
    assert abs(wanted["a"] - total * 0.5) < 1e-6 and abs(wanted["c"] - total * 0.2) < 1e-6
    assert largest_exact_total([], {}) == 0


def test_edge_is_narrowed_by_further_histograms(spark):
    """One source with nearly all records: the cut is the same however many histograms it takes to get there."""
    rng = random.Random(6)
    rows = [(i, "a" if i % 50 else "b", rng.randint(1, 9)) for i in range(20_000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")
    targets = [("a", 0.9, 1), ("b", 0.1, 8)]
    plain, shares = mix(df, targets, total=50_000, edge_rows=10_000)
    fine, _ = mix(df, targets, total=50_000, edge_rows=1)
    assert sorted(plain.collect()) == sorted(fine.collect())
    for r in reached(fine, shares).collect():
        assert abs(r["tokens"] - {s.source: s.wanted for s in shares}[r["source"]]) <= 9


def test_mix_reaches_its_sizes_to_a_record(spark):
    rng = random.Random(4)
    rows = [(i, ["a", "b", "c", None, "unlisted"][i % 5], rng.randint(0, 50)) for i in range(3000)] + [(0, "a", 10)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")
    targets = [("a", 0.6, 1), ("b", 0.3, 3), ("c", 0.1, 2), ("missing", 0.2, 2)]
    chosen, shares = mix(df, targets)
    again, _ = mix(df.repartition(5), targets)
    assert sorted(chosen.collect()) == sorted(again.collect())
    got = {r["source"]: r for r in reached(chosen, shares).collect()}
    for share in shares:
        assert abs(got[share.source]["tokens"] - share.wanted) <= 50
        assert got[share.source]["most_copies"] <= share.max_repeats
    assert got["missing"]["tokens"] == 0 and chosen.where("source is null or source = 'unlisted'").count() == 0
    none, shares = mix(df.limit(0), targets)
    assert none.count() == 0 and reached(none, shares).count() == 4
