import random

from docloom.llm.near_duplicates import budgets_by_size, close_classes, components, error_grid, near_duplicate_groups, near_duplicate_pairs, word_classes

SCHEMA = "id string, question string, cid string, words int"


def brute(rows):
    sets = {i: frozenset("".join(c if c.isalnum() else " " for c in q.lower()).split()) for i, q, *_ in rows if i and q}
    ids = sorted(i for i, s in sets.items() if s)
    return {(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}


def sample(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(rng.choice([12, 30, 300]))]
    base = [rng.sample(vocabulary, rng.randint(1, min(24, len(vocabulary)))) for _ in range(25)]
    rows = []
    for n in range(160):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            if words and rng.random() < 0.5:
                words.pop(rng.randrange(len(words)))
            else:
                words.append(rng.choice(vocabulary))
        rng.shuffle(words)
        rows.append((f"q{n:03}", " ".join(words), "x", 1))
    return rows


def test_same_pairs_as_brute_force_however_often_blocks_are_refined(spark):
    for seed in range(4):
        rows = sample(seed)
        df = spark.createDataFrame(rows, SCHEMA)
        want = brute(rows)
        for leads_a_key in (0, 6, 64):  # 0: every key is refined until the sets end
            got = {tuple(r) for r in near_duplicate_pairs(df, "id", "question", leads_a_key=leads_a_key).collect()}
            assert got == want, (seed, leads_a_key, len(want - got), len(got - want))


def test_every_pair_comes_through_blocks_even_if_all_words_are_common(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(14)]
    rows = [(f"q{n:04}", " ".join(rng.sample(vocabulary, 10)), "x", 1) for n in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    members, classes = word_classes(df, "id", "question")
    report = []
    links = close_classes(classes, leads_a_key=12, report=report).count()
    assert len(report) > 2 and report[0]["refined"] > 0 and report[-1]["refined"] == 0
    sets = {frozenset(q.split()) for _, q, *_ in rows}
    assert links == sum(1 for a in sets for b in sets if sorted(a) < sorted(b) and 5 * len(a & b) >= 4 * len(a | b))
    assert {tuple(r) for r in near_duplicate_pairs(df, "id", "question", leads_a_key=12).collect()} == brute(rows)


def test_blocks_and_budgets():
    assert [error_grid(h) for h in (0, 5, 8, 9, 11, 12, 17, 33, 100)] == [0, 5, 8, 10, 12, 12, 20, 40, 112]
    for n, hs in budgets_by_size(list(range(1, 400))).items():
        assert len(hs) <= 4 and set(hs) == {error_grid((n + m) // 9) for m in range(-(-n * 4 // 5), min(399, n * 5 // 4) + 1)}


def test_odd_rows(spark):
    rows = [("a", None, "", 0), ("b", "", "", 0), ("c", "!?", "", 0), (None, "one two", "", 0), ("d", "Éa ONE-two", "", 0), ("d", "Éa ONE-two", "", 1), ("e", "two one éa", "", 0), ("f", "other " * 500, "", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in near_duplicate_pairs(df, "id", "question").collect()} == {("d", "e")}
    assert near_duplicate_pairs(df.limit(0), "id", "question").count() == 0
    assert near_duplicate_groups(df.limit(0), "id", "question").count() == 0


def test_groups_follow_links_and_pairs_do_not(spark):
    words = [f"w{i}" for i in range(20)]
    rows = [("a", " ".join(words), "", 0), ("b", " ".join(words[2:] + ["x", "y"]), "", 0), ("c", " ".join(words[4:] + ["x", "y", "z", "v"]), "", 0), ("d", "all else", "", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in near_duplicate_pairs(df, "id", "question").collect()} == {("a", "b"), ("b", "c")}
    group = {r["id"]: (r["group_id"], r["n_links"]) for r in near_duplicate_groups(df, "id", "question").collect()}
    assert len({group[i][0] for i in "abc"}) == 1 and group["d"][0] != group["a"][0] and group["b"][1] == 2 and group["d"][1] == 0


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    want = {n: find(n) for n in root if any(n in e and e[0] != e[1] for e in edges)}
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
