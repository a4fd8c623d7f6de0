import random
import time

import numpy as np

from docloom.llm.subjects import Block, _Frames, _hash_of, add_expected, assign_subjects, encode, fit_and_assign, p9_found, sentences, train, training_docs, words

TOPICS = {"law": ["the appeal", "a tort claim", "the judge", "pleadings", "the verdict"], "sport": ["the relay team", "a goalkeeper", "match crowds", "the league", "a stadium"], "energy": ["the turbine", "gas storage", "the grid", "solar panels", "a substation"]}
FRAMES = ["The outlook for {} depends on {}.", "Our partner takes care of {} while we keep {}.", "Spending on {} rose because of {}."]
GENERAL = ["Amounts are rounded.", "The fiscal year ends in June.", "A dividend of 5 cents was declared.", "Copies of this report are free."]


def corpus(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        subjects = rng.sample(sorted(TOPICS), rng.choice([0, 1, 1, 2]))
        text = [rng.choice(GENERAL) for _ in range(rng.randint(1, 3))]
        for s in subjects:
            text += [rng.choice(FRAMES).format(*rng.sample(TOPICS[s], 2)) for _ in range(4)]
        rng.shuffle(text)
        out.append((" ".join(text), set(subjects)))
    return out


def test_held_out_accuracy_with_wrong_labels():
    rng = random.Random(5)
    labelled = [(t, {rng.choice(sorted(TOPICS)): 1} if rng.random() < 0.08 else dict.fromkeys(s or {"none"}, 1)) for t, s in corpus(150, 1)] + [(t, None) for t, _ in corpus(60, 2)]
    model = train(labelled, sorted(TOPICS))
    held = corpus(200, 3)
    got = model.assign([t for t, _ in held])
    right = sum(set(g) == s for g, (_, s) in zip(got, held))
    assert right >= 190
    assert model.assign([None, "", "   ", "<br>"]) == [[], [], [], []]


def test_no_training_data_still_gives_a_model():
    model = train([], ["law"], {"law": "Courts and judges"})
    assert model.assign(["Nothing known here."]) == [[]]
    assert train([], []).assign(["A text."]) == [[]]


def test_sentences():
    assert sentences("HEAD LINE\nOne ends. Two, i.e. that, ends too!\n<b>Three</b> &amp; four.") == ["One ends.", "Two, i.e. that, ends too!", "Three    four."]
    assert sentences("only a heading") == ["only a heading"] and words("A well-known it's 5") == ["a", "well-known", "it's"]


def test_operator(spark):
    docs = [(i, t, "x") for i, (t, _) in enumerate(corpus(60, 1))] + [(900, None, "x"), (901, "", "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, subject_code string")
    truth = {i: s for i, (_, s) in enumerate(corpus(60, 1))}
    labels = spark.createDataFrame([(i, c.upper(), "r", None) for i, s in truth.items() for c in (s or {"none"})] + [(3, None, "r", None), (12345, "law", "r", None)], "doc_id long, subject_code string, rater string, rated_at timestamp")
    chosen = training_docs(df, labels, limit=40, unlabelled=0)
    assert len(chosen) == 40 and chosen == training_docs(df.repartition(3), labels, limit=40, unlabelled=0)
    model = train(training_docs(df, labels), sorted(TOPICS))
    got = {}
    for r in assign_subjects(df.unionByName(df.limit(5)), model).distinct().collect():
        got.setdefault(r["doc_id"], set()).add(r["subject_code"])
    assert sum(got.get(i, set()) == s for i, s in truth.items()) >= 56 and not got.keys() & {900, 901}
    assert assign_subjects(df.limit(0), model).count() == 0


def test_long_labelled_documents_teach_their_subject(spark, tmp_path):
    texts = corpus(200, 1)
    # Only documents of over 20,000 characters are labelled with sport or law.
    docs = [(i, t + "\n" + "0 " * 10_001 if i < 150 and s & {"law", "sport"} else t) for i, (t, s) in enumerate(texts)]
    labels = [(i, c, "r") for i, (_, s) in enumerate(texts[:150]) for c in (s or {"none"})]
    for name, rows, schema in (("documents", docs, "doc_id long, text string"), ("subject_labels", labels, "doc_id long, subject_code string, rater string"), ("subject_areas", [(c, "", "") for c in TOPICS], "subject_code string, subject_title string, subject_note string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {(r["doc_id"], r["subject_code"]) for r in p9_found(spark, str(tmp_path)).collect()}
    assert sum({c for i, c in got if i == k} == s for k, (_, s) in enumerate(texts)) >= 190


def test_counts_of_the_tables_are_those_of_a_list_of_all_documents(spark):
    texts = corpus(80, 7) + corpus(40, 8)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)] + [(900, None), (901, "")], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, c, "r") for i, (_, s) in enumerate(texts[:20]) for c in (s or {"none"})], "doc_id long, subject_code string, rater string")
    votes = {i: dict.fromkeys(s or {"none"}, 1) for i, (_, s) in enumerate(texts[:20])}
    here = train([(t, votes.get(i)) for i, (t, _) in enumerate(texts)], sorted(TOPICS))
    model, found = fit_and_assign(docs, labels, sorted(TOPICS))  # too few labels for halves, so the models are the same
    assert (model.index.vocabulary == here.index.vocabulary).all() and (model.index.pair_keys == here.index.pair_keys).all()
    assert abs(model.ratios - here.ratios).max() < 1e-3 and (model.margins == here.margins).all()
    assert {(r["doc_id"], r["subject_code"]) for r in found.collect()} == {(i, c) for i, codes in enumerate(here.assign([t for t, _ in texts])) for c in codes}
    frames = _Frames(docs, labels, sorted(TOPICS))
    keys, counts = frames.word_counts(0)
    assert counts.sum() == sum(len(words(s)) for t, _ in texts for s in sentences(t)) and len(keys) == len({w for t, _ in texts for s in sentences(t) for w in words(s)})
    empty, none = fit_and_assign(docs.limit(0), labels, sorted(TOPICS), {"law": "Courts and judges"})
    assert none.count() == 0 and len(empty.margins) == 3


def test_words_of_many_texts_at_once_are_those_of_each_sentence():
    rng = random.Random(2)
    odd = "aAbB zZ..!?\n\n \t’'--éÉßİıΣσ\u0307中文ｱ²Ⅷ𝔸𐐀🙂_09&<>;«»\u00ad\u2028\r"
    for texts in [[], [None], ["", "  ", "..."], ["A--b 'c' d-’e ΑΣ. ΑΣ-x"], *([rng.choice([None, "".join(rng.choices(odd, k=50))]) for _ in range(5)] for _ in range(300))]:
        hashes, lengths, per_text = encode(texts)
        each = [[w for s in sentences(t) if (w := words(s))] for t in texts]
        assert hashes.tolist() == [_hash_of(w.encode()) for x in each for s in x for w in s]
        assert lengths.tolist() == [len(s) for x in each for s in x] and per_text.tolist() == [len(x) for x in each]


def test_expected_counts_of_a_word_add_up_to_its_times():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 30, 4000)
    rows = rng.integers(0, 500, lengths.sum())
    block = Block(rows, lengths, np.full(1000, 4), [[i % 12] if i % 3 else None for i in range(1000)], np.arange(1000) % 2)
    out = np.zeros((500, 39))
    add_expected(block, rng.normal(0, 0.1, (500, 3, 13)).astype(np.float32), out)
    owner, labelled = np.repeat(np.repeat(np.arange(1000), 4), lengths), np.arange(1000) % 3 > 0
    # Each word is expected once in all for every model that learns from its document.
    for m, learns in enumerate([np.ones(1000), ~labelled | (np.arange(1000) % 2 == 0), ~labelled | (np.arange(1000) % 2 == 1)]):
        assert np.allclose(out[:, m * 13 : m * 13 + 13].sum(axis=1), np.bincount(rows, learns[owner], 500), atol=1e-2)


def test_words_of_many_texts_take_less_than_those_of_each_sentence():
    texts = [t for t, _ in corpus(4000, 4)]

    def took(f):
        each = []
        for _ in range(3):
            began = time.process_time()
            f()
            each.append(time.process_time() - began)
        return min(each)

    assert took(lambda: encode(texts)) < 0.75 * took(lambda: [_hash_of(w.encode()) for t in texts for s in sentences(t) for w in words(s)])


def test_words_are_stored_as_bytes(spark):
    docs = spark.createDataFrame([(1, "The judge ruled. Gas rose."), (2, "Costs."), (3, "12."), (4, "")], "doc_id long, text string")
    frames = _Frames(docs, spark.createDataFrame([], "doc_id long, subject_code string, rater string"), ["law"])
    got = {r["doc_id"]: (np.frombuffer(r["words"], np.int64).tolist(), np.frombuffer(r["lengths"], np.int32).tolist()) for r in frames.hashed.collect()}
    assert got == {1: ([_hash_of(w.encode()) for w in ("the", "judge", "ruled", "gas", "rose")], [3, 2]), 2: ([_hash_of(b"costs")], [1]), 3: ([], []), 4: ([], [])}
