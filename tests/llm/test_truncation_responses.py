import random
import time

import numpy as np
import pytest

from docloom.llm import responses, truncation
from docloom.llm.responses import TAGS, pair_defects, train, training_sequences
from docloom.llm.truncation import _first_sum, _keys, answer_form, answer_verdicts, content, damaged, lost_ends, open_words, passage_form, passage_verdicts, units

QA = "id string, question string, answer string, source_passage string, feed string, text string"


def test_debris_and_marks():
    for text in ["and led to�", "charges of &nbs", "Amor%2", "the cost inc\\u00", "tell us <td", "before the…", "which were ...", "as of [continued]", "costs (cont'd)"]:
        assert damaged(text), text
    for text in ["fell by 62.3%", "It ended. See Q&A session.", "Higher", "$(2,984,281)", "5 < 6 now.", "costs of 5%"]:
        assert not damaged(text), text


def test_content_and_units():
    assert content("  ") == content("n/a") == content("--") == content("​") == content(None) == content("Answer:") == ""
    assert content("None") == "None" and content("0") == "0"
    assert units("One ends. Two goes on; Three, i.e. 4 more.\nlast") == ["One ends.", "Two goes on;", "Three, i.e. 4 more.", "last"]


def test_forms():
    assert passage_form("It rose by $301.") == passage_form("covered by permit No.") == passage_form("rose by $5.1 million for fiscal") == 1
    assert passage_form("It rose to $12,337,114.") == passage_form("A did so;") == passage_form("Tax | 1,200 | 5\nNet | 3,100 | ") == 0
    assert passage_form("Tax | 1,200 | 5\nNet | 3,100") == passage_form("Tax | 1,20") == 1
    assert answer_form("Lower") == answer_form("No") == answer_form("$5.1 million") == 0 and answer_form("It was lower than the", frozenset(["the"])) == 1


def test_lost_ends(spark):
    source = "The unit in Dale rose by $301.9 million as buyers waited. Customers of Unit B may return goods."
    answers = [f"The {n} program recorded costs of ${i}.5 million at {m} in fiscal 2019." for i, (n, m) in enumerate(zip("Abel Bron Cade Dorn Etna".split() * 8, "Wex Yarn Zell Vale Ulm".split() * 8))]
    rows = [(f"ok{i}", "q", a, "Customers of Unit B may return goods.", "f", "") for i, a in enumerate(answers)]
    rows += [("cut", "q", "The Abel program recorded costs of $7.5", "The unit in Dale rose by $301.", "f", ""), ("stopless", "q", answers[3][:-1], "Customers of Unit B may return goods", "f", ""), ("none", None, None, None, None, None), ("blank", "", " ", "\n", "f", ""), ("short", "q", "Higher", "Tax | 1,200", "f", "")]
    rows.append(rows[-5])
    chunks = spark.createDataFrame([(source,), (None,), ("",)], "text string")
    tables = spark.createDataFrame([([["Tax", "1,200"], ["Net", None]],), (None,), ([],)], "cell_rows array<array<string>>")
    df = spark.createDataFrame(rows, QA)
    got = {tuple(r) for r in lost_ends(df, chunks, tables).collect()}
    # A copy that goes on with a stop alone decides nothing; a sentence without its stop is then open by its form.
    assert got == {("cut", "answer"), ("cut", "source_passage"), ("stopless", "source_passage")}
    assert lost_ends(df.limit(0), chunks.limit(0), tables.limit(0)).count() == 0


def test_copies_at_range_bounds(spark):
    """Every cut row is found by its longer copy, wherever the sorted ranges end, and so is one that many ids share."""
    grids = [([[f"Item {k} of the year", f"1,{k}"], [f"Net sum of item {k}", "3,100"]],) for k in range(100, 250)]
    passages = [(f"cut{k}", f"Item {k} of the year | 1,{k}\nNet sum of item {k} | 3") for k in range(100, 250)]
    passages += [(f"hot{i}", passages[70][1]) for i in range(400)] + [(f"whole{k}", f"Item {k} of the year | 1,{k}\nNet sum of item {k} | 3,100") for k in range(100, 250, 7)]
    rows = spark.createDataFrame(passages, "id string, text string")
    tables, chunks = spark.createDataFrame(grids, "cell_rows array<array<string>>"), spark.createDataFrame([], "text string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["id"] for r in passage_verdicts(rows, chunks, tables).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {k for k, _ in passages if not k.startswith("whole")}


def test_verdicts_do_not_depend_on_partitions(spark):
    """Cut layouts without stops, of which only the longer copies tell, over any number of sorted ranges."""
    words = "gears pumps valves rotors belts seals motors".split()
    sources = [f"the unit in hall {i} sold {words[i % 7]} to {words[i * 3 % 7]} buyers in the north of dale" for i in range(600)]
    passages = [(f"p{i}", s.rsplit(None, 2)[0]) for i, s in enumerate(sources)] + [(f"w{i}", s) for i, s in enumerate(sources[::5])]
    # The first of the longer copies decide nothing, and a short entry is compared like any other.
    sources += ["The unit sold pumps )" + ")" * i for i in range(40)] + ["The unit sold pumps, and valves", "Net gain", "Net (1,234)", "Rate 5%"]
    passages += [("odd", "The unit sold pumps"), ("short", "Net ga"), ("bracket", "Net (1,234"), ("percent", "Rate 5")]
    rows, chunks = spark.createDataFrame(passages, "id string, text string"), spark.createDataFrame([(x,) for x in sources], "text string")
    tables = spark.createDataFrame([], "cell_rows array<array<string>>")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for parts in ("1", "17", "60"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got = {r["id"] for r in passage_verdicts(rows, chunks, tables).collect()}
            assert got == {k for k, _ in passages if not k.startswith("w")}, parts
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_long_units_take_time_in_proportion():
    def seconds(n):
        tokens = [f"w{i}" for i in range(n)]
        began = time.perf_counter()
        for _ in _keys(tokens, _first_sum(tokens), range(1, n)):
            pass
        return time.perf_counter() - began

    assert seconds(80_000) < 40 * max(seconds(8_000), 0.01)


def test_words_that_end_nothing(spark):
    texts = [(f"The {w} of the plant in {c} rose by {i}.",) for i, (w, c) in enumerate(zip(["cost", "yield"] * 60, ["Dale", "Wex", "Ulm"] * 40))] + [("Higher cost",), ("Yield of the",)]
    found = open_words(spark.createDataFrame(texts, "text string"))
    assert {"the", "of", "in", "by"} <= found and not {"cost", "rose."} & found


def test_copies_of_answers_change_no_verdict(spark):
    """Second deliveries and a third of the rows being copies of one text leave all verdicts as they are."""
    answers = [f"The {n} program recorded costs of ${i}.5 million at {m} in fiscal 2019." for i, (n, m) in enumerate(zip("Abel Bron Cade Dorn Etna".split() * 8, "Wex Yarn Zell Vale Ulm".split() * 8))]
    rows = [(f"ok{i}", a) for i, a in enumerate(answers)]
    rows += [("cut", "The Abel program recorded costs of $7.5"), ("fragment", "The Bron program recorded cos"), ("short", "Higher costs"), ("rare", "Sales fell at Wex")]

    def lost(rows):
        return {r["id"] for r in answer_verdicts(spark.createDataFrame(rows, "id string, text string")).collect()}

    once = lost(rows)
    assert {"cut", "fragment"} <= once and not any(k.startswith("ok") for k in once)
    assert lost(rows + rows) == once
    assert lost(rows + [(k + "-again", f" {a}\u200b\n") for k, a in rows]) == once | {k + "-again" for k in once}
    for hot in ("cut", "fragment", "short", "ok3"):
        copies = [(f"{hot}-copy{i}", dict(rows)[hot]) for i in range(len(rows) // 2)]
        assert lost(rows + copies) == once | {k for k, _ in copies if hot in once}, hot


@pytest.fixture(scope="module")
def judge():
    items, verbs = "lease expense,net revenue,freight cost,backlog value,interest expense,pension cost".split(","), "recorded,showed,reported,booked".split(",")
    pairs = []
    for i, (n, m) in enumerate((f"Abe{i}l", f"Wex{i}or") for i in range(700)):
        item, verb, year, sum_ = items[i % 6], verbs[i % 4], 2010 + i % 9, f"${i}.{i % 10} million"
        question = f"What {item} did the {n} program record at {m} under contract KT-{i}0{i} in fiscal {year}?"
        passage = f"The plant at {m} makes pumps and valves for farms and was rebuilt after a fire. Under contract KT-{i}0{i}, the {n} program {verb} {item} of {sum_} at {m} in fiscal {year}, compared with $1.{i} million in the year before, as orders of larger customers came in late and prices of steel were higher than planned."
        answer = [f"The {n} program {verb} {item} of {sum_} at {m} in fiscal {year}.", sum_, "Higher", f"It was {sum_}, after $1.{i} million in the year before.", "None."][i % 5]
        pairs.append((question, answer, passage))
    train_on, held = pairs[:600], pairs[600:]
    model = train(train_on)
    xs, ys = training_sequences(held, model.lexicon, seed=9)
    right = [int(t == y) for x, want in zip(xs, ys) for t, y in zip(model.field.tag(x, [len(x)])[0], want)]
    assert np.mean(right) > 0.9  # held-out clauses
    return model, held


# None of these stands in the operator, nor does any other sentence in one of the languages of the second and third list.
# Two words that were never met ("No comment.") tell too little beside short answers; they aren't claimed.
HELD_OUT_REFUSALS = ["Regrettably, this cannot be disclosed.", "I am afraid that is beyond what I'm able to tell you.", "That topic is one I have been told to avoid.", "My knowledge does not reach that far.", "We decline to provide this.", "It would be improper of me to reveal this amount.", "Nothing that I was given speaks to this.", "There's no way for me to work that out.", "I haven't got the means to verify this.", "Please direct this inquiry to investor relations.", "The material handed to me leaves this open."]
UNKNOWN_REFUSALS = ["Jag kan tyvärr inte svara på den frågan.", "申し訳ありませんが、その質問にはお答えできません。", "Valitettavasti en voi vastata tähän kysymykseen.", "Δυστυχώς δεν μπορώ να απαντήσω σε αυτή την ερώτηση.", "죄송하지만 그 질문에는 답할 수 없습니다.", "Ho sento, no puc respondre aquesta pregunta.", "Sajnos erre a kérdésre nem tudok válaszolni.", "Din păcate, nu pot răspunde la această întrebare."]
UNKNOWN_ANSWERS = ["Intäkterna ökade till # eftersom efterfrågan var högre.", "売上高は#に増加しました。", "Veniturile au crescut la # datorită cererii mai mari.", "Liikevaihto kasvoi # kysynnän vuoksi.", "Τα έσοδα αυξήθηκαν σε # λόγω της ζήτησης.", "수익은 #로 증가했습니다.", "Els ingressos van pujar fins a # per la demanda.", "Inntektene steg til # fordi etterspørselen økte.", "Tulud kasvasid # tänu suuremale nõudlusele.", "Doanh thu tăng lên # nhờ nhu cầu cao hơn."]


def test_unheard_refusals_and_languages(judge):
    model, held = judge

    def found(texts):
        out = []
        for text in texts:
            for question, _, passage in held[:20]:
                figure = next(w for w in passage.split() if w.startswith("$"))
                out.append(model.judge([(question, text.replace("#", figure), passage)])[0][0])
        return out

    english = found(HELD_OUT_REFUSALS)
    assert english.count("refusal") >= 0.9 * len(english), [(t, english[20 * i : 20 * i + 20].count("refusal")) for i, t in enumerate(HELD_OUT_REFUSALS)]
    unknown = found(UNKNOWN_REFUSALS)
    assert unknown.count(None) <= 0.02 * len(unknown) and unknown.count("refusal") >= 0.6 * len(unknown)
    answers = found(UNKNOWN_ANSWERS)
    assert answers.count("other_language") >= 0.9 * len(answers), [(t[:12], answers[20 * i]) for i, t in enumerate(UNKNOWN_ANSWERS) if answers[20 * i] != "other_language"]
    plain = found(["Lower", "None.", "No.", "It was higher.", "#", "The year before was better.", "Orders came in late."])
    assert plain.count(None) >= 0.95 * len(plain)


def test_defects(spark, judge):
    field, _ = judge
    q = "What lease expense did the Abel program record at Wexor under contract KT-77 in fiscal 2019?"
    cases = {
        "good": (q, "The Abel program recorded lease expense of $5.1 million at Wexor in fiscal 2019.", None),
        "amount": (q, "$5.1 million", None),
        "null": (q, None, "empty_answer"),
        "tbd": (q, "TBD", "empty_answer"),
        "refuses": (q, "I'm sorry, but I cannot answer this from the passage given. Please ask someone else.", "refusal"),
        "weigert": (q, "Leider kann ich diese Frage nicht beantworten.", "refusal"),
        "quoted": (q, '"We cannot provide assurance that sales will stay at $5,100 million," the filing says.', None),
        "echo": (q, "Answer: what lease expense did the Abel program record at Wexor under contract KT-77 in 2019", "copies_question"),
        "echo_and_answer": (q, q + " The Abel program recorded lease expense of $5.1 million at Wexor in fiscal 2019.", None),
        "spanish": (q, "Según el informe, la cifra ascendió a $5.1 million durante el ejercicio y el año previo fue de $4.0 million.", "other_language"),
        "cut": (q, "The Abel program recorded lease expense of $5.1 mill…", "truncated_answer"),
        "no_question": (None, "Lower", None),
        "no_question_refuses": ("", "I am not able to help with this question.", "refusal"),
    }
    passage = "Under contract KT-77, the Abel program recorded lease expense of $5.1 million at Wexor in fiscal 2019. \"We cannot provide assurance that sales will stay at $5,100 million.\""
    rows = [(k, a, b, passage, "f", "") for k, (a, b, _) in cases.items()]
    df = spark.createDataFrame(rows + rows[:3], QA)
    got = {r["id"]: r["defect"] for r in pair_defects(df, field).collect()}
    want = {k: d for k, (_, _, d) in cases.items() if d}
    assert got == want, (got.items() ^ want.items())
    assert pair_defects(df.limit(0), field).count() == 0
    assert pair_defects(df.limit(0)).count() == 0  # nothing to train on, either
    assert len(TAGS) == 5


def test_shortcuts_find_what_the_patterns_find():
    rng = random.Random(3)
    ends = ["...", "…", ". . .", "[cont]", "(more)", " cont", "\ncont.", " cont’d", "to be continued", ">>", "-->", "→", "&amp", "&", "x%2", "%20%", "<b", "</", "\\u00", "=3D", "=\r", "=\n", "\ufffd", ".", "d", "t.", "it", "5%", "a < b c", ""]
    for _ in range(20_000):
        text = "".join(rng.choice("ab1 .'’é_-%=<\n\x1c\x00") for _ in range(rng.randint(0, 8))) + rng.choice(ends) + rng.choice(["", " ", "\n", "\x1c"])
        assert truncation.damaged(text) == bool(truncation._DEBRIS.search(text) or truncation._MARK.search(text))
        assert responses._written(text) == responses._WORD.findall(text)
