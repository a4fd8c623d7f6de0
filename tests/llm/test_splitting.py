import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docloom.llm.splitting import split_oversized, split_text, words_within

TEXTS = st.lists(st.sampled_from(["word", "Other", "end.", "Next", "list;", "No.", "\n", "\n\n", "•", "É", "4,200"]), max_size=400).map(" ".join)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(8, 60), st.integers(0, 6))
def test_pieces_cover_the_text_within_the_limit(text, limit, overlap):
    words = text.split()
    pieces = split_text(text, limit, overlap)
    if not words:
        assert pieces == []
        return
    shared = int(overlap / 1.3)
    assert pieces[0].start_word == 0 and pieces[-1].end_word == len(words)
    for p in pieces:
        assert text[p.start_char : p.end_char].split() == words[p.start_word : p.end_word]
        assert int((p.end_word - p.start_word) * 1.3) <= limit
    for a, b in zip(pieces, pieces[1:]):
        assert b.start_word == a.end_word - shared
        assert b.end_word > a.end_word


def test_natural_ends_win_wherever_one_is_in_reach():
    sentence = "Alpha beta gamma delta epsilon zeta eta theta iota kappa. "
    pieces = split_text(sentence * 30, limit=60)
    assert all(p.boundary == "sentence" for p in pieces[:-1]) and pieces[-1].boundary == "end"
    paragraphs = "\n\n".join(["Some words in a row here. And more of them."] * 40)
    assert {p.boundary for p in split_text(paragraphs, limit=60)[:-1]} == {"paragraph"}


def test_semicolons_end_entries_only_before_a_new_one():
    text = " ".join(["The value expires over weeks; royalties came to nothing; Customers of it may return goods;"] * 40)
    pieces = split_text(text, limit=60)
    assert all(text[p.end_char :].lstrip()[0].isupper() for p in pieces[:-1])


def test_words_alone_are_cut_evenly_and_abbreviations_do_not_end_sentences():
    pieces = split_text("word " * 100, limit=39)
    sizes = [p.end_word - p.start_word for p in pieces]
    assert max(sizes) - min(sizes) <= 1 and len(pieces) == 4
    assert all(p.boundary == "word" for p in split_text("see No. 4 or i.e. that " * 30, limit=39)[:-1])
    assert words_within(600, 1.3) == 462


def test_bad_parameters_raise():
    with pytest.raises(ValueError):
        split_text("a b", limit=10, overlap_tokens=20)


def test_operator_on_odd_rows(spark):
    long = "one two three. " * 400
    rows = [("a", long, 1), ("a", long, 2), ("b", None, 1), ("c", "", 1), ("d", "   ", 1), ("e", "short text", 1), (None, long, 1)]
    df = spark.createDataFrame(rows, "chunk_id string, text string, piece_index int")
    got = split_oversized(df)
    assert got.columns == ["chunk_id", "piece_index", "n_pieces", "start_word", "n_words", "tokens", "boundary", "piece_text"]
    assert {r["chunk_id"] for r in got.collect()} == {"a", None}
    assert got.where("tokens > 600").count() == 0
    assert split_oversized(df.limit(0)).count() == 0
