import sys
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from docloom.llm.canonical import KEPT_APART, canonical_text, canonicalize, look_alike_pairs, mapping

ODD = "aeo éＡｅ．，（ﬁﬂﬀаеосрхуԝⅼⅾΑΒοօɡ²³¹ıłœ‑-–—‘’\"​­͏⁠́̈  \t\n\r 　ёΆ"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=ODD, max_size=30))
def test_one_pass_is_enough(text):
    once = canonical_text(text)
    assert canonical_text(once) == once


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=20))
def test_any_text_is_stable(text):
    once = canonical_text(text)
    assert canonical_text(once) == once


def test_what_looks_the_same_is_equal():
    for a, b in [("１２％", "12%"), ("ﬁne", "fine"), ("café", "café"), ("cafe͏́", "café"), ("a b", "a b"), ("a b", "a b"), ("zero​width", "zerowidth"), ("соре", "cope"), ("Ά", "Á"), ("ё", "ë"), ("x‑y", "x-y"), ("a\r\nb", "a\nb"), ("ⅼist", "list"), ("ｅ́", "é")]:
        assert canonical_text(a) == canonical_text(b) == b


def test_every_character_and_its_decomposition():
    """Whatever way an assigned character is composed, it comes out in one form, which is read as itself."""
    for code in range(sys.maxunicode + 1):
        if not 0xD800 <= code <= 0xDFFF and unicodedata.category(chr(code)) != "Cn":
            form = canonical_text(chr(code))
            assert canonical_text(unicodedata.normalize("NFD", chr(code))) == form == canonical_text(form), hex(code)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aeoxкеЁｅｶか한ا\u0301\u0302\u0323\u0327\u0308\u3099\uff9e\u1112\u1161\u11ab\u0653\u064b\u093c\u200d", max_size=12))
def test_same_form_for_all_equivalent_strings(text):
    form = canonical_text(text)
    assert canonical_text(unicodedata.normalize("NFD", text)) == canonical_text(unicodedata.normalize("NFC", text)) == form == canonical_text(form)


def test_longest_chains():
    pairs = [("ｶﾞ", "ガ"), ("か\u3099", "が"), ("\u1112\u1161\u11ab", "한"), ("하\u11ab", "한"), ("\u0627\u0653", "آ"), ("µ", "μ"), ("ᎪᏟ"[0], "A"), ("e\u0302\u0301", "ế"), ("a\u0302\u0323", "ậ"), ("е\u0308", "ë"), ("\u0915\u093c", "\u0958"), ("\U0002f800", "\u4e3d")]
    for a, b in pairs:
        assert canonical_text(a) == canonical_text(b), (a, b)


def test_what_looks_different_stays_apart():
    for a, b in [("Case", "case"), ("cafe", "café"), ("m²", "m2"), ("ı", "i"), ("’", "'"), ("–", "-"), ("—", "–"), ("ab", "a b"), ("a\nb", "a b"), ("ł", "l"), ("ø", "o"), ("О", "Q")]:
        assert canonical_text(a) != canonical_text(b)
    assert not set(KEPT_APART) & mapping().keys()
    assert canonical_text(None) is None and canonical_text("") == ""


def test_pairs(spark):
    rows = [
        ("chunk", "a", ["Text one"], None), ("chunk", "b", ["Text one"], None), ("chunk", "c", ["Text one"], None), ("chunk", "d", ["Тext one"], None), ("chunk", "d", ["Тext one"], None), ("chunk", "e", ["text one"], None),
        ("table", "a", ["1", None, "2"], [2, 1]), ("table", "b", ["１", "", "2"], [2, 1]), ("table", "c", ["1", "2"], [1, 1]), ("table", "z", [], []), ("table", "y", [], []), ("chunk", "n", [""], None),
    ]
    df = spark.createDataFrame(rows, "record_kind string, record_id string, parts array<string>, row_sizes array<int>")
    got = {tuple(r) for r in look_alike_pairs(df).collect()}
    assert got == {("chunk", "a", "b"), ("chunk", "a", "d"), ("chunk", "b", "c"), ("chunk", "b", "d"), ("chunk", "c", "d"), ("table", "a", "b")}
    assert look_alike_pairs(df.limit(0)).count() == 0
    assert canonicalize(df).where("record_kind = 'table' and record_id = 'a'").first()["canonical_text"] == "1\x1f\x1e2"
