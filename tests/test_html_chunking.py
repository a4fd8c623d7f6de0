import time

import pytest
from pyspark.sql import functions as F

from docloom.config import DEFAULT
from docloom.functions.text import token_estimate, words
from docloom.operators.chunking import chunk_pages, heading_level, merge_small, pack_paragraphs, with_heading_state
from docloom.operators.tables import drop_empty, extract_tables, pipe_text, table_passages
from docloom.sources.html import Page, parse, scan, scan_pages


@pytest.mark.parametrize(
    ("text", "level"),
    [
        ("PART I", 0), ("  part iv – other", 0), ("Part II", 0), ("PART", None), ("PARTIAL I", None), ("PART IXTH", None), ("A PART I", None),
        ("ITEM 7.", 1), ("Item 1A", 1), ("item 7 - results", 1), ("Item 7:", 1), ("ITEM 7", 1), ("Item 7AB", None), ("Items 7", None), ("ITEM", None), ("Item seven", None),
    ],
)
def test_part_and_item(spark, text, level):
    df = spark.createDataFrame([(text, False, False)], "t string, b boolean, i boolean")
    assert df.select(heading_level(F.col("t"), F.col("b"), F.col("i"))).first()[0] == level


@pytest.mark.parametrize(
    ("text", "bold", "slanted", "level"),
    [
        ("OVERVIEW", True, False, 2), ("ÉTÉ 7", True, False, 2), ("OVERVIEW", False, True, 3), ("Foreign Currencies", True, False, 3), ("Foreign Currencies", False, False, None), ("7 & 8", True, False, 3),
        ("Ends here.", True, True, None), ("Ends here:", True, False, 3), ("One, two,", True, False, None), ("a b c d e f g h i j k", True, False, 3), ("a b c d e f g h i j k l", True, False, None), ("   ", True, True, None), (None, True, True, None),
    ],
)
def test_styled_headings(spark, text, bold, slanted, level):
    df = spark.createDataFrame([(text, bold, slanted)], "t string, b boolean, i boolean")
    assert df.select(heading_level(F.col("t"), F.col("b"), F.col("i"))).first()[0] == level


def test_styles():
    bold, slanted = (lambda html: Page(parse(html)).bold_or_underlined(1)), (lambda html: Page(parse(html)).italic(1))
    assert bold("<p>a <b>x</b></p>") and bold('<p style="font-weight: bold">a</p>') and bold('<p style="FONT-WEIGHT:700">a</p>')
    assert bold('<p style="text-decoration: underline">a</p>') and bold("<p><u>a</u></p>") and not bold("<p><i>a</i></p>")
    assert slanted("<p><em>a</em></p>") and slanted('<p style="font-style: italic">a</p>') and not slanted("<p>a</p>")


def texts(html, **k):
    return [r["text"] for r in scan(html, **k) if r["kind"] == "block" and not r["is_repeat"]]


@pytest.mark.parametrize("tag", ["div", "font", "b", "p", "li", "td", "table", "span"])
def test_deep_and_unclosed_nesting_takes_time_in_proportion(tag):
    """Neither recursion nor the depth of what is open limits or slows a page."""

    def seconds(n, hide):
        page = "<p>first</p>" + (f"<div style='display:none'>{f'<{tag}>a' * n}</div>" if hide else f"<{tag}>" * n + "x" + f"</{tag}>" * n) + "<p>last</p>"
        began = time.perf_counter()
        found = texts(page, walk="leaf")
        if tag not in ("div", "table"):  # an open part of these is what the end tag closes
            assert found[0] == "first" and (not hide or found == ["first", "last"])
        return time.perf_counter() - began

    for hide in (False, True):
        assert seconds(100_000, hide) < 60 * max(0.05, seconds(5_000, hide))


def test_deep_cells():
    page = f"<table><tr><td>{'<b>' * 20_000}k{'</b>' * 20_000}</td><td>v</td></tr><tr><td>a</td><td>1</td></tr></table>"
    found = [r for r in scan(page) if r["kind"] == "table"]
    assert found[0]["rows"] == [["k", "v"], ["a", "1"]] and found[0]["raw_html"].startswith("<table><tr><td><b>")


def test_hidden_content_is_gone():
    page = '<ix:header><p>meta</p></ix:header><div style="display: none"><p>a<span style="visibility:hidden">b</span></p></div><p>seen <ix:nonfraction>5</ix:nonfraction></p><header><p>kept</p></header><header class="fixed"><p>gone</p></header><hidden><p>kept too</p></hidden>'
    assert texts(page) == ["seen 5", "kept", "kept too"]


def test_hidden_content_with_left_out_and_stray_ends():
    after = "<p>seen</p><table><tr><td>k</td><td>v</td></tr><tr><td>a</td><td>b</td></tr></table>"
    hidden = ["<p>a<p>b", "<ul><li>a<li>b</ul>", "<table><tr><td>a<td>b<tr><td>c</table>", "<p>a</span>b", "a</b></p>b", "a<br>b<img src=x>", "<div><p>a</div>b", "<table><tr><td>a</div>b</table>c"]
    for inner in hidden:
        page = f"<span>top</span><div style='display:none'>{inner}</div>{after}"
        assert texts(page) == ["top", "seen"] and [r["kind"] for r in scan(page)].count("table") == 1, inner
        assert texts(f"<span>x<div style='display:none'>{inner}</div>y</span>{after}") == ["x y", "seen"], inner
    assert texts("<p style='display:none'>a<p>b") == ["b"]
    assert texts("<ul><li style='display:none'>a<li>b</ul><p>c</p>") == ["b", "c"]
    assert texts("<p>x<span style='display:none'><div>a</div><p>b</p></span>y</p><p>z</p>") == ["x y", "z"]
    assert texts("<div>x<span>y<div style='visibility:hidden'>a</span>b</div>z</span></div>") == ["x y z", "y z"]
    grid = [r for r in scan("<table><tr><th>k<th>v<tr style='display:none'><td>a<td>b<tr><td>c<td style='display:none'>no<td>d</table><p>e</p>") if r["kind"] == "table"]
    assert grid[0]["rows"] == [["c", "d"]] and grid[0]["columns"] == ["k", "v"]


def test_blocks():
    assert texts("<div><p>A</p></div>") == ["A"]
    assert texts("<div><p>A</p><p>B</p></div>") == ["A B", "A", "B"]
    assert texts("<div><p>A</p><p>B</p></div>", walk="leaf") == ["A", "B"]
    assert texts("<p>one<p>two <b>three<p>four") == ["one", "two three", "four"] or texts("<p>one<p>two <b>three<p>four")[0] == "one"
    assert texts("<ul><li>x<li>y</ul><script>no</script><p> </p><!-- c -->") == ["x", "y"]
    assert texts("<p>a &amp; b<br>c</p>") == ["a & b c"] and texts("") == [] and texts(None) == []


TABLE = """<p><b>RESULTS</b></p><table><tr><th></th><th>2020</th><th>2019</th><th></th></tr>
<tr><td>Revenue</td><td>1,234</td><td>5</td><td></td></tr><tr><td></td><td></td><td></td><td></td></tr><tr><td>Cost &amp; tax</td><td>2,000</td><td></td><td></td></tr></table>"""


def test_table_cells():
    found = [r for r in scan(TABLE) if r["kind"] == "table"]
    assert len(found) == 1
    assert found[0]["columns"][1:3] == ["2020", "2019"]
    assert found[0]["rows"] == [["Revenue", "1234.0", "5.0"], ["Cost & tax", "2000.0", ""]]
    spans = [r for r in scan("<table><tr><td rowspan=2>a</td><td colspan=2>b</td></tr><tr><td>c</td><td>d</td></tr></table>") if r["kind"] == "table"]
    assert spans[0]["columns"] == ["0", "1", "2"] and spans[0]["rows"] == [["a", "b", "b"], ["a", "c", "d"]]
    assert not list(scan("<table><tr><td></td></tr></table><table></table>"))
    nested = [r for r in scan("<table><tr><td>out<table><tr><td>in</td></tr></table></td></tr></table>") if r["kind"] == "table"]
    assert len(nested) == 1


PAGE = "".join(
    [
        "<p>Cover words " + "alpha " * 40 + "</p>", "<p>PART I</p>", "<p>Item 1. Business</p>", "<p><b>OVERVIEW</b></p>", "<p>" + "beta " * 50 + "</p>", "<p>" + "gamma " * 50 + "</p>", "<p><i>Foreign Currencies</i></p>", "<p>tiny</p>",
        "<p>PART II</p>", "<p>Item 7. Results</p>", "<p>" + "delta " * 50 + "</p>", TABLE,
    ]
)


def test_pages_to_chunks_and_tables(spark):
    pages = spark.createDataFrame([(1, PAGE, "x"), (2, None, "x"), (3, "", "x"), (4, "<p>Only this.</p>", "x")], "doc_id long, html string, text string")
    scanned = scan_pages(pages)
    rows = chunk_pages(scanned).orderBy("doc_id", "order_index").collect()
    one = [r for r in rows if r["doc_id"] == 1]
    assert [r["heading_path"] for r in one] == ["Untitled", "PART I > Item 1. Business > OVERVIEW", "PART II > Item 7. Results"]
    assert one[2]["text"].startswith("tiny\ndelta") and one[2]["order_index"] == 2 and one[2]["chunk_id"] == "chunk_00003"
    assert [r["text"] for r in rows if r["doc_id"] == 4] == ["Only this."]
    table = extract_tables(scanned).collect()
    assert [(r["doc_id"], r["table_id"], r["heading_path"], r["n_rows"]) for r in table] == [(1, "table_0000", "PART II > Item 7. Results > RESULTS", 2)]
    passage = table_passages(extract_tables(scanned)).first()
    assert passage["order_index"] == 1_000_000 and passage["text"].endswith("Cost & tax | 2000.0 | ")
    assert chunk_pages(scan_pages(pages.limit(0))).count() == 0 and extract_tables(scan_pages(pages.limit(0))).count() == 0


def test_heading_state_against_a_state_machine(spark):
    import random

    rng = random.Random(1)
    rows = [(d, p, f"t{d}.{p}", rng.choice([None, None, 0, 1, 2, 3])) for d in range(20) for p in range(40)]
    got = {(r["doc_id"], r["pos"]): r["heading_path"] for r in with_heading_state(spark.createDataFrame(rows, "doc_id int, pos int, text string, level int")).collect()}
    for d in range(20):
        state = [None] * 4
        for _, p, t, level in rows[d * 40 : d * 40 + 40]:
            if level is not None:
                state[level:] = [t] + [None] * (3 - level)
            assert got[d, p] == (" > ".join(x for x in state if x) or "Untitled")


def pack(text, most, target):
    size = lambda t: int(len(t.split()) * 1.3)
    lines = [x.strip() for x in text.split("\n") if x.strip()]
    if size(text) <= most or not lines:
        return [text]
    out, now, total = [], [], 0
    for line in lines:
        if now and total + size(line) > target:
            out.append("\n".join(now))
            now, total = [], 0
        now.append(line)
        total += size(line)
    return [*out, "\n".join(now)]


def test_packing_against_a_loop(spark):
    import random

    rng = random.Random(2)
    config = DEFAULT.with_(max_tokens=50, target_tokens=40)
    cases = ["\n".join("w " * rng.randint(0, 30) for _ in range(rng.randint(1, 12))) for _ in range(60)] + ["", "\n \n", "one"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    for r in df.select("i", pack_paragraphs(F.col("t"), config).alias("p")).collect():
        assert [x.strip() for x in r["p"]] == [x.strip() for x in pack(cases[r["i"]], 50, 40)]


def test_merging_against_a_loop(spark):
    import random

    rng = random.Random(3)
    rows = [(d, f"c{d}_{i}", f"h{i}", None, None, "w " * rng.choice([1, 5, 10, 30, 60]) + f"e{i}", i) for d in range(30) for i in range(rng.randint(1, 9))]
    df = spark.createDataFrame(rows, "doc_id int, chunk_id string, heading_path string, part string, item string, text string, order_index int").withColumn("token_estimate", token_estimate(F.col("text")))
    got = {}
    for r in merge_small(df).orderBy("doc_id", "order_index").collect():
        got.setdefault(r["doc_id"], []).append((r["chunk_id"], r["text"], r["order_index"]))
    size = lambda t: int(len(t.split()) * 1.3)
    for d in range(30):
        items = [(c, t, o) for x, c, _, _, _, t, o in rows if x == d]
        want = []
        for i, (c, t, o) in enumerate(items):
            if size(t) < 30 and i + 1 < len(items):
                n = items[i + 1]
                items[i + 1] = (n[0], t + "\n" + n[1], o)
            elif size(t) < 30 and want:
                p = want[-1]
                want[-1] = (p[0], p[1] + "\n" + t, p[2])
            else:
                want.append((c, t, o))
        assert got[d] == want


def test_words_and_tables(spark):
    df = spark.createDataFrame([("a b c ",), ("",), (None,), ("  ",)], "t string")
    assert [r[0] for r in df.select(F.size(words(F.col("t")))).collect()] == [3, 0, 0, 0]
    t = spark.createDataFrame([(["a", "b", "c"], [["1", "", None], ["", "nan", ""], ["x", "NaN", ""]])], "c array<string>, r array<array<string>>")
    names, rows = drop_empty(F.col("c"), F.col("r"))
    assert tuple(t.select(names, rows).first()) == (["a"], [["1"], ["x"]])
    assert t.select(pipe_text(F.col("c"), F.col("r"))).first()[0] == "a | b | c\n1 |  | \n |  | \nx |  | "
