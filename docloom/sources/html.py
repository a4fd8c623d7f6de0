"""Scan of HTML pages: one pass over each page gives its blocks and tables in document order.

The parser is a small tolerant one on the standard library's tokenizer. Subtrees a reader doesn't see never enter the
tree: tagged header and hidden sections of inline business reports, and elements styled as not displayed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Tags the scan goes by.
BLOCK_TAGS = frozenset(["p", "div", "span", "li", "h1", "h2", "h3", "h4", "h5", "h6"])
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ENDS_PARAGRAPH = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul li".split())
_SILENT = frozenset(["script", "style", "template"])
_SCOPES = {"li": {"ul", "ol"}, "tr": {"table", "thead", "tbody", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}
_CLOSES = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "thead": {"thead", "tbody", "tfoot", "tr", "td", "th"}, "tbody": {"thead", "tbody", "tfoot", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tfoot", "tr", "td", "th"}}


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)
    hidden: bool = False

    def style(self) -> str:
        return (self.attrs.get("style") or "").lower().replace(" ", "")


def is_hidden(tag: str, attrs: dict[str, str]) -> bool:
    """Not for readers: tagged header or hidden sections, and what its own style hides."""
    style = (attrs.get("style") or "").lower().replace(" ", "")
    if "display:none" in style or "visibility:hidden" in style:
        return True
    if tag.rsplit(":", 1)[-1] in ("header", "hidden"):
        return tag.startswith("ix") or any("ix" in c for c in (attrs.get("class") or "").split())
    return False


def _is_outer(tag: str) -> bool:
    """Blocks, parts of tables and tagged sections: a hidden one isn't closed by the end of anything else around it."""
    return tag in _ENDS_PARAGRAPH or tag in _CLOSES or tag in ("body", "html") or ":" in tag


class _Builder(HTMLParser):
    """Builds the tree. A hidden element is opened and closed like any other, but never hung into its parent.

    The places of open elements are kept by tag, so no tag takes longer the deeper the page is nested.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.open = [self.root]
        self.places: dict[str, list[int]] = {}  # of open elements, by tag
        self.hidden: list[int] = []
        self.hidden_outer: list[int] = []

    def _last(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else -1

    def _push(self, node: Node) -> None:
        at = len(self.open)
        self.open.append(node)
        self.places.setdefault(node.tag, []).append(at)
        if node.hidden:
            self.hidden.append(at)
            if _is_outer(node.tag):
                self.hidden_outer.append(at)

    def _cut(self, at: int) -> None:
        """Close all elements from place ``at`` on."""
        while len(self.open) > at:
            self.places[self.open.pop().tag].pop()
        for places in (self.hidden, self.hidden_outer):
            while places and places[-1] >= at:
                places.pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        given = {k: v or "" for k, v in attrs}
        if tag in _ENDS_PARAGRAPH:
            self._close({"p"}, {"td", "th", "table", "li"}, within_hidden=True)
        if tag in _CLOSES:
            self._close(_CLOSES[tag], _SCOPES[tag])
        node = Node(tag, given, hidden=is_hidden(tag, given))
        if not node.hidden:
            self.open[-1].children.append(node)
        if tag not in _VOID:
            self._push(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if not is_hidden(tag, {k: v or "" for k, v in attrs}):
            self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def _close(self, tags: set[str], scope: set[str], within_hidden: bool = False) -> None:
        """Close the nearest open elements of ``tags``, not beyond one of ``scope`` (or a hidden element)."""
        at = max(map(self._last, tags))
        if at < 0 or at < max(map(self._last, scope)) or (within_hidden and self.hidden and at < self.hidden[-1]):
            return
        while at > 1 and self.open[at - 1].tag in tags:
            at -= 1
        self._cut(at)

    def handle_endtag(self, tag: str) -> None:
        at = self._last(tag)
        if at < 0 or (tag != "table" and at < self._last("table")):
            return  # what a table holds doesn't close what is around it
        if self.hidden_outer and at < self.hidden_outer[-1] and not _is_outer(tag):
            return  # a stray end of an inline element doesn't end the hiding
        self._cut(at)

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


class Page:
    """A tree laid out in document order, with what is asked of subtrees counted once.

    A subtree is the stretch of elements ``node`` to ``past[node]``, and of text pieces ``pieces[first[node]:end[node]]``.
    """

    def __init__(self, root: Node):
        self.nodes: list[Node] = []
        self.past: list[int] = []
        self.first: list[int] = []
        self.end: list[int] = []
        self.pieces: list[str] = []
        self.bold, self.slanted, blocks = [0], [0], []
        stack: list[tuple[int, Iterator[Node | str]]] = [(-1, iter([root]))]
        silent = 0
        while stack:
            owner, children = stack[-1]
            child = next(children, None)
            if child is None:
                stack.pop()
                if owner >= 0:
                    self.past[owner], self.end[owner] = len(self.nodes), len(self.pieces)
                    silent -= self.nodes[owner].tag in _SILENT
            elif isinstance(child, str):
                if not silent and (piece := child.strip()):
                    self.pieces.append(piece)
            else:
                at = len(self.nodes)
                self.nodes.append(child)
                self.past.append(at)
                self.first.append(len(self.pieces))
                self.end.append(0)
                self.bold.append(self.bold[-1] + (child.tag in ("b", "strong", "u")))
                self.slanted.append(self.slanted[-1] + (child.tag in ("i", "em")))
                if child.tag in BLOCK_TAGS:
                    blocks.append(at)
                silent += child.tag in _SILENT
                stack.append((at, iter(child.children)))
        # The next block after each element, in document order.
        self.next_block = [len(self.nodes)] * (len(self.nodes) + 1)
        for at in range(len(self.nodes) - 1, -1, -1):
            self.next_block[at] = at + 1 if at + 1 < len(self.nodes) and self.nodes[at + 1].tag in BLOCK_TAGS else self.next_block[at + 1]

    def text(self, at: int) -> str:
        """All text pieces without blanks around them, joined by one space."""
        return " ".join(self.pieces[self.first[at] : self.end[at]])

    def inner_block(self, at: int) -> int | None:
        found = self.next_block[at]
        return found if found < self.past[at] else None

    def bold_or_underlined(self, at: int) -> bool:
        style = self.nodes[at].style()
        if "font-weight:bold" in style or "font-weight:700" in style or "text-decoration:underline" in style:
            return True
        return self.bold[self.past[at]] > self.bold[at]

    def italic(self, at: int) -> bool:
        return "font-style:italic" in self.nodes[at].style() or self.slanted[self.past[at]] > self.slanted[at]


def _cell_grid(table: Node) -> tuple[list[list[str]], int]:
    """Cell texts of all rows, spans filled in, and how many of the first rows are the header."""
    sections: dict[str, list[Node]] = {"thead": [], "tbody": [], "tfoot": []}

    stack = [("tbody", iter(table.children))]
    while stack:
        section, children = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
        elif isinstance(child, Node):
            if child.tag == "tr":
                sections[section].append(child)
            elif child.tag in sections:
                stack.append((child.tag, iter(child.children)))
    head, body = sections["thead"], sections["tbody"]
    cells = lambda row: [c for c in row.children if isinstance(c, Node) and c.tag in ("td", "th")]
    if not head:
        while body and (row := cells(body[0])) and all(c.tag == "th" for c in row):
            head.append(body.pop(0))
    grid: list[list[str]] = []
    below: dict[int, tuple[str, int]] = {}  # column: text and rows still to fill

    def span(node: Node, name: str) -> int:
        value = re.match(r"\s*(\d+)", node.attrs.get(name) or "")
        return min(max(int(value[1]), 1), 1000) if value else 1

    for row in head + body + sections["tfoot"]:
        line: list[str] = []
        filled: dict[int, tuple[str, int]] = {}

        def hanging() -> None:
            while len(line) in below:
                text, rest = below.pop(len(line))
                if rest > 1:
                    filled[len(line)] = (text, rest - 1)
                line.append(text)

        for cell in cells(row):
            hanging()
            text = re.sub(r"[\r\n]+|\s{2,}", " ", "".join(_raw(cell))).strip()
            for _ in range(span(cell, "colspan")):
                if (down := span(cell, "rowspan")) > 1:
                    filled[len(line)] = (text, down - 1)
                line.append(text)
        hanging()
        below = below | filled
        grid.append(line)
    width = max(map(len, grid), default=0)
    return [line + [""] * (width - len(line)) for line in grid], len(head)


def _raw(node: Node) -> Iterator[str]:
    stack = [iter(node.children)]
    while stack:
        child = next(stack[-1], None)
        if child is None:
            stack.pop()
        elif isinstance(child, str):
            yield child
        elif child.tag not in _SILENT:
            stack.append(iter(child.children))


def table_cells(table: Node) -> tuple[list[str], list[list[str]]] | None:
    """Column names and cells as strings; None for tables without a usable cell.

    Columns are typed as a data frame's would be (thousands separators in columns of numbers vanish, blanks make whole
    numbers floats), rows and columns without any value are dropped, and the rest is written out as strings again.
    """
    from pandas.io.parsers import TextParser

    grid, n_head = _cell_grid(table)
    if not grid or not grid[0]:
        return None
    header: int | list[int] | None = None
    if n_head == 1:
        header = 0
    elif n_head > 1:
        header = [i for i in range(n_head) if any(grid[i])] or None
        header = header[0] if header and len(header) == 1 else header
    try:
        frame = TextParser(grid, header=header, thousands=",").read()
    except (ValueError, IndexError, StopIteration):
        return None
    frame = frame.dropna(axis=0, how="all").dropna(axis=1, how="all")
    if frame.empty:
        return None
    cells = frame.astype(object).where(frame.notna(), "")
    return [str(c) for c in frame.columns], [[str(v) for v in row] for row in cells.itertuples(index=False, name=None)]


def _html(node: Node) -> Iterator[str]:
    from html import escape

    stack: list[tuple[str, Iterator[Node | str]]] = [("", iter([node]))]
    while stack:
        closing, children = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            yield closing
        elif isinstance(child, str):
            yield escape(child, quote=False)
        else:
            yield f"<{child.tag}{''.join(f' {k}="{escape(v)}"' for k, v in child.attrs.items())}>"
            stack.append(("" if child.tag in _VOID else f"</{child.tag}>", iter(child.children)))


def scan(html: str | None, walk: str = "compat") -> Iterator[dict]:
    """Blocks and outermost tables of one page in document order, however deep they are nested.

    A block has is_repeat if its first block within has the same text (only headings before tables go by such blocks).
    ``walk="leaf"`` leaves out blocks that hold other blocks, so no text comes twice; the default keeps them.
    """
    page = Page(parse(html))
    position, at = 0, 1
    while at < len(page.nodes):
        node = page.nodes[at]
        if node.tag in _SILENT:
            at = page.past[at]
            continue
        if node.tag == "table":
            if (found := table_cells(node)) is not None:
                yield {"pos": position, "kind": "table", "columns": found[0], "rows": found[1], "raw_html": "".join(_html(node))}
                position += 1
            at = page.past[at]
            continue
        if node.tag in BLOCK_TAGS and page.first[at] < page.end[at]:
            inner = page.inner_block(at)
            if walk == "compat" or inner is None:
                # Text pieces are never empty, so texts are the same exactly if they are made of the same pieces.
                same = inner is not None and (page.first[inner], page.end[inner]) == (page.first[at], page.end[at])
                yield {"pos": position, "kind": "block", "tag": node.tag, "text": page.text(at), "bold_ul": page.bold_or_underlined(at), "italic": page.italic(at), "is_repeat": same}
                position += 1
        at += 1


#: Rows of blocks and tables that are handed on together.
BATCH_ROWS = 2000
SCAN_SCHEMA = "doc_id bigint, pos int, kind string, tag string, text string, bold_ul boolean, italic boolean, is_repeat boolean, columns array<string>, rows array<array<string>>, raw_html string"


def scan_pages(pages: DataFrame, walk: str = "compat") -> DataFrame:
    """Blocks and tables of all pages (doc_id, html), one row each, with their position in the page.

    Null and empty pages give no rows. Pages are parsed where they are read; nothing is shuffled.
    """
    names = [f.name for f in T._parse_datatype_string(SCAN_SCHEMA).fields]
    types = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.list_(pa.string())), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []

        def batch_of() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip(names, types)], names)
            rows.clear()
            return out

        for batch in batches:
            for doc, html in zip(batch.column(0), batch.column(1)):
                for row in scan(html.as_py(), walk):
                    rows.append({"doc_id": doc.as_py(), **row})
                    if len(rows) >= BATCH_ROWS:
                        yield batch_of()
        if rows:
            yield batch_of()

    return pages.selectExpr("cast(doc_id as bigint) as doc_id", "html").mapInArrow(run, SCAN_SCHEMA)
