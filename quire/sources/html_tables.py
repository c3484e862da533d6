"""Tables in HTML: to cells, and to trees for comparison, row by row in batches.

Walks keep their own stacks, so nesting of any depth is read, and spans are kept as intervals of columns, so a wide
span costs no more than a narrow one. What cannot be read gives a row with an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPAN_LIMIT = 1000
PARTS = ("thead", "tbody", "tfoot")
KEPT = ("table", *PARTS, "tr", "td", "th")
_VOID = {"br", "hr", "img", "input", "meta", "link", "col", "wbr", "area", "base", "embed", "source", "track"}
#: an open tag that one of these closes when it comes first
_CLOSES = {"td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), **{p: ("td", "th", "tr", *PARTS) for p in PARTS}}


@dataclass
class Element:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)  # elements and strings

    def pieces(self) -> list[str]:
        """The strings below, in order."""
        out, todo = [], [self]
        while todo:
            at = todo.pop()
            if isinstance(at, str):
                out.append(at)
            else:
                todo += reversed(at.children)
        return out

    def text(self) -> str:
        return "".join(self.pieces())

    def elements(self) -> list[Element]:
        return [c for c in self.children if isinstance(c, Element)]

    def first(self, tag: str) -> Element | None:
        """The first element of that name below, in document order."""
        todo = self.elements()[::-1]
        while todo:
            at = todo.pop()
            if at.tag == tag:
                return at
            todo += at.elements()[::-1]
        return None


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        while len(self.open) > 1 and self.open[-1].tag in _CLOSES.get(tag, ()):
            self.open.pop()
        element = Element(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(element)
        if tag not in _VOID:
            self.open.append(element)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Element(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        names = [e.tag for e in self.open]
        if tag in names[1:]:
            del self.open[len(names) - 1 - names[::-1].index(tag) :]

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(source: str) -> Element:
    builder = _Builder()
    builder.feed(source)
    builder.close()
    return builder.root


def _span(cell: Element, name: str) -> int:
    n = int(cell.attrs.get(name, "1"))
    if not 1 <= n <= SPAN_LIMIT:
        raise ValueError(f"{name} out of range: {n}")
    return n


def cells(source: str) -> list[tuple[int, int, int, int, str, bool]]:
    """(row, col, rowspan, colspan, text, header) of the first table; ValueError if there is none or a span is bad."""
    table = parse(source).first("table")
    if table is None:
        raise ValueError("no table")
    rows = []
    for part in table.elements():
        if part.tag == "tr":
            rows.append((part, False))
        elif part.tag in PARTS:
            rows += [(tr, part.tag == "thead") for tr in part.elements() if tr.tag == "tr"]
    open_: list[tuple[int, int, int]] = []  # first column, column after the last, row after the last
    out = []
    for r, (tr, in_head) in enumerate(rows):
        open_ = sorted(x for x in open_ if x[2] > r)
        col, new = 0, []
        for cell in tr.elements():
            if cell.tag not in ("td", "th"):
                continue
            for first, after, _ in open_:
                if first <= col < after:
                    col = after
            high, wide = _span(cell, "rowspan"), _span(cell, "colspan")
            out.append((r, col, high, wide, cell.text().strip(), cell.tag == "th" or in_head))
            if high > 1:
                new.append((col, col + wide, r + high))
            col += wide
        open_ += new
    return out


@dataclass
class Tree:
    tag: str
    spans: tuple[int, int] | None
    text: str
    children: list[Tree]


def tree(source: str) -> Tree:
    """The first table with its parts, rows and cells only."""
    table = parse(source).first("table")
    if table is None:
        raise ValueError("no table")

    def node(e: Element) -> Tree:
        leaf = e.tag in ("td", "th")
        spans = (int(e.attrs.get("rowspan", "1")), int(e.attrs.get("colspan", "1"))) if leaf else None
        return Tree(e.tag, spans, re.sub(r"\s+", " ", " ".join(e.pieces())).strip() if leaf else "", [])

    root = node(table)
    todo = [(table, root)]
    while todo:
        element, own = todo.pop()
        for c in element.elements():
            if c.tag in KEPT:
                own.children.append(node(c))
                todo.append((c, own.children[-1]))
    return root


def html_table_cells(tables: DataFrame, key: str, source: str = "html") -> DataFrame:
    """key, row, col, rowspan, colspan, text, header, error; a table that cannot be read gives one row with error."""
    own = tables.select(F.col(key).alias("key"), F.col(source).alias("html"))
    kind = own.schema["key"].dataType.simpleString()
    names = ["row", "col", "rowspan", "colspan", "text", "header", "error"]
    kinds = [*[pa.int32()] * 4, pa.string(), pa.bool_(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at: list[int] = []
            out: list[tuple] = []
            for i, html in enumerate(batch.column("html").to_pylist()):
                try:
                    found = [(*c, None) for c in cells(html or "")]
                except ValueError as problem:
                    found = [(*[None] * 6, str(problem))]
                out += found
                at += [i] * len(found)
            columns = zip(*out, strict=True) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(at, pa.int32())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["key", *names])

    found = own.mapInArrow(run, f"key {kind}, row int, col int, rowspan int, colspan int, text string, header boolean, error string")
    return found.withColumnRenamed("key", key)
