"""Pages of PDF files: words with boxes, ruled cells, page sizes.

A reader of its own for files whose streams are plain or deflated, with object streams, simple fonts and two-byte fonts
that bring a map to Unicode. What it cannot read (encryption, other filters, fonts without a map) is an error of the
file or of the page, in a row of its own. Rasters of pages are not drawn here: they come from a provider.

Coordinates are points from the top left corner of the page. Words are parted at spaces, at gaps of more than a fifth
of the font's size, and wherever the baseline changes; a line is a run of words on one baseline, a block one text
object. Rules are strokes and filled bars along the axes; where they enclose areas of a common grid, the areas are the
cells of a table, and areas that no rule parts are one cell.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SNAP, THIN, GAP = 3.0, 3.0, 0.2
MOST_BYTES, MOST_DEPTH = 1 << 28, 100
_DELIMITERS = b"()<>[]{}/%"
_SPACE = b"\0\t\n\f\r "
_TOKEN = re.compile(rb"[^\0\t\n\f\r ()<>\[\]{}/%]+")
_OBJECT = re.compile(rb"(?<![0-9])(\d+)\s+(\d+)\s+obj\b")


class PdfError(ValueError):
    pass


class Name(str):
    pass


@dataclass(frozen=True)
class Reference:
    number: int


@dataclass
class Stream:
    info: dict
    raw: bytes


class Operator(str):
    pass


class Lexer:
    """Values of a run of bytes, one after the other."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def skip(self) -> None:
        data, n = self.data, len(self.data)
        while self.at < n:
            if data[self.at] in _SPACE:
                self.at += 1
            elif data[self.at] == 37:  # a comment
                while self.at < n and data[self.at] not in b"\r\n":
                    self.at += 1
            else:
                return

    def value(self, depth: int = 0):
        """The next value, an Operator for a bare word, None at the end."""
        self.skip()
        if self.at >= len(self.data):
            return None
        if depth > MOST_DEPTH:
            raise PdfError("values are nested too deeply")
        c = self.data[self.at : self.at + 1]
        if self.data.startswith(b"<<", self.at):
            self.at += 2
            items = self.until(b">>", depth)
            return {k: v for k, v in zip(items[::2], items[1::2], strict=False) if isinstance(k, Name)}
        if c == b"[":
            self.at += 1
            return self.until(b"]", depth)
        if c == b"(":
            return self.literal()
        if c == b"<":
            end = self.data.find(b">", self.at)
            digits = re.sub(rb"[^0-9A-Fa-f]", b"", self.data[self.at + 1 : end])
            self.at = end + 1 if end >= 0 else len(self.data)
            return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
        if c == b"/":
            m = _TOKEN.match(self.data, self.at + 1)
            word = m.group() if m else b""
            self.at += 1 + len(word)
            return Name(re.sub(rb"#([0-9A-Fa-f]{2})", lambda x: bytes([int(x[1], 16)]), word).decode("latin-1"))
        m = _TOKEN.match(self.data, self.at)
        if not m:
            self.at += 1
            return Operator(c.decode("latin-1"))
        self.at = m.end()
        word = m.group()
        try:
            return int(word)
        except ValueError:
            pass
        try:
            return float(word) if re.fullmatch(rb"[+-]?[0-9]*\.?[0-9]*", word) else Operator(word.decode("latin-1"))
        except ValueError:
            return Operator(word.decode("latin-1"))

    def until(self, end: bytes, depth: int) -> list:
        out: list = []
        while True:
            self.skip()
            if self.at >= len(self.data):
                return out
            if self.data.startswith(end, self.at):
                self.at += len(end)
                return out
            v = self.value(depth + 1)
            if v == "R" and isinstance(v, Operator) and len(out) > 1 and isinstance(out[-2], int):
                out[-2:] = [Reference(out[-2])]
            else:
                out.append({"true": True, "false": False, "null": None}.get(v, v) if isinstance(v, Operator) else v)

    def literal(self) -> bytes:
        out, depth, data = bytearray(), 0, self.data
        while self.at < len(data):
            c = data[self.at]
            self.at += 1
            if c == 92:  # a backslash
                m = re.compile(rb"[0-7]{1,3}|\r\n|.", re.S).match(data, self.at)
                if not m:
                    break
                self.at = m.end()
                word = m.group()
                if word[:1].isdigit() and word[:1] < b"8":
                    out.append(int(word, 8) & 255)
                elif word not in (b"\n", b"\r", b"\r\n"):
                    out += {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}.get(word, word)
                continue
            depth += (c == 40) - (c == 41)
            if c == 41 and depth == 0:
                break
            if c != 40 or depth > 1:
                out.append(c)
        return bytes(out)


@dataclass
class Font:
    two_bytes: bool
    widths: dict[int, float]
    default: float
    letters: dict[int, str] | None

    def read(self, raw: bytes) -> list[tuple[int, str, float]]:
        """(code, text, width in ems) of each character."""
        size = 2 if self.two_bytes else 1
        codes = [int.from_bytes(raw[i : i + size], "big") for i in range(0, len(raw) - size + 1, size)]
        if self.letters is None and self.two_bytes:
            raise PdfError("a font has no map to Unicode")
        plain = lambda c: bytes([c]).decode("cp1252", "replace")
        return [(c, (self.letters or {}).get(c) or ("" if self.two_bytes else plain(c)), self.widths.get(c, self.default) / 1000) for c in codes]


@dataclass
class Page:
    width: float
    height: float
    words: list[dict] = field(default_factory=list)
    rules: list[tuple[float, float, float, float]] = field(default_factory=list)


class Document:
    def __init__(self, data: bytes):
        if not data.lstrip().startswith(b"%PDF"):
            raise PdfError("no PDF file")
        self.data, self.places, self.made = data, {int(m[1]): m.end() for m in _OBJECT.finditer(data)}, {}
        self.packed: dict[int, tuple[bytes, int]] = {}
        trailer: dict = {}
        for m in re.finditer(rb"trailer", data):
            found = Lexer(data, m.end()).value()
            trailer.update(found if isinstance(found, dict) else {})
        for number in list(self.places):
            o = self.get(Reference(number))
            if isinstance(o, Stream) and o.info.get("Type") == "XRef":
                trailer.update({k: v for k, v in o.info.items() if k in ("Root", "Encrypt")})
            elif isinstance(o, Stream) and o.info.get("Type") == "ObjStm":
                body, first = self.decoded(o), self.get(o.info.get("First", 0))
                numbers = [x for x in (Lexer(body[:first]).until(b"\0none", 0)) if isinstance(x, int)]
                for k, at in zip(numbers[::2], numbers[1::2], strict=False):
                    if k not in self.places:
                        self.packed[k] = (body, first + at)
        if "Encrypt" in trailer:
            raise PdfError("the file is encrypted")
        root = self.get(trailer.get("Root"))
        if not isinstance(root, dict):
            root = next((o for n in self.places if isinstance(o := self.get(Reference(n)), dict) and o.get("Type") == "Catalog"), None)
        if root is None:
            raise PdfError("no catalogue of pages")
        self.pages = list(self._leaves(root.get("Pages")))

    def get(self, value):
        seen = 0
        while isinstance(value, Reference):
            seen += 1
            if seen > MOST_DEPTH:
                raise PdfError("references go in a circle")
            if value.number not in self.made:
                self.made[value.number] = self._object(value.number)
            value = self.made[value.number]
        return value

    def _object(self, number: int):
        if number in self.packed:
            return Lexer(*self.packed[number]).value()
        if number not in self.places:
            return None
        lexer = Lexer(self.data, self.places[number])
        value = lexer.value()
        if isinstance(value, int):  # perhaps a reference
            m = re.compile(rb"\s+\d+\s+R\b").match(self.data, lexer.at)
            return Reference(value) if m else value
        m = re.compile(rb"\s*stream(\r\n|\n|\r)").match(self.data, lexer.at)
        if not isinstance(value, dict) or not m:
            return value
        size = value.get("Length")
        if isinstance(size, Reference):
            place = self.places.get(size.number)
            size = Lexer(self.data, place).value() if place else None
        end = m.end() + size if isinstance(size, int) and re.compile(rb"\s*endstream").match(self.data, m.end() + size) else self.data.find(b"endstream", m.end())
        return Stream(value, self.data[m.end() : end])

    def decoded(self, stream: Stream) -> bytes:
        filters = self.get(stream.info.get("Filter"))
        parameters = self.get(stream.info.get("DecodeParms"))
        if parameters and any((self.get(x) or {}).get("Predictor", 1) > 1 for x in (parameters if isinstance(parameters, list) else [parameters])):
            raise PdfError("a stream with a predictor")
        raw = stream.raw
        for name in filters if isinstance(filters, list) else [filters] if filters else []:
            if name != "FlateDecode":
                raise PdfError(f"a stream with the filter {name}")
            inflate = zlib.decompressobj()
            try:
                raw = inflate.decompress(raw, MOST_BYTES)
            except zlib.error as problem:
                raise PdfError(f"a damaged stream: {problem}") from None
            if inflate.unconsumed_tail:
                raise PdfError("a stream is too large")
        return raw

    def _leaves(self, top) -> Iterator[dict]:
        """Pages in order, with what they inherit."""
        todo, seen = [(top, {})], 0
        while todo:
            node, above = todo.pop()
            node, seen = self.get(node), seen + 1
            if not isinstance(node, dict) or seen > 1_000_000:
                continue
            own = above | {k: v for k, v in node.items() if k in ("MediaBox", "Resources", "Rotate")}
            if "Kids" in node:
                todo += [(k, own) for k in reversed(self.get(node["Kids"]) or [])]
            else:
                yield own | node

    def font(self, info) -> Font:
        info = self.get(info) or {}
        letters = self._letters(info["ToUnicode"]) if "ToUnicode" in info else None
        if info.get("Subtype") == "Type0":
            below = self.get((self.get(info.get("DescendantFonts")) or [None])[0]) or {}
            widths, items, i = {}, self.get(below.get("W")) or [], 0
            while i + 1 < len(items):
                first, then = self.get(items[i]), self.get(items[i + 1])
                if isinstance(then, list):
                    widths.update({first + k: self.get(w) for k, w in enumerate(then)})
                    i += 2
                else:
                    widths.update(dict.fromkeys(range(first, min(then, first + 65_535) + 1), self.get(items[i + 2])))
                    i += 3
            return Font(True, widths, self.get(below.get("DW", 1000)), letters)
        first, own = self.get(info.get("FirstChar", 0)), self.get(info.get("Widths")) or []
        return Font(False, {first + k: self.get(w) for k, w in enumerate(own)}, 500, letters)

    def _letters(self, reference) -> dict[int, str]:
        stream = self.get(reference)
        if not isinstance(stream, Stream):
            return {}
        out: dict[int, str] = {}
        text = lambda raw: raw.decode("utf-16-be", "replace")
        lexer, values = Lexer(self.decoded(stream)), []
        while (v := lexer.value()) is not None:
            if not isinstance(v, Operator):
                values.append(v)
                continue
            if v == "endbfchar":
                raw = [x for x in values if isinstance(x, bytes)]
                out.update({int.from_bytes(a, "big"): text(b) for a, b in zip(raw[::2], raw[1::2], strict=False)})
            elif v == "endbfrange":
                for a, b, c in zip(values[::3], values[1::3], values[2::3], strict=False):
                    if not isinstance(a, bytes) or not isinstance(b, bytes):
                        continue
                    low, high = int.from_bytes(a, "big"), int.from_bytes(b, "big")
                    for k in range(low, min(high, low + 65_535) + 1):
                        if isinstance(c, list):
                            out[k] = text(c[k - low]) if k - low < len(c) else ""
                        else:
                            out[k] = text((int.from_bytes(c, "big") + k - low).to_bytes(max(2, len(c)), "big"))
            values = []
        return out

    def page(self, number: int) -> Page:
        info = self.pages[number]
        box = [float(self.get(x)) for x in self.get(info.get("MediaBox")) or (0, 0, 612, 792)]
        contents = self.get(info.get("Contents")) or []
        streams = [self.get(x) for x in (contents if isinstance(contents, list) else [contents])]
        resources = self.get(info.get("Resources")) or {}
        fonts = self.get(resources.get("Font")) or {}
        return Reader(self, fonts, box).read(b"\n".join(self.decoded(s) for s in streams if isinstance(s, Stream)))


def _times(a: tuple, b: tuple) -> tuple:
    return (a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3], a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3], a[4] * b[0] + a[5] * b[2] + b[4], a[4] * b[1] + a[5] * b[3] + b[5])


class Reader:
    """One page's content: text and paths under a state that can be kept and taken back."""

    PLAIN = (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)

    def __init__(self, document: Document, fonts: dict, box: list[float]):
        self.document, self.fonts, self.box = document, fonts, box
        self.known: dict[str, Font] = {}
        self.out = Page(box[2] - box[0], box[3] - box[1])
        self.state = {"matrix": self.PLAIN, "font": None, "size": 1.0, "char": 0.0, "word": 0.0, "wide": 1.0, "lead": 0.0, "rise": 0.0}
        self.kept: list[dict] = []
        self.text = self.line = self.PLAIN
        self.path: list[tuple] = []
        self.at = self.start = (0.0, 0.0)
        self.open: dict | None = None  # the word being read
        self.block = self.line_number = -1
        self.baseline: float | None = None

    def place(self, x: float, y: float) -> tuple[float, float]:
        m = self.state["matrix"]
        return m[0] * x + m[2] * y + m[4] - self.box[0], self.box[3] - (m[1] * x + m[3] * y + m[5])

    def end_word(self) -> None:
        if self.open and self.open["text"].strip():
            self.out.words.append(self.open)
        self.open = None

    def show(self, raw: bytes) -> None:
        s = self.state
        if s["font"] is None:
            raise PdfError("text without a font")
        for code, letters, width in s["font"].read(raw):
            whole = _times((s["size"] * s["wide"], 0, 0, s["size"], 0, s["rise"]), _times(self.text, s["matrix"]))
            x, y = whole[4] - self.box[0], self.box[3] - whole[5]
            right, high = x + width * whole[0], abs(whole[3]) or abs(whole[1])
            if not letters.strip():
                self.end_word()
            else:
                if self.open and (abs(y - self.open["y"]) > 0.1 * high or x - self.open["x1"] > GAP * high or x < self.open["x1"] - high):
                    self.end_word()
                if self.baseline is None or abs(y - self.baseline) > 0.1 * high:
                    self.line_number, self.baseline = self.line_number + 1, y
                if self.open is None:
                    self.open = {"text": "", "x0": x, "y0": y - 0.8 * high, "x1": x, "y1": y + 0.2 * high, "y": y, "block": self.block, "line": self.line_number}
                self.open["text"] += letters
                self.open["x1"] = max(self.open["x1"], right)
            single = code == 32 and not s["font"].two_bytes
            self.move((width * s["size"] + s["char"] + (s["word"] if single else 0)) * s["wide"], 0)

    def move(self, x: float, y: float) -> None:
        self.text = _times((1, 0, 0, 1, x, y), self.text)

    def next_line(self, x: float, y: float) -> None:
        self.text = self.line = _times((1, 0, 0, 1, x, y), self.line)

    def rule(self, a: tuple[float, float], b: tuple[float, float]) -> None:
        x0, y0, x1, y1 = min(a[0], b[0]), min(a[1], b[1]), max(a[0], b[0]), max(a[1], b[1])
        if (x1 - x0 <= THIN) != (y1 - y0 <= THIN):
            self.out.rules.append((x0, y0, x1, y1))

    def paint(self, stroked: bool, filled: bool) -> None:
        for kind, *points in self.path:
            if kind == "line" and stroked:
                self.rule(*points)
            elif kind == "box":
                (x0, y0), (x1, y1) = points
                thin = min(abs(x1 - x0), abs(y1 - y0)) <= THIN
                if thin and (filled or stroked):
                    self.rule(*points)
                elif stroked:
                    for a, b in (((x0, y0), (x1, y0)), ((x0, y1), (x1, y1)), ((x0, y0), (x0, y1)), ((x1, y0), (x1, y1))):
                        self.rule(a, b)
        self.path = []

    def read(self, content: bytes) -> Page:
        lexer, values = Lexer(content), []
        while (v := lexer.value()) is not None:
            if isinstance(v, Operator) and v not in ("true", "false", "null"):
                if v == "BI":  # an image within the content
                    end = re.compile(rb"\sEI(?=\s)").search(content, lexer.at)
                    lexer.at = end.end() if end else len(content)
                else:
                    self.do(v, values)
                values = []
            else:
                values.append(v)
        self.end_word()
        return self.out

    def do(self, name: str, v: list) -> None:
        s = self.state
        n = [x for x in v if isinstance(x, int | float)]
        if name == "q":
            self.kept.append(dict(s))
        elif name == "Q" and self.kept:
            self.state = self.kept.pop()
        elif name == "cm" and len(n) == 6:
            s["matrix"] = _times(tuple(n), s["matrix"])
        elif name == "BT":
            self.end_word()
            self.text = self.line = self.PLAIN
            self.block, self.line_number, self.baseline = self.block + 1, -1, None
        elif name == "ET":
            self.end_word()
        elif name == "Tf" and len(v) == 2:
            if v[0] not in self.known:
                self.known[v[0]] = self.document.font(self.fonts.get(v[0]))
            s["font"], s["size"] = self.known[v[0]], float(v[1])
        elif name in ("Tc", "Tw", "TL", "Ts", "Tz") and n:
            s[{"Tc": "char", "Tw": "word", "TL": "lead", "Ts": "rise", "Tz": "wide"}[name]] = n[0] / 100 if name == "Tz" else n[0]
        elif name in ("Td", "TD") and len(n) == 2:
            s["lead"] = -n[1] if name == "TD" else s["lead"]
            self.next_line(*n)
        elif name == "Tm" and len(n) == 6:
            self.text = self.line = tuple(n)
        elif name == "T*":
            self.next_line(0, -s["lead"])
        elif name in ("Tj", "'", '"') and v and isinstance(v[-1], bytes):
            if name == '"' and len(n) == 2:
                s["word"], s["char"] = n
            if name != "Tj":
                self.next_line(0, -s["lead"])
            self.show(v[-1])
        elif name == "TJ" and v and isinstance(v[-1], list):
            for x in v[-1]:
                if isinstance(x, bytes):
                    self.show(x)
                elif isinstance(x, int | float):
                    self.move(-x / 1000 * s["size"] * s["wide"], 0)
        elif name == "m" and len(n) == 2:
            self.at = self.start = self.place(*n)
        elif name == "l" and len(n) == 2:
            to = self.place(*n)
            self.path.append(("line", self.at, to))
            self.at = to
        elif name in ("c", "v", "y") and len(n) >= 4:
            self.at = self.place(*n[-2:])
        elif name == "h":
            self.path.append(("line", self.at, self.start))
            self.at = self.start
        elif name == "re" and len(n) == 4:
            self.path.append(("box", self.place(n[0], n[1]), self.place(n[0] + n[2], n[1] + n[3])))
        elif name in ("S", "s", "f", "F", "f*", "B", "B*", "b", "b*", "n"):
            if name in ("s", "b", "b*"):
                self.path.append(("line", self.at, self.start))
            self.paint(name in ("S", "s", "B", "B*", "b", "b*"), name in ("f", "F", "f*", "B", "B*", "b", "b*"))


def _snapped(values: list[float]) -> list[float]:
    """Values that are near each other, from the least on, as one."""
    out: list[list[float]] = []
    for x in sorted(values):
        if out and x - out[-1][-1] <= SNAP:
            out[-1].append(x)
        else:
            out.append([x])
    return [sum(x) / len(x) for x in out]


def ruled_tables(rules: list[tuple[float, float, float, float]]) -> list[list[tuple[float, float, float, float]]]:
    """The cells of each table, from the rules of a page."""
    across = [(r[0], r[2], (r[1] + r[3]) / 2) for r in rules if r[2] - r[0] > r[3] - r[1]]
    down = [(r[1], r[3], (r[0] + r[2]) / 2) for r in rules if r[2] - r[0] <= r[3] - r[1]]
    xs, ys = _snapped([x for *_, x in down]), _snapped([y for *_, y in across])
    if len(xs) < 2 or len(ys) < 2:
        return []

    def drawn(found: list[tuple[float, float, float]], lines: list[float], marks: list[float]) -> set[tuple[int, int]]:
        """(line, k): there is a rule on the line from mark k to the next."""
        out = set()
        for a, b, at in found:
            line = min(range(len(lines)), key=lambda i: abs(lines[i] - at))
            out |= {(line, k) for k in range(len(marks) - 1) if a <= marks[k] + SNAP and b >= marks[k + 1] - SNAP}
        return out

    flat, tall = drawn(across, ys, xs), drawn(down, xs, ys)
    rows, cols = len(ys) - 1, len(xs) - 1
    seen: set[tuple[int, int]] = set()
    areas: list[tuple[int, int, int, int]] = []
    for r in range(rows):
        for c in range(cols):
            if (r, c) in seen:
                continue
            seen.add((r, c))
            todo, members, bounded = [(r, c)], [], True
            while todo:  # what no rule parts belongs together
                i, j = todo.pop()
                members.append((i, j))
                for edge, to in (((i, j) in flat, (i - 1, j)), ((i + 1, j) in flat, (i + 1, j)), ((j, i) in tall, (i, j - 1)), ((j + 1, i) in tall, (i, j + 1))):
                    if edge:
                        continue
                    if not (0 <= to[0] < rows and 0 <= to[1] < cols):
                        bounded = False
                    elif to not in seen:
                        seen.add(to)
                        todo.append(to)
            i0, i1, j0, j1 = min(m[0] for m in members), max(m[0] for m in members), min(m[1] for m in members), max(m[1] for m in members)
            if bounded and len(members) == (i1 - i0 + 1) * (j1 - j0 + 1):
                areas.append((i0, i1 + 1, j0, j1 + 1))
    tables: list[list[tuple[int, int, int, int]]] = []
    for area in areas:  # areas that touch along an edge or at a corner are one table
        touching = [t for t in tables if any(area[0] <= o[1] and o[0] <= area[1] and area[2] <= o[3] and o[2] <= area[3] for o in t)]
        tables = [t for t in tables if t not in touching] + [[area, *(o for t in touching for o in t)]]
    boxes = [[(xs[j0], ys[i0], xs[j1], ys[i1]) for i0, i1, j0, j1 in sorted(t)] for t in tables if len(t) > 1]
    return sorted(boxes, key=lambda t: (t[0][1], t[0][0]))


WORD = "array<struct<text:string,x0:double,y0:double,x1:double,y1:double,block:int,line:int>>"
CELLS = "array<array<struct<x0:double,y0:double,x1:double,y1:double>>>"
SCHEMA = f"path string, page int, pages int, width double, height double, words {WORD}, tables {CELLS}, error string"


def read_pages(content: bytes, wanted: list[int] | None = None, most: int | None = None) -> Iterator[dict]:
    """One dict a page; PdfError for a file that cannot be read or lacks a wanted page."""
    document = Document(content)
    n = len(document.pages)
    if wanted and max(wanted) > n:
        raise PdfError(f"page {max(wanted)} is beyond the {n} pages of the file")
    for number in sorted(set(wanted)) if wanted else range(1, min(n, most or n) + 1):
        row: dict = {"page": number, "pages": n, "width": None, "height": None, "words": [], "tables": [], "error": None}
        try:
            page = document.page(number - 1)
            corners = ("x0", "y0", "x1", "y1")
            row |= {"width": page.width, "height": page.height, "words": [{k: w[k] for k in ("text", *corners, "block", "line")} for w in page.words]}
            row["tables"] = [[dict(zip(corners, c, strict=True)) for c in t] for t in ruled_tables(page.rules)]
        except Exception as problem:  # noqa: BLE001  a page of unknown origin must not end the others
            row["error"] = str(problem) or type(problem).__name__
        yield row


def pages(files: DataFrame, wanted: list[int] | None = None, most: int | None = None, path: str = "path", content: str = "content") -> DataFrame:
    """path, page (from 1), pages, width, height, words, tables (cell boxes), error. Only wanted pages, or the first
    ``most``, are read; a file that cannot be read, or lacks a wanted page, gives one row with an error and no page."""
    own = files.select(F.col(path).cast("string").alias("path"), F.col(content).alias("content"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, raw in zip(frame["path"], frame["content"], strict=True):
                try:
                    rows = list(read_pages(bytes(raw or b""), wanted, most))
                except Exception as problem:  # noqa: BLE001  one file must not end the job
                    rows = [{"page": None, "pages": None, "width": None, "height": None, "words": [], "tables": [], "error": str(problem) or type(problem).__name__}]
                yield pd.DataFrame([(name, json.dumps(r)) for r in rows], columns=["path", "row"])

    read = own.mapInPandas(run, "path string, row string")
    inner = SCHEMA.replace("path string, ", "", 1)
    return read.select("path", F.from_json("row", inner).alias("r")).select("path", "r.*")


def words(read: DataFrame) -> DataFrame:
    """path, page, pos, word, box, block, line of every word of pages()."""
    each = read.select("path", "page", F.posexplode("words").alias("pos", "w"))
    return each.select("path", "page", "pos", F.col("w.text").alias("word"), F.struct("w.x0", "w.y0", "w.x1", "w.y1").alias("box"), "w.block", "w.line")


def cells(read: DataFrame) -> DataFrame:
    """path, page, table_id, cell, box of the ruled cells of pages()."""
    tables = read.select("path", "page", F.posexplode("tables").alias("table_id", "t"))
    return tables.select("path", "page", "table_id", F.posexplode("t").alias("cell", "box"))
