"""Files made by hand: plain and deflated streams, object streams, rules, and what cannot be read."""

import zlib

import pytest

from quire.sources import pdf

WIDTHS = "[" + " ".join(["500"] * 224) + "]"


def made(*contents, more="", packed=False, deflate=False, font=None, trailer="/Root 1 0 R"):
    """A file of one page per content."""
    n = len(contents)
    kids = " ".join(f"{10 + 2 * i} 0 R" for i in range(n))
    objects = {
        1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: f"<< /Type /Pages /Kids [{kids}] /Count {n} /MediaBox [0 0 200 100] /Resources << /Font << /F1 3 0 R >> >> >>".encode(),
        3: (font or f"<< /Type /Font /Subtype /Type1 /BaseFont /Any /FirstChar 32 /Widths {WIDTHS} >>").encode(),
    }
    streams = {}
    for i, content in enumerate(contents):
        raw = content if isinstance(content, bytes) else content.encode("latin-1")
        objects[10 + 2 * i] = f"<< /Type /Page /Parent 2 0 R /Contents {11 + 2 * i} 0 R >>".encode()
        body = zlib.compress(raw) if deflate else raw
        streams[11 + 2 * i] = f"<< /Length {len(body)}{' /Filter /FlateDecode' if deflate else ''} >>\nstream\n".encode() + body + b"\nendstream"
    if packed:
        body, index, at = b"", [], 0
        for k, v in objects.items():
            index.append(f"{k} {at}")
            body += v + b"\n"
            at = len(body)
        head = (" ".join(index) + "\n").encode()
        raw = zlib.compress(head + body)
        streams[50] = f"<< /Type /ObjStm /N {len(objects)} /First {len(head)} /Filter /FlateDecode /Length {len(raw)} >>\nstream\n".encode() + raw + b"\nendstream"
        objects = {}
    out = b"%PDF-1.5\n" + b"".join(f"{k} 0 obj\n".encode() + v + b"\nendobj\n" for k, v in {**objects, **streams}.items())
    return out + more.encode() + f"\ntrailer\n<< {trailer} >>\n%%EOF".encode()


TEXT = r"BT /F1 10 Tf 20 80 Td (Tide table) Tj 0 -20 Td [(H) 20 (igh) -900 (wa\164er)] TJ T* ET BT /F1 10 Tf 1 0 0 1 20 30 Tm (\(low\)) Tj ET"


def words(raw, page=0):
    return [(w["text"], round(w["x0"], 2), round(w["y1"], 2), w["block"], w["line"]) for w in list(pdf.read_pages(raw))[page]["words"]]


@pytest.mark.parametrize("how", [{}, {"deflate": True}, {"packed": True}, {"packed": True, "deflate": True}])
def test_words_and_their_places(how):
    got = words(made(TEXT, **how))
    assert [(w[0], w[3], w[4]) for w in got] == [("Tide", 0, 0), ("table", 0, 0), ("High", 0, 1), ("water", 0, 1), ("(low)", 1, 0)]
    assert got[0][1:3] == (20.0, 22.0) and got[1][1] == 45.0 and got[4][1:3] == (20.0, 72.0)
    page = next(iter(pdf.read_pages(made(TEXT, **how))))
    assert (page["width"], page["height"], page["pages"]) == (200.0, 100.0, 1)


def test_state_is_kept_and_taken_back():
    content = "q 2 0 0 2 10 10 cm BT /F1 5 Tf 0 0 Td (big) Tj ET Q BT /F1 5 Tf 10 10 Td (small) Tj ET"
    (a, b) = words(made(content))
    assert a[1:3] == (10.0, 92.0) and b[1:3] == (10.0, 91.0)


def test_two_byte_fonts_need_a_map():
    cmap = "1 beginbfchar <0001> <0416> endbfchar 2 beginbfrange <0002> <0003> <0061> <0004> <0005> [<4E2D> <6587>] endbfrange"
    font = "<< /Type /Font /Subtype /Type0 /DescendantFonts [<< /DW 1000 /W [1 [500 600]] >>] /ToUnicode 90 0 R >>"
    more = f"90 0 obj << /Length {len(cmap)} >>\nstream\n{cmap}\nendstream\nendobj\n"
    content = "BT /F1 10 Tf 10 10 Td <00010002000300040005> Tj ET"
    assert [w[0] for w in words(made(content, font=font, more=more))] == ["Жab中文"]
    bare = list(pdf.read_pages(made(content, font=font.replace("/ToUnicode 90 0 R", ""))))
    assert "Unicode" in bare[0]["error"] and not bare[0]["words"]


def grid(xs, ys, skip=()):
    lines = [f"{x} {ys[i]} m {x} {ys[i + 1]} l" for x in xs for i in range(len(ys) - 1) if ("v", x, i) not in skip]
    lines += [f"{xs[i]} {y} m {xs[i + 1]} {y} l" for y in ys for i in range(len(xs) - 1) if ("h", y, i) not in skip]
    return "\n".join(lines) + "\nS"


def cells(content):
    (page,) = pdf.read_pages(made(content))
    return [[tuple(round(c[k]) for k in ("x0", "y0", "x1", "y1")) for c in t] for t in page["tables"]]


def test_ruled_cells():
    assert cells(grid([10, 60, 110], [10, 50, 90])) == [[(10, 10, 60, 50), (60, 10, 110, 50), (10, 50, 60, 90), (60, 50, 110, 90)]]
    # no rule between the two upper cells: one cell
    assert cells(grid([10, 60, 110], [10, 50, 90], {("v", 60, 1)})) == [[(10, 10, 110, 50), (10, 50, 60, 90), (60, 50, 110, 90)]]
    # a side is open: its cells are none
    assert cells(grid([10, 60, 110], [10, 50, 90], {("v", 110, 0), ("v", 110, 1)})) == [[(10, 10, 60, 50), (10, 50, 60, 90)]]
    two = grid([10, 30, 50], [10, 50, 90]) + "\n" + grid([100, 130, 160], [10, 50, 90])
    assert [len(t) for t in cells(two)] == [4, 4]
    bars = "\n".join(f"{x} 10 1 80 re f" for x in (10, 60, 110)) + "\n" + "\n".join(f"10 {y} 101 1 re f" for y in (10, 50, 89))
    assert [len(t) for t in cells(bars)] == [4]
    assert cells("10 10 50 50 re S") == [] and cells(TEXT) == []


def test_pages_are_chosen_before_they_are_read(spark):
    three = made("BT /F1 9 Tf (one) Tj ET", "BT /F1 9 Tf (two) Tj ET", "BT /F1 9 Tf (three) Tj ET")
    one = made("BT /F1 9 Tf (alone) Tj ET")
    broken = made(TEXT).replace(b"/F1 10 Tf 20 80 Td", b"/F9 10 Tx 20 80 Td")
    rows = [("a", bytearray(three)), ("b", bytearray(one)), ("c", bytearray(b"no")), ("d", bytearray(made(TEXT, trailer="/Root 1 0 R /Encrypt 9 0 R"))), ("e", bytearray(broken)), ("f", None)]
    files = spark.createDataFrame(rows, "path string, content binary")
    every = pdf.pages(files).cache()
    got = {(r.path, r.page): [w.text for w in r.words] for r in every.where("error is null").collect()}
    assert got == {("a", 1): ["one"], ("a", 2): ["two"], ("a", 3): ["three"], ("b", 1): ["alone"]}
    errors = {(r.path, r.page): r.error for r in every.where("error is not null").collect()}
    assert set(errors) == {("c", None), ("d", None), ("e", 1), ("f", None)} and "encrypted" in errors["d", None]
    assert {(r.path, r.page) for r in pdf.pages(files.limit(2), most=2).collect()} == {("a", 1), ("a", 2), ("b", 1)}
    chosen = {(r.path, r.page): r.error for r in pdf.pages(files.limit(2), wanted=[1, 3]).collect()}
    assert chosen["a", 1] is None and chosen["a", 3] is None and "beyond the 1 pages" in chosen["b", None] and len(chosen) == 3
    placed = pdf.words(every).where("path = 'a' and page = 2").first()
    assert placed.word == "two" and placed.box.x0 == 0.0


def test_cells_and_words_meet(spark):
    """From a file to the text of its cells."""
    from quire.operators import layout

    text = "BT /F1 8 Tf 1 0 0 1 15 75 Tm (Name) Tj 1 0 0 1 65 75 Tm (Depth) Tj 1 0 0 1 15 30 Tm (bay) Tj 1 0 0 1 65 30 Tm (4 m) Tj ET\n"
    read = pdf.pages(spark.createDataFrame([("a", bytearray(made(text + grid([10, 60, 110], [10, 50, 90]))))], "path string, content binary")).cache()
    boxes = pdf.cells(read).withColumnRenamed("box", "region")
    found = layout.words_in(pdf.words(read), boxes, ["path", "page"]).groupBy("cell").agg(layout.in_order(["pos"], "word", " ").alias("text"))
    assert {r.cell: r.text for r in found.collect()} == {0: "Name", 1: "Depth", 2: "bay", 3: "4 m"}
