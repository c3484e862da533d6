import io
import zipfile

from pyspark.sql import functions as F

from quire.operators import content
from quire.sources import ooxml

NS = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
STYLES = (
    f'<w:styles {NS}><w:style w:styleId="Chapter"><w:name w:val="Chapter opening"/><w:basedOn w:val="Base"/></w:style>'
    '<w:style w:styleId="Base"><w:name w:val="Base"/><w:pPr><w:outlineLvl w:val="0"/></w:pPr></w:style></w:styles>'
)
NUMBERING = f'<w:numbering {NS}><w:abstractNum w:abstractNumId="7"><w:lvl w:ilvl="0"><w:numFmt w:val="decimal"/><w:lvlText w:val="%1."/></w:lvl></w:abstractNum><w:num w:numId="3"><w:abstractNumId w:val="7"/></w:num></w:numbering>'


def p(text, props=""):
    return f"<w:p><w:pPr>{props}</w:pPr><w:r><w:rPr><w:b/></w:rPr><w:t>{text}</w:t></w:r></w:p>"


def tc(text, props=""):
    return f"<w:tc><w:tcPr>{props}</w:tcPr>{p(text) if text else '<w:p/>'}</w:tc>"


# two columns of figures beside names; the name of the last two rows is one cell, the foot goes over two columns
TABLE = (
    "<w:tbl><w:tblGrid><w:gridCol/><w:gridCol/><w:gridCol/></w:tblGrid>"
    f'<w:tr><w:trPr><w:tblHeader/></w:trPr>{tc("Harbour")}{tc("Ships")}{tc("Tons")}</w:tr>'
    f'<w:tr>{tc("Westhaven", "<w:vMerge w:val=\"restart\"/>")}{tc("31")}{tc("8200")}</w:tr><w:tr>{tc("", "<w:vMerge/>")}{tc("27")}{tc("6950")}</w:tr>'
    f'<w:tr>{tc("All harbours", "<w:gridSpan w:val=\"2\"/>")}{tc("15150")}</w:tr></w:tbl>'
)


def package(body, **more):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {NS}><w:body>{body}</w:body></w:document>")
        z.writestr("word/styles.xml", STYLES)
        z.writestr("word/numbering.xml", NUMBERING)
        for name, value in more.items():
            z.writestr(name.replace("__", "/") + ".xml", value)
    return out.getvalue()


BODY = p("Trade of the year", '<w:pStyle w:val="Chapter"/>') + TABLE + p("item", '<w:numPr><w:ilvl w:val="0"/><w:numId w:val="3"/></w:numPr>') + p("end", "<w:sectPr/>") + p("") + p("after")


def raw(spark, *contents):
    rows = [(str(i), bytearray(c)) for i, c in enumerate(contents)]
    return ooxml.raw_rows(spark.createDataFrame(rows, "path string, content binary")).cache()


def test_order_styles_lists_sections(spark):
    got = ooxml.blocks(raw(spark, package(BODY))).where("area = 'body'").orderBy("ord").collect()
    assert [r.type for r in got] == ["heading", "table", "list_item", "paragraph", "paragraph"]
    assert [r.section for r in got] == [0, 0, 0, 0, 1]
    assert [r.ord for r in got] == [1, 2, 3, 4, 6]
    assert got[0].heading_level == 1 and got[2].list_format == "decimal" and got[0].runs[0].bold


def test_merges(spark):
    own = raw(spark, package(BODY))
    got = {(r.row, r.col): r for r in ooxml.cells(own).collect()}
    assert got[3, 0].colspan == 2 and got[0, 0].header and got[1, 0].rowspan == 2 and len(got) == 10
    table = ooxml.tables(own).first()
    assert table.passed and (table.nrows, table.ncols) == (4, 3)
    assert ooxml.fillers(own).count() == 0


def test_orphans_and_omitted_cells(spark):
    table = f'<w:tbl><w:tr>{tc("a", "<w:vMerge/>")}{tc("b")}</w:tr><w:tr>{tc("c")}</w:tr></w:tbl>'
    own = raw(spark, package(table))
    row = ooxml.tables(own).first()
    assert not row.passed and list(row.issues) == ["orphan_vertical_merge"] and row.nonempty_den == 4
    assert [(r.r, r.c) for r in ooxml.fillers(own).collect()] == [(1, 1)]
    assert ooxml.status(own).first().status == "partial"


def test_legacy_horizontal_merge(spark):
    table = f'<w:tbl><w:tr>{tc("a", "<w:hMerge w:val=\"restart\"/>")}{tc("b", "<w:hMerge/>")}{tc("c")}</w:tr></w:tbl>'
    got = sorted((r.col, r.colspan, r.text) for r in ooxml.cells(raw(spark, package(table))).collect())
    assert got == [(0, 2, "a\nb"), (2, 1, "c")]
    assert list(ooxml.tables(raw(spark, package(table))).first().issues) == ["legacy_hmerge_normalized"]


def test_nested_tables_get_markers(spark):
    inner = f"<w:tbl><w:tr>{tc('x')}</w:tr></w:tbl>"
    own = raw(spark, package(f"<w:tbl><w:tr><w:tc><w:p/>{inner}<w:p/></w:tc></w:tr></w:tbl>"))
    parents = {r.table_id: r.parent for r in ooxml.entity(own, "table").collect()}
    assert parents == {"table-0001": None, "table-0002": "table-0001"}
    outer = ooxml.cells(own).where("table_id = 'table-0001'").first()
    assert outer.text == "[嵌套表格 table-0002]"


def test_unsafe_and_broken_packages(spark):
    doctype = package(BODY, word__header1="<!DOCTYPE x><x/>")
    own = raw(spark, b"no zip", doctype, b"")
    assert {r.key: r.status for r in ooxml.status(own).collect()} == {"0": "failed", "1": "failed", "2": "failed"}


def test_documents_that_cannot_be_read_are_rows(spark):
    """An encrypted package, tables nested 1500 deep, and a size that is not as declared."""
    import struct

    locked = bytearray(package(p("x")))
    for mark in (b"PK\x03\x04", b"PK\x01\x02"):
        at = locked.find(mark)
        while at >= 0:
            flag = at + (6 if mark == b"PK\x03\x04" else 8)
            locked[flag : flag + 2] = struct.pack("<H", 1)
            at = locked.find(mark, at + 4)
    deep = package("<w:tbl><w:tr><w:tc>" * 1500 + p("x") + "</w:tc></w:tr></w:tbl>" * 1500)
    own = raw(spark, bytes(locked), deep, package(p("fine")))
    assert {r.key: r.status for r in ooxml.status(own).collect()} == {"0": "failed", "1": "failed", "2": "ok"}
    assert all(r.message for r in ooxml.entity(own, "error").collect())


def test_footnotes_have_content(spark):
    notes = f'<w:footnotes {NS}><w:footnote w:id="1">{p("note")}</w:footnote></w:footnotes>'
    got = ooxml.blocks(raw(spark, package(BODY, word__footnotes=notes))).where("area = 'footnotes'").collect()
    assert [r.text for r in got] == ["note"]


def test_content_of_a_document(spark):
    blocks = ooxml.blocks(raw(spark, package(BODY))).where("type <> 'table'")
    items = blocks.select("key", (F.col("section") + 1).alias("number"), "ord", content.item(F.col("type"), F.col("text"), F.col("heading_level"), F.col("list_level"), F.col("list_format")).alias("item"), content.content_runs(F.col("text"), F.col("runs")).alias("runs"))
    html = content.render_units(items, ["key"], "section", "html").first().text
    assert '<section data-section="1">\n<h1><strong>Trade of the year</strong></h1>' in html
    assert html.endswith('<section data-section="2">\n<p><strong>after</strong></p>\n</section>')
    markdown = content.render_units(items, ["key"], "section", "markdown").first().text
    assert markdown.startswith("<!-- section: 1 -->\n\n# **Trade of the year**\n\n1. **item**") and markdown.endswith("\n")
    page = spark.range(1).select(content.html_page(F.lit(None).cast("string"), F.lit("x")).alias("h")).first().h
    assert page.startswith("<!doctype html>") and content.UNTITLED in page


def test_from_packages_to_content_files(spark, tmp_path):
    """A package becomes a stored result, and the export command writes its content."""
    from quire import export
    from quire.sources import files

    core = '<cp:coreProperties xmlns:cp="x" xmlns:dc="y"><dc:title>Yearbook</dc:title></cp:coreProperties>'
    inner = f"<w:tbl><w:tr>{tc('deep')}</w:tr></w:tbl>"
    nested = f"<w:tbl><w:tr><w:tc>{p('outer')}{inner}<w:p/></w:tc></w:tr></w:tbl>"
    good = package(BODY + nested, word__header1=f"<w:hdr {NS}>{p('running head')}</w:hdr>", docProps__core=core)
    own = raw(spark, good, b"no zip")
    stored = ooxml.stored_documents(own).withColumn("folder", F.concat(F.lit("d"), "key"))
    assert {r.key: (r.status, r.json is None) for r in stored.collect()} == {"0": ("ok", False), "1": ("failed", True)}
    assert files.write_documents(stored, f"file://{tmp_path}", "folder", {"document.json": "json"}) == 2
    xml = ooxml.tables(own).select("table_id", "xml", F.concat(F.lit("d0/"), "table_id").alias("folder"))
    files.write_documents(xml, f"file://{tmp_path}", "folder", {"table.xml": "xml"})
    assert "Westhaven" in (tmp_path / "d0" / "table-0001" / "table.xml").read_text()
    assert export.export(spark, str(tmp_path)) == 1
    html, markdown = ((tmp_path / "d0" / f"content.{x}").read_text() for x in ("html", "md"))
    assert "<title>Yearbook</title>" in html and "<h1><strong>Trade of the year</strong></h1>" in html
    assert '<td data-row="1" data-col="0" rowspan="2">Westhaven</td>' in html and "outer<table>" in html and "[嵌套表格" not in html
    assert markdown.endswith("<!-- header -->\n\n**running head**\n")


def test_markdown_escape(spark):
    from quire.functions.text import markdown_escape

    got = spark.createDataFrame([("A-B.txt\n# literal\n---\n1. x\n*a*",)], "t string").select(markdown_escape(F.col("t")).alias("t")).first().t
    assert got == "A-B.txt\n\\# literal\n\\---\n1\\. x\n\\*a\\*"
