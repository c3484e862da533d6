"""Stored results to content files."""

import json

import pytest

from quire import export


def run(text, **more):
    return {"text": text, **more}


def block(kind, text, **more):
    return {"type": kind, "text": text, **more}


def cell(row, col, text, **more):
    return {"row": row, "col": col, "rowspan": 1, "colspan": 1, "text": text, "header": row == 0, **more}


PAGED = {
    "schema_version": "1.0", "input": "/secret/place.pdf", "errors": [], "metadata": {"title": " Ferry <times> "},
    "pages": [
        {"page": 1, "blocks": [block("text", "below", bbox=[5, 300, 80, 310], source="x"), block("text", "above\nall", bbox=[5, 20, 80, 30])], "tables": [{"id": "t", "bbox": [5, 100, 200, 200], "nrows": 1, "ncols": 2, "engine": "p", "cells": [cell(0, 0, "pier"), cell(0, 1, "a & b")]}]},
        {"page": 2, "blocks": [], "tables": []}, {"page": 3, "blocks": [block("text", "last")], "tables": []},
    ],
}
SECTIONED = {
    "source_format": "docx",
    "blocks": [
        block("table", "", order=2, section=0, table_id="outer"), block("heading", "First", order=1, section=0, heading_level=9), block("table", "", order=3, section=0, table_id="missing"),
        block("list_item", "point", order=4, section=1, list={"level": 1, "format": "decimal"}), block("odd", "bold text", order=5, section=1, runs=[run("bold", bold=True), run(" text")]),
    ],
    "tables": [
        {"id": "outer", "nrows": 2, "ncols": 1, "cells": [cell(0, 0, "head"), cell(1, 0, "see\n[嵌套表格 inner]", nested_tables=["inner", "gone", "outer"])]},
        {"id": "inner", "nrows": 1, "ncols": 1, "cells": [cell(0, 0, "deep", nested_tables=["outer"])]},
    ],
    "ancillary": {"headers": [{"blocks": [block("paragraph", "running head", order=1)]}, {"blocks": []}], "footnotes": [{"blocks": [block("paragraph", "a note", order=1)]}]},
}


@pytest.fixture(scope="module")
def exported(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("results")
    for name, document in (("ferry", PAGED), ("deep/notes", SECTIONED)):
        (root / name).mkdir(parents=True)
        (root / name / "document.json").write_text(json.dumps(document))
    assert export.export(spark, str(root)) == 2
    return {name: {x: (root / name / f"content.{x}").read_text() for x in ("json", "html", "md")} for name in ("ferry", "deep/notes")}


def test_pages_in_reading_order(exported):
    own = json.loads(exported["ferry"]["json"])
    assert [(u["number"], len(u["content"])) for u in own["content"]] == [(1, 3), (2, 0), (3, 1)] and own["structure"] == "pages" and own["title"] == "Ferry <times>"
    assert [i["type"] for i in own["content"][0]["content"]] == ["text", "table", "text"]
    assert own["content"][0]["content"][1]["cells"][1]["text"] == "a & b"
    assert not any(word in exported["ferry"]["json"] for word in ("secret", "bbox", "engine", "source\"", "errors"))
    html = exported["ferry"]["html"]
    assert "<title>Ferry &lt;times&gt;</title>" in html and html.index("above<br>") < html.index("a &amp; b") < html.index("below")
    assert exported["ferry"]["md"].startswith("<!-- page: 1 -->\n\nabove\nall\n\n<table>")


def test_sections_nested_tables_and_notes(exported):
    own = json.loads(exported["deep/notes"]["json"])
    assert own["source_format"] == "docx" and [u["number"] for u in own["content"]] == [1, 2]
    first = own["content"][0]["content"]
    assert [i["type"] for i in first] == ["heading", "table"] and first[0]["level"] == 6
    (inner,) = first[1]["cells"][1]["nested_tables"]
    assert inner["cells"][0]["text"] == "deep" and "nested_tables" not in inner["cells"][0] and first[1]["cells"][1]["text"] == "see"
    assert own["supplementary"]["header"][0]["content"][0]["text"] == "running head" and len(own["supplementary"]["header"]) == 1
    assert list(own["supplementary"]) == ["header", "footnotes"]
    html = exported["deep/notes"]["html"]
    assert '<td data-row="1" data-col="0">see<table>\n<tr>\n<th data-row="0" data-col="0">deep</th>' in html
    assert html.index("<strong>bold</strong> text") < html.index('<aside data-content-kind="header">') < html.index('<aside data-content-kind="footnotes">')
    assert exported["deep/notes"]["md"].endswith("  1. point\n\n**bold** text\n\n<!-- header -->\n\nrunning head\n\n<!-- footnotes -->\n\na note\n")


def test_nothing_to_export_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        export.export(spark, str(tmp_path))
    (tmp_path / "document.json").write_text('{"metadata": {"title": "x"}}')
    with pytest.raises(Exception, match="unsupported document"):
        export.export(spark, str(tmp_path))
