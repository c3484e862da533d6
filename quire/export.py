"""Content exports of stored results: ``python -m quire.export FOLDER`` reads every document.json below a folder and
writes content.json, content.html and content.md beside it, with source content only."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import content
from quire.session import session, ship
from quire.sources import files

_RUNS = "array<struct<text:string,bold:boolean,italic:boolean,underline:boolean,vertical_align:string,hyperlink:string>>"
_BLOCK = f"struct<type:string,text:string,bbox:array<double>,order:int,section:int,heading_level:int,table_id:string,list:struct<level:int,format:string>,runs:{_RUNS}>"
_TABLE = "struct<id:string,bbox:array<double>,nrows:int,ncols:int,cells:array<struct<row:int,col:int,rowspan:int,colspan:int,text:string,header:boolean,nested_tables:array<string>>>>"
_PART = f"array<struct<blocks:array<{_BLOCK}>>>"
DOCUMENT = (
    f"source_format string, metadata struct<title:string>, pages array<struct<page:int,blocks:array<{_BLOCK}>,tables:array<{_TABLE}>>>, blocks array<{_BLOCK}>, tables array<{_TABLE}>, "
    f"ancillary struct<headers:{_PART},footers:{_PART},footnotes:{_PART},endnotes:{_PART}>"
)
NONE = "none"


def _item():
    b = F.col("b")
    return content.item(b["type"], b["text"], b["heading_level"], b["list"]["level"], b["list"]["format"]), content.content_runs(b["text"], b["runs"])


def _table_item(text):
    return F.struct(F.lit("table").alias("type"), text.alias("text"), F.lit(None).cast("int").alias("level"), F.lit(None).cast("string").alias("format"))


def _cells(tables: DataFrame, keys: list[str]) -> DataFrame:
    one = tables.select(*keys, F.explode("t.cells").alias("c"))
    span = lambda name: F.greatest(F.lit(1), F.coalesce(F.col(f"c.{name}"), F.lit(1))).alias(name)
    at = lambda name: F.coalesce(F.col(f"c.{name}"), F.lit(0)).alias(name)
    return one.select(*keys, at("row"), at("col"), span("rowspan"), span("colspan"), F.col("c.text").alias("text"), F.coalesce("c.header", F.lit(False)).alias("header"), F.col("c.nested_tables").alias("nested"))


def _sizes(tables: DataFrame, keys: list[str]) -> DataFrame:
    return tables.select(*keys, F.coalesce("t.nrows", F.lit(0)).alias("nrows"), F.coalesce("t.ncols", F.lit(0)).alias("ncols"))


def _rendered(docs: DataFrame, unit: str, units: DataFrame, body: DataFrame, texts: DataFrame, more: DataFrame | None) -> DataFrame:
    """units: path, number of all units, one row with a null number for a document without any. body and more: path, number or area and part, ord, item, runs, table_key; texts: path, table_key, html, json of tables."""

    def form(items: DataFrame | None, column: str) -> DataFrame | None:
        if items is None:
            return None
        both = items.join(texts.select("path", "table_key", F.col(column).alias("rendered")), ["path", "table_key"], "left")
        kept = both.where(F.col("table_key").isNull() | F.col("rendered").isNotNull())
        return kept.withColumn("item", F.when(F.col("table_key").isNotNull(), _table_item(F.col("rendered"))).otherwise(F.col("item")))

    titled = units.join(docs.select("path", F.col("metadata.title").alias("title")), "path")
    html = content.render_units(form(body, "html"), ["path"], unit, "html", form(more, "html"), units).withColumnRenamed("text", "body")
    markdown = content.render_units(form(body, "html"), ["path"], unit, "markdown", form(more, "html"), units).withColumnRenamed("text", "markdown")
    json = content.content_documents(form(body, "json"), ["path"], unit, "pdf" if unit == "page" else "docx", F.col("title"), form(more, "json"), titled)
    every = docs.select("path", F.col("metadata.title").alias("title")).join(html, "path").join(markdown, "path").join(json, "path")
    return every.select("path", "json", content.html_page(F.col("title"), F.col("body")).alias("html"), "markdown")


def paged(docs: DataFrame) -> DataFrame:
    """Exports of documents with pages: blocks and tables of a page by top, left, tables first."""
    units = docs.where("pages is not null").select("path", F.explode_outer("pages.page").alias("number"))
    pages = docs.where("pages is not null").select("path", F.explode("pages").alias("p")).select("path", F.col("p.page").alias("number"), "p.blocks", "p.tables")
    corner = lambda of, i: F.coalesce(F.get(F.col(f"{of}.bbox"), F.lit(i)), F.lit(0.0))
    blocks = pages.select("path", "number", F.posexplode("blocks").alias("i", "b"))
    item, runs = _item()
    own = blocks.select("path", "number", F.struct(corner("b", 1), corner("b", 0), F.lit(1), "i").alias("ord"), item.alias("item"), runs.alias("runs"), F.lit(None).cast("string").alias("table_key"))
    tables = pages.select("path", "number", F.posexplode("tables").alias("i", "t")).withColumn("table_key", F.concat_ws("-", "number", "i"))
    shown = tables.select("path", "number", F.struct(corner("t", 1), corner("t", 0), F.lit(0), "i").alias("ord"), _table_item(F.lit("")).alias("item"), F.lit(None).cast(_RUNS).alias("runs"), "table_key")
    keys = ["path", "table_key"]
    cells, sizes = _cells(tables, keys).drop("nested"), _sizes(tables, keys)
    texts = content.table_html(cells, keys, sizes, export=True).join(content.table_json(cells, keys, sizes), keys)
    return _rendered(docs.where("pages is not null"), "page", units, own.unionByName(shown), texts, None)


def sectioned(docs: DataFrame) -> DataFrame:
    """Exports of documents with blocks: sections in order, then headers, footers and notes; tables within cells in place."""
    own = docs.where("pages is null and blocks is not null")
    item, runs = _item()
    fields = [item.alias("item"), runs.alias("runs"), F.when(F.col("b.type") == "table", F.coalesce("b.table_id", F.lit(NONE))).alias("table_key")]
    order = F.struct(F.coalesce("b.order", F.lit(0)), "i").alias("ord")
    units = own.select("path", F.explode_outer("blocks").alias("b")).select("path", F.when(F.col("b").isNotNull(), F.coalesce("b.section", F.lit(0)) + 1).alias("number"))
    body = own.select("path", F.posexplode("blocks").alias("i", "b")).select("path", (F.coalesce("b.section", F.lit(0)) + 1).alias("number"), order, *fields)
    areas = [own.select("path", F.lit(a).alias("area"), F.posexplode(f"ancillary.{a}").alias("n", "s")).select("path", "area", F.format_string("%06d", "n").alias("part"), F.posexplode("s.blocks").alias("i", "b")) for a in content.SUPPLEMENTARY]
    more = areas[0].unionByName(areas[1]).unionByName(areas[2]).unionByName(areas[3]).select("path", "area", "part", order, *fields)
    tables = own.select("path", F.explode("tables").alias("t")).withColumn("table_id", F.col("t.id"))
    keys = ["path", "table_id"]
    roots = body.select("path", F.col("table_key").alias("table_id")).unionByName(more.select("path", F.col("table_key").alias("table_id"))).where("table_id is not null").distinct()
    cells, sizes = _cells(tables, keys), _sizes(tables, keys)
    texts = content.nested_render(cells, sizes, roots, ["path"], "html").join(content.nested_render(cells, sizes, roots, ["path"], "json"), keys)
    return _rendered(own, "section", units, body, texts.withColumnRenamed("table_id", "table_key"), more)


def export(spark: SparkSession, where: str) -> int:
    """Write the three forms beside every document.json; the number of documents. None at all is an error."""
    docs = files.result_documents(spark, where, DOCUMENT)
    if docs.select("path").isEmpty():
        raise FileNotFoundError(f"no document.json found under {where}")
    if other := docs.where("pages is null and blocks is null").select("path").first():
        raise ValueError(f"unsupported document: expected pages or blocks in {other['path']}")
    made = paged(docs).unionByName(sectioned(docs)).withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))
    return files.write_documents(made, "", "folder", {"content.json": "json", "content.html": "html", "content.md": "markdown"})


def main(arguments: list[str]) -> int:
    if len(arguments) != 1:
        print("usage: python -m quire.export FOLDER", file=sys.stderr)
        return 2
    spark = session("quire-export")
    ship(spark)
    print(f"exported {export(spark, arguments[0])} documents")
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
