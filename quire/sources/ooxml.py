"""Word-processor packages: one pass over the zip gives raw rows; meaning is added by DataFrame operators.

The reader walks the parts and says what is there: paragraphs with their properties, table cells with their
raw spans and merge marks, styles, numbering, metadata. Headings, lists, sections, merged cells and quality are
then joins and windows, so they run in parallel over all documents.
"""

from __future__ import annotations

import io
import json
import posixpath
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass, field
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import switched_on, to_int
from quire.operators import flow, grid

MOST_ENTRIES, MOST_BYTES = 10_000, 2 << 30
# fixed names
W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
M = "{http://schemas.openxmlformats.org/officeDocument/2006/math}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"
MAIN = "word/document.xml"
SIDE_PARTS = {"headers": "word/header", "footers": "word/footer", "footnotes": "word/footnotes.xml", "endnotes": "word/endnotes.xml"}
WRAPPERS = ("customXml", "smartTag", "footnote", "endnote")
CELL_LIMIT = 1000


class PackageError(ValueError):
    pass


def _attr(node, name: str, space: str = W) -> str | None:
    return None if node is None else node.get(space + name)


def _int(text: str | None, default: int) -> int:
    try:
        return int(text) if text is not None else default
    except ValueError:
        return default


def inline_text(node) -> str:
    out = []
    for n in node.iter():
        if n.tag in (W + "t", M + "t"):
            out.append(n.text or "")
        elif n.tag == W + "tab":
            out.append("\t")
        elif n.tag in (W + "br", W + "cr"):
            out.append("\n")
        elif n.tag == W + "noBreakHyphen":
            out.append("‑")
    return "".join(out)


@dataclass
class Package:
    archive: zipfile.ZipFile
    rows: list[tuple[str, dict]] = field(default_factory=list)
    tables: int = 0
    blocks: int = 0
    bytes: int = 0

    def xml(self, name: str, required: bool = False):
        try:
            with self.archive.open(name) as part:  # what is said of the size need not be so
                raw = part.read(MOST_BYTES - self.bytes + 1)
        except KeyError:
            if required:
                raise PackageError(f"package lacks {name}") from None
            return None
        self.bytes += len(raw)
        if self.bytes > MOST_BYTES:
            raise PackageError("uncompressed size is excessive")
        if b"<!DOCTYPE" in raw:
            raise PackageError(f"{name} declares a document type")
        try:
            return ElementTree.fromstring(raw)
        except ElementTree.ParseError as problem:
            raise PackageError(f"{name}: {problem}") from None

    def add(self, kind: str, **values) -> None:
        self.rows.append((kind, values))

    def links(self, part: str) -> dict[str, str]:
        """Relationship targets of a part; what points out of the package is logged and left out."""
        folder, name = posixpath.split(part)
        root, found = self.xml(f"{folder}/_rels/{name}.rels"), {}
        for rel in root.findall(REL + "Relationship") if root is not None else ():
            key, target = rel.get("Id"), rel.get("Target")
            if not key or not target:
                continue
            if rel.get("TargetMode") != "External":
                inside = posixpath.normpath(posixpath.join(folder, target))
                if inside.startswith(("../", "/")):
                    self.add("unresolved", type="unsafe_relationship", part=part, target=target)
                    continue
                target = inside
            found[key] = target
        return found

    def children(self, container) -> Iterator:
        for child in container:
            if child.tag in (W + "p", W + "tbl"):
                yield child
            elif child.tag == W + "sdt":
                inner = child.find(W + "sdtContent")
                if inner is not None:
                    yield from self.children(inner)
            elif child.tag in tuple(W + x for x in WRAPPERS):
                yield from self.children(child)

    def paragraph(self, p, part: str, links: dict[str, str]) -> dict:
        props = p.find(W + "pPr")
        find = lambda path: None if props is None else props.find("/".join(W + x for x in path.split("/")))
        runs = []
        for node in p:
            target = links.get(node.get(R + "id")) if node.tag == W + "hyperlink" else None
            for run in [node] if node.tag == W + "r" else node.findall(W + "r") if node.tag == W + "hyperlink" else ():
                text = inline_text(run)
                if text:
                    rp = run.find(W + "rPr")
                    mark = lambda x: None if rp is None or rp.find(W + x) is None else (_attr(rp.find(W + x), "val") or "")  # noqa: B023, E731
                    runs.append({"text": text, "bold": mark("b"), "italic": mark("i"), "underline": mark("u"), "vertical_align": mark("vertAlign"), "hyperlink": target})
        breaks = sum(_attr(b, "type") == "page" for b in p.iter(W + "br"))
        before = find("pageBreakBefore")
        if before is not None and (_attr(before, "val") or "").lower() not in ("0", "false", "off", "none"):
            breaks += 1
        return {
            "text": inline_text(p).strip(), "style_id": _attr(find("pStyle"), "val"), "outline": _attr(find("outlineLvl"), "val"), "num_id": _attr(find("numPr/numId"), "val"), "ilvl": _attr(find("numPr/ilvl"), "val"),
            "runs": runs, "page_breaks": breaks, "ends_section": find("sectPr") is not None,
        }

    def table(self, node, part: str, parent: str | None) -> str:
        self.tables += 1
        name = f"table-{self.tables:04d}"
        rows = node.findall(W + "tr")
        columns = len(node.findall(f"{W}tblGrid/{W}gridCol"))
        pending = []
        for r, tr in enumerate(rows):
            head = tr.find(f"{W}trPr/{W}tblHeader")
            before, after = (_int(_attr(tr.find(f"{W}trPr/{W}{x}"), "val"), 0) for x in ("gridBefore", "gridAfter"))
            width = before + after
            for c, tc in enumerate(tr.findall(W + "tc")):
                span = max(1, min(CELL_LIMIT, _int(_attr(tc.find(f"{W}tcPr/{W}gridSpan"), "val"), 1)))
                width += span
                merges = {k: "none" if (m := tc.find(f"{W}tcPr/{W}{x}")) is None else (_attr(m, "val") or "continue") for k, x in (("vmerge", "vMerge"), ("hmerge", "hMerge"))}
                text = [t for t in (inline_text(p).strip() for p in tc.findall(W + "p")) if t]
                nested = [self.table(t, part, name) for t in tc.findall(W + "tbl")]
                text += [" ".join(f"[嵌套表格 {n}]" for n in nested)] if nested else []
                pending.append({"table_id": name, "row": r, "cell": c, "before": before, "colspan": span, **merges, "text": "\n".join(text), "header": head is not None and (_attr(head, "val") or "").lower() not in ("0", "false", "off", "none"), "nested": nested})
            columns = max(columns, width)
        self.add("table", table_id=name, parent=parent, part=part, nrows=len(rows), ncols=columns, xml=ElementTree.tostring(node, encoding="unicode"))
        for cell in pending:
            self.add("cell", **cell)
        return name

    def container(self, node, part: str, area: str) -> None:
        links = self.links(part)
        for child in self.children(node):
            self.blocks += 1
            if child.tag == W + "p":
                self.add("block", ord=self.blocks, part=part, area=area, table_id=None, **self.paragraph(child, part, links))
            else:
                self.add("block", ord=self.blocks, part=part, area=area, table_id=self.table(child, part, None), text="", page_breaks=0, ends_section=False)

    def read(self) -> None:
        entries = self.archive.infolist()
        size = sum(e.file_size for e in entries)
        if len(entries) > MOST_ENTRIES:
            raise PackageError(f"too many entries: {len(entries)}")
        if size > MOST_BYTES:
            raise PackageError(f"uncompressed size is excessive: {size}")
        root = self.xml(MAIN, required=True)
        body = root.find(W + "body")
        if body is None:
            raise PackageError("document has no body")
        styles, numbering, core = (self.xml(x) for x in ("word/styles.xml", "word/numbering.xml", "docProps/core.xml"))
        for s in styles.findall(W + "style") if styles is not None else ():
            name = s.find(W + "name")
            self.add("style", style_id=_attr(s, "styleId"), name=_attr(s, "styleId") if name is None else _attr(name, "val"), based_on=_attr(s.find(W + "basedOn"), "val"), outline=_int(_attr(s.find(f"{W}pPr/{W}outlineLvl"), "val"), -1))
        for a in numbering.findall(W + "abstractNum") if numbering is not None else ():
            for lvl in a.findall(W + "lvl"):
                self.add("level", abstract_id=_attr(a, "abstractNumId"), level=_int(_attr(lvl, "ilvl"), 0), format=_attr(lvl.find(W + "numFmt"), "val"), text=_attr(lvl.find(W + "lvlText"), "val"))
        for n in numbering.findall(W + "num") if numbering is not None else ():
            self.add("num", num_id=_attr(n, "numId"), abstract_id=_attr(n.find(W + "abstractNumId"), "val"))
        for item in core if core is not None else ():
            if item.text:
                self.add("metadata", name=item.tag.rpartition("}")[2], value=item.text)
        self.container(body, MAIN, "body")
        for area, prefix in SIDE_PARTS.items():
            for part in sorted(n for n in self.archive.namelist() if n.startswith(prefix) and n.endswith(".xml")):
                self.container(self.xml(part), part, area)
        count = lambda *tags: sum(1 for t in tags for _ in root.iter(t))
        drawings, boxes = count(W + "drawing", W + "pict"), count(W + "txbxContent")
        if drawings:
            self.add("unresolved", type="images_skipped", count=drawings)
        if boxes:
            self.add("unresolved", type="floating_text_order", count=boxes)
        self.add("package", entries=len(entries), uncompressed=size, drawings=drawings, equations=count(M + "oMath", M + "oMathPara"), distinct_equations=count(M + "oMath"), textboxes=boxes, inserted=count(W + "ins"), deleted=count(W + "del"))


def read_package(content: bytes) -> list[tuple[str, dict]]:
    """(kind, values) rows of one package; PackageError if it is none, or an unsafe one."""
    if not zipfile.is_zipfile(io.BytesIO(content)):
        raise PackageError("not a zip package")
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        package = Package(archive)
        package.read()
        return package.rows


RUNS = "array<struct<text:string,bold:string,italic:string,underline:string,vertical_align:string,hyperlink:string>>"
SCHEMAS = {
    "block": f"ord int, part string, area string, table_id string, text string, style_id string, outline string, num_id string, ilvl string, runs {RUNS}, page_breaks int, ends_section boolean",
    "table": "table_id string, parent string, part string, nrows int, ncols int, xml string",
    "cell": "table_id string, row int, cell int, before int, colspan int, vmerge string, hmerge string, text string, header boolean, nested array<string>",
    "style": "style_id string, name string, based_on string, outline int",
    "num": "num_id string, abstract_id string",
    "level": "abstract_id string, level int, format string, text string",
    "metadata": "name string, value string",
    "unresolved": "type string, part string, target string, count int",
    "package": "entries int, uncompressed bigint, drawings int, equations int, distinct_equations int, textboxes int, inserted int, deleted int",
    "error": "message string",
}


def raw_rows(files: DataFrame, key: str = "path", content: str = "content") -> DataFrame:
    """key, kind, payload. A package that cannot be read gives one row of kind error. Write this before use: all
    entities are read from it."""
    own = files.select(F.col(key).cast("string").alias("key"), F.col(content).alias("content"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, raw in zip(frame["key"], frame["content"], strict=True):
                try:
                    rows = read_package(raw or b"")
                except Exception as problem:  # noqa: BLE001  encrypted, damaged or too deeply nested: one document must not end the job
                    rows = [("error", {"message": str(problem) or type(problem).__name__})]
                yield pd.DataFrame([(name, kind, json.dumps(v, ensure_ascii=False)) for kind, v in rows], columns=["key", "kind", "payload"])

    return own.mapInPandas(run, "key string, kind string, payload string")


def entity(raw: DataFrame, kind: str) -> DataFrame:
    return raw.where(F.col("kind") == kind).select("key", F.from_json("payload", SCHEMAS[kind]).alias("v")).select("key", "v.*")


def cells(raw: DataFrame) -> DataFrame:
    """key, table_id, row, col, rowspan, colspan, text, header, orphan, nested (ids of the tables in the cell that a merged
    one begins with): merged, without fillers."""
    own = entity(raw, "cell")
    keys = ["key", "table_id"]
    wide = flow.hmerge(own, keys).join(own.select(*keys, "row", "cell", "before", "nested"), [*keys, "row", "cell"])
    placed = grid.running_columns(wide, keys, "before")
    heads = own.groupBy(*keys, "row").agg(F.bool_or("header").alias("header"))
    links = placed.select(*keys, "row", "col", "nested").where(F.size("nested") > 0)
    return flow.vmerge_spans(placed, keys).join(heads, [*keys, "row"]).join(links, [*keys, "row", "col"], "left")


def tables(raw: DataFrame) -> DataFrame:
    """key, table_id, parent, part, nrows, ncols, xml (as in the package), passed, issues, nonempty_num, nonempty_den."""
    own = entity(raw, "table")
    keys = ["key", "table_id"]
    quality = flow.word_table_quality(cells(raw), own.select(*keys, "nrows", "ncols"), keys)
    joined = flow.hmerge(entity(raw, "cell"), keys).groupBy(*keys).agg((F.sum("merged_cells") > 0).alias("joined"))
    noted = F.when(F.col("joined"), F.array_sort(F.array_append("issues", "legacy_hmerge_normalized"))).otherwise(F.col("issues"))
    return own.join(quality, keys).join(joined, keys, "left").withColumn("issues", noted).drop("joined")


def fillers(raw: DataFrame) -> DataFrame:
    """key, table_id, r, c of grid positions that no cell covers."""
    return grid.grid_fill(cells(raw), ["key", "table_id"], entity(raw, "table").select("key", "table_id", "nrows", "ncols"))


def blocks(raw: DataFrame) -> DataFrame:
    """key, area, part, ord, section, type, heading_level, text, runs, list level and format, table_id, page_breaks.

    Empty paragraphs without a page break are left out; they count in ord and end sections all the same.
    """
    own = entity(raw, "block")
    styles = flow.style_resolve(entity(raw, "style"), ["key"]).select("key", "style_id", F.col("name").alias("style_name"), F.col("outline").alias("style_outline"))
    numbers = entity(raw, "num").join(entity(raw, "level").withColumnRenamed("text", "template"), ["key", "abstract_id"]).select("key", "num_id", F.col("level").alias("list_level"), F.col("format").alias("list_format"), "template")
    by = Window.partitionBy("key", "part").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    ends = F.when(F.col("area") == "body", F.coalesce(F.sum(F.col("ends_section").cast("int")).over(by), F.lit(0))).otherwise(0)
    full = own.withColumn("section", ends.cast("int")).withColumn("list_level", to_int(F.col("ilvl"), 0))
    full = full.join(styles, ["key", "style_id"], "left").join(numbers, ["key", "num_id", "list_level"], "left")
    outline = F.coalesce(F.col("outline").try_cast("int"), F.col("style_outline"), F.lit(-1))
    level = flow.heading_level(outline, F.col("style_name"))
    kind = F.when(F.col("table_id").isNotNull(), "table").otherwise(flow.block_type(level, F.col("num_id").isNotNull()))
    on = lambda r, n: switched_on(r[n].isNotNull(), r[n])
    runs = F.transform("runs", lambda r: F.struct(r.text.alias("text"), on(r, "bold").alias("bold"), on(r, "italic").alias("italic"), on(r, "underline").alias("underline"), r.vertical_align.alias("vertical_align"), r.hyperlink.alias("hyperlink")))
    kept = full.where((F.col("text") != "") | (F.col("page_breaks") > 0) | F.col("table_id").isNotNull())
    return kept.select("key", "area", "part", "ord", "section", kind.alias("type"), level.alias("heading_level"), "text", runs.alias("runs"), F.when(F.col("num_id").isNotNull(), F.col("list_level")).alias("list_level"), "list_format", "template", "table_id", "page_breaks")


def status(raw: DataFrame) -> DataFrame:
    """key, status (ok, partial or failed), tables, failed_tables, native_characters, image_only."""
    found = tables(raw).groupBy("key").agg(F.count(F.lit(1)).alias("tables"), F.sum((~F.col("passed")).cast("long")).alias("failed_tables"))
    text = blocks(raw).where("area = 'body'").groupBy("key").agg(F.array_join(F.collect_list("text"), "\n").alias("text"))
    every = raw.select("key").distinct().join(found, "key", "left").join(text, "key", "left").join(entity(raw, "package").select("key", "drawings"), "key", "left").join(entity(raw, "error"), "key", "left")
    n = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), "\\s", ""))
    state = F.when(F.col("message").isNotNull(), "failed").when(F.coalesce("failed_tables", F.lit(0)) > 0, "partial").otherwise("ok")
    return every.select("key", state.alias("status"), F.coalesce("tables", F.lit(0)).alias("tables"), F.coalesce("failed_tables", F.lit(0)).alias("failed_tables"), n.alias("native_characters"), F.coalesce(flow.image_only(F.col("text"), F.col("drawings")), F.lit(False)).alias("image_only"))


def stored_documents(raw: DataFrame) -> DataFrame:
    """key, status, json: one result a package, as the export command reads it. Packages that cannot be read have no json."""
    block = F.struct("type", "text", F.col("ord").alias("order"), "section", "heading_level", "table_id", F.struct(F.col("list_level").alias("level"), F.col("list_format").alias("format")).alias("list"), "runs").alias("block")
    placed = blocks(raw).select("key", "area", "part", "ord", block)
    listed = placed.groupBy("key", "area", "part").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "block"))), lambda x: x.block).alias("blocks"))
    parts = lambda area: F.transform(F.array_sort(F.collect_list(F.when(F.col("area") == area, F.struct("part", "blocks")))), lambda x: F.struct(x.blocks.alias("blocks"))).alias(area)
    flows = listed.groupBy("key").agg(F.first(F.when(F.col("area") == "body", F.col("blocks")), ignorenulls=True).alias("blocks"), *[parts(a) for a in SIDE_PARTS])
    filled = cells(raw).groupBy("key", "table_id").agg(F.array_sort(F.collect_list(F.struct("row", "col", "rowspan", "colspan", "text", "header", F.col("nested").alias("nested_tables")))).alias("cells"))
    table = F.struct(F.col("table_id").alias("id"), F.col("parent").alias("parent_table"), "nrows", "ncols", F.struct("passed", "issues").alias("quality"), "cells")
    found = tables(raw).join(filled, ["key", "table_id"], "left").groupBy("key").agg(F.array_sort(F.collect_list(table)).alias("tables"))
    named = entity(raw, "metadata").groupBy("key").agg(F.map_from_entries(F.collect_set(F.struct("name", "value"))).alias("metadata"))
    every = status(raw).select("key", "status").join(flows, "key", "left").join(found, "key", "left").join(named, "key", "left")
    none = lambda name, like: F.coalesce(F.col(name), F.array().cast(like)).alias(name)
    whole = F.struct(
        F.lit("1.0").alias("schema_version"), F.lit("docx").alias("source_format"), "status", "metadata",
        none("blocks", flows.schema["blocks"].dataType), none("tables", found.schema["tables"].dataType), F.struct(*SIDE_PARTS).alias("ancillary"),
    )
    return every.select("key", "status", F.when(F.col("status") != "failed", F.to_json(whole)).alias("json"))
