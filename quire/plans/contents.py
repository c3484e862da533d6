"""Queries over content documents and their rendered forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.operators import content, flow
from quire.operators.layout import in_order
from quire.plans.registry import query
from quire.sources import carriers as c

ESC = "replace(replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"


@query(f"SELECT page_id, {ESC.format('html')} AS escaped FROM pages")
def html_escape(spark, sf_dir):
    return c.table(spark, sf_dir, "pages").select("page_id", tx.html_escape(F.col("html")).alias("escaped"))


def _md(x: str) -> str:
    """The escape for texts in which no line begins with two marks; the blank is consumed instead of looked at."""
    x = f"replace({x}, '\\', '\\\\')"
    x = f"regexp_replace({x}, '([`*_\\[\\]<>|~])', '\\\\\\1', 'g')"
    x = f"regexp_replace({x}, '(?m)^(\\s*)([#>+-])(\\s)', '\\1\\\\\\2\\3', 'g')"
    x = f"regexp_replace({x}, '(?m)^(\\s*)(\\d+)([.)])(\\s)', '\\1\\2\\\\\\3\\4', 'g')"
    return f"regexp_replace({x}, '(?m)^(\\s*)(---+)(\\s*)$', '\\1\\\\\\2\\3', 'g')"


@query(f"SELECT doc_id, {_md('text')} AS escaped FROM documents WHERE text IS NOT NULL")
def markdown_escape(spark, sf_dir):
    return c.table(spark, sf_dir, "documents").where("text is not null").select("doc_id", tx.markdown_escape(F.col("text")).alias("escaped"))


@query("SELECT doc_id, coalesce(text, '') AS cleaned FROM documents")
def clean_markers(spark, sf_dir):
    """Markers are put in and cleaned away again."""
    marked = F.concat(F.substring("text", 1, 20), F.lit("\n[嵌套表格 table-0001 x]"), F.substring(F.col("text"), F.lit(21), F.length("text")))
    return c.table(spark, sf_dir, "documents").select("doc_id", tx.clean_markers(F.coalesce(marked, F.lit(""))).alias("cleaned"))


@query("SELECT doc_id, source || '-' || substr(sha256(coalesce(text, '')), 1, 8) AS name FROM documents")
def doc_identity(spark, sf_dir):
    return c.table(spark, sf_dir, "documents").select("doc_id", tx.document_name(F.col("source"), F.coalesce("text", F.lit("")).cast("binary")).alias("name"))


ITEMS = f"""{c.FLOW}, items AS (SELECT conv_id, ord, section, kind AS type, text, CASE kind WHEN 'heading' THEN greatest(1, least(6, CASE WHEN turn = 0 THEN 1 ELSE turn END)) WHEN 'list_item' THEN greatest(0, turn - 2) END AS level,
  CASE WHEN kind = 'list_item' THEN CASE WHEN turn % 3 = 0 THEN 'decimal' WHEN turn % 3 = 1 THEN 'none' ELSE 'bullet' END END AS format, turn FROM v_sections)"""


def _items(spark, sf_dir):
    own = flow.section_index(c.flow(spark, sf_dir), ["conv_id"], "turn", "is_heading")
    turn = F.col("turn").cast("int")
    form = F.when(turn % 3 == 0, "decimal").when(turn % 3 == 1, "none")
    return own.withColumn("item", content.item(F.col("kind"), F.col("text"), turn, turn - 2, form))


@query(f"WITH {ITEMS} SELECT conv_id, ord, type, CAST(coalesce(level, -1) AS INT) AS level, coalesce(format, '') AS format, text FROM items")
def content_items(spark, sf_dir):
    return _items(spark, sf_dir).select("conv_id", "ord", "item.type", F.coalesce("item.level", F.lit(-1)).alias("level"), F.coalesce("item.format", F.lit("")).alias("format"), "item.text")


# two runs a block: its first 10 characters and the rest; formats by the turn; some spell the text wrongly
def _runs(spark, sf_dir):
    own = _items(spark, sf_dir)
    turn, text = F.col("turn"), F.col("text")
    run = lambda t, on: F.struct(t.alias("text"), (on & (turn % 2 == 0)).alias("bold"), (on & (turn % 3 == 0)).alias("italic"), F.lit(False).alias("underline"), F.when(on & (turn % 5 == 1), "superscript").alias("vertical_align"), F.when(on & (turn == 1), "http://x/?a=1&b=2").alias("hyperlink"))
    first, rest = F.substring(text, 1, 10), F.substring(text, F.lit(11), F.length(text))
    runs = F.array(run(first, F.lit(True)), run(F.when(turn % 4 == 3, F.concat(rest, F.lit(" "))).otherwise(rest), F.lit(False)))
    return own.withColumn("runs", content.content_runs(text, runs))


RUNS = f"""{ITEMS}, runs AS (SELECT *, substr(text, 1, 10) AS a, substr(text, 11) AS b, turn % 4 <> 3 AND (turn % 2 = 0 OR turn % 3 = 0 OR turn % 5 = 1 OR turn = 1) AS kept FROM items)"""


@query(f"WITH {RUNS} SELECT conv_id, ord, kept, CASE WHEN kept THEN 2 ELSE 0 END AS n_runs, CASE WHEN kept THEN a ELSE '' END AS first_run FROM runs")
def content_runs(spark, sf_dir):
    out = _runs(spark, sf_dir)
    return out.select("conv_id", "ord", F.col("runs").isNotNull().alias("kept"), F.when(F.col("runs").isNull(), 0).otherwise(F.size("runs")).alias("n_runs"), F.coalesce(F.get("runs", F.lit(0))["text"], F.lit("")).alias("first_run"))


def _inline(form: str) -> str:
    text = (lambda x: f"replace({ESC.format(x)}, chr(10), '<br>' || chr(10))") if form == "html" else _md
    em, strong = (("<em>", "</em>"), ("<strong>", "</strong>")) if form == "html" else (("*", "*"), ("**", "**"))
    a = f"CASE WHEN turn % 5 = 1 THEN '<sup>' || {text('a')} || '</sup>' ELSE {text('a')} END"
    a = f"CASE WHEN turn % 3 = 0 THEN '{em[0]}' ELSE '' END || {a} || CASE WHEN turn % 3 = 0 THEN '{em[1]}' ELSE '' END"
    a = f"CASE WHEN turn % 2 = 0 THEN '{strong[0]}' ELSE '' END || {a} || CASE WHEN turn % 2 = 0 THEN '{strong[1]}' ELSE '' END"
    link = ("<a href=\"http://x/?a=1&amp;b=2\">", "</a>") if form == "html" else ("[", "](<http://x/?a=1&b=2>)")
    a = f"CASE WHEN turn = 1 THEN '{link[0]}' ELSE '' END || {a} || CASE WHEN turn = 1 THEN '{link[1]}' ELSE '' END"
    return f"CASE WHEN kept THEN {a} || {text('b')} ELSE {text('text')} END"


@query(f"WITH {RUNS} SELECT conv_id, ord, {_inline('html')} AS html, {_inline('markdown')} AS markdown FROM runs")
def render_inline(spark, sf_dir):
    out = _runs(spark, sf_dir)
    return out.select("conv_id", "ord", content.inline_html(F.col("text"), F.col("runs")).alias("html"), content.inline_markdown(F.col("text"), F.col("runs")).alias("markdown"))


# every fourth turn shows a table; a third of these tables do not exist, and their blocks are left out
SHOWN = f"""{c.FLOW}, v_blocks AS (SELECT *, CASE WHEN turn % 4 = 3 THEN conv_id * 10 + turn END AS table_id FROM v_sections),
v_shown AS (SELECT conv_id, section, ord, CASE WHEN table_id IS NULL THEN kind ELSE 'table' END AS kind FROM v_blocks WHERE table_id IS NULL OR table_id % 3 > 0)"""


@query(f"WITH {SHOWN} SELECT conv_id, section + 1 AS number, count(*) AS n_items, string_agg(kind, ',' ORDER BY ord) AS kinds FROM v_shown GROUP BY ALL")
def section_content(spark, sf_dir):
    own = flow.section_index(c.flow(spark, sf_dir), ["conv_id"], "turn", "is_heading")
    own = own.withColumn("table_id", F.when(F.col("turn") % 4 == 3, F.col("conv_id") * 10 + F.col("turn")))
    tables = own.where("table_id % 3 > 0").select("conv_id", "table_id")
    shown = content.with_tables(own, tables, ["conv_id"]).withColumn("kind", F.when(F.col("table_id").isNull(), F.col("kind")).otherwise("table"))
    return shown.groupBy("conv_id", (F.col("section") + 1).alias("number")).agg(F.count(F.lit(1)).alias("n_items"), in_order(["ord"], "kind", ",").alias("kinds"))


HTML_TEXT = f"replace({ESC.format('text')}, chr(10), '<br>' || chr(10))"
HTML_ITEM = f"""CASE type WHEN 'heading' THEN '<h' || level || '>' || {HTML_TEXT} || '</h' || level || '>' WHEN 'list_item' THEN '<div class="list-item" data-level="' || level || '" style="--level:' || level || '">' || {HTML_TEXT} || '</div>' ELSE '<p>' || {HTML_TEXT} || '</p>' END"""
MD_ITEM = f"CASE type WHEN 'heading' THEN repeat('#', CAST(level AS INT)) || ' ' || {_md('text')} WHEN 'list_item' THEN repeat('  ', CAST(level AS INT)) || CASE WHEN format IN ('bullet', 'none') THEN '- ' ELSE '1. ' END || {_md('text')} ELSE {_md('text')} END"


@query(f"""WITH {ITEMS}, units AS (SELECT conv_id, section, '<section data-section="' || (section + 1) || '">' || chr(10) || string_agg({HTML_ITEM}, chr(10) ORDER BY ord) || chr(10) || '</section>' AS t FROM items GROUP BY conv_id, section)
SELECT conv_id, string_agg(t, chr(10) ORDER BY section) AS text FROM units GROUP BY conv_id""")
def render_html(spark, sf_dir):
    own = _items(spark, sf_dir).withColumn("number", F.col("section") + 1)
    return content.render_units(own, ["conv_id"], "section", "html")


@query(f"""WITH {ITEMS}, units AS (SELECT conv_id, section, '<!-- section: ' || (section + 1) || ' -->' || CASE WHEN string_agg({MD_ITEM}, '') <> '' OR count(*) > 1 THEN chr(10) || chr(10) || string_agg({MD_ITEM}, chr(10) || chr(10) ORDER BY ord) ELSE '' END AS t FROM items GROUP BY conv_id, section)
SELECT conv_id, regexp_replace(string_agg(t, chr(10) || chr(10) ORDER BY section), '\\s+$', '') || chr(10) AS text FROM units GROUP BY conv_id""")
def render_markdown(spark, sf_dir):
    own = _items(spark, sf_dir).withColumn("number", F.col("section") + 1)
    return content.render_units(own, ["conv_id"], "section", "markdown")


AREA = "CASE turn WHEN 4 THEN 'footnotes' WHEN 5 THEN 'footers' WHEN 6 THEN 'headers' WHEN 7 THEN 'endnotes' END"
PLACE = "CASE turn WHEN 4 THEN 2 WHEN 5 THEN 1 WHEN 6 THEN 0 WHEN 7 THEN 3 ELSE -1 END"
KIND = "CASE turn WHEN 4 THEN 'footnotes' WHEN 5 THEN 'footer' WHEN 6 THEN 'header' WHEN 7 THEN 'endnotes' END"


def _parts(spark, sf_dir):
    """Items of the body and of supplementary parts: the turns from 4 on."""
    own = _items(spark, sf_dir).withColumn("number", F.col("section") + 1)
    area = F.when(F.col("turn") == 4, "footnotes").when(F.col("turn") == 5, "footers").when(F.col("turn") == 6, "headers").when(F.col("turn") == 7, "endnotes")
    own = own.withColumn("area", area).withColumn("part", F.col("turn").cast("string"))
    return own.where("area is null"), own.where("area is not null")


@query(f"""WITH {ITEMS}, units AS (SELECT conv_id, -1 AS place, section, '<section data-section="' || (section + 1) || '">' || chr(10) || string_agg({HTML_ITEM}, chr(10) ORDER BY ord) || chr(10) || '</section>' AS t FROM items WHERE turn < 4 GROUP BY conv_id, section
  UNION ALL SELECT conv_id, {PLACE}, 0, '<aside data-content-kind="' || {KIND} || '">' || chr(10) || string_agg({HTML_ITEM}, chr(10) ORDER BY ord) || chr(10) || '</aside>' FROM items WHERE turn >= 4 GROUP BY conv_id, turn)
SELECT conv_id, string_agg(t, chr(10) ORDER BY place, section) AS text FROM units GROUP BY conv_id""")
def supplementary_html(spark, sf_dir):
    body, more = _parts(spark, sf_dir)
    return content.render_units(body, ["conv_id"], "section", "html", more)


@query("""WITH RECURSIVE shown AS (SELECT p_partkey AS root, p_partkey AS id, 0 AS depth FROM part WHERE p_partkey < 4 UNION ALL SELECT s.root, l.p_partkey, s.depth + 1 FROM shown s JOIN part l ON l.p_partkey // 4 = s.id AND l.p_partkey >= 4)
SELECT root, id, depth FROM shown""")
def nested_tables(spark, sf_dir):
    part = c.table(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("id"))
    links = part.where("id >= 4").select(F.floor(F.col("id") / 4).cast("long").alias("parent"), "id")
    return content.nested_tables(links, part.join(links, "id", "left_anti"))


# every part is a table of one row: its name, and a cell that holds the tables of up to four other parts, the last first
@query(f"""WITH RECURSIVE shown AS (SELECT p_partkey AS root, p_partkey AS id, [CAST(0 AS BIGINT)] AS path FROM part WHERE p_partkey < 4 UNION ALL SELECT s.root, l.p_partkey, list_append(s.path, -l.p_partkey) FROM shown s JOIN part l ON l.p_partkey // 4 = s.id AND l.p_partkey >= 4),
ends AS (SELECT root, path, '<table>' || chr(10) || '<tr>' || chr(10) || '<td data-row="0" data-col="0">' || {ESC.format('p_name')} || '</td>' || chr(10) || '<td data-row="0" data-col="1">' AS t FROM shown JOIN part ON p_partkey = id
  UNION ALL SELECT root, list_append(path, 1), '</td>' || chr(10) || '</tr>' || chr(10) || '</table>' FROM shown)
SELECT root AS table_id, string_agg(t, '' ORDER BY path) AS html FROM ends GROUP BY root""")
def nested_table_html(spark, sf_dir):
    part = c.table(spark, sf_dir, "part").select(F.lit(0).alias("doc"), F.col("p_partkey").cast("long").alias("table_id"), "p_name")
    links = part.where("table_id >= 4").groupBy("doc", F.floor(F.col("table_id") / 4).cast("long").alias("table_id")).agg(F.sort_array(F.collect_list("table_id"), asc=False).alias("nested"))
    one = lambda col, text, nested: F.struct(F.lit(0).alias("row"), F.lit(col).alias("col"), F.lit(1).alias("rowspan"), F.lit(1).alias("colspan"), text.alias("text"), F.lit(False).alias("header"), nested.alias("nested"))
    both = part.join(links, ["doc", "table_id"], "left").select("doc", "table_id", F.inline(F.array(one(0, F.col("p_name"), F.lit(None).cast("array<bigint>")), one(1, F.lit("[嵌套表格 x]"), F.col("nested")))))
    tables = part.select("doc", "table_id", F.lit(1).alias("nrows"), F.lit(2).alias("ncols"))
    return content.nested_render(both, tables, part.where("table_id < 4").select("doc", "table_id"), ["doc"]).select("table_id", "html")


@query("SELECT p_partkey AS table_id FROM part WHERE p_partkey NOT IN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity > 45)")
def nested_only_tables(spark, sf_dir):
    """Parts are tables; line items of large quantity are the blocks that show them."""
    tables = c.table(spark, sf_dir, "part").select(F.lit(0).alias("doc"), F.col("p_partkey").cast("long").alias("table_id"))
    blocks = c.table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.lit(0).alias("doc"), F.col("l_partkey").cast("long").alias("table_id"))
    return content.nested_only(tables, blocks, ["doc"]).select("table_id")


@query(f"""WITH {ITEMS}, units AS (SELECT conv_id, section + 1 AS number, list({{'type': type, 'text': text, 'level': CAST(level AS INT), 'format': format}} ORDER BY ord) AS content FROM items GROUP BY conv_id, section),
docs AS (SELECT conv_id, list({{'type': 'section', 'number': number, 'content': content}} ORDER BY number) AS content FROM units GROUP BY conv_id)
SELECT conv_id, CAST(to_json({{'schema_version': '1.0', 'source_format': 'docx', 'structure': 'sections', 'content': content, 'title': CASE WHEN conv_id % 3 > 0 THEN 'c' || conv_id END}}) AS VARCHAR) AS json FROM docs""")
def content_documents(spark, sf_dir):
    own = _items(spark, sf_dir).withColumn("number", F.col("section") + 1)
    title = F.when(F.col("conv_id") % 3 > 0, F.concat(F.lit(" c"), F.col("conv_id").cast("string")))
    return content.content_documents(own, ["conv_id"], "section", "docx", title)
