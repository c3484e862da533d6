"""Queries over flow documents and their tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import flow, grid
from quire.plans.registry import query
from quire.sources import carriers as c

# styles form chains over parts: each is based on a fifth of its number; every 7th has an outline, some have no name
STYLES = """styles AS (SELECT p_partkey AS style_id, CASE WHEN p_partkey % 3 <> 0 THEN CASE WHEN p_partkey % 4 = 0 THEN 'Heading ' || p_partkey % 12 WHEN p_partkey % 4 = 1 THEN '标题' || p_partkey % 5 ELSE p_brand END END AS name,
  CASE WHEN p_partkey % 10 = 9 THEN p_partkey WHEN p_partkey >= 5 THEN p_partkey // 5 END AS based_on, CASE WHEN p_partkey % 7 = 0 THEN CAST(p_partkey % 11 AS INT) ELSE -1 END AS outline FROM part)"""
RESOLVED = f"""{STYLES}, chain AS (SELECT style_id AS root, style_id, name, outline, based_on, 0 AS depth, [style_id] AS seen FROM styles
  UNION ALL SELECT c.root, s.style_id, s.name, s.outline, s.based_on, c.depth + 1, list_append(c.seen, s.style_id) FROM chain c JOIN styles s ON s.style_id = c.based_on WHERE c.outline < 0 AND NOT list_contains(c.seen, s.style_id)),
resolved AS (SELECT root AS style_id, arg_min(name, depth) FILTER (WHERE name IS NOT NULL) AS name, coalesce(arg_min(outline, depth) FILTER (WHERE outline >= 0), -1) AS outline FROM chain GROUP BY root)"""


def _styles(spark, sf_dir):
    k = F.col("p_partkey")
    name = F.when(k % 4 == 0, F.concat(F.lit("Heading "), (k % 12).cast("string"))).when(k % 4 == 1, F.concat(F.lit("标题"), (k % 5).cast("string"))).otherwise(F.col("p_brand"))
    based = F.when(k % 10 == 9, k).when(k >= 5, F.floor(k / 5).cast("long"))
    return c.table(spark, sf_dir, "part").select(k.cast("long").alias("style_id"), F.when(k % 3 != 0, name).alias("name"), based.cast("long").alias("based_on"), F.when(k % 7 == 0, (k % 11).cast("int")).otherwise(-1).alias("outline"))


@query(f"WITH RECURSIVE {RESOLVED} SELECT style_id, coalesce(name, '') AS name, outline FROM resolved")
def style_resolve(spark, sf_dir):
    return flow.style_resolve(_styles(spark, sf_dir)).withColumn("name", F.coalesce("name", F.lit("")))


LEVEL = "CASE WHEN outline BETWEEN 0 AND 8 THEN outline + 1 WHEN regexp_extract(plain, '^(heading|标题)([0-9]+)$', 2) <> '' THEN least(9, CAST(regexp_extract(plain, '^(heading|标题)([0-9]+)$', 2) AS INT)) END"


@query(f"WITH RECURSIVE {RESOLVED} SELECT style_id, coalesce({LEVEL}, -1) AS level FROM (SELECT *, replace(lower(coalesce(name, '')), ' ', '') AS plain FROM resolved)")
def heading_level(spark, sf_dir):
    own = flow.style_resolve(_styles(spark, sf_dir))
    level = flow.heading_level(F.col("outline"), F.coalesce("name", F.lit("")))
    return own.select("style_id", F.coalesce(level, F.lit(-1)).alias("level"))


@query("""WITH p AS (SELECT p_partkey AS id, p_size % 6 AS num_id, CASE WHEN p_partkey % 5 = 0 THEN 'x' ELSE CAST(p_partkey % 4 AS VARCHAR) END AS ilvl FROM part), n(num_id, abstract_id) AS (VALUES (1, 10), (2, 10), (3, 20), (4, 99)),
l(abstract_id, level, format, text) AS (VALUES (10, 0, 'decimal', '%1.'), (10, 1, 'bullet', '•'), (10, 2, 'lowerLetter', '%3)'), (20, 0, 'bullet', '-'), (20, 1, NULL, NULL))
SELECT id, CAST(p.num_id AS BIGINT) AS num_id, coalesce(TRY_CAST(ilvl AS INT), 0) AS level, coalesce(format, '') AS format, coalesce(text, '') AS template FROM p LEFT JOIN n ON n.num_id = p.num_id LEFT JOIN l ON l.abstract_id = n.abstract_id AND l.level = coalesce(TRY_CAST(ilvl AS INT), 0)""")
def list_numbering(spark, sf_dir):
    p = c.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") % 6).cast("long").alias("num_id"), F.when(F.col("p_partkey") % 5 == 0, "x").otherwise((F.col("p_partkey") % 4).cast("string")).alias("ilvl"))
    nums = spark.createDataFrame([(1, 10), (2, 10), (3, 20), (4, 99)], "num_id long, abstract_id long")
    levels = spark.createDataFrame([(10, 0, "decimal", "%1."), (10, 1, "bullet", "•"), (10, 2, "lowerLetter", "%3)"), (20, 0, "bullet", "-"), (20, 1, None, None)], "abstract_id long, level int, format string, text string")
    out = flow.list_numbering(p, nums, levels)
    return out.withColumns({k: F.coalesce(k, F.lit("")) for k in ("format", "template")})


@query(f"WITH {c.FLOW} SELECT conv_id, ord, CASE WHEN kind = 'heading' AND turn % 3 <> 2 THEN 'heading' WHEN kind = 'list_item' THEN 'list_item' ELSE 'paragraph' END AS type FROM v_sections")
def block_classify(spark, sf_dir):
    own = flow.section_index(c.flow(spark, sf_dir), ["conv_id"], "turn", "is_heading")
    level = F.when((F.col("kind") == "heading") & (F.col("turn") % 3 != 2), 1)
    return own.select("conv_id", "ord", flow.block_type(level, F.col("kind") == "list_item").alias("type"))


@query(f"WITH {c.FLOW} SELECT conv_id, ord, section, kind, CAST(length(text) AS INT) AS n FROM v_sections")
def section_index(spark, sf_dir):
    own = flow.section_index(c.flow(spark, sf_dir), ["conv_id"], "turn", "is_heading")
    return own.select("conv_id", "ord", "section", "kind", F.length("text").alias("n"))


@query("SELECT doc_id, length(regexp_replace(coalesce(text, ''), '\\s', '', 'g')) < 20 AND doc_id % 3 > 0 AS image_only FROM documents")
def image_only_probe(spark, sf_dir):
    docs = c.table(spark, sf_dir, "documents")
    return docs.select("doc_id", flow.image_only(F.col("text"), F.col("doc_id") % 3).alias("image_only"))


# rows of a word-processor table: one per distinct line number, three cells each, widths and merges from the keys
RAW = """lines_of AS (SELECT l_orderkey AS table_id, l_linenumber - 1 AS r, max(l_partkey) AS p, max(l_suppkey) AS s, max(l_returnflag) AS f FROM lineitem GROUP BY ALL),
raw AS (SELECT table_id, CAST(r AS INT) AS "row", k AS cell, CAST(1 + CAST((s % 2 = 1 AND k = 0) AS INT) AS INT) AS colspan, CASE (p + k) % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'restart' ELSE 'continue' END AS vmerge, CASE WHEN (p + k) % 4 = 0 THEN '' ELSE f || k END AS text FROM lines_of, (VALUES (0), (1), (2)) t(k)),
placed AS (SELECT *, CAST(coalesce(sum(colspan) OVER (PARTITION BY table_id, "row" ORDER BY cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS col FROM raw)"""
MERGED = f"""{RAW}, isl AS (SELECT *, sum(brk) OVER (PARTITION BY table_id, col, colspan ORDER BY "row" ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT *, CASE WHEN vmerge = 'continue' AND lag("row") OVER w = "row" - 1 THEN 0 ELSE 1 END AS brk FROM placed WINDOW w AS (PARTITION BY table_id, col, colspan ORDER BY "row"))),
headed AS (SELECT *, first_value(vmerge) OVER (PARTITION BY table_id, col, colspan, island ORDER BY "row") = 'restart' AS anchored FROM isl),
merged AS (SELECT table_id, min("row") AS "row", col, colspan, CAST(count(*) AS INT) AS rowspan, coalesce(string_agg(CASE WHEN text <> '' THEN text END, chr(10) ORDER BY "row"), '') AS text, bool_or(NOT anchored AND vmerge = 'continue') AS orphan FROM headed GROUP BY table_id, col, colspan, island, CASE WHEN anchored THEN -1 ELSE "row" END)"""


def _raw(spark, sf_dir):
    li = c.table(spark, sf_dir, "lineitem")
    rows = li.groupBy(F.col("l_orderkey").cast("long").alias("table_id"), (F.col("l_linenumber") - 1).cast("int").alias("row")).agg(F.max("l_partkey").alias("p"), F.max("l_suppkey").alias("s"), F.max("l_returnflag").alias("f"))
    each = rows.select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("cell"))
    kind = (F.col("p") + F.col("cell")) % 3
    return each.select(
        "table_id", "row", "cell", F.when((F.col("s") % 2 == 1) & (F.col("cell") == 0), 2).otherwise(1).alias("colspan"), F.when(kind == 0, "none").when(kind == 1, "restart").otherwise("continue").alias("vmerge"),
        F.when((F.col("p") + F.col("cell")) % 4 == 0, "").otherwise(F.concat("f", F.col("cell").cast("string"))).alias("text"), F.when((F.col("p") + F.col("cell")) % 5 == 0, "restart").when((F.col("s") + F.col("cell")) % 4 == 0, "continue").otherwise("none").alias("hmerge"),
    )


@query(f"""WITH {RAW} SELECT table_id, "row", cell, col, colspan FROM placed""")
def grid_columns(spark, sf_dir):
    return grid.running_columns(_raw(spark, sf_dir), ["table_id"]).select("table_id", "row", "cell", "col", "colspan")


@query(f"""WITH {MERGED} SELECT table_id, "row", col, colspan, rowspan, text, orphan FROM merged""")
def vmerge_spans(spark, sf_dir):
    placed = grid.running_columns(_raw(spark, sf_dir), ["table_id"])
    return flow.vmerge_spans(placed, ["table_id"])


H_RAW = RAW.replace("AS text FROM lines_of", "AS text, CASE WHEN (p + k) % 5 = 0 THEN 'restart' WHEN (s + k) % 4 = 0 THEN 'continue' ELSE 'none' END AS hmerge FROM lines_of")


@query(f"""WITH {H_RAW}, runs AS (SELECT *, sum(CAST(hmerge <> 'continue' AS INT)) OVER (PARTITION BY table_id, "row" ORDER BY cell ROWS UNBOUNDED PRECEDING) AS run FROM raw),
headed AS (SELECT *, hmerge = 'continue' AND first_value(hmerge) OVER (PARTITION BY table_id, "row", run ORDER BY cell) <> 'restart' AS lone FROM runs)
SELECT table_id, "row", CAST(min(cell) AS INT) AS cell, CAST(sum(colspan) AS BIGINT) AS colspan, coalesce(string_agg(CASE WHEN text <> '' THEN text END, chr(10) ORDER BY cell), '') AS text, count(*) - 1 AS merged_cells FROM headed GROUP BY table_id, "row", run, CASE WHEN lone THEN cell ELSE -1 END""")
def hmerge_cells(spark, sf_dir):
    return flow.hmerge(_raw(spark, sf_dir), ["table_id"]).select("table_id", "row", "cell", "colspan", "text", "merged_cells")


@query(f"""WITH {MERGED}, size_of AS (SELECT table_id, max("row") + 1 AS nrows, max(col + colspan) AS ncols FROM placed GROUP BY table_id),
pos AS (SELECT table_id, "row" + i AS r, col + j AS c, count(*) AS n FROM merged, unnest(range(0, rowspan)) a(i), unnest(range(0, colspan)) b(j) GROUP BY ALL),
spread AS (SELECT table_id, bool_or(n > 1) AS clash, CAST(sum(CAST(r < nrows AND c < ncols AS INT)) AS BIGINT) AS filled FROM pos JOIN size_of USING (table_id) GROUP BY table_id),
facts AS (SELECT table_id, bool_or(orphan) AS orphans, count(*) AS n_cells, CAST(sum(CAST(trim(text) <> '' AS INT)) AS BIGINT) AS n_full FROM merged GROUP BY table_id)
SELECT table_id, NOT orphans AND NOT clash AS passed, array_to_string(list_filter([CASE WHEN orphans THEN 'orphan_vertical_merge' END, CASE WHEN clash THEN 'overlapping_cells' END], lambda x: x IS NOT NULL), ',') AS issues, n_full AS nonempty_num, n_cells + nrows * ncols - filled AS nonempty_den
FROM size_of JOIN facts USING (table_id) JOIN spread USING (table_id)""")
def word_table_quality(spark, sf_dir):
    placed = grid.running_columns(_raw(spark, sf_dir), ["table_id"])
    sizes = placed.groupBy("table_id").agg((F.max("row") + 1).alias("nrows"), F.max(F.col("col") + F.col("colspan")).alias("ncols"))
    out = flow.word_table_quality(flow.vmerge_spans(placed, ["table_id"]), sizes, ["table_id"])
    return out.withColumn("issues", F.array_join("issues", ","))
