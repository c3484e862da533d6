"""Entities derived from the driver's tables, in Spark and in DuckDB SQL.

The driver has no PDFs; words, regions, cells and flow blocks are laid out from the tables it has. All
coordinates are small dyadic numbers, so both engines compute the same values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.geometry import box


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("text is not null")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("ln", "line"))


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, ln, pos, word, box: 40 points a word, 16 a line."""
    w = lines(spark, sf_dir).select("doc_id", "ln", F.posexplode(F.filter(F.split("line", " "), lambda x: x != "")).alias("pos", "word"))
    x0, y0 = F.col("pos") * 40.0, F.col("ln") * 16.0
    return w.select("doc_id", "ln", "pos", "word", box(x0, y0, x0 + 4.0 * F.length("word"), y0 + 12.0).alias("box"))


WORDS = """v_lines AS (SELECT doc_id, CAST(i - 1 AS INT) AS ln, ls[i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL) s, unnest(range(1, len(ls) + 1)) t(i)),
v_words AS (SELECT doc_id, ln, CAST(i - 1 AS INT) AS pos, ws[i] AS word, CAST((i - 1) * 40 AS DOUBLE) AS x0, CAST((i - 1) * 40 + 4 * length(ws[i]) AS DOUBLE) AS x1, CAST(ln * 16 AS DOUBLE) AS y0, CAST(ln * 16 + 12 AS DOUBLE) AS y1
  FROM (SELECT doc_id, ln, list_filter(string_split(line, ' '), lambda x: x <> '') AS ws FROM v_lines) s, unnest(range(1, len(ws) + 1)) t(i))"""


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two table regions a document, which share an edge."""
    docs = table(spark, sf_dir, "documents").where("text is not null").select("doc_id")
    two = F.array(F.struct(F.lit(0).alias("box_id"), box(*map(F.lit, (0.0, 30.0, 200.0, 62.0))).alias("region")), F.struct(F.lit(1).alias("box_id"), box(*map(F.lit, (80.0, 54.0, 400.0, 94.0))).alias("region")))
    return docs.select("doc_id", F.inline(two))


BOXES = "v_boxes AS (SELECT doc_id, b.* FROM documents, (VALUES (0, 0.0, 30.0, 200.0, 62.0), (1, 80.0, 54.0, 400.0, 94.0)) b(box_id, bx0, by0, bx1, by1) WHERE text IS NOT NULL)"
INSIDE = "(w.x0 + w.x1) / 2 BETWEEN b.bx0 AND b.bx1 AND (w.y0 + w.y1) / 2 BETWEEN b.by0 AND b.by1"


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page, id, kind, passed, strong, label, score, n_cells, ncols, strategy, box, u (a small number)."""
    e = table(spark, sf_dir, "events")
    n, u = F.col("event_id"), F.col("user_id")
    x0, y0 = (u % 50).cast("double"), ((n % 20) * 5).cast("double")
    x1 = x0 + 20 + (F.floor(F.abs("value")) % 60)
    kind = F.when(F.col("event_type").isin("purchase", "signup"), "detection").otherwise("native")
    return e.select(
        (F.floor(n / 20)).cast("long").alias("page"), n.alias("id"), kind.alias("kind"), (kind == "native").__and__(F.col("event_type") != "error").alias("passed"),
        (n % 3 != 0).alias("strong"), F.when(kind == "detection", F.when(n % 7 == 0, "figure").when(n % 5 == 0, "table rotated").otherwise("table")).alias("label"),
        F.when(kind == "detection", (F.floor(F.abs("value")) % 101) / 100.0).alias("score"), (u % 9 * (n % 4)).cast("long").alias("n_cells"), (u % 5 + 1).cast("long").alias("ncols"),
        F.when(n % 11 == 0, "text").otherwise("lines").alias("strategy"), box(x0, y0, x1, y0 + 10 + (u % 30)).alias("box"), u.cast("long").alias("u"),
    )


REGIONS = """v_regions AS (SELECT event_id // 20 AS page, event_id AS id, kind, kind = 'native' AND event_type <> 'error' AS passed, event_id % 3 <> 0 AS strong,
  CASE WHEN kind = 'detection' THEN CASE WHEN event_id % 7 = 0 THEN 'figure' WHEN event_id % 5 = 0 THEN 'table rotated' ELSE 'table' END END AS label,
  CASE WHEN kind = 'detection' THEN (CAST(floor(abs(value)) AS BIGINT) % 101) / CAST(100 AS DOUBLE) END AS score, (user_id % 9) * (event_id % 4) AS n_cells, user_id % 5 + 1 AS ncols,
  CASE WHEN event_id % 11 = 0 THEN 'text' ELSE 'lines' END AS strategy, user_id AS u, CAST(user_id % 50 AS DOUBLE) AS x0, CAST((event_id % 20) * 5 AS DOUBLE) AS y0,
  CAST(user_id % 50 + 20 + CAST(floor(abs(value)) AS BIGINT) % 60 AS DOUBLE) AS x1, CAST((event_id % 20) * 5 + 10 + user_id % 30 AS DOUBLE) AS y1
  FROM (SELECT *, CASE WHEN event_type IN ('purchase', 'signup') THEN 'detection' ELSE 'native' END AS kind FROM events))"""


def sql_area(a: str) -> str:
    return f"(greatest(0, {a}.x1 - {a}.x0) * greatest(0, {a}.y1 - {a}.y0))"


def sql_inter(a: str, b: str) -> str:
    return f"(greatest(0, least({a}.x1, {b}.x1) - greatest({a}.x0, {b}.x0)) * greatest(0, least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0)))"


def sql_iou(a: str, b: str) -> str:
    return f"({sql_inter(a, b)} / greatest({sql_area(a)} + {sql_area(b)} - {sql_inter(a, b)}, 1e-9))"


def sql_overlap(a: str, b: str) -> str:
    return f"({sql_inter(a, b)} / greatest(least({sql_area(a)}, {sql_area(b)}), 1e-9))"


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """table_id, row, col, rowspan, colspan, text, header, has_box: three columns per line item."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    each = li.select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("col"))
    text = F.when(F.col("l_suppkey") % 5 == 0, "").when(F.col("col") == 0, F.col("l_returnflag")).when(F.col("col") == 1, F.col("l_linestatus")).otherwise(F.concat_ws(" & ", "l_returnflag", "l_linestatus"))
    return each.select(
        F.col("l_orderkey").cast("long").alias("table_id"), (F.col("l_linenumber") - 1).cast("int").alias("row"), "col", F.lit(1).alias("rowspan"),
        F.when((F.col("col") == 0) & (F.col("l_partkey") % 7 == 0), 2).otherwise(1).alias("colspan"), text.alias("text"), (F.col("l_linenumber") == 1).alias("header"), (F.col("l_partkey") % 11 != 0).alias("has_box"),
    )


CELLS = """v_cells AS (SELECT l_orderkey AS table_id, CAST(l_linenumber - 1 AS INT) AS "row", c AS col, 1 AS rowspan, CASE WHEN c = 0 AND l_partkey % 7 = 0 THEN 2 ELSE 1 END AS colspan,
  CASE WHEN l_suppkey % 5 = 0 THEN '' WHEN c = 0 THEN l_returnflag WHEN c = 1 THEN l_linestatus ELSE l_returnflag || ' & ' || l_linestatus END AS text, l_linenumber = 1 AS header, l_partkey % 11 <> 0 AS has_box
  FROM lineitem, (VALUES (0), (1), (2)) t(c))"""


def plain_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clean grid per order: one row for each distinct line number, numbered from 0, three columns, no spans."""
    own = cells(spark, sf_dir).groupBy("table_id", "row", "col").agg(F.max("text").alias("text"))
    dense = F.dense_rank().over(Window.partitionBy("table_id").orderBy("row")) - 1
    return own.withColumn("row", dense.cast("int")).select("table_id", "row", "col", F.lit(1).alias("rowspan"), F.lit(1).alias("colspan"), "text", (F.col("row") == 0).alias("header"))


def plain_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of plain_cells, a row of its three cells each: table_id, row (numbers may have gaps), first, second, third."""
    li = table(spark, sf_dir, "lineitem")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = {"first": F.col("l_returnflag"), "second": F.col("l_linestatus"), "third": F.concat_ws(" & ", "l_returnflag", "l_linestatus")}
    own = li.select(F.col("l_orderkey").cast("long").alias("table_id"), (F.col("l_linenumber") - 1).cast("int").alias("row"), *(F.when(F.col("l_suppkey") % 5 == 0, "").otherwise(x).alias(k) for k, x in texts.items()))
    return own.repartition(parts, "table_id").groupBy("table_id", "row").agg(*(F.max(k).alias(k) for k in texts))


PLAIN_CELLS = f"""{CELLS}, v_plain AS (SELECT table_id, CAST(dense_rank() OVER (PARTITION BY table_id ORDER BY "row") - 1 AS INT) AS "row", col, 1 AS rowspan, 1 AS colspan, text FROM (SELECT table_id, "row", col, max(text) AS text FROM v_cells GROUP BY ALL))"""


def flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, turn, kind, text, is_heading."""
    c = table(spark, sf_dir, "conversations")
    kind = F.when(F.col("role") == "system", "heading").when(F.col("role") == "assistant", "list_item").otherwise("paragraph")
    return c.select("conv_id", "turn", kind.alias("kind"), F.coalesce("text", F.lit("")).alias("text"), (F.col("role") == "system").alias("is_heading"))


FLOW = """v_flow AS (SELECT conv_id, turn, CASE role WHEN 'system' THEN 'heading' WHEN 'assistant' THEN 'list_item' ELSE 'paragraph' END AS kind, coalesce(text, '') AS text, role = 'system' AS is_heading FROM conversations),
v_sections AS (SELECT *, CAST(row_number() OVER w AS INT) AS ord, CAST(coalesce(sum(CAST(is_heading AS INT)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS section FROM v_flow WINDOW w AS (PARTITION BY conv_id ORDER BY turn))"""
