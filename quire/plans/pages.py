"""Queries over words on pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import geometry as g
from quire.operators import layout, textlayer
from quire.operators.content import item
from quire.plans.registry import query
from quire.sources import carriers as c
from quire.sources.files import page_selection as select_pages



def _layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = c.table(spark, sf_dir, "documents")
    tokens = F.filter(F.split(F.coalesce("text", F.lit("")), "[ \\n]"), lambda w: w != "")
    return docs.select("doc_id", textlayer.quality(tokens).alias("q")).select("doc_id", "q.*")


LAYER = """layer AS (SELECT doc_id, visible, words, printable / greatest(visible, 1) AS printable_ratio, semantic / greatest(visible, 1) AS semantic_ratio, replaced / greatest(visible, 1) AS replacement_ratio FROM
  (SELECT doc_id, length(j) AS visible, w AS words, CAST(length(regexp_replace(j, '[\\p{C}\\p{Z}\\x{FFFD}]', '', 'g')) AS DOUBLE) AS printable, CAST(length(regexp_replace(j, '[^\\p{L}\\p{N}]', '', 'g')) AS DOUBLE) AS semantic,
    CAST(length(j) - length(replace(j, chr(65533), '')) AS DOUBLE) AS replaced FROM
    (SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \\n]', '', 'g') AS j, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\n]'), lambda x: x <> '')) AS w FROM documents))),
gated AS (SELECT *, visible >= 20 AND words >= 3 AND printable_ratio >= 0.95 AND semantic_ratio >= 0.25 AND replacement_ratio <= 0.01 AS reliable FROM layer)"""


@query(f"WITH {LAYER} SELECT * FROM gated")
def text_layer_quality(spark, sf_dir):
    return _layer(spark, sf_dir)


@query(f"WITH {LAYER} SELECT doc_id, CASE WHEN reliable THEN 'native' ELSE 'ocr' END AS text_source FROM gated")
def text_source_route(spark, sf_dir):
    pages = _layer(spark, sf_dir).select("doc_id", "reliable")
    native = pages.select("doc_id", F.lit("layer").alias("origin"))
    read = pages.select("doc_id", F.lit("image").alias("origin"))
    return textlayer.route(pages, native, read, ["doc_id"]).select("doc_id", "text_source")


@query(f"WITH {c.WORDS} SELECT doc_id, ln AS line, pos AS word, word AS text, x0, y0, x1, y1 FROM v_words")
def word_layout(spark, sf_dir):
    return c.words(spark, sf_dir).select("doc_id", F.col("ln").alias("line"), F.col("pos").alias("word"), F.col("word").alias("text"), "box.x0", "box.y0", "box.x1", "box.y1")


@query(f"WITH {c.WORDS} SELECT doc_id, count(*) AS n_lines FROM v_lines WHERE ln + 1 IN (2, 4, 5, 6) GROUP BY doc_id")
def page_filter(spark, sf_dir):
    """The selector is applied to page numbers before anything else is done to a page."""
    lines = c.lines(spark, sf_dir)
    wanted = lines.where(F.array_contains(select_pages(F.lit("2,4-6")), (F.col("ln") + 1).cast("long")))
    return wanted.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"))


SPECS = ("1,3-5", "0", "5-3", "2,2,1", " 7 ", "1,,2", "a", "3-", "1-200000", "4-4,1", "10 - 12", "")


@query(f"""WITH specs(spec) AS (VALUES {", ".join(f"('{s}')" for s in SPECS)}), parts AS (SELECT spec, trim(p) AS part FROM specs, unnest(string_split(spec, ',')) t(p)),
bounds AS (SELECT spec, part, regexp_full_match(part, '[0-9]+( *- *[0-9]+)?') AS ok, TRY_CAST(trim(string_split(part, '-')[1]) AS BIGINT) AS lo, TRY_CAST(trim(string_split(part, '-')[-1]) AS BIGINT) AS hi FROM parts),
sound AS (SELECT spec, bool_and(coalesce(ok AND lo >= 1 AND hi >= lo AND hi - lo < 100000, false)) AS valid FROM bounds GROUP BY spec),
pages AS (SELECT DISTINCT spec, unnest(range(lo, hi + 1)) AS page FROM bounds JOIN sound USING (spec) WHERE valid)
SELECT s.spec, s.valid, coalesce((SELECT string_agg(CAST(page AS VARCHAR), ',' ORDER BY page) FROM pages p WHERE p.spec = s.spec), '') AS pages FROM sound s""")
def page_selection(spark, sf_dir):
    specs = spark.createDataFrame([(s,) for s in SPECS], "spec string")
    pages = select_pages(F.col("spec"))
    return specs.select("spec", pages.isNotNull().alias("valid"), F.coalesce(F.array_join(pages.cast("array<string>"), ","), F.lit("")).alias("pages"))


PAIRS = f"SELECT a.page, a.id AS a_id, b.id AS b_id, {c.sql_area('a')} AS area_a, {c.sql_area('b')} AS area_b, {c.sql_inter('a', 'b')} AS inter, {c.sql_iou('a', 'b')} AS iou, {c.sql_overlap('a', 'b')} AS overlap_min FROM v_regions a JOIN v_regions b ON a.page = b.page AND a.id < b.id"


@query(f"WITH {c.REGIONS} {PAIRS}")
def box_geometry(spark, sf_dir):
    r = c.regions(spark, sf_dir).select("page", "id", "box")
    a, b = r.select("page", F.col("id").alias("a_id"), F.col("box").alias("p")), r.select("page", F.col("id").alias("b_id"), F.col("box").alias("q"))
    p, q = F.col("p"), F.col("q")
    return a.join(b, "page").where("a_id < b_id").select("page", "a_id", "b_id", g.area(p).alias("area_a"), g.area(q).alias("area_b"), g.intersection(p, q).alias("inter"), g.iou(p, q).alias("iou"), g.overlap_min(p, q).alias("overlap_min"))


@query(f"WITH {c.REGIONS} SELECT page, id, y0 AS rx0, 200 - x1 AS ry0, y1 AS rx1, 200 - x0 AS ry1, x0 AS bx0, y0 AS by0, x1 AS bx1, y1 AS by1 FROM v_regions")
def box_rotate(spark, sf_dir):
    turned = c.regions(spark, sf_dir).select("page", "id", g.rotate_ccw(F.col("box"), F.lit(200.0)).alias("r"))
    back = turned.withColumn("b", g.unrotate_ccw(F.col("r"), F.lit(200.0)))
    return back.select("page", "id", *(F.col(f"r.{k}").alias(f"r{k}") for k in ("x0", "y0", "x1", "y1")), *(F.col(f"b.{k}").alias(f"b{k}") for k in ("x0", "y0", "x1", "y1")))


@query(f"""WITH {c.REGIONS}, crops AS (SELECT page, id, greatest(0, CAST(trunc((x0 - 15) * 1.5) AS INT) - 10) AS "left", greatest(0, CAST(trunc(y0 * 2.5) AS INT) - 10) AS top, least(96, CAST(trunc((x1 - 15) * 1.5) AS INT) + 10) AS "right", least(250, CAST(trunc(y1 * 2.5) AS INT) + 10) AS bottom FROM v_regions)
SELECT page, id, CASE WHEN ok THEN "left" END AS "left", CASE WHEN ok THEN top END AS top, CASE WHEN ok THEN "right" END AS "right", CASE WHEN ok THEN bottom END AS bottom FROM (SELECT *, "right" > "left" AND bottom > top AS ok FROM crops)""")
def pixel_crop(spark, sf_dir):
    size = lambda w, h: F.struct(F.lit(w).alias("width"), F.lit(h).alias("height"))
    moved = g.box(F.col("box.x0") - 15, "box.y0", F.col("box.x1") - 15, "box.y1")
    return c.regions(spark, sf_dir).select("page", "id", g.pixel_crop(moved, size(64.0, 100.0), size(96.0, 250.0)).alias("crop")).select("page", "id", "crop.left", "crop.top", "crop.right", "crop.bottom")


@query("SELECT vec_id, least(e[1], e[3], e[5], e[7]) / 2 AS x0, least(e[2], e[4], e[6], e[8]) / 4 AS y0, greatest(e[1], e[3], e[5], e[7]) / 2 AS x1, greatest(e[2], e[4], e[6], e[8]) / 4 AS y1 FROM (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings)")
def polygon_bbox(spark, sf_dir):
    e = c.table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    points = F.array(*[F.struct(F.col("e")[2 * i].alias("x"), F.col("e")[2 * i + 1].alias("y")) for i in range(4)])
    return e.select("vec_id", g.polygon_box(points, F.lit(2.0), F.lit(4.0)).alias("b")).select("vec_id", "b.*")


@query(f"WITH {c.WORDS}, {c.BOXES} SELECT doc_id, box_id, count(*) AS n_words FROM v_words w JOIN v_boxes b USING (doc_id) WHERE {c.INSIDE} GROUP BY ALL")
def words_in_box(spark, sf_dir):
    return layout.words_in(c.words(spark, sf_dir), c.boxes(spark, sf_dir), ["doc_id"]).groupBy("doc_id", "box_id").agg(F.count(F.lit(1)).alias("n_words"))


OUTSIDE = f"v_out AS (SELECT * FROM v_words w WHERE NOT EXISTS (SELECT 1 FROM v_boxes b WHERE b.doc_id = w.doc_id AND {c.INSIDE}))"


@query(f"WITH {c.WORDS}, {c.BOXES}, {OUTSIDE} SELECT doc_id, ln AS line, pos AS word, word AS text FROM v_out")
def words_outside_tables(spark, sf_dir):
    return layout.words_outside(c.words(spark, sf_dir), c.boxes(spark, sf_dir), ["doc_id"]).select("doc_id", F.col("ln").alias("line"), F.col("pos").alias("word"), F.col("word").alias("text"))


@query(f"WITH {c.WORDS}, {c.BOXES} SELECT doc_id, box_id, string_agg(word, ' ' ORDER BY ln, pos) AS text FROM v_words w JOIN v_boxes b USING (doc_id) WHERE {c.INSIDE} GROUP BY doc_id, box_id")
def cell_text_assign(spark, sf_dir):
    found = layout.words_in(c.words(spark, sf_dir), c.boxes(spark, sf_dir), ["doc_id"])
    return found.groupBy("doc_id", "box_id").agg(layout.in_order(["ln", "pos"], "word", " ").alias("text"))


TEXT_LINES = f"{c.WORDS}, {c.BOXES}, {OUTSIDE}, v_text AS (SELECT doc_id, ln, string_agg(word, ' ' ORDER BY x0, word) AS text, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM v_out GROUP BY doc_id, ln)"


@query(f"WITH {TEXT_LINES} SELECT doc_id, 'text-' || lpad(CAST(row_number() OVER (PARTITION BY doc_id ORDER BY y0, x0, ln) AS VARCHAR), 4, '0') AS block_id, text, x0, y0, x1, y1 FROM v_text")
def text_lines(spark, sf_dir):
    outside = layout.words_outside(c.words(spark, sf_dir), c.boxes(spark, sf_dir), ["doc_id"])
    return layout.text_lines(outside, ["doc_id"], ["ln"]).select("doc_id", "block_id", "text", "box.x0", "box.y0", "box.x1", "box.y1")


@query(f"""WITH RECURSIVE {c.REGIONS}, sorted AS (SELECT page, id AS word_id, (y0 + y1) / 2 AS mid, row_number() OVER (PARTITION BY page ORDER BY y0, x0, id) AS rn FROM v_regions),
fold AS (SELECT page, word_id, rn, 0 AS line_id, mid AS last FROM sorted WHERE rn = 1
  UNION ALL SELECT s.page, s.word_id, s.rn, f.line_id + CASE WHEN abs(s.mid - f.last) > 4 THEN 1 ELSE 0 END, (f.last + s.mid) / 2 FROM fold f JOIN sorted s ON s.page = f.page AND s.rn = f.rn + 1)
SELECT page, word_id, line_id FROM fold""")
def ocr_lines(spark, sf_dir):
    return layout.cluster_lines(c.regions(spark, sf_dir), ["page"], "id").select("page", F.col("word").alias("word_id"), F.col("line").alias("line_id"))


@query(f"WITH {c.REGIONS} SELECT page, CAST(row_number() OVER (PARTITION BY page ORDER BY y0, x0, CASE WHEN kind = 'native' THEN 0 ELSE 1 END, id) AS INT) AS ordinal, CASE WHEN kind = 'native' THEN 'table' ELSE 'text' END AS kind, id FROM v_regions")
def reading_order(spark, sf_dir):
    items = c.regions(spark, sf_dir).select("page", "id", F.col("id").alias("item"), F.when(F.col("kind") == "native", "table").otherwise("text").alias("kind"), "box")
    return layout.reading_order(items, ["page"]).select("page", "ordinal", "kind", "id")


@query(f"""WITH {c.WORDS}, crop AS (SELECT 1.5 AS sx, 2.0 AS sy, 50 AS l, 20 AS t, 350 AS r, 180 AS b), placed AS (SELECT doc_id, ln, pos, x0 * sx - l AS x0, y0 * sy - t AS y0, x1 * sx - l AS x1, y1 * sy - t AS y1, doc_id % 2 = 0 AS turned FROM v_words, crop)
SELECT doc_id, ln AS line, pos AS word, CAST(CASE WHEN turned THEN y0 ELSE x0 END AS DOUBLE) AS x0, CAST(CASE WHEN turned THEN 300 - x1 ELSE y0 END AS DOUBLE) AS y0, CAST(CASE WHEN turned THEN y1 ELSE x1 END AS DOUBLE) AS x1, CAST(CASE WHEN turned THEN 300 - x0 ELSE y1 END AS DOUBLE) AS y1
FROM placed WHERE (x0 + x1) / 2 BETWEEN 0 AND 300 AND (y0 + y1) / 2 BETWEEN 0 AND 160""")
def tokens_in_crop(spark, sf_dir):
    docs = c.table(spark, sf_dir, "documents").where("text is not null")
    crop = F.struct(F.lit(50).alias("left"), F.lit(20).alias("top"), F.lit(350).alias("right"), F.lit(180).alias("bottom"))
    crops = docs.select("doc_id", crop.alias("crop"), F.lit(1.5).alias("sx"), F.lit(2.0).alias("sy"), (F.col("doc_id") % 2 == 0).alias("rotated"))
    found = layout.tokens_in_crop(c.words(spark, sf_dir), crops, ["doc_id"])
    return found.select("doc_id", F.col("ln").alias("line"), F.col("pos").alias("word"), "local.x0", "local.y0", "local.x1", "local.y1")


@query(f"WITH {TEXT_LINES} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY y0, x0, ln) AS INT) AS ordinal, 'text' AS type, text FROM v_text")
def page_content(spark, sf_dir):
    """The flagship: words outside table regions, to lines, to content items in reading order."""
    outside = layout.words_outside(c.words(spark, sf_dir), c.boxes(spark, sf_dir), ["doc_id"])
    blocks = layout.text_lines(outside, ["doc_id"], ["ln"]).select("doc_id", "box", "text", F.lit("text").alias("kind"), F.col("block_id").alias("item"))
    placed = layout.reading_order(blocks, ["doc_id"])
    none = F.lit(None)
    return placed.select("doc_id", "ordinal", item(F.col("kind"), F.col("text"), none.cast("int"), none.cast("int"), none.cast("string")).alias("i")).select("doc_id", "ordinal", "i.type", "i.text")
