"""Queries over proposed table regions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import decide, fusion
from quire.plans.registry import query
from quire.sources import carriers as c

REASON = "CASE WHEN kind = 'detection' AND NOT label IN ('table', 'table rotated') THEN 'not_a_table_label' WHEN kind = 'detection' AND NOT strong THEN 'no_strong_grid' WHEN kind = 'native' AND NOT passed AND NOT strong THEN 'failed_quality_without_grid' END"


@query(f"WITH {c.REGIONS} SELECT page, id, kind, reason IS NULL AS eligible, coalesce(reason, '') AS reason FROM (SELECT *, {REASON} AS reason FROM v_regions)")
def candidate_prefilter(spark, sf_dir):
    r = c.regions(spark, sf_dir)
    native = r.where("kind = 'native'").drop("kind", "label", "score")
    out = decide.prefilter(decide.proposals(native, r.where("kind = 'detection'").drop("kind", "passed")))
    return out.select("page", "id", "kind", "eligible", F.coalesce("reason", F.lit("")).alias("reason"))


@query(f"""WITH {c.REGIONS}, pairs AS (SELECT a.page, a.id AS native_id, b.id AS det_id, {c.sql_iou('a', 'b')} AS iou, {c.sql_overlap('a', 'b')} AS overlap_min FROM v_regions a JOIN v_regions b ON a.page = b.page AND a.kind = 'native' AND b.kind = 'detection')
SELECT page, native_id, det_id, iou, overlap_min FROM (SELECT *, row_number() OVER (PARTITION BY page, native_id ORDER BY iou DESC, overlap_min DESC, det_id) AS rn FROM pairs WHERE iou > 0 AND iou >= 0.25 OR overlap_min >= 0.72) WHERE rn = 1""")
def iou_best_match(spark, sf_dir):
    r = c.regions(spark, sf_dir)
    left = r.where("kind = 'native'").select("page", F.col("id").alias("left_id"), F.col("box").alias("left_box"))
    right = r.where("kind = 'detection'").select("page", F.col("id").alias("right_id"), F.col("box").alias("right_box"))
    return fusion.best_match(left, right, ["page"]).withColumnsRenamed({"left_id": "native_id", "right_id": "det_id", "overlap": "overlap_min"})


# the folds of the order-dependent queries: one step an item, the state a list
ITEMS = f"""{c.REGIONS}, dealt AS (SELECT page, id, role, x0, y0, x1, y1, row_number() OVER (PARTITION BY page ORDER BY CASE role WHEN 'passed' THEN 0 WHEN 'detected' THEN 1 ELSE 2 END, y0, x0, id) AS k
  FROM (SELECT *, CASE WHEN kind = 'detection' THEN 'detected' WHEN passed THEN 'passed' ELSE 'repair' END AS role FROM (SELECT *, {REASON} AS reason FROM v_regions) WHERE reason IS NULL AND (kind = 'detection' OR strategy = 'lines')))"""
BOX = "{{'x0': {0}.x0, 'y0': {0}.y0, 'x1': {0}.x1, 'y1': {0}.y1}}"


@query(f"""WITH RECURSIVE {ITEMS}, fold AS (
  SELECT page, k, [{{'a': {BOX.format('i')}, 'b': {BOX.format('i')}, 'n': CAST(role <> 'detected' AS INT), 'd': CASE WHEN role = 'detected' THEN [{BOX.format('i')}] ELSE [] END}}] AS cs FROM dealt i WHERE k = 1
  UNION ALL SELECT page, k, CASE WHEN pick IS NULL THEN list_append(cs, {{'a': i, 'b': i, 'n': CAST(role <> 'detected' AS INT), 'd': CASE WHEN role = 'detected' THEN [i] ELSE [] END}})
    ELSE list_transform(cs, lambda r, j: CASE WHEN j = pick THEN {{'a': r.a, 'b': {{'x0': least(r.b.x0, i.x0), 'y0': least(r.b.y0, i.y0), 'x1': greatest(r.b.x1, i.x1), 'y1': greatest(r.b.y1, i.y1)}}, 'n': r.n + CAST(role <> 'detected' AS INT), 'd': CASE WHEN role = 'detected' THEN list_append(r.d, i) ELSE r.d END}} ELSE r END) END AS cs
  FROM (SELECT *, coalesce(twin, -(list_sort(list_filter(list_transform(cs, lambda r, j: {{'iou': {c.sql_iou('r.a', 'i')}, 'low': {c.sql_overlap('r.a', 'i')}, 'j': -j, 'ok': role <> 'detected' OR r.n > 0 AND len(r.d) = 0}}), lambda m: m.ok AND (m.iou > 0 AND m.iou >= 0.25 OR m.low >= 0.72)), 'DESC')[1]).j) AS pick
    FROM (SELECT *, CASE WHEN role = 'detected' THEN list_filter(list_transform(cs, lambda r, j: CASE WHEN len(list_filter(r.d, lambda o: {c.sql_iou('o', 'i')} >= 0.8)) > 0 THEN j END), lambda j: j IS NOT NULL)[1] END AS twin
      FROM (SELECT f.page, i.k, i.role, f.cs, {BOX.format('i')} AS i FROM fold f JOIN dealt i ON i.page = f.page AND i.k = f.k + 1)))),
ends AS (SELECT page, unnest(cs) AS r FROM (SELECT page, arg_max(cs, k) AS cs FROM fold GROUP BY page))
SELECT page, 'p' || format('{{:04d}}', page) || '-candidate-' || format('{{:03d}}', row_number() OVER (PARTITION BY page ORDER BY r.a.y0, r.a.x0)) AS candidate_id,
  CAST(r.n AS INT) AS n_native, CAST(len(r.d) AS INT) AS n_det, r.b.x0 AS x0, r.b.y0 AS y0, r.b.x1 AS x1, r.b.y1 AS y1 FROM ends""")
def candidate_fusion(spark, sf_dir):
    r = decide.prefilter(c.regions(spark, sf_dir)).where("eligible and (kind = 'detection' or strategy = 'lines')")
    role = F.when(F.col("kind") == "detection", "detected").when(F.col("passed"), "passed").otherwise("repair")
    out = fusion.candidate_fusion(r.select("page", "id", role.alias("role"), "box"))
    return out.select("page", "candidate_id", F.size("native_ids").alias("n_native"), F.size("detection_ids").alias("n_det"), "x0", "y0", "x1", "y1")


@query(f"""WITH RECURSIVE {c.REGIONS}, dealt AS (SELECT page, id, {{'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1, 'ncols': ncols}} AS i, row_number() OVER (PARTITION BY page ORDER BY id) AS k FROM v_regions WHERE kind = 'native'),
fold AS (SELECT page, id, k, true AS kept, [i] AS seen FROM dealt WHERE k = 1
  UNION ALL SELECT page, id, k, kept, CASE WHEN kept THEN list_append(seen, i) ELSE seen END FROM (SELECT f.page, d.id, d.k, d.i, f.seen, len(list_filter(f.seen, lambda o: o.ncols = d.i.ncols AND {c.sql_iou('o', 'd.i')} > 0.9)) = 0 AS kept FROM fold f JOIN dealt d ON d.page = f.page AND d.k = f.k + 1))
SELECT page, id, kept FROM fold""")
def near_duplicate_tables(spark, sf_dir):
    r = c.regions(spark, sf_dir).where("kind = 'native'")
    return fusion.near_duplicates(r.select("page", "id", F.lit(2).alias("nrows"), "ncols", "box"))


@query(f"""WITH RECURSIVE {c.REGIONS}, placed AS (SELECT page // 4 AS doc, page, id, kind, {{'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}} AS b FROM v_regions),
truths AS (SELECT doc, page, id, b, CASE WHEN id % 13 = 0 THEN id + 1 END AS named, row_number() OVER (PARTITION BY doc ORDER BY id) AS k FROM placed WHERE kind = 'native'),
offers AS (SELECT doc, list({{'id': id, 'page': page, 'b': b}} ORDER BY id) AS ps FROM placed WHERE kind = 'detection' GROUP BY doc),
fold AS (SELECT doc, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS gt_id, CAST(NULL AS BIGINT) AS pred_id, CAST(NULL AS DOUBLE) AS iou, CAST([] AS BIGINT[]) AS used FROM (SELECT DISTINCT doc FROM placed)
  UNION ALL SELECT doc, k, gt_id, best.id, best.iou, CASE WHEN best IS NULL THEN used ELSE list_append(used, best.id) END FROM (SELECT f.doc, t.k, t.id AS gt_id, f.used,
    list_sort(list_filter(list_transform(coalesce(o.ps, []), lambda p: {{'iou': CAST({c.sql_iou('p.b', 't.b')} AS DOUBLE), 'turn': -p.id, 'id': p.id, 'page': p.page}}), lambda m: NOT list_contains(f.used, m.id) AND CASE WHEN t.named IS NULL THEN m.page = t.page AND m.iou >= 0.25 ELSE m.id = t.named END), 'DESC')[1] AS best
    FROM fold f JOIN truths t ON t.doc = f.doc AND t.k = f.k + 1 LEFT JOIN offers o ON o.doc = f.doc))
SELECT doc, gt_id, pred_id, iou FROM fold WHERE k > 0 UNION ALL SELECT p.doc, NULL, p.id, NULL FROM placed p WHERE kind = 'detection' AND NOT EXISTS (SELECT 1 FROM fold f WHERE f.pred_id = p.id)""")
def gt_match(spark, sf_dir):
    r = c.regions(spark, sf_dir).select(F.floor(F.col("page") / 4).cast("long").alias("doc"), "page", "id", "kind", "box")
    named = F.when(F.col("id") % 13 == 0, F.col("id") + 1)
    truths = r.where("kind = 'native'").select("doc", "page", "id", "box", named.alias("prediction_id"))
    return fusion.gt_match(truths, r.where("kind = 'detection'").select("doc", "page", "id", "box")).select("doc", "gt_id", "pred_id", "iou")


@query(f"WITH {c.REGIONS} SELECT page, id, strategy = 'lines' AS ruled, n_cells FROM (SELECT *, row_number() OVER (PARTITION BY page ORDER BY strategy = 'lines' DESC, n_cells DESC, id) AS rn FROM v_regions WHERE kind = 'native' AND passed) WHERE rn = 1")
def best_native(spark, sf_dir):
    return decide.best_native(c.regions(spark, sf_dir).where("kind = 'native'"), ["page"])


@query(f"WITH {c.REGIONS} SELECT page, id, kind, coalesce(score, -1) AS score FROM (SELECT *, row_number() OVER (PARTITION BY page ORDER BY kind = 'detection' DESC, score DESC NULLS LAST, passed DESC, n_cells DESC, id) AS rn FROM v_regions) WHERE rn = 1")
def structure_proposal(spark, sf_dir):
    return decide.structure_proposal(c.regions(spark, sf_dir), ["page"]).select("page", "id", "kind", F.coalesce("score", F.lit(-1.0)).alias("score"))


@query(f"WITH {c.REGIONS} SELECT page, id, n_cells FROM (SELECT *, row_number() OVER (PARTITION BY page ORDER BY u % 4 DESC, n_cells DESC, id) AS rn FROM v_regions WHERE kind = 'native') WHERE rn = 1")
def best_structure(spark, sf_dir):
    """Native regions stand for structures, with a confidence of few values so that cells decide."""
    r = c.regions(spark, sf_dir).where("kind = 'native'").withColumn("confidence", (F.col("u") % 4) / 4.0)
    return decide.best_structure(r, ["page"])


EVIDENCE = """facts AS (SELECT page, max(score) AS max_detection, bool_or(kind = 'native' AND n_cells >= 20 AND ncols >= 5) AS native_grid, bool_or(kind = 'detection' AND ncols >= 5 AND score >= 0.75) AS partial_grid, bool_or(strong AND u % 16 = 0) AS strong, bool_or(passed AND u % 25 = 0) AS any_passed FROM v_regions GROUP BY page),
scored AS (SELECT *, CASE WHEN coalesce(max_detection, 0) >= 0.85 THEN 2 ELSE 0 END + CASE WHEN native_grid THEN 3 ELSE 0 END + CASE WHEN partial_grid THEN 3 ELSE 0 END + CASE WHEN strong THEN 3 ELSE 0 END AS score, native_grid OR partial_grid OR strong AS structural FROM facts)"""


def _facts(spark, sf_dir):
    r = c.regions(spark, sf_dir)
    return r.groupBy("page").agg(
        F.max("score").alias("max_detection"), F.expr("bool_or(kind = 'native' and n_cells >= 20 and ncols >= 5)").alias("native_grid"), F.expr("bool_or(kind = 'detection' and ncols >= 5 and score >= 0.75)").alias("partial_grid"),
        F.expr("bool_or(strong and u % 16 = 0)").alias("any_strong"), F.expr("bool_or(passed and u % 25 = 0)").alias("any_passed"),
    )


@query(f"WITH {c.REGIONS}, {EVIDENCE} SELECT page, CAST(score AS BIGINT) AS score, structural, structural AND score >= 4 AS sufficient FROM scored")
def evidence_score(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return f.select("page", decide.evidence(F.col("max_detection"), F.col("native_grid"), F.col("partial_grid"), F.col("any_strong")).alias("e")).select("page", "e.*")


DECIDED = f"""{EVIDENCE}, asked AS (SELECT *, NOT any_passed AND strong AS ask, page % 5 = 0 AS structure_ok, structural AND score >= 4 AS sufficient, CASE WHEN page % 11 = 0 THEN 'error' WHEN page % 3 = 0 THEN 'accepted' ELSE 'failed_qc' END AS fallback FROM scored),
decided AS (SELECT page, CASE WHEN any_passed THEN 'accepted_pdfplumber' WHEN NOT strong THEN 'borderless_or_false_positive' WHEN structure_ok THEN 'accepted_tatr_repair' WHEN NOT sufficient THEN 'figure_or_false_positive' WHEN fallback = 'accepted' THEN 'accepted_mineru_fallback' ELSE 'unresolved_table' END AS decision,
  array_to_string(list_filter([CASE WHEN any_passed THEN 'pdfplumber:accepted' ELSE 'visual-grid-candidate-gate:' || CASE WHEN strong THEN 'passed' ELSE 'rejected' END END, CASE WHEN ask THEN 'tatr-v1.1-all:' || CASE WHEN structure_ok THEN 'accepted' ELSE 'failed_qc' END END,
  CASE WHEN ask AND NOT structure_ok THEN 'table_evidence_gate:' || CASE WHEN sufficient THEN 'passed' ELSE 'rejected' END END, CASE WHEN ask AND NOT structure_ok AND sufficient THEN 'mineru-table-region:' || fallback END], lambda x: x IS NOT NULL), ' > ') AS attempts FROM asked)"""


@query(f"WITH {c.REGIONS}, {DECIDED} SELECT page, decision, attempts FROM decided")
def decision_cascade(spark, sf_dir):
    """Stand-ins for the models: structure succeeds on every fifth page, the fallback on every third, and fails on some."""
    structure = lambda asked: asked.select("page", (F.col("page") % 5 == 0).alias("structure_passed"), F.col("partial_grid").alias("structure_grid"))
    fallback = lambda asked: asked.select("page", F.when(F.col("page") % 11 != 0, F.col("page") % 3 == 0).alias("fallback_passed"))
    out = decide.cascade(_facts(spark, sf_dir), ["page"], structure, fallback)
    return out.select("page", "decision", F.array_join("attempts", " > ").alias("attempts"))


@query(f"""WITH {c.REGIONS}, {DECIDED} SELECT page, 'proposal' AS stage, CAST(id AS VARCHAR) AS item, reason FROM (SELECT *, {REASON} AS reason FROM v_regions) WHERE reason IS NOT NULL
UNION ALL SELECT page, 'candidate', 'c' || page, decision FROM decided WHERE NOT starts_with(decision, 'accepted_')""")
def rejected_list(spark, sf_dir):
    filtered = decide.prefilter(c.regions(spark, sf_dir))
    decided = decision_cascade(spark, sf_dir).withColumn("candidate", F.concat(F.lit("c"), F.col("page").cast("string")))
    return decide.rejected(filtered, decided, ["page"])


@query(f"""WITH {c.REGIONS}, placed AS (SELECT page // 4 AS doc, page, id, ncols, y0, y1 FROM v_regions WHERE kind = 'native')
SELECT a.doc, a.id AS first_id, b.id AS second_id FROM placed a JOIN placed b ON a.doc = b.doc AND b.page = a.page + 1 AND a.ncols = b.ncols WHERE a.y1 > 0.78::DOUBLE * 130 AND b.y0 < 0.25::DOUBLE * 130""")
def continuation_pairs(spark, sf_dir):
    r = c.regions(spark, sf_dir).where("kind = 'native'").select(F.floor(F.col("page") / 4).cast("long").alias("doc"), "page", "id", "ncols", "box")
    pages = r.select("doc", "page", F.lit(130.0).alias("height")).distinct()
    return decide.continuation_pairs(r, pages, ["doc"])
