"""What becomes of proposals and candidates: prefilters, evidence, the cascade of decisions.

Costly stages see only what cheaper ones left open: the residue is filtered before a provider is asked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TABLE_LABELS = ("table", "table rotated")
DETECTION_SCORE, EVIDENCE_THRESHOLD = 0.85, 4
BOTTOM, TOP = 0.78, 0.25


def proposals(native: DataFrame, detections: DataFrame) -> DataFrame:
    """Native tables and detections as one list; what only one side has is null on the other."""
    both = [d.withColumn("kind", F.lit(kind)) for d, kind in ((native, "native"), (detections, "detection"))]
    return both[0].unionByName(both[1], allowMissingColumns=True)


def prefilter(proposals: DataFrame) -> DataFrame:
    """proposals: kind (native | detection), passed, strong, label. Adds eligible and reason.

    A detection needs a table label and a strong ruled grid; its score alone never suffices. A native table
    needs sound quality or a strong grid.
    """
    passed, strong = F.coalesce("passed", F.lit(False)), F.coalesce("strong", F.lit(False))
    detected = F.col("kind") == "detection"
    reason = (
        F.when(detected & ~F.coalesce(F.col("label").isin(*TABLE_LABELS), F.lit(False)), "not_a_table_label")
        .when(detected & ~strong, "no_strong_grid")
        .when(~detected & ~passed & ~strong, "failed_quality_without_grid")
    )
    return proposals.withColumn("reason", reason).withColumn("eligible", F.col("reason").isNull())


def best_native(tables: DataFrame, keys: list[str]) -> DataFrame:
    """Of the sound native tables of a candidate: ruled ones first, then the most cells, then the first."""
    order = F.struct((F.col("strategy") == "lines").alias("ruled"), "n_cells", (-F.col("id")).alias("turn"))
    best = tables.where("passed").groupBy(*keys).agg(F.max(order).alias("best"))
    return best.select(*keys, (-F.col("best.turn")).alias("id"), F.col("best.ruled").alias("ruled"), F.col("best.n_cells").alias("n_cells"))


def structure_proposal(items: DataFrame, keys: list[str]) -> DataFrame:
    """The detection of the highest score, else the native table by (passed, cells); the first among equals."""
    detected = F.col("kind") == "detection"
    by = Window.partitionBy(*keys).orderBy(detected.desc(), F.when(detected, F.col("score")).desc_nulls_last(), F.col("passed").desc(), F.col("n_cells").desc(), F.col("id"))
    return items.withColumn("turn", F.row_number().over(by)).where("turn = 1").drop("turn")


def best_structure(structures: DataFrame, keys: list[str]) -> DataFrame:
    """Of the structures found for a candidate the one by (confidence, cells); the first among equals.

    structures: keys, id, confidence, n_cells.
    """
    order = F.struct(F.coalesce("confidence", F.lit(float("-inf"))).alias("confidence"), "n_cells", (-F.col("id")).alias("turn"))
    best = structures.groupBy(*keys).agg(F.max(order).alias("best"))
    return best.select(*keys, (-F.col("best.turn")).alias("id"), F.col("best.n_cells").alias("n_cells"))


def rejected(filtered: DataFrame, decided: DataFrame, keys: list[str]) -> DataFrame:
    """What did not become a table: proposals that the prefilter refused, and candidates that ended without a table.

    filtered: prefilter's output with keys and id; decided: keys, candidate, decision. Gives keys, stage, item, reason.
    """
    early = filtered.where(~F.col("eligible")).select(*keys, F.lit("proposal").alias("stage"), F.col("id").cast("string").alias("item"), "reason")
    late = decided.where(~F.col("decision").startswith("accepted_")).select(*keys, F.lit("candidate").alias("stage"), F.col("candidate").cast("string").alias("item"), F.col("decision").alias("reason"))
    return early.unionByName(late)


def evidence(max_detection: Column, native_grid: Column, partial_structure: Column, strong: Column, threshold: int = EVIDENCE_THRESHOLD) -> Column:
    """A struct of score, structural and sufficient."""
    point = lambda c, n: F.when(c, n).otherwise(0)
    score = point(F.coalesce(max_detection, F.lit(0.0)) >= DETECTION_SCORE, 2) + point(native_grid, 3) + point(partial_structure, 3) + point(strong, 3)
    structural = native_grid | partial_structure | strong
    return F.struct(score.cast("long").alias("score"), structural.alias("structural"), (structural & (score >= threshold)).alias("sufficient"))


Provider = Callable[[DataFrame], DataFrame]


def cascade(candidates: DataFrame, keys: list[str], structure: Provider, fallback: Provider | None, threshold: int = EVIDENCE_THRESHOLD) -> DataFrame:
    """Decide every candidate; attempts lists the stages it went through.

    candidates: keys, any_passed, any_strong, max_detection, native_grid. structure gives keys and
    structure_passed, structure_grid for the candidates it is asked about; fallback gives keys and
    fallback_passed (null for an error). Without a fallback provider what reaches it stays unresolved.
    """
    accepted = F.col("any_passed")
    asked = candidates.where(~accepted & F.col("any_strong"))
    seen = asked.join(structure(asked), keys, "left")
    seen = seen.withColumn("structure_passed", F.coalesce("structure_passed", F.lit(False))).withColumn("structure_grid", F.coalesce("structure_grid", F.lit(False)))
    seen = seen.withColumn("evidence", evidence(F.col("max_detection"), F.col("native_grid"), F.col("structure_grid"), F.col("any_strong"), threshold))
    open_ = seen.where(~F.col("structure_passed") & F.col("evidence.sufficient"))
    if fallback is None:
        last = open_.select(*keys, F.lit(None).cast("boolean").alias("fallback_passed"), F.lit("disabled").alias("fallback_state"))
    else:
        last = open_.select(*keys).join(fallback(open_), keys, "left")
        state = F.when(F.col("fallback_passed").isNull(), "error").when(F.col("fallback_passed"), "accepted").otherwise("failed_qc")
        last = last.select(*keys, "fallback_passed", state.alias("fallback_state"))
    every = candidates.select(*keys, "any_passed", "any_strong").join(seen.select(*keys, "structure_passed", F.col("evidence.sufficient").alias("sufficient")), keys, "left").join(last, keys, "left")
    refused = ~accepted & ~F.col("any_strong")
    decision = (
        F.when(accepted, "accepted_pdfplumber").when(refused, "borderless_or_false_positive").when(F.col("structure_passed"), "accepted_tatr_repair")
        .when(~F.col("sufficient"), "figure_or_false_positive").when(F.col("fallback_state") == "accepted", "accepted_mineru_fallback").otherwise("unresolved_table")
    )
    attempts = F.array_compact(F.array(
        F.when(accepted, F.lit("pdfplumber:accepted")),
        F.when(~accepted, F.concat(F.lit("visual-grid-candidate-gate:"), F.when(F.col("any_strong"), "passed").otherwise("rejected"))),
        F.when(F.col("structure_passed").isNotNull(), F.concat(F.lit("tatr-v1.1-all:"), F.when(F.col("structure_passed"), "accepted").otherwise("failed_qc"))),
        F.when(~F.col("structure_passed"), F.concat(F.lit("table_evidence_gate:"), F.when(F.col("sufficient"), "passed").otherwise("rejected"))),
        F.when(F.col("fallback_state").isin("accepted", "failed_qc", "error"), F.concat(F.lit("mineru-table-region:"), F.col("fallback_state"))),
    ))
    return every.select(*keys, decision.alias("decision"), attempts.alias("attempts"))


def continuation_pairs(tables: DataFrame, pages: DataFrame, document: list[str]) -> DataFrame:
    """Tables that may go on overleaf: next page, as many columns, at the bottom and at the top. Only flagged.

    tables: document, page, id, ncols, box; pages: document, page, height.
    """
    placed = tables.join(pages, [*document, "page"])
    low = placed.where(F.col("box.y1") > BOTTOM * F.col("height")).select(*document, (F.col("page") + 1).alias("page"), "ncols", F.col("id").alias("first_id"))
    high = placed.where(F.col("box.y0") < TOP * F.col("height")).select(*document, "page", "ncols", F.col("id").alias("second_id"))
    return low.join(high, [*document, "page", "ncols"]).select(*document, "first_id", "second_id")
