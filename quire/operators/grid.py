"""Table grids: coordinates to cells, spans, completeness, quality, signatures."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.numbers import rounded
from quire.functions.text import REPLACEMENT, SPACE, is_blank, without

FATAL = ("empty_table", "too_few_rows", "too_few_columns", "invalid_cell_index_or_span", "overlapping_cells", "nonrectangular_grid", "mostly_empty_cells", "replacement_character")
MOSTLY_EMPTY, NONEMPTY, RECALL, RECALL_FALLBACK, RECALL_FROM, CONFIDENCE = 0.72, 0.28, 0.35, 0.45, 8, 0.25


def dims(cells: DataFrame, keys: list[str]) -> DataFrame:
    end = lambda a, b: F.coalesce(F.max(F.col(a) + F.col(b)), F.lit(0)).cast("long")
    return cells.groupBy(*keys).agg(end("row", "rowspan").alias("nrows"), end("col", "colspan").alias("ncols"))


def cells_from_boxes(boxes: DataFrame, keys: list[str], item: str) -> DataFrame:
    """Rows and columns of cell boxes by the rank of their rounded edges among all edges of a table."""
    rounded = boxes.where("box.x1 > box.x0 and box.y1 > box.y0").select(*keys, item, *(F.round(F.col(f"box.{c}"), 3).alias(c) for c in ("x0", "y0", "x1", "y1")))
    edges = rounded.groupBy(*keys).agg(*(F.array_sort(F.array_union(F.collect_set(a), F.collect_set(b))).alias(n) for a, b, n in (("x0", "x1", "xs"), ("y0", "y1", "ys"))))
    at = lambda axis, edge: F.array_position(axis, F.col(edge)).cast("int") - 1
    both = rounded.join(edges, keys)
    col, row = at("xs", "x0"), at("ys", "y0")
    return both.select(*keys, item, row.alias("row"), col.alias("col"), (at("ys", "y1") - row).alias("rowspan"), (at("xs", "x1") - col).alias("colspan"))


def invalid(row="row", col="col", rowspan="rowspan", colspan="colspan") -> Column:
    return (F.col(row) < 0) | (F.col(col) < 0) | (F.col(rowspan) < 1) | (F.col(colspan) < 1)


def positions(cells: DataFrame, keys: list[str]) -> DataFrame:
    """One row per grid position that a valid cell covers."""
    valid = cells.where(~invalid())
    rows = valid.select(*keys, F.explode(F.sequence("row", F.col("row") + F.col("rowspan") - 1)).alias("r"), "col", "colspan")
    return rows.select(*keys, "r", F.explode(F.sequence("col", F.col("col") + F.col("colspan") - 1)).alias("c"))


def occupancy(cells: DataFrame, keys: list[str]) -> DataFrame:
    """covered (positions with repeats) and distinct positions, each position counted once on the map side."""
    each = positions(cells, keys).groupBy(*keys, "r", "c").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy(*keys).agg(F.sum("n").alias("covered"), F.count(F.lit(1)).alias("positions"))


def issue(condition: Column, name: str) -> Column:
    return F.when(condition, F.lit(name))


def grid_check(cells: DataFrame, keys: list[str], tables: DataFrame | None = None) -> DataFrame:
    """keys, nrows, ncols, n_cells, n_empty, n_boxed, issues (sorted).

    cells: keys, row, col, rowspan, colspan, text, has_box. tables gives keys (and declared nrows, ncols) of
    tables that may have no cells; without it the sizes are those of the cells.
    """
    bad = invalid()
    facts = cells.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_cells"), F.sum(is_blank(F.col("text")).cast("int")).alias("n_empty"),
        F.sum(F.col("has_box").cast("int")).alias("n_boxed"), F.bool_or(bad).alias("any_invalid"), F.bool_or(~bad & ~F.col("has_box")).alias("no_geometry"),
        F.bool_or(~bad & F.col("text").contains(REPLACEMENT)).alias("replaced"),
    )
    size = dims(cells, keys) if tables is None else tables.select(*keys, "nrows", "ncols")
    all_of = size.join(facts, keys, "left").join(occupancy(cells, keys), keys, "left").fillna(0, ["n_cells", "n_empty", "n_boxed", "covered", "positions"]).fillna(False, ["any_invalid", "no_geometry", "replaced"])
    found = F.array_compact(F.array(
        issue(F.col("no_geometry"), "cell_geometry_unavailable"), issue(F.col("n_cells") == 0, "empty_table"),
        issue(F.col("any_invalid"), "invalid_cell_index_or_span"), issue(F.col("n_empty") > MOSTLY_EMPTY * F.col("n_cells"), "mostly_empty_cells"),
        issue((F.col("nrows") != 0) & (F.col("ncols") != 0) & (F.col("positions") != F.col("nrows") * F.col("ncols")), "nonrectangular_grid"),
        issue(F.col("covered") > F.col("positions"), "overlapping_cells"), issue(F.col("replaced"), "replacement_character"),
        issue(F.col("ncols") < 2, "too_few_columns"), issue(F.col("nrows") < 2, "too_few_rows"),
    ))
    return all_of.select(*keys, "nrows", "ncols", "n_cells", "n_empty", "n_boxed", F.array_sort(found).alias("issues"))


def grid_fill(cells: DataFrame, keys: list[str], size: DataFrame | None = None) -> DataFrame:
    """Positions of the grid that no cell covers."""
    size = dims(cells, keys) if size is None else size
    full = size.where("nrows > 0 and ncols > 0").select(*keys, F.explode(F.sequence(F.lit(0), (F.col("nrows") - 1).cast("int"))).alias("r"), "ncols")
    full = full.select(*keys, "r", F.explode(F.sequence(F.lit(0), (F.col("ncols") - 1).cast("int"))).alias("c"))
    return full.join(positions(cells, keys), [*keys, "r", "c"], "left_anti")


def character_counts(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, ch, n: the letters and digits of texts, each case-folded in full, counted within each text before rows meet."""
    own = texts.select(*keys, F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, chars, counts = [], [], []
            for i, value in enumerate(batch.column("text").to_pylist()):
                found: Counter[str] = Counter()
                for ch, n in Counter(value or "").items():
                    if ch.isalnum():
                        for folded in ch.casefold():
                            found[folded] += n
                rows += [i] * len(found)
                chars += found.keys()
                counts += found.values()
            at = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in keys), pa.array(chars, pa.string()), pa.array(counts, pa.int64())], [*keys, "ch", "n"])

    kinds = ", ".join(f"`{k}` {own.schema[k].dataType.simpleString()}" for k in keys)
    return own.mapInArrow(run, f"{kinds}, ch string, n long").groupBy(*keys, "ch").agg(F.sum("n").alias("n"))


def text_recall(reference: DataFrame, prediction: DataFrame, keys: list[str]) -> DataFrame:
    """keys, matched, total: the multiset of normal characters of the reference found in the prediction."""
    want = character_counts(reference, keys)
    have = character_counts(prediction, keys).withColumnRenamed("n", "have")
    both = want.join(have, [*keys, "ch"], "left")
    return both.groupBy(*keys).agg(F.sum(F.least("n", F.coalesce("have", F.lit(0)))).alias("matched"), F.sum("n").alias("total"))


def table_quality(checked: DataFrame, recall: DataFrame, keys: list[str], stage: str = "pdfplumber", confidence: str | None = None) -> DataFrame:
    """keys, passed, issues, nonempty_num, nonempty_den. recall: keys, matched, total of the source words."""
    both = checked.join(recall, keys, "left").fillna(0, ["matched", "total"])
    required = RECALL_FALLBACK if stage == "mineru" else RECALL
    low = (F.col("total") >= RECALL_FROM) & (F.col("matched") / F.greatest("total", F.lit(1)) < required)
    unsure = F.lit(False)
    if stage == "tatr" and confidence:
        unsure = F.coalesce(F.col(confidence) < CONFIDENCE, F.lit(False))
    full = F.col("n_cells") - F.col("n_empty")
    sound = ~F.arrays_overlap("issues", F.array(*[F.lit(x) for x in FATAL])) & (full / F.greatest("n_cells", F.lit(1)) >= NONEMPTY)
    more = F.array_compact(F.array(issue(low, "low_source_text_recall"), issue(unsure, "low_structure_confidence")))
    return both.select(*keys, (sound & ~low & ~unsure).alias("passed"), F.array_sort(F.array_distinct(F.concat("issues", more))).alias("issues"), full.alias("nonempty_num"), F.col("n_cells").alias("nonempty_den"))


def quality_report(checked: DataFrame, recall: DataFrame, keys: list[str], stage: str = "pdfplumber", confidence: str | None = None) -> DataFrame:
    """table_quality for readers: stage, passed, issues and ratios of four digits; the recall is null without source text."""
    judged = table_quality(checked, recall, keys, stage, confidence).select(*keys, "passed", "issues")
    both = checked.drop("issues").join(judged, keys).join(recall, keys, "left")
    share = lambda n, of: rounded(F.when(F.col(of) > 0, F.col(n) / F.col(of)).otherwise(0.0))
    full = both.withColumn("n_full", F.col("n_cells") - F.col("n_empty"))
    found = rounded(F.when(F.col("total") > 0, F.col("matched") / F.col("total")))
    return full.select(*keys, F.lit(stage).alias("stage"), "passed", "issues", share("n_full", "n_cells").alias("nonempty_cell_ratio"), share("n_boxed", "n_cells").alias("cell_geometry_ratio"), found.alias("source_text_recall"))


def signature(cells: DataFrame, keys: list[str], with_text: bool = True) -> DataFrame:
    text = without(F.coalesce("text", F.lit("")), SPACE) if with_text else F.lit("")
    rows = F.array_sort(F.collect_list(F.struct("row", "col", "rowspan", "colspan", text.alias("text"))))
    line = F.transform(rows, lambda c: F.concat_ws(":", c.row.cast("string"), c.col.cast("string"), c.rowspan.cast("string"), c.colspan.cast("string"), c.text))
    return cells.groupBy(*keys).agg(F.array_join(line, "|").alias("signature"))


def structure_cells(cells: DataFrame) -> DataFrame:
    """Cells given by lists of row and column numbers to anchors and spans."""
    rows = [F.array_min("row_nums").alias("row"), F.array_min("column_nums").alias("col"), F.size("row_nums").alias("rowspan"), F.size("column_nums").alias("colspan")]
    return cells.select(*[c for c in cells.columns if c not in ("row_nums", "column_nums")], *rows)


def running_columns(cells: DataFrame, keys: list[str], before: str | None = None) -> DataFrame:
    """col: the first grid column of each cell of a row, from the spans to its left. cells: keys, row, cell, colspan."""
    by = Window.partitionBy(*keys, "row").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("colspan").over(by), F.lit(0)) + (F.col(before) if before else F.lit(0))
    return cells.withColumn("col", start.cast("int"))
