"""Flow documents: styles, numbering, block types, sections, merged cells of word-processor tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import SPACE, to_int, without
from quire.operators.grid import positions
from quire.tables import materialize, release

HEADING_NAMES = ("heading", "标题")


def style_resolve(styles: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """styles: style_id, name, based_on, outline (-1: none). The first name and the first outline along the chain,
    stopping at an outline, a missing style or a cycle.

    Every round doubles the reach of all chains by one join and writes the result; it ends when no chain goes on, so
    the deepest chain takes log2(depth) + 1 joins. Chains that go round in a cycle are done when they have reached as
    far as there are styles.
    """
    keys = keys or []
    level = F.when(F.col("outline") >= 0, F.col("outline"))
    up = F.when(F.col("outline") >= 0, F.lit(None)).otherwise(F.col("based_on"))
    chain = materialize(styles.select(*keys, "style_id", "name", level.alias("level"), up.alias("up")), "styles")
    reach, most = 1, chain.count()
    while reach <= most and not chain.where("up is not null").isEmpty():
        above = chain.select(*keys, F.col("style_id").alias("up"), F.col("name").alias("name_up"), F.col("level").alias("level_up"), F.col("up").alias("up_up"))
        joined = chain.join(above, [*keys, "up"], "left")
        # past a level nothing above counts any more
        further = F.when(F.coalesce("level", "level_up").isNull(), F.col("up_up"))
        longer = joined.select(*keys, "style_id", F.coalesce("name", "name_up").alias("name"), F.coalesce("level", "level_up").alias("level"), further.alias("up"))
        longer = materialize(longer, "styles")
        release(chain)
        chain, reach = longer, reach * 2
    return chain.select(*keys, "style_id", "name", F.coalesce("level", F.lit(-1)).alias("outline"))


def list_numbering(paragraphs: DataFrame, nums: DataFrame, levels: DataFrame) -> DataFrame:
    """paragraphs: id, num_id, ilvl (text); nums: num_id, abstract_id; levels: abstract_id, level, format, text."""
    own = paragraphs.withColumn("level", to_int(F.col("ilvl"), 0))
    return own.join(nums, "num_id", "left").join(levels, ["abstract_id", "level"], "left").select("id", "num_id", "level", "format", F.col("text").alias("template"))


def heading_level(outline: Column, style_name: Column) -> Column:
    """1..9 from an outline of 0..8, else from a style named heading N; null for other text."""
    plain = F.replace(F.lower(style_name), F.lit(" "), F.lit(""))
    named = F.regexp_extract(plain, f"^(?:{'|'.join(HEADING_NAMES)})([0-9]+)$", 1)
    return F.when(outline.between(0, 8), outline + 1).when(named != "", F.least(F.lit(9), to_int(F.substring(named, 1, 9), 9)))


def block_type(level: Column, is_list: Column) -> Column:
    return F.when(F.coalesce(level, F.lit(0)) != 0, "heading").when(F.coalesce(is_list, F.lit(False)), "list_item").otherwise("paragraph")


def section_index(blocks: DataFrame, keys: list[str], order: str, ends_section: str) -> DataFrame:
    """ord counts every block; section counts the section ends before it. Filter empty blocks after this."""
    by = Window.partitionBy(*keys).orderBy(order)
    ends = F.sum(F.col(ends_section).cast("int")).over(by.rowsBetween(Window.unboundedPreceding, -1))
    return blocks.withColumn("ord", F.row_number().over(by)).withColumn("section", F.coalesce(ends, F.lit(0)).cast("int"))


def image_only(text: Column, drawings: Column) -> Column:
    return (F.length(without(F.coalesce(text, F.lit("")), SPACE)) < 20) & (drawings > 0)


def hmerge(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Join horizontal continuations to the restart cell on their left; its span and text take them in.

    cells: keys, row, cell, colspan, hmerge (none | restart | continue), vmerge, text. A continuation without a
    restart cell just before it (or before other continuations) stays a cell of its own. Adds merged_cells.
    """
    by = Window.partitionBy(*keys, "row").orderBy("cell")
    cont = F.col("hmerge") == "continue"
    start = F.sum((~cont).cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0))
    runs = cells.withColumn("run", start)
    first = F.first("hmerge").over(Window.partitionBy(*keys, "row", "run").orderBy("cell"))
    alone = cont & (first != "restart")
    runs = runs.withColumn("lone", alone).withColumn("part", F.when(alone, F.col("cell")).otherwise(F.lit(-1)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("text") != "", F.struct("cell", "text")))), lambda x: x.text), "\n")
    return runs.groupBy(*keys, "row", "run", "part").agg(F.min("cell").alias("cell"), F.sum("colspan").alias("colspan"), F.min_by("vmerge", "cell").alias("vmerge"), text.alias("text"), (F.count(F.lit(1)) - 1).alias("merged_cells")).drop("run", "part")


def vmerge_spans(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Vertical merges as islands. cells: keys, row, col, colspan, vmerge (none | restart | continue), text.

    Cells of one column and width form an island as long as each but the first continues in the very next row.
    An island that begins with a restart is one cell of that many rows; other continuations are orphans and
    stay cells of their own. Gives row, col, colspan, rowspan, text, orphan.
    """
    cells = cells.repartition(*keys)  # every step below is within a table
    place = Window.partitionBy(*keys, "col", "colspan").orderBy("row")
    cont = F.col("vmerge") == "continue"
    new = F.when(cont & (F.lag("row").over(place) == F.col("row") - 1), 0).otherwise(1)
    islands = cells.withColumn("new", F.coalesce(new, F.lit(1))).withColumn("island", F.sum("new").over(place.rowsBetween(Window.unboundedPreceding, 0)))
    head = F.first("vmerge").over(Window.partitionBy(*keys, "col", "colspan", "island").orderBy("row"))
    islands = islands.withColumn("anchored", head == "restart")
    part = F.when(F.col("anchored"), F.lit(-1)).otherwise(F.col("row"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("text") != "", F.struct("row", "text")))), lambda x: x.text), "\n")
    out = islands.withColumn("part", part).groupBy(*keys, "col", "colspan", "island", "part").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("rowspan"), text.alias("text"), F.bool_or(~F.col("anchored") & cont).alias("orphan"))
    return out.select(*keys, "row", "col", "colspan", F.col("rowspan").cast("int").alias("rowspan"), "text", "orphan")


def word_table_quality(cells: DataFrame, sizes: DataFrame, keys: list[str]) -> DataFrame:
    """cells: merged cells with orphan; sizes: keys, nrows, ncols. Filler cells count in the ratio."""
    each = positions(cells, keys).groupBy(*keys, "r", "c").agg(F.count(F.lit(1)).alias("n"))
    inside = each.join(sizes, keys).withColumn("in_grid", (F.col("r") < F.col("nrows")) & (F.col("c") < F.col("ncols")))
    spread = inside.groupBy(*keys).agg(F.bool_or(F.col("n") > 1).alias("overlaps"), F.sum(F.col("in_grid").cast("long")).alias("filled"))
    facts = cells.groupBy(*keys).agg(F.bool_or("orphan").alias("orphans"), F.count(F.lit(1)).alias("n_cells"), F.sum((without(F.col("text"), SPACE) != "").cast("long")).alias("n_full"))
    every = sizes.join(facts, keys, "left").join(spread, keys, "left").fillna(0, ["n_cells", "n_full", "filled"]).fillna(False, ["orphans", "overlaps"])
    issues = F.array_compact(F.array(F.when(F.col("orphans"), F.lit("orphan_vertical_merge")), F.when(F.col("overlaps"), F.lit("overlapping_cells"))))
    passed = ~F.col("orphans") & ~F.col("overlaps") & (F.col("nrows") > 0) & (F.col("ncols") > 0)
    cells_all = F.col("n_cells") + F.col("nrows") * F.col("ncols") - F.col("filled")
    return every.select(*keys, passed.alias("passed"), F.array_sort(issues).alias("issues"), F.col("n_full").alias("nonempty_num"), cells_all.cast("long").alias("nonempty_den"))
