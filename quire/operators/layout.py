"""Words on pages: point-in-box joins, text lines, blocks, reading order.

All joins are equi-joins on the page keys with the geometric test as a residual condition.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.geometry import center_in, rotate_ccw, union_of

TOLERANCE = 4.0


def in_order(order: list[Column | str], text: Column | str, separator: str) -> Column:
    """Aggregate: texts joined by a separator in the given order."""
    text = F.col(text) if isinstance(text, str) else text
    keys = [(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)]
    rows = F.array_sort(F.collect_list(F.struct(*keys, text.alias("text"))))
    return F.array_join(F.transform(rows, lambda r: r.text), separator)


def _inside(words: DataFrame, boxes: DataFrame, keys: list[str], margin: float) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & (words[k] == boxes[k])
    return same & center_in(words["box"], boxes["region"], margin)


def words_in(words: DataFrame, boxes: DataFrame, keys: list[str], margin: float = 0.0) -> DataFrame:
    """words with the columns of every box that holds their centre; a word on a shared edge is in both."""
    found = words.join(boxes, _inside(words, boxes, keys, margin), "inner")
    for k in keys:
        found = found.drop(boxes[k])
    return found


def words_outside(words: DataFrame, boxes: DataFrame, keys: list[str]) -> DataFrame:
    return words.join(boxes, _inside(words, boxes, keys, 0.0), "left_anti")


def text_lines(words: DataFrame, keys: list[str], line: list[str]) -> DataFrame:
    """One block per line of native words: words left to right, lines numbered by their top left corner."""
    lines = words.groupBy(*keys, *line).agg(in_order([F.col("box.x0"), "word"], "word", " ").alias("text"), union_of(F.col("box")).alias("box"))
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("box.y0", "box.x0", *line))
    return lines.withColumn("block_id", F.format_string("text-%04d", number)).select(*keys, "block_id", "text", "box")


def cluster_lines(words: DataFrame, keys: list[str], order: Column | str, tolerance: float = TOLERANCE) -> DataFrame:
    """Line numbers for words without lines: top to bottom, a new line where the middle of a word is more than
    ``tolerance`` from a running mean that halves with every word. One pass over the sorted words of each page."""
    middle = (F.col("box.y0") + F.col("box.y1")) / 2
    rows = F.array_sort(F.collect_list(F.struct(F.col("box.y0").alias("y"), F.col("box.x0").alias("x"), (F.col(order) if isinstance(order, str) else order).cast("long").alias("word"), middle.alias("middle"))))
    pages = words.groupBy(*keys).agg(rows.alias("rows")).select(*keys, F.col("rows.word").alias("word"), F.col("rows.middle").alias("middle"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page, word, line = [], [], []
            for i, (ids, middles) in enumerate(zip(batch.column("word").to_pylist(), batch.column("middle").to_pylist(), strict=True)):
                number, last = 0, None
                for own in middles:
                    if last is None:
                        last = own
                    else:
                        number += abs(own - last) > tolerance
                        last = (last + own) / 2
                    line.append(number)
                word += ids
                page += [i] * len(ids)
            at = pa.array(page, pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in keys), pa.array(word, pa.int64()), pa.array(line, pa.int32())], [*keys, "word", "line"])

    kinds = ", ".join(f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keys)
    return pages.mapInArrow(run, f"{kinds}, word long, line int")


def reading_order(items: DataFrame, keys: list[str]) -> DataFrame:
    """Tables and texts of a page by top, left, tables first, then their own order. Missing boxes count as 0, 0."""
    top, left = F.coalesce("box.y0", F.lit(0.0)), F.coalesce("box.x0", F.lit(0.0))
    rank = F.when(F.col("kind") == "table", 0).otherwise(1)
    return items.withColumn("ordinal", F.row_number().over(Window.partitionBy(*keys).orderBy(top, left, rank, "item")))


def tokens_in_crop(words: DataFrame, crops: DataFrame, keys: list[str]) -> DataFrame:
    """Words whose centre lies in a pixel crop, in the crop's coordinates, turned where the crop is.

    words: keys, word, box; crops: keys, crop (left, top, right, bottom), sx, sy, rotated.
    """
    both = words.join(crops, keys)
    width = (F.col("crop.right") - F.col("crop.left")).cast("double")
    height = (F.col("crop.bottom") - F.col("crop.top")).cast("double")
    local = F.struct(
        (F.col("box.x0") * F.col("sx") - F.col("crop.left")).alias("x0"), (F.col("box.y0") * F.col("sy") - F.col("crop.top")).alias("y0"),
        (F.col("box.x1") * F.col("sx") - F.col("crop.left")).alias("x1"), (F.col("box.y1") * F.col("sy") - F.col("crop.top")).alias("y1"),
    )
    at = both.withColumn("local", local)
    cx, cy = (F.col("local.x0") + F.col("local.x1")) / 2, (F.col("local.y0") + F.col("local.y1")) / 2
    at = at.where(cx.between(0, width) & cy.between(0, height))
    return at.withColumn("local", F.when(F.col("rotated"), rotate_ccw(F.col("local"), width)).otherwise(F.col("local")))
