"""Whether a page's own text layer can be trusted, and where its words come from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import NOT_SPACE, REPLACEMENT, SPACE, without


@dataclass(frozen=True)
class Gate:
    visible: int = 20
    words: int = 3
    printable: float = 0.95
    semantic: float = 0.25
    replacement: float = 0.01


def quality(words: Column, gate: Gate = Gate()) -> Column:
    """A struct of counts and ratios for an array of word texts; computed within the row, without a shuffle.

    The gate uses unrounded ratios. Blank words do not count.
    """
    kept = F.filter(words, lambda w: w.rlike(NOT_SPACE))
    joined = without(F.array_join(kept, ""), SPACE)

    def counted(own: Column) -> Column:
        text = own.text
        return F.struct(
            F.length(text).alias("visible"), own.n.alias("n"), F.length(without(text, "[\\p{C}\\p{Z}�]+")).alias("printable"),
            F.length(without(text, "[^\\p{L}\\p{N}]+")).alias("semantic"), F.length(F.replace(text, F.lit(REPLACEMENT), F.lit(""))).alias("sound"),
        )

    def measured(n: Column) -> Column:
        below = F.greatest(n.visible, F.lit(1)).cast("double")
        printable, semantic, replacement = n.printable / below, n.semantic / below, (n.visible - n.sound) / below
        reliable = (n.visible >= gate.visible) & (n.n >= gate.words) & (printable >= gate.printable) & (semantic >= gate.semantic) & (replacement <= gate.replacement)
        return F.struct(
            n.visible.cast("long").alias("visible"), n.n.cast("long").alias("words"), printable.alias("printable_ratio"),
            semantic.alias("semantic_ratio"), replacement.alias("replacement_ratio"), reliable.alias("reliable"),
        )

    # arrays of one, so that the joined text and each count of it are made once and not for each measure
    once = F.transform(F.array(F.struct(joined.alias("text"), F.size(kept).alias("n"))), counted)
    return F.transform(once, measured)[0]


def route(pages: DataFrame, native: DataFrame, ocr: DataFrame, keys: list[str]) -> DataFrame:
    """The words of each page from one source only: its own layer where pages.reliable, else recognition."""
    own = native.join(pages.where("reliable").select(*keys), keys, "left_semi")
    read = ocr.join(pages.where("not reliable").select(*keys), keys, "left_semi")
    return own.withColumn("text_source", F.lit("native")).unionByName(read.withColumn("text_source", F.lit("ocr")), allowMissingColumns=True)
