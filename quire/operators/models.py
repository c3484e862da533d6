"""What is built on recognition and table models, whichever provider brings them.

A provider turns batches of rows into batches of rows and is made once a task; the steps here ask it only about rows
that are open, and give its answers the form that the other operators take.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators import grid, structure
from quire.operators.decide import TABLE_LABELS
from quire.sources.html_tables import html_table_cells
from quire.sources.providers import Provider, WithFallback, apply, isolated

PRESELECT = 0.30
Maker = Callable[[], Provider]


def recognised_words(pages: DataFrame, make: Maker, spare: Maker | None = None) -> DataFrame:
    """Words of page images by a recognition provider, and by a spare one where it fails; event tells of that.

    The provider gives page keys, word, confidence and box. Blank words are left out.
    """
    read = apply(pages, (lambda: WithFallback(make(), spare())) if spare else make)
    return read.where(F.trim(F.coalesce("word", F.lit(""))) != "")


def detections(pages: DataFrame, make: Maker, least: float = PRESELECT) -> DataFrame:
    """Table detections worth a look: of a table's label and a score of at least ``least``."""
    return apply(pages, make).where(F.col("label").isin(*TABLE_LABELS) & (F.col("score") >= least))


def structures(crops: DataFrame, make: Maker, key: str) -> DataFrame:
    """Cells of crops from the objects that a structure provider finds: key, cell, row, col, rowspan, colspan, box corners,
    header, confidence. The provider gives key, label, score and box."""
    return grid.structure_cells(structure.structures(apply(crops, make), key))


def tables_from_html(regions: DataFrame, make: Maker, key: str) -> DataFrame:
    """Cells of regions from the HTML that a provider writes of them; a region that fails gives a row with its error.

    The provider gives key and html.
    """
    written = apply(regions, isolated(make, key))
    cells = html_table_cells(written.where("error is null").select(key, "html"), key)
    failed = written.where("error is not null").select(key, "error")
    return cells.unionByName(failed, allowMissingColumns=True)
