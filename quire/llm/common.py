"""What the operators of this subpackage share: inputs, Arrow batches, linked components.

Intermediate results are written and read again (quire.tables), so a lost executor costs only the tasks it ran.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.tables import materialize, release


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator needs, under fixed names: other columns cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def free_name(df: DataFrame, base: str) -> str:
    """base, or base with underscores until df has no such column (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


_caches: dict[str, Callable[[], None]] = {}


def holds_cache(owner: str, clear: Callable[[], None]) -> None:
    """Note how to empty what an operator keeps in a Python worker between its tasks."""
    _caches[owner] = clear


def free_caches(owner: str = "") -> None:
    """Workers go on to tasks of other operators: what any but the owner keeps goes before they begin."""
    for name, clear in _caches.items():
        if name != owner:
            clear()


def trim() -> None:
    """Give memory that is free back to the system; the worker stays for other tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library has no such call
        return


def per_batch(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, owner: str = "") -> DataFrame:
    """fn of every batch; owner: whose caches the tasks use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_caches(owner)
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)
        trim()

    return df.mapInArrow(run, schema)


def utf8_slices(column: pa.Array, limit: int = 1 << 21) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets from 0, bytes) of runs of rows that hold about ``limit`` bytes; a longer text is a run alone."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        to = min(to, n)
        yield at, offsets[at : to + 1] - offsets[at], data[offsets[at] : offsets[to]]
        at = to


def _followed(parents: DataFrame) -> DataFrame:
    """Every node's parent's parent."""
    above = parents.select(F.col("node").alias("at"), F.col("up").alias("further"))
    return parents.join(above, parents["up"] == above["at"], "left").select("node", F.coalesce("further", "up").alias("up"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, comp): the smallest node reachable, for every node of an edge other than a loop.

    edges: (a, b), in any order, repeats allowed. In each round every node points to its smallest neighbour if
    that is smaller, pointers are followed to their parents' parents, and edges are drawn between what they
    point to; those within one vanish. Stars are done after one round, and chains shrink by more than half.
    Only the question whether edges remain reaches the driver.
    """
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    edges = materialize(edges.where("a <> b").select(low, high).distinct(), f"{name}-edges")
    labels = None
    while True:
        both = edges.union(edges.select("b", "a"))
        nearest = both.groupBy("a").agg(F.min("b").alias("near"))
        nearest = materialize(nearest.select(F.col("a").alias("node"), F.least("a", "near").alias("up")), f"{name}-parents")
        parents = materialize(_followed(nearest), f"{name}-parents")
        before = labels
        if labels is None:
            labels = materialize(parents.select("node", F.col("up").alias("comp")), name)
        else:
            moved = parents.select(F.col("node").alias("comp"), "up")
            labels = materialize(labels.join(moved, "comp", "left").select("node", F.coalesce("up", "comp").alias("comp")), name)
            release(before)
        of = lambda end: parents.select(F.col("node").alias(end), F.col("up").alias(f"up_{end}"))  # noqa: E731, B023
        drawn = edges.join(of("a"), "a").join(of("b"), "b").where("up_a <> up_b").select(F.least("up_a", "up_b").alias("a"), F.greatest("up_a", "up_b").alias("b"))
        left = materialize(drawn.distinct(), f"{name}-edges")
        release(edges, nearest, parents)
        edges = left
        if edges.isEmpty():
            release(edges)
            return labels


def join_components(labels: DataFrame, links: DataFrame, name: str = "components") -> DataFrame:
    """labels (node, comp) after further links (a, b); works on whole components, so only they travel."""
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    known = materialize(labels.union(ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("comp"))), name)
    of = lambda end: known.select(F.col("node").alias(end), F.col("comp").alias(f"comp_{end}"))
    between = links.join(of("a"), "a").join(of("b"), "b").select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b"))
    merged = components(between, name).select(F.col("node").alias("comp"), F.col("comp").alias("into"))
    return materialize(known.join(merged, "comp", "left").select("node", F.coalesce("into", "comp").alias("comp")), name)
