"""Detected rows, columns and merged cells of a table to its cells.

The objects of one table overlap and repeat each other. Of rows (and of columns) that share most of their extent the
surer one stays; those that stay are numbered from top to bottom and from left to right, and cross in cells. A merged
cell takes in the cells of which it covers at least half, made up to a rectangle; surer ones come first, and none takes
a cell that is taken. Rows that lie mostly in a header's box are header rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed names of the classes of objects
ROW, COLUMN, MERGED, HEADER, PROJECTED = "table row", "table column", "table spanning cell", "table column header", "table projected row header"
LEAST_SCORE, SAME_EXTENT, COVERED = 0.5, 0.5, 0.5


def _axis(boxes: np.ndarray, scores: np.ndarray, low: int) -> np.ndarray:
    """The numbers of the objects that stay along an axis (low: 0 for columns, 1 for rows), in order."""
    start, end = boxes[:, low], boxes[:, low + 2]
    stay: list[int] = []
    for i in np.lexsort((start, -scores)).tolist():
        shared = [min(end[i], end[j]) - max(start[i], start[j]) for j in stay]
        least = [max(1e-9, min(end[i] - start[i], end[j] - start[j])) for j in stay]
        if end[i] > start[i] and not any(s / n > SAME_EXTENT for s, n in zip(shared, least, strict=True)):
            stay.append(i)
    return np.array(sorted(stay, key=lambda i: (start[i] + end[i], i)), int)


def _covered(inner: np.ndarray, outer: np.ndarray) -> np.ndarray:
    """How much of each inner box the outer one covers."""
    size = np.maximum(inner[..., 2:] - inner[..., :2], 0).prod(axis=-1)
    both = np.maximum(np.minimum(inner[..., 2:], outer[2:]) - np.maximum(inner[..., :2], outer[:2]), 0).prod(axis=-1)
    return both / np.maximum(size, 1e-9)


def cells_of(objects: list[tuple[str, float, tuple]], least: float = LEAST_SCORE) -> tuple[list[tuple[list[int], list[int], tuple, bool]], float]:
    """objects: (label, score, box). Cells as (row numbers, column numbers, box, header), and the mean score of rows and columns."""
    sure = [o for o in objects if o[1] >= least]
    of = lambda *labels: [o for o in sure if o[0] in labels]
    array = lambda found: np.array([o[2] for o in found], float).reshape(-1, 4)
    rows, columns = of(ROW), of(COLUMN)
    if not rows or not columns:
        return [], 0.0
    row_at, column_at = (_axis(array(x), np.array([o[1] for o in x]), low) for x, low in ((rows, 1), (columns, 0)))
    down, across = array(rows)[row_at], array(columns)[column_at]
    grid = np.zeros((len(down), len(across), 4))
    grid[:, :, 0], grid[:, :, 2] = across[None, :, 0], across[None, :, 2]
    grid[:, :, 1], grid[:, :, 3] = down[:, None, 1], down[:, None, 3]
    header = np.zeros(len(down), bool)
    for o in of(HEADER):
        header |= _covered(down, np.array(o[2], float)) >= COVERED
    taken = np.zeros(grid.shape[:2], bool)
    out = []
    for o in sorted(of(MERGED, PROJECTED), key=lambda o: (-o[1], o[2])):
        inside = _covered(grid, np.array(o[2], float)) >= COVERED
        if inside.sum() < 2:
            continue
        r, c = (np.flatnonzero(inside.any(axis=k)) for k in (1, 0))
        block = np.ix_(range(r[0], r[-1] + 1), range(c[0], c[-1] + 1))
        if not taken[block].any():
            taken[block] = True
            out.append((list(range(r[0], r[-1] + 1)), list(range(c[0], c[-1] + 1))))
    out += [([int(r)], [int(c)]) for r, c in zip(*np.nonzero(~taken), strict=True)]
    cells = []
    for r, c in sorted((([int(x) for x in r], [int(x) for x in c]) for r, c in out)):
        box = (*grid[r[0], c[0], :2].tolist(), *grid[r[-1], c[-1], 2:].tolist())
        cells.append((r, c, box, bool(header[r].all())))
    scores = [rows[i][1] for i in row_at] + [columns[i][1] for i in column_at]
    return cells, float(np.mean(scores))


def structures(objects: DataFrame, key: str, least: float = LEAST_SCORE) -> DataFrame:
    """objects: key, label, score, box. key, cell, row_nums, column_nums, x0, y0, x1, y1, header, confidence of each cell."""
    own = objects.groupBy(F.col(key).cast("long").alias("key")).agg(F.collect_list(F.struct("label", "score", "box.x0", "box.y0", "box.x1", "box.y1")).alias("objects"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, found in zip(batch.column("key").to_pylist(), batch.column("objects").to_pylist(), strict=True):
                cells, confidence = cells_of(sorted((o["label"], o["score"], (o["x0"], o["y0"], o["x1"], o["y1"])) for o in found), least)
                out += [(name, i, r, c, *box, header, confidence) for i, (r, c, box, header) in enumerate(cells)]
            ints, real = pa.list_(pa.int32()), pa.float64()
            kinds = [pa.int64(), pa.int32(), ints, ints, real, real, real, real, pa.bool_(), real]
            names = ["key", "cell", "row_nums", "column_nums", "x0", "y0", "x1", "y1", "header", "confidence"]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names)

    schema = "key long, cell int, row_nums array<int>, column_nums array<int>, x0 double, y0 double, x1 double, y1 double, header boolean, confidence double"
    return own.mapInArrow(run, schema).withColumnRenamed("key", key)
