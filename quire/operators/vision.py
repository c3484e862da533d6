"""Evidence of ruled grids in rasters, by run lengths in NumPy.

Opening with a line of n pixels keeps exactly the runs of at least n pixels, so it is a run-length filter along
one axis. Runs of neighbouring lines that touch are one rule (eight neighbours), measured by its extent.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_KERNEL, KERNEL_SHARE, RULE_SHARE, RULES, CROSSINGS, PADDING = 12, 18, 0.35, 3, 8, 10


def otsu(gray: np.ndarray) -> int:
    """The threshold of largest between-class variance."""
    histogram = np.bincount(gray.reshape(-1), minlength=256).astype(float)
    weight = np.cumsum(histogram)
    mean = np.cumsum(histogram * np.arange(256))
    with np.errstate(divide="ignore", invalid="ignore"):
        between = (mean[-1] * weight / weight[-1] - mean) ** 2 / (weight * (weight[-1] - weight))
    return int(np.nanargmax(np.where(np.isfinite(between), between, -1.0)))


def runs(mask: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(line, start, end) of the horizontal runs of at least ``least`` pixels."""
    edge = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    line, start = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    long = end - start >= least
    return list(zip(line[long].tolist(), start[long].tolist(), end[long].tolist(), strict=True))


def _rules(found: list[tuple[int, int, int]], extent: float) -> int:
    """How many connected groups of runs reach ``extent`` along the runs' axis."""
    root = list(range(len(found)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    by_line: dict[int, list[int]] = {}
    for i, (line, _, _) in enumerate(found):
        by_line.setdefault(line, []).append(i)
    for i, (line, a, b) in enumerate(found):
        for j in by_line.get(line - 1, ()):
            if found[j][1] <= b and a <= found[j][2]:
                root[top(i)] = top(j)
    spans: dict[int, tuple[int, int]] = {}
    for i, (_, a, b) in enumerate(found):
        lo, hi = spans.get(top(i), (a, b))
        spans[top(i)] = (min(lo, a), max(hi, b))
    return sum(hi - lo >= extent for lo, hi in spans.values())


def _painted(found: list[tuple[int, int, int]], shape: tuple[int, int]) -> np.ndarray:
    out = np.zeros(shape, bool)
    for line, a, b in found:
        out[line, a:b] = True
    return out


def grid_evidence(gray: np.ndarray) -> tuple[int, int, int, bool]:
    """(horizontal rules, vertical rules, crossing pixels, strong) of a grey raster with dark rules."""
    if gray.ndim != 2 or not gray.size:
        return 0, 0, 0, False
    high, wide = gray.shape
    dark = gray <= otsu(gray)
    if dark.all():
        dark = np.zeros_like(dark)
    across = runs(dark, max(LEAST_KERNEL, wide // KERNEL_SHARE))
    down = runs(dark.T, max(LEAST_KERNEL, high // KERNEL_SHARE))
    crossing = int((_painted(across, dark.shape) & _painted(down, dark.T.shape).T).sum())
    h, v = _rules(across, RULE_SHARE * wide), _rules(down, RULE_SHARE * high)
    return h, v, crossing, h >= RULES and v >= RULES and crossing >= CROSSINGS


def _gray(data: bytes, width: int, height: int, channels: int) -> np.ndarray:
    pixels = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    gray = pixels[:, :, 0] if channels == 1 else np.rint(pixels[:, :, :3].astype(float) @ np.array([0.114, 0.587, 0.299]))
    return gray.astype(np.uint8)


EVIDENCE = ["horizontal_rules", "vertical_rules", "intersection_pixels", "strong", "error"]
KINDS = "horizontal_rules int, vertical_rules int, intersection_pixels int, strong boolean, error string"


def visual_grid(rasters: DataFrame, key: str) -> DataFrame:
    """rasters: key, width, height, channels, data (rows of bytes). One row of evidence each; broken data is not strong."""
    own = rasters.select(F.col(key).alias("key"), "width", "height", "channels", "data")
    kind = own.schema["key"].dataType.simpleString()

    def run(frames):
        for pdf in frames:
            out = []
            for r in pdf.itertuples(index=False):
                try:
                    out.append((r.key, *grid_evidence(_gray(r.data, r.width, r.height, r.channels)), None))
                except (ValueError, TypeError) as problem:
                    out.append((r.key, 0, 0, 0, False, str(problem)))
            yield pd.DataFrame(out, columns=["key", *EVIDENCE])

    return own.mapInPandas(run, f"key {kind}, {KINDS}").withColumnRenamed("key", key)


BOX, CORNERS = ("x0", "y0", "x1", "y1"), ("left", "top", "right", "bottom")
RASTER = ("width", "height", "channels", "data", "page_width", "page_height")
NONE = (0, 0, 0, False)


def _crop(place: tuple, width: int, height: int, page_width: float, page_height: float, padding: int) -> tuple[int, int, int, int]:
    x0, y0, x1, y1 = place
    sx, sy = width / page_width, height / page_height
    left, top = max(0, int(x0 * sx) - padding), max(0, int(y0 * sy) - padding)
    return left, top, min(width, int(x1 * sx) + padding), min(height, int(y1 * sy) + padding)


def region_evidence(rasters: DataFrame, regions: DataFrame, page: str = "page", padding: int = PADDING) -> DataFrame:
    """The evidence of each region, measured in its crop of the page's raster.

    rasters: page, width, height, channels, data, page_width, page_height (in points); regions: page, id, box (in
    points). The crop is the box in pixels, widened by ``padding`` and kept within the raster; an empty one is not
    strong. A page's raster is read once for all its regions. Gives page, id, crop (left, top, right, bottom) and the
    evidence; regions of pages without a raster, and those without a box, have an error.

    Rasters are large once they are made, and small as Spark counts them: pages meet their regions one page at a time,
    so that no raster is broadcast and no batch holds many, in as many tasks as there are shuffle partitions.
    """
    parts = int(regions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = regions.select(F.col(page).cast("long").alias("page"), F.col("id").cast("long").alias("id"), *(F.col(f"box.{k}").cast("double").alias(k) for k in BOX)).repartition(parts, "page")
    drawn = rasters.where(F.col(page).isNotNull()).select(F.col(page).cast("long").alias("page"), *RASTER)

    def run(boxes: pa.Table, drawings: pa.Table) -> pa.Table:
        out: list[tuple] = []
        at, ids = boxes.column("page").to_pylist(), boxes.column("id").to_pylist()
        places = list(zip(*(boxes.column(k).to_pylist() for k in BOX), strict=True))
        for n in range(max(1, drawings.num_rows)) if at else ():
            try:
                width, height, channels, data, *points = (drawings.column(k)[n].as_py() for k in RASTER) if drawings.num_rows else (None,) * len(RASTER)
                gray, problem = _gray(data, width, height, channels), None
            except (ValueError, TypeError) as broken:
                gray, problem = None, str(broken) if drawings.num_rows else "no raster of the page"
            for key, i, place in zip(at, ids, places, strict=True):
                if gray is None:
                    out.append((key, i, *[None] * 4, *NONE, problem))
                    continue
                try:
                    crop = _crop(place, width, height, *points, padding)
                except (ValueError, TypeError, ArithmeticError) as broken:
                    out.append((key, i, *[None] * 4, *NONE, str(broken)))
                    continue
                left, top, right, bottom = crop
                empty = right <= left or bottom <= top
                found = (*NONE, "empty proposal crop") if empty else (*grid_evidence(gray[top:bottom, left:right]), None)
                out.append((key, i, *crop, *found))
        columns = zip(*out, strict=True) if out else [()] * len(kinds)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], list(kinds))

    kinds = {"page": pa.int64(), "id": pa.int64(), **dict.fromkeys(CORNERS, pa.int32()), **dict(zip(EVIDENCE, [*[pa.int32()] * 3, pa.bool_(), pa.string()], strict=True))}
    found = own.groupBy("page").cogroup(drawn.groupBy("page")).applyInArrow(run, f"page long, id long, {', '.join(f'{c} int' for c in CORNERS)}, {KINDS}")
    crop = F.when(F.col("left").isNotNull(), F.struct(*CORNERS))
    return found.withColumn("crop", crop).drop(*CORNERS).withColumnRenamed("page", page)
