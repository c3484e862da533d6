"""Boxes as Column expressions: points, top-left origin, nullable.

A box is a struct of x0, y0, x1, y1. Everything here stays inside generated code; a null box has no area and
meets nothing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"
EPSILON = 1e-9


def box(x0, y0, x1, y1) -> Column:
    parts = zip(("x0", "y0", "x1", "y1"), (x0, y0, x1, y1), strict=True)
    return F.struct(*[(F.col(v) if isinstance(v, str) else v).cast("double").alias(k) for k, v in parts])


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def area(b: Column) -> Column:
    return _or_zero(F.greatest(F.lit(0.0), b.x1 - b.x0) * F.greatest(F.lit(0.0), b.y1 - b.y0))


def intersection(a: Column, b: Column) -> Column:
    wide = F.least(a.x1, b.x1) - F.greatest(a.x0, b.x0)
    high = F.least(a.y1, b.y1) - F.greatest(a.y0, b.y0)
    both = F.greatest(F.lit(0.0), wide) * F.greatest(F.lit(0.0), high)
    return F.when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(both)


def iou(a: Column, b: Column) -> Column:
    both = intersection(a, b)
    return both / F.greatest(area(a) + area(b) - both, F.lit(EPSILON))


def overlap_min(a: Column, b: Column) -> Column:
    """The share of the smaller box that lies in the other."""
    return intersection(a, b) / F.greatest(F.least(area(a), area(b)), F.lit(EPSILON))


def center_in(inner: Column, outer: Column, margin: float = 0.0) -> Column:
    """Whether the centre lies in the outer box, edges included; never for null boxes."""
    cx, cy = (inner.x0 + inner.x1) / 2, (inner.y0 + inner.y1) / 2
    inside = (cx >= outer.x0 - margin) & (cx <= outer.x1 + margin) & (cy >= outer.y0 - margin) & (cy <= outer.y1 + margin)
    return F.coalesce(inside, F.lit(False))


def union_of(b: Column) -> Column:
    """Aggregate: the box around all boxes."""
    return box(F.min(b.x0), F.min(b.y0), F.max(b.x1), F.max(b.y1))


def rotate_ccw(b: Column, width: Column) -> Column:
    return box(b.y0, width - b.x1, b.y1, width - b.x0)


def unrotate_ccw(b: Column, width: Column) -> Column:
    return box(width - b.y1, b.x0, width - b.y0, b.x1)


def pixel_crop(b: Column, page: Column, image: Column, padding: int = 10) -> Column:
    """Points to whole pixels (towards zero), padded, clamped to the image; null where nothing remains.

    page and image are structs of width and height.
    """
    sx, sy = image.width / page.width, image.height / page.height
    left = F.greatest(F.lit(0), (b.x0 * sx).cast("int") - padding)
    top = F.greatest(F.lit(0), (b.y0 * sy).cast("int") - padding)
    right = F.least(image.width.cast("int"), (b.x1 * sx).cast("int") + padding)
    bottom = F.least(image.height.cast("int"), (b.y1 * sy).cast("int") + padding)
    crop = F.struct(left.alias("left"), top.alias("top"), right.alias("right"), bottom.alias("bottom"))
    return F.when((right > left) & (bottom > top), crop)


def polygon_box(points: Column, sx: Column | None = None, sy: Column | None = None) -> Column:
    """The box around an array of points (structs of x and y), scaled to points where scales are given."""
    sx, sy = F.lit(1.0) if sx is None else sx, F.lit(1.0) if sy is None else sy
    xs, ys = F.transform(points, lambda p: p.x), F.transform(points, lambda p: p.y)
    return box(F.array_min(xs) / sx, F.array_min(ys) / sy, F.array_max(xs) / sx, F.array_max(ys) / sy)
