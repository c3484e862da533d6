"""Candidate regions: best overlaps, order-dependent fusion, near duplicates, ground-truth matching.

What depends on the order of earlier choices is gathered per page (pages are small) and runs in Arrow batches of
many pages; all else is joins on the page with a geometric residual.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.geometry import iou, overlap_min

MATCH_IOU, MATCH_OVERLAP, SAME_DETECTION, SAME_TABLE, TRUTH_IOU = 0.25, 0.72, 0.80, 0.90, 0.25
Box = tuple[float, float, float, float]


def best_match(left: DataFrame, right: DataFrame, keys: list[str], threshold: float = MATCH_IOU) -> DataFrame:
    """For each left box the right box of its page with the largest (IoU, overlap), the first among equals.

    left: keys, left_id, left_box; right: keys, right_id, right_box. Left boxes without a match are left out.
    """
    both = left.join(right, keys).select(*keys, "left_id", "right_id", iou(F.col("left_box"), F.col("right_box")).alias("iou"), overlap_min(F.col("left_box"), F.col("right_box")).alias("overlap"))
    good = both.where(((F.col("iou") > 0) & (F.col("iou") >= threshold)) | (F.col("overlap") >= MATCH_OVERLAP))
    best = good.groupBy(*keys, "left_id").agg(F.max(F.struct("iou", "overlap", (-F.col("right_id")).alias("turn"))).alias("best"))
    return best.select(*keys, "left_id", (-F.col("best.turn")).alias("right_id"), F.col("best.iou").alias("iou"), F.col("best.overlap").alias("overlap_min"))


@dataclass
class Candidate:
    """What the members of a candidate have in common: the item that founded it, and the box around all."""

    anchor: Box
    box: Box
    native: list[int]
    detected: list[int]


def overlap_matrices(boxes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(IoU, share of the smaller) of every box with every other."""
    size = np.maximum(boxes[:, 2:] - boxes[:, :2], 0).prod(axis=1)
    low, high = np.maximum(boxes[:, None, :2], boxes[None, :, :2]), np.minimum(boxes[:, None, 2:], boxes[None, :, 2:])
    both = np.maximum(high - low, 0).prod(axis=2)
    return both / np.maximum(size[:, None] + size[None, :] - both, 1e-9), both / np.maximum(np.minimum(size[:, None], size[None, :]), 1e-9)


RANKS = {"passed": 0, "detected": 1, "repair": 2}


def founders(roles: list[str], iou_of: np.ndarray, share_of: np.ndarray, threshold: float) -> list[int]:
    """For each item, in the order in which items are dealt, the item that founded its candidate (maybe itself).

    An item goes to the founder it overlaps most, by (IoU, share of the smaller) and then by age, if it is near enough.
    A detection goes first to the oldest candidate with nearly the same detection, else only to candidates of native
    tables that have no detection yet.
    """
    owner: list[int] = []
    near = (iou_of > 0) & (iou_of >= threshold) | (share_of >= MATCH_OVERLAP)
    for i, role in enumerate(roles):
        open_ = [j for j in range(i) if owner[j] == j]
        if role == "detected":
            seen = [j for j in range(i) if roles[j] == "detected"]
            twins = [owner[j] for j in seen if iou_of[i, j] >= SAME_DETECTION]
            if twins:
                owner.append(min(twins))
                continue
            taken = {owner[j] for j in seen}
            open_ = [j for j in open_ if j not in taken]
        fits = [(iou_of[i, j], share_of[i, j], -j) for j in open_ if near[i, j]]
        owner.append(-max(fits)[2] if fits else i)
    return owner


def fuse(items: list[tuple[int, str, Box]], threshold: float = MATCH_IOU) -> list[Candidate]:
    """items: (id, 'passed' | 'detected' | 'repair', box) of one page, in any order. Sound native tables are dealt
    first, then detections, then failed tables, each from top to bottom."""
    dealt = sorted(items, key=lambda x: (RANKS[x[1]], x[2][1], x[2][0], x[0]))
    if not dealt:
        return []
    boxes = np.array([x[2] for x in dealt], float)
    owner = np.array(founders([x[1] for x in dealt], *overlap_matrices(boxes), threshold))
    out = []
    for i in np.unique(owner).tolist():
        members = np.flatnonzero(owner == i)
        around = (*boxes[members, :2].min(axis=0).tolist(), *boxes[members, 2:].max(axis=0).tolist())
        kinds = [[dealt[j][0] for j in members if (dealt[j][1] == "detected") == detected] for detected in (False, True)]
        out.append(Candidate(tuple(boxes[i].tolist()), around, *kinds))
    return sorted(out, key=lambda c: (c.anchor[1], c.anchor[0]))


def _per_group(rows: DataFrame, key: str, items: list[str], one: Callable, schema: list[tuple[str, pa.DataType]]) -> DataFrame:
    """one(key, items...) gives the output tuples of each group; each of items is a gathered list of structs."""
    gathered = rows.groupBy(key).agg(*[F.array_compact(F.collect_list(i)).alias(i) for i in items])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [row for group in zip(*(batch.column(c).to_pylist() for c in (key, *items)), strict=True) for row in one(*group)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, (_, kind) in enumerate(schema)], [n for n, _ in schema])

    names = {pa.int64(): "bigint", pa.string(): "string", pa.float64(): "double", pa.bool_(): "boolean", pa.list_(pa.int64()): "array<bigint>"}
    return gathered.mapInArrow(run, ", ".join(f"{n} {names[k]}" for n, k in schema))


def _box_of(item: dict) -> Box:
    return item["x0"], item["y0"], item["x1"], item["y1"]


CORNERS = ("x0", "y0", "x1", "y1")
BOX_COLUMNS = [f"box.{c} as {c}" for c in CORNERS]


def _struct(*columns: str):
    return F.struct(*[F.expr(c) for c in (*columns, *BOX_COLUMNS)])


def candidate_fusion(items: DataFrame, page: str = "page", threshold: float = MATCH_IOU) -> DataFrame:
    """items: page, id, role, box of what may enter fusion. One row per candidate."""
    own = items.select(F.col(page).cast("long").alias("page"), _struct("cast(id as bigint) as id", "role").alias("item"))

    def one(number: int, rows: list[dict]) -> Iterator[tuple]:
        for i, r in enumerate(fuse([(x["id"], x["role"], _box_of(x)) for x in rows], threshold), 1):
            yield number, f"p{number:04d}-candidate-{i:03d}", r.native, r.detected, *r.box

    ids = pa.list_(pa.int64())
    schema = [("page", pa.int64()), ("candidate_id", pa.string()), ("native_ids", ids), ("detection_ids", ids), *((c, pa.float64()) for c in CORNERS)]
    return _per_group(own, "page", ["item"], one, schema)


def near_duplicates(tables: DataFrame, page: str = "page") -> DataFrame:
    """tables: page, id, nrows, ncols, box. kept is false for a table that nearly equals an earlier kept one."""
    own = tables.select(F.col(page).cast("long").alias("page"), _struct("cast(id as bigint) as id", "nrows", "ncols").alias("item"))

    def one(number: int, rows: list[dict]) -> Iterator[tuple]:
        rows = sorted(rows, key=lambda x: x["id"])
        iou_of, _ = overlap_matrices(np.array([_box_of(r) for r in rows], float))
        kept: list[int] = []
        for i, r in enumerate(rows):
            alike = [j for j in kept if (rows[j]["nrows"], rows[j]["ncols"]) == (r["nrows"], r["ncols"])]
            new = not (iou_of[i, alike] > SAME_TABLE).any()
            kept += [i] if new else []
            yield number, r["id"], new

    return _per_group(own, "page", ["item"], one, [("page", pa.int64()), ("id", pa.int64()), ("kept", pa.bool_())])


def gt_match(truths: DataFrame, predictions: DataFrame, document: str = "doc") -> DataFrame:
    """truths: doc, id, page, box, prediction_id; predictions: doc, id, page, box. Each truth in its order takes the
    prediction it names, or the unused one of its page with the largest IoU if that is enough. One row per
    truth and per unused prediction (gt_id null)."""
    doc = F.col(document).cast("long").alias("doc")
    left = truths.select(doc, _struct("cast(id as bigint) as id", "page", "cast(prediction_id as bigint) as named").alias("truth"))
    right = predictions.select(doc, _struct("cast(id as bigint) as id", "page").alias("found"))

    def one(number: int, wanted: list[dict], offered: list[dict]) -> Iterator[tuple]:
        wanted, offered = (sorted(x, key=lambda r: r["id"]) for x in (wanted, offered))
        boxes = np.array([_box_of(r) for r in (*wanted, *offered)], float).reshape(-1, 4)
        iou_of = overlap_matrices(boxes)[0][: len(wanted), len(wanted) :]
        free = np.ones(len(offered), bool)
        ids, pages = np.array([p["id"] for p in offered]), np.array([p["page"] for p in offered])
        for t, near in zip(wanted, iou_of, strict=True):
            fits = free & ((ids == t["named"]) if t["named"] is not None else (pages == t["page"]) & (near >= TRUTH_IOU))
            # the first of the largest; a table that is named is one
            best = int(np.where(fits, near, -1.0).argmax()) if fits.any() else None
            if best is not None:
                free[best] = False
            yield number, t["id"], None if best is None else offered[best]["id"], None if best is None else float(near[best])
        for i in np.flatnonzero(free).tolist():
            yield number, None, offered[i]["id"], None

    schema = [("doc", pa.int64()), ("gt_id", pa.int64()), ("pred_id", pa.int64()), ("iou", pa.float64())]
    return _per_group(left.unionByName(right, allowMissingColumns=True), "doc", ["truth", "found"], one, schema)
