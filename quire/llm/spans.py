"""Spans of whole texts in the form the scanning operators share."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame

from quire.llm.common import id_and_text, per_batch

Span = tuple[str, int, int]


def written(spans: list[Span], order: dict[str, int]) -> str:
    """kind:start:end by start, then kind as listed, comma-joined; code points, end exclusive."""
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], order[x[0]], x[2])))


def scan(docs: DataFrame, find: Callable[[str], tuple[list[Span], list[Span]]], base: tuple[str, ...], added: tuple[str, ...], id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_<kind> of each base kind, base_sha256, spans, n_added, n_total. find gives (base spans, added spans)."""
    order = {k: i for i, k in enumerate((*base, *added))}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: list[list[int]] = [[] for _ in base]
        sha, every, more, total = [], [], [], []
        for text in batch.column("text"):
            own, extra = find(text.as_py())
            for kind, col in zip(base, counts, strict=True):
                col.append(sum(s[0] == kind for s in own))
            sha.append(hashlib.sha256(written(own, order).encode()).hexdigest())
            every.append(written([*own, *extra], order))
            more.append(len(extra))
            total.append(len(own) + len(extra))
        cols = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(sha, pa.string()), pa.array(every, pa.string()), pa.array(more, pa.int64()), pa.array(total, pa.int64())]
        return pa.RecordBatch.from_arrays(cols, ["doc_id", *(f"n_{k}" for k in base), "base_sha256", "spans", "n_added", "n_total"])

    schema = ", ".join(["doc_id long", *(f"n_{k} long" for k in base), "base_sha256 string", "spans string", "n_added long", "n_total long"])
    return per_batch(id_and_text(docs, id_col, text_col), run, schema)
