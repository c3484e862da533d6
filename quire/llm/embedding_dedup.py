"""Embedding near-dedup by cross-polytope hashing.

A vector is rotated by three rounds of random signs and a fast Hadamard transform; its bucket is the axis, with
sign, to which it then points most. Several such hashes make one key of a table, and the vector also goes to the
keys in which one of its hashes is replaced by the second nearest axis (multiprobe). The number of hashes grows
with the logarithm of the number of vectors of a label, so that vectors that are not alike seldom share a key at
any size, and the number of tables grows with it, so that a pair at the threshold is missed with a probability
under 1e-4 in 64 dimensions and 1e-3 in 1024 (measured on random pairs at cosine 0.98). Vectors that meet under
a key and share a label are compared by cosine in double precision.

Equal vectors of a label are one class with a count, so copies are never paired. Only keys with several classes
travel with vectors. The members of a key are streamed in sorted order; a key with more members than
half a task's fair share (at least LEAST_BLOCK, at most MOST_BLOCK) is dealt out as pairs of blocks, each a group
of its own. Exact link counts need every pair of a group compared, so
a vector goes to each pair of blocks of its own once: as many copies as there are blocks, which is the least
possible with tasks of bounded memory. A pair that meets under several keys counts where the key is the least of
them. Of the pairs below the threshold nothing leaves a task, of the others a count per class and the forest that
connects them.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and those without a
label or id, link with nothing and are components of their own. Vectors of different lengths never link. Rows
that repeat an id are vectors of their own, each with its own row, whether they link or not. Very long vectors
are hashed like others, in batches of bounded size. An empty table gives an empty result. Columns besides id,
vector and label are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import components, materialize, per_batch
from quire.llm.textkit import U, mix

THRESHOLD = 0.98
#: fewest and most members of a block
LEAST_BLOCK, MOST_BLOCK = 256, 4096
#: fewest and most hashes in a key; axes that a key should have for each vector of a label
LEAST_HASHES, MOST_HASHES, ROOM = 2, 6, 16
#: groups up to this many members are compared as lists of pairs, many groups at once
SMALL, PAIRS, TILE = 48, 40_000, 512


def padded(d: int) -> int:
    """A power of two; short vectors are padded so that their rotations differ."""
    return 1 << max(4, (d - 1).bit_length())


def hashes(d: int, n: int) -> int:
    """How many hashes a key of vectors of length d has, where n is the size of the largest label."""
    wanted = math.ceil(math.log(max(2, ROOM * n)) / math.log(2 * padded(d)))
    return min(MOST_HASHES, max(LEAST_HASHES, wanted))


def tables(d: int, count: int) -> int:
    """Rotations of short vectors differ less, so they have more tables."""
    return (2 if d >= 16 else 4) * count


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row; the length is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        y = x.reshape(n, d // (2 * step), 2, step)
        x = np.concatenate((y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]), axis=2).reshape(n, d)
        step *= 2
    return x


def keys(x: np.ndarray, count: int) -> np.ndarray:
    """rows x tables x (1 + count) bucket keys; the first of each table is the vector's own."""
    n, d = x.shape
    size = padded(d)
    wide = np.zeros((n, size), np.float64)
    wide[:, :d] = x
    rows = np.arange(n)
    out = np.zeros((n, tables(d, count), 1 + count), U)
    for t in range(tables(d, count)):
        near, second = [], []
        for h in range(count):
            y = wide
            for turn in range(3):
                name = U(((t * MOST_HASHES + h) * 3 + turn) << 32) + np.arange(size, dtype=U)
                y = hadamard(y * np.where(mix(name + U(17)) & U(1), 1.0, -1.0))
            away = np.abs(y)
            best = away.argmax(axis=1)
            near.append((2 * best + (y[rows, best] < 0)).astype(U))
            away[rows, best] = -1
            best = away.argmax(axis=1)
            second.append((2 * best + (y[rows, best] < 0)).astype(U))
        for p in range(1 + count):
            code = np.full(n, t + 1, U)
            for h in range(count):
                code = mix(code * U(0x9E3779B97F4A7C15) + (second if p == h + 1 else near)[h] + U(1))
            out[:, t, p] = code
    return out


def _prepare(n: int, kind: str):
    """Rows to vec_id, digest, vector (bytes) and keys; the last three are null for vectors that cannot link."""
    item = np.dtype(kind)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, lists = batch.num_rows, batch.column("embedding")
        able = pc.and_(pc.is_valid(lists), pc.and_(batch.column("label").is_valid(), batch.column("vec_id").is_valid())).to_numpy(zero_copy_only=False)
        flat = lists.flatten()  # null lists have no values here
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        values = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
        total = lambda x: np.concatenate(([0], np.cumsum(x)))
        bad, some = total(~np.isfinite(values)), total(values != 0)
        able &= (sizes > 0) & (bad[ends] == bad[starts]) & (some[ends] > some[starts])
        labels = batch.column("label").to_pylist()
        digests: list = [None] * rows
        vectors: list = [None] * rows
        found: list = [None] * rows
        for d in np.unique(sizes[able]).tolist():
            own = np.flatnonzero(able & (sizes == d))
            step = max(1, (1 << 17) // d)
            for at in range(0, len(own), step):
                part = own[at : at + step]
                x = values[starts[part, None] + np.arange(d)] + 0.0  # one zero
                codes = keys(x / np.abs(x).max(axis=1, keepdims=True), hashes(d, n)).reshape(len(part), -1)
                raw = x.astype(item)
                for i, row, code in zip(part.tolist(), raw, codes, strict=True):
                    label = labels[i].encode()
                    vectors[i] = row.tobytes()
                    digests[i] = blake2b(vectors[i], digest_size=16, key=blake2b(label, digest_size=32).digest()).digest()
                    found[i] = mix(code ^ U(xxhash.xxh3_64_intdigest(label, d))).view(np.int64)
        counts = np.array([0 if f is None else len(f) for f in found], np.int64)
        every = np.concatenate([f for f in found if f is not None]) if counts.any() else np.zeros(0, np.int64)
        at = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
        cols = [batch.column("vec_id"), pa.array(digests, pa.binary()), pa.array(vectors, pa.binary()), pa.ListArray.from_arrays(at, pa.array(every))]
        return pa.RecordBatch.from_arrays(cols, ["vec_id", "digest", "vector", "keys"])

    return run


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number in each one's component."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    while (root[root] != root).any():
        root = root[root]
    return root


def near_pairs(x: np.ndarray, start: np.ndarray, end: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of unit vectors, first < second, within the groups start..end, with a product of threshold or more."""
    many = end - start
    later = np.zeros(len(x), np.int64)  # members of the group after each row; groups of many are left to products
    group = np.repeat(np.arange(len(start)), many)
    small = many[group] <= SMALL
    later[small] = (end[group] - 1 - np.arange(len(x)))[small]
    before = np.concatenate(([0], np.cumsum(later)))
    first = 0
    while first < len(x) and before[-1] > before[first]:
        to = max(first + 1, int(np.searchsorted(before, before[first] + PAIRS, "right")) - 1)
        a = np.repeat(np.arange(first, to), later[first:to])
        b = a + 1 + np.arange(len(a)) - (before[a] - before[first])
        near = np.einsum("ij,ij->i", x[a], x[b]) >= threshold
        yield a[near], b[near]
        first = to
    for s, e in zip(start[many > SMALL].tolist(), end[many > SMALL].tolist(), strict=True):
        for i in range(s, e, TILE):
            a, b = np.nonzero(x[i : min(i + TILE, e)] @ x[i:e].T >= threshold)
            keep = a < b
            yield a[keep] + i, b[keep] + i


def _least_common(own: np.ndarray, other: np.ndarray, probes: int) -> np.ndarray:
    """The least key that two rows of keys have in common; keys of different tables are never equal."""
    a, b = own.reshape(len(own), -1, probes, 1), other.reshape(len(other), -1, 1, probes)
    return np.where(a == b, a, np.iinfo(np.int64).max).reshape(len(own), -1).min(axis=1)


def _linked(rows: pa.Table, threshold: float, kind: str, n: int) -> pa.RecordBatch:
    """(class, copies linked, smallest class of its links here) of whole groups, sorted by group and class."""
    column = lambda c: rows.column(c).combine_chunks().to_numpy(zero_copy_only=False)
    sizes = pc.binary_length(rows.column("vector")).to_numpy()
    reps, counts, tops = [], [], []
    for width in np.unique(sizes).tolist():  # of one key they are alike, but for a collision
        own = rows.filter(pa.array(sizes == width)) if (sizes != width).any() else rows
        column = lambda c: own.column(c).combine_chunks().to_numpy(zero_copy_only=False)  # noqa: B023, E731
        key, low, high, rep, many, block = (column(c) for c in ("key", "low", "high", "rep", "copies", "block"))
        d = width // np.dtype(kind).itemsize
        x = np.frombuffer(b"".join(own.column("vector").to_pylist()), kind).reshape(-1, d).astype(np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        codes = own.column("keys").combine_chunks().flatten().to_numpy().reshape(len(x), -1)
        new = np.ones(len(x), bool)
        new[1:] = (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        start = np.flatnonzero(new)
        links: list[tuple[np.ndarray, np.ndarray]] = []
        for a, b in near_pairs(x, start, np.append(start[1:], len(x)), threshold):
            ok = (low[a] == high[a]) | (block[a] != block[b])
            a, b = a[ok], b[ok]
            for at in range(0, len(a), PAIRS // 2):
                p, q = a[at : at + PAIRS // 2], b[at : at + PAIRS // 2]
                here = _least_common(codes[p], codes[q], 1 + hashes(d, n)) == key[p]
                links.append((p[here], q[here]))
        a, b = (np.concatenate([x[i] for x in links]) if links else np.zeros(0, np.int64) for i in (0, 1))
        if len(a):
            root = roots(len(x), a, b)
            count = np.bincount(a, many[b], len(x)) + np.bincount(b, many[a], len(x))
            met = np.flatnonzero(count)
            reps.append(rep[met])
            counts.append(count[met].astype(np.int64))
            tops.append(rep[root[met]])
    cat = lambda v: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64())
    return pa.RecordBatch.from_arrays([cat(reps), cat(counts), cat(tops)], ["rep", "n", "root"])


def _compare(threshold: float, kind: str, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []  # the group that is not known to have ended
        last: tuple = ()
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = [batch.column(c).to_numpy() for c in ("key", "low", "high")]
            ended = np.zeros(batch.num_rows, bool)
            for c in ids:
                ended |= c != c[-1]
            cut = int(np.flatnonzero(ended)[-1]) + 1 if ended.any() else 0
            if cut:
                yield _linked(pa.Table.from_batches([*kept, batch.slice(0, cut)]), threshold, kind, n)
                kept = []
            elif kept and last != tuple(c[-1] for c in ids):
                yield _linked(pa.Table.from_batches(kept), threshold, kind, n)
                kept = []
            kept.append(batch.slice(cut))
            last = tuple(c[-1] for c in ids)
        if kept:
            yield _linked(pa.Table.from_batches(kept), threshold, kind, n)

    return run


def similar(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, block: int | None = None) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept. block: most members of a block, if not by the tasks' share."""
    kind = "<f4" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "<f8"
    every = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"), F.col(label_col).cast("string").alias("label"))
    n = every.where("label is not null").groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    prepared = materialize(per_batch(every, _prepare(n, kind), "vec_id long, digest binary, vector binary, keys array<long>"), "vectors")
    able = prepared.where("digest is not null")
    classes = able.groupBy("digest").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"), F.first("keys").alias("keys"))
    # numbered once written: rows may repeat an id with other vectors, so the least id does not name a class
    classes = materialize(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    placed = classes.select("rep", F.explode(F.array_distinct("keys")).alias("key"))
    counted = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counted = materialize(counted, "shared")
    if block is None:
        share = (counted.agg(F.sum("n")).first()[0] or 0) // (2 * int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        block = min(MOST_BLOCK, max(LEAST_BLOCK, share))
    shared = placed.join(counted, "key").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    shared = shared.withColumn("block", F.pmod(F.xxhash64("rep", F.lit(3)), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = shared.select("rep", "key", "block", other).select("rep", "key", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    rows = dealt.join(classes.select("rep", "copies", "vector", "keys"), "rep").repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "rep")
    met = materialize(rows.select("key", "low", "high", "rep", "copies", "vector", "keys", "block").mapInArrow(_compare(threshold, kind, n), "rep long, n long, root long"), "met")
    comps = components(met.select(F.col("rep").alias("a"), F.col("root").alias("b")), "embeddings")
    own = classes.select("digest", "least", "copies", "rep").join(met.groupBy("rep").agg(F.sum("n").alias("links")), "rep", "left").join(comps, F.col("rep") == F.col("node"), "left")
    own = materialize(own.select("digest", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("comp", "rep").alias("comp")), "linked")
    least = own.groupBy("comp").agg(F.min("least").alias("component_id"))
    found = materialize(own.join(least, "comp").select("digest", "n_links", "component_id"), "found")  # read back, so that a large class is split in the join
    linked = able.select("vec_id", "digest").join(found, "digest").select("vec_id", "n_links", "component_id")
    alone = prepared.where("digest is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
