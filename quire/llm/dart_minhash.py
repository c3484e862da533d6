"""Near-dedup of texts by DartMinHash signatures, banded candidates and verified similarity.

Similarity is the weighted Jaccard of two texts' five-word shingles, weighted by how often each occurs.
A shingle of weight w owns the strip [0, w) of an endless plane whose other axis is rank. Darts hit every unit
of that strip as a Poisson process along the rank axis, with gaps drawn from hashes, so equal regions of two
texts receive the same darts. Each dart falls to one of SIGNATURE coordinates and each coordinate keeps its
earliest dart. Two texts agree in a coordinate with a probability equal to their similarity. Only darts below
a rank bound are thrown, about SIGNATURE * (ln SIGNATURE + 2) for any length of text; the bound is doubled for
the texts that have an empty coordinate.

Bands of ROWS coordinates give candidates. In each bucket all members are compared with the bucket's smallest
id, the hub, and not with each other; that settles most buckets. Where members of one bucket end in different
components, the distances to the hub rule out most of the rest: 1 - similarity is a metric, so two members whose
distances to the hub differ by more than 1 - threshold are not linked. Members that no distance rules out against
some member of another component are dealt out in blocks of bounded size and pairs of blocks, and each task
compares the members of its two blocks at once, as a product of incidence matrices. Buckets with the same members
left are settled once. Only links between components leave the task. So every pair that shares a bucket is
compared, ruled out by its distances, or known to be in one component.

Comparison moves texts, not shingles: the hub's text once for every SALT members and each member's text once for
each of its hubs, streamed through sorted partitions; in buckets that stay open, once for each block of the
members that are left. Those that lie at like distances from the hub and from each other, all below the threshold,
are the only ones whose comparison grows with the square of their number, since no pair of them can be skipped
without losing links.

Defined results: null and empty texts are linked with nothing. A text of fewer than five words is one shingle
of all its words; one without words is one shingle of its characters. A very long text is signed, moved and
compared whole, alone in its slice. Equal shingle weights are always linked. Rows that repeat an id are taken
for one document: what is linked to one of their texts is linked to the id, and each row has the class of its own
text. Rows without an id are never compared: their class and representative are null, and they are kept. Ties do not occur: the
smallest id names a class and stays. An empty table gives an empty result. Columns besides id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import components, free_caches, free_name, id_and_text, join_components, materialize, per_batch, trim, utf8_slices
from quire.llm.textkit import U, mix, occurrence, shingles

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 5
SIGNATURE = BANDS * ROWS
SALT = 256
#: distances to a hub are told apart in this many steps
STEPS = 50
#: fewest and most texts that a block is made for, most units of weight in it, and most entries of a matrix part
LEAST_TEXTS, MOST_TEXTS, BLOCK_UNITS, ENTRIES = 256, 1024, 400_000, 4_000_000
MASK = (1 << 64) - 1


def units(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, key) of each unit of weight: the n-th occurrence of a shingle has a key of its own."""
    doc, h = shingles(buf, offsets, WORDS)
    return doc, mix(h ^ occurrence(doc, h).astype(U) * U(0x9FB21C651E98DF25))


def _gap(key: np.ndarray) -> np.ndarray:
    """An exponential variate from each hash."""
    return -np.log(((mix(key) >> U(11)).astype(np.float64) + 1.0) * 2.0**-53)


def signatures(doc: np.ndarray, key: np.ndarray, texts: int) -> np.ndarray:
    """texts x SIGNATURE dart names; rows of texts without units are zero."""
    out = np.zeros((texts, SIGNATURE), U)
    weight = np.bincount(doc, minlength=texts).astype(np.float64)
    todo = np.flatnonzero(weight)
    bound = np.zeros(texts)
    bound[todo] = SIGNATURE * (np.log(SIGNATURE) + 2) / weight[todo]
    while len(todo):
        wanted = np.zeros(texts, bool)
        wanted[todo] = True
        own = wanted[doc]
        d, k = doc[own], key[own]
        rank, n = _gap(k + U(1)), 1
        darts = []
        while len(d):
            hit = rank <= bound[d]
            d, k, rank = d[hit], k[hit], rank[hit]
            darts.append((d, mix(k ^ U(n * 0xD1342543DE82EF95 & MASK)), rank))
            n += 1
            rank = rank + _gap(k + U(n * 0xA24BAED4963EE407 & MASK))
        d, name, rank = (np.concatenate(x) for x in zip(*darts, strict=True))
        place = d * SIGNATURE + (name % U(SIGNATURE)).astype(np.int64)
        late_first = np.argsort(rank)[::-1]  # the last write to a coordinate is its earliest dart
        flat, filled = out.reshape(-1), np.zeros(texts * SIGNATURE, bool)
        flat[place[late_first]] = name[late_first]
        filled[place] = True
        todo = todo[~filled.reshape(texts, SIGNATURE)[todo].all(axis=1)]
        bound[todo] *= 2
    return out


def _sign(batch: pa.RecordBatch) -> pa.RecordBatch:
    lowered = pc.utf8_lower(batch.column("text"))
    n = batch.num_rows
    weight, prints, bands = np.zeros(n, np.int64), np.zeros((n, 2), U), np.zeros((n, BANDS), U)
    turn = np.arange(1, ROWS + 1, dtype=U) * U(0x8CB92BA72F3D8DD7)
    for first, offsets, data in utf8_slices(lowered, 1 << 20):
        doc, key = units(data, offsets)
        m = len(offsets) - 1
        rows = slice(first, first + m)
        weight[rows] = np.bincount(doc, minlength=m)
        np.add.at(prints[rows, 0], doc, mix(key + U(3)))
        np.add.at(prints[rows, 1], doc, mix(key + U(5)))
        sig = signatures(doc, key, m).reshape(m, BANDS, ROWS)
        bands[rows] = mix((mix(sig) * turn).sum(axis=2, dtype=U) + np.arange(BANDS, dtype=U) * U(0xF1357AEA2E62A9C5))
    flat = pa.array(bands.view(np.int64).reshape(-1))
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32)), flat)
    cols = [batch.column("doc_id"), pa.array(weight), pa.array(prints[:, 0].view(np.int64)), pa.array(prints[:, 1].view(np.int64)), lists]
    return pa.RecordBatch.from_arrays(cols, ["doc_id", "weight", "print_a", "print_b", "bands"])


def text_units(texts: pa.Array, step: int = 256) -> Iterator[np.ndarray]:
    """The sorted units of each text; some texts at a time are lower-cased and cut into shingles together."""
    for first in range(0, len(texts), step):
        for _, offsets, data in utf8_slices(pc.utf8_lower(texts.slice(first, step)), 1 << 20):
            doc, key = units(data, offsets)
            yield from (np.sort(x) for x in np.split(key, np.searchsorted(doc, np.arange(1, len(offsets) - 1))))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    at = np.searchsorted(a, b) if len(a) else np.zeros(0, np.int64)
    both = int((a[np.minimum(at, len(a) - 1)] == b).sum()) if len(a) and len(b) else 0
    whole = len(a) + len(b) - both
    return both / whole if whole else 0.0


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (hub, salt, role): each hub's text precedes its members'."""
    free_caches()
    hub, own = None, np.zeros(0, U)
    for batch in batches:
        a, b, s = [], [], []
        for h, node, role, mine in zip(*(batch.column(c).to_pylist() for c in ("hub", "node", "role")), text_units(batch.column("text")), strict=True):
            if role == 0:
                hub, own = h, mine
            elif h == hub:
                a.append(h)
                b.append(node)
                s.append(similarity(own, mine))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.float64())], ["hub", "node", "similarity"])
    trim()


def compare_with_hubs(pairs: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """pairs: distinct (hub, node). The exact similarity of each; docs has doc_id and text."""
    salts = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / SALT).cast("int").alias("salts"))
    members = pairs.join(salts, "hub").select("hub", F.pmod(F.xxhash64("node"), "salts").cast("int").alias("salt"), "node", F.lit(1).alias("role"))
    hubs = salts.select("hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("hub").alias("node"), F.lit(0).alias("role"))
    need = materialize(members.unionByName(hubs), f"{name}-need")
    # a merge join at every size: what is moved must not depend on whether the ids happen to fit a broadcast
    rows = docs.hint("merge").join(need, docs.doc_id == need.node).select("hub", "salt", "role", "node", "text")
    dealt = rows.repartition("hub", "salt").sortWithinPartitions("hub", "salt", "role", "node")
    return materialize(dealt.mapInArrow(_compare, "hub long, node long, similarity double"), name)


def block_similarities(rows: list[np.ndarray]) -> np.ndarray:
    """The similarity of all pairs of unit sets: shared units by products of incidence matrices, part by part."""
    n = len(rows)
    sizes = np.array([len(r) for r in rows], np.float64)
    values, column, times = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    text = np.repeat(np.arange(n), sizes.astype(int))
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    text, column = text[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    text, column = text[order], column[order]
    both = np.zeros((n, n), np.float32)
    width, total = max(1, ENTRIES // n), int(shared.sum())
    for first in range(0, total, width):
        at, to = np.searchsorted(column, (first, first + width))
        part = np.zeros((n, min(width, total - first)), np.float32)
        part[text[at:to], column[at:to] - first] = 1
        both += part @ part.T
    whole = sizes[:, None] + sizes[None, :] - both
    return both / np.maximum(whole, 1)


def _settle(threshold: float):
    """Links between components of one group (band, low, high); rows are sorted by it."""

    def links(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        comps = np.array([r[1] for r in rows])
        if len(rows) < 2 or (comps == comps[0]).all():
            return
        near = block_similarities([r[2] for r in rows]) >= threshold
        a, b = np.nonzero(near & (comps[:, None] < comps[None, :]))
        seen = set()
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            if (comps[i], comps[j]) not in seen:
                seen.add((comps[i], comps[j]))
                yield rows[i][0], rows[j][0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_caches()
        group, rows = None, []
        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in ("band", "low", "high", "node", "comp")]
            for *key, node, comp, mine in zip(*columns, text_units(batch.column("text")), strict=True):
                if key != group:
                    found += links(rows) if group else ()
                    group, rows = key, []
                rows.append((node, comp, mine))
            yield _pairs(found)
        if group:
            yield _pairs(list(links(rows)))
        trim()

    return run


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])


def open_members(shared: DataFrame, labels: DataFrame, compared: DataFrame, threshold: float) -> DataFrame:
    """band, node, weight, comp of the members that may be linked to a member of another component of their bucket.

    Distances to the hub are counted in STEPS; a member is left if another component has one within 1 - threshold of
    it. Of buckets with the same members left one stays.
    """
    step = F.floor((1 - F.coalesce("similarity", F.lit(1.0))) * STEPS).cast("int")  # the hub itself is at 0
    near = shared.join(compared, ["hub", "node"], "left").join(labels, "node", "left")
    placed = materialize(near.select("band", "node", "weight", F.coalesce("comp", "node").alias("comp"), step.alias("step")), "placed")
    reach = int((1 - threshold) * STEPS) + 1
    around = Window.partitionBy("band").orderBy("step").rangeBetween(-reach, reach)
    rings = placed.groupBy("band", "step").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    rings = rings.select("band", "step", F.min("lo").over(around).alias("lo"), F.max("hi").over(around).alias("hi")).where("lo <> hi")
    left = placed.join(materialize(rings, "rings"), ["band", "step"])
    prints = [F.bit_xor(F.xxhash64("node", F.lit(salt))).alias(f"x{salt}") for salt in (1, 2)]
    members = left.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("units"), *prints)
    once = members.where("n > 1").groupBy("n", "units", "x1", "x2").agg(F.min("band").alias("band")).select("band", "n", "units")
    return left.select("band", "node", "comp").join(materialize(once, "open"), "band")


def settle_open_buckets(shared: DataFrame, labels: DataFrame, compared: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between components that share a bucket. shared: band, hub, node, weight."""
    left = materialize(open_members(shared, labels, compared, threshold), "open-members")
    # a task compares two blocks, so a block is half of what a task would have if all members were dealt evenly
    share = left.count() // (2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    texts = min(MOST_TEXTS, max(LEAST_TEXTS, share))
    blocks = F.ceil(F.greatest(F.col("n") / texts, F.col("units") / BLOCK_UNITS)).cast("int")
    left = left.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node", "band"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = left.select("band", "node", "comp", "block", other).select("band", "node", "comp", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    need = materialize(dealt, "open-need")
    rows = docs.hint("merge").join(need, docs.doc_id == need.node).select("band", "low", "high", "node", "comp", "text")
    rows = rows.repartition("band", "low", "high").sortWithinPartitions("band", "low", "high")
    return materialize(rows.mapInArrow(_settle(threshold), "a long, b long").distinct(), "settled")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id (smallest id of its component), rep_id (smallest id with the same
    shingle weights), kept (doc_id = class_id)."""
    docs = id_and_text(docs, id_col, text_col)
    known = docs.where("doc_id is not null")
    signed = materialize(per_batch(known, _sign, "doc_id long, weight long, print_a long, print_b long, bands array<long>"), "signatures")
    some = signed.where("weight > 0")
    same = ["weight", "print_a", "print_b"]
    reps = materialize(some.groupBy(*same).agg(F.min("doc_id").alias("rep_id")), "representatives")
    own = some.join(reps.withColumnRenamed("rep_id", "doc_id"), [*same, "doc_id"], "left_semi")
    banded = own.select(F.col("doc_id").alias("node"), "weight", F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub <> top").select("band", "hub")
    shared = materialize(banded.join(materialize(hubs, "hubs"), "band").select("band", "hub", "node", "weight"), "buckets")
    pairs = materialize(shared.where("hub <> node").select("hub", "node").distinct(), "candidates")
    compared = compare_with_hubs(pairs, known, "compared")
    found = compared.where(F.col("similarity") >= threshold)
    labels = components(found.select(F.col("hub").alias("a"), F.col("node").alias("b")), "near")
    labels = join_components(labels, settle_open_buckets(shared, labels, compared, known, threshold), "near")
    classes = reps.join(labels, reps.rep_id == labels.node, "left").select(*same, "rep_id", F.coalesce("comp", "rep_id").alias("class_id"))
    classes = materialize(classes, "classes")
    linked = some.select("doc_id", *same).join(classes, same).select("doc_id", "class_id", "rep_id")
    alone = signed.where("weight = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("rep_id"))
    unknown = docs.where("doc_id is null").select("doc_id", *(F.lit(None).cast("long").alias(c) for c in ("class_id", "rep_id")))
    return linked.unionByName(alone).unionByName(unknown).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each group, the one of the smallest id; all columns kept."""
    mark = free_name(docs, "near_id")
    kept = near_groups(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias(mark))
    return docs.join(kept, docs[id_col].cast("long").eqNullSafe(F.col(mark)), "left_semi")
