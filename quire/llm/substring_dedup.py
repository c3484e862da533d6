"""Repeated passages by content-defined chunking.

A gear hash of the last 16 bytes marks boundaries, about one in SPACING bytes. A boundary depends on those
bytes alone, so an insertion shifts boundaries without changing them, and two copies of a passage are cut alike
from their 17th byte on. A stretch of WINDOW bytes without a boundary, as in a run of one repeated word, is cut
where the hash is least, which depends on the bytes of the stretch alone. From every cut a chunk reaches to the
first cut at least CHUNK bytes on; the first cut with fewer bytes than that before the text's end begins a chunk
that ends there, so the tail of a text and texts shorter than CHUNK are compared like all others. A chunk is known
by a cryptographic digest of 128 bits (BLAKE2b of its bytes): two different chunks among 10^12 share one with a
probability under 1e-14, and no one can make such a pair on purpose. A chunk whose digest occurs in more than one
document is repeated, and the smallest id that holds it is its first holder. Overlapping and touching repeated
chunks of a document make a passage, which is reported if it has ``min_span`` characters or more: one row for
every first holder of its chunks, with the part of the passage that is made of them (parts can overlap).

cut_copies takes out what another document holds first, so what is cut stays in its first holder or, where that
part is cut there too, in a still earlier one: nothing is cut everywhere.

Digests are counted per digest with partial sums on the map side and joined to their places; neither gathers a
common passage in one task.

Defined results: a null text is empty and has no spans. A text of any length is compared, however short or long.
A passage that repeats only within one document is not reported. Rows that repeat an id count as one document, so
equal texts under one id are no repeats; rows without an id hold nothing and have no spans (cut_copies leaves them
as they are). Of equal texts the one of the smallest id is the first holder. An empty table gives an empty result.
Columns besides id and text are ignored.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import free_name, id_and_text, materialize, per_batch, utf8_slices
from quire.llm.textkit import GEAR_WINDOW, gear

SPACING, CHUNK, WINDOW = 16, 80, 64
#: characters of a passage that is worth reporting: some less than 50 short words, since a span may lack a few at either end
MIN_SPAN = 170


def _sliding(x: np.ndarray, n: int, pick) -> np.ndarray:
    """pick over every n values in a row, n a power of two; n - 1 values shorter than x."""
    step = 1
    while step < n:
        x = pick(x[:-step], x[step:])
        step *= 2
    return x


def _forced(key: np.ndarray) -> np.ndarray:
    """Where a key is the least of some WINDOW keys in a row, none of them 0; places with the largest key are no cuts.

    Keys of periodic text are tied in every period; of cuts less than SPACING bytes apart every n-th is kept, so that
    those kept are whole periods apart and chunks from them are alike.
    """
    if len(key) < WINDOW:
        return np.zeros(0, np.int64)
    least = _sliding(key, WINDOW, np.minimum)
    edge = np.zeros(WINDOW - 1, key.dtype)
    reach = _sliding(np.concatenate((edge, least, edge)), WINDOW, np.maximum)
    found = np.flatnonzero((reach == key) & (key > 0) & (key < np.iinfo(key.dtype).max))
    if not len(found):
        return found
    gap = np.diff(found, prepend=found[0] - SPACING, append=found[-1] + SPACING)
    before, after = gap[:-1], gap[1:]
    first = np.flatnonzero((before >= SPACING) | (before != after))
    run = np.searchsorted(first, np.arange(len(found)), "right") - 1
    return found[(np.arange(len(found)) - first[run]) % -(-SPACING // after[first][run]) == 0]


def boundaries(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the cuts of all texts of a buffer, their starts and ends included; the text that each begins in."""
    key = gear(data)
    key = np.where((key >> np.uint32(16)) % np.uint32(SPACING) == 0, np.uint32(0), key | np.uint32(1))
    never = np.iinfo(np.uint32).max
    key[:-1][(data[1:] & 0xC0) == 0x80] = never  # whole characters
    key[-1] = never
    for i in range(-1, GEAR_WINDOW - 1):  # the hash of a text's first bytes reads the text before
        at = offsets[:-1] + i
        key[at[(at >= 0) & (at < len(key))]] = never
    cuts = np.concatenate((np.flatnonzero(key == 0), _forced(key))) + 1
    at = np.unique(np.concatenate((cuts, offsets)))
    return at, np.searchsorted(offsets, at, "right") - 1


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and texts of the chunks of all texts of a buffer."""
    at, own = boundaries(data, offsets)
    to = np.searchsorted(at, at + CHUNK)
    text_end = offsets[np.minimum(own + 1, len(offsets) - 1)]
    whole = to < len(at)
    whole[whole] = at[to[whole]] <= text_end[whole]
    late = np.flatnonzero(~whole & (at < text_end))
    tails = late[np.unique(own[late], return_index=True)[1]]
    end = np.concatenate((at[to[whole]], text_end[tails]))
    return np.concatenate((at[whole], at[tails])), end, np.concatenate((own[whole], own[tails]))


def _chunks(batch: pa.RecordBatch) -> pa.RecordBatch:
    ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
    digests, docs, places = [], [], []
    for first, offsets, data in utf8_slices(batch.column("text")):
        if not len(data):
            continue
        start, end, own = cut(data, offsets)
        raw = data.tobytes()
        digests.append(b"".join([blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(start.tolist(), end.tolist(), strict=True)]))
        characters = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        base = characters[offsets[own]]
        docs.append(ids[first + own])
        places.append((characters[start] - base) << 32 | (characters[end] - base))
    both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    cat = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (both[:, 0].copy(), both[:, 1].copy(), cat(docs), cat(places))], ["d1", "d2", "doc_id", "place"])


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """d1, d2 (the digest), doc_id, place (start << 32 | end, in characters) of every chunk."""
    return per_batch(id_and_text(docs, id_col, text_col).where("doc_id is not null"), _chunks, "d1 long, d2 long, doc_id long, place long")


def _islands(spans: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Numbers the groups of overlapping or touching spans (s, e) of each key."""
    order = Window.partitionBy(*keys).orderBy("s", "e")
    reach = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = spans.withColumn("new", F.when(F.col("s") <= reach, 0).otherwise(1))
    return new.withColumn(name, F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("new")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_span: int = MIN_SPAN) -> DataFrame:
    """doc_id, span_start, span_end, first_doc_id, is_copy: the parts of repeated passages, by their first holder.

    is_copy tells that the first holder is another document.
    """
    found = chunks(docs, id_col, text_col)
    digest = ["d1", "d2"]
    repeated = found.groupBy(*digest).agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last")).where("first_doc_id < last").drop("last")
    repeated = materialize(repeated, "digests")  # read back, so that a common passage is split in the join
    places = found.join(repeated, digest).select("doc_id", "first_doc_id", F.shiftright("place", 32).alias("s"), F.col("place").bitwiseAND(0xFFFFFFFF).alias("e")).repartition("doc_id")
    parts = _islands(places, ["doc_id", "first_doc_id"], "part").groupBy("doc_id", "first_doc_id", "part").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    passages = _islands(parts, ["doc_id"], "passage")
    whole = Window.partitionBy("doc_id", "passage")
    wide = passages.withColumn("size", F.max("e").over(whole) - F.min("s").over(whole)).where(F.col("size") >= min_span)
    return wide.select("doc_id", F.col("s").alias("span_start"), F.col("e").alias("span_end"), "first_doc_id", (F.col("first_doc_id") < F.col("doc_id")).alias("is_copy"))


def cut_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_span: int = MIN_SPAN) -> DataFrame:
    """docs without the text that another document holds first; other columns and rows unchanged."""
    mark, own = free_name(docs, "copied_id"), free_name(docs, "copied_spans")
    copied = repeated_spans(docs, id_col, text_col, min_span).where("is_copy").select("doc_id", F.col("span_start").alias("s"), F.col("span_end").alias("e"))
    merged = _islands(copied, ["doc_id"], "span").groupBy("doc_id", "span").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    spans = merged.groupBy(F.col("doc_id").alias(mark)).agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias(own))
    n = F.size(own)
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(own, lambda x: x["e"]))
    ends = F.concat(F.transform(own, lambda x: x["s"]), F.array(F.length(text_col).cast("long")))
    kept = F.transform(F.sequence(F.lit(0), n), lambda i: F.substring(F.col(text_col), F.get(starts, i).cast("int") + 1, (F.get(ends, i) - F.get(starts, i)).cast("int")))
    joined = docs.join(spans, docs[id_col].cast("long") == F.col(mark), "left")
    return joined.withColumn(text_col, F.when(F.col(own).isNull(), F.col(text_col)).otherwise(F.array_join(kept, ""))).select(*docs.columns)
