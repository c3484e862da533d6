"""Exact dedup by content-defined chunk recipes.

A text is cut where a gear hash of the last 16 bytes says so, so equal texts are cut alike. Each chunk has a
64-bit key; the dictionary step brings every distinct chunk together once, under its key, and looks whether a
key stands for more than one byte string. A key that stands for exactly one is a verified identifier. Texts
are then compared by their ordered lists of keys. Texts that hold an unverified key are compared by their
bytes as well, so a collision can never join two different texts.

Long documents do not move: only distinct chunks are shuffled, once, after each task has dropped its own
repeats; everything after that handles eight bytes a chunk.

Defined results: a null text is an empty text; all empty texts are equal. Of equal texts the largest id stays;
a row repeated with the same id is marked like its twin. Null ids are allowed and lose to any other. A very long
text is cut into more chunks, none above MAX_CHUNK bytes. An empty table gives an empty result. Columns besides id
and text are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import free_name, id_and_text, materialize, per_batch, utf8_slices
from quire.llm.textkit import GEAR_WINDOW, LOWER, gear

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_CHUNK, AVERAGE_CHUNK, MAX_CHUNK = 256, 2048, 16384


def cut(buf: np.ndarray, hashes: np.ndarray) -> list[int]:
    """Ends of the chunks of one text. Only the text's own bytes count: no cut within the first window."""
    candidates = np.flatnonzero((hashes >> np.uint32(16)) % np.uint32(AVERAGE_CHUNK) == 0) + 1
    ends, last, n = [], 0, len(buf)
    for c in (*candidates.tolist(), n):
        while c - last > MAX_CHUNK:
            last += MAX_CHUNK
            ends.append(last)
        if c == n or c - last >= MIN_CHUNK:
            if c > last:
                ends.append(c)
            last = c
    return ends


def _texts(batch: pa.RecordBatch):
    """(row, lower-cased bytes, chunk ends) of each text."""
    for first, offsets, data in utf8_slices(batch.column("text")):
        data = LOWER[data]
        hashes = gear(data)
        for i in range(len(offsets) - 1):
            a, b = int(offsets[i]), int(offsets[i + 1])
            own = data[a:b]
            # the first window of a text would see its neighbour in the buffer; chunks are never that short
            h = hashes[a:b]
            assert GEAR_WINDOW <= MIN_CHUNK
            yield first + i, own, cut(own, h)


def _recipes(batch: pa.RecordBatch) -> pa.RecordBatch:
    sha, size, keys = [], [], []
    for _, own, ends in _texts(batch):
        raw = own.tobytes()
        sha.append(hashlib.sha256(raw).hexdigest())
        size.append(len(raw))
        starts = [0, *ends[:-1]]
        keys.append(b"".join(xxhash.xxh3_64_digest(raw[s:e]) for s, e in zip(starts, ends, strict=True)) if ends else b"")
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(sha, pa.string()), pa.array(keys, pa.binary())], ["doc_id", "n_bytes", "text_sha256", "recipe"])


def _chunks(batch: pa.RecordBatch) -> pa.RecordBatch:
    found: dict[bytes, int] = {}
    for _, own, ends in _texts(batch):
        raw, last = own.tobytes(), 0
        for e in ends:
            found[raw[last:e]] = 0
            last = e
    own = list(found)
    keys = [int.from_bytes(xxhash.xxh3_64_digest(c), "big", signed=True) for c in own]
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(own, pa.binary())], ["key", "chunk"])


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, text_sha256, recipe: the ordered 8-byte chunk keys of the normalised text."""
    return per_batch(id_and_text(docs, id_col, text_col), _recipes, "doc_id long, n_bytes long, text_sha256 string, recipe binary")


def unverified_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Keys under which the dictionary holds more than one byte string; none, but for hash collisions."""
    chunks = per_batch(id_and_text(docs, id_col, text_col), _chunks, "key long, chunk binary")
    return chunks.distinct().groupBy("key").count().where("count > 1").select("key")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    bad = materialize(unverified_keys(docs, id_col, text_col), "chunk-collisions")
    own = materialize(recipes(docs, id_col, text_col), "recipes")
    n_keys = (F.length("recipe") / 8).cast("int")
    key_at = F.transform(F.sequence(F.lit(1), n_keys), lambda i: F.conv(F.hex(F.substring("recipe", (i - 1) * 8 + 1, F.lit(8))), 16, -10).cast("long"))
    # what tells apart texts whose recipe holds an unverified key: their bytes; empty for all others
    # ids may be null, so they are compared null-safe
    suspects = own.where("length(recipe) > 0").select("doc_id", F.explode(key_at).alias("key")).join(bad, "key", "left_semi").select("doc_id").distinct()
    suspects = materialize(suspects, "suspects")
    plain = F.translate("text", UPPER, UPPER.lower())
    texts = id_and_text(docs, id_col, text_col)
    proof = texts.join(suspects, texts["doc_id"].eqNullSafe(suspects["doc_id"]), "left_semi").select(F.col("doc_id").alias("proof_id"), F.sha2(plain, 256).alias("proof_sha256"), plain.alias("proof")).distinct()
    own = own.join(proof, F.col("doc_id").eqNullSafe(F.col("proof_id")) & (F.col("text_sha256") == F.col("proof_sha256")), "left")
    own = own.withColumn("proof", F.coalesce("proof", F.lit(""))).drop("proof_id", "proof_sha256")
    groups = own.groupBy("n_bytes", "recipe", "proof").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = materialize(groups, "groups")  # read back, so that a large group of copies is split in the join
    return own.join(groups, ["n_bytes", "recipe", "proof"]).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without copies, all columns kept; rows repeated with the id that stays all stay."""
    mark = free_name(docs, "keep_id")
    kept = exact_groups(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias(mark))
    return docs.join(kept, docs[id_col].cast("long").eqNullSafe(F.col(mark)), "left_semi")
