"""Language identification by nearest centroid over normalised TF-IDF vectors of character n-grams.

A text's vector counts its n-grams of 1 to 3 characters (by bytes of the lower-cased text, digits and
punctuation as one mark, hashed to DIMENSIONS), damped by log, weighted by inverse document frequency and
scaled to length 1. Each language has up to CLUSTERS centroids, found by spherical k-means. A text goes to the
language of the most similar centroid. It is rejected when it is farther from it than any but a hundredth of
the training texts of similar length, by a wide margin (MARGIN), so ordinary texts of any language learned are
kept and strings without language are not.

The model is fitted on at most about SAMPLE texts a language and MOST_ROWS in all, chosen by a hash of their id
among labelled rows that are not held out, and on the MOST_LANGUAGES most frequent labels; these bounds are
parameters. So the driver's memory is bounded whatever the number of labels. Everything else covers every row and
whole texts.

Defined results: ``und`` and score 0 for a null text or one without a letter, and for every text if there was
nothing to learn from; such texts are rejected. Texts of less than 32 bytes, a few words, are never rejected for
their distance. Rows with a null language are not learned from; a row with a null id is predicted, not learned from
and not held out. Of languages that are equally near the first by name is predicted. A very long text gives one
vector like others. Rows that repeat an id are predicted each for itself. An empty table gives an empty result.
Other columns are ignored, or kept as they are by identify and keep_known.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import free_caches, free_name, per_batch, trim, utf8_slices
from quire.llm.textkit import U, mix

DIMENSIONS, CLUSTERS, SAMPLE, ROUNDS, MARGIN = 4096, 4, 1000, 12, 0.5
MOST_ROWS, MOST_LANGUAGES = 16_000, 1000
UNKNOWN = "und"
#: 0 white space and marks (one space), 1 digits as one, others themselves
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[48:58] = 48
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_SALT = (U(0x9E6C63D0676A9A99), U(0x8BB84B93962EACC9), U(0x4BE98134A5976FD3))


def vectors(texts: pa.Array) -> np.ndarray:
    """Damped counts, one row a text."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    for first, offsets, data in utf8_slices(pc.utf8_lower(texts), 1 << 20):
        n = len(offsets) - 1
        grams = _FOLD[data].astype(U)
        doc = np.repeat(np.arange(n), np.diff(offsets))
        own = np.zeros(n * DIMENSIONS, np.float32)
        code = grams
        for size in (1, 2, 3):
            if size > 1:
                code = code[:-1] * U(256) + grams[size - 1 :]
            if not len(code):
                break
            whole = doc[: len(code)] == doc[size - 1 :]
            place = (mix(code + _SALT[size - 1]) % U(DIMENSIONS)).astype(np.int64) + doc[: len(code)] * DIMENSIONS
            own += np.bincount(place[whole], minlength=n * DIMENSIONS).astype(np.float32)
        out[first : first + n] = np.log1p(own.reshape(n, DIMENSIONS))
    return out


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _length_class(texts: pa.Array) -> np.ndarray:
    size = pc.fill_null(pc.binary_length(texts.cast(pa.large_string())), 0).to_numpy(zero_copy_only=False)
    return np.minimum(np.log2(np.maximum(size, 1)).astype(int), 12)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    floor: np.ndarray  # by length class, the least similarity that is no rejection

    def nearest(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(language number, cosine)."""
        if not len(self.languages):
            return np.zeros(len(texts), int), np.zeros(len(texts))
        near = _scaled(vectors(texts) * self.idf) @ self.centroids.T
        best = near.argmax(axis=1)
        return self.owner[best], np.clip(near[np.arange(len(best)), best].astype(float), 0.0, 1.0)


def _cluster(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from evenly spaced rows; same rows, same centroids."""
    centre = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(ROUNDS):
        near = (x @ centre.T).argmax(axis=1)
        for c in range(len(centre)):
            if (near == c).any():
                centre[c] = x[near == c].mean(axis=0)
        centre = _scaled(centre)
    return centre


def fit(raw: np.ndarray, length_class: np.ndarray, languages: list[str], clusters: int = CLUSTERS) -> Model:
    """raw: the vectors of the training texts (scaled in place); length_class and languages of each."""
    names = sorted(set(languages))
    if not names:
        return Model([], np.ones(DIMENSIONS, np.float32), np.zeros((0, DIMENSIONS), np.float32), np.zeros(0, int), np.zeros(13))
    idf = np.log((1 + len(raw)) / (1 + np.count_nonzero(raw, axis=0))).astype(np.float32) + np.float32(0.1)
    x = raw
    x *= idf
    x /= np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x))[:, None], 1e-12)
    y = np.array([names.index(v) for v in languages])
    parts = [_cluster(x[y == i], clusters) for i in range(len(names))]
    centroids, owner = np.concatenate(parts), np.repeat(np.arange(len(names)), [len(p) for p in parts])
    near = (x @ centroids.T).max(axis=1)
    floor, least = np.zeros(13), 1.0
    for c in range(12, -1, -1):  # shorter texts are less alike; where few were seen the bound of the next longer holds
        if (length_class == c).sum() >= 20:
            least = min(least, MARGIN * float(np.quantile(near[length_class == c], 0.01)))
        floor[c] = least if least < 1.0 else 0.0
    floor[:5] = 0.0  # under 32 bytes, a few words; a few words say too little to be rejected
    return Model(names, idf, centroids, owner, floor)


def _packed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The vectors of texts as (places, half-precision values): a bounded number of bytes for any length of text."""
    texts = batch.column("text")
    out = []
    for first in range(0, len(texts), 256):
        for row in vectors(texts.slice(first, 256)):
            at = np.flatnonzero(row).astype(np.uint16)
            out.append(at.tobytes() + row[at].astype(np.float16).tobytes())
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(_length_class(texts), pa.int32()), pa.array(out, pa.binary())], ["doc_id", "lang", "size", "vector"])


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """Fit on at most about ``sample`` rows a language; only their vectors reach the driver."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    own = own.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}") & ~held_out("doc_id"))
    labels = own.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    wanted = min(sample, MOST_ROWS / max(1, len(labels)))
    share = {r["lang"]: wanted / r["n"] for r in labels}
    if not share:
        return fit(np.zeros((0, DIMENSIONS), np.float32), np.zeros(0, int), [])
    # a row is taken if its hash is below its language's share: no sort, no gathering of a large language
    turn = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) / 1_000_000.0
    bound = F.element_at(F.create_map(*[F.lit(v) for kv in sorted(share.items()) for v in kv]), F.col("lang"))
    taken = per_batch(own.where(turn < bound).select("doc_id", "text", "lang"), _packed, "doc_id long, lang string, size int, vector binary")
    rows = sorted(taken.collect(), key=lambda r: (r["lang"], r["doc_id"], r["vector"]))
    raw = np.zeros((len(rows), DIMENSIONS), np.float32)
    for i, r in enumerate(rows):
        both = np.frombuffer(r["vector"], np.uint16)
        at = both[: len(both) // 2]
        raw[i, at] = both[len(at) :].view(np.float16)
    return fit(raw, np.array([r["size"] for r in rows]), [r["lang"] for r in rows])


def identify(docs: DataFrame, model: Model, text_col: str = "text", prefix: str = "") -> DataFrame:
    """All columns of docs, then lang_pred, score and rejected, under names that docs does not have yet."""
    names = [free_name(docs, prefix + c) for c in ("lang_pred", "score", "rejected")]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is bounded by languages * CLUSTERS * DIMENSIONS
    at = docs.columns.index(text_col)

    def run(batches):
        free_caches()
        own = shared.value
        for batch in batches:
            texts = batch.column(at).cast(pa.string())
            lang, score = np.zeros(len(texts), int), np.zeros(len(texts))
            for first in range(0, len(texts), 256):
                lang[first : first + 256], score[first : first + 256] = own.nearest(texts.slice(first, 256))
            letters = pc.fill_null(pc.match_substring_regex(texts, "\\p{L}"), False).to_numpy(zero_copy_only=False) & bool(own.languages)
            names_of = np.array([*own.languages, UNKNOWN], object)
            pred = np.where(letters, names_of[lang], UNKNOWN)
            score = np.where(letters, score, 0.0)
            far = ~letters | (score < own.floor[_length_class(texts)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(far, pa.bool_())], [*batch.schema.names, *names])
        trim()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, `{names[0]}` string, `{names[1]}` double, `{names[2]}` boolean")


def predict(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every row."""
    model = train(docs, id_col, text_col, lang_col, sample)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return identify(own, model).drop("text")


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """docs without the rows that are rejected; columns unchanged."""
    model = train(docs, id_col, text_col, lang_col)
    found = identify(docs, model, text_col)
    rejected = found.columns[-1]
    return found.where(~F.col(rejected)).select(*docs.columns)
