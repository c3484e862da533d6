"""Best-fit packing of token pieces into sequences, by matching of large items and best fit of small ones.

A document is its token ids and the end id 0; only documents longer than a sequence are cut. Packing looks at
lengths alone, and there are at most CAPACITY of them, so the plan is made from one count per length, whatever
the size of the corpus:

1. pieces above a third of the capacity go at most two to a sequence: from the largest down, each is matched
   with the largest that still fits beside it;
2. the others, from the largest down, go where the least room remains that holds them; a new sequence is
   opened only if none does.

The plan is a list of runs "pieces of length s ranked a..b go to sequences from q on, n in each, at offset o".
Its size is bounded by the number of lengths. The ranks of pieces within their length are computed without
gathering a length in one place: pieces are dealt to groups by their id, counted per group and length, and
ranked within; sums over groups give each group's first rank.

Defined results: a null or empty text is the end id alone. Rows with equal ids are documents of their own.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import holds_cache, id_and_text, materialize, per_batch

TOKENIZER, CAPACITY, END = "word_bpe_49k.json", 2048, (0).to_bytes(4, "little")
CACHED, FRESH, CACHED_LENGTH = 500_000, 150_000, 48
#: words of Latin-1 letters and a run of other signs, which the tokenizer always separates from each other; not
#: the apostrophe, which may begin a token with the letters after it, and the signs of special tokens
SEPARABLE = re.compile(r'([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?#$%&*+/=@^~()\[\]{}_"-]*)').fullmatch
#: a stop or comma after a letter or digit begins a token of its own; after another sign it may not
PLAIN_END, CROWDED = re.compile("(?<=[A-Za-z0-9À-ÖØ-öø-ÿ])(?=[.,])"), re.compile("[^A-Za-z0-9À-ÖØ-öø-ÿ \n][.,]").search


def chunks_of(text: str) -> list[str]:
    """Parts of a text between which the tokenizer never merges."""
    if CROWDED(text):
        text = PLAIN_END.sub(" ", text)
    else:
        text = text.replace(".", " .").replace(",", " ,")
    return text.replace("\n", " ").split(" ")


def _short(found: dict[str, bytes]) -> dict[str, bytes]:
    if max(map(len, found), default=0) <= CACHED_LENGTH:
        return found
    return {c: v for c, v in found.items() if len(c) <= CACHED_LENGTH}


class ChunkEncoder:
    """The tokenizer's ids of a text as bytes, put together from its space-separated chunks.

    The tokenizer drops white space and never merges across it, so chunks are independent; the ids of frequent
    chunks are kept in a bounded cache and all others come from the tokenizer itself.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        vocabulary = self.tokenizer.get_vocab()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        #: whether a token ends a word; a tokenizer that does not mark this is asked word by word
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        # chunks, and the words and signs that they are made of: those asked for more than once, and those asked for
        # lately in two generations
        self.known: dict[str, bytes] = {"": b""}
        self.fresh: dict[str, bytes] = {}
        self.stale: dict[str, bytes] = {}

    def _ask(self, texts: list[str]) -> dict[str, bytes]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return {t: np.array(e.ids, "<u4").tobytes() for t, e in zip(texts, got, strict=True)}

    def _ask_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words of Latin letters: one text of them all, cut after the tokens that end a word."""
        (got,) = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(got.ids, "<u4")
        at = [0, *(np.flatnonzero(self.ends[ids]) + 1).tolist()]
        if len(at) != len(words) + 1:
            return self._ask(words)
        raw = ids.tobytes()
        return {w: raw[4 * a : 4 * b] for w, a, b in zip(words, at, at[1:], strict=False)}

    def _learn(self, unknown: set[str]) -> dict[str, bytes]:
        """Ids of chunks that are not known. What is short is remembered, for good when it is asked for again."""
        known, fresh, stale = self.known, self.fresh, self.stale
        new = {c: some.pop(c) for some in (fresh, stale) for c in unknown & some.keys()}
        known.update(new)
        rest = unknown.difference(new) if new else unknown
        plain = {c: c.lower() for c in rest if c.isascii() and c.isalpha()}
        words = set(plain.values())
        hard, ended, signs = [], [], set()
        for c in rest.difference(plain):
            if m := SEPARABLE(c):
                w, p = m.groups()
                w = w.lower()
                ended.append((c, w, p))
                words.add(w)
                signs.add(p)
            else:
                hard.append(c)
        ids = {w: known.get(w) or fresh.get(w) or stale.get(w) for w in words}
        if ask := [w for w, v in ids.items() if v is None]:
            got = self._ask_words(ask)
            ids.update(got)
            fresh.update(_short(got))
        new.update(zip(plain, map(ids.__getitem__, plain.values()), strict=True))
        made = {c: ids[w] for c, w in plain.items() if c != w}
        if ended:
            ends = {p: known.get(p) for p in signs}
            if ask := [p for p, v in ends.items() if v is None]:
                got = self._ask(ask)
                ends.update(got)
                known.update(_short(got))
            made.update({c: ids[w] + ends[p] for c, w, p in ended})
        if hard:
            made.update(self._ask(hard))
        new.update(made)
        fresh.update(_short(made))
        return new

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > CACHED:
            self.known = {"": b""}
        if len(self.fresh) > FRESH:
            self.stale, self.fresh = self.fresh, {}
        split, known = [chunks_of(t) for t in texts], self.known
        new = self._learn(unknown) if (unknown := set().union(*split).difference(known)) else {}
        passing = new.keys() - known.keys()  # for these texts only
        known.update(new)
        out = [b"".join(map(known.__getitem__, chunks)) for chunks in split]
        for c in passing:
            del known[c]
        return out


@lru_cache(maxsize=2)
def encoder(file: str) -> ChunkEncoder:
    return ChunkEncoder(file)


holds_cache("packing", encoder.cache_clear)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_file: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    file = tokenizer_file or default_tokenizer()
    step = 4 * capacity

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cols: list[list] = [[], [], [], [], []]
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
        for first in range(0, len(ids), 256):
            for doc, raw in zip(ids[first : first + 256], encoder(file).encode(texts.slice(first, 256).to_pylist()), strict=True):
                raw += END
                for k, at in enumerate(range(0, len(raw), step)):
                    own = raw[at : at + step]
                    for col, value in zip(cols, (doc, k, at // 4, len(own) // 4, zlib.crc32(own)), strict=True):
                        col.append(value)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return per_batch(id_and_text(docs, id_col, text_col), run, "doc_id long, piece int, start long, length long, ids_crc32 long", "packing")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Runs (length, first rank, last rank + 1, first sequence, pieces in each, offset) and the number of sequences."""
    left = {s: n for s, n in counts.items() if n > 0}
    bins: list[tuple[int, int, list[tuple[int, int]]]] = []  # room, how many, [(length, pieces in each)]
    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        a = large[-1]
        mates = bisect_left(large, capacity - a + 1)
        b = large[mates - 1] if mates else None
        if b is None:
            bins.append((capacity - a, left.pop(a), [(a, 1)]))
            large.pop()
        elif b == a:
            n, odd = divmod(left.pop(a), 2)
            large.pop()
            if n:
                bins.append((capacity - 2 * a, n, [(a, 2)]))
            if odd:  # its own kind is used up: the next smaller one, if any, shares its sequence
                if large:
                    c = large[-1]
                    bins.append((capacity - a - c, 1, [(a, 1), (c, 1)]))
                    left[c] -= 1
                    if not left[c]:
                        left.pop(c)
                        large.pop()
                else:
                    bins.append((capacity - a, 1, [(a, 1)]))
        else:
            n = min(left[a], left[b])
            bins.append((capacity - a - b, n, [(a, 1), (b, 1)]))
            for s in (a, b):
                left[s] -= n
                if not left[s]:
                    left.pop(s)
                    large.remove(s)
    by_room: dict[int, list[tuple[int, list[tuple[int, int]]]]] = defaultdict(list)
    rooms: list[int] = []

    def put(room: int, n: int, content: list[tuple[int, int]]) -> None:
        if not by_room[room]:
            insort(rooms, room)
        by_room[room].append((n, content))

    for room, n, content in bins:
        put(room, n, content)
    for s in sorted(left, reverse=True):
        n = left[s]
        while n:
            at = bisect_left(rooms, s)
            if at == len(rooms):
                put(capacity, max(1, n // (capacity // s)), [])
                continue
            room = rooms[at]
            many, content = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
            each = min(room // s, n)
            used = min(many, n // each)
            put(room - each * s, used, [*content, (s, each)])
            if used < many:
                put(room, many - used, content)
            n -= used * each
    runs, sequence = [], 0
    rank: dict[int, int] = defaultdict(int)
    for room in sorted(by_room):
        for many, content in by_room[room]:
            offset = 0
            for s, each in content:
                runs.append((s, rank[s], rank[s] + many * each, sequence, each, offset))
                rank[s] += many * each
                offset += s * each
            sequence += many
    return runs, sequence


def pack(own: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """own: a written table of pieces. Adds sequence_id and offset; offsets in a sequence are gapless from 0."""
    spark = own.sparkSession
    counts = {r["length"]: r["n"] for r in own.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity rows
    runs, _ = plan(counts, capacity)
    table = np.array(sorted(runs), np.int64).reshape(-1, 6)
    sizes, firsts = table[:, 0].copy(), table[:, 1].copy()
    most = int(firsts.max(initial=0)) + 1

    groups = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = own.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    per = dealt.groupBy("length", "grp").agg(F.count(F.lit(1)).alias("n"))
    before = per.select("length", "grp", (F.sum("n").over(Window.partitionBy("length").orderBy("grp")) - F.col("n")).alias("base"))
    within = F.row_number().over(Window.partitionBy("length", "grp").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = dealt.withColumn("within", within).join(before, ["length", "grp"]).withColumn("rank", F.col("base") + F.col("within"))

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
        at = np.searchsorted(sizes * most + firsts, length * most + np.minimum(rank, most - 1), "right") - 1
        run = table[at]
        turn = rank - run[:, 1]
        sequence, offset = run[:, 3] + turn // run[:, 4], run[:, 5] + turn % run[:, 4] * length
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return per_batch(ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank"), place, schema)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_file: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return pack(materialize(pieces(docs, id_col, text_col, tokenizer_file, capacity), "pieces"), capacity)
