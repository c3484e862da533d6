"""Exact token counts of every prefix of a text, by dynamic programming over prefixes.

In byte-pair encoding the encoding of a prefix ends in one token, and what precedes it is the encoding of the
shorter prefix. So ``count[i] = count[j] + 1`` for the one token that spans j..i and may follow the last token
of prefix j. Two tokens may be neighbours exactly when encoding their joined text gives the two of them; that
is decided once a pair. One pass gives the count of tokens of every prefix, so "how many tokens has text[:p]"
and "how many characters fit n tokens" are look-ups.

Merges never cross a place whose two characters no vocabulary entry holds side by side; a text is cut there
and the tables of its segments follow each other. The table of a text is stored as one signed byte a character, by
how much the count changes there, and every answer comes from it: the count of the whole text is the sum, the
longest prefix within a budget ends before the running sum first exceeds it. Tables of frequent segments are kept
in a bounded cache.

Counts equal the library's encoding of each prefix (no begin, end or added tokens). Defined results: a null text is
empty and has an empty table, no tokens and a prefix of 0 characters; characters outside the vocabulary count their
UTF-8 bytes. A very long text has a table as long as itself and is handled alone. Rows that repeat an id, and rows
without one, are counted each for itself. An empty table gives an empty result. Columns besides id and text are
ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from quire.llm.common import holds_cache, id_and_text, per_batch

MODEL, LIMIT = "piece_bpe_32k.model", 4096
SPACE = "▁"
CACHED, FRESH, CACHED_LENGTH, TOGETHER = 250_000, 100_000, 64, 1 << 22


class _Endings(dict):
    def __missing__(self, key: str) -> tuple[int, ...]:
        return (1,)


class PrefixCounter:
    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(sp.get_piece_size())
        plain = [i for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        ends: dict[str, set[int]] = defaultdict(set)
        for p in self.score:
            ends[p[-2:]].add(len(p))
        #: by the last two characters of a prefix, the lengths that its last token can have, longest first
        self.endings = _Endings({k: tuple(sorted(v | {1}, reverse=True)) for k, v in ends.items()})
        self.joined = {p[k : k + 2] for p in self.score for k in range(len(p) - 1)}
        if sp.normalize("A  Åﬁ½") != f"{SPACE}A{SPACE}{SPACE}Åﬁ½" or any(b[1] == SPACE != b[0] for b in self.joined):
            raise ValueError("the model rewrites texts or joins words; segments would not be independent")
        self.segments = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall
        if max(map(len, self.score)) > 120:
            raise ValueError("a count could change by more than a byte holds")
        self.neighbours: dict[tuple[str, str], bool] = {}
        # tables of parts: those asked for more than once, and those asked for lately in two generations
        self.known: dict[str, bytes] = {}
        self.fresh: dict[str, bytes] = {}
        self.stale: dict[str, bytes] = {}

    def _encode(self, text: str) -> list[str]:
        """Plain merging of a short string: best score first, leftmost among equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _may_follow(self, left: str, right: str) -> bool:
        found = self._encode(left + right) == [left, right]
        if len(self.neighbours) > 4 * CACHED:
            self.neighbours.clear()
        self.neighbours[left, right] = found
        return found

    def _changes(self, segments: set[str]) -> dict[str, bytes]:
        """By how much the count of tokens of segment[:i] changes at each i from 1, for segments in which merges are
        possible everywhere. They are taken in order, so that one goes on from what it has in common with the one before."""
        score, endings, known, may_follow = self.score, self.endings, self.neighbours.get, self._may_follow
        counts, last, changes, before, out = [0], [None], bytearray(), "", {}
        for segment in sorted(segments):
            n, most = 0, min(len(before), len(segment))
            while n < most and before[n] == segment[n]:
                n += 1
            del counts[n + 1 :], last[n + 1 :], changes[n:]
            for i in range(n + 1, len(segment) + 1):
                here, piece = segment[i - 1], None
                if here not in score:
                    count = counts[-1] + len(here.encode("utf-8", "surrogatepass"))
                else:
                    for size in endings[segment[i - 2 : i] if i > 1 else here]:
                        j = i - size
                        if j >= 0 and (piece := segment[j:i]) in score:
                            left = last[j]
                            if left is not None:
                                follows = known((left, piece))
                                if follows or follows is None and may_follow(left, piece):
                                    break
                            elif j == 0 or segment[j - 1] not in score:
                                break
                    else:
                        raise AssertionError(f"no token ends at {i} of {segment!r}")
                    count = counts[j] + 1
                changes.append((count - counts[-1]) & 255)
                counts.append(count)
                last.append(piece)
            out[segment] = bytes(changes)
            before = segment
        return out

    def _new(self, parts: set[str]) -> dict[str, bytes]:
        """The tables of parts, put together from the segments between which no merge is possible."""
        joined, cut = self.joined, {}
        for part in parts:
            at = [k for k in range(1, len(part)) if part[k - 1 : k + 1] not in joined]
            cut[part] = [part[a:b] for a, b in pairwise([0, *at, len(part)])] if at else [part]
        found = self._changes({x for segments in cut.values() for x in segments})
        return {part: found[segments[0]] if len(segments) == 1 else b"".join([found[x] for x in segments]) for part, segments in cut.items()}

    def tables(self, texts: list[str]) -> list[bytes]:
        """The prefix table of each text: one signed byte a character."""
        if len(self.known) > CACHED:
            self.known = {}
        if len(self.fresh) > FRESH:
            self.stale, self.fresh = self.fresh, {}
        known, fresh, stale = self.known, self.fresh, self.stale
        split = [self.segments(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
        unknown = set().union(*split).difference(known)
        again = {p: some.pop(p) for some in (fresh, stale) for p in unknown & some.keys()}
        known.update(again)
        passing = self._new(unknown.difference(again))
        known.update(passing)
        # the first part begins with the space that the library puts before a text
        rows = [b"".join(map(known.__getitem__, parts)) for parts in split]
        for part, found in passing.items():
            del known[part]
            if len(part) <= CACHED_LENGTH:
                fresh[part] = found
        return [bytes([(raw[0] + raw[1]) & 255]) + raw[2:] if raw else b"" for raw in rows]

    def table(self, text: str) -> bytes:
        return self.tables([text])[0]


def counts(table: bytes) -> np.ndarray:
    """Token counts of text[:p] for p = 0..len(text)."""
    out = np.zeros(len(table) + 1, np.int32)
    np.cumsum(np.frombuffer(table, np.int8), dtype=np.int32, out=out[1:])
    return out


def fit(table: bytes, budget: int) -> int:
    """The longest prefix, in characters, of which no prefix has more than ``budget`` tokens."""
    over = counts(table) > budget
    return int(over.argmax()) - 1 if over.any() else len(table)


@lru_cache(maxsize=2)
def counter(model_file: str) -> PrefixCounter:
    return PrefixCounter(model_file)


holds_cache("tokens", counter.cache_clear)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_file: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_chars, prefix_table of every whole text.

    fit_chars is the longest prefix within the limit; prefix_table is what counts() and fit() read for any other.
    """
    model_file = model_file or default_model()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, texts = counter(model_file), batch.column("text")
        cols: list[list] = [[], [], [], []]
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < len(texts):  # texts of some megabytes together; a longer one alone
            to = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + TOGETHER, "right")))
            part = texts.slice(first, to - first).to_pylist()
            first = to
            for table in own.tables(part):
                n = counts(table)
                within = len(table) if n.max() <= limit else int((n > limit).argmax()) - 1
                for col, value in zip(cols, (int(n[-1]), int(n[-1]) > limit, within, table), strict=True):
                    col.append(value)
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.binary())
        size = pc.binary_length(texts).cast(pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), size, *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars", "prefix_table"])

    return per_batch(id_and_text(docs, id_col, text_col), run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long, prefix_table binary", "tokens")
