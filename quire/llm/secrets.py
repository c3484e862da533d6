"""Secret scans: fixed patterns, and two character Markov models compared by log-likelihood ratio.

The patterns give the base spans. Beside them every run of 20 characters or more of the base64 alphabet that
holds letters is scored: how much likelier is it under a Markov model of random strings than under one of ordinary
identifiers? Both models are first order over characters and the start of the run, smoothed by single characters
and by the uniform distribution. A run is added when the ratio a character reaches BAR and it overlaps no base
span. Of a run of more than LONG characters that does not reach BAR as a whole, the windows of WINDOW characters
that do are added, touching ones as one; no run is too long.

Both models are trained on labelled samples of the table itself, about SAMPLE rows chosen by a hash of their id.
The patterns label them: values of base spans with a digit and 16 characters or more are random strings, the words
outside of all spans are the parts of ordinary identifiers. Tasks count pairs of letters, and only these counts,
whose number is fixed, reach the driver. There the words are put together by the usual conventions of identifiers
(run together, camel case, snake case, kebab case, paths, constants, numbers at the end) as expected counts of
pairs, and random strings over the usual alphabets, labelled by their making, are counted with those of the table.

Defined results: a null text is empty and has no spans; neither has an empty one. A very long text is scanned whole.
Rows that repeat an id, and rows without one, are scanned each for itself; rows without an id are not learned from.
Where spans of two kinds begin at one place both are listed, in the order of kinds. If the sample holds no words,
no spans are added. An empty table gives an empty result. Columns besides id and text are ignored. Offsets are code
points, ends exclusive.
"""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import id_and_text, per_batch
from quire.llm.spans import Span, scan

BASE, ADDED = ("assign", "access", "hex"), ("random",)
# fixed patterns
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{24,}")  # a run that is long enough; shorter ones would be dropped
KEYWORD = re.compile("passw|secret|token|api_?key", re.ASCII | re.IGNORECASE)
CANDIDATE = re.compile("[A-Za-z0-9+/_=-]{20,}")
LONG, WINDOW, BAR, SEED, STRINGS, SAMPLE = 200, 50, 0.15, 20, 4000, 20_000
ALPHABETS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")
SYMBOLS = "+-/0123456789=ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz"
START = len(SYMBOLS)
LOWER, UPPER, DIGITS = (np.array([SYMBOLS.index(c) for c in x]) for x in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"))
#: an identifier has this many words, and this share of them ends in a number of three digits
PARTS, NUMBERED = 3, 0.4


def base_spans(text: str) -> tuple[list[Span], list[str]]:
    """The spans of the fixed patterns, and their values."""
    spans: list[Span] = []
    values: list[str] = []
    if KEYWORD.search(text):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 6:
                spans.append(("assign", *m.span()))
                values.append(m[2])
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= 20:
                spans.append(("access", *m.span()))
                values.append(m[0])
    for m in HEX.finditer(text):
        spans.append(("hex", *m.span()))
        values.append(m[0])
    return spans, values


def random_strings(n: int, rng: random.Random) -> list[str]:
    return ["".join(rng.choice(letters) for _ in range(rng.randint(20, 48))) for letters in (rng.choice(ALPHABETS) for _ in range(n))]


def string_pairs(strings: list[str]) -> np.ndarray:
    """How often each character follows another, or the start."""
    out = np.zeros((START + 1, START))
    for s, n in Counter(strings).items():
        at = [SYMBOLS.find(c) for c in s]
        for a, b in zip([START, *at], at, strict=False):
            if a >= 0 and b >= 0:
                out[a, b] += n
    return out


def word_pairs(texts: list[str]) -> np.ndarray:
    """Four squares of 26: pairs at the start of words, pairs further on, first letters, last letters (on diagonals)."""
    raw = np.frombuffer("\n".join(texts).lower().encode("utf-8", "replace"), np.uint8)
    raw = np.concatenate(([10], raw, [10]))
    letter = ((raw >= 97) & (raw < 123)).astype(np.int8)
    word = letter.astype(bool) | ((raw >= 48) & (raw < 58)) | (raw >= 128)
    # runs of letters that no digit and no letter beyond ASCII touches
    start, end = np.flatnonzero(word[1:] & ~word[:-1]) + 1, np.flatnonzero(word[:-1] & ~word[1:]) + 1
    plain = np.concatenate(([0], np.cumsum(letter)))
    good = (plain[end] - plain[start] == end - start) & (end - start >= 3)
    start, end = start[good], end[good]
    code = raw.astype(np.int64) - 97
    inside = np.zeros(len(raw) + 1, np.int64)
    np.add.at(inside, start, 1)
    np.add.at(inside, end - 1, -1)
    at = np.flatnonzero(np.cumsum(inside)[:-1])  # each with the next letter of its word
    pair = code[at] * 26 + code[at + 1]
    first = np.zeros(len(raw), bool)
    first[start] = True
    out = np.zeros((4, 676))
    out[0] = np.bincount(pair[first[at]], minlength=676)
    out[1] = np.bincount(pair[~first[at]], minlength=676)
    out[2] = np.bincount(code[start] * 27, minlength=676)
    out[3] = np.bincount(code[end - 1] * 27, minlength=676)
    return out.reshape(4, 26, 26)


def identifier_pairs(words: np.ndarray) -> np.ndarray:
    """Expected pairs of identifiers that are made of the words by each convention alike."""
    begin, inner, firsts, lasts = words[0], words[1], np.diagonal(words[2]), np.diagonal(words[3])
    n = firsts.sum()
    out = np.zeros((START + 1, START))

    def style(low: np.ndarray, head: np.ndarray, lead: np.ndarray, separator: str = "") -> None:
        """low: letters within words; head: first letters of words but the first; lead: of the first."""
        joins = 1 - 1 / PARTS
        out[np.ix_(low, low)] += inner
        out[np.ix_(head, low)] += begin * joins
        out[np.ix_(lead, low)] += begin / PARTS
        out[START, lead] += firsts / PARTS
        if separator:
            at = SYMBOLS.index(separator)
            out[low, at] += lasts * joins
            out[at, head] += firsts * joins
        else:
            out[np.ix_(low, head)] += np.outer(lasts, firsts) / max(n, 1) * joins
        out[np.ix_(low, DIGITS)] += lasts[:, None] * NUMBERED / PARTS / 10
        out[np.ix_(DIGITS, DIGITS)] += n * NUMBERED / PARTS * 2 / 100

    style(LOWER, LOWER, LOWER)
    style(LOWER, UPPER, LOWER)
    style(LOWER, UPPER, UPPER)
    style(UPPER, UPPER, UPPER, "_")
    for separator in "_-/":
        style(LOWER, LOWER, LOWER, separator)
    return out


def log_probabilities(pairs: np.ndarray) -> np.ndarray:
    """Of each character after another: by pairs, by single characters, and uniform."""
    single = pairs.sum(axis=0)
    before = pairs.sum(axis=1, keepdims=True)
    return np.log(0.6 * pairs / np.maximum(before, 1e-9) + 0.3 * single / max(single.sum(), 1e-9) + 0.1 / START)


class Detector:
    def __init__(self, strings: np.ndarray, identifiers: np.ndarray, bar: float = BAR):
        self.able = bool(identifiers.any())
        ratio = log_probabilities(strings) - log_probabilities(identifiers)
        names = SYMBOLS + "^"
        self.ratio = {names[a] + names[b]: float(ratio[a, b]) for a in range(START + 1) for b in range(START)}
        self.bar = bar

    def score(self, run: str) -> float:
        """Log-likelihood ratio a character."""
        framed, ratio = "^" + run, self.ratio
        return sum([ratio[framed[i : i + 2]] for i in range(len(run))]) / len(run)

    def __call__(self, run: str) -> bool:
        return self.able and any(c.isalpha() for c in run) and self.score(run) >= self.bar

    def stretches(self, run: str) -> list[tuple[int, int]]:
        """The parts of a run that are added: all of it, or windows of a long one."""
        if self(run):
            return [(0, len(run))]
        out: list[tuple[int, int]] = []
        if len(run) > LONG:
            for at in [*range(0, len(run) - WINDOW, WINDOW // 2), len(run) - WINDOW]:
                if self(run[at : at + WINDOW]):
                    start = out.pop()[0] if out and at <= out[-1][1] else at
                    out.append((start, at + WINDOW))
        return out


def labelled(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(pairs in random strings, word pairs) of texts, labelled by the fixed patterns."""
    strings: list[str] = []
    plain: list[str] = []
    for text in texts:
        spans, values = base_spans(text)
        strings += [v for v in values if len(v) >= 16 and any(c.isdigit() for c in v)]
        last = 0
        for _, s, e in sorted(spans, key=lambda x: x[1]):
            plain.append(text[last : max(s, last)])
            last = max(e, last)
        plain.append(text[last:])
    return string_pairs(strings), word_pairs(plain)


def detector_of(strings: np.ndarray, words: np.ndarray, bar: float = BAR) -> Detector:
    made = string_pairs(random_strings(STRINGS, random.Random(SEED)))
    return Detector(made + strings, identifier_pairs(words), bar)


def _counts(batch: pa.RecordBatch) -> pa.RecordBatch:
    strings, words = labelled([t.as_py() for t in batch.column("text")])
    flat = np.concatenate((strings.reshape(-1), words.reshape(-1))).astype(np.int64)
    at = np.flatnonzero(flat)
    return pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], ["place", "n"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Detector:
    """Fit on about ``sample`` rows; what reaches the driver has a fixed size."""
    own = id_and_text(docs, id_col, text_col).where("doc_id is not null")
    share = sample / max(1, own.select("doc_id").count())
    taken = own.where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1_000_000)) / 1_000_000.0 < share)
    flat = np.zeros((START + 1) * START + 4 * 676)
    for r in per_batch(taken, _counts, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
        flat[r["place"]] = r["n"]
    cut = (START + 1) * START
    return detector_of(flat[:cut].reshape(START + 1, START), flat[cut:].reshape(4, 26, 26))


def find(text: str, random_run: Detector) -> tuple[list[Span], list[Span]]:
    """(base spans, added spans)."""
    base, _ = base_spans(text)
    added: list[Span] = []
    for m in CANDIDATE.finditer(text):
        for s, e in random_run.stretches(m.group()):
            s, e = m.start() + s, m.start() + e
            if not any(s < f and a < e for _, a, f in base):
                added.append(("random", s, e))
    return base, added


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Detector | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_added of every whole text; model: if not trained on docs."""
    own = model or train(docs, id_col, text_col)
    return scan(docs, lambda text: find(text, own), BASE, ADDED, id_col, text_col)
