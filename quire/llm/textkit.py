"""Vectorised text primitives over UTF-8 buffers: mixed hashes, words, shingles, gear boundaries."""

from __future__ import annotations

import numpy as np

U = np.uint64
_WORD = np.zeros(256, bool)
for _lo, _hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _WORD[_lo:_hi] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_RADIX = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (multiply and xor-shift)."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the radix and of its inverse modulo 2^64, for n positions."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 16)  # of the longest slice so far; a slice is some megabytes, or one longer text
        for key, base in (("up", _RADIX), ("down", pow(_RADIX, -1, 1 << 64))):
            p = np.full(size, base, U)
            p[0] = 1
            _powers[key] = np.multiply.accumulate(p)
    return _powers["up"][:n], _powers["down"][:n]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each buf[start:end], from one running sum."""
    if not len(starts):
        return np.zeros(0, U)
    up, down = _power(len(buf) + 1)
    run = np.zeros(len(buf) + 1, U)
    np.cumsum((buf.astype(U) + U(1)) * up[: len(buf)], out=run[1:])
    h = (run[ends] - run[starts]) * down[starts]
    return mix(h ^ (ends - starts).astype(U) * U(0xA0761D6478BD642F))


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words: runs of ASCII letters and digits and of characters beyond ASCII, within one text."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = _WORD[buf]
    before = np.concatenate(([False], inside[:-1]))
    after = np.concatenate((inside[1:], [False]))
    firsts, lasts = offsets[:-1], offsets[1:] - 1
    full = offsets[1:] > offsets[:-1]
    before[firsts[full]] = False
    after[lasts[full]] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def shingles(buf: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every run of ``size`` words, in order.

    A text of fewer words gives one shingle of all of them; one without words gives its bytes as one shingle;
    an empty one gives none. The caller passes lower-cased bytes.
    """
    starts, ends = words(buf, offsets)
    n, texts = len(starts), len(offsets) - 1
    h = span_hashes(buf, starts, ends)
    doc = np.searchsorted(offsets, starts, "right") - 1
    doc_end = np.searchsorted(doc, doc, "right") if n else np.zeros(0, np.int64)
    acc = np.zeros(n, U)
    for j in range(size):
        factor = U(pow(0xE7037ED1A0B428DB, j + 1, 1 << 64))
        ahead = np.minimum(np.arange(n) + j, max(n - 1, 0))
        acc += np.where(np.arange(n) + j < doc_end, h[ahead] * factor, U(0))
    first = np.ones(n, bool)
    first[1:] = doc[1:] != doc[:-1]
    take = (np.arange(n) + size <= doc_end) | first
    doc, acc = doc[take], mix(acc[take])
    bare = np.flatnonzero((np.bincount(doc, minlength=texts)[:texts] == 0) & (offsets[1:] > offsets[:-1]))
    if len(bare):
        doc = np.concatenate((doc, bare))
        acc = np.concatenate((acc, span_hashes(buf, offsets[bare], offsets[bare + 1])))
        order = np.argsort(doc, kind="stable")
        doc, acc = doc[order], acc[order]
    return doc, acc


def occurrence(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """For each (text, hash) entry, how many equal entries of its text come before it."""
    n = len(h)
    if not n:
        return np.zeros(0, np.int64)
    key = mix(h + doc.astype(U) * U(0xC2B2AE3D27D4EB4F))
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    new = np.ones(n, bool)
    new[1:] = ranked[1:] != ranked[:-1]
    at = np.arange(n)
    out = np.empty(n, np.int64)
    out[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return out


_GEAR = mix(np.arange(1, 257, dtype=U) * U(0x2545F4914F6CDD1D)).astype(np.uint32)
GEAR_WINDOW = 16


def gear(buf: np.ndarray) -> np.ndarray:
    """The gear rolling hash at every byte over the last GEAR_WINDOW bytes: the sum of table[byte] << age.

    Doubling the window in each of four passes replaces the byte-by-byte loop. Ages of 16 and more are left
    out, so a value depends on 16 bytes only and its high bits mix all of them.
    """
    h = _GEAR[buf]
    step = 1
    while step < GEAR_WINDOW:
        nxt = h.copy()
        nxt[step:] += h[:-step] << np.uint32(step) if len(h) > step else np.uint32(0)
        h = nxt
        step *= 2
    return h
