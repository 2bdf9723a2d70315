"""Vectorised words and word shingles of a batch of texts.

A text is looked at as UTF-8 bytes; words are ``[^\\x20\\x09-\\x0D]+`` with A-Z
lower-cased. Everything is numpy over the joined bytes of a bounded slice of
the batch, so no Python code runs per word.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Everything but letters, digits and non-ASCII bytes.
NO_LETTER = np.array([not (b >= 128 or chr(b).isalnum()) for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_RNG = np.random.default_rng(20240731)
_BYTE_KEY = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_KEY_LOW = _BYTE_KEY[LOWER]
_STEP = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        p = np.full(max(n, 256), _STEP, np.uint64)
        p[0] = 1
        _POWERS = np.multiply.accumulate(p)
    return _POWERS


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of the splitmix64 generator (bijective on 64 bits)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of ``n`` texts: byte range, text index and 64-bit hash of each."""
    n: int
    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    hash: np.ndarray

    def per_doc(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n)


def slices(texts: Sequence[str | None], limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first index, encoded texts) of consecutive runs of about ``limit`` bytes;
    a longer text stands alone. Null texts count as empty."""
    at, run, size = 0, [], 0
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b""
        if run and size + len(b) > limit:
            yield at, run
            at, run, size = i, [], 0
        run.append(b)
        size += len(b)
    if run:
        yield at, run


def runs(texts: Sequence[str | None], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(begin, end) of consecutive runs of about ``limit`` characters; a longer text
    stands alone."""
    at = size = 0
    for i, t in enumerate(texts):
        n = len(t) if isinstance(t, str) else 0
        if i > at and size + n > limit:
            yield at, i
            at, size = i, 0
        size += n
    if at < len(texts):
        yield at, len(texts)


def words_of(texts: list[bytes], between: np.ndarray = _SPACE) -> Words:
    """Words of encoded texts; ``between`` marks the bytes that part words."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    inside = ~between[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside)).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    doc = np.searchsorted(np.cumsum(lengths), starts, "right")
    if not len(starts):
        return Words(len(texts), buf, starts, ends, doc, np.zeros(0, np.uint64))
    size = ends - starts
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    at = np.flatnonzero(inside)
    pos = np.arange(len(at)) - np.repeat(first, size)
    keyed = _BYTE_KEY_LOW[buf[at]] * powers(int(size.max()))[pos]
    return Words(len(texts), buf, starts, ends, doc,
                 mix64(np.add.reduceat(keyed, first) + size.astype(np.uint64)))


def shingles(w: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, 64-bit hash) of every ``width``-word shingle, in text order,
    repeats kept; a text with fewer words gives its whole sequence as one."""
    counts = w.per_doc()
    n = len(w.hash)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    keys = mix64(np.arange(1, width + 1, dtype=np.uint64) * _STEP) | np.uint64(1)
    total = np.zeros(n, np.uint64)
    for k in range(min(width, n)):
        total[: n - k] += w.hash[k:] * keys[k]
    ok = np.zeros(n, bool)
    if n >= width:
        ok[: n - width + 1] = w.doc[width - 1:] == w.doc[: n - width + 1]
    doc, h = w.doc[ok], mix64(total[ok])
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        first = np.concatenate(([0], np.cumsum(counts)[:-1]))
        whole = np.array([np.sum(w.hash[first[d]: first[d] + counts[d]] * keys[: counts[d]])
                          for d in short], np.uint64)
        doc = np.concatenate((doc, short))
        h = np.concatenate((h, mix64(whole + counts[short].astype(np.uint64))))
        order = np.argsort(doc, kind="stable")
        doc, h = doc[order], h[order]
    return doc, h


def distinct_shingles(w: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``shingles``, each hash once a text, sorted by (text, hash)."""
    doc, h = shingles(w, width)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[keep], h[keep]
