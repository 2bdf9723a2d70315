"""Operator 4, toxicity by a bidirectional gated recurrent network.

Words are runs of letters and digits, A-Z lower-cased, parted at spaces and
punctuation of all scripts. A run of more than ``LONGEST`` bytes (scripts without
spaces) becomes several words that overlap by the largest n-gram, so that every
byte enters. A word enters as a word
input (log-odds of its hash, whether the fit has seen it) and a character input
(largest, mean and smallest log-odds over its byte 3- to 6-grams, with word
ends marked), so that an unseen form of a known stem is recognised. Two gated
recurrent layers read a window forwards and backwards, attention pools their
states, and a logistic unit scores the window. Windows of ``WINDOW`` words start
every ``STRIDE`` words and cover the whole text; a document has the score of
its worst window.

Training, in numpy: log-odds come from document counts of the sample, for the
training documents themselves from the other folds; the network learns from the
worst window of each document under the current weights (and further random
windows of clean documents) by back-propagation through time.

The fit uses a bounded sample of labelled rows (FIT_ROWS a class, labels.FIT_CHARS);
the broadcast model has fixed size (about 1 MB).

Edge cases: null or empty text is one window without words; without labels of
both classes every score is 0; repeated rows are scored alike; other columns are
ignored; an empty table gives an empty result.
"""
from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.labels import Adam, fitted, labelled_sample, scored, sigmoid
from staylens.llm.words import LOWER, NO_LETTER, Words, mix64, slices, words_of

FOLDS, HELD_OUT = 4, 2
WINDOW, STRIDE = 24, 12
HIDDEN, ATTENTION = 8, 8
GRAMS = (3, 4, 5, 6)
#: Hash buckets of words and of byte n-grams.
BITS = 17
INPUTS = 6
#: A word or n-gram counts from so many documents of the sample on.
LEAST_DOCS = 3
FIT_ROWS = 1000
#: Bytes of a word at most.
LONGEST = 64
_MASK = np.uint64((1 << BITS) - 1)
#: Spaces and punctuation beyond ASCII, which bytes do not tell from letters.
_BETWEEN = re.compile("[" + "".join(re.escape(c) for c in map(chr, range(128, sys.maxunicode + 1))
                                    if unicodedata.category(c)[0] in "ZP" or c.isspace() or c == "\u200b") + "]")


def parted(texts: list[str | None]) -> list[str | None]:
    """``texts`` with a space for each of _BETWEEN."""
    return [t if not isinstance(t, str) or t.isascii() else _BETWEEN.sub(" ", t) for t in texts]


def split_words(texts: list[bytes]) -> Words:
    """Words of encoded texts, those over LONGEST bytes as overlapping parts."""
    w = words_of(texts, NO_LETTER)
    size = w.ends - w.starts
    if not (size > LONGEST).any():
        return w
    step = LONGEST - max(GRAMS)
    n = 1 + np.maximum(0, -(-(size - LONGEST) // step))
    own = np.repeat(np.arange(len(size)), n)
    starts = w.starts[own] + (np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)) * step
    ends = np.minimum(starts + LONGEST, w.ends[own])
    hashes = w.hash[own]
    cut = np.flatnonzero(n[own] > 1)
    # the hash of a part as a word of its own
    pieces = [w.buf[a:b].tobytes() for a, b in zip(starts[cut], ends[cut])]
    hashes[cut] = words_of(pieces, NO_LETTER).hash
    return Words(w.n, w.buf, starts, ends, w.doc[own], hashes)


class Distinct:
    """Distinct words of a slice: ``of`` maps each word to its row; ``word``
    and ``gram`` are hash buckets, n-grams of row i at gram_at[i]:gram_at[i+1]."""

    def __init__(self, w: Words):
        self.hash, first, self.of = np.unique(w.hash, return_index=True, return_inverse=True)
        self.word = (self.hash & _MASK).astype(np.int64)
        size = w.ends[first] - w.starts[first] + 2  # with both end marks
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
        own = np.repeat(np.arange(len(first)), size)
        byte = LOWER[w.buf[np.clip(np.repeat(w.starts[first], size) + at - 1, 0, len(w.buf) - 1)]].astype(np.uint64)
        byte[(at == 0) | (at == size[own] - 1)] = 1
        owners, hashes = [], []
        rolled = np.zeros(len(byte), np.uint64)
        for n in range(1, max(GRAMS) + 1):
            rolled[: len(byte) - n + 1] = rolled[: len(byte) - n + 1] * np.uint64(257) + byte[n - 1:]
            if n in GRAMS or n == 2:
                ok = at + n <= size[own]
                if n == 2:  # a word too short for other n-grams
                    ok &= size[own] < min(GRAMS)
                owners.append(own[ok])
                hashes.append(mix64(rolled[ok] + np.uint64(n * 0x9E3779B97F4A7C15 % 2**64)))
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        self.gram = (np.concatenate(hashes)[order] & _MASK).astype(np.int64)
        self.gram_at = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(first)))))

    def inputs(self, tables: dict[str, np.ndarray]) -> np.ndarray:
        x = np.zeros((len(self.word) + 1, INPUTS), np.float32)  # last row: no word
        if len(self.word):
            g = tables["gram"][self.gram]
            at = self.gram_at[:-1]
            x[:-1, 0] = tables["word"][self.word]
            x[:-1, 1] = tables["seen"][self.word]
            x[:-1, 2] = np.maximum.reduceat(g, at)
            x[:-1, 3] = np.add.reduceat(g, at) / np.diff(self.gram_at)
            x[:-1, 4] = np.minimum.reduceat(g, at)
            x[:-1, 5] = np.minimum(np.diff(self.gram_at), 40) / 20
        return x


def windows(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text index of each window, word positions (windows x WINDOW), -1: none)."""
    counts = w.per_doc()
    own = np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1)
    doc = np.repeat(np.arange(w.n), own)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(own) - own, own)
    # the last window ends with the text
    begin = np.maximum(0, np.minimum(nth * STRIDE, counts[doc] - WINDOW))
    inside = begin[:, None] + np.arange(WINDOW)
    first = np.cumsum(counts) - counts
    return doc, np.where(inside < counts[doc][:, None], first[doc][:, None] + inside, -1)


def _start(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    both, h = 2 * HIDDEN, HIDDEN
    side = np.zeros((both, 3 * both), np.float32)  # each direction sees its own state only
    for gate in range(3):
        for d in range(2):
            side[d * h: d * h + h, gate * both + d * h: gate * both + d * h + h] = 1
    return {"X": rng.normal(0, 0.4, (INPUTS, 3 * both)), "B": np.zeros(3 * both),
            "H": rng.normal(0, 0.25, (both, 3 * both)) * side, "own": side,
            "A": rng.normal(0, 0.3, (both, ATTENTION)), "a": rng.normal(0, 0.5, ATTENTION),
            "c": rng.normal(0, 0.3, both), "d": np.full(1, -1.0)}


def _columns(direction: int) -> np.ndarray:
    """Columns of a direction in the three gates side by side."""
    at = np.arange(HIDDEN) + direction * HIDDEN
    return np.concatenate([at + g * 2 * HIDDEN for g in range(3)])


def project(p: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gate inputs of each distinct word, forwards and backwards."""
    return tuple(x @ np.ascontiguousarray(p["X"][:, c]) + p["B"][c] for c in map(_columns, (0, 1)))


def forward(p: dict, projected: tuple[np.ndarray, np.ndarray], of: np.ndarray, keep: bool = False):
    """Scores of windows ``of`` (rows of distinct words; -1, the last, is no word)."""
    n, both, h = len(of), 2 * HIDDEN, HIDDEN
    split_f, split_b = projected
    state = np.zeros((n, both), np.float32)
    states = np.empty((WINDOW, n, both), np.float32)
    there = of >= 0
    full = bool(there.all())
    saved = []
    u = np.empty((n, 3, both), np.float32)
    for t in range(WINDOW):
        r = WINDOW - 1 - t
        u[:, :, :h] = split_f[of[:, t]].reshape(n, 3, h)
        u[:, :, h:] = split_b[of[:, r]].reshape(n, 3, h)
        rec = (state @ p["H"]).reshape(n, 3, both)
        zr = sigmoid(u[:, :2] + rec[:, :2])
        z, reset = zr[:, 0], zr[:, 1]
        new = np.tanh(u[:, 2] + reset * rec[:, 2])
        if full:
            move = 1 - z
        else:
            live = np.empty((n, both), np.float32)
            live[:, :h], live[:, h:] = there[:, t, None], there[:, r, None]
            move = (1 - z) * live
        if keep:
            saved.append((state, zr, rec[:, 2].copy(), new, move))
        state = state + move * (new - state)
        states[t, :, :h], states[r, :, h:] = state[:, :h], state[:, h:]
    k = np.tanh(states @ p["A"])
    e = np.where(there.T, k @ p["a"], np.float32(-1e4))
    e = np.exp(e - e.max(0))
    att = e / e.sum(0)
    pooled = (att[:, :, None] * states).sum(0)
    s = sigmoid(pooled @ p["c"] + p["d"][0])
    return (s, states, k, att, pooled, saved, there) if keep else s


def backward(p: dict, x: np.ndarray, of: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    s, states, k, att, pooled, saved, there = forward(p, project(p, x), of, keep=True)
    n, both, h = len(of), 2 * HIDDEN, HIDDEN
    ds = (s - y) * weight
    dp = ds[:, None] * p["c"]
    dstates = att[:, :, None] * dp
    da = (states * dp).sum(2)
    de = att * (da - (att * da).sum(0))
    dk = de[:, :, None] * p["a"] * (1 - k ** 2)
    dstates += dk @ p["A"].T
    g = {"c": pooled.T @ ds, "d": ds.sum(keepdims=True), "a": np.einsum("tnk,tn->k", k, de),
         "A": np.einsum("tnb,tnk->bk", states, dk), "H": np.zeros_like(p["H"]),
         "X": np.zeros_like(p["X"]), "B": np.zeros_like(p["B"])}
    dh = np.zeros((n, both), np.float32)
    for t in reversed(range(WINDOW)):
        r = WINDOW - 1 - t
        dh[:, :h] += dstates[t, :, :h]
        dh[:, h:] += dstates[r, :, h:]
        state, zr, hn, new, move = saved[t]
        z, reset = zr[:, 0], zr[:, 1]
        dnew = dh * move * (1 - new ** 2)
        live = np.empty((n, both), np.float32)
        live[:, :h], live[:, h:] = there[:, t, None], there[:, r, None]
        dz = -dh * (new - state) * live * z * (1 - z)
        dr = dnew * hn * reset * (1 - reset)
        dinput = np.concatenate((dz, dr, dnew), 1)
        drec = np.concatenate((dz, dr, dnew * reset), 1)
        g["H"] += state.T @ drec
        dh = dh * (1 - move) + drec @ p["H"].T
        xt = np.empty((n, 2, INPUTS), np.float32)
        xt[:, 0], xt[:, 1] = x[of[:, t]], x[of[:, r]]
        for d in range(2):
            cols = _columns(d)
            g["X"][:, cols] += xt[:, d].T @ dinput[:, cols]
        g["B"] += dinput.sum(0)
    g["H"] *= p["own"]
    return g


def _log_odds(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    odds = np.log((pos + 0.5) / (n_pos + 1)) - np.log((neg + 0.5) / (n_neg + 1))
    odds[pos + neg < LEAST_DOCS] = 0
    return np.clip(odds, -5, 5).astype(np.float32)


def fit(texts: list[str], labels: np.ndarray, rounds: int = 6, steps: int = 40, seed: int = 11) -> dict:
    y = np.asarray(labels, np.float32)
    if len(set(y)) < 2:
        return {}
    rng = np.random.default_rng(seed)
    parts = []
    for at, run in slices(parted(texts)):
        w = split_words(run)
        parts.append((at, w, Distinct(w)))
    # documents with each bucket, by fold and class
    fold = rng.permutation(len(y)) % 4
    size = 1 << BITS
    counts = {k: np.zeros((4, 2, size), np.int32) for k in ("word", "gram")}
    for at, w, d in parts:
        grams = np.diff(d.gram_at)
        for name in counts:
            if name == "word":
                doc, bucket = w.doc + at, d.word[d.of]
            else:
                reps = grams[d.of]
                doc = np.repeat(w.doc + at, reps)
                ends = np.cumsum(reps)
                bucket = d.gram[np.arange(ends[-1] if len(ends) else 0) + np.repeat(d.gram_at[:-1][d.of] - (ends - reps), reps)]
            pair = np.unique(doc * size + bucket)
            np.add.at(counts[name], (fold[pair // size], y[pair // size].astype(int), pair % size), 1)

    def tables(without: int | None) -> dict[str, np.ndarray]:
        use = [f for f in range(4) if f != without]
        n = [int(((y == c) & np.isin(fold, use)).sum()) for c in (0, 1)]
        sums = {k: v[use].sum(0) for k, v in counts.items()}
        out = {k: _log_odds(v[1], v[0], n[1], n[0]) for k, v in sums.items()}
        return out | {"seen": (sums["word"].sum(0) > 0).astype(np.float32)}

    # inputs of the training windows, each document by the other folds' counts
    xs, ofs, owners, base = [], [], [], 0
    for f in range(4):
        mine = tables(f)
        for at, w, d in parts:
            doc, of = windows(w)
            use = fold[doc + at] == f
            of = of[use]
            rows, back = np.unique(np.where(of >= 0, d.of[of] if len(d.of) else -1, -1), return_inverse=True)
            x = d.inputs(mine)
            xs.append(x[rows])
            ofs.append(np.where(of >= 0, back.reshape(of.shape) + base, -1))
            owners.append(doc[use] + at)
            base += len(rows)
    x = np.concatenate([*xs, np.zeros((1, INPUTS), np.float32)])
    of, owner = np.concatenate(ofs), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    of, owner = of[order], owner[order]
    start = np.searchsorted(owner, np.arange(len(y)))
    p = {k: v.astype(np.float32) for k, v in _start(seed).items()}
    learn = {k: v for k, v in p.items() if k != "own"}
    adam = Adam(learn, 0.02, 0.02)
    clean = np.flatnonzero(y[owner] == 0)
    strongest = x[of, 0].max(1) + x[of, 2].max(1)  # the first guess of the worst windows
    for turn in range(rounds):
        s = strongest if turn == 0 else score_windows(p, x, of)
        worst = np.lexsort((s, owner))[np.append(start[1:], len(owner)) - 1]
        pos, neg = worst[y == 1], worst[y == 0]
        extra = rng.choice(clean, min(len(clean), len(neg)), replace=False)
        for _ in range(steps):
            pick = np.concatenate((rng.choice(pos, 64), rng.choice(neg, 112), rng.choice(extra, 80)))
            weight = np.full(len(pick), 1 / len(pick), np.float32)
            seen = of[pick]
            # some clean windows cut short, down to no word at all
            seen[-24:][np.arange(WINDOW) >= rng.integers(0, 9, (24, 1))] = -1
            rows, back = np.unique(seen, return_inverse=True)
            back = np.where(seen >= 0, back.reshape(seen.shape), -1)
            own = np.concatenate((x[rows], x[-1:]))  # the last row is no word
            adam.step(backward(p, own, back, y[owner[pick]], weight))
            p["H"] *= p["own"]
    return p | tables(None)


def score_windows(p: dict, x: np.ndarray, of: np.ndarray, batch: int = 1024) -> np.ndarray:
    projected = project(p, x)
    return np.concatenate([forward(p, projected, of[i: i + batch]) for i in range(0, len(of), batch)])


def score(model: dict, texts: list[str | None]) -> np.ndarray:
    """Score of every whole text: that of its worst window."""
    if not model:
        return np.zeros(len(texts))
    out = [np.zeros(0)]
    for _, run in slices(parted(texts)):
        w = split_words(run)
        d = Distinct(w)
        doc, at = windows(w)
        of = np.where(at >= 0, d.of[at], -1) if len(d.of) else at
        s = score_windows(model, d.inputs(model), of)
        out.append(np.maximum.reduceat(s, np.searchsorted(doc, np.arange(len(run)))))
    return np.concatenate(out).astype(float)


def score_column(spark, model: dict):
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def toxicity(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield pd.Series(score(sent.value, t.tolist()))

    return toxicity


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    model = fitted(labelled_sample(docs, labels, "toxic", FOLDS, HELD_OUT, FIT_ROWS), fit)
    rated = docs.withColumn("score", score_column(docs.sparkSession, model)("text"))
    return scored(rated, F.col("score"), FOLDS, HELD_OUT)
