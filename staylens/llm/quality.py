"""Operator 7, quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words, covering the whole
text. Each passage becomes a vector of byte classes, hashed byte pairs and word
statistics; an encoder maps it to h, gated attention (tanh(V h) * sigmoid(U h))
weighs the passages, and a logistic unit scores the weighted passage vector.
Encoder, attention and score are learnt together from document labels.

The fit uses a bounded sample of labelled rows (labels.FIT_ROWS, FIT_CHARS);
scoring goes over all texts, slice by slice, with the fitted arrays (about
100 kB, fixed) broadcast.

Edge cases: null or empty text is one passage without words; without labels of
both classes every score is 1, so that nothing is rejected unlearnt; repeated rows are scored alike; other columns
are ignored; an empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.labels import Adam, fitted, labelled_sample, scored, sigmoid
from staylens.llm.words import mix64, slices, words_of

PASSAGE_WORDS = 48
FOLDS, HELD_OUT = 5, 0
_PAIRS = 128
_HIDDEN, _GATE = 24, 12
PRIOR_BYTES = 60
#: Share of the loss that label 1 carries: losing a good text is worse than keeping a bad one.
GOOD_MASS = 0.75

#: Byte classes: each ASCII sign its own, then digits, upper, lower, other bytes.
_CLASS = np.zeros(256, np.int64)
_signs = [b for b in range(33, 127) if not chr(b).isalnum()]
_CLASS[_signs] = np.arange(1, len(_signs) + 1)
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123] = (len(_signs) + k for k in (1, 2, 3))
_CLASS[128:] = len(_signs) + 4
_CLASSES = len(_signs) + 5
_PAIR_OF = (mix64(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(_PAIRS)).astype(np.int64)
FEATURES = _CLASSES + _PAIRS + 7


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, bytes in words, features) of each passage; every text has one."""
    w = words_of(texts)
    counts = w.per_doc()
    own = np.maximum(1, -(-counts // PASSAGE_WORDS))
    doc = np.repeat(np.arange(len(texts)), own)
    first = np.cumsum(own) - own
    n = len(doc)
    x = np.zeros((n, FEATURES), np.float32)
    if not len(w.starts):
        return doc, np.zeros(n, np.float32), x
    nth = np.arange(len(w.doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    passage = first[w.doc] + nth // PASSAGE_WORDS
    size = w.ends - w.starts
    at = np.repeat(w.starts - (np.cumsum(size) - size), size) + np.arange(size.sum())
    owner = np.repeat(passage, size)
    byte = w.buf[at]
    total = np.bincount(passage, size, n)[:, None] + 1e-9
    x[:, :_CLASSES] = np.bincount(owner * _CLASSES + _CLASS[byte], minlength=n * _CLASSES).reshape(n, -1) / total
    pair = _PAIR_OF[byte.astype(np.int64) << 8 | w.buf[np.minimum(at + 1, len(w.buf) - 1)]]
    x[:, _CLASSES: _CLASSES + _PAIRS] = np.bincount(owner * _PAIRS + pair, minlength=n * _PAIRS).reshape(n, -1) / total
    words = np.bincount(passage, minlength=n) + 1e-9
    same = np.zeros(len(w.hash), bool)
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (passage[1:] == passage[:-1])
    order = np.lexsort((w.hash, passage))
    new = np.ones(len(order), bool)
    new[1:] = (w.hash[order][1:] != w.hash[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    signs = (_CLASS[w.buf] > 0) & (_CLASS[w.buf] <= len(_signs))
    last, begin = w.buf[w.ends - 1], w.buf[w.starts]
    stats = [size / 8, np.minimum(size, 64) ** 2 / 200, same, (begin >= 65) & (begin <= 90),
             signs[w.ends - 1], (size == 1) & signs[w.starts], (last >= 65) & (last <= 90)]
    for k, s in enumerate(stats[:6]):
        x[:, _CLASSES + _PAIRS + k] = np.bincount(passage, s, n) / words
    x[:, -1] = np.bincount(passage[order], new, n) / words
    return doc, total[:, 0].astype(np.float32), x


def _scaled(x: np.ndarray, total: np.ndarray, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
    """Standardised features; those of a short passage lean to the mean as if
    ``PRIOR_BYTES`` of average text stood beside it."""
    return np.clip((x - mean) / std * (total / (total + PRIOR_BYTES))[:, None], -5, 5)


def _forward(p: dict, x: np.ndarray, doc: np.ndarray, n: int) -> dict:
    start = np.searchsorted(doc, np.arange(n))
    h = np.tanh(x @ p["W"] + p["b"])
    t, g = np.tanh(h @ p["V"]), sigmoid(h @ p["U"])
    e = (t * g) @ p["w"]
    a = np.exp(e - np.maximum.reduceat(e, start)[doc])
    a = a / np.add.reduceat(a, start)[doc]
    z = np.add.reduceat(a[:, None] * h, start)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "s": sigmoid(z @ p["c"] + p["d"][0]), "start": start}


def _backward(p: dict, f: dict, x: np.ndarray, doc: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    """Gradients of the weighted logistic loss, from what ``_forward`` gave."""
    ds = (f["s"] - y) * weight
    dz = ds[:, None] * p["c"]
    da = (dz[doc] * f["h"]).sum(1)
    de = f["a"] * (da - np.add.reduceat(f["a"] * da, f["start"])[doc])
    dtg = de[:, None] * p["w"]
    dt, dg = dtg * f["g"] * (1 - f["t"] ** 2), dtg * f["t"] * f["g"] * (1 - f["g"])
    dh = f["a"][:, None] * dz[doc] + dt @ p["V"].T + dg @ p["U"].T
    dh *= 1 - f["h"] ** 2
    return {"W": x.T @ dh, "b": dh.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ dg,
            "w": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ ds, "d": ds.sum(keepdims=True)}


def fit(texts: list[str], labels: np.ndarray, steps: int = 160, seed: int = 7) -> dict:
    """Fitted arrays; only a constant if a class is missing."""
    y = np.asarray(labels, np.float32)
    if len(set(y)) < 2:
        return {"constant": 1.0}
    parts = [(at, *passages(run)) for at, run in slices(texts)]
    doc = np.concatenate([d + at for at, d, _, _ in parts])
    total, x = (np.concatenate([q[k] for q in parts]) for k in (2, 3))
    mean, std = x.mean(0), x.std(0) + np.float32(1e-3)
    x = _scaled(x, total, mean, std)
    rng = np.random.default_rng(seed)
    p = {"W": rng.normal(0, FEATURES ** -0.5, (FEATURES, _HIDDEN)), "b": np.zeros(_HIDDEN),
         "V": rng.normal(0, 0.3, (_HIDDEN, _GATE)), "U": rng.normal(0, 0.3, (_HIDDEN, _GATE)),
         "w": rng.normal(0, 0.3, _GATE), "c": rng.normal(0, 0.3, _HIDDEN), "d": np.zeros(1)}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    weight = (np.where(y == 1, GOOD_MASS / y.mean(), (1 - GOOD_MASS) / (1 - y.mean())) / len(y)).astype(np.float32)
    adam = Adam(p, 0.01, 0.02)
    for _ in range(steps):
        f = _forward(p, x, doc, len(y))
        adam.step(_backward(p, f, x, doc, y, weight))
    return p | {"mean": mean, "std": std}


def score(model: dict, texts: list[str | None]) -> np.ndarray:
    """Score of every whole text."""
    if "constant" in model:
        return np.full(len(texts), model["constant"])
    out = []
    for _, run in slices(texts):
        doc, total, x = passages(run)
        out.append(_forward(model, _scaled(x, total, model["mean"], model["std"]), doc, len(run))["s"])
    return np.concatenate(out).astype(float) if out else np.zeros(0)


def score_column(spark, model: dict):
    """Column function: score of a text column."""
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def quality(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield pd.Series(score(sent.value, t.tolist()))

    return quality


def fitted_model(docs: DataFrame, labels: DataFrame) -> dict:
    return fitted(labelled_sample(docs, labels, "quality", FOLDS, HELD_OUT), fit)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    model = fitted_model(docs, labels)
    rated = docs.withColumn("score", score_column(docs.sparkSession, model)("text"))
    return scored(rated, F.col("score"), FOLDS, HELD_OUT)
