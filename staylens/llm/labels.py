"""Labelled rows for the document classifiers."""
from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import crc_mod

#: Bounds of the sample a classifier is fitted on: rows of each class, and the
#: longest text (in characters) that is taken.
FIT_ROWS = 1500
FIT_CHARS = 20_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int,
                    rows: int = FIT_ROWS, chars: int = FIT_CHARS) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labels a class, outside the held-out
    fold and with texts up to ``chars``, chosen by a hash of doc_id. Of an id that
    several texts share one enters, the first in byte order."""
    known = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("label")).where(
        "id is not null and label in (0, 1)").where(crc_mod(F.col("id"), folds) != held_out)
    by_hash = [F.xxhash64("id", F.lit(label)), "id"]
    picked = [known.where(F.col("label") == c).orderBy(*by_hash).limit(rows) for c in (0, 1)]
    ids = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 x rows
    texts = docs.select("doc_id", "text").where(f"text is not null and length(text) <= {chars}")
    return (texts.join(ids, F.col("doc_id") == F.col("id")).groupBy("id", "label").agg(F.min("text").alias("text"))
            .select(F.col("id").alias("doc_id"), "text", "label"))


def fitted(sample: DataFrame, fit: Callable[[list[str], np.ndarray], dict]) -> dict:
    """``fit`` run by one task over the bounded sample; only the model (a few
    arrays of fixed size) comes to the driver."""
    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"doc_id": [], "text": [], "label": []}), *batches])
        rows = rows.sort_values(["doc_id", "text"])
        yield pd.DataFrame({"model": [pickle.dumps(fit(rows["text"].tolist(), rows["label"].to_numpy()))]})

    made = sample.repartition(1).mapInPandas(train, "model binary").first()
    return pickle.loads(made["model"]) if made else fit([], np.zeros(0))  # no row, no task


def scored(docs: DataFrame, score, folds: int, held_out: int, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted, with ``score`` a column of ``docs``."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(crc_mod(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out"),
                       score.alias("score"), (score >= threshold).cast("int").alias("predicted"))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Adam:
    """Adam steps on a dict of arrays, with decoupled weight decay."""

    def __init__(self, params: dict[str, np.ndarray], rate: float, decay: float = 0.0):
        self.p, self.rate, self.decay, self.t = params, rate, decay, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
            up = (self.m[k] / (1 - 0.9 ** self.t)) / (np.sqrt(self.v[k] / (1 - 0.999 ** self.t)) + 1e-8)
            self.p[k] -= self.rate * (up + self.decay * self.p[k])
