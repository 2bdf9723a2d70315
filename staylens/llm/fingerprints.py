"""Operator 10, document fingerprints by MinHash.

A text's signature holds, for each of ``PERMUTATIONS`` universal hash functions
(a x + b mod 2^31 - 1), the smallest value over its 5-word shingles, all in
numpy; the fingerprint is the low 16 bits of each in hex. All texts have this one
kind of shingle, so that any two can be compared; a text under five words is one
shingle. The likeness of two fingerprints is the share of equal values, an
estimate of the Jaccard similarity.

``fingerprint_documents`` also fingerprints an edited form of each document,
whose tail comes from the next document by doc_id. Neighbours meet without a
global sort of texts in one task: the ids alone are sorted to find range bounds,
documents are dealt into ranges, each range gets a copy of the next one's first
document, and ranges are streamed in order.

``near_duplicates`` joins bands of signature values and verifies the Jaccard
similarity of the candidates' whole shingle sets.

Edge cases: null text is empty; texts without words have equal fingerprints (likeness
1 among themselves); a null doc_id sorts first; rows with the same doc_id follow
each other by text; a single document is its own next one; other columns are
ignored; an empty table gives an empty result.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import shuffle_partitions, stored
from staylens.llm.jaccard_join import link_entries
from staylens.llm.words import distinct_shingles, mix64, shingles, slices, words_of

WIDTH = 5
PERMUTATIONS = 64
#: Documents of a range, and the most ranges (their bounds, 8 bytes each, are broadcast).
RANGE_ROWS, MOST_RANGES = 400, 200_000
#: 16 bands of 4: a pair of similarity 0.8 shares a band with probability 0.9998.
BAND_ROWS = 4
PERCENT = 80
_P = np.uint64(2**31 - 1)
_RNG = np.random.default_rng(8191)
_A = _RNG.integers(1, 2**31 - 1, PERMUTATIONS, dtype=np.uint64)
_B = _RNG.integers(0, 2**31 - 1, PERMUTATIONS, dtype=np.uint64)
RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def signatures(texts: list[str | None]) -> np.ndarray:
    """(texts x PERMUTATIONS) smallest hash values; 2^31 - 1 where there is no shingle."""
    out = np.full((len(texts), PERMUTATIONS), _P, np.uint64)
    for at, run in slices(texts):
        doc, h = shingles(words_of(run), WIDTH)
        if not len(doc):
            continue
        x = h % _P
        rows, start = np.unique(doc, return_index=True)
        for k in range(PERMUTATIONS):
            v = x * _A[k] + _B[k]
            v = (v & _P) + (v >> np.uint64(31))
            v = np.where(v >= _P, v - _P, v)
            out[at + rows, k] = np.minimum.reduceat(v, start)
    return out


def _short(sig: np.ndarray) -> np.ndarray:
    return (sig & np.uint64(0xFFFF)).astype(">u2")


def fingerprint(text: str | None) -> str:
    return _short(signatures([text]))[0].tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of equal values of two fingerprints."""
    x, y = (np.frombuffer(bytes.fromhex(s), ">u2") for s in (a, b))
    return float((x == y).mean())


def _range_bounds(docs: DataFrame) -> np.ndarray:
    """Smallest key of each range, in order: every RANGE_ROWS-th id of the sorted ids."""
    step = max(RANGE_ROWS, docs.count() // MOST_RANGES)

    def every(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = 0
        for b in batches:
            yield b.iloc[(-seen) % step:: step]
            seen += len(b)

    ids = docs.select("key").repartitionByRange(shuffle_partitions(docs.sparkSession), "key")
    picked = ids.sortWithinPartitions("key").mapInPandas(every, "key long").distinct()
    return np.sort(np.array([r["key"] for r in picked.collect()], np.int64))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """One row per document, see ``RESULT``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(-2**63)).alias("key"))
    bounds = docs.sparkSession.sparkContext.broadcast(_range_bounds(rows))  # at most MOST_RANGES numbers

    @F.pandas_udf("array<long>")
    def places(key: pd.Series) -> pd.Series:
        """Range of a key and, for a range's smallest key, the one before (-1 - range)."""
        b = bounds.value
        at = np.searchsorted(b, key.to_numpy(), "right") - 1
        first = b[at] == key.to_numpy()
        return pd.Series([[r, -1 - (r - 1) % len(b)] if f else [r] for r, f in zip(at, first)])

    dealt = (rows.withColumn("place", F.explode(places("key")))
             .withColumn("carried", F.col("place") < 0)
             .withColumn("range", F.when(F.col("carried"), -1 - F.col("place")).otherwise(F.col("place"))))
    ordered = (dealt.repartition(shuffle_partitions(docs.sparkSession), "range")
               .sortWithinPartitions("range", "carried", "key", "text").select("range", "carried", "doc_id", "text"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the last row so far, whose next document is still to come
        for batch in batches:
            for i in range(0, len(batch), 1000):
                part = batch.iloc[i: i + 1000]
                part = part if held is None else pd.concat((held, part), ignore_index=True)
                held = part.iloc[-1:]
                texts = part["text"].tolist()
                sig = _short(signatures(texts))
                live = np.flatnonzero(~part["carried"].to_numpy(bool)[:-1])
                edited = [texts[j][: len(texts[j]) - len(texts[j]) // 4] + texts[j + 1][: len(texts[j]) // 4]
                          for j in live]
                changed = _short(signatures(edited))
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].iloc[live].astype("Int64"),
                    "n_chars": [len(texts[j]) for j in live],
                    "edited_sha256": [hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited],
                    "fingerprint": [sig[j].tobytes().hex() for j in live],
                    "edited_fingerprint": [c.tobytes().hex() for c in changed],
                    "near_edited": (sig[live] == changed).mean(1), "near_next": (sig[live] == sig[live + 1]).mean(1)})

    return ordered.mapInPandas(compare, RESULT)


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, class_id): smallest doc_id linked by verified pairs that share a
    band of their signatures. Texts without words stand alone."""
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["text"].tolist()
            sig = signatures(texts).astype(np.uint32)
            sets, whole = [], []
            for _, run in slices(texts):
                d, h = distinct_shingles(words_of(run), WIDTH)
                cut = np.searchsorted(d, np.arange(1, len(run)))
                sets += np.split(h.view(np.int64), cut)
                whole += [hashlib.md5(t).hexdigest() for t in run]
            bands = [np.frombuffer(mix64(np.frombuffer(r.tobytes(), np.uint64).reshape(-1, 2)[:, 0]
                                         + mix64(np.frombuffer(r.tobytes(), np.uint64).reshape(-1, 2)[:, 1])
                                         + np.arange(PERMUTATIONS // BAND_ROWS, dtype=np.uint64)).tobytes(), np.int64)
                     for r in sig]
            yield pd.DataFrame({"doc_id": b["doc_id"], "whole": whole, "n": [len(s) for s in sets],
                                "bands": bands, "shingles": sets})

    every = stored(docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                   .mapInPandas(sign, "doc_id long, whole string, n long, bands array<long>, shingles array<long>"),
                   "signatures")
    classes = every.groupBy("whole").agg(F.min("doc_id").alias("id"))
    members = every.select("doc_id", "whole", "n").join(classes, "whole").select(
        "doc_id", "n", F.when(F.col("n") > 0, F.col("id")).alias("id"))
    own = every.join(classes.select("whole", F.col("id").alias("doc_id")), ["whole", "doc_id"], "left_semi")
    sets = own.where("n > 0").select(F.col("doc_id").alias("id"), "n", "bands", "shingles").dropDuplicates(["id"])
    entries = sets.select(F.explode("bands").alias("shingle"), "id", "n",
                          F.lit(0).alias("pos"))
    linked = link_entries(entries, sets, members, percent)
    return linked.select("doc_id", F.col("component_id").alias("class_id"))
