"""Operator 9, best-fit packing of documents into sequences.

A document becomes its subword ids and an end id; only documents longer than a
sequence are cut, into pieces of ``capacity`` ids and a rest. Pieces are packed
by vector best fit: every sequence has three residual capacities (tokens,
documents, attention cost = sum of squared piece lengths); pieces come longest
first, and a piece goes to the open sequence that satisfies every constraint
and is left with the smallest weighted norm of its residuals (or has the
largest weighted dot product of demand and residuals).

Scale: pieces (a few numbers each) are dealt evenly into chunks of
``CHUNK`` and every chunk is packed by one task; a chunk leaves at most about
one sequence partly filled, CHUNK pieces being hundreds of sequences. The ids
themselves are never shuffled. Where the documents have an order (``order``
columns), chunks are runs of CHUNK pieces of it, and sequences are numbered by
chunk and, in a chunk, by their first piece in that order.

Edge cases: null text is the empty text, whose only id is the end id; null or
repeated doc_ids are pieces like others; very long texts give many pieces; other
columns are ignored; an empty table gives no pieces.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import shuffle_partitions, stored
from staylens.llm.subwords import default_vocabulary, loaded
from staylens.llm.words import runs

CAPACITY = 2048
END_ID = 0
CHUNK = 4096
#: Weights of the token, document and attention-cost residuals.
WEIGHTS = (1.0, 0.3, 0.3)
PIECE = ["doc_id long", "piece int", "start long", "length long"]
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
           vocabulary: str | None = None, order: tuple[str, ...] = (), digest: bool = False) -> DataFrame:
    """One row per piece; ``ids`` holds little-endian unsigned 32-bit ids, or with
    ``digest`` ``ids_crc32`` their crc32. The integer columns ``order`` go along."""
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())  # fixed size, 1.7 MB
    schema = [*PIECE, "ids_crc32 long" if digest else "ids binary"]
    columns = [c.split()[0] for c in schema] + list(order)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = loaded(file.value)
        for batch in batches:
            texts, doc_ids = batch["text"].tolist(), batch["doc_id"].tolist()
            places = list(zip(*(batch[c].tolist() for c in order))) if order else [()] * len(texts)
            for at, end in runs(texts):
                flat, counts = bpe.ids_of(texts[at:end])
                ends = np.cumsum(counts)
                rows = []
                for i, (lo, hi) in enumerate(zip(ends - counts, ends)):
                    ids = np.append(flat[lo:hi], end_id).astype("<u4")
                    for k, s in enumerate(range(0, len(ids), capacity)):
                        part = ids[s: s + capacity]
                        raw = part.tobytes()
                        rows.append((doc_ids[at + i], k, s, len(part), zlib.crc32(raw) if digest else raw,
                                     *places[at + i]))
                yield pd.DataFrame(rows, columns=columns).astype(
                    {"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *order).mapInPandas(
        cut, ", ".join([*schema, *(f"{c} long" for c in order)]))


def best_fit(lengths: np.ndarray, capacity: int, max_docs: int, max_cost: int,
             weights: tuple[float, float, float], by: str = "norm") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, bin, offset) of pieces, longest first."""
    order = np.argsort(-lengths, kind="stable")
    limits = np.array([capacity, max_docs, max_cost], float)
    w = np.array(weights) / limits ** 2
    left = np.zeros((len(lengths), 3))  # residuals of open bins, others behind
    ids = np.zeros(len(lengths), np.int64)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    n_open = n_bins = 0
    least = lengths.min() if len(lengths) else 0
    for k, length in enumerate(lengths[order]):
        need = np.array([length, 1.0, float(length) ** 2])
        after = left[:n_open] - need
        fits = np.flatnonzero((after >= 0).all(1))
        if len(fits):
            score = (after[fits] ** 2) @ w if by == "norm" else -(left[fits] @ (need * w))
            b = fits[score.argmin()]
        else:
            b = n_open
            left[b], ids[b] = limits, n_bins
            n_open, n_bins = n_open + 1, n_bins + 1
        bins[k], offsets[k] = ids[b], capacity - int(left[b, 0])
        left[b] -= need
        if left[b, 0] < least or left[b, 1] < 1 or left[b, 2] < float(least) ** 2:  # full
            n_open -= 1
            left[b], ids[b] = left[n_open], ids[n_open]
    return order, bins, offsets


def pack(rows: DataFrame, capacity: int = CAPACITY, max_docs: int | None = None,
         max_cost: int | None = None, weights: tuple[float, float, float] = WEIGHTS,
         by: str = "norm", order: tuple[str, ...] = ()) -> DataFrame:
    """Place pieces (doc_id, piece, start, length, ids_crc32) in sequences. The
    document and cost limits default to what the token limit implies. ``order``:
    columns whose order the sequences follow, chunk by chunk."""
    rows = stored(rows, "pieces")  # before anything that reads it twice
    if order:
        rows = _numbered(rows, order)
    chunks = max(1, round(rows.count() / CHUNK))
    max_docs = max_docs or capacity
    max_cost = max_cost or capacity ** 2

    def place(chunk: pd.DataFrame) -> pd.DataFrame:
        if order:
            chunk = chunk.sort_values("at")
        length = chunk["length"].to_numpy()
        longest, bins, offsets = best_fit(length, capacity, max_docs, max_cost, weights, by)
        if order and len(bins):  # number the sequences by their first piece
            first = np.full(bins.max() + 1, len(bins))
            np.minimum.at(first, bins, longest)
            bins = np.argsort(np.argsort(first))[bins]
        out = chunk.iloc[longest][["doc_id", "piece", "start", "length", "ids_crc32"]]
        return out.assign(doc_id=out["doc_id"].astype("Int64"), sequence_id=bins + (chunk["chunk"].iat[0] << 32),
                          offset=offsets)

    if order:  # equal runs, at most half a CHUNK longer than one
        chunk = F.expr(f"at * {chunks} div {max(1, rows.count())}")
    else:
        chunk = F.monotonically_increasing_id() % chunks
    return rows.withColumn("chunk", chunk).groupBy("chunk").applyInPandas(place, PLACED)


def _numbered(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """``rows`` stored with ``at``, their number by ``order`` and piece from 0: ranges
    sorted apart, then each range's start added, so no task holds all rows."""
    spread = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *order, "piece")
    tagged = stored(spread.sortWithinPartitions(*order, "piece").withColumn("part", F.spark_partition_id())
                    .withColumn("tag", F.monotonically_increasing_id()), "pieces")
    sizes = tagged.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()  # a row a partition
    starts, total = [], 0
    for r in sizes:
        starts.append((r["part"], total))
        total += r["n"]
    start = rows.sparkSession.createDataFrame(starts, "part int, begin long")
    return (tagged.join(F.broadcast(start), "part")  # broadcast: a row a partition
            .withColumn("at", F.col("begin") + F.col("tag").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("part", "tag", "begin"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = (), **options) -> DataFrame:
    """Digest of the packed sequences: one row per piece with its place."""
    return pack(pieces(docs, capacity, order=order, digest=True), capacity, order=order, **options)
