"""Operator 1, exact top-k inner product search with two cover trees.

Queries and data are both indexed: a cover tree node has a centre, a covering
radius and children whose centres lie apart and cover its points at a smaller
scale. For a query node (centre q, radius s) and a data node (centre r, radius t)
no pair of their points scores above q.r + s |r| + t |q| + s t; the pair is
pruned when that is under the worst k-th score of the node's queries so far.
What is left is scored exactly, in integers, so results equal a full scan.

Scale: queries are taken in blocks of ``QUERY_BLOCK`` vectors (a few MB, broadcast
with their trees and first k-th scores, found on ``SEED_ROWS`` data rows); each task streams its part of the
data in chunks of ``CHUNK`` rows, a tree a chunk, and keeps k results a query; the
tasks' results merge by a window on query_id.

Edge cases: vectors that are null or hold null or non-finite components, and null
ids, take no part; a vector is compared with those of its own length only; rows
that share the query's id count as its own; equal scores go to the smaller
vec_id; fewer than k candidates give fewer rows; scores are exact integers up to
the limits of a long, one beyond them is an error. Other
columns are ignored; an empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 20
QUERY_STEP = 20
SCALE = 64
QUERY_BLOCK = 8192
SEED_ROWS = 4096
CHUNK = 2048
#: A node's children cover it at 1 / BASE of its radius; smaller nodes are leaves.
BASE = 1.3
LEAF = 24
#: No score yet; its negative is a long too.
_LOWEST = np.iinfo(np.int64).min + 1


@dataclass
class CoverTree:
    """Points in leaf order and nodes by number (0 is the root)."""
    ids: np.ndarray
    points: np.ndarray
    centre: np.ndarray  # centres (nodes x dim)
    norm: np.ndarray
    radius: np.ndarray
    begin: np.ndarray  # points of a node: begin..end
    end: np.ndarray
    child: list[np.ndarray]  # children of a node, empty for a leaf

    @classmethod
    def build(cls, ids: np.ndarray, points: np.ndarray) -> CoverTree:
        square = (points ** 2).sum(1)
        dist = np.sqrt(np.maximum(square[:, None] + square - 2 * points @ points.T, 0))
        order: list[np.ndarray] = []
        centre, radius, begin, end, child = [], [], [], [], []
        placed = 0

        def grow(c: int, members: np.ndarray) -> int:
            nonlocal placed
            me = len(centre)
            r = float(dist[c, members].max())
            centre.append(c)
            radius.append(r)
            begin.append(placed)
            end.append(0)
            child.append(np.zeros(0, np.int64))
            if len(members) <= LEAF or r == 0:
                order.append(members)
                placed += len(members)
            else:
                # centres more than r / BASE apart that cover all members
                near = dist[c, members]
                open_, centres = near > r / BASE, [c]
                gap = near.copy()
                while open_.any():
                    new = members[np.where(open_, gap, -1).argmax()]
                    centres.append(new)
                    gap = np.minimum(gap, dist[new, members])
                    open_ = gap > r / BASE
                at = dist[np.ix_(members, centres)].argmin(1)
                child[me] = np.array([grow(k, members[at == i]) for i, k in enumerate(centres) if (at == i).any()])
            end[me] = placed
            return me

        grow(0, np.arange(len(ids)))
        order_ = np.concatenate(order)
        c = points[centre]
        # rounding of distances must not make a radius too small
        far = np.array(radius) * (1 + 1e-9) + 1e-6 * np.sqrt(square.max())
        return cls(ids[order_], points[order_], c, np.sqrt((c ** 2).sum(1)), far, np.array(begin), np.array(end), child)


class TopK:
    """Best k (score, id) of each query of a tree, worst last."""

    def __init__(self, tree: CoverTree, k: int):
        self.tree, self.k = tree, k
        self.score = np.full((len(tree.ids), k), _LOWEST, np.int64)
        self.id = np.full((len(tree.ids), k), np.iinfo(np.int64).max)
        #: known lower bounds of the k-th score; rounding to a float keeps their order
        self.least = np.full(len(tree.ids), -np.inf)

    def offer(self, lo: int, hi: int, ids: np.ndarray, points: np.ndarray) -> None:
        s = _products(self.tree.points[lo:hi], points)
        s[self.tree.ids[lo:hi, None] == ids] = _LOWEST
        some = (s >= self.least[lo:hi, None]).any(0)
        if not some.any():
            return
        s = np.concatenate((self.score[lo:hi], s[:, some]), 1)
        i = np.concatenate((self.id[lo:hi], np.broadcast_to(ids[some], (hi - lo, some.sum()))), 1)
        best = np.lexsort((i, -s))[:, : self.k]
        self.score[lo:hi], self.id[lo:hi] = np.take_along_axis(s, best, 1), np.take_along_axis(i, best, 1)
        worst = self.score[lo:hi, -1]
        self.least[lo:hi] = np.maximum(self.least[lo:hi], np.where(worst > _LOWEST, worst, -np.inf))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer vectors (held as floats), exact."""
    size = max(1, a.shape[1]) * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    if size < 2**53:
        return (a @ b.T).astype(np.int64)
    if size < 2**63:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = np.frompyfunc(int, 1, 1)
    exact = np.asarray(whole(a) @ whole(b).T, object).reshape(len(a), len(b))
    return exact.astype(np.int64)  # an OverflowError where a score is no long


def search(found: TopK, data: CoverTree) -> None:
    """Offer all of ``data`` that can matter to ``found``."""
    q = found.tree

    def bound(node: int, cand: np.ndarray) -> np.ndarray:
        s, t = q.radius[node], data.radius[cand]
        return data.centre[cand] @ q.centre[node] + s * data.norm[cand] + t * q.norm[node] + s * t

    def visit(node: int, cand: np.ndarray) -> None:
        lo, hi = q.begin[node], q.end[node]
        inner = len(q.child[node]) > 0
        while True:
            worst = found.least[lo:hi].min()
            b = bound(node, cand)
            keep = b * (1 + 1e-9 * np.sign(b)) >= worst  # ties count
            cand, b = cand[keep], b[keep]
            wide = np.array([len(data.child[c]) > 0 and (not inner or data.radius[c] >= q.radius[node]) for c in cand], bool)
            if not wide.any():
                break
            cand = np.concatenate([cand[~wide], *[data.child[c] for c in cand[wide]]])
        if not len(cand):
            return
        if inner:
            for c in q.child[node]:
                visit(c, cand)
            return
        order = np.argsort(-b)
        cand, b = cand[order], b[order]
        size = np.cumsum(data.end[cand] - data.begin[cand])
        at, room = 0, 512 if np.isfinite(found.least[lo:hi]).all() else 2 * found.k  # few until there is a bound
        while at < len(cand):
            stop = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + room, "right")))
            room = 512
            able = b * (1 + 1e-9 * np.sign(b)) >= found.least[lo:hi].min()  # falling bounds: a prefix
            stop = min(stop, int(able.sum()))
            if stop <= at:
                return
            rows = np.concatenate([np.arange(data.begin[c], data.end[c]) for c in cand[at:stop]])
            found.offer(lo, hi, data.ids[rows], data.points[rows])
            at = stop

    visit(0, np.zeros(1, np.int64))


def _trees(ids: np.ndarray, vectors: list[np.ndarray]) -> Iterator[CoverTree]:
    """Cover trees of at most CHUNK vectors of one length each."""
    length = np.array([len(v) for v in vectors])
    for n in np.unique(length):
        at = np.flatnonzero(length == n)
        for i in range(0, len(at), CHUNK):
            part = at[i: i + CHUNK]
            yield CoverTree.build(ids[part], np.stack([vectors[j] for j in part]))


def _integers(batch: pd.DataFrame, scale: int) -> tuple[np.ndarray, list[np.ndarray]]:
    return batch["vec_id"].to_numpy(np.int64), [np.floor(scale * np.asarray(v, float)) for v in batch["embedding"]]


def top_k(data: DataFrame, k: int = K, query_step: int = QUERY_STEP, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose vec_id is divisible by
    ``query_step``, against all rows."""
    spark = data.sparkSession
    sound = data.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias(
        "embedding")).where("vec_id is not null and embedding is not null and forall(embedding, "
                            "x -> x is not null and not isnan(x) and abs(x) < double('inf'))")
    queries = sound.where(F.col("vec_id") % query_step == 0)
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    seed_ids, seeds = _integers(sound.orderBy(F.xxhash64("vec_id")).limit(SEED_ROWS).toPandas(), scale)
    seed_trees = list(_trees(seed_ids, seeds))
    parts = []
    for i in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)) == i)
        ids, vectors = _integers(block.dropDuplicates(["vec_id", "embedding"]).toPandas(), scale)
        groups = []
        for tree in _trees(ids, vectors):
            first = TopK(tree, k)
            for s in seed_trees:
                if s.points.shape[1] == tree.points.shape[1]:
                    search(first, s)
            groups.append((tree, first.least))
        parts.append(sound.mapInPandas(_against(spark.sparkContext.broadcast(groups), k, scale),
                                       "query_id long, vec_id long, score long"))
    found = reduce(DataFrame.unionByName, parts)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _against(groups, k: int, scale: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = []
        for tree, least in groups.value:
            top = TopK(tree, k)
            top.least = least.copy()
            best.append(top)
        for batch in batches:
            for data in _trees(*_integers(batch, scale)):
                for top in best:
                    if top.tree.points.shape[1] == data.points.shape[1]:
                        search(top, data)
        for top in best:
            row, col = np.nonzero(top.score > _LOWEST)
            yield pd.DataFrame({"query_id": top.tree.ids[row], "vec_id": top.id[row, col],
                                "score": top.score[row, col]})
    return run


#: All inner products, by plain SQL.
ORACLE = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.e, r.e)::BIGINT AS score
  FROM v q JOIN v r ON q.vec_id <> r.vec_id AND len(q.e) = len(r.e) WHERE q.vec_id % {QUERY_STEP} = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= {K}
"""
