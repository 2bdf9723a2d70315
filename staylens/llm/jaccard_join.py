"""Operator 8, exact Jaccard self-join of word n-gram sets with set-relation skipping.

Two documents link when 100 * intersection >= 85 * union of their distinct
4-word shingles. One row per document comes out: its set size and the smallest
doc_id of its link component.

1. *Index.* Shingles get a global order, rare ones first: the document
   frequency of every shingle is summed over all documents by hash ranges, and
   a set's prefix is its first n - ceil(0.85 n) + 1 shingles in that order.
   Linked sets share a prefix shingle, so shingles that stand in one document
   only are never listed; a document with enough of those needs no probe.
2. *Skipping by position.* Index lists are blocked by set size (a list block
   holds sizes within a factor 100/85); a probe reads two blocks a list and skips
   entries whose position leaves too few shingles for the overlap it needs.
3. *Answers from a similar set.* Equal sets are one class. Then every list names
   a leader (the entry with the fewest rarer shingles); sets that link with their
   leader take over the leader's component, and the rest of the join skips
   all pairs inside a component, which a third of all rows being near copies
   would make quadratic. Every pair across components is still verified.

Nothing is capped: all pairs that pass the filters are compared on whole sets.
Shingles are 64-bit hashes.

Edge cases: null or empty text has an empty set and links with nothing; a text
with fewer than four words is one shingle; a null doc_id gives a null component
and links with nothing; rows with the same doc_id are one node; other columns
are ignored; an empty table gives an empty result.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import stored
from staylens.llm.graph import components
from staylens.llm.words import distinct_shingles, slices, words_of

WIDTH = 4
PERCENT = 85
#: Text of one block (a task's group): a 128th of the whole, in these bounds.
BLOCK_BYTES = (1 << 20, 8 << 20)
#: Text whose shingles one hash range is sized for; every block sends a row to every
#: range, so ranges are larger than blocks and fewer.
RANGE_BYTES = (1 << 20, 48 << 20)
SETS = ("doc_id long, n long, key_hi long, key_lo long, prefix array<long>, pos array<int>, "
        "shingles array<long>")


def _block_sets(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    docs, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for at, run in slices(texts):
        d, h = distinct_shingles(words_of(run), width)
        docs.append(d + at)
        hashes.append(h)
    return np.concatenate(docs), np.concatenate(hashes)


def _ranges(distinct: np.ndarray, parts: int) -> np.ndarray:
    """Bounds of each hash range in sorted distinct hashes."""
    edges = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)
    return np.concatenate(([0], np.searchsorted(distinct, edges), [len(distinct)]))


def shingle_sets(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per document with its set, prefix and positions (``SETS``);
    ``shingles`` is null where no prefix shingle is shared."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    (low, high), (least, most) = BLOCK_BYTES, RANGE_BYTES
    blocks = max(1, round(size / min(high, max(low, size / 128))))
    parts = max(1, round(size / min(most, max(least, size / 64))))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))))

    def split(block: pd.DataFrame) -> pd.DataFrame:
        _, h = _block_sets(block["text"].tolist(), width)
        distinct, count = np.unique(h, return_counts=True)
        at = _ranges(distinct, parts)
        low32, count = distinct.astype(np.uint32), np.minimum(count, 2**31).astype(np.uint32)
        return pd.DataFrame({"part": np.arange(parts), "block": block["block"].iat[0],
                             "keys": [low32[a:b].tobytes() for a, b in zip(at, at[1:])],
                             "counts": [count[a:b].tobytes() for a, b in zip(at, at[1:])]})

    def frequency(part: pd.DataFrame) -> pd.DataFrame:
        keys = np.frombuffer(b"".join(part["keys"]), np.uint32)
        counts = np.frombuffer(b"".join(part["counts"]), np.uint32)
        _, inverse = np.unique(keys, return_inverse=True)
        df = np.bincount(inverse, weights=counts)
        level = np.log2(np.maximum(df, 1)).astype(np.uint8)[inverse]
        ends = np.cumsum([len(k) // 4 for k in part["keys"]], dtype=np.int64)
        return pd.DataFrame({"block": part["block"], "part": part["part"],
                             "levels": [x.tobytes() for x in np.split(level, ends[:-1])]})

    def prefixes(block: pd.DataFrame, levels: pd.DataFrame) -> pd.DataFrame:
        doc, h = _block_sets(block["text"].tolist(), width)
        distinct, inverse = np.unique(h, return_inverse=True)
        level = np.frombuffer(b"".join(levels.sort_values("part")["levels"]), np.uint8)[inverse]
        n = np.bincount(doc, minlength=len(block))
        first = np.concatenate(([0], np.cumsum(n)[:-1]))
        order = np.lexsort((h, level, doc))
        rank = np.arange(len(h)) - np.repeat(first, n)
        ranked, rare = h[order], level[order]
        wanted = (rank < np.repeat(n - (percent * n + 99) // 100 + 1, n)) & (rare > 0)
        per_doc = np.bincount(doc[wanted], minlength=len(block))
        cut = np.cumsum(per_doc)[:-1]
        signed = h.view(np.int64)
        key = _set_keys(h, n, first)
        return pd.DataFrame({
            "doc_id": block["doc_id"].astype("Int64"), "n": n, "key_hi": key[0], "key_lo": key[1],
            "prefix": np.split(ranked[wanted].view(np.int64), cut),
            "pos": np.split(rank[wanted].astype(np.int32), cut),
            "shingles": [signed[f: f + k] if p else None for f, k, p in zip(first, n, per_doc)]})

    counted = (rows.groupBy("block").applyInPandas(split, "part long, block long, keys binary, counts binary")
               .groupBy("part").applyInPandas(frequency, "block long, part long, levels binary"))
    return rows.groupBy("block").cogroup(counted.groupBy("block")).applyInPandas(prefixes, SETS)


def _set_keys(h: np.ndarray, n: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit key of each set: two sums of independently mixed hashes."""
    from staylens.llm.words import mix64
    out = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        total = np.concatenate(([0], np.cumsum(mix64(h ^ np.uint64(salt)), dtype=np.uint64)))
        total = total.astype(np.uint64)
        out.append((total[first + n] - total[first]).view(np.int64))
    return out[0], out[1]


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets pass the threshold."""
    def side(c):
        return sets.select(F.col("id").alias(c), F.col("shingles").alias(f"s{c}"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .where(100 * both >= percent * (F.size("sa") + F.size("sb") - both)).select("a", "b"))


def link_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    every = stored(shingle_sets(docs, width, percent), "sets")
    classes = (every.where("n > 0 and doc_id is not null").groupBy("key_hi", "key_lo", "n")
               .agg(F.min("doc_id").alias("id")))
    members = stored(every.select("doc_id", "n", "key_hi", "key_lo")
                     .join(classes, ["key_hi", "key_lo", "n"], "left")
                     .select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("id")).alias("id")), "members")
    sets = stored(every.where("shingles is not null").join(
        classes.select("key_hi", "key_lo", "n", F.col("id").alias("doc_id")), ["key_hi", "key_lo", "n", "doc_id"],
        "left_semi").select(F.col("doc_id").alias("id"), "key_hi", "n", "prefix", "pos", "shingles")
        .dropDuplicates(["id", "key_hi", "n"]), "class-sets")
    entries = sets.select("id", "n", F.explode(F.arrays_zip("prefix", "pos")).alias("e")).select(
        F.col("e.prefix").alias("shingle"), "id", "n", F.col("e.pos").alias("pos"))
    return link_entries(entries, sets, members, percent)


def link_entries(entries: DataFrame, sets: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id) from index lists ``entries`` (shingle,
    id, n, pos), whole sets (id, shingles) and ``members`` (doc_id, n, id)."""
    need = f"({percent} * (na + nb) + {99 + percent}) div {100 + percent}"
    fits = f"100 * least(na, nb) >= {percent} * greatest(na, nb) and least(na - pa, nb - pb) >= {need}"
    lead = (entries.groupBy("shingle").agg(F.min(F.struct("pos", F.xxhash64("id").alias("h"), "id", "n")).alias("l"))
            .select("shingle", F.col("l.id").alias("b"), F.col("l.n").alias("nb"), F.col("l.pos").alias("pb")))
    asked = stored(entries.select("shingle", F.col("id").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"))
                   .join(lead, "shingle").where("a <> b").where(fits)
                   .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "leaders")
    same_id = (members.where("id is not null").groupBy("doc_id").agg(F.min("id").alias("a"), F.collect_set("id").alias("bs"))
               .where("size(bs) > 1").select("a", F.explode("bs").alias("b")))
    links = stored(_linked(asked, sets, percent).unionByName(same_id), "links")
    groups = components(links)

    grouped = entries.join(groups, "id", "left").select(
        "shingle", "id", "n", "pos", F.coalesce("component", "id").alias("c"),
        F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent))).cast("int").alias("band"))
    probe = grouped.select("shingle", F.col("id").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"),
                           F.col("c").alias("ca"), F.explode(F.array("band", F.col("band") + 1)).alias("band"))
    listed = grouped.select("shingle", "band", F.col("id").alias("b"), F.col("n").alias("nb"),
                            F.col("pos").alias("pb"), F.col("c").alias("cb"))
    rest = (probe.join(listed, ["shingle", "band"])
            .where("ca <> cb and (na < nb or na = nb and a < b)").where(fits)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            .join(asked, ["a", "b"], "left_anti"))
    more = _linked(stored(rest, "pairs"), sets, percent)
    final = components(links.unionByName(more))
    return (members.join(final, "id", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "id", "doc_id").alias("component_id")))


#: The same rows by plain SQL: all pairs that share a shingle.
ORACLE = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {WIDTH} THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - {WIDTH - 2}), lambda i: array_to_string(ws[i:i + {WIDTH - 1}], ' '))) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
inter AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM inter JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= {PERCENT} * (x.n + y.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.b) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN reach r ON r.a = d.doc_id GROUP BY 1, 2
"""
