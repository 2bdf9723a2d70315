"""Operator 13, audit of how five document filters interact.

Filters, by the condition under which a text fails:

    A  under 200 words
    B  distinct words under half of the words
    C  more than 3 % of its code points are A-Z
    D  holds one of # $ % & * |
    E  the same text as a document with a smaller id, anywhere in the table

A document's failures are a mask of five bits. The audit only needs how many
documents of a part have each mask (and how many of them are labelled good or
toxic): all orders of the filters are sums over those 32 counts.

E is settled in two steps. The prepass counts text hashes in a counting Bloom
sketch: tasks count their rows in ``PROBES`` counters a text, counters of one
block of slots meet in one task and are added (two is as much as a counter has to
tell). A text with a counter below two was counted once, so it is unique for
certain. Only the other texts are shuffled, whole, to find the smallest id of
each text; the copies of a task are combined before that, so a text that a third
of the table shares sends one row a task. The ids found are joined back to the
masks by id and text hash, and the masks are counted.

Scale: the texts are read twice (masks and hashes; possible repeats) and only
possible repeats are shuffled. What is broadcast is one bit a counter,
``MAX_COUNTERS`` at most (128 MB); there are 16 counters a document up to 67
million documents. With more documents to a counter the prepass clears fewer
texts, and more are shuffled: the result is exact at every size, and a cluster
with memory for a larger sketch passes ``max_counters``.

Edge cases: null text is the empty text, null lang the empty string; a row with
null doc_id has no smaller or larger id, so it neither is a repeat nor makes one;
rows that repeat a doc_id count each (of equal texts, those with the smallest id
are all first); rows without label are neither good nor toxic, a doc_id with
several labels is good or toxic if one of them says so; other columns are
ignored; an empty table has no parts and so no rows.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import stored
from staylens.llm.words import mix64

FILTERS = "ABCDE"
REPEAT = 1 << FILTERS.index("E")
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 3
# Fixed value: the signs of filter D.
SIGNS = "[#$%&*|]"
# Fixed value: white space between words.
SPACE = " \t\n\x0b\x0c\r"

COUNTERS_PER_ROW = 16
MAX_COUNTERS = 1 << 30
MIN_COUNTERS = 1 << 16
PROBES = 4
#: The slots of a sketch are dealt to so many blocks at least, of at most
#: 2 ** 20 slots each.
BLOCKS = 256
#: Hashes that a task counts before it sends what it has.
COUNTED_AT_ONCE = 1 << 20
AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
         "unique_fails long, good_lost long, toxic_lost long, shapley long")


def text_mask(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    bare = F.btrim(text, F.lit(SPACE))
    words = F.split(bare, f"[{SPACE}]+")
    n = F.when(bare == "", 0).otherwise(F.size(words))
    distinct = F.when(bare == "", 0).otherwise(F.size(F.array_distinct(words)))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = (n < MIN_WORDS, 100 * distinct < DISTINCT_PERCENT * n,
             100 * capitals > CAPITAL_PERCENT * F.length(text), text.rlike(SIGNS))
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))


def slots(hashes: np.ndarray, counters: int) -> np.ndarray:
    """``PROBES`` slots of every hash (one row a probe)."""
    h = hashes.astype(np.int64).view(np.uint64)
    step = mix64(h) | np.uint64(1)
    probe = np.arange(PROBES, dtype=np.uint64)[:, None]
    return (mix64(h + probe * step) & np.uint64(counters - 1)).astype(np.int64)


def counters_for(rows: int, max_counters: int = MAX_COUNTERS) -> int:
    """A power of two near ``COUNTERS_PER_ROW`` a row, within the bounds."""
    wanted = 1 << max(0, rows * COUNTERS_PER_ROW - 1).bit_length()
    return max(MIN_COUNTERS, min(wanted, max_counters))


def repeated_slots(hashes: DataFrame, counters: int) -> DataFrame:
    """(block, bits): for every block of slots, those that were counted twice or
    more over all rows of ``hashes`` (one long column)."""
    block_slots = min(counters // BLOCKS, 1 << 20)

    def sketch(h: np.ndarray) -> pd.DataFrame:
        # a text counts once for each of its slots, even if two of them agree
        at = np.sort(slots(h, counters), axis=0)
        once = np.ones(at.shape, bool)
        once[1:] = at[1:] != at[:-1]
        slot, n = np.unique(at[once], return_counts=True)
        block = slot // block_slots
        first = np.flatnonzero(np.diff(block, prepend=-1))
        ends = np.append(first[1:], len(slot))
        within, n = (slot % block_slots).astype("<u4"), np.minimum(n, 2).astype(np.uint8)
        return pd.DataFrame({"block": block[first],
                             "slot": [within[a:b].tobytes() for a, b in zip(first, ends)],
                             "n": [n[a:b].tobytes() for a, b in zip(first, ends)]})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            held.append(batch.iloc[:, 0].to_numpy())
            size += len(batch)
            if size >= COUNTED_AT_ONCE:
                yield sketch(np.concatenate(held))
                held, size = [], 0
        if size:
            yield sketch(np.concatenate(held))

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, total = None, np.zeros(0, np.uint8)
        for batch in batches:
            for block, slot, n in zip(batch["block"], batch["slot"], batch["n"]):
                if block != now:
                    if now is not None:
                        yield pd.DataFrame({"block": [now], "bits": [np.packbits(total > 1).tobytes()]})
                    now, total = block, np.zeros(block_slots, np.uint8)
                at = np.frombuffer(slot, "<u4")
                total[at] = np.minimum(total[at] + np.frombuffer(n, np.uint8), 2)
        if now is not None:
            yield pd.DataFrame({"block": [now], "bits": [np.packbits(total > 1).tobytes()]})

    sketches = hashes.mapInPandas(count, "block long, slot binary, n binary")
    return (sketches.repartition("block").sortWithinPartitions("block")
            .mapInPandas(merge, "block long, bits binary"))


def possible_repeat(hashes: DataFrame, counters: int):
    """A function of a hash column: false for texts that are unique for certain."""
    block_bytes = min(counters // BLOCKS, 1 << 20) // 8
    bits = bytearray(counters // 8)  # at most MAX_COUNTERS / 8 bytes
    for r in repeated_slots(hashes, counters).toLocalIterator():
        bits[r["block"] * block_bytes:(r["block"] + 1) * block_bytes] = r["bits"]
    merged = hashes.sparkSession.sparkContext.broadcast(bytes(bits))

    @F.pandas_udf("boolean")
    def possible(h: pd.Series) -> pd.Series:
        sketch = np.frombuffer(merged.value, np.uint8)
        at = slots(h.to_numpy(), counters)
        return pd.Series(((sketch[at >> 3] >> (7 - (at & 7))) & 1).all(0))

    return possible


def masks(docs: DataFrame, max_counters: int = MAX_COUNTERS) -> DataFrame:
    """(doc_id, part, mask) of every document."""
    text = F.coalesce("text", F.lit(""))
    hashed = F.xxhash64(text)
    digest = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
        text_mask(text).alias("failed"), hashed.alias("hash"), F.xxhash64(text, F.lit(1)).alias("hash2")), "masks")
    possible = possible_repeat(digest.select("hash"), counters_for(digest.count(), max_counters))
    first = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), hashed.alias("hash"))
             .where(F.col("doc_id").isNotNull() & possible("hash"))
             .groupBy("text").agg(F.min("doc_id").alias("doc_id"))
             .select("doc_id", F.xxhash64("text").alias("hash"), F.xxhash64("text", F.lit(1)).alias("hash2"),
                     F.lit(True).alias("first")))
    # a document's id and both hashes name its text; the smallest ids come from whole texts
    flagged = digest.withColumn("possible", possible("hash")).join(
        stored(first, "first-ids"), ["doc_id", "hash", "hash2"], "left")
    repeat = F.col("possible") & F.col("doc_id").isNotNull() & F.col("first").isNull()
    return flagged.select("doc_id", "part", (F.col("failed") + F.when(repeat, REPEAT).otherwise(0)).alias("mask"))


def mask_counts(flagged: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents, and those labelled so."""
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.coalesce("quality", F.lit(0)) == 1).cast("int")).alias("good"),
        F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("int")).alias("toxic"))
    return flagged.join(known, "doc_id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def _audit_part(part: str, counts: np.ndarray) -> pd.DataFrame:
    """All orders of the filters over 32 rows of (n, good, toxic)."""
    mask = np.arange(1 << len(FILTERS))
    n, good, toxic = counts.T
    rows = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order, 1):
            own = (mask >> f & 1).astype(bool)
            still = (mask & before) == 0
            gone = own & still
            before |= 1 << f
            rows.append((part, "".join(FILTERS[k] for k in order), step, n[(mask & before) == 0].sum(), n[gone].sum(),
                         n[own & ~still].sum(), n[1 << f], good[gone].sum(), toxic[gone].sum(), f))
    out = pd.DataFrame(rows, columns=["part", "filter_order", "step", "kept", "removed", "redundant",
                                      "unique_fails", "good_lost", "toxic_lost", "f"])
    out["shapley"] = out.groupby("f")["removed"].transform("sum")
    return out.drop(columns="f")


def audit(docs: DataFrame, labels: DataFrame, max_counters: int = MAX_COUNTERS) -> DataFrame:
    """One row per part, order of the filters and step."""
    entry = F.struct("mask", "n", "good", "toxic")
    parts = mask_counts(masks(docs, max_counters), labels).groupBy("part").agg(
        F.collect_list(entry).alias("counts"))  # at most 32 entries a part

    def tables(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, entries in zip(batch["part"], batch["counts"]):
                counts = np.zeros((1 << len(FILTERS), 3), np.int64)
                for e in entries:
                    counts[e["mask"]] = e["n"], e["good"], e["toxic"]
                yield _audit_part(part, counts)

    return parts.mapInPandas(tables, AUDIT)


ORACLE = """
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words,
         row_number() OVER (PARTITION BY t ORDER BY doc_id) > 1 AS e FROM d
), m AS (
  SELECT w.part, coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic,
         (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * e::INT AS mask
  FROM w LEFT JOIN labels l USING (doc_id)
), c AS (
  SELECT part, mask, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM m GROUP BY ALL
), f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM f a, f b, f c, f d, f e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), s AS (
  SELECT filter_order, step::INT AS step, f.bit,
         list_sum([x.bit FOR x IN (SELECT list({'letter': letter, 'bit': bit}) FROM f)
                   IF instr(filter_order, x.letter) < step])::INT AS before
  FROM o, range(1, 6) r(step) JOIN f ON f.letter = filter_order[step]
), p AS (
  SELECT part, filter_order, step, s.bit,
         sum(n) FILTER (mask & (coalesce(before, 0) | s.bit) = 0) AS kept,
         sum(n) FILTER (mask & s.bit > 0 AND mask & coalesce(before, 0) = 0) AS removed,
         sum(n) FILTER (mask & s.bit > 0 AND mask & coalesce(before, 0) > 0) AS redundant,
         sum(n) FILTER (mask = s.bit) AS unique_fails,
         sum(good) FILTER (mask & s.bit > 0 AND mask & coalesce(before, 0) = 0) AS good_lost,
         sum(toxic) FILTER (mask & s.bit > 0 AND mask & coalesce(before, 0) = 0) AS toxic_lost
  FROM c, s GROUP BY ALL
)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       (sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM p
"""
