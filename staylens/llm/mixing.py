"""Operator 2, mixing sources to target weights by Pfair scheduling
(DataFrame functions only).

Each source is cut into blocks of ``block_rows`` documents. With integer shares
q_s (sum D) of the target weights, block j of source s may not come before slot
floor(j D / q_s) and must come before slot ceil((j+1) D / q_s); one block a slot,
the earliest deadline among the released ones first. Unit jobs of such windows
always meet them, so after every slot each source has had its weighted share of
blocks to within less than one block (as long as no source has run out).

The target weights are the integer shares. Whole-number weights whose sum (in lowest
terms) is at most ``period`` are shares as they are, so a mix of 3 : 2 : 1 stays so
for ever. Other weights, as the square roots of the sources' sizes, are first
rounded to shares of about ``period`` slots in all: against the weights before
rounding the mix can be off by 1 / (2 period) of the slots.

The windows repeat after D slots, so the order is computed once for one period
of D = sum of shares slots, a table bounded by ``period`` and the number of
sources and not by the data, and every block looks up its slot in it. All rows
are kept: the slots of a source that has run out stay empty, the others keep
their order.

Within a source, documents come in the order of an md5 over doc_id and text. They
are numbered in shards of that order (sizes summed first), so a source with a third
of all rows, or an id that many texts share, is spread over many tasks.

Edge cases: a null source is a source of its own; null and repeated doc_ids are
rows like others (ties by text); weights that name only some sources give the
rest the smallest share; other columns pass through; an empty table gives an
empty result.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 16
PERIOD = 1000
#: Slots a source has at least on average in a period, so that shares of many
#: sources are still told apart.
SLOTS_PER_SOURCE = 8
ROWS_PER_SHARD = 2000


def _key(source):
    return F.coalesce(F.concat(F.lit("s:"), source.cast("string")), F.lit("null"))


def _whole_shares(weights: dict[str, float] | None, period: int) -> dict[str, int]:
    """Positive whole-number weights in lowest terms, if their sum fits a period."""
    if not weights or any(w <= 0 or w != int(w) for w in weights.values()):
        return {}
    least = math.gcd(*(int(w) for w in weights.values()))
    made = {k: int(w) // least for k, w in weights.items()}
    return made if sum(made.values()) <= period else {}


def _place_key(doc_id, text):
    """Order of a source's documents: a hash of id and text, as hexadecimal digits."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"),
                          F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))


def shares(docs: DataFrame, weights: dict[str, float] | None = None,
           period: int = PERIOD) -> DataFrame:
    """(key, share): integer shares, at least 1, proportional to ``weights`` or,
    without them, to the square root of each source's number of rows."""
    sources = docs.groupBy(_key(F.col("source")).alias("key")).agg(F.count("*").alias("n"))
    whole = _whole_shares(weights, period)
    if whole:
        given = F.create_map(*[x for k, q in sorted(whole.items()) for x in (F.lit(f"s:{k}"), F.lit(q))])
        return sources.select("key", F.coalesce(given[F.col("key")], F.lit(1)).cast("bigint").alias("share"))
    if weights:
        given = F.create_map(*[x for k, w in sorted(weights.items())
                               for x in (F.lit(f"s:{k}"), F.lit(float(w)))])
        sources = sources.withColumn("w", F.coalesce(given[F.col("key")], F.lit(0.0)))
    else:
        sources = sources.withColumn("w", F.sqrt("n"))
    total = sources.agg(F.sum("w").alias("w_sum"), F.count("*").alias("n_sources"))
    slots = F.greatest(F.lit(period), F.lit(SLOTS_PER_SOURCE) * F.col("n_sources"))
    return sources.crossJoin(F.broadcast(total)).select(  # one row of totals
        "key", F.greatest(F.lit(1), F.round(F.col("w") / F.col("w_sum") * slots)).cast("bigint").alias("share"))


#: Earliest deadline first over one period. q: array of (key, share), d: their
#: sum; state: c = blocks given so far by source, p = picks in slot order.
_EDF = """
aggregate(sequence(0L, d - 1),
  named_struct('c', transform(q, x -> 0L),
               'p', cast(array() as array<struct<i:int,j:bigint>>)),
  (a, t) -> transform(array(array_min(filter(
      transform(q, (x, i) -> named_struct('due', ((a.c[i] + 1) * d + x.share - 1) div x.share, 'i', i, 'j', a.c[i],
                                          'open', a.c[i] < x.share and (a.c[i] * d) div x.share <= t)),
      x -> x.open))),
    b -> named_struct('c', transform(a.c, (n, i) -> if(i = b.i, n + 1, n)),
                      'p', concat(a.p, array(named_struct('i', b.i, 'j', b.j)))))[0],
  a -> a.p)
"""


def schedule(share: DataFrame) -> DataFrame:
    """(key, share, j, t, d): in every period of d slots, block j of the
    source's share stands in slot t."""
    one = share.agg(F.sort_array(F.collect_list(F.struct("key", "share"))).alias("q"),
                    F.sum("share").alias("d")).where("d > 0")
    return (one.select("q", "d", F.posexplode(F.expr(_EDF)).alias("t", "pick"))
            .select(F.expr("q[pick.i].key").alias("key"), F.expr("q[pick.i].share").alias("share"),
                    F.col("pick.j").alias("j"), F.col("t").cast("bigint").alias("t"), "d"))


def place(docs: DataFrame, weights: dict[str, float] | None = None,
          block_rows: int = BLOCK_ROWS, period: int = PERIOD) -> DataFrame:
    """(row, block, slot, offset): each row of ``docs`` as a struct with its block of
    its source (from 0), the block's slot in the mix and the place in the block."""
    digits = max(1, math.ceil(math.log(max(2, docs.count() / ROWS_PER_SHARD), 16)))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    row = (row.withColumn("key", _key(F.col("row.source")))
           .withColumn("h", _place_key(F.col("row.doc_id"), F.col("row.text")))
           .withColumn("shard", F.substring("h", 1, digits)))
    sizes = (docs.select(_key(F.col("source")).alias("key"),
                         F.substring(_place_key(F.col("doc_id"), F.col("text")), 1, digits).alias("shard"))
             .groupBy("key", "shard").agg(F.count("*").alias("n")))
    before = Window.partitionBy("key").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("key", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("key", "shard").orderBy("h", "row.doc_id", "row.text")
    numbered = (row.withColumn("at", F.row_number().over(inside) - 1)
                .join(starts, ["key", "shard"])
                .withColumn("at", F.col("at") + F.col("start"))
                .withColumn("block", F.expr(f"at div {block_rows}"))
                .withColumn("offset", (F.col("at") % block_rows).cast("int")))
    # broadcast: max(period, 8 x sources) rows and at most one more a source
    order = F.broadcast(schedule(shares(docs, weights, period)))
    per_source = order.select("key", F.col("share").alias("own")).distinct()
    placed = (numbered.join(F.broadcast(per_source), "key")
              .withColumn("j", F.expr("block % own"))
              .join(order, ["key", "j"])
              .withColumn("slot", F.expr("(block div own) * d + t")))
    return placed.select("row", "block", "slot", "offset")


def mix(docs: DataFrame, weights: dict[str, float] | None = None,
        block_rows: int = BLOCK_ROWS, period: int = PERIOD) -> DataFrame:
    """``docs`` plus ``block``, ``slot`` and ``offset`` of ``place``, which take the
    place of columns with these names."""
    own = ("block", "slot", "offset")
    kept = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in own]
    return place(docs, weights, block_rows, period).select(*kept, *own)


def in_order(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """``docs`` sorted by their place in the mix."""
    return (place(docs, weights).orderBy("slot", "offset")
            .select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))


#: The same order, slot by slot in a recursive statement.
ORACLE = f"""
WITH RECURSIVE sources AS (
  SELECT coalesce('s:' || source, 'null') AS key, sqrt(count(*)) AS w FROM documents GROUP BY 1),
quota AS (
  SELECT key, row_number() OVER (ORDER BY key) - 1 AS i,
         greatest(1, round(w / sum(w) OVER () * greatest({PERIOD}, {SLOTS_PER_SOURCE} * count(*) OVER ())))::BIGINT AS share
  FROM sources),
total AS (SELECT sum(share)::BIGINT AS d FROM quota),
step(t, i, j, due_c) AS (
  SELECT -1::BIGINT, -1::BIGINT, -1::BIGINT, (SELECT list(0::BIGINT ORDER BY i) FROM quota)
  UNION ALL
  SELECT t + 1, pick.i, pick.c,
         list_transform(due_c, lambda n, k: CASE WHEN k = pick.i + 1 THEN n + 1 ELSE n END)
  FROM (SELECT s.t, s.due_c,
               (SELECT min(struct_pack(due := ((s.due_c[q.i + 1] + 1) * d + share - 1) // share, i := q.i, c := s.due_c[q.i + 1]))
                FROM quota q, total
                WHERE s.due_c[q.i + 1] < share AND (s.due_c[q.i + 1] * d) // share <= s.t + 1) AS pick
        FROM step s, total WHERE s.t + 1 < d)),
numbered AS (
  SELECT doc_id, source, coalesce('s:' || source, 'null') AS key,
         row_number() OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), doc_id, text) - 1 AS pos
  FROM documents)
SELECT n.doc_id, n.source, pos // {BLOCK_ROWS} AS block,
       ((pos // {BLOCK_ROWS}) // q.share) * d + s.t AS slot, (pos % {BLOCK_ROWS})::INTEGER AS "offset"
FROM numbered n JOIN quota q USING (key), total, step s
WHERE s.i = q.i AND s.j = (pos // {BLOCK_ROWS}) % q.share
"""
