"""Surrogate keys 1..N without a single-partition sort.

The warehouse filled ids from a counter (start 1, step 1). Here the rows are
written once, tagged with ``monotonically_increasing_id`` (partition index in the
upper 31 bits, position in the lower 33), to a table in the shared scratch folder.
Per-partition row counts of that table become offsets, and
``id = offset + position + 1``. The tags are data by then: no later scan, split
size or retried task can change them. The offsets hold one row per written
partition and are broadcast, so that no row is shuffled by its partition (whole
partitions would meet in one task); the running sum over them is one small window.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens.session import stored

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def with_surrogate_id(df: DataFrame, id_col: str = "id") -> DataFrame:
    tagged = stored(df.withColumn("_sk_mid", F.monotonically_increasing_id()), "surrogate")
    part = F.shiftrightunsigned(F.col("_sk_mid"), _POS_BITS)
    counts = tagged.groupBy(part.alias("_sk_part")).agg(F.count(F.lit(1)).alias("_sk_n"))
    before = Window.orderBy("_sk_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_sk_part", F.coalesce(F.sum("_sk_n").over(before), F.lit(0)).alias("_sk_off"))
    numbered = tagged.join(F.broadcast(offsets), part == F.col("_sk_part"))
    new_id = F.col("_sk_off") + F.col("_sk_mid").bitwiseAND(F.lit(_POS_MASK)) + F.lit(1)
    return numbered.select(new_id.cast("bigint").alias(id_col), *df.columns)
