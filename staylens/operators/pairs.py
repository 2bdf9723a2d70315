"""Many-to-many join sized by its output.

An equi-join of two sides that both repeat a key makes ``n_left * n_right`` rows
per key, so neither the number of input bytes nor Spark's adaptive re-planning
(which looks at shuffled bytes) says how much work a task gets. Here the rows per
key are counted on both sides first (map-side combined, a few numbers per key):

* the exchange gets as many partitions as the joined rows need at
  ``pairs_per_task`` each;
* a key with more joined rows than that is cut into a grid of cells: its rows on
  either side are dealt to parts, and a row is copied once for every part of the
  other side. The smaller side stays whole where it can (at most
  ``sqrt(pairs_per_task)`` of its rows go in a cell), the larger one is cut until
  a cell makes about ``pairs_per_task`` rows.

Rows are dealt by a hash of a column that tells them apart, so a task that is run
again deals them alike. Null keys join nothing.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.session import stored

#: Joined rows that one task makes, about.
PAIRS_PER_TASK = 2_000_000
#: More tasks than this cost more to hand out than they save.
MAX_TASKS = 100_000


def key_sizes(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, l_rows, r_rows) of every key that joins."""
    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))

    return rows(left, "l_rows").join(rows(right, "r_rows"), key)


def _grid(pairs_per_task: int) -> tuple[Column, Column]:
    """Parts of the left and of the right side of a key."""
    small, large = F.least("l_rows", "r_rows"), F.greatest("l_rows", "r_rows")
    small_rows = F.least(small, F.lit(max(1, math.isqrt(pairs_per_task))))
    small_parts = F.ceil(small / small_rows)
    large_parts = F.ceil(large / F.greatest(F.lit(1), F.floor(F.lit(pairs_per_task) / small_rows)))
    left_small = F.col("l_rows") <= F.col("r_rows")
    return (F.when(left_small, small_parts).otherwise(large_parts),
            F.when(left_small, large_parts).otherwise(small_parts))


def fan_out_join(left: DataFrame, right: DataFrame, key: str, left_tag: str, right_tag: str,
                 pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """Inner join on ``key``; ``left_tag`` / ``right_tag`` name a column of each
    side that differs from row to row. The columns are those of a join using
    ``key``."""
    sizes = stored(key_sizes(left, right, key), "key-sizes")
    pairs = F.col("l_rows").cast("double") * F.col("r_rows")
    l_parts, r_parts = _grid(pairs_per_task)
    hot = sizes.where(pairs > pairs_per_task).select(
        F.col(key).alias("_hot_key"), l_parts.alias("_l_parts"), r_parts.alias("_r_parts"))
    total = sizes.agg(F.sum(pairs).alias("pairs")).first()["pairs"] or 0
    tasks = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                min(MAX_TASKS, math.ceil(total / pairs_per_task)))

    def dealt(df: DataFrame, tag: str, own: str, other: str, own_cell: str, other_cell: str) -> DataFrame:
        marked = df.where(F.col(key).isNotNull()).join(hot, F.col(key) == F.col("_hot_key"), "left")
        parts = F.coalesce(F.col(own), F.lit(1))
        copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col(other), F.lit(1)).cast("bigint") - 1)
        return marked.select(*df.columns, F.pmod(F.xxhash64(tag), parts).cast("bigint").alias(own_cell),
                             F.explode(copies).alias(other_cell)).repartition(tasks, key, "_l_cell", "_r_cell")

    return (dealt(left, left_tag, "_l_parts", "_r_parts", "_l_cell", "_r_cell")
            .join(dealt(right, right_tag, "_r_parts", "_l_parts", "_r_cell", "_l_cell"), [key, "_l_cell", "_r_cell"])
            .drop("_l_cell", "_r_cell"))
