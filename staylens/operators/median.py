"""Exact weighted median over pairs of two collapsed sides.

The values stand on the left side (``left_n`` rows each), the groups are made of
columns of both sides, and a value counts ``left_n * right_n`` times in every
group that its key meets. The pairs of a key are never rows of a shuffle: the right
side goes along as an array per key (one element per right group of the key), and
numpy makes the pairs in tasks, a bounded number at a time. Two ways, chosen by the
number of left rows that a group can hold at most:

* up to ``SMALL_GROUP`` left rows with the group's left columns: a row per (left
  group, key) is shuffled by left group, and one sort of the pairs of some groups
  gives their middle values;
* more: selection. Values fall in buckets that keep their order; tasks add up the
  weight per (group, bucket) and a hash aggregate adds their sums, running sums find
  the bucket or two that hold the middle ranks, and only the pairs of those buckets
  are counted value by value. All of it are sums over longs, which are combined
  before the shuffle and can spill, and no group's values are in one object.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.operators.surrogate import with_surrogate_id
from staylens.session import stored, visible

SMALL_GROUP = 4096
#: Buckets per doubling of a value.
PER_DOUBLING = 16
#: Pairs that a task holds at a time, about (at least those of a small group or a row).
PAIRS = 1 << 21
#: Left elements of a key in one row, about; a key with more gets several rows.
LIST = 512


def bucket_of(value: str) -> Column:
    """A whole number that never falls when the value rises: equal steps of the
    logarithm, mirrored for negative values."""
    x = F.col(value).cast("double")
    steps = F.floor(F.log2(F.abs(x) + 1) * PER_DOUBLING).cast("bigint")
    return F.when(x < 0, -steps).otherwise(steps)


def same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(Column.__and__, (left[c].eqNullSafe(right[f"_{c}"]) for c in columns))


def renamed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*(F.col(c).alias(f"_{c}") if c in columns else F.col(c) for c in df.columns))


def paired_median(left: DataFrame, right: DataFrame, key: str, left_groups: Sequence[str],
                  right_groups: Sequence[str], value: str, left_n: str, right_n: str, out: str,
                  small_group: int = SMALL_GROUP) -> DataFrame:
    """(left_groups, right_groups, out) of every group with a pair. ``left`` holds
    (key, left_groups, value, left_n), ``right`` (key, right_groups, right_n);
    values are not null, group columns may be. The median of an even number of
    rows is the mean of the two in the middle, as ``percentile`` gives it. The right
    groups of one key are few (the months of a listing)."""
    left_groups, right_groups = list(left_groups), list(right_groups)
    visible(left.sparkSession)
    values = stored(left.select(key, *left_groups, value, left_n), "median-values")
    sizes = values.groupBy(*left_groups).agg(F.count(F.lit(1)).alias("_rows"))
    large = stored(sizes.where(F.col("_rows") > small_group).drop("_rows"), "median-groups")
    if large.isEmpty():
        return _by_sort(values, right, key, left_groups, right_groups, value, left_n, right_n, out)
    right = stored(right.select(key, *right_groups, right_n), "median-right")  # read for numbers and for lists
    found = _by_selection(values, large, right, key, left_groups, right_groups, value, left_n, right_n, out)
    if sizes.where(F.col("_rows") <= small_group).isEmpty():
        return found  # the right side is not made into lists for no left group
    other = renamed(large, left_groups)
    small = _by_sort(values.join(other, same(values, other, left_groups), "left_anti"), right, key, left_groups,
                     right_groups, value, left_n, right_n, out)
    return small.unionByName(found)


def _codes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Numbers that are equal where the values are (nulls too)."""
    coded = column.dictionary_encode(null_encoding="encode")
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.unify_dictionaries().combine_chunks()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _lists(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(elements of all lists, bounds of each list among them)."""
    bounds = column.offsets.to_numpy().astype(np.int64)
    return column.flatten(), bounds - bounds[0]


def _pairs(l_bounds: np.ndarray, r_bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Left and right element of every pair of elements of the same row."""
    row = np.repeat(np.arange(len(l_bounds) - 1), np.diff(l_bounds))
    n = np.diff(r_bounds)[row]
    left = np.repeat(np.arange(len(row)), n)
    right = np.arange(len(left)) + np.repeat(r_bounds[row] - (np.cumsum(n) - n), n)
    return left, right


def _cuts(n_pairs: np.ndarray) -> np.ndarray:
    """Bounds of runs of rows with about PAIRS pairs (more only for a single row)."""
    upto = np.cumsum(n_pairs)
    return np.unique(np.concatenate(([0], np.flatnonzero(np.diff(upto // PAIRS)) + 1, [len(upto)])))


def _by_sort(values, right, key, left_groups, right_groups, value, left_n, right_n, out) -> DataFrame:
    """One row per (left group, key) with its values and its right side; the rows of a
    left group meet in one task, in order, and give the middle values of its groups."""
    lists = values.groupBy(key, *left_groups).agg(F.collect_list(F.struct(value, left_n)).alias("_left"))
    sides = right.groupBy(key).agg(F.collect_list(F.struct(*right_groups, right_n)).alias("_right"))
    rows = (lists.join(sides, key).select(*left_groups, "_left", "_right")
            .repartition(*left_groups).sortWithinPartitions(*left_groups))
    groups = T.StructType([*(values.schema[c] for c in left_groups), *(right.schema[c] for c in right_groups)])
    middle = T.StructType([T.StructField(f.name, f.dataType) for f in groups] + [
        T.StructField(out, values.schema[value].dataType)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of a left group that may go on, SMALL_GROUP of them at most
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if held is not None:
                rows = pa.concat_tables([held, rows]).combine_chunks()
            first = _firsts(rows, left_groups)
            yield from _middles(rows.slice(0, first[-1]), first[:-1])
            held = rows.slice(first[-1])
        if held is not None:
            yield from _middles(held, np.zeros(1, np.int64))

    def _middles(rows: pa.Table, first: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not rows.num_rows:
            return
        n = np.diff(_lists(rows["_left"].combine_chunks())[1]) * np.diff(_lists(rows["_right"].combine_chunks())[1])
        ends = np.append(first[1:], rows.num_rows)
        cuts = _cuts(np.add.reduceat(n, first))
        for a, b in zip(cuts, cuts[1:]):
            part = rows.slice(first[a], ends[b - 1] - first[a])
            yield _middle_values(part, np.repeat(np.arange(b - a), (ends - first)[a:b]), left_groups, right_groups,
                                 value, left_n, right_n, middle.names)

    return (rows.mapInArrow(run, middle).groupBy(*left_groups, *right_groups)
            .agg((F.min(out).cast("double") * 0.5 + F.max(out).cast("double") * 0.5).alias(out)))


def _firsts(rows: pa.Table, columns: Sequence[str]) -> np.ndarray:
    """Where a run of rows with equal columns begins."""
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for c in columns:
        codes = _codes(rows[c])
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def _middle_values(rows: pa.Table, group: np.ndarray, left_groups, right_groups, value, left_n, right_n,
                   names: list[str]) -> pa.RecordBatch:
    """One or two rows per group of ``rows``, whole left groups numbered by ``group``:
    the value or values in the middle of its pairs."""
    left, l_bounds = _lists(rows["_left"].combine_chunks())
    right, r_bounds = _lists(rows["_right"].combine_chunks())
    distinct, rank = np.unique(left.field(value).to_numpy(zero_copy_only=False), return_inverse=True)
    side = np.zeros(len(right), np.int64)  # number of the right group
    for c in right_groups:
        codes = _codes(right.field(c))
        _, side = np.unique(side * (codes.max(initial=0) + 1) + codes, return_inverse=True)
    sides = side.max(initial=0) + 1
    l, r = _pairs(l_bounds, r_bounds)
    row = np.repeat(np.arange(rows.num_rows), np.diff(l_bounds))
    cell = group[row[l]] * sides + side[r]
    order = np.argsort(cell * len(distinct) + rank[l])
    cell, l, r = cell[order], l[order], r[order]
    weight = left.field(left_n).to_numpy()[l] * right.field(right_n).to_numpy()[r]
    upto = np.cumsum(weight)
    first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    before = upto[first] - weight[first]
    total = np.append(before[1:], upto[-1]) - before
    low = np.searchsorted(upto, before + (total - 1) // 2, "right")
    high = np.searchsorted(upto, before + total // 2, "right")
    at = np.concatenate((low, high[distinct[rank[l[high]]] != distinct[rank[l[low]]]]))
    of_row, of_side = pa.array(row[l[at]]), pa.array(r[at])
    return pa.RecordBatch.from_arrays(
        [*(rows[c].combine_chunks().take(of_row) for c in left_groups),
         *(right.field(c).take(of_side) for c in right_groups), left.field(value).take(pa.array(l[at]))], names)


def _met(rows: DataFrame, key: str, columns: Sequence[str], arrays: DataFrame, hot: DataFrame | None,
         cut: Sequence[str]) -> DataFrame:
    """``rows`` (key, columns, _n) as lists, one row per key (some LIST elements a row
    for the keys of ``hot``, dealt by a hash of ``cut``), with the arrays _sides and _ns
    of the key's right side: they go along once, not with every left element."""
    part = F.lit(0)
    if hot is not None:
        rows = rows.join(hot, key, "left")
        part = F.pmod(F.xxhash64(*cut), F.coalesce("_parts", F.lit(1)))
    lists = rows.groupBy(key, part.alias("_part")).agg(F.collect_list(F.struct(*columns, "_n")).alias("_left"))
    return lists.join(arrays, key).select(
        *(F.col(f"_left.{c}").alias(c) for c in [*columns, "_n"]), "_sides", "_ns")


def _summed(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(columns, _side, _w): weights of the pairs of ``rows`` (as ``_met`` gives them),
    added up in a task for some PAIRS pairs at a time."""
    columns = list(columns)
    schema = T.StructType([T.StructField(c, T.LongType()) for c in [*columns, "_side", "_w"]])

    def numbered(parts: list[np.ndarray]) -> tuple[np.ndarray, int]:
        """A number per element, equal where all parts are, and a bound of it."""
        cell, spread = np.zeros(len(parts[0]), np.int64), 1
        for p in parts:
            p = p - p.min()
            most = int(p.max()) + 1
            if spread * most >= 1 << 62:  # renumbered, so that a cell stays a long
                _, cell = np.unique(cell, return_inverse=True)
                _, p = np.unique(p, return_inverse=True)
                spread = most = len(p) + 1
            cell, spread = cell * most + p, spread * most
        return cell, spread

    def add_up(batch: pa.Table) -> pa.RecordBatch:
        lefts = [_lists(batch[c].combine_chunks()) for c in [*columns, "_n"]]
        parts, l_bounds = [v.to_numpy() for v, _ in lefts], lefts[0][1]
        sides, r_bounds = _lists(batch["_sides"].combine_chunks())
        sides, ns = sides.to_numpy(), _lists(batch["_ns"].combine_chunks())[0].to_numpy()
        left_n = parts.pop()
        l, r = _pairs(l_bounds, r_bounds)
        of_left, spread = numbered(parts)
        low, width = sides.min(), int(sides.max() - sides.min()) + 1
        if spread * width >= 1 << 62:
            _, of_left = np.unique(of_left, return_inverse=True)
            spread = len(of_left)
        cell, spread = (of_left * width)[l] + (sides - low)[r], spread * width
        weight = left_n[l] * ns[r]
        if spread <= 4 * len(l) and weight.sum(dtype=float) < 1 << 52:  # a place for every cell; exact as doubles
            total = np.bincount(cell, weight, spread)
            one = np.zeros(spread, np.int64)
            one[cell] = np.arange(len(cell))
            there = np.flatnonzero(total)
            one, sums = one[there], total[there].astype(np.int64)
        else:
            order = np.argsort(cell)
            first = np.flatnonzero(np.concatenate(([True], np.diff(cell[order]) != 0)))
            one, sums = order[first], np.add.reduceat(weight[order], first)
        return pa.RecordBatch.from_arrays(
            [*(pa.array(p[l[one]]) for p in parts), pa.array(sides[r[one]]), pa.array(sums)], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, pairs = [], 0
        for batch in batches:
            n = np.diff(_lists(batch.column("_n"))[1]) * np.diff(_lists(batch.column("_sides"))[1])
            cuts = _cuts(n)
            for a, b in zip(cuts, cuts[1:]):
                waiting.append(batch.slice(a, b - a))
                pairs += int(n[a:b].sum())
                if pairs >= PAIRS:
                    yield add_up(pa.Table.from_batches(waiting))
                    waiting, pairs = [], 0
        if pairs:
            yield add_up(pa.Table.from_batches(waiting))

    return (rows.select(*columns, "_n", "_sides", "_ns").mapInArrow(run, schema)
            .groupBy(*columns, "_side").agg(F.sum("_w").alias("_w")))


def _by_selection(values, large, right, key, left_groups, right_groups, value, left_n, right_n, out) -> DataFrame:
    """Groups and right groups are numbered, so that tasks add up longs; the right
    side of a key meets its left rows as lists, wherever the join places them."""
    groups = stored(with_surrogate_id(large, "_group"), "median-groups")
    named = renamed(groups, left_groups)
    sides = stored(with_surrogate_id(right.select(*right_groups).distinct(), "_side"), "median-sides")
    named_sides = renamed(sides, right_groups)
    arrays = (right.join(named_sides, same(right, named_sides, right_groups)).groupBy(key)
              .agg(F.collect_list(F.struct("_side", right_n)).alias("_right"))
              .select(key, F.col("_right._side").alias("_sides"), F.col(f"_right.{right_n}").alias("_ns")))
    arrays = stored(arrays, "median-arrays")
    bucketed = (values.join(named, same(values, named, left_groups))
                .select(key, "_group", bucket_of(value).alias("_bucket"), value, F.col(left_n).alias("_n")))
    hot = stored(values.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / LIST).alias("_parts")).where(F.col("_parts") > 1),
                 "median-hot-keys")
    hot = None if hot.isEmpty() else hot
    cut = ["_group", value]  # a bucket alone may hold many values
    weights = _summed(_met(bucketed, key, ["_group", "_bucket"], arrays, hot, cut), ["_group", "_bucket"])
    whole = Window.partitionBy("_group", "_side")
    before = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("_w").over(whole)
    ranked = weights.select("_group", "_side", "_bucket", "_w", F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_before"),
                            F.floor((total - 1) / 2).alias("_low"), F.floor(total / 2).alias("_high"))
    middle = stored(ranked.where((F.col("_before") <= F.col("_high")) & (F.col("_before") + F.col("_w") > F.col("_low")))
                    .drop("_w"), "median-buckets")
    few = bucketed.join(middle.select("_group", "_bucket").distinct(), ["_group", "_bucket"], "left_semi")
    # the values of a bucket by number, as tasks add up longs
    known = stored(with_surrogate_id(few.select(value).distinct(), "_value"), "median-middle-values")
    counted = (_summed(_met(few.join(known, value), key, ["_group", "_bucket", "_value"], arrays, hot, cut),
                       ["_group", "_bucket", "_value"])
               .join(middle, ["_group", "_side", "_bucket"]).join(known, "_value"))
    so_far = Window.partitionBy("_group", "_side", "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("_before") + F.coalesce(F.sum("_w").over(so_far), F.lit(0))
    placed = counted.select("_group", "_side", value, "_w", "_low", "_high", at.alias("_at"))

    def holding(rank: str) -> Column:
        return F.max(F.when((F.col("_at") <= F.col(rank)) & (F.col(rank) < F.col("_at") + F.col("_w")), F.col(value)))

    found = placed.groupBy("_group", "_side").agg(
        (holding("_low").cast("double") * 0.5 + holding("_high").cast("double") * 0.5).alias(out))
    return found.join(groups, "_group").join(sides, "_side").select(*left_groups, *right_groups, out)
