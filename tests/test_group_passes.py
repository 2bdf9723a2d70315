"""Distinct hosts as bits, the weighted median and marts that share their passes."""
import random
from bisect import bisect_right
from collections import Counter, defaultdict
from itertools import accumulate
from statistics import median

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from staylens.operators import fanout
from staylens.operators.median import PAIRS, _cuts, bucket_of, paired_median
from staylens.plans import marts
from tests import brute
from tests.helpers import dims, rows_of, snap_row as r

SETS = [marts.NEIGHBOURHOOD_KEYS, marts.PROPERTY_KEYS]


def _norm(df):
    return sorted(map(str, rows_of(df)))


LEFT = st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None]), st.integers(-300, 5000), st.integers(1, 4)), max_size=30)
RIGHT = st.lists(st.tuples(st.integers(0, 3), st.sampled_from([1, 2, None]), st.integers(1, 3)), max_size=12)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(LEFT, RIGHT)
def test_selection_and_percentile_give_the_median_of_the_pairs(spark, left_rows, right_rows):
    left = spark.createDataFrame(left_rows, "k int, g string, v long, l_n long")
    right = spark.createDataFrame(right_rows, "k int, m int, r_n long")
    values = defaultdict(list)
    for k, g, v, n in left_rows:
        for j, m, w in right_rows:
            if k == j:
                values[g, m] += [v] * n * w
    want = {key: float(median(v)) for key, v in values.items()}
    for small in (0, 3, 10**6):  # all by selection, mixed, all by percentile
        got = paired_median(left, right, "k", ["g"], ["m"], "v", "l_n", "r_n", "med", small).collect()
        assert {(x["g"], x["m"]): x["med"] for x in got} == want and len(got) == len(want)


def test_medians_of_groups_that_batches_cut(spark):
    """Rows of a group in several batches, a hot key, weights far apart."""
    rng = random.Random(7)
    left_rows = [(0 if k % 2 else rng.randrange(9), rng.choice(["a", "b", "c", None]), rng.randrange(-50, 2000),
                  rng.choice([1, 3, 1000])) for k in range(400)]
    right_rows = [(k, m, rng.choice([1, 2, 500])) for k in range(8) for m in (1, 2, 3, None) if rng.random() < 0.8]
    left = spark.createDataFrame(left_rows, "k int, g string, v long, l_n long")
    right = spark.createDataFrame(right_rows, "k int, m int, r_n long")
    values = defaultdict(Counter)
    for k, g, v, n in left_rows:
        for j, m, w in right_rows:
            if k == j:
                values[g, m][v] += n * w

    def middle(weights):
        ordered = sorted(weights)
        upto = list(accumulate(weights[v] for v in ordered))
        low, high = (ordered[bisect_right(upto, rank)] for rank in ((upto[-1] - 1) // 2, upto[-1] // 2))
        return (low + high) / 2

    want = {key: middle(c) for key, c in values.items()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        for small in (0, 100):
            got = paired_median(left, right, "k", ["g"], ["m"], "v", "l_n", "r_n", "med", small).collect()
            assert {(x["g"], x["m"]): x["med"] for x in got} == want and len(got) == len(want)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_pairs_of_the_median_are_no_rows_of_a_join(spark):
    """The right side meets the values as one array a key, and no aggregate holds a
    map of a group's values."""
    left = spark.createDataFrame([(1, "a", v, 1) for v in range(30)], "k int, g string, v long, l_n long")
    right = spark.createDataFrame([(1, m, 1) for m in range(20)], "k int, m int, r_n long")
    made = paired_median(left, right, "k", ["g"], ["m"], "v", "l_n", "r_n", "med")
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and plan.count("Join Inner") == 1
    assert [x["med"] for x in made.collect()] == [14.5] * 20


def test_cuts_bound_the_pairs_of_a_run():
    import numpy as np
    n = np.array([PAIRS // 2, PAIRS // 2, 5, 3 * PAIRS, 1, 1])
    cuts = _cuts(n)
    assert cuts[0] == 0 and cuts[-1] == len(n)
    sums = [n[a:b].sum() for a, b in zip(cuts, cuts[1:])]
    assert all(x <= PAIRS + n.max() for x in sums) and sum(sums) == n.sum()


def test_buckets_never_fall(spark):
    rows = spark.range(-70_000, 70_000).select(F.col("id").alias("v"))
    big = spark.createDataFrame([(s * (1 << k) + d,) for k in range(3, 62) for s in (1, -1) for d in (-1, 0, 1)], "v long")
    both = rows.unionByName(big).select("v", bucket_of("v").alias("b")).orderBy("v").collect()
    assert all(x["b"] <= y["b"] for x, y in zip(both, both[1:]))
    assert len({x["b"] for x in both}) > 250


def test_a_hot_listing_sends_words_and_not_hosts(spark):
    """One listing with half of all rows and 500 hosts a month."""
    rows = [r(1, f"2020-0{1 + k % 2}", nb="AB"[k % 2], host=f"h{k % 1000:04d}", superhost="t") for k in range(1000)]
    rows += [r(2 + k, "2020-01", nb="A", host=f"h{k % 40:04d}") for k in range(1000)]
    rows += [r(2, "2020-02", nb="A", host=None)]
    ld, hd = dims(spark, rows)
    hosts = fanout.host_collapse(hd)
    words = hosts.where("listing_id = 1").groupBy("listing_id", "s_date", fanout.host_word().alias("word")).agg(
        F.bit_or(fanout.host_bit()).alias("bits"))
    assert hosts.where("listing_id = 1").count() == 1000
    assert words.count() <= 2 * (1000 // 64 + 2)  # not 1000
    got = {(x["listing_neighbourhood"], x["s_date"]): x["distinct_host_count"]
           for x in rows_of(fanout.month_distinct_hosts(ld, hosts, [["listing_neighbourhood"]]).drop("key_set"))}
    names = defaultdict(set)
    for row, host, month in brute.pairs(ld, hd):
        if row["has_availability"] == "t" and host["host_name"] is not None:
            names[row["listing_neighbourhood"], month].add(host["host_name"])
    assert got == {k: len(v) for k, v in names.items()}


def test_host_numbers_are_one_to_n(spark):
    _, hd = dims(spark, [r(k, "2020-01", host=f"h{k % 7}" if k % 5 else None) for k in range(60)])
    hosts = fanout.host_collapse(hd).collect()
    numbers = Counter((x["host_name"], x["host_no"]) for x in hosts)
    assert {n for name, n in numbers if name is not None} == set(range(1, 8))
    assert all((name is None) == (n is None) for name, n in numbers) and len(numbers) == 8


def test_marts_of_one_refresh_are_those_made_apart(spark):
    rng = random.Random(3)
    rows = [r(rng.randrange(12), f"2020-0{1 + k % 4}", nb=rng.choice(["A", "B", None]), host=f"h{rng.randrange(9)}",
              price=rng.randrange(20, 400), active=rng.choice("tf"), superhost=rng.choice("tf"),
              ptype=rng.choice(["flat", "house", None])) for k in range(150)]
    ld, hd = dims(spark, rows)
    one, two = marts.listing_marts(ld, fanout.host_collapse(hd), SETS, include_keys=True)
    assert _norm(one) == _norm(brute.listing_mart(ld, hd, list(SETS[0]), True))
    assert _norm(two) == _norm(brute.listing_mart(ld, hd, list(SETS[1]), True))


def test_one_refresh_joins_listings_and_hosts_once_a_figure(spark, tmpdir_path, monkeypatch):
    """Statistics, hosts and median: one join each for both marts together, the host
    side from one stored table."""
    ld, hd = dims(spark, [r(1, "2020-05", superhost="t"), r(2, "2020-05", active="f")])
    ld.write.parquet(f"{tmpdir_path}/l")
    hd.write.parquet(f"{tmpdir_path}/h")
    l2, h2 = spark.read.parquet(f"{tmpdir_path}/l"), spark.read.parquet(f"{tmpdir_path}/h")
    plans, keep = {}, marts.stored
    hosts = fanout.host_collapse(h2)
    monkeypatch.setattr(marts, "stored", lambda df, tag: (plans.__setitem__(tag, df), keep(df, tag))[1])
    made = marts.listing_marts(l2, hosts, SETS)
    assert set(plans) == {"month-stats", "month-hosts", "month-medians"}

    def listing_host_joins(df):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        return text.count("Join Inner, (listing_id"), text

    for df in plans.values():
        joins, text = listing_host_joins(df)
        assert joins == 1 and " host_is_superhost#" not in text  # the host dimension is not read again
    assert all(listing_host_joins(df)[0] == 0 for df in made)


@pytest.mark.parametrize("sets", [[["listing_neighbourhood"]], SETS, [["room_type"], ["room_type", "accommodates"]]])
def test_rows_of_a_key_set(spark, sets):
    ld, hd = dims(spark, [r(k % 5, "2020-05", nb="AB"[k % 2], superhost="t") for k in range(20)])
    stats = fanout.month_stats(ld, fanout.host_collapse(hd), sets)
    for number, keys in enumerate(sets):
        mine = fanout.one_set(stats, number, sets)
        assert mine.columns[:len(keys) + 1] == [*keys, fanout.MONTH]
        assert _norm(mine) == _norm(fanout.keyed_month_stats(ld, hd, keys))
