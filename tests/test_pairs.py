"""The fan-out join against a plain one, and how it spreads a hot key."""
import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from staylens.operators import pairs


def sides(spark, left_keys, right_keys):
    left = spark.createDataFrame([(k, i, f"l{i}") for i, k in enumerate(left_keys)], "k long, l_tag long, a string")
    right = spark.createDataFrame([(k, i, f"r{i}") for i, k in enumerate(right_keys)], "k long, r_tag long, b string")
    return left, right


def joined(left, right, target):
    got = pairs.fan_out_join(left, right, "k", "l_tag", "r_tag", target)
    assert got.columns == ["k", "l_tag", "a", "r_tag", "b"]
    return got


KEYS = st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(KEYS, KEYS, st.sampled_from([1, 3, 20, 10**6]))
def test_same_rows_as_a_plain_join(spark, left_keys, right_keys, target):
    left, right = sides(spark, left_keys, right_keys)
    want = [(k, i, f"l{i}", j, f"r{j}") for i, k in enumerate(left_keys)
            for j, m in enumerate(right_keys) if k is not None and k == m]
    assert Counter(tuple(r) for r in joined(left, right, target).collect()) == Counter(want)


@pytest.mark.parametrize("n_left, n_right", [(3000, 2000), (6000, 3), (2, 6000)])
def test_one_key_with_half_of_all_rows_is_spread(spark, n_left, n_right):
    rng = random.Random(2)
    left, right = sides(spark, [0] * n_left + [rng.randrange(1, 3000) for _ in range(n_left)],
                        [0] * n_right + [rng.randrange(1, 3000) for _ in range(n_right)])
    target = n_left * n_right // 40
    got = joined(left, right, target)
    per_task = [r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(per_task) >= 20 and max(per_task) <= 6 * target
    assert got.where("k = 0").count() == n_left * n_right


def test_cells_of_a_key_hold_the_wanted_rows(spark):
    sizes = spark.createDataFrame([(1000, 1000), (10**6, 10), (10, 10**6), (10**7, 10**7), (1, 1)], "l_rows long, r_rows long")
    l_parts, r_parts = pairs._grid(10_000)
    for r in sizes.select("*", l_parts.alias("lp"), r_parts.alias("rp")).collect():
        cell = -(-r["l_rows"] // r["lp"]) * -(-r["r_rows"] // r["rp"])
        assert cell <= 10_000 and r["lp"] * r["rp"] <= 4 * max(1, r["l_rows"] * r["r_rows"] / 10_000)


def test_empty_sides(spark):
    left, right = sides(spark, [], [])
    assert joined(left, right, 10).count() == 0
