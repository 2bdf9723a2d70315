"""Structural property of the mart plans: every join input is an aggregate
(or another join), never raw snapshot rows, so no listing x host row pairs
are ever produced."""
import re

import pytest

from staylens.plans import marts
from tests.helpers import dims, snap_row as r

PASS_THROUGH = {"Project", "Filter", "Window", "Sort", "RepartitionByExpression",
                "Repartition", "WindowGroupLimit"}


def _children(node):
    ch = node.children()
    return [ch.apply(i) for i in range(ch.size())]


def _input_kind(node):
    while node.nodeName() in PASS_THROUGH:
        node = _children(node)[0]
    columns = node.schema().fieldNames() if node.nodeName() == "LogicalRelation" else []
    if sorted(columns) == ["host_neighbourhood", "host_neighbourhood_lga"]:
        return "Stored"  # the area mapping of mart 3
    if "h_rows" in columns:
        return "Stored"  # the host side, collapsed
    if "l_n" in columns or columns[-1:] == ["_high"]:
        return "Stored"  # listing prices and middle buckets of the median
    if "inactive_listing_count" in columns or "all_listing_count" in columns:
        return "Stored"  # the group statistics of marts 1 and 2
    return node.nodeName()


def _join_inputs(plan):
    out, stack = [], [plan]
    while stack:
        n = stack.pop()
        if n.nodeName() == "Join":
            out.append(tuple(_input_kind(c) for c in _children(n)))
        stack.extend(_children(n))
    return out


@pytest.mark.parametrize("build", [
    lambda l, h: marts.listing_neighbourhood_mart(l, h, True),
    lambda l, h: marts.property_type_mart(l, h, True),
    lambda l, h: marts.host_neighbourhood_mart(l, h),
    lambda l, h: marts.active_listing_stats(l, h, ["listing_neighbourhood"]),
])
def test_mart_joins_only_aggregated_inputs(spark, tmpdir_path, build):
    rows = [r(1, "2020-05"), r(1, "2020-06", active="f"), r(2, "2020-05", superhost="t")]
    ld, hd = dims(spark, rows)
    # read back from parquet so the leaves are real scans, as in production
    ld.write.parquet(f"{tmpdir_path}/l"); hd.write.parquet(f"{tmpdir_path}/h")
    l2, h2 = spark.read.parquet(f"{tmpdir_path}/l"), spark.read.parquet(f"{tmpdir_path}/h")
    plan = build(l2, h2)._jdf.queryExecution().optimizedPlan()
    joins = _join_inputs(plan)
    assert joins, "expected joins in the mart plan"
    bad = [j for j in joins if any(k not in ("Aggregate", "Join", "Stored") for k in j)]
    assert not bad, bad


def test_marts_1_and_2_join_listings_and_hosts_three_times(spark, tmpdir_path, monkeypatch):
    """Once for the stored statistics, once for the median, once for the hosts."""
    ld, hd = dims(spark, [r(1, "2020-05", superhost="t"), r(2, "2020-05", active="f")])
    ld.write.parquet(f"{tmpdir_path}/l"); hd.write.parquet(f"{tmpdir_path}/h")
    l2, h2 = spark.read.parquet(f"{tmpdir_path}/l"), spark.read.parquet(f"{tmpdir_path}/h")
    plans = []
    keep = marts.stored
    monkeypatch.setattr(marts, "stored", lambda df, tag: (plans.append(df), keep(df, tag))[1])
    plans.append(marts.listing_neighbourhood_mart(l2, h2))
    scans = sum(p._jdf.queryExecution().optimizedPlan().toString().count(f"Relation [") for p in plans)
    assert len(plans) == 2 and scans <= 8  # two a join and the stored statistics twice


def test_mart3_broadcasts_the_mapping_and_leaves_host_rows_in_place(spark, tmpdir_path):
    ld, hd = dims(spark, [r(k, f"2020-0{1 + k % 9}", host=f"h{k}", superhost="t") for k in range(50)])
    ld.write.parquet(f"{tmpdir_path}/l"); hd.write.parquet(f"{tmpdir_path}/h")
    mart = marts.host_neighbourhood_mart(spark.read.parquet(f"{tmpdir_path}/l"), spark.read.parquet(f"{tmpdir_path}/h"))
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(host_neighbourhood#\d+, \d+\)", plan)
    assert re.search(r"BroadcastHashJoin \[host_neighbourhood#\d+\], \[host_neighbourhood#\d+\], Inner, BuildRight", plan)


def test_mart3_with_one_hot_host_area_and_one_hot_listing(spark):
    from tests import brute
    from tests.helpers import rows_of
    rows = [r(1 if k % 2 else k, f"2020-0{1 + k % 9}", nb="A" if k % 5 else "B", host=f"h{k % 37}", price=k,
              host_nb="hot" if k % 3 else f"n{k % 4}") for k in range(240)]
    ld, hd = dims(spark, rows)
    def norm(x):
        return sorted(map(str, rows_of(x)))
    assert norm(marts.host_neighbourhood_mart(ld, hd)) == norm(brute.host_neighbourhood_mart(ld, hd))
    keys = ["listing_neighbourhood"]
    assert norm(marts.active_listing_stats(ld, hd, keys)) == norm(brute.active_listing_stats(ld, hd, keys))
