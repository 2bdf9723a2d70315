"""What the marts' passes make must follow the rows, not hosts times groups."""
import random
from collections import defaultdict
from statistics import median

from pyspark.sql import functions as F

from staylens import registry
from staylens.operators import fanout
from staylens.operators import median as med
from staylens.plans import marts
from tests import brute
from tests.helpers import dims, rows_of, snap_row as r, snapshot_df


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_hosts_meet_the_groups_of_a_listing_as_bits(spark, monkeypatch):
    """More than 64 groups (several words), hosts with several areas, nulls."""
    rng = random.Random(3)
    rows = [r(rng.randrange(12), f"2020-0{rng.randrange(1, 4)}", nb=f"n{rng.randrange(150)}",
              host=rng.choice([None, *(f"h{k}" for k in range(60))]), host_nb=rng.choice("AB"),
              active=rng.choice("ttf")) for _ in range(700)]
    rows += [r(3, "2020-02", nb=None, host="h1"), r(3, "2020-02", nb="n1", host=None)]
    ld, hd = dims(spark, rows)
    hosts = fanout.host_collapse(hd)
    names = defaultdict(set)
    for row, host, month in brute.pairs(ld, hd):
        if row["has_availability"] == "t" and host["host_name"] is not None:
            names[row["listing_neighbourhood"], month].add(host["host_name"])
    made, kept = {}, fanout.stored
    monkeypatch.setattr(fanout, "stored", lambda df, tag: made.setdefault(tag, df) and kept(df, tag))
    got = fanout.month_distinct_hosts(ld, hosts, [["listing_neighbourhood"]], drop_null_keys=False)
    assert {(x["listing_neighbourhood"], x["s_date"]): x["distinct_host_count"] for x in got.collect()} == {
        k: len(v) for k, v in names.items()}
    # the joined rows are combined by host: one row a host, month and 64 groups
    joined = [line for line in _plan(made["group-hosts"]).splitlines() if "bit_or(_bits" in line]
    assert joined and all("host_no#" in line and "listing_neighbourhood" not in line for line in joined)


def test_the_right_side_meets_a_key_once(spark, monkeypatch):
    """Lists of the left elements, cut for a hot key; no lists for small groups where
    there are none."""
    monkeypatch.setattr(med, "LIST", 8)
    rng = random.Random(5)
    left_rows = [(0 if k % 3 else rng.randrange(6), rng.choice("abc"), rng.randrange(-40, 900), rng.choice([1, 2, 50]))
                 for k in range(300)]
    right_rows = [(k, m, rng.choice([1, 3])) for k in range(5) for m in (1, 2, None)]
    left = spark.createDataFrame(left_rows, "k int, g string, v long, l_n long")
    right = spark.createDataFrame(right_rows, "k int, m int, r_n long")
    values = defaultdict(list)
    for k, g, v, n in left_rows:
        for j, m, w in right_rows:
            if k == j:
                values[g, m] += [v] * n * w
    made = med.paired_median(left, right, "k", ["g"], ["m"], "v", "l_n", "r_n", "med", 0)
    assert {(x["g"], x["m"]): x["med"] for x in made.collect()} == {k: float(median(v)) for k, v in values.items()}
    assert _plan(made).count("MapInArrow") == 1  # the selection's; no sort of small groups beside it

    arrays = spark.createDataFrame([(k, [1, 2], [1, 1]) for k in range(6)], "k int, _sides array<long>, _ns array<long>")
    hot = left.groupBy("k").agg(F.ceil(F.count(F.lit(1)) / 8).alias("_parts"))
    rows = left.select("k", F.lit(1).cast("long").alias("_group"), "v", F.col("l_n").alias("_n"))
    met = med._met(rows, "k", ["_group", "v"], arrays, hot, ["_group", "v"]).collect()
    assert sum(len(x["_n"]) for x in met) == 300 and max(len(x["_n"]) for x in met) < 40
    assert len(med._met(rows, "k", ["_group", "v"], arrays, None, []).collect()) == 6


def test_stored_marts_share_the_host_side(spark, monkeypatch):
    rows = [r(k % 7, f"2020-0{1 + k % 3}", nb="AB"[k % 2], host=f"h{k % 5}", superhost="tf"[k % 2],
              active="ttf"[k % 3], price=50 + k, ptype="XY"[k % 2], acc=k % 2) for k in range(90)]
    snapshot = snapshot_df(spark, rows)
    monkeypatch.setattr(registry.Ctx, "snapshot", lambda self: snapshot)
    tags, kept = [], fanout.stored
    monkeypatch.setattr(fanout, "stored", lambda df, tag: tags.append(tag) or kept(df, tag))
    got = registry.queries()["mart_tables_roundtrip"](spark, "")
    assert tags.count("host-months") == 1
    ld, hd = dims(spark, rows)
    for name, keys in (("dm_listing_neighbourhood", marts.NEIGHBOURHOOD_KEYS), ("dm_property_type", marts.PROPERTY_KEYS)):
        want = registry.presentable(marts.listing_mart(ld, hd, keys))
        assert sorted(map(str, got.where(F.col("mart") == name).drop("mart").collect())) == sorted(map(str, want.collect()))
        assert len(rows_of(want)) > 2
