"""The three data marts.

Marts 1 and 2 share one builder over different listing keys; mart 3 maps each
host neighbourhood to the listing LGA where its listings are most frequent.
None of them builds the listing x host join row by row (see
operators.fanout); the literal statement over the joined rows lives in
tests/brute.py as the brute-force reference on small fixtures.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions import hundred, ratio6, stay_days, to_number
from staylens.operators.argmax import argmax_with_ties
from staylens.operators.fanout import (
    KEY_SET, MONTH, KeySets, host_bit, host_collapse, host_word, month_distinct_hosts,
    month_median_price, month_stats, one_set, pair_counts)
from staylens.operators.series import month_change_series
from staylens.session import stored

NEIGHBOURHOOD_KEYS = ("listing_neighbourhood",)
PROPERTY_KEYS = ("property_type", "room_type", "accommodates")

MART_COLUMNS = [
    "active_listing_rate", "min_price", "max_price", "avg_price", "median_price",
    "distinct_host_count", "avg_review_scores_rating", "active_percentage_change",
    "inactive_percentage_change", "superhost_rate", "total_staying",
    "average_estimated_revenue",
]


def _not_null(cols: Sequence[str]):
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def _finish(groups: DataFrame, keys: Sequence[str], include_keys: bool,
            ordered: bool = False) -> DataFrame:
    out = groups.select(
        *keys, MONTH,
        (ratio6("active_listing_count", "all_listing_count") * hundred()).alias("active_listing_rate"),
        "min_price", "max_price", "avg_price", "median_price", "distinct_host_count",
        "avg_review_scores_rating", "active_percentage_change", "inactive_percentage_change",
        (ratio6("count_host_is_superhost", "all_count_host_is_superhost") * hundred())
         .alias("superhost_rate"),
        "total_staying",
        (to_number("total_staying") * to_number("price")).alias("average_estimated_revenue"))
    if ordered:   # ascending, nulls last, as the source warehouse sorts
        out = out.orderBy(*[F.col(k).asc_nulls_last() for k in [*keys, MONTH]])
    return out if include_keys else out.select(*MART_COLUMNS)


def listing_marts(listing_d: DataFrame, hosts: DataFrame, key_sets: KeySets,
                  include_keys: bool = False, ordered: bool = False) -> list[DataFrame]:
    """One mart per set of keys over listing x host rows grouped by (keys, month):
    active rate, price statistics, distinct hosts, rating, global month-over-month
    change of active and inactive counts, superhost rate, nights and revenue.
    A group is kept only if it has an active listing, a superhost, non-null
    keys and a month present in the global change series.

    All marts share the passes: statistics, median and hosts are each worked out by
    one listing x host join for all key sets. ``hosts`` is the stored host side
    (``fanout.host_collapse``)."""
    # one row per group, stored: it feeds the groups and the month series without
    # a second listing x host join
    stats = stored(month_stats(listing_d, hosts, key_sets), "month-stats")
    distinct = month_distinct_hosts(listing_d, hosts, key_sets)
    median = month_median_price(listing_d, hosts, key_sets)
    if len(key_sets) > 1:
        distinct, median = stored(distinct, "month-hosts"), stored(median, "month-medians")
    # the joined rows of a month are the same in every key set
    series = month_change_series(stats.where(F.col(KEY_SET) == 0).groupBy(MONTH).agg(
        F.sum("active_listing_count").alias("active_listing_count"),
        F.sum("inactive_listing_count").alias("inactive_listing_count")))
    out = []
    for number, keys in enumerate(key_sets):
        group = [*keys, MONTH]
        kept = one_set(stats, number, key_sets).filter(
            _not_null(group) & (F.col("active_listing_count") > 0) & (F.col("count_host_is_superhost") > 0))
        groups = (kept.join(one_set(distinct, number, key_sets), group, "left")
                      .join(one_set(median, number, key_sets), group, "left")
                      .withColumn("distinct_host_count",
                                  F.coalesce("distinct_host_count", F.lit(0).cast("bigint")))
                      .join(series.select(MONTH, "active_percentage_change",
                                          "inactive_percentage_change"), MONTH))
        out.append(_finish(groups, keys, include_keys, ordered))
    return out


def listing_mart(listing_d: DataFrame, host_d: DataFrame, keys: Sequence[str],
                 include_keys: bool = False, ordered: bool = False) -> DataFrame:
    """The mart of one set of keys (see ``listing_marts``).

    ``ordered=True`` sorts by (keys, month) even when the keys are not
    output; a stored table does not keep an order, so the export sorts."""
    return listing_marts(listing_d, host_collapse(host_d), [list(keys)], include_keys, ordered)[0]


def _join_null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
    """Join on equal-or-both-null columns (GROUP BY treats nulls as one group)."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in cols else F.col(c) for c in right.columns])
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(r[f"_r_{c}"])
    return left.join(r, cond, how).drop(*[f"_r_{c}" for c in cols])


def active_listing_stats(listing_d: DataFrame, host_d: DataFrame,
                         keys: Sequence[str]) -> DataFrame:
    """The marts' active-listing aggregates per (keys, month) over the joined
    rows, every group kept (null keys included): count, min/max/avg/median
    price, distinct hosts, average rating, nights and price sum."""
    keys = list(keys)
    g = keys + [MONTH]
    by = host_collapse(host_d)
    stats = stored(month_stats(listing_d, by, [keys]).drop(KEY_SET).filter(F.col("active_listing_count") > 0),
                   "month-stats")
    hosts = month_distinct_hosts(listing_d, by, [keys], drop_null_keys=False).drop(KEY_SET)
    median = month_median_price(listing_d, by, [keys], drop_null_keys=False).drop(KEY_SET)
    out = _join_null_safe(_join_null_safe(stats, hosts, g, "left"), median, g, "left")
    return out.select(*g, "active_listing_count", "min_price", "max_price", "avg_price",
                      "median_price",
                      F.coalesce("distinct_host_count", F.lit(0).cast("bigint"))
                       .alias("distinct_host_count"),
                      "avg_review_scores_rating", "total_staying", "price")


def listing_neighbourhood_mart(listing_d, host_d, include_keys=False, ordered=False):
    return listing_mart(listing_d, host_d, NEIGHBOURHOOD_KEYS, include_keys, ordered)


def property_type_mart(listing_d, host_d, include_keys=False, ordered=False):
    return listing_mart(listing_d, host_d, PROPERTY_KEYS, include_keys, ordered)


def host_lga_mapping(listing_d: DataFrame, hosts: DataFrame) -> DataFrame:
    """Each host neighbourhood -> the listing LGA(s) where its joined rows are
    most frequent over all months (ties kept)."""
    best = argmax_with_ties(pair_counts(listing_d, hosts), "host_neighbourhood",
                            "listing_neighbourhood", "counting")
    return best.select("host_neighbourhood",
                       F.col("listing_neighbourhood").alias("host_neighbourhood_lga"),
                       "counting")


HOST_MART_COLUMNS = ["host_neighbourhood_lga", MONTH, "distinct_host_count",
                     "average_estimated_revenue", "average_revenue_p_host"]


def host_neighbourhood_mart(listing_d: DataFrame, host_d: DataFrame,
                            ordered: bool = False, hosts: DataFrame | None = None) -> DataFrame:
    """Per (mapped LGA, month) over joined rows whose listing lies in the LGA
    its host neighbourhood maps to: distinct hosts, revenue (nights x price)
    and revenue per host (six digits, null when no host has a name). ``hosts`` is
    the stored host side, where it is there already."""
    if hosts is None:
        hosts = host_collapse(host_d)
    # a table of its own: Spark sees its true size (a few rows per host area), so
    # the ordinary threshold broadcasts it and host rows are not shuffled by area
    mapping = stored(host_lga_mapping(listing_d, hosts).filter(
        F.col("host_neighbourhood_lga").isNotNull()).drop("counting"), "host-areas")
    l2 = (listing_d.groupBy("listing_id", "listing_neighbourhood")
          .agg(F.sum(stay_days("availability_30")).alias("l_stay"),
               F.sum("price").alias("l_price")))
    # the mapping (at most a few LGAs per host neighbourhood) is applied to
    # the host side first, so the join on (listing_id, LGA) only yields
    # pairs that survive the filter instead of every listing x host pair
    h_mapped = hosts.select("listing_id", "host_neighbourhood", MONTH, "host_no", "h_rows").join(
        mapping, "host_neighbourhood")
    pairs = l2.join(h_mapped,
                    (l2.listing_id == h_mapped.listing_id)
                    & (l2.listing_neighbourhood == h_mapped.host_neighbourhood_lga))
    # hosts as bits of 64 a word: a listing has one LGA here, or few
    agg = (pairs.groupBy("host_neighbourhood_lga", MONTH, host_word().alias("word"))
                .agg(F.bit_or(host_bit()).alias("bits"),
                     F.sum(F.col("l_stay") * F.col("h_rows")).alias("total_staying"),
                     F.sum(F.col("l_price") * F.col("h_rows")).alias("price"))
                .groupBy("host_neighbourhood_lga", MONTH)
                .agg(F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).cast("bigint").alias("distinct_host_count"),
                     F.sum("total_staying").alias("total_staying"), F.sum("price").alias("price")))
    revenue = to_number("total_staying") * to_number("price")
    out = (agg.select("host_neighbourhood_lga", MONTH, "distinct_host_count",
                      revenue.alias("average_estimated_revenue"))
              .withColumn("average_revenue_p_host",
                          ratio6("average_estimated_revenue", "distinct_host_count")))
    order = [F.col("host_neighbourhood_lga").asc_nulls_last(), F.col(MONTH).asc_nulls_last()]
    return out.orderBy(*order) if ordered else out
