"""Aggregates over the listing x host join without materialising it.

The marts join the listing dimension to the host dimension on ``listing_id``
alone. Both hold one row per listing per month, so a listing seen in M months
yields M*M joined rows; the month comes from the host row and the figures
from a listing row of *any* month. That result is reproduced exactly, but the
join is never built row by row: each side is first collapsed per listing id
(map-side partial aggregation, so a hot id is combined before the shuffle),
then the collapsed sides are joined and every additive aggregate becomes a
sum of products ``listing_part * host_part``:

  count over joined rows          = sum(l_rows * h_rows)
  sum(x) over joined rows         = sum(sum_x_per_listing * h_rows)
  avg(x)                          = the two sums above divided
  min / max(x)                    = min / max over listing groups that join
  median(x)                       = weighted median over (keys, month, x)
                                    with weight sum(l_rows * h_rows)
  count(distinct host attribute)  = bits set in words of 64 numbered groups, one
                                    row per (host, month, word)

The joined size drops from sum(n_l * n_h) per id to
sum(distinct listing groups * distinct host groups) per id; only the median
needs listing groups down to the individual price.

Several sets of group keys are served by one pass: the listing side is collapsed
with GROUPING SETS and every row carries the number of its set in ``key_set``
(keys outside a set are null). The host side is collapsed once, with hosts
numbered, in a stored table (``host_collapse``) that all marts read.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions import is_false_flag, is_true_flag, month_of, stay_days
from staylens.operators.median import paired_median, renamed, same
from staylens.operators.surrogate import with_surrogate_id
from staylens.session import stored

MONTH = "s_date"
KEY_SET = "key_set"
KeySets = Sequence[Sequence[str]]


def host_months(host_d: DataFrame) -> DataFrame:
    """Host side with the month bucket: (listing_id, s_date, host attrs)."""
    return host_d.select(
        "listing_id", month_of("scraped_date").alias(MONTH), "host_name",
        "host_is_superhost", "host_neighbourhood")


def host_collapse(host_d: DataFrame) -> DataFrame:
    """Stored host side, one row per (listing_id, s_date, host_neighbourhood,
    host_name): row counts, superhost counts and ``host_no``, a number 1..N of the
    host name (null for no name)."""
    known = host_months(host_d).where(F.col("listing_id").isNotNull())
    rows = known.groupBy("listing_id", MONTH, "host_neighbourhood", "host_name").agg(
        F.count(F.lit(1)).alias("h_rows"),
        F.count("host_is_superhost").alias("h_sup_known"),
        F.count_if(is_true_flag("host_is_superhost")).alias("h_sup_t"))
    names = with_surrogate_id(
        known.where(F.col("host_name").isNotNull()).select("host_name").distinct(), "host_no")
    return stored(rows.join(names, "host_name", "left"), "host-months")


def _month_counts(hosts: DataFrame) -> DataFrame:
    return hosts.groupBy("listing_id", MONTH).agg(
        F.sum("h_rows").alias("h_rows"), F.sum("h_sup_known").alias("h_sup_known"),
        F.sum("h_sup_t").alias("h_sup_t"))


def set_columns(key_sets: KeySets) -> list[str]:
    """All keys of all sets, each once."""
    return list(dict.fromkeys(k for keys in key_sets for k in keys))


def _per_listing(rows: DataFrame, key_sets: KeySets, *aggs, also: Sequence[str] = ()) -> DataFrame:
    """``rows`` collapsed per listing id, the keys of each set and ``also``, with
    ``key_set``: one pass over the rows for all sets."""
    columns = ["listing_id", *also, *set_columns(key_sets)]
    if len(key_sets) == 1:
        out = rows.groupBy(*columns).agg(*aggs)
        return out.select(F.lit(0).alias(KEY_SET), *out.columns)
    sets = [["listing_id", *also, *keys] for keys in key_sets]
    # grouping_id: one bit per column, set where the column is left out
    ids = [int("".join("0" if c in keys else "1" for c in columns), 2) for keys in sets]
    number = F.coalesce(*(F.when(F.col("_gid") == g, k) for k, g in enumerate(ids)))
    out = rows.groupingSets([[F.col(c) for c in keys] for keys in sets], *columns).agg(
        F.grouping_id(*columns).alias("_gid"), *aggs)
    return out.select(number.alias(KEY_SET), *(c for c in out.columns if c != "_gid"))


def _known_keys(key_sets: KeySets):
    """No key of a row's own set is null."""
    known = F.lit(False)
    for k, keys in enumerate(key_sets):
        known = known | ((F.col(KEY_SET) == k) & _all_not_null(keys))
    return known


def month_stats(listing_d: DataFrame, hosts: DataFrame, key_sets: KeySets) -> DataFrame:
    """Per (key_set, keys, s_date) over listing x host joined rows, every group
    kept (null keys included): active/all/inactive counts, superhost counts, and
    the active listings' min/max/avg price, price sum, nights and rating.

    Both sides collapse to one row per (listing_id, keys) and per
    (listing_id, s_date); nothing here needs the individual prices.
    """
    columns = set_columns(key_sets)
    active = is_true_flag("has_availability")
    act_price = F.when(active, F.col("price"))
    l1 = _per_listing(
        listing_d.where(F.col("listing_id").isNotNull()).select(
            "listing_id", *columns, "price", "has_availability", "availability_30", "review_scores_rating"),
        key_sets,
        F.count(F.lit(1)).alias("l_rows"),
        F.count_if(active).alias("l_act"),
        F.count_if(is_false_flag("has_availability")).alias("l_inact"),
        F.min(act_price).alias("l_min_price"),
        F.max(act_price).alias("l_max_price"),
        F.sum(act_price).alias("l_price_sum"),
        F.count(act_price).alias("l_price_n"),
        F.sum(F.when(active, stay_days("availability_30"))).alias("l_act_stay"),
        F.sum(F.when(active, F.col("review_scores_rating"))).alias("l_act_rating_sum"),
        F.count(F.when(active, F.col("review_scores_rating"))).alias("l_act_rating_n"))
    j = l1.join(_month_counts(hosts), "listing_id")
    h = F.col("h_rows")
    return j.groupBy(KEY_SET, *columns, MONTH).agg(
        F.sum(F.col("l_act") * h).alias("active_listing_count"),
        F.sum(F.col("l_rows") * h).alias("all_listing_count"),
        F.sum(F.col("l_inact") * h).alias("inactive_listing_count"),
        F.sum(F.col("l_rows") * F.col("h_sup_known")).alias("all_count_host_is_superhost"),
        F.sum(F.col("l_rows") * F.col("h_sup_t")).alias("count_host_is_superhost"),
        F.min("l_min_price").alias("min_price"),
        F.max("l_max_price").alias("max_price"),
        F.sum(F.col("l_price_sum") * h).alias("price"),
        F.sum(F.col("l_price_n") * h).alias("_price_n"),
        F.sum(F.col("l_act_stay") * h).alias("total_staying"),
        F.sum(F.col("l_act_rating_sum") * h).alias("_rating_sum"),
        F.sum(F.col("l_act_rating_n") * h).alias("_rating_n"),
    ).select(
        KEY_SET, *columns, MONTH, "active_listing_count", "all_listing_count",
        "inactive_listing_count", "all_count_host_is_superhost",
        "count_host_is_superhost", "min_price", "max_price",
        _safe_avg("price", "_price_n").alias("avg_price"),
        _safe_avg("_rating_sum", "_rating_n").alias("avg_review_scores_rating"),
        "total_staying", "price")


def month_median_price(listing_d: DataFrame, hosts: DataFrame, key_sets: KeySets,
                       only_active: bool = True, drop_null_keys: bool = True) -> DataFrame:
    """Exact median price per (key_set, keys, s_date) over joined (active) rows.

    Each listing price is repeated once per joined host row, so the median is
    a weighted one: the listing side collapses to (listing_id, keys, price)
    with a row count, the host side to (listing_id, s_date) with a row count.
    """
    lsrc = listing_d.filter(is_true_flag("has_availability")) if only_active else listing_d
    lsrc = lsrc.filter(F.col("price").isNotNull() & F.col("listing_id").isNotNull())
    lp = _per_listing(lsrc.select("listing_id", *set_columns(key_sets), "price"), key_sets,
                      F.count(F.lit(1)).alias("l_n"), also=["price"])
    hm = _month_counts(hosts).select("listing_id", MONTH, F.col("h_rows").alias("h_n"))
    if drop_null_keys:
        lp, hm = lp.filter(_known_keys(key_sets)), hm.filter(F.col(MONTH).isNotNull())
    found = paired_median(lp, hm, "listing_id", [KEY_SET, *set_columns(key_sets)], [MONTH],
                          "price", "l_n", "h_n", "median_price")
    if len(key_sets) > 1:
        return found  # the marts of several sets store it
    # stored, as the hosts are: the shuffles of its pairs go before the mart goes on
    return stored(found, "group-medians").groupBy(KEY_SET, *set_columns(key_sets), MONTH).agg(
        F.max("median_price").alias("median_price"))


def month_distinct_hosts(listing_d: DataFrame, hosts: DataFrame, key_sets: KeySets,
                         only_active: bool = True, drop_null_keys: bool = True) -> DataFrame:
    """count(distinct host_name) per (key_set, keys, s_date) over joined rows.

    Groups of keys are numbered, 64 of them a word. A listing sends one row per word
    with the bits of its groups to its named host rows, (month, host, word) combines
    them by OR (a hash aggregate over longs, so copies are combined before the
    shuffle), and the bits set are counted last. Rows are never more than host rows
    times words of a listing's groups, however many hosts there are: hosts grow with
    the data, the groups of a listing do not. Groups without a named host have no
    row."""
    columns = set_columns(key_sets)
    lsrc = listing_d.filter(is_true_flag("has_availability")) if only_active else listing_d
    ld = _per_listing(lsrc.where(F.col("listing_id").isNotNull()).select("listing_id", *columns), key_sets,
                      F.lit(1).alias("_one")).drop("_one")
    named = hosts.where(F.col("host_no").isNotNull()).select("listing_id", MONTH, "host_no")
    if drop_null_keys:
        ld, named = ld.filter(_known_keys(key_sets)), named.filter(F.col(MONTH).isNotNull())
    ld = stored(ld, "listing-groups")
    group = [KEY_SET, *columns]
    numbers = stored(with_surrogate_id(ld.select(*group).distinct(), "_group"), "group-numbers")
    other = renamed(numbers, group)
    words = (ld.join(other, same(ld, other, group))
             .groupBy("listing_id", F.shiftright("_group", 6).alias("_word")).agg(F.bit_or(_bit("_group")).alias("_bits")))
    seen = words.join(named, "listing_id").groupBy(MONTH, "host_no", "_word").agg(F.bit_or("_bits").alias("_bits"))
    place = F.explode(F.sequence(F.lit(0), F.lit(63))).alias("_place")
    counts = (seen.select(MONTH, "_word", "_bits", place)
              .where(F.expr("getbit(_bits, _place) = 1"))
              .groupBy(MONTH, (F.shiftleft("_word", 6) + F.col("_place")).alias("_group"))
              .agg(F.count(F.lit(1)).alias("distinct_host_count")))
    found = counts.join(numbers, "_group").select(*group, MONTH, "distinct_host_count")
    if len(key_sets) == 1:
        # stored: one row per group, so that the mart's plan holds no listing-level join
        # of it (the marts of several sets store the result)
        found = stored(found, "group-hosts")
    return found.groupBy(*group, MONTH).agg(F.sum("distinct_host_count").alias("distinct_host_count"))


def host_word():
    return F.shiftright("host_no", 6)


def _bit(number: str):
    return F.expr(f"shiftleft(1L, cast({number} & 63 as int))")


def host_bit():
    return _bit("host_no")


def one_set(df: DataFrame, number: int, key_sets: KeySets) -> DataFrame:
    """Rows of one key set, without the columns of the others."""
    out = df.where(F.col(KEY_SET) == number) if len(key_sets) > 1 else df
    return out.drop(KEY_SET, *(c for c in set_columns(key_sets) if c not in key_sets[number]))


def keyed_month_stats(listing_d: DataFrame, host_d: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``month_stats`` of one set of keys over the host dimension."""
    return month_stats(listing_d, host_collapse(host_d), [keys]).drop(KEY_SET)


def keyed_month_distinct_hosts(listing_d: DataFrame, host_d: DataFrame, keys: Sequence[str],
                               only_active: bool = True, drop_null_keys: bool = True) -> DataFrame:
    """``month_distinct_hosts`` of one set of keys over the host dimension."""
    return month_distinct_hosts(listing_d, host_collapse(host_d), [keys], only_active, drop_null_keys).drop(KEY_SET)


def monthly_activity(listing_d: DataFrame, host_d: DataFrame) -> DataFrame:
    """Per s_date over all joined rows: active and inactive listing counts.
    The listing side collapses to one row per id, so this costs one small
    join next to the keyed statistics."""
    la = (listing_d.groupBy("listing_id")
          .agg(F.count_if(is_true_flag("has_availability")).alias("l_act"),
               F.count_if(is_false_flag("has_availability")).alias("l_inact")))
    hm = (host_months(host_d).groupBy("listing_id", MONTH)
          .agg(F.count(F.lit(1)).alias("h_rows")))
    return (la.join(hm, "listing_id").groupBy(MONTH)
              .agg(F.sum(F.col("l_act") * F.col("h_rows")).alias("active_listing_count"),
                   F.sum(F.col("l_inact") * F.col("h_rows")).alias("inactive_listing_count")))


def pair_counts(listing_d: DataFrame, hosts: DataFrame) -> DataFrame:
    """count(*) of joined rows per (host_neighbourhood, listing_neighbourhood)."""
    l2 = listing_d.groupBy("listing_id", "listing_neighbourhood").agg(
        F.count(F.lit(1)).alias("l_rows"))
    h2 = hosts.groupBy("listing_id", "host_neighbourhood").agg(F.sum("h_rows").alias("h_rows"))
    return (l2.join(h2, "listing_id")
              .groupBy("host_neighbourhood", "listing_neighbourhood")
              .agg(F.sum(F.col("l_rows") * F.col("h_rows")).alias("counting")))


def _safe_avg(num: str, den: str):
    return F.col(num).cast("double") / F.nullif(F.col(den), F.lit(0)).cast("double")


def _all_not_null(cols: Sequence[str]):
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond
