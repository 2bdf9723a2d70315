"""Registered queries: one per operator / query of the inventory.

Each callable takes (spark, sf_dir) and returns a DataFrame built from the
driver's tables through the adapter (sources.testdata). Decimal outputs are
presented as DOUBLE (exact decimal computed first, converted last) so results
compare with an independent SQL engine; the library functions themselves
return NUMBER(38,6) / NUMBER(38,0).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.functions import (
    hundred, is_true_flag, lga_code_of, month_of, ratio6, stay_days, to_number)
from staylens.operators import fanout
from staylens.operators.series import month_change_series
from staylens.plans import adhoc, marts, star
from staylens.sources.testdata import Inputs


def presentable(df: DataFrame) -> DataFrame:
    """Decimal columns -> DOUBLE (the value is exact before the conversion)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


class Ctx:
    """Inputs and dimensions for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.inputs = Inputs(spark, sf_dir)

    def snapshot(self) -> DataFrame:
        return self.inputs.snapshot()

    def listing_d(self, with_id: bool = False) -> DataFrame:
        return star.listing_dim(self.snapshot(), with_id)

    def host_d(self, with_id: bool = False) -> DataFrame:
        return star.host_dim(self.snapshot(), with_id)

    def lga_d(self, with_id: bool = False) -> DataFrame:
        return star.lga_dim(self.inputs.lga_code(), with_id)

    def suburb_d(self, with_id: bool = False) -> DataFrame:
        return star.suburb_dim(self.inputs.lga_suburb(), with_id)

    def census_d(self, with_id: bool = False) -> DataFrame:
        return star.census_dim(self.inputs.census_01(), self.inputs.census_02(), with_id)


Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return presentable(fn(Ctx(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return fn
    return deco


def queries() -> dict[str, Query]:
    # the write/read-back queries live in plans.layers and register on import
    from staylens.plans import layers  # noqa: F401
    return dict(_REGISTRY)


# --------------------------------------------------------------------------
# Projections, predicates, expressions, aggregates (single table)
# --------------------------------------------------------------------------
@register("filter_active")
def _filter_active(c: Ctx) -> DataFrame:
    """Listing dimension rows with has_availability = 't'."""
    return c.listing_d().filter(is_true_flag("has_availability"))


@register("agg_sum_expr")
def _agg_sum_expr(c: Ctx) -> DataFrame:
    """sum(30 - availability_30) per listing neighbourhood."""
    return (c.listing_d().groupBy("listing_neighbourhood")
             .agg(F.sum(stay_days("availability_30")).alias("total_staying")))


@register("agg_product_of_sums")
def _agg_product_of_sums(c: Ctx) -> DataFrame:
    """Revenue = sum(nights) * sum(price) per neighbourhood (a product of two
    sums, in NUMBER(38,0))."""
    g = (c.listing_d().filter(is_true_flag("has_availability"))
          .groupBy("listing_neighbourhood")
          .agg(F.sum(stay_days("availability_30")).alias("total_staying"),
               F.sum("price").alias("price")))
    return g.withColumn("revenue", to_number("total_staying") * to_number("price"))


@register("adhoc_best_listing_type")
def _adhoc_best_listing_type(c: Ctx) -> DataFrame:
    """Ad-hoc 3.b: best listing types by nights and revenue."""
    return adhoc.best_listing_type(c.listing_d())


@register("fn_left_month")
def _fn_left_month(c: Ctx) -> DataFrame:
    """LEFT(scraped_date, 7) month buckets of the host dimension with row counts."""
    return (c.host_d().groupBy(month_of("scraped_date").alias("s_date"))
             .agg(F.count(F.lit(1)).alias("n_rows")))


@register("expr_ratio_scale6")
def _expr_ratio_scale6(c: Ctx) -> DataFrame:
    """Active share per neighbourhood as a six-digit ratio and as a percentage
    (rounded before the x100)."""
    g = (c.listing_d().groupBy("listing_neighbourhood")
          .agg(F.count_if(is_true_flag("has_availability")).alias("active_n"),
               F.count(F.lit(1)).alias("all_n")))
    return g.select("listing_neighbourhood", "active_n", "all_n",
                    ratio6("active_n", "all_n").alias("active_ratio"),
                    (ratio6("active_n", "all_n") * hundred()).alias("active_listing_rate"))


@register("expr_lateral_alias")
def _expr_lateral_alias(c: Ctx) -> DataFrame:
    """A SELECT that reuses its own aliases (nights, price -> revenue)."""
    return c.spark.sql(
        """SELECT listing_neighbourhood,
                  sum(30 - availability_30) AS total_staying,
                  sum(price) AS total_price,
                  CAST(total_staying AS DECIMAL(38,0)) * CAST(total_price AS DECIMAL(38,0)) AS revenue
           FROM {listing}
           WHERE has_availability = 't'
           GROUP BY listing_neighbourhood""", listing=c.listing_d())


@register("agg_count_nonnull")
def _agg_count_nonnull(c: Ctx) -> DataFrame:
    """count(col) skips nulls; count(*) does not."""
    return (c.listing_d().groupBy("listing_neighbourhood")
             .agg(F.count("review_scores_rating").alias("n_rated"),
                  F.count(F.lit(1)).alias("n_rows")))


@register("agg_count_distinct")
def _agg_count_distinct(c: Ctx) -> DataFrame:
    """Exact count(distinct host_name) per listing neighbourhood."""
    return (c.snapshot().groupBy("listing_neighbourhood")
             .agg(F.count_distinct("host_name").alias("distinct_host_count")))


@register("agg_min_max_avg")
def _agg_min_max_avg(c: Ctx) -> DataFrame:
    """min/max/avg price of active listings per neighbourhood."""
    return (c.listing_d().filter(is_true_flag("has_availability"))
             .groupBy("listing_neighbourhood")
             .agg(F.min("price").alias("min_price"), F.max("price").alias("max_price"),
                  F.avg("price").alias("avg_price")))


@register("agg_median")
def _agg_median(c: Ctx) -> DataFrame:
    """Exact median price of active listings per (neighbourhood, room type)."""
    return (c.listing_d().filter(is_true_flag("has_availability"))
             .groupBy("listing_neighbourhood", "room_type")
             .agg(F.median("price").alias("median_price")))


@register("agg_conditional_single_pass")
def _agg_conditional_single_pass(c: Ctx) -> DataFrame:
    """Active, all, superhost-known and superhost counts per (neighbourhood,
    month) over the listing x host rows, in one aggregation pass."""
    s = fanout.keyed_month_stats(c.listing_d(), c.host_d(), marts.NEIGHBOURHOOD_KEYS)
    return s.select("listing_neighbourhood", "s_date", "active_listing_count",
                    "all_listing_count", "all_count_host_is_superhost",
                    "count_host_is_superhost")


# --------------------------------------------------------------------------
# Fan-out join, window, argmax, sort
# --------------------------------------------------------------------------
@register("join_listing_host")
def _join_listing_host(c: Ctx) -> DataFrame:
    """Listing x host on listing_id (many-to-many): joined rows and summed
    price per host month."""
    ld = c.listing_d().groupBy("listing_id").agg(
        F.count(F.lit(1)).alias("l_rows"), F.sum("price").alias("l_price"))
    hm = (fanout.host_months(c.host_d()).groupBy("listing_id", "s_date")
          .agg(F.count(F.lit(1)).alias("h_rows")))
    return (ld.join(hm, "listing_id").groupBy("s_date")
              .agg(F.sum(F.col("l_rows") * F.col("h_rows")).alias("n_rows"),
                   F.sum(F.col("l_price") * F.col("h_rows")).alias("sum_price")))


@register("win_lag_pct_change")
def _win_lag_pct_change(c: Ctx) -> DataFrame:
    """Global month series of active / inactive listing counts with LAG and
    percentage change."""
    return month_change_series(fanout.monthly_activity(c.listing_d(), c.host_d()))


@register("argmax_with_ties")
def _argmax_with_ties(c: Ctx) -> DataFrame:
    """Host neighbourhood -> most frequent listing LGA, ties kept."""
    return marts.host_lga_mapping(c.listing_d(), fanout.host_collapse(c.host_d()))


@register("sort_by_hidden_key")
def _sort_by_hidden_key(c: Ctx) -> DataFrame:
    """Mart 1 in its published shape: ordered by keys that are not output."""
    return marts.listing_neighbourhood_mart(c.listing_d(), c.host_d(), include_keys=False,
                                            ordered=True)


# --------------------------------------------------------------------------
# Marts
# --------------------------------------------------------------------------
@register("mart_active_listings")
def _mart_active_listings(c: Ctx) -> DataFrame:
    """The marts' active-listing aggregates per (listing neighbourhood, month)
    over listing x host rows: count, price min/max/avg/median, distinct hosts,
    rating, nights, price sum."""
    return marts.active_listing_stats(c.listing_d(), c.host_d(), marts.NEIGHBOURHOOD_KEYS)


@register("mart_listing_neighbourhood")
def _mart_listing_neighbourhood(c: Ctx) -> DataFrame:
    """Mart 1 per (listing neighbourhood, month), keys included."""
    return marts.listing_neighbourhood_mart(c.listing_d(), c.host_d(), include_keys=True)


@register("mart_property_type")
def _mart_property_type(c: Ctx) -> DataFrame:
    """Mart 2 per (property type, room type, accommodates, month), keys included."""
    return marts.property_type_mart(c.listing_d(), c.host_d(), include_keys=True)


@register("mart_host_neighbourhood")
def _mart_host_neighbourhood(c: Ctx) -> DataFrame:
    """Mart 3 per (host neighbourhood's LGA, month)."""
    return marts.host_neighbourhood_mart(c.listing_d(), c.host_d())


# --------------------------------------------------------------------------
# Star schema
# --------------------------------------------------------------------------
@register("dim_listing")
def _dim_listing(c: Ctx) -> DataFrame:
    """Listing dimension without its opaque surrogate id."""
    return c.listing_d()


@register("dim_host")
def _dim_host(c: Ctx) -> DataFrame:
    """Host dimension without its opaque surrogate id."""
    return c.host_d()


@register("dim_suburb")
def _dim_suburb(c: Ctx) -> DataFrame:
    return c.suburb_d()


@register("dim_lga")
def _dim_lga(c: Ctx) -> DataFrame:
    return c.lga_d()


@register("dim_census")
def _dim_census(c: Ctx) -> DataFrame:
    """Census dimension: both census files joined, numeric code."""
    return c.census_d()


@register("dim_listing_surrogate_key")
def _dim_listing_surrogate_key(c: Ctx) -> DataFrame:
    """Surrogate ids of the listing dimension are exactly 1..N."""
    d = c.listing_d(with_id=True)
    return d.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_distinct("id").alias("n_distinct_ids"),
                 F.min("id").alias("min_id"), F.max("id").alias("max_id"),
                 F.sum("id").alias("sum_id"))


@register("fn_right_cast_code")
def _fn_right_cast_code(c: Ctx) -> DataFrame:
    """RIGHT(code, 5) cast to a number."""
    return c.inputs.census_01().select(
        "lga_code_2016", lga_code_of("lga_code_2016").alias("lga_code"))


@register("join_listing_lga")
def _join_listing_lga(c: Ctx) -> DataFrame:
    """Listing -> LGA by exact name: listing rows and price per LGA."""
    j = star.listing_with_lga(c.listing_d(), c.lga_d())
    return (j.groupBy("lga_code", "lga_name")
             .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("price").alias("sum_price")))


@register("join_census_lga")
def _join_census_lga(c: Ctx) -> DataFrame:
    """LGA -> census on the numeric code."""
    j = star.lga_with_census(c.lga_d(), c.census_d())
    return j.select("lga_code", "lga_name", "tot_p_p", "age_0_4_yr_p",
                    "median_mortgage_repay_monthly")


@register("join_lower_suburb")
def _join_lower_suburb(c: Ctx) -> DataFrame:
    """LGA -> suburbs on lower-cased names."""
    return star.lga_with_suburbs(c.lga_d(), c.suburb_d()).select(
        "lga_code", "lga_name", "suburb_name")


@register("fact_rental_by_month")
def _fact_rental_by_month(c: Ctx) -> DataFrame:
    """Fact rows (5-way star join, surrogate ids) counted and priced per month."""
    fact = star.fact_rental(c.listing_d(with_id=True), c.host_d(with_id=True),
                            c.lga_d(with_id=True), c.census_d(with_id=True),
                            c.suburb_d(with_id=True))
    return (fact.groupBy(month_of("date").alias("s_date"))
                .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("price").alias("sum_price"),
                     F.count_distinct("sururb_id").alias("n_suburbs")))


# --------------------------------------------------------------------------
# Ad-hoc queries
# --------------------------------------------------------------------------
@register("adhoc_lga_revenue")
def _adhoc_lga_revenue(c: Ctx) -> DataFrame:
    """Ad-hoc 3.a."""
    return adhoc.lga_revenue(c.listing_d(), c.lga_d(), c.census_d(), c.suburb_d())


@register("adhoc_revenue_vs_mortgage")
def _adhoc_revenue_vs_mortgage(c: Ctx) -> DataFrame:
    """Ad-hoc 3.d."""
    return adhoc.revenue_vs_mortgage(c.listing_d(), c.lga_d(), c.census_d(), c.suburb_d())


@register("adhoc_host_same_vs_diff")
def _adhoc_host_same_vs_diff(c: Ctx) -> DataFrame:
    """Ad-hoc 3.c over all snapshot rows."""
    return adhoc.host_same_vs_different(c.snapshot())


# --------------------------------------------------------------------------
# Specified orders as data: the row number in the order
# --------------------------------------------------------------------------
def _numbered(df: DataFrame, *order) -> DataFrame:
    from staylens.plans.layers import with_row_number
    return with_row_number(df, list(order))


@register("order_listing_mart")
def _order_listing_mart(c: Ctx) -> DataFrame:
    """Mart 1 with its row number by (neighbourhood, month), nulls last."""
    mart = marts.listing_neighbourhood_mart(c.listing_d(), c.host_d(), include_keys=True)
    return _numbered(mart, *[F.col(k).asc_nulls_last() for k in (*marts.NEIGHBOURHOOD_KEYS, "s_date")])


@register("order_property_mart")
def _order_property_mart(c: Ctx) -> DataFrame:
    """Mart 2 with its row number by (property keys, month), nulls last."""
    mart = marts.property_type_mart(c.listing_d(), c.host_d(), include_keys=True)
    return _numbered(mart, *[F.col(k).asc_nulls_last() for k in (*marts.PROPERTY_KEYS, "s_date")])


@register("order_lga_revenue")
def _order_lga_revenue(c: Ctx) -> DataFrame:
    """Ad-hoc 3.a with its row number by falling revenue."""
    return _numbered(adhoc.lga_revenue(c.listing_d(), c.lga_d(), c.census_d(), c.suburb_d()),
                     F.col("revenue").desc_nulls_first(), F.col("listing_neighbourhood"))


@register("order_best_listing_type")
def _order_best_listing_type(c: Ctx) -> DataFrame:
    """Ad-hoc 3.b with its row number by falling nights, then revenue."""
    return _numbered(adhoc.best_listing_type(c.listing_d()), F.col("total_staying").desc_nulls_first(),
                     F.col("revenue").desc_nulls_first(), "listing_neighbourhood", "property_type",
                     "room_type", "accommodates")


@register("order_host_same_vs_diff")
def _order_host_same_vs_diff(c: Ctx) -> DataFrame:
    """Ad-hoc 3.c with its row number by falling count, then host name."""
    return _numbered(adhoc.host_same_vs_different(c.snapshot()),
                     (F.col("same_neighbourhood") + F.col("different_neighbourhood")).desc(), F.col("host_name"))


@register("order_revenue_vs_mortgage")
def _order_revenue_vs_mortgage(c: Ctx) -> DataFrame:
    """Ad-hoc 3.d with its row number by falling revenue, then mortgage."""
    return _numbered(adhoc.revenue_vs_mortgage(c.listing_d(), c.lga_d(), c.census_d(), c.suburb_d()),
                     F.col("estimated_revenue").desc_nulls_first(),
                     F.col("median_mortgage_annaully").desc_nulls_first(), F.col("listing_neighbourhood"))
