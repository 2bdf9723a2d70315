"""The four ad-hoc business queries.

The LGA reports join listings to the LGA, census and suburb dimensions.
Listings are first collapsed per neighbourhood (map-side partial
aggregation), and only those per-neighbourhood rows meet the dimensions; the
suburb fan-out (one joined row per suburb of the LGA) is applied to the
collapsed sums: a census count summed over the joined rows is the count
times the neighbourhood's listing rows, per suburb.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens import schemas
from staylens.functions import is_true_flag, month_of, stay_days, to_number
from staylens.plans.star import lga_with_census, lga_with_suburbs


def _avg(num: str, den: str):
    return F.sum(num).cast("double") / F.nullif(F.sum(den), F.lit(0)).cast("double")


def _lga_dims(lga_d: DataFrame, census_d: DataFrame, suburb_d: DataFrame,
              census_cols: list[str]) -> DataFrame:
    lc = lga_with_census(lga_d.select("lga_code", "lga_name"),
                         census_d.select("lga_code_2016", *census_cols))
    return lga_with_suburbs(lc, suburb_d.select("lga_name", "suburb_name"))


def lga_revenue(listing_d: DataFrame, lga_d: DataFrame, census_d: DataFrame,
                suburb_d: DataFrame) -> DataFrame:
    """Active listings per neighbourhood with census age bands: average
    rating and cleanliness, summed age columns, nights, price and revenue,
    highest revenue first."""
    per_nb = (listing_d.filter(is_true_flag("has_availability"))
              .groupBy("listing_neighbourhood")
              .agg(F.count(F.lit(1)).alias("n_rows"),
                   F.sum("review_scores_rating").alias("rating_sum"),
                   F.count("review_scores_rating").alias("rating_n"),
                   F.sum("review_scores_cleanliness").alias("clean_sum"),
                   F.count("review_scores_cleanliness").alias("clean_n"),
                   F.sum(stay_days("availability_30")).alias("stay"),
                   F.sum("price").alias("price_sum")))
    dims = _lga_dims(lga_d, census_d, suburb_d, schemas.ADHOC_AGE_COLUMNS)
    j = per_nb.join(dims, per_nb.listing_neighbourhood == dims.lga_name)
    ages = [F.sum(F.col(c) * F.col("n_rows")).alias(c) for c in schemas.ADHOC_AGE_COLUMNS]
    agg = j.groupBy("listing_neighbourhood").agg(
        _avg("rating_sum", "rating_n").alias("avg_review_scores_rating"),
        _avg("clean_sum", "clean_n").alias("review_scores_cleanliness"),
        *ages,
        F.sum("stay").alias("total_staying"),
        F.sum("price_sum").alias("price"))
    return (agg.withColumn("revenue", to_number("total_staying") * to_number("price"))
               .orderBy(F.col("revenue").desc_nulls_first()))


def best_listing_type(listing_d: DataFrame) -> DataFrame:
    """Active listings per (neighbourhood, property type, room type,
    accommodates): nights, price and revenue, most nights first. Null keys
    form their own groups."""
    keys = ["listing_neighbourhood", "property_type", "room_type", "accommodates"]
    agg = (listing_d.filter(is_true_flag("has_availability"))
           .groupBy(*keys)
           .agg(F.sum(stay_days("availability_30")).alias("total_staying"),
                F.sum("price").alias("price")))
    return (agg.withColumn("revenue", to_number("total_staying") * to_number("price"))
               .orderBy(F.col("total_staying").desc_nulls_first(),
                        F.col("revenue").desc_nulls_first()))


def host_same_vs_different(snapshot: DataFrame, month: str | None = None,
                           source_table: str | None = None) -> DataFrame:
    """Hosts with listings both inside and outside their own neighbourhood,
    from one snapshot: a month ('yyyy-MM'), or a source table (e.g.
    'listing_01_2021', the raw layer's partition column, so only that
    partition is read), or all rows when both are None.

    The modelled SQL orders by a column that does not exist; here the order is
    (same + different) desc, host name asc."""
    src = snapshot
    if source_table is not None:
        src = src.filter(F.col("source_table") == source_table)
    if month is not None:
        src = src.filter(month_of("scraped_date") == month)
    same = F.col("host_neighbourhood") == F.col("listing_neighbourhood")
    diff = F.col("host_neighbourhood") != F.col("listing_neighbourhood")
    g = (src.filter(F.col("host_name").isNotNull())
            .groupBy("host_name")
            .agg(F.count_if(same).alias("same_neighbourhood"),
                 F.count_if(diff).alias("different_neighbourhood")))
    return (g.filter((F.col("same_neighbourhood") > 0) & (F.col("different_neighbourhood") > 0))
             .orderBy((F.col("same_neighbourhood") + F.col("different_neighbourhood")).desc(),
                      F.col("host_name").asc()))


def revenue_vs_mortgage(listing_d: DataFrame, lga_d: DataFrame, census_d: DataFrame,
                        suburb_d: DataFrame) -> DataFrame:
    """All listings per neighbourhood: summed monthly median mortgage over the
    joined rows (named 'annaully' as in the source, no x12) and revenue."""
    per_nb = (listing_d.groupBy("listing_neighbourhood")
              .agg(F.count(F.lit(1)).alias("n_rows"),
                   F.sum(stay_days("availability_30")).alias("stay"),
                   F.sum("price").alias("price_sum")))
    dims = _lga_dims(lga_d, census_d, suburb_d, ["median_mortgage_repay_monthly"])
    j = per_nb.join(dims, per_nb.listing_neighbourhood == dims.lga_name)
    agg = j.groupBy("listing_neighbourhood").agg(
        F.sum("stay").alias("total_staying"), F.sum("price_sum").alias("price"),
        F.sum(F.col("median_mortgage_repay_monthly") * F.col("n_rows"))
         .alias("median_mortgage_annaully"))
    return (agg.select("listing_neighbourhood", "median_mortgage_annaully",
                       (to_number("price") * to_number("total_staying")).alias("estimated_revenue"))
               .orderBy(F.col("estimated_revenue").desc_nulls_first(),
                        F.col("median_mortgage_annaully").desc_nulls_first()))
