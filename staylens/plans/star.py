"""Star schema: five dimensions and the rental fact."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens import schemas
from staylens.functions import lga_code_of
from staylens.operators.pairs import fan_out_join
from staylens.operators.surrogate import with_surrogate_id


def _maybe_id(df: DataFrame, with_id: bool) -> DataFrame:
    return with_surrogate_id(df) if with_id else df


def listing_dim(snapshots: DataFrame, with_id: bool = False) -> DataFrame:
    """Listing dimension: the listing columns of every snapshot row (all
    months appended, no de-duplication). Review scores are stored as whole
    numbers, rounded half up like an insert into NUMBER(38,0)."""
    cols = []
    for c in schemas.LISTING_DIM_COLUMNS:
        if c in schemas.REVIEW_SCORE_COLUMNS:
            cols.append(F.col(c).cast("decimal(38,0)").cast("bigint").alias(c))
        else:
            cols.append(F.col(c))
    return _maybe_id(snapshots.select(*cols), with_id)


def host_dim(snapshots: DataFrame, with_id: bool = False) -> DataFrame:
    """Host dimension: the host columns of every snapshot row."""
    return _maybe_id(snapshots.select(*schemas.HOST_DIM_COLUMNS), with_id)


def suburb_dim(lga_suburb: DataFrame, with_id: bool = False) -> DataFrame:
    return _maybe_id(lga_suburb.select("lga_name", "suburb_name"), with_id)


def lga_dim(lga_code: DataFrame, with_id: bool = False) -> DataFrame:
    """LGA dimension, taken by position (code, name) from the code file."""
    return _maybe_id(lga_code.toDF("lga_code", "lga_name"), with_id)


def census_dim(census_01: DataFrame, census_02: DataFrame, with_id: bool = False) -> DataFrame:
    """Census dimension: the two census files joined 1:1 on the raw code; the
    key keeps its 5 trailing digits as a number ('LGA10050' -> 10050)."""
    c1 = census_01.select("lga_code_2016", *schemas.CENSUS_COUNT_COLUMNS)
    c2 = census_02.select(F.col("lga_code_2016").alias("_c2_code"), *schemas.CENSUS_MEDIAN_COLUMNS)
    joined = c1.join(c2, c1.lga_code_2016 == c2._c2_code)
    out = joined.select(lga_code_of("lga_code_2016").alias("lga_code_2016"),
                        *schemas.CENSUS_COUNT_COLUMNS, *schemas.CENSUS_MEDIAN_COLUMNS)
    return _maybe_id(out, with_id)


def listing_with_lga(listing_d: DataFrame, lga_d: DataFrame) -> DataFrame:
    """Listing -> LGA by exact (case-sensitive) name; unmatched listings drop."""
    return listing_d.join(lga_d, listing_d.listing_neighbourhood == lga_d.lga_name)


def lga_with_census(lga_d: DataFrame, census_d: DataFrame) -> DataFrame:
    """LGA -> census on the numeric code."""
    return lga_d.join(census_d, census_d.lga_code_2016 == lga_d.lga_code)


def lga_with_suburbs(lga_d: DataFrame, suburb_d: DataFrame) -> DataFrame:
    """LGA -> suburbs on lower-cased names (one row per suburb)."""
    s = suburb_d.select(F.lower("lga_name").alias("_suburb_lga_lower"),
                        *[c for c in suburb_d.columns if c != "lga_name"])
    return lga_d.join(s, F.lower(lga_d.lga_name) == s._suburb_lga_lower).drop("_suburb_lga_lower")


def fact_rental(listing_d: DataFrame, host_d: DataFrame, lga_d: DataFrame,
                census_d: DataFrame, suburb_d: DataFrame) -> DataFrame:
    """Fact rows: listing x host on listing_id, x LGA by listing name, x census
    by code, x suburb by lower-cased LGA name. DATE is the host row's scrape
    date, PRICE the listing row's.

    The small dimensions are applied to the listing side before the fan-out
    join (same rows, no growth before the shuffle) and the suburb fan-out is
    applied last, after the shuffle, so only listing and host rows cross the
    network. The fan-out join is sized by the rows it makes (operators.pairs).
    """
    lga = lga_d.select(F.col("id").alias("lga_code_id"), "lga_code", "lga_name")
    cen = census_d.select(F.col("id").alias("census_id"), F.col("lga_code_2016"))
    sub = suburb_d.select(F.col("id").alias("sururb_id"),
                          F.lower("lga_name").alias("_sub_lga_lower"))
    lst = listing_d.select(F.col("id").alias("_l_id"), "listing_id",
                           "listing_neighbourhood", "price")
    host = host_d.select(F.col("id").alias("_h_id"), "listing_id", "scraped_date")

    l_dims = (lst.join(lga, lst.listing_neighbourhood == lga.lga_name)
                 .join(cen, cen.lga_code_2016 == lga.lga_code))
    fanned = fan_out_join(l_dims, host, "listing_id", "_l_id", "_h_id")
    with_sub = fanned.join(sub, F.lower(fanned.lga_name) == sub._sub_lga_lower)
    return with_sub.select(
        F.col("_l_id").alias("listing_id"), F.col("_h_id").alias("host_id"),
        "census_id", "lga_code_id", "sururb_id",
        F.col("scraped_date").alias("date"), "price")
