"""Adapter: driver parquet tables -> reference-shaped inputs.

It only *renames and re-types* existing rows so the job has inputs of the
schema it expects; it computes none of the job's results. One snapshot row is
produced per ``lineitem`` row:

  listing_id            <- l_partkey (many rows per id across months: real fan-out)
  scraped_date          <- o_orderdate as 'yyyy-MM-dd'
  listing_neighbourhood <- supplier nation name
  host_neighbourhood    <- customer nation name
  property_type / room_type / accommodates <- p_type / p_brand / p_size
  price                 <- round(l_extendedprice)
  has_availability      <- 't' when l_linestatus = 'O' else 'f'
  host_is_superhost     <- 't' when l_returnflag = 'A' else 'f'
  ...

Reference tables: one LGA per nation (code 10000 + n_nationkey), two suburbs
per LGA whose LGA name is lower-cased (so the case-folding join is exercised),
census counts from customer market segments per nation.
"""
from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens import schemas
from staylens.session import stored

LGA_CODE_BASE = 10000


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _broadcast(df: DataFrame) -> bool:
    """Whether Spark may broadcast ``df``, by its estimate from the files' sizes."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def snapshot(spark: SparkSession, sf_dir: str, tasks: int = 1) -> DataFrame:
    """All listing snapshot rows (raw file shape, see FIXTURES.md §1). Line items
    in fewer files than ``tasks`` are dealt to that many partitions, unless the join
    with orders is too large for a broadcast and so deals them anyway."""
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        # as short as they are used: these rows are shuffled
        F.col("l_quantity").cast("bigint").alias("qty"), F.round("l_extendedprice").cast("bigint").alias("price"),
        F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_returnflag", "l_linestatus")
    orders = _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    if len(li.inputFiles()) < tasks and _broadcast(orders):
        li = li.repartition(tasks, "l_orderkey")
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_size")
    supp = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    cust = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    sn = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("s_nation"))
    cn = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("c_nation"))

    # customers meet the orders and the part's long texts come last: a shuffle of line
    # items carries no more columns than it must
    rows = (li.join(orders.join(cust, F.col("o_custkey") == cust.c_custkey).drop("o_custkey", "c_custkey"),
                    li.l_orderkey == F.col("o_orderkey"))
              .join(supp, li.l_suppkey == supp.s_suppkey)
              .join(part, li.l_partkey == part.p_partkey)
              .join(sn, "s_nationkey")
              .join(cn, "c_nationkey"))
    qty = F.col("qty")
    return rows.select(
        F.col("l_partkey").alias("listing_id"),
        F.col("l_orderkey").alias("scrape_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("scraped_date"),
        F.col("l_suppkey").alias("host_id"),
        F.col("s_name").alias("host_name"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("host_since"),
        F.when(F.col("l_returnflag") == "A", "t").otherwise("f").alias("host_is_superhost"),
        F.col("c_nation").alias("host_neighbourhood"),
        F.col("s_nation").alias("listing_neighbourhood"),
        F.col("p_type").alias("property_type"),
        F.col("p_brand").alias("room_type"),
        F.col("p_size").cast("bigint").alias("accommodates"),
        "price",
        F.when(F.col("l_linestatus") == "O", "t").otherwise("f").alias("has_availability"),
        (qty % 31).alias("availability_30"),
        F.col("l_linenumber").cast("bigint").alias("number_of_reviews"),
        F.when(F.col("l_returnflag") == "R", F.lit(None))
         .otherwise(qty + 50).cast("double").alias("review_scores_rating"),
        (F.col("l_linenumber").cast("double") + F.lit(0.5)).alias("review_scores_accuracy"),
        (qty % 11).cast("double").alias("review_scores_cleanliness"),
        (qty % 7).cast("double").alias("review_scores_checkin"),
        F.when(F.col("l_linestatus") == "F", F.lit(None))
         .otherwise(qty % 5).cast("double").alias("review_scores_communication"),
        ((qty % 9).cast("double") + F.lit(0.5)).alias("review_scores_value"),
    )


def nsw_lga_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation")
    return n.select((F.lit(LGA_CODE_BASE) + F.col("n_nationkey")).cast("bigint").alias("lga_code"),
                    F.col("n_name").alias("lga_name"))


def nsw_lga_suburb(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation")
    side = F.explode(F.array(F.lit("NORTH"), F.lit("SOUTH"))).alias("side")
    return (n.select("n_name", side)
             .select(F.lower("n_name").alias("lga_name"),
                     F.concat_ws(" ", "n_name", "side").alias("suburb_name")))


def _raw_code() -> F.Column:
    return F.concat(F.lit("LGA"), (F.lit(LGA_CODE_BASE) + F.col("n_nationkey")).cast("string"))


def census_01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per LGA: totals = all customers, four age bands = four market
    segments; _m = even custkey, _f = odd, _p = both. Counts with no natural
    source are 0 (they only carry the schema)."""
    n = _read(spark, sf_dir, "nation").select("n_nationkey")
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    joined = n.join(c, n.n_nationkey == c.c_nationkey, "left")
    even = (F.col("c_custkey") % 2) == 0
    bands = {"tot_p": None, "age_0_4_yr": "AUTOMOBILE", "age_5_14_yr": "BUILDING",
             "age_15_19_yr": "FURNITURE", "age_20_24_yr": "HOUSEHOLD"}
    aggs = []
    for band, seg in bands.items():
        in_band = F.col("c_custkey").isNotNull() if seg is None else (F.col("c_mktsegment") == seg)
        aggs += [F.count_if(in_band & even).alias(f"{band}_m"),
                 F.count_if(in_band & ~even).alias(f"{band}_f"),
                 F.count_if(in_band).alias(f"{band}_p")]
    counts = joined.groupBy("n_nationkey").agg(*aggs)
    cols = [_raw_code().alias("lga_code_2016")]
    for name in schemas.CENSUS_COUNT_COLUMNS:
        if name in counts.columns:
            cols.append(F.col(name).cast("bigint").alias(name))
        else:
            cols.append(F.lit(0).cast("bigint").alias(name))
    return counts.select(*cols)


def census_02(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians per LGA; the mortgage is the largest rounded account balance of
    the nation's customers (0 when it has none)."""
    n = _read(spark, sf_dir, "nation").select("n_nationkey")
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    joined = n.join(c, n.n_nationkey == c.c_nationkey, "left")
    agg = joined.groupBy("n_nationkey").agg(
        F.coalesce(F.max(F.round("c_acctbal").cast("bigint")), F.lit(0).cast("bigint"))
         .alias("median_mortgage_repay_monthly"),
        F.count("c_custkey").cast("bigint").alias("n_cust"))
    return agg.select(
        _raw_code().alias("lga_code_2016"),
        (F.lit(30) + F.col("n_nationkey")).cast("bigint").alias("median_age_persons"),
        F.col("median_mortgage_repay_monthly"),
        (F.col("n_cust") * 10).alias("median_tot_prsnl_inc_weekly"),
        (F.col("n_cust") * 3).alias("median_rent_weekly"),
        (F.col("n_cust") * 20).alias("median_tot_fam_inc_weekly"),
        F.lit(1.25).alias("average_num_psns_per_bedroom"),
        (F.col("n_cust") * 15).alias("median_tot_hhd_inc_weekly"),
        F.lit(2.5).alias("average_household_size"),
    )


#: Application and folder -> stored snapshot.
_STAGED: dict[tuple[str, str], DataFrame] = {}


def staged_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot as a table of the scratch folder, written when a query of the
    application first runs over ``sf_dir``; later queries read only the columns
    they need."""
    key = spark.sparkContext.applicationId, sf_dir.rstrip("/")
    if key not in _STAGED:
        _STAGED[key] = stored(snapshot(spark, sf_dir, spark.sparkContext.defaultParallelism), "snapshot")
    return _STAGED[key]


class Inputs:
    """Reference-shaped inputs for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, staged: bool = True):
        self.spark, self.sf_dir, self.staged = spark, sf_dir, staged

    def snapshot(self) -> DataFrame:
        if self.staged:
            return staged_snapshot(self.spark, self.sf_dir)
        return snapshot(self.spark, self.sf_dir)

    def lga_code(self) -> DataFrame:
        return nsw_lga_code(self.spark, self.sf_dir)

    def lga_suburb(self) -> DataFrame:
        return nsw_lga_suburb(self.spark, self.sf_dir)

    def census_01(self) -> DataFrame:
        return census_01(self.spark, self.sf_dir)

    def census_02(self) -> DataFrame:
        return census_02(self.spark, self.sf_dir)
