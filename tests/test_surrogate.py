from pyspark.sql import functions as F

from staylens.operators.surrogate import with_surrogate_id


def test_ids_are_one_to_n_across_partitions(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") % 13).alias("v"))
    out = with_surrogate_id(df)
    r = out.agg(F.count("*").alias("n"), F.count_distinct("id").alias("d"),
                F.min("id").alias("lo"), F.max("id").alias("hi")).first()
    assert (r.n, r.d, r.lo, r.hi) == (1000, 1000, 1, 1000)
    assert out.columns == ["id", "v"]
    # values untouched
    assert sorted(x.v for x in out.collect()) == sorted(x.v for x in df.collect())


def test_row_number_follows_order(spark):
    from staylens.plans.layers import with_row_number
    df = spark.range(0, 200, 1, 5).select((F.lit(199) - F.col("id")).alias("k"))
    rows = with_row_number(df, ["k"]).collect()
    assert all(r.row_no == r.k for r in rows)


def test_ids_do_not_depend_on_how_scans_split_files(spark, tmpdir_path):
    """The split size changes between building the ids and using them."""
    spark.range(0, 20_000, 1, 4).select(F.col("id").alias("v")).write.parquet(f"{tmpdir_path}/t")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for built, used in (("1m", "4k"), ("4k", "1m"), ("2k", "64k")):
            spark.conf.set(key, built)
            scan = spark.read.parquet(f"{tmpdir_path}/t").filter("v % 2 = 0")
            outs = [with_surrogate_id(scan), with_surrogate_id(scan.groupBy("v").count())]
            spark.conf.set(key, used)
            for out in outs:
                r = out.agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count_distinct("id").alias("d"),
                            F.count_distinct("v").alias("v")).first()
                assert (r.lo, r.hi, r.d, r.v) == (1, 10_000, 10_000, 10_000)
    finally:
        spark.conf.set(key, before)
