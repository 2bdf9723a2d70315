"""What queries leave on disk while they go on: shuffle files, text of records that are
parsed already, files of loads that are in no table."""
import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from staylens import registry, session
from staylens.operators import fanout
from staylens.plans import layers, marts
from staylens.sources import csv_ingest, csv_records, testdata
from tests.helpers import dims, snap_row as r, snapshot_df


def _shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return {f for k in range(files.size()) if (f := files.apply(k).getName()).startswith("shuffle_") and f.endswith(".data")}


def test_a_long_write_leaves_no_shuffle_files(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(session, "LONG_WRITE", 0.0)
    rows = spark.range(2000).withColumn("t", (F.col("id") % 3).cast("string"))
    wh = layers.Warehouse(spark, f"{tmpdir_path}/wh")
    for write in (lambda: session.stored(rows.repartition(3, "id"), "freed"),
                  lambda: wh.write("raw", "x", rows, ["t"]),
                  lambda: csv_ingest.write_csv_tables(rows.withColumnRenamed("t", "source_table"), f"{tmpdir_path}/csv")):
        before = _shuffle_files(spark)
        write()
        until = time.time() + 20
        while (left := _shuffle_files(spark) - before) and time.time() < until:
            time.sleep(0.2)
        assert not left


def test_packed_month_files_are_read_back(spark, tmpdir_path):
    rows = snapshot_df(spark, [r(k, f"2020-0{1 + k % 3}", host='An "x",\nna' if k % 4 == 0 else f"h{k}") for k in range(40)])
    named = rows.withColumn("source_table", F.concat(F.lit("listing_0"), F.substring("scraped_date", 7, 1), F.lit("_2020")))
    csv_ingest.write_csv_tables(named, f"{tmpdir_path}/w", packed=True)
    files = glob.glob(f"{tmpdir_path}/w/*/part-*")
    assert len(files) == 3 and all(f.endswith(".csv.gz") for f in files)
    loaded, rejected = csv_ingest.load_snapshots(spark, f"{tmpdir_path}/w")
    assert sorted(map(str, loaded.collect())) == sorted(map(str, named.collect())) and rejected.count() == 0


def test_records_on_one_line_are_stored_as_fields_only(spark, tmpdir_path, monkeypatch):
    with open(f"{tmpdir_path}/listing_05_2020.csv", "w") as fh:
        fh.write('a,b\n1,x\n2,"two\nlines"\n\n3,"q"\n')
    plans, keep = {}, csv_records.stored
    monkeypatch.setattr(csv_records, "stored", lambda df, tag: plans.setdefault(tag, keep(df, tag)))
    got = csv_ingest.read_text_fields(spark, csv_ingest.list_tables(spark, tmpdir_path), ["a", "b"])
    assert {tuple(x)[:2] for x in got.collect()} == {("1", "x"), ("2", "two\nlines"), ("3", "q")}
    lines = plans["csv-lines"].collect()
    assert sorted((x["value"], x["r"] and tuple(x["r"])) for x in lines if x["value"]) == [('2,"two', None), ('lines"', None)]
    assert sorted(tuple(x["r"]) for x in lines if x["value"] is None) == [("1", "x"), ("3", "q")]


def test_a_reload_keeps_no_files_of_the_first_load(spark, monkeypatch):
    rows = [r(k, f"2020-0{1 + k % 4}", price=k) for k in range(60)]
    snapshot, made, new = snapshot_df(spark, rows), [], session.new_scratch_dir
    monkeypatch.setattr(registry.Ctx, "snapshot", lambda self: snapshot)
    monkeypatch.setattr(session, "new_scratch_dir", lambda s, tag: made.append((tag, new(s, tag))) or made[-1][1])
    monkeypatch.setattr(registry, "_REGISTRY", {})
    layers._register()  # again, with the folders noted
    got = {x["source_table"]: x["n_rows"] for x in registry._REGISTRY["layer_reset_reload"](spark, "").collect()}
    assert got == {"listing_02_2020": 15, "listing_04_2020": 15}
    paths = {tag: [p.removeprefix("file:") for t, p in made if t == tag] for tag in ("csv", "wh")}
    assert len(paths["csv"]) == 2 and not any(os.path.exists(p) for p in paths["csv"])
    assert len(glob.glob(f"{paths['wh'][0]}/raw/*/*/source_table=*")) == 2  # not the four of the first load


def test_only_scratch_folders_are_discarded(spark, tmpdir_path):
    with pytest.raises(ValueError):
        session.discard(spark, tmpdir_path)
    assert os.path.isdir(tmpdir_path)


def test_a_mart_of_one_set_stores_its_parts(spark, monkeypatch):
    """Statistics, hosts and median each leave a table with a row per group."""
    ld, hd = dims(spark, [r(k % 5, f"2020-0{1 + k % 3}", nb="AB"[k % 2], host=f"h{k % 4}", price=k) for k in range(30)])
    tags = []
    for module in (fanout, marts):
        keep = module.stored
        monkeypatch.setattr(module, "stored", lambda df, tag, keep=keep: tags.append(tag) or keep(df, tag))
    mart = marts.active_listing_stats(ld, hd, marts.NEIGHBOURHOOD_KEYS)
    assert {"month-stats", "group-hosts", "group-medians"} <= set(tags)
    assert "listing_id" not in mart._jdf.queryExecution().optimizedPlan().toString()


def test_the_adapter_deals_few_line_items_but_not_large_orders(spark, tmpdir_path):
    """Customers and orders meet before the line items; without a broadcast the join
    deals the rows, and a shuffle more would do nothing."""
    def save(name, ddl, *rows):
        spark.createDataFrame(list(rows), ddl).coalesce(1).write.parquet(f"{tmpdir_path}/{name}.parquet")
    save("lineitem", "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
         "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
         *((o, 1, 1, n, 7.0, 10.5 + n, "A", "O", None) for o in (1, 2, 3) for n in (1, 2)), (9, 1, 1, 1, 1.0, 1.0, "A", "O", None))
    save("orders", "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz", (1, 1, None), (1, 1, None), (2, 1, None), (3, None, None))
    save("customer", "c_custkey long, c_nationkey int", (1, 1))
    save("supplier", "s_suppkey long, s_name string, s_nationkey int", (1, "s", 1))
    save("part", "p_partkey long, p_type string, p_brand string, p_size int", (1, "t", "b", 3))
    save("nation", "n_nationkey int, n_name string", (1, "N"))
    old, plans = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), {}
    try:
        for threshold in ("10m", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            df = testdata.snapshot(spark, tmpdir_path, 4)
            assert sorted((x["scrape_id"], x["price"], x["availability_30"]) for x in df.collect()) == [
                (1, 12, 7), (1, 12, 7), (1, 13, 7), (1, 13, 7), (2, 12, 7), (2, 13, 7)]
            plans[threshold] = df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "RepartitionByExpression" in plans["10m"] and "RepartitionByExpression" not in plans["-1"]
