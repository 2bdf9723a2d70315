import csv
import glob
import os

import pytest

from staylens import schemas
from staylens.plans import marts, pipeline
from tests.helpers import FIELDS, dims, rows_of, snap_row as r

M1, M2 = "2020-05", "2020-06"
ROWS = {
    "listing_05_2020": [r(1, M1, "Inner West", superhost="t", host="h1", host_nb="Inner West"),
                        r(2, M1, "Inner West", active="f", host="h2", host_nb="Inner West"),
                        r(3, M1, "Ryde", superhost="t", host="h3", host_nb="Inner West", price=250)],
    "listing_06_2020": [r(1, M2, "Inner West", superhost="t", host="h1", host_nb="Inner West"),
                        r(4, M2, "Ryde", active="f", host="h4", host_nb="Ryde"),
                        r(3, M2, "Ryde", superhost="t", host="h3", host_nb="Inner West", price=260)],
}


def _write(path, header, rows):
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        w.writerows(rows)


def _sources(root):
    os.makedirs(f"{root}/listings")
    for name, rows in ROWS.items():
        _write(f"{root}/listings/{name}.csv", [f.upper() for f in FIELDS],
               [["" if x[f] is None else x[f] for f in FIELDS] for x in rows])
    counts = schemas.CENSUS_COUNT_COLUMNS
    _write(f"{root}/census_01.csv", ["LGA_CODE_2016"] + counts,
           [["LGA10001"] + [3] * len(counts), ["LGA10002"] + [5] * len(counts)])
    _write(f"{root}/census_02.csv", ["LGA_CODE_2016"] + schemas.CENSUS_MEDIAN_COLUMNS,
           [["LGA10001", 40, 2000, 1, 1, 1, 1.5, 1, 2.5], ["LGA10002", 41, 2100, 1, 1, 1, 1.5, 1, 2.5]])
    _write(f"{root}/nsw_lga_code.csv", ["LGA_CODE", "LGA_NAME"], [[10001, "Inner West"], [10002, "Ryde"]])
    _write(f"{root}/nsw_lga_suburb.csv", ["LGA_NAME", "SUBURB_NAME"],
           [["INNER WEST", "LEICHHARDT"], ["INNER WEST", "ANNANDALE"], ["RYDE", "RYDE"]])
    _write(f"{root}/listings/extra_rates.csv", ["Code", "Rate", "Day"],
           [[1, 0.5, "2020-01-02"], [2, 1.5, "2020-01-03"]])


def _snap(wh, layer, name):
    return sorted((tuple(x.values()) for x in rows_of(wh.read(layer, name))), key=str)


def test_pipeline_end_to_end_and_idempotent(spark, tmpdir_path):
    src, wh_root, out = f"{tmpdir_path}/src", f"{tmpdir_path}/wh", f"{tmpdir_path}/out"
    _sources(src)
    res = pipeline.run_pipeline(spark, src, wh_root, out)
    wh = res.warehouse
    assert wh.read("raw", pipeline.SNAPSHOT_TABLE).count() == 6
    extra = wh.read("raw", "extra_rates")          # undeclared file: inferred, widened
    assert [(f.name, f.dataType.simpleString()) for f in extra.schema.fields] == [
        ("code", "bigint"), ("rate", "double"), ("day", "string")]
    assert extra.count() == 2
    assert sorted(wh.tables("datawarehouse")) == sorted(
        t[len("stg_"):] for t in pipeline.STAGE_TABLES)
    # fact: listing x host on listing_id, x suburbs of the LGA
    # ids 1 (2 snapshots: 4 joined) and 3 (4 joined) and 2 (1) and 4 (1) -> Inner West 5, Ryde 5;
    # Inner West has 2 suburbs, Ryde 1 -> 5 * 2 + 5 = 15
    assert wh.read("datawarehouse", "rental_f").count() == 15
    ids = wh.read("datawarehouse", "listing_d").select("id").collect()
    assert sorted(x.id for x in ids) == list(range(1, 7))
    # the warehouse mart equals the mart computed directly from the rows
    all_rows = [x for rows in ROWS.values() for x in rows]
    ld, hd = dims(spark, all_rows)
    direct = sorted((tuple(x.values()) for x in rows_of(marts.listing_neighbourhood_mart(ld, hd))), key=str)
    assert wh.read("datamart", "dm_listing_neighbourhood").columns == marts.MART_COLUMNS
    assert _snap(wh, "datamart", "dm_listing_neighbourhood") == direct
    first = {t: _snap(wh, "datamart", t) for t in pipeline.MART_ORDER}
    # export layout: unnamed row-number column, upper-case names
    files = glob.glob(f"{out}/dm_host_neighbourhood/*.csv")
    with open(sorted(files)[0]) as fh:
        assert fh.readline().strip() == (",HOST_NEIGHBOURHOOD_LGA,S_DATE,DISTINCT_HOST_COUNT,"
                                         "AVERAGE_ESTIMATED_REVENUE,AVERAGE_REVENUE_P_HOST")
    # running again gives the same tables (full refresh, no duplicated dims)
    pipeline.run_pipeline(spark, src, wh_root, out)
    assert {t: _snap(wh, "datamart", t) for t in pipeline.MART_ORDER} == first
    assert wh.read("datawarehouse", "listing_d").count() == 6
    # every loaded table is in staging, with its partitions; all tables have names
    assert {pipeline.SNAPSHOT_TABLE, *pipeline.REFERENCE_TABLES, "extra_rates"} <= set(wh.tables("staging"))
    assert wh.partition_columns("staging", pipeline.SNAPSHOT_TABLE) == ["source_table"]
    assert spark.sql("SELECT count(*) AS n FROM staging.listing_snapshots WHERE source_table = 'listing_05_2020'"
                     ).first().n == 3
    assert spark.table("datamart.dm_host_neighbourhood").count() == wh.read("datamart", "dm_host_neighbourhood").count()
    assert spark.table(f"raw.{pipeline.REJECTS}").count() == 0
    # reset keeps every table and empties it
    tables = {f"{layer}.{t}" for layer in schemas.LAYERS for t in wh.tables(layer)}
    columns = {t: spark.table(t).columns for t in tables}
    assert set(wh.reset()) == tables
    for t in tables:
        assert wh.read(*t.split(".")).count() == 0 and spark.table(t).columns == columns[t]


def test_withdrawn_file_disappears_and_missing_source_touches_nothing(spark, tmpdir_path):
    src, wh_root = f"{tmpdir_path}/src", f"{tmpdir_path}/wh"
    _sources(src)
    wh = pipeline.run_pipeline(spark, src, wh_root, names=False).warehouse
    assert wh.read("datawarehouse", "listing_d").count() == 6
    os.remove(f"{src}/listings/listing_06_2020.csv")
    kept = pipeline.run_pipeline(spark, src, wh_root, reset=False, names=False).warehouse
    assert kept.read("raw", pipeline.SNAPSHOT_TABLE).count() == 6     # without a reset it stays
    pipeline.run_pipeline(spark, src, wh_root, names=False)
    assert wh.read("raw", pipeline.SNAPSHOT_TABLE).count() == 3
    assert wh.read("datawarehouse", "listing_d").count() == 3
    for gone in ("listings/listing_05_2020.csv", "census_02.csv"):
        os.remove(f"{src}/{gone}")
        with pytest.raises(FileNotFoundError):
            pipeline.run_pipeline(spark, src, wh_root, names=False)
        assert wh.read("datawarehouse", "listing_d").count() == 3
        _sources_again = f"{tmpdir_path}/again"
        if not os.path.isdir(_sources_again):
            _sources(_sources_again)
            os.replace(f"{_sources_again}/listings/listing_05_2020.csv", f"{src}/listings/listing_05_2020.csv")


def test_rejects_are_stored_and_a_failed_write_keeps_the_table(spark, tmpdir_path):
    src = f"{tmpdir_path}/src"
    _sources(src)
    with open(f"{src}/listings/listing_05_2020.csv", "a") as fh:
        fh.write("77," + ",".join("oops" if f == "price" else "" for f in FIELDS[1:]) + "\n")
    res = pipeline.run_pipeline(spark, src, f"{tmpdir_path}/wh", names=False)
    (bad,) = res.warehouse.read("raw", pipeline.REJECTS).collect()
    assert (bad.target_table, bad.source_table, bad.reject_columns) == (
        pipeline.SNAPSHOT_TABLE, "listing_05_2020", "price")
    assert bad.fields["listing_id"] == "77" and bad.fields["price"] == "oops"
    from pyspark.sql import functions as F
    failing = spark.range(3).select(F.raise_error(F.lit("no")).alias("x"))
    with pytest.raises(Exception, match="no"):
        res.warehouse.write("raw", "census_01", failing)
    assert res.warehouse.read("raw", "census_01").count() == 2


def _state(wh):
    return {f"{layer}.{t}": _snap(wh, layer, t) for layer in schemas.LAYERS for t in wh.tables(layer)}


def test_a_run_that_dies_between_stages_leaves_every_old_table(spark, tmpdir_path, monkeypatch):
    src, wh_root = f"{tmpdir_path}/src", f"{tmpdir_path}/wh"
    _sources(src)
    wh = pipeline.run_pipeline(spark, src, wh_root, names=False).warehouse
    before, versions = _state(wh), wh.versions()
    _write(f"{src}/listings/listing_05_2020.csv", [f.upper() for f in FIELDS],
           [["" if x[f] is None else x[f] for f in FIELDS] for x in ROWS["listing_05_2020"][:1]])
    for stage, reset in (("load_raw", True), ("load_raw", False), ("build_star", True), ("_publish", True)):
        home = pipeline if hasattr(pipeline, stage) else pipeline.Warehouse
        real = getattr(home, stage)

        def dies(*args, **kwargs):
            if stage != "_publish":
                real(*args, **kwargs)
            raise RuntimeError("killed")

        with monkeypatch.context() as m:
            m.setattr(home, stage, dies)
            with pytest.raises(RuntimeError, match="killed"):
                pipeline.run_pipeline(spark, src, wh_root, reset=reset, names=False)
        assert pipeline.Warehouse(spark, wh_root).versions() == versions
    again = pipeline.Warehouse(spark, wh_root)
    assert _state(again) == before
    after = pipeline.run_pipeline(spark, src, wh_root, names=False).warehouse
    assert after.read("raw", pipeline.SNAPSHOT_TABLE).count() == 4
    # the folders of the failed runs are named by no version
    gone = after.vacuum(keep=1)
    assert gone and after.read("datawarehouse", "listing_d").count() == 4
    assert len(after.versions()) == 1


def _files(root):
    return {f for d, _, names in os.walk(root) for f in (os.path.join(d, n) for n in names) if f.endswith(".parquet")}


def test_copy_and_promotion_write_no_data_file(spark, tmpdir_path):
    wh = pipeline.Warehouse(spark, f"{tmpdir_path}/wh")
    table = spark.range(10).selectExpr("id", "id % 3 AS m")
    wh.write("raw", "a", table, ["m"])
    wh.write("staging", "stg_b", table)
    before = _files(tmpdir_path)
    wh.copy("raw", "staging", ["a"])
    wh.promote(["stg_b"])
    assert _files(tmpdir_path) == before
    assert wh.folders("staging", "a") == wh.folders("raw", "a")
    assert wh.partition_columns("staging", "a") == ["m"] and wh.read("datawarehouse", "b").count() == 10
    # a refresh of the source does not change the copy
    wh.write("raw", "a", table.limit(1), ["m"])
    assert wh.read("staging", "a").count() == 10 and wh.read("raw", "a").count() == 1


def test_months_are_replaced_without_rewriting_the_others(spark, tmpdir_path):
    wh = pipeline.Warehouse(spark, f"{tmpdir_path}/wh", names=True)
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "x int, m string")
    wh.write("raw", "t", rows, ["m"])
    old = _files(tmpdir_path)
    wh.write("raw", "t", spark.createDataFrame([(20, "b"), (21, "b"), (40, "d")], "x int, m string"), ["m"],
             keep_other_partitions=True)
    wh.write("raw", "t", spark.createDataFrame([(30, "c")], "x int, m string"), ["m"], keep_other_partitions=True)
    assert old <= _files(tmpdir_path)
    want = [(1, "a"), (20, "b"), (21, "b"), (30, "c"), (40, "d")]
    assert sorted(tuple(r) for r in wh.read("raw", "t").collect()) == want
    assert sorted(tuple(r) for r in spark.table("raw.t").select("x", "m").collect()) == want
    plan = wh.read("raw", "t").where("m = 'c'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan
    # nothing new: everything stays
    wh.write("raw", "t", rows.limit(0), ["m"], keep_other_partitions=True)
    assert sorted(tuple(r) for r in wh.read("raw", "t").collect()) == want


def test_two_runs_cannot_publish_the_same_version(spark, tmpdir_path):
    one, two = (pipeline.Warehouse(spark, f"{tmpdir_path}/wh") for _ in range(2))
    one.write("raw", "t", spark.range(1))
    with pytest.raises(OSError, match="another run"):
        with one.run():
            one.write("raw", "t", spark.range(2))
            two.write("raw", "t", spark.range(3))
    assert two.read("raw", "t").count() == 3 and one.read("raw", "t").count() == 3
