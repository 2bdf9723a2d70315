"""Quoted line breaks over splits against Python's csv module, headers of many files
by a fixed number of jobs, inferred types."""
import csv
import os
import random
from collections import Counter

import pytest
from pyspark.sql import types as T

from staylens import schemas
from staylens.sources import csv_ingest, csv_records
from staylens.sources.csv_records import scan_files

NAMES = [n for n, _ in schemas.SNAPSHOT_FIELDS]


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _write(path, header, rows):
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh, lineterminator="\n")
        w.writerow(header)
        w.writerows(rows)


def _field(rng):
    return rng.choice(["a", "", "b c", 'say "x"', "one\ntwo", "\n", '"\n"', "x,\ny,\n,z", "line\n" * rng.randrange(1, 40), "é\n漢"])


def test_records_over_many_splits(spark, tmpdir_path, small_splits):
    rng, want = random.Random(6), Counter()
    for f in range(4):
        rows = [[str(k), _field(rng), "".join(rng.choices("xyz ", k=rng.randrange(30))), _field(rng)] for k in range(60)]
        if f == 3:  # a field longer than several splits, and a file without any break
            rows[10][1] = 'begins "here"\n' + "never ending story\n" * 100
        if f == 2:
            rows = [[c.replace("\n", " ") for c in r] for r in rows]
        _write(f"{tmpdir_path}/t{f}.csv", ["k", "a", "b", "c"], rows)
        want.update((f"t{f}", *(c or None for c in r)) for r in rows)
    tables = csv_ingest.list_tables(spark, tmpdir_path)
    scan = scan_files(spark, [p for ps in tables.values() for p in ps])
    assert {p.rsplit("/", 1)[-1] for p in scan.broken} == {"t0.csv", "t1.csv", "t3.csv"} and len(scan.inside) > 5
    got = csv_ingest.read_text_fields(spark, tables, ["k", "a", "b", "c"], scan=scan)
    assert Counter((r["source_table"], r["k"], r["a"], r["b"], r["c"]) for r in got.collect()) == want


def test_a_name_with_a_line_break_stays_whole(spark, tmpdir_path):
    def row(k, name):
        return [(dict.fromkeys(NAMES, "") | {"listing_id": str(k), "host_name": name, "price": "10", "host_neighbourhood": "x"})[n]
                for n in NAMES]
    _write(f"{tmpdir_path}/listing_05_2020.csv", NAMES, [row(1, "An\nna"), row(2, "Bo"), row(3, 'Q "\n" r')])
    loaded, rejected = csv_ingest.load_snapshots(spark, tmpdir_path)
    got = {r.listing_id: (r.host_name, r.price, r.host_neighbourhood, r.source_table) for r in loaded.collect()}
    assert got == {1: ("An\nna", 10, "x", "listing_05_2020"), 2: ("Bo", 10, "x", "listing_05_2020"),
                   3: ('Q "\n" r', 10, "x", "listing_05_2020")}
    assert rejected.count() == 0


def _jobs(spark, action):
    spark.sparkContext.setJobGroup(f"count-{random.random()}", "jobs")
    group = spark.sparkContext.getLocalProperty("spark.jobGroup.id")
    action()
    n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return n


def test_many_files_take_a_fixed_number_of_jobs(spark, tmpdir_path):
    for count in (5, 500):
        os.makedirs(f"{tmpdir_path}/{count}")
        for k in range(count):
            _write(f"{tmpdir_path}/{count}/t{k}.csv", ["Id", "v"], [[k, "0.5"]])

    def load(count):
        tables = csv_ingest.list_tables(spark, f"{tmpdir_path}/{count}")
        found = csv_ingest.infer_raw_schemas(spark, tables)
        assert len(found) == count
        assert {s.simpleString() for s in found.values()} == {"struct<id:bigint,v:double>"}
        rows = csv_ingest.parse_typed(csv_ingest.read_text_fields(spark, tables, ["id", "v"]), found["t0"])[0]
        assert rows.count() == count

    few, many = (_jobs(spark, lambda c=c: load(c)) for c in (5, 500))
    assert many <= few + 4  # listing of many paths may take jobs of its own


def test_inferred_types(spark, tmpdir_path):
    _write(f"{tmpdir_path}/a.csv", ["I", "D", "B", "S", "N", "Mixed", "Day", "Big", "E"], [
        ["1", "1", "true", "x", "NULL", "1", "2020-01-01", "99999999999999999999", "1e3"],
        ["-2", "0.5", "False", "", "", "x", "2020-01-02", "1", "2"], ["NULL", "", "", "", "null", "2", "", "", ""]])
    _write(f"{tmpdir_path}/b.csv", ["I", "D", "B", "S", "N", "Mixed", "Day", "Big", "E"], [["x", "1"]])
    _write(f"{tmpdir_path}/c.csv", ["only", "header"], [])
    open(f"{tmpdir_path}/empty.csv", "w").close()
    found = csv_ingest.infer_raw_schemas(spark, csv_ingest.list_tables(spark, tmpdir_path))
    long, real, flag, text = T.LongType(), T.DoubleType(), T.BooleanType(), T.StringType()
    assert [f.dataType for f in found["a"]] == [long, real, flag, text, text, text, text, real, real]
    assert [f.dataType for f in found["b"]][:3] == [text, long, text]  # every table by its own values
    assert found["c"].simpleString() == "struct<only:string,header:string>" and not found["empty"].fields


def test_the_scan_sorts_no_lines(spark, tmpdir_path, monkeypatch):
    """A sort that spills does not keep the order of a file's lines: any of them came
    out as the first one, the header."""
    for k in range(3):
        _write(f"{tmpdir_path}/t{k}.csv", [f"Id{k}", "v"], [[n, 'a "q"' if n % 2 else "b\nc"] for n in range(25_000)])
    plans, keep = [], csv_records.stored
    monkeypatch.setattr(csv_records, "stored", lambda df, tag: (plans.append(df), keep(df, tag))[1])
    paths = [p for ps in csv_ingest.list_tables(spark, tmpdir_path).values() for p in ps]
    scan = scan_files(spark, paths)
    assert sorted(scan.header(p) for p in paths) == [(f"Id{k}", "v") for k in range(3)] and len(scan.broken) == 3
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan
    for r in plans[0].collect():  # several batches a file
        with open("/" + r["file"].partition(":")[2].lstrip("/")) as fh:
            lines = fh.read().split("\n")
        assert (r["first"], r["odd"], r["quotes"]) == (
            lines[0], sum(x.count('"') % 2 for x in lines), sum(x.count('"') for x in lines))
