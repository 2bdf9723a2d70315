import gzip
import os

from staylens.sources import csv_ingest
from staylens import schemas

HEADER = ",".join(n.upper() for n, _ in schemas.SNAPSHOT_FIELDS)


def _line(**over):
    vals = {n: "" for n, _ in schemas.SNAPSHOT_FIELDS}
    vals.update(listing_id="1", scraped_date="2020-05-01", host_name="h", price="100",
                has_availability="t", availability_30="5", listing_neighbourhood="A")
    vals.update(over)
    return ",".join(vals[n] for n, _ in schemas.SNAPSHOT_FIELDS)


def test_tolerant_load(spark, tmpdir_path):
    root = tmpdir_path
    os.makedirs(f"{root}/sub")
    lines = [HEADER,
             _line(listing_id="1", host_name="NULL", host_neighbourhood="null", room_type=""),
             _line(listing_id="2", host_name='"Smith, J"'),
             _line(listing_id="3", price="abc"),                         # rejected
             "4,5,2020-05-02",                                           # short row: padded
             _line(listing_id="5") + ",extra,fields"]                    # long row: extra ignored
    with open(f"{root}/listing_05_2020.csv", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    with gzip.open(f"{root}/sub/listing_06_2020.csv.gz", "wt") as fh:
        fh.write(HEADER + "\n" + _line(listing_id="6", scraped_date="2020-06-01") + "\n")
    with open(f"{root}/census_01.csv", "w") as fh:                      # not a listing table
        fh.write("a,b\n1,2\n")
    loaded, rejected = csv_ingest.load_snapshots(spark, root)
    got = {r.listing_id: r.asDict() for r in loaded.collect()}
    assert set(got) == {1, 2, 4, 5, 6}
    assert got[1]["host_name"] is None and got[1]["host_neighbourhood"] is None
    assert got[1]["room_type"] is None
    assert got[2]["host_name"] == "Smith, J"
    assert got[4]["scraped_date"] == "2020-05-02" and got[4]["price"] is None
    assert got[5]["price"] == 100
    assert got[6]["source_table"] == "listing_06_2020"
    assert got[1]["source_table"] == "listing_05_2020"
    bad = rejected.collect()
    assert len(bad) == 1 and bad[0]["listing_id"] == "3" and bad[0]["reject_columns"] == "price"


def test_table_name_rule(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("file:/d/listing_05_2020.csv",), ("s3a://b/x/Census_01.part.csv.gz",),
                                ("file:/w/source_table=listing_07_2020/part-0001-abc.csv",),
                                ("file:/w/nsw_lga_code/part-0000.csv",)], "p string")
    names = [r.n for r in df.select(csv_ingest.table_name_of(F.col("p")).alias("n")).collect()]
    assert names == ["listing_05_2020", "Census_01", "listing_07_2020", "nsw_lga_code"]


def test_infer_raw_schema_widens(spark, tmpdir_path):
    from pyspark.sql import types as T
    with open(f"{tmpdir_path}/extra.csv", "w") as fh:
        fh.write("Code,Ratio,Day,Name\n1,0.5,2020-01-02,a\n2,1.5,2020-01-03,b\n")
    s = csv_ingest.infer_raw_schema(spark, [f"{tmpdir_path}/extra.csv"])
    assert [(f.name, f.dataType) for f in s.fields] == [
        ("code", T.LongType()), ("ratio", T.DoubleType()), ("day", T.StringType()),
        ("name", T.StringType())]


def test_partition_pruning_for_one_snapshot(spark, tmpdir_path):
    from staylens.plans import adhoc
    from staylens.plans.layers import Warehouse
    from tests.helpers import snapshot_df, snap_row as r
    from pyspark.sql import functions as F
    rows = [r(1, "2021-01", "A", host="h1", host_nb="A"), r(2, "2021-01", "B", host="h1", host_nb="A"),
            r(3, "2021-02", "B", host="h2", host_nb="A"), r(4, "2021-02", "A", host="h2", host_nb="A")]
    s = snapshot_df(spark, rows).withColumn(
        "source_table", F.concat(F.lit("listing_"), F.substring("scraped_date", 6, 2), F.lit("_"),
                                 F.substring("scraped_date", 1, 4)))
    wh = Warehouse(spark, f"{tmpdir_path}/wh")
    raw = wh.write("raw", "listing_snapshots", s, partition_by=["source_table"])
    q = adhoc.host_same_vs_different(raw, source_table="listing_01_2021")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_table" in plan and "listing_01_2021" in plan
    assert [x.host_name for x in q.collect()] == ["h1"]


def test_list_tables_names_part_files_by_folder(spark, tmpdir_path):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, "listing_05_2020"), (2, "listing_06_2020"), (3, "listing_06_2020")],
                               "k long, source_table string")
    csv_ingest.write_csv_tables(df, f"{tmpdir_path}/w")
    with open(f"{tmpdir_path}/w/nsw_lga_code.csv", "w") as fh:
        fh.write("LGA_CODE,LGA_NAME\n1,A\n")
    tables = csv_ingest.list_tables(spark, f"{tmpdir_path}/w")
    assert set(tables) == {"listing_05_2020", "listing_06_2020", "nsw_lga_code"}
    # the column-side rule agrees with the listing-side rule
    back = spark.read.option("header", True).option("recursiveFileLookup", True).csv(
        [p for ps in tables.values() for p in ps])
    names = {r.n for r in back.select(csv_ingest.table_name_of(F.col("_metadata.file_path")).alias("n"))
             .distinct().collect()}
    assert names == set(tables)


def _listing(root, name, header, *lines):
    os.makedirs(root, exist_ok=True)
    with open(f"{root}/{name}.csv", "w") as fh:
        fh.write("\n".join([",".join(header), *lines]) + "\n")


def test_columns_bind_by_header_name(spark, tmpdir_path):
    names = [n for n, _ in schemas.SNAPSHOT_FIELDS]
    swapped = [n.upper() for n in reversed(names)] + ["OTHER"]
    values = dict.fromkeys(names, "") | {"listing_id": "1", "price": "100", "accommodates": "2"}
    _listing(tmpdir_path, "listing_05_2020", names, ",".join(values[n] for n in names))
    _listing(tmpdir_path, "listing_06_2020", swapped, ",".join(values[n.lower()] for n in swapped[:-1]) + ",x")
    loaded, rejected = csv_ingest.load_snapshots(spark, tmpdir_path)
    assert {(r.source_table, r.listing_id, r.price, r.accommodates) for r in loaded.collect()} == {
        ("listing_05_2020", 1, 100, 2), ("listing_06_2020", 1, 100, 2)}
    assert rejected.count() == 0


def test_missing_column_is_an_error_and_optional_is_null(spark, tmpdir_path):
    import pytest
    _listing(tmpdir_path, "listing_05_2020", ["LISTING_ID", "PRICE"], "1,100")
    with pytest.raises(ValueError, match="scrape_id"):
        csv_ingest.load_snapshots(spark, tmpdir_path)
    text = csv_ingest.read_text_fields(spark, csv_ingest.snapshot_tables(spark, tmpdir_path),
                                       ["price", "host_name"], optional=["host_name"])
    assert [tuple(r) for r in text.collect()] == [("100", None, "listing_05_2020")]
    with pytest.raises(FileNotFoundError):
        csv_ingest.load_snapshots(spark, f"{tmpdir_path}/nowhere")


def test_decimals_in_whole_number_columns_round(spark, tmpdir_path):
    names = [n for n, _ in schemas.SNAPSHOT_FIELDS]
    def line(price):
        return ",".join((dict.fromkeys(names, "") | {"listing_id": "1", "price": price})[n] for n in names)
    _listing(tmpdir_path, "listing_05_2020", names, *map(line, ["100.0", "99.5", "-3", "1e2", "12x", "1 000"]))
    loaded, rejected = csv_ingest.load_snapshots(spark, tmpdir_path)
    assert sorted(r.price for r in loaded.collect()) == [-3, 100, 100, 100]
    assert sorted(r.price for r in rejected.collect()) == ["1 000", "12x"]


def test_written_csv_reads_back_unchanged(spark, tmpdir_path):
    names = ['A "b", c ', " x", 'An "x", y', "plain", "back\\slash"]
    fields = [n for n, _ in schemas.SNAPSHOT_FIELDS]
    from tests.helpers import snapshot_df, snap_row
    from pyspark.sql import functions as F
    rows = snapshot_df(spark, [snap_row(k, "2020-05", host=n) for k, n in enumerate(names)])
    csv_ingest.write_csv_tables(rows.withColumn("source_table", F.lit("listing_05_2020")), f"{tmpdir_path}/w")
    loaded, rejected = csv_ingest.load_snapshots(spark, f"{tmpdir_path}/w")
    assert sorted(map(str, loaded.select(fields).collect())) == sorted(map(str, rows.select(fields).collect()))
    assert rejected.count() == 0
