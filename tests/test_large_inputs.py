"""What a load or a write costs must follow the rows, not tasks times folders."""
import pytest
from pyspark.sql import functions as F

from staylens.operators.surrogate import with_surrogate_id
from staylens.plans.layers import Warehouse
from staylens.sources import csv_ingest

PATHS = ["file:/a/listing_05_2020.csv", "file:/a/b/listing_05_2020.csv.gz", "file:/a/source_table=listing_01_1995/part-00-x.c000.csv",
         "file:/a/x=y=z/part-1", "file:/a//part-1", "part-1", "a.b.csv", "", "file:/a/", "file:/a/plain/part-0.csv", None]


def _by_patterns(path):
    base = F.regexp_extract(path, r"([^/]+)$", 1)
    folder = F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)
    return F.when(base.startswith("part-"), F.regexp_extract(folder, r"([^=]*)$", 1)).otherwise(
        F.regexp_extract(base, r"^([^.]*)", 1))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_table_names_are_cut_from_paths_as_the_patterns_did(spark):
    rows = spark.createDataFrame([(p,) for p in PATHS], "p string")
    got = rows.select(csv_ingest.table_name_of(F.col("p")).alias("a"), _by_patterns(F.col("p")).alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]
    assert "regexp_extract" not in _plan(rows.select(csv_ingest.table_name_of(F.col("p"))))


@pytest.fixture
def dealt(spark):
    """Four months, each spread over 8 partitions."""
    return spark.range(400).repartition(8, "id").select(
        "id", F.concat(F.lit("listing_0"), (F.col("id") % 4 + 1).cast("string"), F.lit("_2020")).alias("source_table"))


def test_files_of_a_folder_do_not_multiply_with_tasks(spark, dealt, tmp_path):
    csv_ingest.write_csv_tables(dealt, f"{tmp_path}/csv")
    assert len(list(tmp_path.glob("csv/*/*.csv"))) == 4
    got = csv_ingest.read_text_fields(spark, csv_ingest.list_tables(spark, f"{tmp_path}/csv"), ["id"])
    assert sorted(int(r.id) for r in got.collect()) == list(range(400))


def test_parts_of_a_layer_table_do_not_multiply_with_tasks(spark, dealt, tmp_path):
    table = Warehouse(spark, f"{tmp_path}/wh").write("raw", "t", dealt, ["source_table"])
    assert len(table.inputFiles()) == 4
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, dealt.collect()))


def test_broken_records_are_parsed_once(spark, tmp_path):
    (tmp_path / "listing_05_2020.csv").write_text('a,b\n1,"x\ny"\n2,z\nbad,"q"\n')
    text = csv_ingest.read_text_fields(spark, csv_ingest.list_tables(spark, str(tmp_path)), ["a", "b"])
    from pyspark.sql import types as T
    loaded, rejected = csv_ingest.parse_typed(text, T.StructType.fromDDL("a bigint, b string"))
    assert sorted((r.a, r.b) for r in loaded.collect()) == [(1, "x\ny"), (2, "z")]
    assert [(r.a, r.b) for r in rejected.collect()] == [("bad", "q")]
    assert "from_csv" not in _plan(loaded)


def test_surrogate_ids_do_not_shuffle_the_rows(spark, restored_conf):
    restored_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    out = with_surrogate_id(spark.range(100).repartition(8, "id").withColumnRenamed("id", "x"))
    assert "SortMergeJoin" not in _plan(out)
    assert sorted(r.id for r in out.collect()) == list(range(1, 101))


@pytest.fixture
def restored_conf(spark):
    before = {}

    def change(key, value):
        before[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
