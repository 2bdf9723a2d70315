"""Layers of the job as parquet tables under one shared root:

  <root>/raw/<table>/<tag>  ...  <root>/datamart/<table>/<tag>   data folders
  <root>/_versions/<number>.json                                 the warehouse

A data folder is written once and never changed. Which folders make up a table is
said by the newest version file alone: a small map of layer and table to folders.
A write is a full refresh into a new folder; a load that keeps other months names
the old folders of those months beside the new one. Copying a layer, promoting
staging tables and keeping months only write names, no data.

Inside ``with warehouse.run():`` all changes stay with the run and become one new
version when it ends. A run that fails at any point publishes nothing: readers,
and the next run, still have every table of the version before. Outside of a run
every change is published by itself. ``vacuum`` deletes folders that no kept
version names.

With ``names`` every table is also a view of the session's catalog (``raw.x``,
``staging.x`` ...), renewed after publishing. Exports write CSV part files from
the executors (no collect), with a leading zero-based row number column in the
mart's order.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.schemas import LAYERS
from staylens.session import by_folder, shuffles_freed
from staylens.sources.csv_ingest import csv_writer

STAGING_PREFIX = "stg_"
VERSIONS = "_versions"

#: A table: its partition columns and its parts. A part is a data folder with its
#: schema, and the partition folders that still count (none named: all of it).
Entry = dict


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, names: bool = False):
        self.spark, self.root, self.names = spark, root.rstrip("/"), names
        self._draft: dict[str, Entry] | None = None

    # -- the version file --------------------------------------------------
    def _fs(self):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return hadoop.Path, hadoop.Path(self.root).getFileSystem(conf)

    def _list(self, path: str, folders: bool) -> list[str]:
        to, fs = self._fs()
        if not fs.exists(to(path)):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(to(path)) if s.isDirectory() == folders)

    def versions(self) -> list[int]:
        """Numbers of the published versions, ascending."""
        names = self._list(f"{self.root}/{VERSIONS}", folders=False)
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _load(self, version: int) -> dict[str, Entry]:
        to, fs = self._fs()
        stream = fs.open(to(f"{self.root}/{VERSIONS}/{version:012d}.json"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def state(self) -> dict[str, Entry]:
        """The tables as this warehouse object sees them: its run's, or those of
        the newest version."""
        if self._draft is not None:
            return self._draft
        known = self.versions()
        return self._load(known[-1]) if known else {}

    def _publish(self, tables: dict[str, Entry], base: int) -> None:
        """``tables`` as the version after ``base``; an error if another run has
        published in between."""
        to, fs = self._fs()
        target = to(f"{self.root}/{VERSIONS}/{base + 1:012d}.json")
        written = to(f"{self.root}/{VERSIONS}/new-{uuid.uuid4().hex}")
        stream = fs.create(written, False)
        stream.write(bytearray(json.dumps(tables, sort_keys=True, indent=1).encode()))
        stream.close()
        if fs.exists(target) or not fs.rename(written, target):
            fs.delete(written, False)
            raise OSError(f"another run has published version {base + 1} of {self.root}")

    @contextmanager
    def run(self) -> Iterator[Warehouse]:
        """All changes inside become one version, or none if the run fails."""
        if self._draft is not None:
            raise RuntimeError("a run is open already")
        known = self.versions()
        base = known[-1] if known else 0
        before = self._load(base) if known else {}
        self._draft = dict(before)
        try:
            yield self
            made = self._draft
            if made != before:
                self._publish(made, base)
        finally:
            self._draft = None
        for table in made:
            if made[table] != before.get(table):
                self._name(table, made[table])

    def _put(self, changes: dict[str, Entry]) -> None:
        if self._draft is not None:
            self._draft |= changes
        else:
            with self.run():
                self._draft |= changes

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the data folders that none of the last ``keep`` versions names, and
        the older version files; the folders deleted. Not while a run is open."""
        to, fs = self._fs()
        known = self.versions()
        named = {part["path"] for v in known[-keep:] for e in self._load(v).values() for part in e["parts"]}
        gone = [path for layer in LAYERS for t in self._list(f"{self.root}/{layer}", folders=True)
                for tag in self._list(f"{self.root}/{layer}/{t}", folders=True)
                if (path := f"{self.root}/{layer}/{t}/{tag}") not in named]
        for v in known[:-keep]:
            fs.delete(to(f"{self.root}/{VERSIONS}/{v:012d}.json"), False)
        for path in gone:
            fs.delete(to(path), True)
        return gone

    # -- tables --------------------------------------------------------------
    @staticmethod
    def _key(layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
        return f"{layer}.{table.lower()}"

    def exists(self, layer: str, table: str) -> bool:
        return self._key(layer, table) in self.state()

    def tables(self, layer: str) -> list[str]:
        return sorted(k.split(".", 1)[1] for k in self.state() if k.startswith(f"{layer}."))

    def partition_columns(self, layer: str, table: str) -> list[str]:
        return list(self.state()[self._key(layer, table)]["partitions"])

    def folders(self, layer: str, table: str) -> list[str]:
        """Data folders of a table."""
        return [part["path"] for part in self.state()[self._key(layer, table)]["parts"]]

    def write(self, layer: str, table: str, df: DataFrame, partition_by: Iterable[str] = (),
              keep_other_partitions: bool = False) -> DataFrame:
        """Full refresh of a table, or of the partitions in ``df`` only; returns
        the table as written."""
        key, columns = self._key(layer, table), list(partition_by)
        path = f"{self.root}/{key.replace('.', '/', 1)}/{uuid.uuid4().hex[:12]}"
        with shuffles_freed(self.spark):
            (by_folder(df, *columns) if columns else df).write.partitionBy(*columns).parquet(path)
        fields = [*(f for f in df.schema.fields if f.name not in columns), *(df.schema[c] for c in columns)]
        fresh = [n for n in self._list(path, folders=True) if "=" in n] if columns else []
        parts = [{"path": path, "schema": T.StructType(fields).json()}]
        if columns and not fresh:
            parts[0]["folders"] = []  # no row, no folder
        old = self.state().get(key)
        if keep_other_partitions and old and columns and old["partitions"] == columns:
            for part in old["parts"]:
                there = part["folders"] if "folders" in part else self._list(part["path"], folders=True)
                if kept := [n for n in there if "=" in n and n not in fresh]:
                    parts.append({**part, "folders": kept})
        self._put({key: {"partitions": columns, "parts": parts}})
        return self.read(layer, table)

    def _read(self, entry: Entry) -> DataFrame:
        frames = []
        for part in entry["parts"]:
            schema = T.StructType.fromJson(json.loads(part["schema"]))
            reader = self.spark.read.schema(schema)
            if "folders" not in part:
                frames.append(reader.parquet(part["path"]))
            elif part["folders"]:
                frames.append(reader.option("basePath", part["path"]).parquet(
                    *(f"{part['path']}/{n}" for n in part["folders"])))
        return reduce(DataFrame.unionByName, frames) if frames else self.spark.createDataFrame([], schema)

    def read(self, layer: str, table: str) -> DataFrame:
        return self._read(self.state()[self._key(layer, table)])

    def _name(self, key: str, entry: Entry) -> None:
        if not self.names:
            return
        layer, table = key.split(".", 1)
        schema = self._read(entry).schema
        columns = ", ".join(f"`{f.name}`" for f in schema)
        selects = []
        for part in entry["parts"]:
            only = ""
            if not part.get("folders", ["all"]):
                continue
            if "folders" in part:  # folder names are column=value
                values = ", ".join("'" + n.split("=", 1)[1].replace("'", "\\'") + "'" for n in part["folders"])
                only = f" WHERE `{entry['partitions'][0]}` IN ({values})"
            selects.append(f"SELECT {columns} FROM parquet.`{part['path']}`{only}")
        if not selects:
            typed = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
            selects = [f"SELECT {typed} WHERE false"]
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {layer}.`{table}` AS {' UNION ALL '.join(selects)}")

    def copy(self, src_layer: str, dst_layer: str, tables: Iterable[str],
             rename: Callable[[str], str] = lambda t: t) -> dict[str, DataFrame]:
        """CREATE OR REPLACE dst.t AS SELECT * FROM src.t, for each table, with
        its partitioning: the new table names the data folders of the old one."""
        state, names = self.state(), {t: rename(t) for t in tables}
        self._put({self._key(dst_layer, new): state[self._key(src_layer, t)] for t, new in names.items()})
        return {new: self.read(dst_layer, new) for new in names.values()}

    def promote(self, tables: Iterable[str]) -> dict[str, DataFrame]:
        """Staging -> warehouse, dropping the 'stg_' prefix."""
        return self.copy("staging", "datawarehouse", tables,
                         lambda t: t[len(STAGING_PREFIX):] if t.startswith(STAGING_PREFIX) else t)

    def truncate(self, layer: str, table: str) -> None:
        """TRUNCATE TABLE IF EXISTS: keep the schema, drop every row and partition."""
        if self.exists(layer, table):
            self.write(layer, table, self.spark.createDataFrame([], self.read(layer, table).schema))

    def reset(self) -> list[str]:
        """Truncate every existing table of every layer; the tables now empty."""
        found = [(layer, t) for layer in LAYERS for t in self.tables(layer)]
        for layer, t in found:
            self.truncate(layer, t)
        return [f"{layer}.{t}" for layer, t in found if self.read(layer, t).isEmpty()]


#: Table of the raw layer with the rows that a load rejected.
REJECTS = "load_rejects"


def reject_rows(target: str, rejected: DataFrame) -> DataFrame:
    """Rejected rows of any load in one shape: target_table, source_table,
    reject_columns and all fields as text."""
    own = [c for c in rejected.columns if c not in ("source_table", "reject_columns")]
    pairs = [x for c in own for x in (F.lit(c), F.col(f"`{c}`"))]
    return rejected.select(F.lit(target).alias("target_table"), "source_table", "reject_columns",
                           F.create_map(*pairs).alias("fields"))


def with_row_number(df: DataFrame, order: list, col: str = "row_no") -> DataFrame:
    """Zero-based row number in ``order`` without a single-partition window:
    a range-partitioned sort, then per-partition offsets (see
    operators.surrogate)."""
    from staylens.operators.surrogate import with_surrogate_id
    numbered = with_surrogate_id(df.orderBy(*order), id_col="_rn1")
    return numbered.select((F.col("_rn1") - 1).alias(col), *df.columns)


def export_csv(df: DataFrame, path: str, order: list, leave_out: Iterable[str] = ()) -> None:
    """Mart -> CSV with a header, an unnamed leading row-number column and
    upper-case column names (the published file layout); columns that only
    give the order can be left out."""
    numbered = with_row_number(df, order)
    out = numbered.select(F.col("row_no").alias(""),
                          *[F.col(c).alias(c.upper()) for c in df.columns if c not in leave_out])
    with shuffles_freed(df.sparkSession):
        csv_writer(out).option("emptyValue", "").csv(path)


def read_export(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


# ---------------------------------------------------------------------------
# Registered write/read-back queries (scratch folder next to the checkpoints)
# ---------------------------------------------------------------------------
def _register():
    from staylens import registry
    from staylens.functions import month_of
    from staylens.operators import fanout
    from staylens.plans import marts, star
    from staylens.schemas import SNAPSHOT_SCHEMA
    from staylens.session import discard, new_scratch_dir
    from staylens.sources import csv_ingest

    def _month_table(snapshot: DataFrame) -> DataFrame:
        m = month_of("scraped_date")
        name = F.concat(F.lit("listing_"), F.substring(m, 6, 2), F.lit("_"), F.substring(m, 1, 4))
        return snapshot.withColumn(csv_ingest.TABLE_COL, name)

    def _roundtrip(c: registry.Ctx) -> tuple[DataFrame, DataFrame]:
        root = new_scratch_dir(c.spark, "csv")
        csv_ingest.write_csv_tables(_month_table(c.snapshot()), root, packed=True)
        return csv_ingest.load_snapshots(c.spark, root)

    @registry.register("src_csv_roundtrip")
    def _src_csv_roundtrip(c: registry.Ctx) -> DataFrame:
        """Snapshot rows written as one CSV folder per month table, then
        discovered, named and parsed back by the tolerant loader."""
        loaded, _ = _roundtrip(c)
        return loaded

    @registry.register("union_all_snapshots")
    def _union_all_snapshots(c: registry.Ctx) -> DataFrame:
        """All monthly files appended in one scan (UNION ALL of the month
        tables); rows and summed price per source table."""
        loaded, _ = _roundtrip(c)
        return (loaded.groupBy(csv_ingest.TABLE_COL)
                 .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("price").alias("sum_price")))

    @registry.register("src_csv_header_order")
    def _src_csv_header_order(c: registry.Ctx) -> DataFrame:
        """Month files with other column orders, letter cases and a further
        column, bound by header name."""
        root = new_scratch_dir(c.spark, "csv")
        rows = _month_table(c.snapshot()).withColumn("EXTRA", F.lit("not asked for"))
        names = c.snapshot().columns
        month = F.substring(csv_ingest.TABLE_COL, 9, 2).cast("int")
        for rest, order in ((0, names), (1, ["EXTRA", *(n.upper() for n in reversed(names))]),
                            (2, [*names[5:], *(n.title() for n in names[:5])])):
            csv_ingest.write_csv_tables(
                rows.where(month % 3 == rest).select(*[F.col(n).alias(n) for n in order], csv_ingest.TABLE_COL),
                f"{root}/{rest}", packed=True)
        tables = {}
        for rest in range(3):
            tables |= csv_ingest.snapshot_tables(c.spark, f"{root}/{rest}")
        return csv_ingest.parse_typed(csv_ingest.read_text_fields(
            c.spark, tables, SNAPSHOT_SCHEMA.fieldNames()), SNAPSHOT_SCHEMA)[0]

    def _planted(c: registry.Ctx) -> str:
        """Month files as raw lines with planted faults, by (scrape_id + reviews) % 10."""
        root = new_scratch_dir(c.spark, "csv")
        rows = _month_table(c.snapshot())
        names = c.snapshot().columns
        case = (F.col("scrape_id") + F.col("number_of_reviews")) % 10
        field = {n: F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names}
        field["price"] = F.when(case == 0, "abc").when(case == 5, F.concat(field["price"], F.lit(".0"))).otherwise(field["price"])
        field["host_name"] = (F.when(case == 1, "NULL").when(case == 6, "null")
                              .when(case == 4, F.concat(F.lit('"An ""x"", '), field["host_name"], F.lit('"')))
                              .when(case == 7, F.concat(F.lit('"An\nna, '), field["host_name"], F.lit('"')))
                              .otherwise(field["host_name"]))
        full = F.concat_ws(",", *[field[n] for n in names])
        short = F.concat_ws(",", *[field[n] for n in names[:-3]])
        line = F.when(case == 2, short).when(case == 3, F.concat(full, F.lit(",more,fields"))).otherwise(full)
        # lines as they are: no quoting, a separator that no line has; a record with a
        # line break is two lines, made in the task that writes it and kept together by the order
        records = by_folder(rows.select(F.monotonically_increasing_id().alias("row"), csv_ingest.TABLE_COL,
                                        F.split(line, "\n").alias("lines")), csv_ingest.TABLE_COL)
        lines = (records.select("row", csv_ingest.TABLE_COL, F.posexplode("lines").alias("nth", "line"))
                 .sortWithinPartitions(csv_ingest.TABLE_COL, "row", "nth"))
        with shuffles_freed(c.spark):
            (lines.select(F.col("line").alias(",".join(names)), csv_ingest.TABLE_COL).write.partitionBy(csv_ingest.TABLE_COL)
             .option("header", True).option("quote", "\u0000").option("sep", "\u0001").option("compression", "gzip").csv(root))
        return root

    @registry.register("src_load_reject_count")
    def _src_load_reject_count(c: registry.Ctx) -> DataFrame:
        """Tolerant load of files with planted faults: loaded and rejected rows,
        nulls and quoted names per source table; rejects are stored."""
        loaded, rejected = csv_ingest.load_snapshots(c.spark, _planted(c))
        wh = Warehouse(c.spark, new_scratch_dir(c.spark, "wh"))
        bad = wh.write("raw", REJECTS, reject_rows("listing_snapshots", rejected))
        a = loaded.groupBy(csv_ingest.TABLE_COL).agg(
            F.count(F.lit(1)).alias("n_loaded"), F.sum("price").alias("sum_price"),
            F.count("host_name").alias("n_named"), F.count_if(F.col("host_name").startswith('An "x", ')).alias("n_quoted"),
            F.count_if(F.col("host_name").startswith("An\nna, ")).alias("n_broken"),
            F.count("review_scores_value").alias("n_valued"))
        b = bad.where("reject_columns = 'price' and fields['price'] = 'abc'").groupBy("source_table").agg(
            F.count(F.lit(1)).alias("n_rejected"))
        return a.join(b, "source_table", "left").withColumn("n_rejected", F.coalesce("n_rejected", F.lit(0)))

    @registry.register("src_infer_widened")
    def _src_infer_widened(c: registry.Ctx) -> DataFrame:
        """Month files without a declared schema: columns typed by their values and
        widened, one read for all tables; types and sums per table."""
        root = new_scratch_dir(c.spark, "csv")
        odd = F.col("scrape_id") % 2 == 1
        csv_ingest.write_csv_tables(_month_table(c.snapshot()).select(
            F.col("listing_id").alias("Whole"), (F.col("price") / 4).alias("RATIO"),
            F.when(odd, F.lit("NULL")).otherwise(F.col("accommodates").cast("string")).alias("some_null"),
            odd.cast("string").alias("flag"), F.col("scraped_date").alias("day"),
            F.when(odd, "x1").otherwise("1").alias("mixed"), F.lit(None).cast("string").alias("nothing"),
            csv_ingest.TABLE_COL), root, packed=True)
        tables = csv_ingest.list_tables(c.spark, root)
        found = csv_ingest.infer_raw_schemas(c.spark, tables)  # a few type names per table
        types = c.spark.createDataFrame(
            [(name, *(f.dataType.simpleString() for f in s)) for name, s in sorted(found.items())],
            [csv_ingest.TABLE_COL, *(f"t_{n}" for n in next(iter(found.values())).names)])
        schema = T.StructType.fromDDL("whole bigint, ratio double, some_null bigint, flag boolean, day string, "
                                      "mixed string, nothing string")
        rows, bad = csv_ingest.parse_typed(csv_ingest.read_text_fields(c.spark, tables, schema.fieldNames()), schema)
        return rows.groupBy(csv_ingest.TABLE_COL).agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("whole").alias("sum_whole"), F.sum("ratio").alias("sum_ratio"),
            F.sum("some_null").alias("sum_some"), F.count_if("flag").alias("n_flag"), F.max("day").alias("last_day"),
            F.count_if(F.col("mixed") == "x1").alias("n_mixed"), F.count("nothing").alias("n_nothing")).join(
                types, csv_ingest.TABLE_COL)

    @registry.register("layer_named_tables")
    def _layer_named_tables(c: registry.Ctx) -> DataFrame:
        """Snapshot table reached by name in three layers (created, copied and kept
        under other months), rows per month table."""
        wh = Warehouse(c.spark, new_scratch_dir(c.spark, "wh"), names=True)
        rows = _month_table(c.snapshot()).select("listing_id", "price", csv_ingest.TABLE_COL)
        late = F.substring(csv_ingest.TABLE_COL, 12, 4) >= "1998"
        with wh.run():
            wh.write("raw", "gate_snapshots", rows.where(~late), [csv_ingest.TABLE_COL])
            wh.write("raw", "gate_snapshots", rows.where(late), [csv_ingest.TABLE_COL], keep_other_partitions=True)
            wh.copy("raw", "staging", ["gate_snapshots"], lambda t: f"stg_{t}")
            wh.promote(["stg_gate_snapshots"])
        named = [c.spark.table(t).select("listing_id", "price", csv_ingest.TABLE_COL).withColumn("layer", F.lit(t.split(".")[0]))
                 for t in ("raw.gate_snapshots", "staging.stg_gate_snapshots", "datawarehouse.gate_snapshots")]
        return (named[0].unionByName(named[1]).unionByName(named[2]).groupBy("layer", csv_ingest.TABLE_COL)
                .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("price").alias("sum_price")))

    @registry.register("layer_reset_reload")
    def _layer_reset_reload(c: registry.Ctx) -> DataFrame:
        """All months loaded, every layer reset, the even months loaded again:
        rows per month table of the staging copy."""
        from staylens.plans.pipeline import SNAPSHOT_TABLE, load_snapshots_to_raw
        rows, roots = _month_table(c.snapshot()), [new_scratch_dir(c.spark, "csv") for _ in range(2)]
        csv_ingest.write_csv_tables(rows, roots[0], packed=True)
        wh = Warehouse(c.spark, new_scratch_dir(c.spark, "wh"))
        load_snapshots_to_raw(c.spark, wh, roots[0])
        wh.copy("raw", "staging", [SNAPSHOT_TABLE])
        wh.reset()
        wh.vacuum(keep=1)  # the first load is in no table now, its files are not needed again
        discard(c.spark, roots[0])
        csv_ingest.write_csv_tables(
            rows.where(F.substring(csv_ingest.TABLE_COL, 9, 2).cast("int") % 2 == 0), roots[1], packed=True)
        load_snapshots_to_raw(c.spark, wh, roots[1])
        discard(c.spark, roots[1])
        wh.copy("raw", "staging", [SNAPSHOT_TABLE])
        return wh.read("staging", SNAPSHOT_TABLE).groupBy(csv_ingest.TABLE_COL).agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("price").alias("sum_price"))

    @registry.register("adhoc_host_same_vs_diff_month")
    def _adhoc_host_same_vs_diff_month(c: registry.Ctx) -> DataFrame:
        """Ad-hoc 3.c from one month of the partitioned staging copy."""
        from staylens.plans import adhoc
        wh = Warehouse(c.spark, new_scratch_dir(c.spark, "wh"))
        wh.write("raw", "listing_snapshots", _month_table(c.snapshot()), [csv_ingest.TABLE_COL])
        staged = wh.copy("raw", "staging", ["listing_snapshots"])["listing_snapshots"]
        return adhoc.host_same_vs_different(staged, source_table="listing_03_1995")

    @registry.register("mart_tables_roundtrip")
    def _mart_tables_roundtrip(c: registry.Ctx) -> DataFrame:
        """Marts 1 and 2 stored in their published shape and read back by name."""
        wh = Warehouse(c.spark, new_scratch_dir(c.spark, "wh"))
        made = marts.listing_marts(c.listing_d(), fanout.host_collapse(c.host_d()),
                                   [marts.NEIGHBOURHOOD_KEYS, marts.PROPERTY_KEYS])
        read = [wh.write("datamart", name, mart).withColumn("mart", F.lit(name))
                for name, mart in zip(("dm_listing_neighbourhood", "dm_property_type"), made)]
        return read[0].unionByName(read[1])

    @registry.register("export_listing_mart")
    def _export_listing_mart(c: registry.Ctx) -> DataFrame:
        """Mart 1 exported as CSV in its published shape and order, read back."""
        mart = marts.listing_neighbourhood_mart(c.listing_d(), c.host_d(), include_keys=True)
        path = new_scratch_dir(c.spark, "export") + "/dm_listing_neighbourhood"
        keys = ["listing_neighbourhood", "s_date"]
        export_csv(mart, path, keys, leave_out=keys)
        fields = [f for f in mart.schema.fields if f.name not in keys]
        return read_export(c.spark, path, T.StructType([T.StructField("row_no", T.LongType()), *fields]))

    @registry.register("layer_copy_raw_to_staging")
    def _layer_copy_raw_to_staging(c: registry.Ctx) -> DataFrame:
        """Raw snapshot table copied to staging (select *), read back."""
        wh = Warehouse(c.spark, new_scratch_dir(c.spark, "wh"))
        wh.write("raw", "listing_snapshots", _month_table(c.snapshot()),
                 [csv_ingest.TABLE_COL])
        return wh.copy("raw", "staging", ["listing_snapshots"])["listing_snapshots"]

    @registry.register("layer_promote_staging_to_dw")
    def _layer_promote_staging_to_dw(c: registry.Ctx) -> DataFrame:
        """Listing dimension built in staging and promoted to the warehouse
        (prefix dropped), read back without its opaque id."""
        wh = Warehouse(c.spark, new_scratch_dir(c.spark, "wh"))
        wh.write("staging", "stg_listing_d", star.listing_dim(c.snapshot(), with_id=True))
        promoted = wh.promote(["stg_listing_d"])["listing_d"]
        return promoted.drop("id")

    @registry.register("export_host_mart")
    def _export_host_mart(c: registry.Ctx) -> DataFrame:
        """Mart 3 exported as CSV with its row-number column, read back."""
        mart = marts.host_neighbourhood_mart(c.listing_d(), c.host_d())
        path = new_scratch_dir(c.spark, "export") + "/dm_host_neighbourhood"
        export_csv(mart, path, ["host_neighbourhood_lga", "s_date"])
        schema = T.StructType([
            T.StructField("row_no", T.LongType()),
            T.StructField("host_neighbourhood_lga", T.StringType()),
            T.StructField("s_date", T.StringType()),
            T.StructField("distinct_host_count", T.LongType()),
            T.StructField("average_estimated_revenue", T.DecimalType(38, 0)),
            T.StructField("average_revenue_p_host", T.DecimalType(38, 6))])
        return read_export(c.spark, path, schema)


_register()


def layer_oracle_sql(with_prefix) -> dict[str, str]:
    from staylens import oracle
    month_table = ("'listing_' || substr(left(scraped_date, 7), 6, 2) || '_' || "
                   "substr(left(scraped_date, 7), 1, 4)")
    q = {}
    q["src_csv_roundtrip"] = with_prefix() + f"\nSELECT *, {month_table} AS source_table FROM snapshot"
    q["union_all_snapshots"] = with_prefix() + f"""
SELECT {month_table} AS source_table, count(*) AS n_rows, CAST(sum(price) AS BIGINT) AS sum_price
FROM snapshot GROUP BY 1"""
    case = "(scrape_id + number_of_reviews) % 10"
    q["src_load_reject_count"] = with_prefix() + f"""
SELECT {month_table} AS source_table, count(*) FILTER ({case} <> 0) AS n_loaded,
       CAST(sum(price) FILTER ({case} <> 0) AS BIGINT) AS sum_price,
       count(host_name) FILTER ({case} NOT IN (0, 1, 6)) AS n_named,
       count(host_name) FILTER ({case} = 4) AS n_quoted,
       count(host_name) FILTER ({case} = 7) AS n_broken,
       count(review_scores_value) FILTER ({case} NOT IN (0, 2)) AS n_valued,
       count(*) FILTER ({case} = 0) AS n_rejected
FROM snapshot GROUP BY 1"""
    q["src_csv_header_order"] = q["src_csv_roundtrip"]
    q["layer_reset_reload"] = with_prefix() + f"""
SELECT {month_table} AS source_table, count(*) AS n_rows, CAST(sum(price) AS BIGINT) AS sum_price
FROM snapshot WHERE CAST(substr(scraped_date, 6, 2) AS INTEGER) % 2 = 0 GROUP BY 1"""
    odd = "scrape_id % 2 = 1"
    q["src_infer_widened"] = with_prefix() + f"""
SELECT {month_table} AS source_table, count(*) AS n_rows, CAST(sum(listing_id) AS BIGINT) AS sum_whole,
       sum(price / 4) AS sum_ratio, CAST(sum(accommodates) FILTER (NOT {odd}) AS BIGINT) AS sum_some,
       count(*) FILTER ({odd}) AS n_flag, max(scraped_date) AS last_day, count(*) FILTER ({odd}) AS n_mixed,
       0 AS n_nothing, 'bigint' AS t_whole, 'double' AS t_ratio, CASE WHEN count(*) FILTER (NOT {odd}) > 0 THEN 'bigint' ELSE 'string' END AS t_some_null,
       'boolean' AS t_flag, 'string' AS t_day, CASE WHEN count(*) FILTER ({odd}) > 0 THEN 'string' ELSE 'bigint' END AS t_mixed,
       'string' AS t_nothing
FROM snapshot GROUP BY 1"""
    q["layer_named_tables"] = with_prefix() + f"""
SELECT layer, {month_table} AS source_table, count(*) AS n_rows, CAST(sum(price) AS BIGINT) AS sum_price
FROM snapshot, (VALUES ('raw'), ('staging'), ('datawarehouse')) l(layer) GROUP BY 1, 2"""
    marts12 = {"dm_listing_neighbourhood": ["listing_neighbourhood"],
               "dm_property_type": ["property_type", "room_type", "accommodates"]}
    q["mart_tables_roundtrip"] = " UNION ALL ".join(
        f"SELECT *, '{n}' AS mart FROM ({oracle._mart_sql(k, include_keys=False)})" for n, k in marts12.items())
    q["export_listing_mart"] = oracle._mart_sql(["listing_neighbourhood"], include_keys=False, row_no=True)
    q["layer_copy_raw_to_staging"] = q["src_csv_roundtrip"]
    q["layer_promote_staging_to_dw"] = with_prefix() + "\nSELECT * FROM listing_d"
    mart3 = oracle._host_mart_sql()
    q["export_host_mart"] = (f"SELECT row_number() OVER (ORDER BY host_neighbourhood_lga, s_date) - 1"
                             f" AS row_no, * FROM (\n{mart3}\n) m")
    return q
