"""The full refresh job: reset -> load raw -> copy to staging -> small
dimensions -> listing/host dimensions -> fact -> promote -> marts -> export.

State passes between stages only through the layer tables, so each stage
can be re-run alone, and a failed executor costs a task retry, never a
restart of the job. The tables of a refresh are published together, last.
"""
from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.operators.fanout import host_collapse
from staylens.plans import marts, star
from staylens.plans.layers import REJECTS, Warehouse, export_csv, reject_rows
from staylens.sources import csv_ingest
from staylens.session import ensure_checkpoint_dir, stored

SNAPSHOT_TABLE = "listing_snapshots"
REFERENCE_TABLES = ("census_01", "census_02", "nsw_lga_code", "nsw_lga_suburb")
STAGE_TABLES = ("stg_listing_d", "stg_hosting_d", "stg_census_d", "stg_suburb_d",
                "stg_lga_code_d", "stg_rental_f")
MART_ORDER = {
    "dm_listing_neighbourhood": ["listing_neighbourhood", "s_date"],
    "dm_property_type": ["property_type", "room_type", "accommodates", "s_date"],
    "dm_host_neighbourhood": ["host_neighbourhood_lga", "s_date"],
}


#: Keys of marts 1 and 2, which the published files do not show.
HIDDEN_KEYS = {n: MART_ORDER[n] for n in ("dm_listing_neighbourhood", "dm_property_type")}


@dataclass
class PipelineResult:
    warehouse: Warehouse
    rejected: DataFrame
    marts: dict[str, DataFrame] = field(default_factory=dict)
    exports: dict[str, str] = field(default_factory=dict)


def load_snapshots_to_raw(spark: SparkSession, wh: Warehouse, source_root: str,
                          keep_other_months: bool = False) -> DataFrame:
    """The monthly listing files into one raw table, a partition per file;
    returns the rejected rows."""
    rows, bad = csv_ingest.load_snapshots(spark, source_root)
    wh.write("raw", SNAPSHOT_TABLE, rows, [csv_ingest.TABLE_COL], keep_other_partitions=keep_other_months)
    return bad


def check_source(spark: SparkSession, source_root: str) -> dict[str, list[str]]:
    """The CSV files of a source by table name; an error if one that the job needs
    is missing."""
    found = csv_ingest.list_tables(spark, source_root)
    csv_ingest.snapshot_tables(spark, source_root)
    there = {n.lower() for n in found}
    if missing := [n for n in REFERENCE_TABLES if n not in there]:
        raise FileNotFoundError(f"no file {', '.join(missing)} in {source_root}")
    return found


def load_raw(spark: SparkSession, wh: Warehouse, source_root: str,
             keep_other_months: bool = False) -> DataFrame:
    """Stage 2: every CSV into the raw layer, rejected rows into one table of
    it, which is returned."""
    found = check_source(spark, source_root)
    rejected = {SNAPSHOT_TABLE: load_snapshots_to_raw(spark, wh, source_root, keep_other_months)}
    for name in REFERENCE_TABLES:
        ok, rejected[name] = csv_ingest.load_reference(spark, source_root, name)
        wh.write("raw", name, ok.drop(csv_ingest.TABLE_COL))
    # any other CSV file is loaded too, with an inferred (widened) schema
    others = {name: paths for name, paths in sorted(found.items())
              if "listing" not in name and name.lower() not in REFERENCE_TABLES}
    if others:
        scan = csv_ingest.scan_files(spark, [p for paths in others.values() for p in paths])
        for name, schema in csv_ingest.infer_raw_schemas(spark, others, scan).items():
            if not schema.fields:
                continue  # an empty file
            ok, rejected[name] = csv_ingest.parse_typed(csv_ingest.read_text_fields(
                spark, {name: others[name]}, schema.fieldNames(), scan=scan), schema)
            wh.write("raw", name, ok.drop(csv_ingest.TABLE_COL))
    return wh.write("raw", REJECTS, reduce(DataFrame.unionByName, (
        reject_rows(name, bad) for name, bad in rejected.items())))


def build_star(wh: Warehouse) -> None:
    """Stages 4-6: dimensions with surrogate ids, then the fact."""
    snaps = wh.read("staging", SNAPSHOT_TABLE)
    wh.write("staging", "stg_suburb_d", star.suburb_dim(wh.read("staging", "nsw_lga_suburb"), True))
    wh.write("staging", "stg_lga_code_d", star.lga_dim(wh.read("staging", "nsw_lga_code"), True))
    wh.write("staging", "stg_census_d", star.census_dim(
        wh.read("staging", "census_01"), wh.read("staging", "census_02"), True))
    wh.write("staging", "stg_listing_d", star.listing_dim(snaps, True))
    wh.write("staging", "stg_hosting_d", star.host_dim(snaps, True))
    fact = star.fact_rental(wh.read("staging", "stg_listing_d"), wh.read("staging", "stg_hosting_d"),
                            wh.read("staging", "stg_lga_code_d"), wh.read("staging", "stg_census_d"),
                            wh.read("staging", "stg_suburb_d"))
    wh.write("staging", "stg_rental_f", fact)


def build_marts(wh: Warehouse, include_keys: bool = False) -> dict[str, DataFrame]:
    """Stage 8: the three marts from the warehouse dimensions, in their published
    shape (marts 1 and 2 without group keys) or with the keys. Returned are the
    marts with keys, which an export needs for its order."""
    ld, hd = wh.read("datawarehouse", "listing_d"), wh.read("datawarehouse", "hosting_d")
    hosts = host_collapse(hd)  # read by all three marts
    neighbourhood, property_type = marts.listing_marts(
        ld, hosts, [marts.NEIGHBOURHOOD_KEYS, marts.PROPERTY_KEYS], include_keys=True)
    keyed = {
        "dm_listing_neighbourhood": stored(neighbourhood, "mart"),
        "dm_property_type": stored(property_type, "mart"),
        "dm_host_neighbourhood": stored(marts.host_neighbourhood_mart(ld, hd, hosts=hosts), "mart"),
    }
    for name, df in keyed.items():
        wh.write("datamart", name, df.drop(*([] if include_keys else HIDDEN_KEYS.get(name, ()))))
    return keyed


def run_pipeline(spark: SparkSession, source_root: str, warehouse_root: str,
                 export_root: str | None = None, reset: bool = True, include_keys: bool = False,
                 names: bool = True) -> PipelineResult:
    """Nothing is reset before the source has been found complete, and all tables
    change together after the marts: a run that fails on the way leaves every table
    as it was. With ``names`` the layers' tables can be queried as raw.x, staging.x,
    datawarehouse.x and datamart.x; ``reset=False`` keeps months that the source no
    longer has."""
    ensure_checkpoint_dir(spark)
    check_source(spark, source_root)
    wh = Warehouse(spark, warehouse_root, names)
    with wh.run():
        if reset:
            wh.reset()                                                    # 1
        rejected = load_raw(spark, wh, source_root, not reset)            # 2
        wh.copy("raw", "staging", [t for t in wh.tables("raw") if t != REJECTS])   # 3
        build_star(wh)                                                    # 4-6
        wh.promote(STAGE_TABLES)                                          # 7
        keyed = build_marts(wh, include_keys)                             # 8
    exports = {}
    if export_root:                                                   # 9
        for name, df in keyed.items():
            path = f"{export_root.rstrip('/')}/{name}"
            export_csv(df, path, [F.col(c).asc_nulls_last() for c in MART_ORDER[name]],
                       () if include_keys else HIDDEN_KEYS.get(name, ()))
            exports[name] = path
    return PipelineResult(wh, rejected, {n: wh.read("datamart", n) for n in keyed}, exports)
