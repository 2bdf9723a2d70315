"""Tolerant CSV ingestion of the monthly snapshot and reference files.

Rules of the modelled load (one file format for every file):
  * files are found in the source folder and one level below it;
  * a file's table name is its base name up to the first '.'
    (for Spark-written part files: the name of their folder);
  * ',' delimiter, one header line, '"' quotes honoured (a quoted field may hold
    line breaks), gzip read transparently;
  * columns are bound by header name, in any letter case and order; columns the
    schema does not name are left out, a missing one is an error (or null if the
    caller calls it optional). Only the LGA code file is read by position;
  * the tokens NULL and null and empty fields load as null;
  * short rows are padded with nulls and extra fields are ignored;
  * a number with decimals in a whole-number column is rounded half up;
  * a row with a value that does not parse as its column's type is rejected
    and the load continues (rejects are returned, not lost).

The first lines of all files come from one distributed read, which also finds the
files with quoted line breaks (``csv_records``). Files with the same header are
then read in one distributed scan. The fields are read as text, then each typed
column is a ``try_cast``; a row is rejected when some non-null text failed to
cast.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.session import by_folder, shuffles_freed
from staylens.sources.csv_records import Scan, quoted_fields, scan_files

NULL_TOKENS = ("NULL", "null")
TABLE_COL = "source_table"
REJECT_COL = "reject_columns"


def csv_globs(root: str) -> list[str]:
    """CSV files in ``root`` and one folder level down (plain or gzip)."""
    root = root.rstrip("/")
    return [f"{root}/*.csv", f"{root}/*/*.csv", f"{root}/*.csv.gz", f"{root}/*/*.csv.gz"]


def table_name_of(path: Column) -> Column:
    """Base name up to the first '.'; Spark part files take their folder's
    name (the value after '=' for a partition folder)."""
    # by cutting, not by patterns: those try every place of a long path, for each row
    base = F.substring_index(path, "/", -1)
    stem = F.substring_index(base, ".", 1)
    folder = F.when(path.contains("/"), F.substring_index(F.substring_index(path, "/", -2), "/", 1)).otherwise("")
    folder_value = F.substring_index(folder, "=", -1)
    return F.when(base.startswith("part-"), folder_value).otherwise(stem)


def list_tables(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Table name -> file paths under ``root`` (metadata only: the file
    listing, as the modelled job globs its data folder)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    tables: dict[str, list[str]] = {}
    for pattern in csv_globs(root):
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        for st in path.getFileSystem(conf).globStatus(path) or []:
            p = st.getPath().toString()
            base = p.rsplit("/", 1)[-1]
            if base.startswith("part-"):
                name = p.rsplit("/", 2)[-2].split("=")[-1]
            else:
                name = base.split(".", 1)[0]
            tables.setdefault(name, []).append(p)
    return tables


def _qualified(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Paths with their file system, as rows' metadata name them."""
    path, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    return [p if ":/" in p else path(p).getFileSystem(conf).makeQualified(path(p)).toString() for p in paths]


def _csv(spark: SparkSession):
    return (spark.read.option("header", True).option("mode", "PERMISSIVE")
            .option("quote", '"').option("escape", '"')
            .option("recursiveFileLookup", True))  # names come from paths, not partition discovery


def _cleaned(fields: DataFrame, picked: Sequence[Column], path: Column, columns: Sequence[str]) -> DataFrame:
    nulled = [F.when(c.isin(*NULL_TOKENS) | (c == ""), F.lit(None)).otherwise(c) for c in picked]
    return fields.select(*nulled, table_name_of(path).alias(TABLE_COL)).toDF(*columns, TABLE_COL)


def read_text_fields(spark: SparkSession, tables: dict[str, list[str]], columns: Sequence[str],
                     optional: Sequence[str] = (), by_position: bool = False,
                     scan: Scan | None = None) -> DataFrame:
    """The fields of ``tables`` (name -> files) as text, plus the table name.
    Columns are found by header name, or by position. ``scan`` may cover more
    files."""
    if not tables:
        raise FileNotFoundError("no CSV file to load")
    paths = _qualified(spark, [p for name in sorted(tables) for p in tables[name]])
    scan = scan or scan_files(spark, paths)
    groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for p in paths:
        if not by_position and not scan.header(p):
            continue  # an empty file
        header = tuple(columns) if by_position else scan.header(p)
        groups.setdefault((header, scan.is_broken(p)), []).append(p)
    parts = []
    for (header, broken), files in groups.items():
        place = {c.strip().lower(): k for k, c in reversed(list(enumerate(header)))}
        missing = [c for c in columns if c.lower() not in place and c not in optional]
        if missing:
            raise ValueError(f"{files[0]}: no column {', '.join(missing)} in its header")
        # columns by place, as a header may name one twice
        plain = len(place) == len(header) and all(c.strip() and "`" not in c for c in header)
        names = list(header) if plain else [f"c{k}" for k in range(len(header))]
        schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
        if broken:
            record = F.from_csv("value", schema.toDDL(), {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})
            fields = quoted_fields(spark, files, scan, record).select("r.*", F.col("file").alias("file of the record"))
            path = F.col("`file of the record`")
        else:
            fields = _csv(spark).schema(schema).csv(files)
            path = F.col("_metadata.file_path")
        picked = [F.col(f"`{names[place[c.lower()]]}`") if c.lower() in place else F.lit(None).cast("string")
                  for c in columns]
        parts.append(_cleaned(fields, picked, path, columns))
    if not parts:
        empty = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, TABLE_COL)])
        return spark.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, parts)


def parse_typed(text: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(loaded, rejected): typed rows, and the rows with a value that failed to
    parse (kept as text with the names of the failing columns)."""
    typed, failed = [], []
    for f in schema.fields:
        if isinstance(f.dataType, T.StringType):
            typed.append(F.col(f.name).alias(f.name))
            continue
        text_of = f"`{f.name}`"
        if isinstance(f.dataType, T.LongType):  # 100.0 is 100, 99.5 is 100
            text_of = f"round(try_cast({text_of} AS decimal(38,6)))"
        cast = F.expr(f"try_cast({text_of} AS {f.dataType.simpleString()})")
        typed.append(cast.alias(f.name))
        failed.append(F.when(F.col(f.name).isNotNull() & cast.isNull(), F.lit(f.name)))
    bad = F.concat_ws(",", *failed) if failed else F.lit("")
    marked = text.select("*", bad.alias(REJECT_COL))
    loaded = marked.filter(F.col(REJECT_COL) == "").select(*typed, TABLE_COL)
    rejected = marked.filter(F.col(REJECT_COL) != "")
    return loaded, rejected


def snapshot_tables(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """The monthly listing files under ``root``, by table name."""
    found = {n: p for n, p in list_tables(spark, root).items() if "listing" in n}
    if not found:
        raise FileNotFoundError(f"no listing file in {root}")
    return found


def load_snapshots(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Every monthly listing file under ``root`` (tables named like
    ``listing_MM_YYYY``), appended into one DataFrame (implicit UNION ALL)."""
    from staylens.schemas import SNAPSHOT_SCHEMA
    return parse_typed(read_text_fields(spark, snapshot_tables(spark, root), SNAPSHOT_SCHEMA.fieldNames()),
                       SNAPSHOT_SCHEMA)


def load_reference(spark: SparkSession, root: str, name: str) -> tuple[DataFrame, DataFrame]:
    """One named reference file (census_01, census_02, nsw_lga_code,
    nsw_lga_suburb), matched by table name case-insensitively."""
    from staylens.schemas import RAW_SCHEMAS
    schema = RAW_SCHEMAS[name]
    tables = {n: p for n, p in list_tables(spark, root).items() if n.lower() == name.lower()}
    if not tables:
        raise FileNotFoundError(f"no file {name} in {root}")
    return parse_typed(read_text_fields(spark, tables, schema.fieldNames(),
                                        by_position=name == "nsw_lga_code"), schema)


def infer_raw_schemas(spark: SparkSession, tables: dict[str, list[str]],
                      scan: Scan | None = None) -> dict[str, T.StructType]:
    """Schemas of files without a declared one, by table: the type that all values
    of a column parse as, widened the way the raw layer stores it (whole numbers ->
    bigint, other numbers -> double, true / false -> boolean, all else and columns
    without a value -> text; dates stay text in every layer). The rows are read
    once for all tables with the same header; declared schemas
    (schemas.RAW_SCHEMAS, SNAPSHOT_SCHEMA) skip it."""
    tables = {name: _qualified(spark, paths) for name, paths in tables.items()}
    scan = scan or scan_files(spark, [p for ps in tables.values() for p in ps])
    groups: dict[tuple[str, ...], dict[str, list[str]]] = {}
    for name, paths in tables.items():
        header = next((h for p in paths if (h := scan.header(p))), ())
        groups.setdefault(tuple(c.strip().lower() for c in header), {})[name] = paths
    out = {name: T.StructType([]) for name in tables}
    for header, group in groups.items():
        columns = list(dict.fromkeys(c for c in header if c))
        if not columns:
            continue
        text = read_text_fields(spark, group, columns, scan=scan)
        checks = []
        for k, c in enumerate(columns):
            value = F.col(f"`{c}`")
            checks += [F.count(value).alias(f"n{k}"), F.count(value.try_cast("bigint")).alias(f"whole{k}"),
                       F.count(value.try_cast("double")).alias(f"number{k}"),
                       F.count_if(F.lower(value).isin("true", "false")).alias(f"flag{k}"),
                       F.count_if(value.contains(".")).alias(f"point{k}")]
        for r in text.groupBy(TABLE_COL).agg(*checks).collect():  # a row per table
            fields = []
            for k, c in enumerate(columns):
                n, t = r[f"n{k}"], T.StringType()
                if n and r[f"flag{k}"] == n:
                    t = T.BooleanType()
                elif n and r[f"whole{k}"] == n and not r[f"point{k}"]:  # '1.5' casts to 1
                    t = T.LongType()
                elif n and r[f"number{k}"] == n:
                    t = T.DoubleType()
                fields.append(T.StructField(c, t, True))
            out[r[TABLE_COL]] = T.StructType(fields)
        for name in group:  # no row at all: text
            if not out[name].fields:
                out[name] = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    return out


def infer_raw_schema(spark: SparkSession, paths: Sequence[str]) -> T.StructType:
    """``infer_raw_schemas`` of one table's files."""
    names = {p.rsplit("/", 1)[-1].split(".", 1)[0] for p in paths}
    found = infer_raw_schemas(spark, {name: [p for p in paths if p.rsplit("/", 1)[-1].split(".", 1)[0] == name]
                                      for name in sorted(names)})
    return next(iter(found.values()))


def csv_writer(df: DataFrame):
    """Writer whose files the loader reads back unchanged: doubled quotes, blanks kept."""
    return (df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def write_csv_tables(df: DataFrame, root: str, table_col: str = TABLE_COL, packed: bool = False) -> None:
    """Write one folder of CSV part files per table name; ``table_name_of``
    reads the folder name back as the table name. ``packed`` files (gzip) take a
    fraction of the disk; each is read by one task, which is what one task wrote."""
    writer = csv_writer(by_folder(df, table_col)).partitionBy(table_col)
    with shuffles_freed(df.sparkSession):
        (writer.option("compression", "gzip") if packed else writer).csv(root)
