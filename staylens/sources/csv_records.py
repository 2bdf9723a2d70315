"""What a set of CSV files looks like, in one distributed read, and the records of
files with quoted line breaks.

``scan_files`` reads all files as lines, once, and gives each file's first line and
for every split whether it begins inside a quoted field: quotes are counted per
split (by the task that reads it, line by line as they come: nothing is sorted, so
that the first line stays the first), and a running sum of those counts over a
file's splits says on which side of a quote each split begins. A doubled quote
counts twice and so changes nothing.

``quoted_fields`` then reads the files that need it by the same splits. A task
goes through its lines with the parity that its split begins with: a line that
begins and ends outside quotes is a record, whose fields are stored in the place of
its text. Only the lines of records that were broken are kept as text and shuffled, to
be put together in file order; a record may run over any number of lines and splits.
Large files stay splittable.
"""
from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staylens.session import stored

SPLITS = "file string, block long, first string, odd long, quotes long"
LINES = "file string, block long, rec long, line long, whole boolean, value string"


def file_key(path: str, encoded: bool = False) -> str:
    """One spelling for a path of the file listing and of a row's metadata."""
    path = unquote(path) if encoded else path
    scheme, colon, rest = path.partition(":")
    return scheme + colon + "/" + rest.lstrip("/") if colon else path


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


@dataclass
class Scan:
    """``headers``: first line of every file that has one; ``broken``: files with a
    quoted line break; ``inside``: splits of those that begin inside quotes."""
    headers: dict[str, str]
    broken: set[str]
    inside: set[tuple[str, int]]

    def header(self, path: str) -> tuple[str, ...]:
        line = self.headers.get(file_key(path), "").lstrip("﻿")
        return tuple(next(csv.reader([line]), ()))

    def is_broken(self, path: str) -> bool:
        return file_key(path) in self.broken


def _splits(lines: DataFrame) -> DataFrame:
    """One row per split, from its lines in the order of the file: the first line, the
    lines with an odd number of quotes and all quotes. (An aggregate by split sorts the
    lines, and a sort that spills does not keep the order of equal keys.)"""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, now = ["file", "block", "first", "odd", "quotes"], None
        for batch in batches:
            if not batch.num_rows:
                continue
            value, file, block = (batch.column(c) for c in ("value", "file", "block"))
            quotes = pc.count_substring(value, '"').to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.union1d(*(pc.run_end_encode(c).run_ends.to_numpy() for c in (file, block)))
            begins, made = np.append(0, ends[:-1]), []
            for a, odd, n in zip(begins, np.add.reduceat(quotes & 1, begins), np.add.reduceat(quotes, begins)):
                key = file[int(a)].as_py(), block[int(a)].as_py()
                if now and now[:2] == key:
                    now = *now[:3], now[3] + int(odd), now[4] + int(n)
                    continue
                if now:
                    made.append(now)
                now = *key, value[int(a)].as_py(), int(odd), int(n)
            if made:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in made])
        if now:
            yield pa.RecordBatch.from_pylist([dict(zip(names, now))])

    return lines.mapInArrow(run, SPLITS)


def scan_files(spark: SparkSession, paths: Sequence[str]) -> Scan:
    """One read of all files. To the driver come one row per file and one per split
    that begins inside quotes (the driver's own file and split lists are longer)."""
    splits = stored(_splits(_lines(spark, paths)), "csv-splits")  # a split's lines are read by one task, in order
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = splits.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    headers = {file_key(r["file"], True): r["first"] for r in splits.where("block = 0").select("file", "first").collect()}
    broken = {file_key(r["file"], True) for r in splits.where("odd > 0").select("file").distinct().collect()}
    inside = {(file_key(r["file"], True), r["block"]) for r in begun.where("inside").select("file", "block").collect()
              } if broken else set()
    return Scan(headers, broken, inside)


def _annotated(lines: DataFrame, inside: set[tuple[str, int]]) -> DataFrame:
    """Every line with the number of its record in its split (0: begun in an earlier
    split) and of itself, and whether it is a record by itself."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, odd, recs, seen = None, 0, 0, 0
        for batch in batches:
            new = (batch["file"].ne(batch["file"].shift()) | batch["block"].ne(batch["block"].shift())).to_numpy()
            cuts = [0, *(np.flatnonzero(new[1:]) + 1), len(batch)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                key = batch["file"].iat[a], int(batch["block"].iat[a])
                if key != now:
                    now, recs, seen = key, 0, 0
                    odd = int((file_key(now[0], True), now[1]) in inside)
                part = batch.iloc[a:b]
                own = np.fromiter((v.count('"') & 1 for v in part["value"]), np.int64, b - a)
                after = (odd + np.cumsum(own)) & 1
                begins = np.append(odd, after[:-1]) == 0
                rec = recs + np.cumsum(begins)
                yield part.assign(rec=rec, line=seen + np.arange(b - a), whole=begins & (own == 0))[
                    ["file", "block", "rec", "line", "whole", "value"]]
                odd, recs, seen = int(after[-1]), int(rec[-1]), seen + b - a

    return lines.mapInPandas(run, LINES)


def quoted_fields(spark: SparkSession, paths: Sequence[str], scan: Scan, record: Column) -> DataFrame:
    """(r, file) of every record after the header, ``r`` being ``record`` of its text in
    column ``value``; a quoted line break is one line feed. Empty lines are no records.
    Both parts are stored: a filter on the fields would else parse a record once per
    field it reads."""
    first = (F.col("block") == 0) & (F.col("rec") == 1)  # the header
    text = F.col("whole") & ~first & (F.trim("value") != "")
    lines = stored(_annotated(_lines(spark, paths), scan.inside).where(text | ~F.col("whole")).select(
        "file", "block", "rec", "line", "whole", F.when(F.col("whole"), record).alias("r"),
        F.when(~F.col("whole"), F.col("value")).alias("value")), "csv-lines")
    whole = lines.where("whole").select("r", "file")
    broken = lines.where(~F.col("whole"))
    # a line of an earlier split's record belongs to the last record begun before it
    last = broken.groupBy("file", "block").agg(F.max("rec").alias("last"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    owner = F.last(F.when(F.col("last") > 0, F.struct(F.col("block"), F.col("last").alias("rec"))), ignorenulls=True)
    owners = last.select(F.col("file").alias("_file"), F.col("block").alias("_block"), owner.over(before).alias("owner"))
    placed = broken.join(owners, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block"))).withColumn(
        "of", F.when(F.col("rec") > 0, F.struct("block", "rec")).otherwise(F.col("owner")))
    together = (placed.groupBy("file", "of").agg(F.sort_array(F.collect_list(F.struct("block", "line", "value"))).alias("lines"))
                .where(~((F.col("of.block") == 0) & (F.col("of.rec") == 1)))
                .select(F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("value"), "file"))
    return whole.unionByName(stored(together.select(record.alias("r"), "file"), "csv-fields"))
