"""Helpers shared by the operators: table access, shared scratch tables, sizing."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.session import new_scratch_dir, visible  # noqa: F401

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared scratch folder (inside
    ``spark.checkpoint.dir``) and read it back: cuts the lineage, so a lost
    executor costs a re-read and not a recomputation."""
    path = new_scratch_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(col):
    """Lower-case A-Z only, as the word contracts ask."""
    return F.translate(col, UPPER, UPPER.lower())


def crc_mod(col, n: int):
    """crc32 of an id as text, modulo n: the contracts' fold of a row."""
    return F.crc32(col.cast("string").cast("binary")) % F.lit(n)
