"""Argmax per key with ties kept (rank() = 1), one shuffle on the key."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def argmax_with_ties(df: DataFrame, key: str, value: str, score: str) -> DataFrame:
    """Rows (key, value, score) whose score is the maximum for the key; every
    tied value is kept. Null keys never match downstream equi-joins and are
    dropped here."""
    w = Window.partitionBy(key).orderBy(F.col(score).desc())
    return (df.filter(F.col(key).isNotNull())
              .withColumn("_rk", F.rank().over(w))
              .filter(F.col("_rk") == 1)
              .drop("_rk"))
