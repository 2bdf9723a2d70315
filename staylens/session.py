"""Session helpers.

Cluster deployments pass their own settings; ``get_session`` only fills in
what is unset so the same code runs on ``local[N]`` for tests and benches.
"""
from __future__ import annotations

import os
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.parquet.filterPushdown": "true",
    # Lists per key (ObjectHashAggregate): up to 4096 keys per task in hash mode
    # before falling back to sort-based aggregation (the default is 128).
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
}


def get_session(master: str | None = None, app: str = "staylens",
                shuffle_partitions: int | None = None,
                driver_memory: str | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Session with DEFAULTS for what is configured nowhere else; arguments win
    over the configuration."""
    wanted = dict(extra or {})
    if master:
        wanted["spark.master"] = master
    if shuffle_partitions:
        wanted.setdefault("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        wanted.setdefault("spark.driver.memory", driver_memory)
    active = SparkSession.getActiveSession()
    known = ({r["key"] for r in active.sql("SET").collect()} if active
             else {k for k, _ in SparkConf().getAll()})
    wanted |= {k: v for k, v in DEFAULTS.items() if k not in known and k not in wanted}
    spark = SparkSession.builder.appName(app).config(map=wanted).getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Where it is unset, a private
    scratch folder serves a ``local[...]`` master (tests); on anything else the
    other machines could not see it, so that is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="staylens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def visible(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (a
    cluster without that folder gets the package by --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (root, env.get("PYTHONPATH"))))


def scratch_root(spark: SparkSession) -> str:
    """A shared folder for intermediate tables: inside the session's
    checkpoint directory, which a cluster places on shared storage."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/staylens-scratch"


def new_scratch_dir(spark: SparkSession, tag: str) -> str:
    return f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex[:12]}"


#: A statement that took longer (seconds) may have left much in shuffle files.
LONG_WRITE = 2.0


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """A long write inside leaves no shuffle files on the executors' disks: Spark
    removes them when the driver collects the statement's plan as garbage, which may
    be never, while a query goes on to its next tables."""
    began = time.monotonic()
    yield
    if time.monotonic() - began > LONG_WRITE:
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)  # what the first lets go of holds the shuffles
        spark.sparkContext._jvm.System.gc()


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of which nothing is read any more."""
    if not path.startswith(scratch_root(spark) + "/"):
        raise ValueError(f"{path} is no scratch folder")
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(to, True)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to a scratch table on the shared storage and read back."""
    path = new_scratch_dir(df.sparkSession, tag)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_folder(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` for a write partitioned by ``columns``: rows of a folder come together
    in tasks of Spark's advisory size, so that files follow the amount of data, not
    tasks times folders, and a task sorts no more than that. Large folders get
    several tasks."""
    return df.hint("rebalance", *columns)
