"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join side is broadcast only after its shuffled size has been measured.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Conditions on the year reach the reader of observation files.
    "spark.sql.python.filterPushdown.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and benches on one machine; on a cluster, pass ``SETTINGS`` to spark-submit."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("gaugeloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that all executors share.

    The folder is ``spark.checkpoint.dir`` of the session. Only a local master
    may go without it: then a temporary folder of this machine is used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="gaugeloom-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written once to the shared folder and read back.

    For small tables that several joins use: they are computed once, losing an
    executor does not lose them, and the planner sees their true size, so they
    are broadcast only below its threshold and joined by shuffling beyond it.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, most: int = 100_000) -> DataFrame:
    """Marked for broadcast if it has at most ``most`` rows; a larger table is left to the planner.

    For short tables whose size the planner cannot know, such as limits per variable.
    """
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
