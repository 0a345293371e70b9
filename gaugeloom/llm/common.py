"""Helpers the operators share: stored tables, text and row keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloom.session import shared_dir


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session, the measure of the cluster's width."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written once to the shared folder and read back, whatever its size.

    Lineage ends here, and an executor lost later costs no recomputation.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
