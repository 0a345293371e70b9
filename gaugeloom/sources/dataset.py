"""Year-partitioned datasets and report files."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


#: Order of the rows of a year, as far as a table has these columns, and the size of a row group.
CLUSTER = ("station_id", "time")
ROW_GROUP_BYTES = 16 << 20


def write_years(
    df: DataFrame, path: str, year: str = "year", cluster: Sequence[str] = CLUSTER, row_group_bytes: int = ROW_GROUP_BYTES
) -> None:
    """Replace the years that occur in ``df`` and leave all others as they are.

    Rows are first brought together by year into pieces of the advisory
    partition size, so there are few files per year, and a year of any size is
    split over many tasks. Each file is in order of ``cluster``, so the statistics of its row groups
    and pages let a reader of some stations or times skip the others.
    """
    order = [year, *[c for c in cluster if c in df.columns]]
    (
        df.hint("rebalance", year)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("parquet.block.size", row_group_bytes)
        .partitionBy(year)
        .parquet(path)
    )


def read_years(spark: SparkSession, path: str) -> DataFrame:
    """The dataset with its year column; an empty one is an error."""
    df = spark.read.parquet(path)
    if df.isEmpty():
        raise ValueError(f"no rows in {path}")
    return df


def write_report(report: DataFrame, path: str) -> None:
    """A report table (years x variables at most) as one JSON file.

    It is written beside ``path`` and takes its place when it is complete, so a run
    that fails leaves the report of the run before. If the swap itself fails, the old one is put back.
    """
    spark = report.sparkSession
    jvm, own = spark._jvm, uuid.uuid4().hex
    place = lambda suffix: jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}{suffix}")
    target, staged, before = place(""), place(f".staged-{own}"), place(f".before-{own}")
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        report.coalesce(1).write.option("ignoreNullFields", "false").json(staged.toString())
        had_one = store.exists(target)
        if had_one and not store.rename(target, before):
            raise OSError(f"cannot replace {path}")
        if not store.rename(staged, target):
            if had_one:
                store.rename(before, target)
            raise OSError(f"cannot write {path}")
        if had_one:
            store.delete(before, True)
    finally:
        store.delete(staged, True)
