"""Merging measurement categories into one table and pruning its variables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_folds(folds: Sequence[DataFrame]) -> DataFrame:
    """Rows of all categories by column name; columns a category lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), folds)


def existing_variables(folds: Sequence[DataFrame], ids: Sequence[str] = ("station_id", "time")) -> DataFrame:
    """Years in which a variable exists: those with rows of a category that has the column.

    One row per year and variable, whether or not any of its values is valid.
    """
    skip = {"year", "order_key", "fold", "file_name", *ids}
    years = [
        f.select("year")
        .distinct()
        .select("year", F.explode(F.array(*[F.lit(c) for c in f.columns if c not in skip])).alias("variable"))
        for f in folds
    ]
    return union_folds(years).distinct()


def first_non_null(
    df: DataFrame,
    value_cols: Sequence[str],
    keys: Sequence[str] = ("station_id", "time"),
    order: str = "order_key",
) -> DataFrame:
    """One row per key with the first non-missing value of every column by ``order``.

    The minimum by order key combines on the map side, so copies of a row
    collapse before the shuffle.
    """
    return df.groupBy(*keys).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in value_cols]
    )


def to_long(df: DataFrame, variables: Sequence[str], ids: Sequence[str] = ("year", "station_id", "time")) -> DataFrame:
    """One row per cell and variable.

    A generator rather than ``unpivot``: filters move below it in every copy of
    the plan, so several uses of a long table can share one shuffle.
    """
    pairs = [c for v in variables for c in (F.lit(v), F.col(v).cast("double"))]
    return df.select(*ids, F.stack(F.lit(len(variables)), *pairs).alias("variable", "value"))


def prune_variables(
    df: DataFrame, keep: Sequence[str], always: Sequence[str] = ("year", "station_id", "time")
) -> DataFrame:
    """The kept variables that exist, next to the key columns."""
    wanted = set(keep) | set(always)
    return df.select(*[c for c in df.columns if c in wanted])
