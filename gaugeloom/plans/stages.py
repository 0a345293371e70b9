"""The stages of a full run, from raw files to a gap-filled dataset.

Every stage maps DataFrames to DataFrames; a full run writes each of them before
the next one starts, so nothing is computed twice and lost executors cost little.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.config import BOUNDS, FILL_EXEMPT, MAX_EXTRAP, MAX_GAP, MAX_MISSING_PCT
from gaugeloom.functions.scalar import Bounds, apply_filters, numeric_columns
from gaugeloom.operators.gapfill import fill_gaps
from gaugeloom.operators.grid import join_station, station_dedupe
from gaugeloom.operators.merge import existing_variables, first_non_null, prune_variables, union_folds
from gaugeloom.operators.profile import global_missing_pct, keep_list, profile_missing_wide
from gaugeloom.session import stored
from gaugeloom.sources.dataset import read_years, write_years

KEYS = ("year", "station_id", "time")
CONSTANTS = ("latitude", "longitude", "height")


def merge_stage(folds: Sequence[DataFrame], stations: DataFrame) -> DataFrame:
    """v1: all categories in one wide table with station constants.

    ``folds`` carry ``station_id, time, year, order_key`` and their variables.
    """
    union = union_folds(folds)
    values = [c for c in union.columns if c not in (*KEYS, "order_key", "fold", "file_name")]
    merged = first_non_null(union, values, KEYS)
    return join_station(merged, stored(station_dedupe(stations).drop("ordinal"), "stations"))


def clean_stage(observations: DataFrame, bounds: Bounds = BOUNDS, **switches: bool) -> DataFrame:
    """v2: infinite and implausible values become NULL; coordinates stay as they are."""
    limits = {v: b for v, b in bounds.items() if v not in ("latitude", "longitude")}
    return apply_filters(observations, limits, **switches)


def prune_stage(
    observations: DataFrame, threshold: float = MAX_MISSING_PCT, existing: DataFrame | None = None
) -> DataFrame:
    """v3: variables that are missing in more than ``threshold`` percent of all cells drop out.

    Years count for a variable if ``existing`` lists them, all years without it.
    """
    variables = numeric_columns(observations, (*KEYS, *CONSTANTS))
    keep = keep_list(global_missing_pct(profile_missing_wide(observations, variables, existing), threshold))
    return prune_variables(observations, keep, (*KEYS, *CONSTANTS))


def fill_stage(observations: DataFrame, max_gap: int = MAX_GAP, max_extrap: int = MAX_EXTRAP) -> DataFrame:
    """v4: dense grid with short gaps filled; row descriptions are kept but not filled."""
    variables = numeric_columns(observations, (*KEYS, *FILL_EXEMPT))
    constants = [c for c in CONSTANTS if c in observations.columns]
    carried = [c for c in observations.columns if c not in (*KEYS, *constants, *variables)]
    filled = fill_gaps(observations, variables, max_gap=max_gap, max_extrap=max_extrap, carried=carried)
    if not constants:
        return filled
    sites = observations.groupBy("station_id").agg(*[F.max(c).alias(c) for c in constants])
    return join_station(filled, stored(sites, "stations"))


def full_run(
    folds: Sequence[DataFrame],
    stations: DataFrame,
    root: str,
    bounds: Bounds = BOUNDS,
    threshold: float = MAX_MISSING_PCT,
    max_gap: int = MAX_GAP,
    max_extrap: int = MAX_EXTRAP,
) -> dict[str, DataFrame]:
    """All stages chained; each is written below ``root`` by year and read back by the next."""
    spark = stations.sparkSession

    def kept(stage: DataFrame, name: str) -> DataFrame:
        write_years(stage, f"{root}/{name}")
        return read_years(spark, f"{root}/{name}")

    v1 = kept(merge_stage(folds, stations), "v1")
    v2 = kept(clean_stage(v1, bounds), "v2")
    existing = stored(existing_variables(folds), "existing")
    v3 = kept(prune_stage(v2, threshold, existing), "v3")
    v4 = kept(fill_stage(v3, max_gap, max_extrap), "v4")
    return {"v1": v1, "v2": v2, "v3": v3, "v4": v4}
