"""Checks of all variables from one shuffle of the observations.

The cells of a series are gathered by stretches of time. Each stretch gives a
summary: counts, extremes, its first and last valid value, and the changes
between its consecutive valid values. Summaries merge in the order of time, the
change across a border coming from the last value before and the first one after it. So no
window runs over rows, and a series of any length is spread over many tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloom.config import DAY_SECONDS, STEP_SECONDS
from gaugeloom.functions.times import calendar_steps, chunk_of, seconds_between
from gaugeloom.session import small

STRETCH_SECONDS = 32 * DAY_SECONDS
SERIES = ("year", "variable", "station_id")


def stretches(obs: DataFrame, seconds: int = STRETCH_SECONDS) -> DataFrame:
    """``SERIES, chunk, cells``: the (time, value) pairs of a stretch of one series, in no order.

    Rows without a key or a time are left out here, so that later joins add no
    filters of their own and all uses share one shuffle.
    """
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in (*SERIES, "time")])
    return obs.filter(known).groupBy(*SERIES, chunk_of(F.col("time"), seconds).alias("chunk")).agg(
        F.collect_list(F.struct("time", "value")).alias("cells")
    )


def _steps(later: Column, earlier: Column, max_lag: int | None) -> Column:
    """Sizes of the changes between paired (time, value) entries; those that are no number or too far apart are left out."""

    def size(b: Column, a: Column) -> Column:
        change = F.nanvl(F.abs(b.value - a.value), F.lit(None).cast("double"))
        return change if max_lag is None else F.when(seconds_between(a.time, b.time) <= max_lag, change)

    return F.filter(F.zip_with(later, earlier, size), lambda x: x.isNotNull())


def _tail_of(array: Column) -> Column:
    return F.slice(array, F.lit(2), F.greatest(F.size(array) - 1, F.lit(0)))


def _head_of(array: Column) -> Column:
    return F.slice(array, F.lit(1), F.greatest(F.size(array) - 1, F.lit(0)))


def _beyond(sizes: Column) -> Column:
    return F.size(F.filter(sizes, lambda x: x > F.col("threshold")))


def summaries(parts: DataFrame, bounds: DataFrame, limits: DataFrame, max_lag: int | None = None) -> DataFrame:
    """One summary per stretch; ``head`` and ``tail`` are NULL without a valid value."""
    valid = F.filter("cells", lambda x: x.value.isNotNull())
    values = F.transform("valid", lambda x: x.value)
    return (
        parts.join(small(bounds.select("variable", "lo", "hi")), "variable", "left")
        .join(small(limits.select("variable", "threshold")), "variable", "left")
        .select(*SERIES, "chunk", "lo", "hi", "threshold", F.size("cells").alias("n_cells"), F.array_sort(valid).alias("valid"))
        .select("*", values.alias("values"), _steps(_tail_of(F.col("valid")), _head_of(F.col("valid")), max_lag).alias("steps"))
        .select(
            *SERIES,
            "chunk",
            "lo",
            "threshold",
            F.size("values").alias("n_valid"),
            F.size(F.filter("values", lambda v: F.abs(v) == float("inf"))).alias("inf_count"),
            F.size(F.filter("values", lambda v: v < F.col("lo"))).alias("below_min"),
            F.size(F.filter("values", lambda v: v > F.col("hi"))).alias("above_max"),
            F.array_min("values").alias("actual_min"),
            F.array_max("values").alias("actual_max"),
            F.size("steps").alias("n_steps"),
            _beyond(F.col("steps")).alias("large_jumps"),
            F.array_max("steps").alias("max_diff"),
            F.get("valid", F.lit(0)).alias("head"),
            F.get("valid", F.size("valid") - 1).alias("tail"),
        )
    )


SUMS = ("n_valid", "inf_count", "below_min", "above_max", "n_steps", "large_jumps")


def merged_series(found: DataFrame, max_lag: int | None = None) -> DataFrame:
    """Summaries of whole series: stretches put in order and joined at their borders."""
    ends = F.array_sort(F.collect_list(F.when(F.col("head").isNotNull(), F.struct("chunk", "head", "tail"))))
    border = _steps(
        F.transform(_tail_of(F.col("ends")), lambda e: e.head), F.transform(_head_of(F.col("ends")), lambda e: e.tail), max_lag
    )
    return (
        found.groupBy(*SERIES, "lo", "threshold")
        .agg(
            *[F.sum(c).alias(c) for c in SUMS],
            F.min("actual_min").alias("actual_min"),
            F.max("actual_max").alias("actual_max"),
            F.max("max_diff").alias("max_diff"),
            ends.alias("ends"),
        )
        .withColumn("border", border)
        .withColumns(
            {
                "n_steps": F.col("n_steps") + F.size("border"),
                "large_jumps": F.col("large_jumps") + _beyond(F.col("border")),
                "max_diff": F.greatest("max_diff", F.array_max("border")),
            }
        )
        .drop("ends", "border")
    )


def merged_variables(series: DataFrame) -> DataFrame:
    """The summaries of all stations together, per year and variable."""
    return series.groupBy("year", "variable").agg(
        F.max(F.col("lo").isNotNull()).alias("range_defined"),
        F.max("threshold").alias("threshold"),
        *[F.sum(c).alias(c) for c in SUMS],
        F.min("actual_min").alias("actual_min"),
        F.max("actual_max").alias("actual_max"),
        F.max("max_diff").alias("max_diff"),
    )


def axes_of(parts: DataFrame, calendar: bool = False, step_seconds: int = STEP_SECONDS) -> DataFrame:
    """Stations and times of every year, out of the same stretches."""
    # The cells are looked at, though a stretch always has some: otherwise they would be gathered a second time without them.
    stations = parts.groupBy("year", "station_id").agg(F.max(F.size("cells")).alias("_n"))
    counted = stations.groupBy("year").agg(F.count_if(F.col("_n") > 0).alias("n_stations"))
    if calendar:
        return counted.withColumn("n_times", calendar_steps(F.col("year"), step_seconds))
    times = parts.select("year", F.explode(F.transform("cells", lambda x: x.time)).alias("time")).distinct()
    return counted.join(times.groupBy("year").agg(F.count("time").alias("n_times")), "year")


def variable_checks(
    obs: DataFrame,
    bounds: DataFrame,
    limits: DataFrame,
    calendar: bool = False,
    step_seconds: int = STEP_SECONDS,
    max_lag: int | None = None,
    seconds: int = STRETCH_SECONDS,
) -> DataFrame:
    """Completeness, range and jump figures of every year and variable.

    ``total_values`` counts the cells of the dense cube, absent ones are missing.
    ``max_lag`` leaves out changes between values more than that many seconds apart.
    """
    parts = stretches(obs, seconds)
    found = merged_variables(merged_series(summaries(parts, bounds, limits, max_lag), max_lag))
    return (
        found.join(axes_of(parts, calendar, step_seconds), "year")
        .withColumn("total_values", F.col("n_stations") * F.col("n_times"))
        .withColumn("missing_count", F.col("total_values") - F.col("n_valid"))
    )
