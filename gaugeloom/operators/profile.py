"""Completeness, range and jump profiles of long observations.

Input is ``year, station_id, time, variable, value`` with one row per present
cell. Absent cells count as missing: the size of the dense cube is taken from
the number of distinct stations and times of a year, the cube is never built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeloom.config import CHECK_EXEMPT, DAY_SECONDS, ENOUGH_ROWS_RATIO, MAX_MISSING_PCT, STEP_SECONDS
from gaugeloom.functions.scalar import band, cleaned_long
from gaugeloom.functions.times import calendar_steps
from gaugeloom.operators.segments import merged_series, merged_variables, stretches, summaries, variable_checks
from gaugeloom.session import small



def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100.0).otherwise(0.0)


def cube_axes(obs: DataFrame, calendar: bool = False, step_seconds: int = STEP_SECONDS) -> DataFrame:
    """Stations and times of every year, over all variables; with ``calendar`` a year has all its steps."""
    stations = F.count_distinct("station_id").alias("n_stations")
    if calendar:
        return obs.groupBy("year").agg(stations).withColumn("n_times", calendar_steps(F.col("year"), step_seconds))
    return obs.groupBy("year").agg(stations, F.count_distinct("time").alias("n_times"))


def profile_missing(obs: DataFrame, calendar: bool = False, step_seconds: int = STEP_SECONDS) -> DataFrame:
    """Missing and infinite cells per year and variable, over the dense cube.

    The cube holds the steps that any station reports, or with ``calendar`` every step of the year.
    """
    present = obs.groupBy("year", "variable").agg(
        F.count("value").alias("present"),
        F.count_if(F.abs("value") == float("inf")).alias("inf_count"),
    )
    return _missing_profile(present, cube_axes(obs, calendar, step_seconds))


def profile_missing_wide(
    obs: DataFrame,
    variables: Sequence[str],
    existing: DataFrame | None = None,
    calendar: bool = False,
    step_seconds: int = STEP_SECONDS,
) -> DataFrame:
    """The same for a table with one column per variable, without a row per variable and cell.

    ``existing`` limits the profile to the ``(year, variable)`` pairs it lists,
    because a column of a wide table is there in all years.
    """
    counts = obs.groupBy("year").agg(
        *[F.count(c).alias(f"n|{c}") for c in variables],
        *[F.count_if(F.abs(c) == float("inf")).alias(f"inf|{c}") for c in variables],
    )
    per_variable = F.array(
        *[
            F.struct(
                F.lit(c).alias("variable"), F.col(f"n|{c}").alias("present"), F.col(f"inf|{c}").alias("inf_count")
            )
            for c in variables
        ]
    )
    present = counts.select("year", F.inline(per_variable))
    if existing is not None:
        present = present.join(existing, ["year", "variable"], "left_semi")
    return _missing_profile(present, cube_axes(obs, calendar, step_seconds))


def _missing_profile(present: DataFrame, axes: DataFrame) -> DataFrame:
    return (
        present.join(axes, "year")
        .withColumn("total_values", F.col("n_stations") * F.col("n_times"))
        .withColumn("missing_count", F.col("total_values") - F.col("present"))
        .select(
            "year",
            "variable",
            "total_values",
            "missing_count",
            percent(F.col("missing_count"), F.col("total_values")).alias("missing_pct"),
            "inf_count",
            percent(F.col("inf_count"), F.col("total_values")).alias("inf_pct"),
            ((F.col("missing_count") > 0) | (F.col("inf_count") > 0)).alias("has_issues"),
        )
    )


def profile_range(obs: DataFrame, bounds: DataFrame) -> DataFrame:
    """Valid values below, above and within the bounds per year and variable."""
    return (
        obs.join(small(bounds), "variable", "left")
        .groupBy("year", "variable")
        .agg(
            F.max(F.col("lo").isNotNull()).alias("range_defined"),
            F.count("value").alias("n_valid"),
            F.count_if(F.col("value") < F.col("lo")).alias("below_min"),
            F.count_if(F.col("value") > F.col("hi")).alias("above_max"),
            F.min("value").alias("actual_min"),
            F.max("value").alias("actual_max"),
        )
        .withColumn("all_missing", F.col("n_valid") == 0)
        .withColumn("in_range", F.col("n_valid") - F.col("below_min") - F.col("above_max"))
        .withColumn("in_range_pct", percent(F.col("in_range"), F.col("n_valid")))
        .withColumn("has_issues", (F.col("below_min") > 0) | (F.col("above_max") > 0))
    )


def temporal_jumps(obs: DataFrame, limits: DataFrame, max_lag: int | None = None) -> DataFrame:
    """Changes between consecutive valid values of a station beyond the variable's limit.

    With ``max_lag`` only values at most that many seconds apart are compared.
    A variable without two such values at any station has no row.
    """
    unbounded = limits.select("variable", F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"))
    limited = obs.filter(F.col("value").isNotNull()).join(limits.select("variable"), "variable", "left_semi")
    series = merged_series(summaries(stretches(limited), unbounded, limits, max_lag), max_lag)
    return (
        merged_variables(series)
        .filter("n_steps > 0")
        .select("year", "variable", "threshold", "n_steps", "large_jumps", "max_diff", (F.col("large_jumps") > 0).alias("has_issues"))
    )


def _with_status(checks: DataFrame, variance: DataFrame | None = None) -> DataFrame:
    """Issue flags and status next to the figures of :func:`variable_checks`."""
    measured = ~F.col("variable").isin(*CHECK_EXEMPT)
    flags = {
        "missing_issue": (F.col("missing_count") > 0) | (F.col("inf_count") > 0),
        "range_issue": (F.col("below_min") > 0) | (F.col("above_max") > 0),
        "jump_issue": (F.col("large_jumps") > 0) & measured,
    }
    if variance is not None:
        checks = checks.join(variance.select("year", "variable", F.col("has_issues").alias("_uneven")), ["year", "variable"], "left")
        flags["variance_issue"] = F.coalesce("_uneven", F.lit(False)) & measured
    flagged = checks.withColumns(flags).drop("_uneven")
    any_issue = F.greatest(*[F.col(f).cast("int") for f in flags]) == 1
    return flagged.withColumn("status", F.when(any_issue, "WARNING").otherwise("OK"))


def variable_status(
    obs: DataFrame, bounds: DataFrame, limits: DataFrame, variance: DataFrame | None = None
) -> DataFrame:
    """WARNING if a check of the variable has issues in that year, otherwise OK.

    Row descriptions such as quality flags only take part in the first two
    checks. ``variance`` is the table of :func:`gaugeloom.operators.inference.levene`.
    """
    flags = ["missing_issue", "range_issue", "jump_issue"] + (["variance_issue"] if variance is not None else [])
    return _with_status(variable_checks(obs, bounds, limits), variance).select("year", "variable", *flags, "status")


def check_report(
    obs: DataFrame,
    bounds: DataFrame,
    limits: DataFrame,
    variance: DataFrame | None = None,
    distribution: DataFrame | None = None,
) -> DataFrame:
    """All checks of every year and variable, and the totals of every year (``variable`` is NULL, level 1).

    ``variance`` and ``distribution`` are the tables of :func:`gaugeloom.operators.inference.levene`
    and :func:`gaugeloom.operators.inference.ks_normality`; with them, uneven variances count as
    an issue, and their p-values are reported. A total has sums of counts, the largest jump, how
    many variables there are and how many have a warning; its status is WARNING if any has one.
    """
    checked = _with_status(variable_checks(obs, bounds, limits), variance)
    tests = {}
    for table, p_value in ((variance, "levene_p"), (distribution, "ks_p")):
        if table is not None:
            checked = checked.join(table.select("year", "variable", p_value), ["year", "variable"], "left")
            tests[p_value] = F.when(F.grouping("variable") == 0, F.max(p_value))
    sums = ("total_values", "missing_count", "inf_count", "n_valid", "below_min", "above_max", "n_steps", "large_jumps")
    one = F.grouping("variable") == 0
    extremes = {c: F.when(one, how(c)) for c, how in (("actual_min", F.min), ("actual_max", F.max), ("threshold", F.max))}
    return (
        checked.groupingSets([["year", "variable"], ["year"]], "year", "variable")
        .agg(
            F.grouping("variable").cast("int").alias("level"),
            F.max("n_stations").alias("n_stations"),
            F.max("n_times").alias("n_times"),
            F.count(F.lit(1)).alias("n_variables"),
            F.count_if(F.col("status") == "WARNING").alias("n_warnings"),
            *[F.sum(c).alias(c) for c in sums],
            *[e.alias(c) for c, e in extremes.items()],
            F.max("max_diff").alias("max_diff"),
            F.max("missing_issue").alias("missing_issue"),
            F.max("range_issue").alias("range_issue"),
            F.max("jump_issue").alias("jump_issue"),
            *([F.max("variance_issue").alias("variance_issue")] if variance is not None else []),
            *[e.alias(c) for c, e in tests.items()],
            F.max("status").alias("status"),
        )
        .withColumn("missing_pct", percent(F.col("missing_count"), F.col("total_values")))
        .withColumn("in_range_pct", percent(F.col("n_valid") - F.col("below_min") - F.col("above_max"), F.col("n_valid")))
    )


def dataset_overview(obs: DataFrame, status: DataFrame) -> DataFrame:
    """Cube dimensions, variables and number of variables with warnings per year."""
    names = status.groupBy("year").agg(
        F.count(F.lit(1)).alias("n_variables"),
        F.concat_ws(",", F.sort_array(F.collect_set("variable"))).alias("variables"),
        F.count_if(F.col("status") == "WARNING").alias("n_warnings"),
    )
    return cube_axes(obs).join(names, "year")


def coordinate_checks(obs: DataFrame, stations: DataFrame, bounds: DataFrame) -> DataFrame:
    """Missing and range checks of the station coordinates, over the stations of every year."""
    names = ["latitude", "longitude", "height"]
    per_station = (
        obs.select("year", "station_id")
        .distinct()
        .join(stations, "station_id", "left")
        .unpivot(["year", "station_id"], names, "variable", "value")
        .join(small(bounds), "variable", "left")
    )
    return (
        per_station.groupBy("year", "variable")
        .agg(
            F.count(F.lit(1)).alias("total_values"),
            F.count_if(F.col("value").isNull()).alias("missing_count"),
            F.count_if(F.col("value") < F.col("lo")).alias("below_min"),
            F.count_if(F.col("value") > F.col("hi")).alias("above_max"),
        )
        .withColumn(
            "status",
            F.when(
                (F.col("missing_count") > 0) | (F.col("below_min") > 0) | (F.col("above_max") > 0), "WARNING"
            ).otherwise("OK"),
        )
    )


def cleaning_stats(obs: DataFrame, bounds: DataFrame, use_inf: bool = True, use_range: bool = True) -> DataFrame:
    """Valid values before and after cleaning; infinite values count as valid before."""
    cleaned = cleaned_long(obs, bounds, use_inf, use_range, out="clean")
    return _with_removed(
        cleaned.groupBy("year", "variable").agg(
            F.count("value").alias("original_valid"), F.count("clean").alias("clean_valid")
        )
    )


def _with_removed(counts: DataFrame) -> DataFrame:
    return counts.withColumn("removed", F.col("original_valid") - F.col("clean_valid")).withColumn(
        "removed_pct", percent(F.col("removed"), F.col("original_valid"))
    )


def _sums(stats: DataFrame) -> list[Column]:
    return [F.sum(c).alias(c) for c in ("original_valid", "clean_valid")]


def cleaning_by_variable(stats: DataFrame) -> DataFrame:
    """Cleaning pooled over years, worst variable first."""
    pooled = _with_removed(stats.groupBy("variable").agg(*_sums(stats)))
    return with_rank(pooled, F.col("removed_pct").desc())


def cleaning_report(stats: DataFrame) -> DataFrame:
    """Year x variable rows plus the total of every year (``variable`` is NULL) and of all years."""
    pooled = stats.rollup("year", "variable").agg(
        *_sums(stats), F.grouping_id("year", "variable").alias("level")
    )
    return _with_removed(pooled)


def with_rank(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Report position by a metric; one row per variable comes in, so one task suffices."""
    return df.withColumn(name, F.rank().over(Window.orderBy(*order)))


def completeness_by_variable(missing: DataFrame) -> DataFrame:
    """Mean of the yearly completeness and missing shares."""
    means = missing.groupBy("variable").agg(
        F.avg(F.lit(100.0) - F.col("missing_pct")).alias("completeness_pct"),
        F.avg("missing_pct").alias("missing_pct"),
    )
    value = F.col("completeness_pct")
    return with_rank(means.withColumn("band", band(value, value >= 95, value >= 80)), value.asc())


def violations_by_variable(ranges: DataFrame) -> DataFrame:
    """Out-of-range values per valid value, pooled over years; only variables with bounds."""
    pooled = (
        ranges.filter(F.col("range_defined") & ~F.col("all_missing"))
        .groupBy("variable")
        .agg(
            F.sum(F.col("below_min") + F.col("above_max")).alias("violations"),
            F.sum("n_valid").alias("n_valid"),
        )
        .withColumn("violation_pct", percent(F.col("violations"), F.col("n_valid")))
    )
    return with_rank(pooled, F.col("violation_pct").desc())


def global_missing_pct(missing: DataFrame, threshold: float = MAX_MISSING_PCT) -> DataFrame:
    """Missing cells per cell over all years in which the variable exists."""
    pooled = (
        missing.groupBy("variable")
        .agg(F.sum("total_values").alias("total_values"), F.sum("missing_count").alias("missing_count"))
        .filter("total_values > 0")
        .withColumn("missing_pct", percent(F.col("missing_count"), F.col("total_values")))
    )
    value = F.col("missing_pct")
    return with_rank(pooled.withColumn("keep", value <= threshold), value.desc())


def keep_list(global_missing: DataFrame) -> list[str]:
    """Names of the variables to keep; one short row per variable reaches the driver."""
    return [r.variable for r in global_missing.filter("keep").select("variable").orderBy("variable").collect()]


def prune_summary(missing: DataFrame, global_missing: DataFrame) -> DataFrame:
    """Variables before and after pruning per year."""
    return (
        missing.select("year", "variable")
        .join(global_missing.select("variable", "keep"), "variable")
        .groupBy("year")
        .agg(
            F.count(F.lit(1)).alias("original_vars"),
            F.count_if("keep").alias("remaining_vars"),
            F.count_if(~F.col("keep")).alias("removed_vars"),
        )
    )


def year_summary(obs: DataFrame, step_seconds: int = STEP_SECONDS) -> DataFrame:
    """Size, time range and completeness of every year against a full calendar."""
    facts = obs.groupBy("year").agg(
        F.min("time").alias("first_time"),
        F.max("time").alias("last_time"),
        F.count("value").alias("present"),
        F.count_distinct("station_id").alias("n_stations"),
        F.count_distinct("time").alias("n_times"),
        F.count_distinct("variable").alias("n_variables"),
    )
    days = F.dayofyear(F.make_date("year", F.lit(12), F.lit(31)))
    cells = F.col("n_stations") * F.col("n_times") * F.col("n_variables")
    rows = F.col("n_stations") * F.col("n_times")
    expected = F.col("n_stations") * F.lit(DAY_SECONDS // step_seconds) * days
    return facts.select(
        "year",
        "n_stations",
        "n_times",
        "first_time",
        "last_time",
        percent(cells - F.col("present"), cells).alias("missing_pct"),
        (rows / expected).alias("data_ratio"),
        (rows / expected >= ENOUGH_ROWS_RATIO).alias("enough_data"),
    )
