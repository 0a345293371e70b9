"""Consistency between years, homogeneity of variances, shape of distributions.

All tests run on long observations ``year, station_id, time, variable, value``
for every year and variable at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeloom.config import (
    ALPHA,
    CHECK_EXEMPT,
    MIN_STATIONS_VARIANCE,
    MIN_VALUES_DISTRIBUTION,
    MIN_VALUES_STATION_YEAR,
    MIN_VALUES_VARIANCE,
    MIN_YEARS,
)
from gaugeloom.functions.scalar import band
from gaugeloom.functions.tails import f_upper_tail, kolmogorov_upper_tail, normal_cdf
from gaugeloom.operators.chunks import bucket_offsets, cumulated, ranked_values, split_large, value_counts
from gaugeloom.operators.profile import with_rank
from gaugeloom.session import stored

GROUP = ("year", "variable")
SERIES = ("year", "variable", "station_id")


def _measured(obs: DataFrame) -> DataFrame:
    return obs.filter(F.col("value").isNotNull() & ~F.col("variable").isin(*CHECK_EXEMPT))


def _finite(c: Column) -> Column:
    """NULL instead of NaN, which infinite input leads to and which would pass every ``>``."""
    return F.nanvl(c, F.lit(None).cast("double"))


# --- between years -----------------------------------------------------------


def station_year_stats(obs: DataFrame, min_values: int = MIN_VALUES_STATION_YEAR) -> DataFrame:
    """Mean and population deviation of a station's year, where it has enough values."""
    return (
        _measured(obs)
        .groupBy(*SERIES)
        .agg(
            F.count("value").alias("n_values"),
            F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("std"),
        )
        .filter(F.col("n_values") >= min_values)
    )


def interannual_cv(stats: DataFrame, min_years: int = MIN_YEARS) -> DataFrame:
    """Variation of a station's yearly means and deviations, averaged over stations."""
    per_station = (
        stats.groupBy("variable", "station_id")
        .agg(
            F.count(F.lit(1)).alias("n_years"),
            F.avg("mean").alias("mean_of_means"),
            F.stddev_pop("mean").alias("std_of_means"),
            F.avg("std").alias("mean_of_stds"),
            F.stddev_pop("std").alias("std_of_stds"),
        )
        .filter(F.col("n_years") >= min_years)
        .select(
            "variable",
            (F.col("std_of_means") / F.nullif(F.abs("mean_of_means"), F.lit(0.0))).alias("mean_cv"),
            (F.col("std_of_stds") / F.nullif(F.col("mean_of_stds"), F.lit(0.0))).alias("std_cv"),
        )
    )
    value = F.col("mean_cv")
    averaged = (
        per_station.groupBy("variable")
        .agg(
            F.avg("mean_cv").alias("mean_cv"),
            F.avg("std_cv").alias("std_cv"),
            F.count("mean_cv").alias("n_stations"),
        )
        .filter("n_stations > 0")
        .withColumn("band", band(value, value <= 0.15, value <= 0.3))
    )
    return with_rank(averaged, value.desc())


# --- variances between stations ---------------------------------------------------


def levene_statistic(
    obs: DataFrame,
    min_values: int = MIN_VALUES_VARIANCE,
    min_stations: int = MIN_STATIONS_VARIANCE,
    split_above: int = 1_000_000,
) -> DataFrame:
    """Median-centred Levene statistic over the stations of a year, and their variances.

    The values of a station are sorted once, stations of more than ``split_above`` rows a year
    in the buckets of their values, so a station of any size stays spread. The distances from the median
    add up to the upper half of the values less the lower half, whatever the median is. All sums are
    taken of distances from the station's mean, which keeps them well away from cancellation.
    """
    counts = split_large(value_counts(_measured(obs), SERIES), SERIES, split_above)
    offsets = bucket_offsets(counts, SERIES, "value").filter(F.col("n") >= min_values)
    cum, cnt, size = F.col("cum"), F.col("cnt"), F.col("n")
    before, half, none = cum - cnt, F.floor(size / F.lit(2)), F.lit(0).cast("bigint")
    lower = F.greatest(F.least(cum, half) - before, none)
    upper = F.greatest(cum - F.greatest(before, size - half), none)
    d = F.col("value") - F.col("mean")
    total = F.col("n_i").cast("double")
    shift = F.col("median") - F.col("mean")
    squared = F.col("about_mean") - F.lit(2.0) * shift * F.col("signed") + total * shift * shift
    station = (
        cumulated(counts, offsets, SERIES)
        .groupBy(*SERIES)
        .agg(
            F.max("n").alias("n_i"),
            F.max("mean").alias("mean"),
            F.min(F.when(cum >= size - half, F.col("value"))).alias("lo"),
            F.min(F.when(cum >= half + 1, F.col("value"))).alias("hi"),
            F.sum(cnt * d).alias("signed"),
            F.sum((upper - lower) * d).alias("absolute"),
            F.sum(cnt * d * d).alias("about_mean"),
        )
        .withColumn("median", (F.col("lo") + F.col("hi")) / F.lit(2.0))
        .select(
            *GROUP,
            "n_i",
            (F.col("absolute") / total).alias("z_mean"),
            (squared - F.col("absolute") * F.col("absolute") / total).alias("z_within"),
            ((F.col("about_mean") - F.col("signed") * F.col("signed") / total) / total).alias("variance"),
        )
    )
    # One row per station and year from here on.
    group = Window.partitionBy(*GROUP)
    grand = F.sum(F.col("n_i") * F.col("z_mean")).over(group) / F.sum("n_i").over(group)
    values, k = F.col("n_values"), F.col("n_stations")
    return (
        station.withColumn("apart", F.col("n_i") * F.pow(F.col("z_mean") - grand, F.lit(2.0)))
        .groupBy(*GROUP)
        .agg(
            F.count(F.lit(1)).alias("n_stations"),
            F.sum("n_i").alias("n_values"),
            F.sum("apart").alias("between"),
            F.sum("z_within").alias("within"),
            F.min("variance").alias("min_variance"),
            F.max("variance").alias("max_variance"),
            F.avg("variance").alias("mean_variance"),
        )
        .filter(k >= min_stations)
        .select(
            *GROUP,
            "n_stations",
            "n_values",
            _finite((values - k) / (k - 1) * F.col("between") / F.nullif(F.col("within"), F.lit(0.0))).alias(
                "levene_w"
            ),
            *[_finite(F.col(c)).alias(c) for c in ("min_variance", "max_variance", "mean_variance")],
        )
        .withColumn(
            "variance_ratio",
            F.when(F.col("min_variance") > 0, F.col("max_variance") / F.col("min_variance")).when(
                F.col("min_variance") == 0, F.lit(float("inf"))
            ),
        )
    )


def levene(obs: DataFrame, alpha: float = ALPHA, **options) -> DataFrame:
    """The statistic with its p-value; unequal variances are an issue of the variable."""
    p = f_upper_tail("levene_w", F.col("n_stations") - 1, F.col("n_values") - F.col("n_stations"))
    return (
        levene_statistic(obs, **options)
        .withColumn("levene_p", p)
        .withColumn("homogeneous", F.coalesce(F.col("levene_p") > alpha, F.lit(False)))
        .withColumn("has_issues", ~F.col("homogeneous"))
    )


def variance_ratio_by_variable(variance: DataFrame) -> DataFrame:
    """Mean of the finite positive yearly variance ratios."""
    value = F.col("variance_ratio")
    averaged = (
        variance.filter((value > 0) & (value < float("inf")))
        .groupBy("variable")
        .agg(F.avg("variance_ratio").alias("variance_ratio"), F.count(F.lit(1)).alias("n_years"))
        .withColumn("band", band(value, value <= 5, value <= 10))
    )
    return with_rank(averaged, value.desc())


# --- distributions ------------------------------------------------------------------


def ecdf(obs: DataFrame) -> DataFrame:
    """Steps of the empirical distribution function per year and variable."""
    n = F.col("n")
    return ranked_values(_measured(obs), GROUP).select(
        *GROUP, "value", "cnt", "n", (F.col("prev_cum") / n).alias("below"), (F.col("cum") / n).alias("upto")
    )


def shape_stats(obs: DataFrame, min_values: int = MIN_VALUES_DISTRIBUTION) -> DataFrame:
    """Moments of the valid values: population deviation, skewness and excess kurtosis."""
    return (
        _measured(obs)
        .groupBy(*GROUP)
        .agg(
            F.count("value").alias("n_values"),
            F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("std"),
            F.skewness("value").alias("skewness"),
            F.kurtosis("value").alias("kurtosis"),
        )
        .filter(F.col("n_values") >= min_values)
        .withColumns({c: _finite(F.col(c)) for c in ("mean", "std", "skewness", "kurtosis")})
    )


def ks_normality(obs: DataFrame, min_values: int = MIN_VALUES_DISTRIBUTION, alpha: float = ALPHA) -> DataFrame:
    """Kolmogorov-Smirnov distance to the normal law with the sample's own mean and deviation.

    One row per year and variable joins the distinct values, a table bounded by
    years x variables, so it may be broadcast.
    """
    shape = shape_stats(obs, min_values)
    moments = shape.select(*GROUP, "mean", "std")
    z = (F.col("value") - F.col("mean")) / F.nullif(F.col("std"), F.lit(0.0))
    distance = (
        ecdf(obs)
        .join(stored(moments, "moments"), list(GROUP))
        .withColumn("phi", _finite(normal_cdf(z)))
        .groupBy(*GROUP)
        .agg(F.max(F.greatest(F.col("upto") - F.col("phi"), F.col("phi") - F.col("below"))).alias("ks_d"))
    )
    return (
        shape.join(distance, list(GROUP), "left")
        .withColumn("ks_p", kolmogorov_upper_tail("ks_d", "n_values"))
        .withColumn("is_normal", F.coalesce(F.col("ks_p") > alpha, F.lit(False)))
    )


def distribution_by_variable(checks: DataFrame) -> DataFrame:
    """Means of the yearly distribution checks, with their bands, ranks and a class per variable."""
    p, share = F.col("mean_p"), F.col("normal_pct")
    skew, kurt = F.abs("mean_skewness"), F.abs("mean_kurtosis")
    pooled = (
        checks.groupBy("variable")
        .agg(
            F.count(F.lit(1)).alias("n_years"),
            F.avg("ks_p").alias("mean_p"),
            (F.avg(F.col("is_normal").cast("double")) * 100.0).alias("normal_pct"),
            F.avg("skewness").alias("mean_skewness"),
            F.avg("kurtosis").alias("mean_kurtosis"),
        )
        .withColumn("p_band", band(p, p > ALPHA, F.lit(False)))
        .withColumn("normal_band", band(share, share > 80, share > 50))
        .withColumn("skewness_band", band(skew, skew < 0.5, skew < 1.0))
        .withColumn("kurtosis_band", band(kurt, kurt < 1.0, kurt < 3.0))
        .withColumn(
            "distribution_class",
            F.when(share > 80, "normal").when(share > 50, "moderate").otherwise("non-normal"),
        )
    )
    orders = {"p_rank": p.asc(), "normal_rank": share.desc(), "skewness_rank": skew.desc(), "kurtosis_rank": kurt.desc()}
    for name, order in orders.items():
        pooled = with_rank(pooled, order, name=name)
    return pooled
