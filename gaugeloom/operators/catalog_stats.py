"""Shares and totals over the file catalog, one row per measurement category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeloom.config import DAY_SECONDS, HISTOGRAM_YEARS
from gaugeloom.functions.times import seconds_between


def station_durations(catalog: DataFrame) -> DataFrame:
    """Stations per category and whole years of announced data."""
    days = F.floor(seconds_between(F.col("start_date"), F.col("end_date")) / F.lit(DAY_SECONDS))
    return (
        catalog.groupBy("fold", "station_id")
        .agg(F.sum(days).alias("days"))
        .withColumn("years", F.floor(F.col("days") / F.lit(365.25)).cast("int"))
        .groupBy("fold", "years")
        .agg(F.count(F.lit(1)).alias("n_stations"))
    )


def duration_stack(durations: DataFrame, bins: int = HISTOGRAM_YEARS) -> DataFrame:
    """The durations of all categories on common bins, with the base each bar stands on."""
    folds = durations.groupBy("fold").agg(F.max("years").alias("longest"))
    slots = folds.agg(F.max("longest").alias("longest"), F.collect_set("fold").alias("folds")).select(
        F.explode("folds").alias("fold"),
        F.sequence(F.lit(0), F.greatest(F.col("longest"), F.lit(bins - 1))).alias("slots"),
    )
    below = Window.partitionBy("years").orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    return (
        slots.select("fold", F.explode("slots").alias("years"))
        .join(durations, ["fold", "years"], "left")
        .withColumn("n_stations", F.coalesce("n_stations", zero))
        .withColumn("base", F.coalesce(F.sum("n_stations").over(below), zero))
    )


def catalog_extent(catalog: DataFrame) -> DataFrame:
    """Files, stations and summed station spans of every category."""
    return (
        catalog.groupBy("fold", "station_id")
        .agg(
            F.count(F.lit(1)).alias("files"),
            seconds_between(F.min("start_date"), F.max("end_date")).alias("span"),
        )
        .groupBy("fold")
        .agg(
            F.sum("files").alias("n_files"),
            F.count(F.lit(1)).alias("n_stations"),
            F.sum("span").alias("span_seconds"),
        )
    )


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100.0).otherwise(0.0)


def _pair_shares(pairs: DataFrame, catalog: DataFrame, seconds: Column, share: str, time_share: str) -> DataFrame:
    hit = (
        pairs.groupBy("fold", "station_id")
        .agg(F.sum(seconds * F.col("n_pairs")).alias("s"))
        .groupBy("fold")
        .agg(F.count(F.lit(1)).alias("n_hit"), F.sum("s").alias("hit_seconds"))
    )
    zero = F.lit(0).cast("bigint")
    return (
        catalog_extent(catalog)
        .join(hit, "fold", "left")
        .withColumns({"n_hit": F.coalesce("n_hit", zero), "hit_seconds": F.coalesce("hit_seconds", zero)})
        .select(
            "fold",
            "n_files",
            F.col("n_hit").alias("n_stations_hit"),
            _percent(F.col("n_hit"), F.col("n_files")).alias(share),
            _percent(F.col("hit_seconds"), F.col("span_seconds")).alias(time_share),
        )
    )


def overlap_pct(overlaps: DataFrame, catalog: DataFrame) -> DataFrame:
    """Stations with overlaps per file, and overlapping time per station span, in percent.

    ``catalog`` is the one the shares refer to, normally the resolved one.
    """
    return _pair_shares(overlaps, catalog, -F.col("diff_seconds"), "stations_per_file_pct", "overlap_time_pct")


def missing_pct(missing: DataFrame, catalog: DataFrame) -> DataFrame:
    """Stations with holes per file, and missing time per station span, in percent."""
    return _pair_shares(missing, catalog, F.col("diff_seconds"), "stations_per_file_pct", "missing_time_pct")


def misaligned_pct(misaligned: DataFrame, catalog: DataFrame) -> DataFrame:
    """Failing files per file, and wrong time per station span, in percent."""
    bad = misaligned.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_bad"), F.sum(F.col("wrong_minutes") * 60.0).alias("wrong_seconds")
    )
    return (
        catalog_extent(catalog)
        .join(bad, "fold", "left")
        .withColumns(
            {
                "n_bad": F.coalesce("n_bad", F.lit(0).cast("bigint")),
                "wrong_seconds": F.coalesce("wrong_seconds", F.lit(0.0)),
            }
        )
        .select(
            "fold",
            "n_files",
            "n_bad",
            _percent(F.col("n_bad"), F.col("n_files")).alias("bad_files_pct"),
            _percent(F.col("wrong_seconds"), F.col("span_seconds")).alias("wrong_time_pct"),
        )
    )


def correction_totals(misaligned: DataFrame) -> DataFrame:
    return misaligned.agg(
        F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("wrong_minutes"), F.lit(0.0)).alias("total_minutes")
    )


def consolidation_pct(catalog: DataFrame) -> DataFrame:
    """Stations per file in percent: how far concatenation reduces the number of files."""
    return catalog_extent(catalog).select(
        "fold", "n_files", "n_stations", _percent(F.col("n_stations"), F.col("n_files")).alias("stations_per_file_pct")
    )
