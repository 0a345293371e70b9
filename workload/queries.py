"""One runnable query per operator, over the whole given tables."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloom.config import bounds_frame, change_frame
from gaugeloom.functions import scalar
from gaugeloom.operators import catalog_stats, gapfill, grid, inference, intervals, merge, profile
from gaugeloom.session import shared_dir, stored
from gaugeloom.sources import catalog as files
from gaugeloom.sources import dataset, delimited, station_text
from workload import adapters as A

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in cols})


# --- shared inputs -------------------------------------------------------------------


def obs_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text to one numeric value per cell: cast, sentinel, first non-missing."""
    raw = A.raw_obs(spark, sf_dir)
    typed = raw.select(
        "station_id",
        scalar.parse_time(F.col("time_text")).alias("time"),
        "variable",
        scalar.without_sentinel(scalar.lenient_double(F.col("raw"))).alias("value"),
        "order_key",
    ).filter(F.col("time").isNotNull())
    keys = ["year", "station_id", "time", "variable"]
    return merge.first_non_null(typed.withColumn("year", F.year("time")), ["value"], keys)


def finite_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scalar.filter_inf(obs_values(spark, sf_dir), ["value"])


def bounds(spark: SparkSession) -> DataFrame:
    return bounds_frame(spark, A.BOUNDS)


def limits(spark: SparkSession) -> DataFrame:
    return change_frame(spark, A.JUMP_LIMITS)


def wide_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivoted(obs_values(spark, sf_dir))


def pivoted(cells: DataFrame) -> DataFrame:
    """One column per variable and row per station and time."""
    return cells.groupBy("year", "station_id", "time").agg(
        *[F.max(F.when(F.col("variable") == v, F.col("value"))).alias(v) for v in A.EVENT_VARIABLES]
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(grid.station_dedupe(A.station_versions(spark, sf_dir)).drop("ordinal"), "stations")


# --- sources and sinks -----------------------------------------------------------------


def delimited_files(spark: SparkSession, sf_dir: str, columns: list[str]) -> str:
    path = shared_dir(spark, "delimited")
    A.delimited_lines(spark, sf_dir, columns).write.text(path)
    return path


DELIMITED = [*delimited.KEY_COLUMNS, "QN", "value", "eor"]


@query
def scan_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = delimited.scan_delimited(spark, delimited_files(spark, sf_dir, DELIMITED), DELIMITED)
    return delimited.typed_observations(text, ["QN", "value"]).select("station_id", "time", "year", "QN", "value", "eor")


@query
def delimited_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read and over-long rows left out, by year; a line of a bad time has no year."""
    rows = station_text.scan(spark, delimited_files(spark, sf_dir, DELIMITED), DELIMITED)
    return rows.groupBy("year").agg(F.count_if(~F.col("rejected")).alias("n_rows"), F.count_if("rejected").alias("n_rejected"))


@query
def interval_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.interval_catalog(A.file_names(spark, sf_dir))


@query
def catalog_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.catalog_rejects(A.file_names(spark, sf_dir))


@query
def storage_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = A.table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", "//([^/:?#]+)", 1).alias("fold"), F.octet_length("html").alias("length")
    )
    return rounded(files.storage_inventory(pages), "storage_gb", digits=9)


@query
def extract_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = A.table(spark, sf_dir, "pages").select("page_id", "html")
    return files.extract_links(pages, "e").withColumn("position", F.col("position").cast("bigint"))


@query
def expand_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                names, contents = [], []
                for page_id, url, html in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    out = io.BytesIO()
                    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                        z.writestr("url.txt", url)
                        z.writestr(f"page_{page_id}.html", html)
                    names.append(f"{page_id}.zip")
                    contents.append(out.getvalue())
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(contents, pa.binary())], ["archive", "content"])

    pages = A.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    archives = pages.mapInArrow(packed, "archive string, content binary")
    return files.expand_archives(archives).select(
        "archive",
        F.col("member_idx").cast("bigint").alias("member_idx"),
        "member",
        F.octet_length("content").cast("bigint").alias("n_bytes"),
        F.md5("content").alias("digest"),
    )


@query
def station_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        delimited.station_latest(A.station_versions(spark, sf_dir)), "latitude", "longitude", "height"
    )


@query
def write_year_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "years")
    dataset.write_years(A.wide_lineitem(spark, sf_dir), path)
    stored = dataset.read_years(spark, path)
    return rounded(
        stored.groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("quantity")),
        "quantity",
    )


@query
def cleaning_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = profile.cleaning_stats(obs_values(spark, sf_dir), bounds(spark))
    return rounded(profile.cleaning_report(stats), "removed_pct").withColumns(
        {
            "level": F.col("level").cast("bigint"),
            "year": F.coalesce(F.col("year").cast("string"), F.lit("all")),
            "variable": F.coalesce("variable", F.lit("all")),
        }
    )


# --- projections and filters ---------------------------------------------------------


@query
def lenient_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = A.raw_obs(spark, sf_dir)
    number = scalar.lenient_double(F.col("raw"))
    return raw.select(
        "order_key", F.when(F.abs(number) < float("inf"), number).alias("value"), number.isNull().alias("is_missing")
    )


@query
def sentinel_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = A.raw_obs(spark, sf_dir).select(
        "order_key", "variable", scalar.without_infinity(scalar.lenient_double(F.col("raw"))).alias("value")
    )
    return scalar.sentinel_to_null(typed, ["value"])


@query
def parse_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.raw_obs(spark, sf_dir).select("order_key", scalar.parse_time(F.col("time_text")).alias("time"))


@query
def year_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    sliced = scalar.year_slice(A.table(spark, sf_dir, "lineitem"), 1998, "l_shipdate")
    return rounded(
        sliced.groupBy(F.col("l_suppkey").alias("station_id")).agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("quantity")
        ),
        "quantity",
    )


@query
def files_of_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scalar.files_of_year(A.intervals(spark, sf_dir), 1998)


@query
def filter_inf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scalar.filter_inf(obs_values(spark, sf_dir), ["value"])


@query
def filter_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scalar.filter_range(wide_values(spark, sf_dir), A.BOUNDS)


@query
def clip_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scalar.filter_range(wide_values(spark, sf_dir), A.BOUNDS, replace_with_null=False)


@query
def apply_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scalar.cleaned_long(obs_values(spark, sf_dir), bounds(spark))


@query
def prune_variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = profile.profile_missing(obs_values(spark, sf_dir))
    keep = profile.keep_list(profile.global_missing_pct(missing, A.KEEP_THRESHOLD))
    pruned = merge.prune_variables(wide_values(spark, sf_dir), keep)
    return pruned.groupBy("year").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(",".join(c for c in sorted(pruned.columns) if c in A.EVENT_VARIABLES)).alias("variables"),
    )


# --- joins and grid -----------------------------------------------------------------------


@query
def join_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = grid.join_station(A.wide_lineitem(spark, sf_dir), stations(spark, sf_dir))
    return rounded(
        joined.groupBy("year", "station_id", "latitude", "longitude", "height").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("quantity")
        ),
        "latitude",
        "longitude",
        "height",
        "quantity",
    )


@query
def station_constants(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = grid.join_station(A.wide_lineitem(spark, sf_dir), stations(spark, sf_dir))
    return rounded(grid.station_constants(joined), "latitude", "longitude", "height")


@query
def station_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        grid.station_dedupe(A.station_versions(spark, sf_dir)), "latitude", "longitude", "height"
    )


@query
def densify_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    dense = grid.densify_grid(A.gap_obs(spark, sf_dir), ["value"], step_seconds=A.STEP)
    return rounded(dense, "value").withColumn("pos", F.col("pos").cast("bigint"))


@query
def densify_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid over all steps of the calendar year, reported by anyone or not."""
    dense = grid.densify_grid(A.gap_obs(spark, sf_dir), ["value"], step_seconds=A.STEP, calendar=True)
    return rounded(dense, "value").withColumn("pos", F.col("pos").cast("bigint"))


@query
def regularize_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.regularize_interval(
        A.file_rows(spark, sf_dir), A.announced_files(spark, sf_dir), ["n_rows"], step_seconds=A.STEP
    )


# --- interval catalog --------------------------------------------------------------------------


@query
def overlap_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.overlap_intervals(A.intervals(spark, sf_dir))


@query
def resolve_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.resolve_overlaps(A.intervals(spark, sf_dir))


@query
def missing_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.missing_intervals(A.intervals(spark, sf_dir))


@query
def fill_missing_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = intervals.fill_missing_intervals(A.intervals(spark, sf_dir), step_seconds=86400)
    return rows.groupBy("fold", "station_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("time").alias("first_time"), F.max("time").alias("last_time")
    )


@query
def irregular_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.irregular_steps(A.file_rows(spark, sf_dir), step_seconds=A.STEP)


def misaligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.alignment_check(
        A.file_rows(spark, sf_dir), A.announced_files(spark, sf_dir), step_seconds=A.STEP
    )


@query
def alignment_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        misaligned(spark, sf_dir).drop("delta_sum"),
        "missing_start",
        "missing_end",
        "missing_intermediate",
        "length_minutes",
        "expected_length_minutes",
        "missing_minutes",
        "wrong_minutes",
    )


@query
def concat_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.concat_stations(A.file_rows(spark, sf_dir), A.announced_files(spark, sf_dir))


@query
def station_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog_stats.station_durations(A.intervals(spark, sf_dir))


@query
def duration_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog_stats.duration_stack(catalog_stats.station_durations(A.intervals(spark, sf_dir)))


@query
def overlap_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = A.intervals(spark, sf_dir)
    shares = catalog_stats.overlap_pct(intervals.overlap_intervals(before), intervals.resolve_overlaps(before))
    return rounded(shares, "stations_per_file_pct", "overlap_time_pct")


@query
def missing_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = A.intervals(spark, sf_dir)
    shares = catalog_stats.missing_pct(intervals.missing_intervals(given), given)
    return rounded(shares, "stations_per_file_pct", "missing_time_pct")


@query
def misaligned_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = catalog_stats.misaligned_pct(misaligned(spark, sf_dir), A.announced_files(spark, sf_dir))
    return rounded(shares, "bad_files_pct", "wrong_time_pct")


@query
def correction_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(catalog_stats.correction_totals(misaligned(spark, sf_dir)), "total_minutes")


@query
def consolidation_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(catalog_stats.consolidation_pct(A.intervals(spark, sf_dir)), "stations_per_file_pct")


# --- merging -------------------------------------------------------------------------------------


@query
def union_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = A.raw_obs(spark, sf_dir).withColumn(
        "value", scalar.without_infinity(scalar.lenient_double(F.col("raw")))
    )
    folds = [
        raw.filter(F.col("variable") == v).select("station_id", "time", "order_key", F.col("value").alias(v))
        for v in A.EVENT_VARIABLES
    ]
    return merge.union_folds(folds)


@query
def first_non_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finite_values(spark, sf_dir)


# --- profiles -----------------------------------------------------------------------------------------


@query
def profile_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.profile_missing(obs_values(spark, sf_dir)), "missing_pct", "inf_pct")


@query
def profile_missing_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = obs_values(spark, sf_dir)
    return rounded(profile.profile_missing(cells, calendar=True, step_seconds=A.STEP), "missing_pct", "inf_pct")


@query
def profile_missing_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.profile_missing(A.over_two_years(obs_values(spark, sf_dir))), "missing_pct", "inf_pct")


@query
def profile_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        profile.profile_range(finite_values(spark, sf_dir), bounds(spark)), "actual_min", "actual_max", "in_range_pct"
    )


@query
def temporal_jumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.temporal_jumps(finite_values(spark, sf_dir), limits(spark)), "max_diff")


@query
def temporal_jumps_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only values at most a day apart are compared."""
    found = profile.temporal_jumps(finite_values(spark, sf_dir), limits(spark), max_lag=86400)
    return rounded(found, "max_diff")


@query
def temporal_jumps_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.temporal_jumps(A.over_two_years(finite_values(spark, sf_dir)), limits(spark)), "max_diff")


@query
def check_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as a report file and read back; over two years, one of which lacks a variable."""
    cells = A.over_two_years(obs_values(spark, sf_dir))
    report = profile.check_report(cells, bounds(spark), limits(spark))
    numbers = ("actual_min", "actual_max", "max_diff", "missing_pct", "in_range_pct")
    path = shared_dir(spark, "check_report")
    text = report.withColumns({c: F.col(c).cast("string") for c in ("actual_min", "actual_max", "max_diff")})
    dataset.write_report(text, path)
    back = spark.read.schema(text.schema).json(path).withColumn("variable", F.coalesce("variable", F.lit("all")))
    finite = lambda c: F.when(F.abs(c.cast("double")) < float("inf"), c.cast("double"))
    return rounded(back.withColumns({c: finite(F.col(c)) for c in numbers}), *numbers).withColumn("level", F.col("level").cast("bigint"))


@query
def variable_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.variable_status(obs_values(spark, sf_dir), bounds(spark), limits(spark))


@query
def variable_status_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = finite_values(spark, sf_dir)
    return profile.variable_status(cells, bounds(spark), limits(spark), inference.levene(cells))


@query
def dataset_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = obs_values(spark, sf_dir)
    return profile.dataset_overview(cells, profile.variable_status(cells, bounds(spark), limits(spark)))


@query
def coordinate_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.coordinate_checks(
        A.long_lineitem(spark, sf_dir), stations(spark, sf_dir), bounds_frame(spark)
    )


@query
def cleaning_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.cleaning_stats(obs_values(spark, sf_dir), bounds(spark)), "removed_pct")


@query
def cleaning_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = profile.cleaning_stats(obs_values(spark, sf_dir), bounds(spark))
    return rounded(profile.cleaning_by_variable(stats), "removed_pct").withColumn("rank", F.col("rank").cast("bigint"))


@query
def completeness_by_variable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over several years: lineitem variables, with the discounts of zero taken as missing."""
    means = profile.completeness_by_variable(profile.profile_missing(A.patchy_lineitem(spark, sf_dir)))
    return rounded(means, "completeness_pct", "missing_pct").withColumn("rank", F.col("rank").cast("bigint"))


@query
def violations_by_variable(spark: SparkSession, sf_dir: str) -> DataFrame:
    pooled = profile.violations_by_variable(profile.profile_range(obs_values(spark, sf_dir), bounds(spark)))
    return rounded(pooled, "violation_pct").withColumn("rank", F.col("rank").cast("bigint"))


@query
def global_missing_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = profile.profile_missing(obs_values(spark, sf_dir))
    pooled = profile.global_missing_pct(missing, A.KEEP_THRESHOLD)
    return rounded(pooled, "missing_pct").withColumn("rank", F.col("rank").cast("bigint"))


@query
def keep_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = profile.profile_missing(obs_values(spark, sf_dir))
    return profile.global_missing_pct(missing, A.KEEP_THRESHOLD).select("variable", "keep")


@query
def prune_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = profile.profile_missing(obs_values(spark, sf_dir))
    return profile.prune_summary(missing, profile.global_missing_pct(missing, A.KEEP_THRESHOLD))


@query
def year_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = profile.year_summary(obs_values(spark, sf_dir), A.STEP)
    return rounded(summary, "missing_pct", "data_ratio")


# --- statistics ------------------------------------------------------------------------------------------


@query
def station_year_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(inference.station_year_stats(A.long_lineitem(spark, sf_dir)), "mean", "std", digits=4)


@query
def interannual_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = inference.station_year_stats(A.long_lineitem(spark, sf_dir))
    return rounded(inference.interannual_cv(stats), "mean_cv", "std_cv").withColumn("rank", F.col("rank").cast("bigint"))


VARIANCES = ("min_variance", "max_variance", "mean_variance")


@query
def levene_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    stat = inference.levene_statistic(A.long_lineitem(spark, sf_dir))
    return rounded(rounded(stat, "levene_w", "variance_ratio"), *VARIANCES, digits=2)


@query
def levene(spark: SparkSession, sf_dir: str) -> DataFrame:
    tested = inference.levene(A.long_lineitem(spark, sf_dir)).drop(*VARIANCES)
    return rounded(tested, "levene_w", "variance_ratio", "levene_p")


@query
def variance_ratio_by_variable(spark: SparkSession, sf_dir: str) -> DataFrame:
    stat = inference.levene_statistic(A.long_lineitem(spark, sf_dir))
    pooled = inference.variance_ratio_by_variable(stat)
    return rounded(pooled, "variance_ratio").withColumn("rank", F.col("rank").cast("bigint"))


@query
def ecdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(inference.ecdf(A.long_lineitem(spark, sf_dir)), "value", "below", "upto")


@query
def shape_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    shape = inference.shape_stats(A.long_lineitem(spark, sf_dir))
    return rounded(rounded(shape, "skewness", "kurtosis"), "mean", "std", digits=4)


@query
def ks_normality(spark: SparkSession, sf_dir: str) -> DataFrame:
    tested = inference.ks_normality(A.long_lineitem(spark, sf_dir))
    return rounded(tested.select("year", "variable", "n_values", "ks_d", "ks_p", "is_normal"), "ks_d", "ks_p")


@query
def distribution_by_variable(spark: SparkSession, sf_dir: str) -> DataFrame:
    pooled = inference.distribution_by_variable(inference.ks_normality(A.long_lineitem(spark, sf_dir)))
    ranks = ("p_rank", "normal_rank", "skewness_rank", "kurtosis_rank")
    return rounded(pooled, "mean_p", "normal_pct", "mean_skewness", "mean_kurtosis").withColumns(
        {c: F.col(c).cast("bigint") for c in ranks}
    )


# --- gap filling -------------------------------------------------------------------------------------------


@query
def gap_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = gapfill.gap_runs(A.gap_obs(spark, sf_dir), step_seconds=A.STEP)
    return rounded(runs, "left_value", "right_value").withColumns(
        {c: F.col(c).cast("bigint") for c in ("gap_start", "gap_end", "gap_length")}
    )


@query
def interpolate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gapfill.interpolate(A.gap_obs(spark, sf_dir), step_seconds=A.STEP), "value").drop("pos")


@query
def extrapolate(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = gapfill.fill_gaps(A.gap_obs(spark, sf_dir), step_seconds=A.STEP)
    return rounded(filled.filter(F.col("value_method").startswith("extrapolated")), "value").drop("pos")


@query
def fill_gaps_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = gapfill.fill_gaps(A.gap_obs(spark, sf_dir), step_seconds=A.STEP, calendar=True)
    return rounded(filled, "value").drop("pos")


@query
def fill_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gapfill.fill_gaps(A.gap_obs(spark, sf_dir), step_seconds=A.STEP), "value").drop("pos")


def gap_stats(cells: DataFrame) -> DataFrame:
    """Statistics of all event variables, filled together as columns of one wide table.

    The cleaned table is written by year first, as a full run does between its stages. Years count
    for the variables they hold.
    """
    spark = cells.sparkSession
    path = shared_dir(spark, "cleaned")
    dataset.write_years(scalar.apply_filters(pivoted(cells), A.BOUNDS), path)
    wide = dataset.read_years(spark, path)
    filled = gapfill.fill_gaps(wide, A.EVENT_VARIABLES, step_seconds=A.STEP)
    return gapfill.fill_stats(filled, A.EVENT_VARIABLES, existing=cells.select("year", "variable").distinct())


def report_rows(stats: DataFrame) -> DataFrame:
    return rounded(gapfill.fill_report(stats), "success_pct").withColumns(
        {
            "year": F.coalesce(F.col("year").cast("string"), F.lit("all")),
            "variable": F.coalesce("variable", F.lit("all")),
            "level": F.col("level").cast("bigint"),
        }
    )


@query
def fill_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gapfill.pooled_fill_stats(gap_stats(obs_values(spark, sf_dir))), "success_pct").withColumn(
        "rank", F.col("rank").cast("bigint")
    )


@query
def gapfill_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_rows(gap_stats(obs_values(spark, sf_dir)))


@query
def gapfill_report_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over two years, one of which lacks a variable: it has no rows there and counts for no total."""
    return report_rows(gap_stats(A.over_two_years(obs_values(spark, sf_dir))))


@query
def fill_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    overall = gapfill.overall_fill_stats(gap_stats(obs_values(spark, sf_dir)))
    return rounded(overall, "success_pct", "interpolated_pct", "extrapolated_pct")
