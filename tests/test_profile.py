import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gaugeloom.config import BOUNDS, bounds_frame, change_frame
from gaugeloom.operators import grid, merge, profile

INF = float("inf")


def obs(spark, rows):
    data = [(y, s, dt.datetime(y, 1, 1) + dt.timedelta(minutes=10 * i), v, x) for y, s, i, v, x in rows]
    return spark.createDataFrame(data, "year int, station_id int, time timestamp_ntz, variable string, value double")


ROWS = [
    (2000, 1, 0, "TT_10", 1.0),
    (2000, 1, 1, "TT_10", INF),
    (2000, 2, 0, "TT_10", None),
    (2000, 2, 5, "QN", 3.0),
    (2001, 1, 0, "TT_10", 60.0),
    (2001, 1, 1, "TT_10", -2.0),
]


def test_missing_counts_absent_cells(spark):
    rows = {(r.year, r.variable): r for r in profile.profile_missing(obs(spark, ROWS)).collect()}
    tt = rows[2000, "TT_10"]
    assert (tt.total_values, tt.missing_count, tt.inf_count, tt.has_issues) == (6, 4, 1, True)
    assert rows[2000, "QN"].missing_count == 5
    assert (rows[2001, "TT_10"].total_values, rows[2001, "TT_10"].has_issues) == (2, False)


def test_missing_equals_the_built_grid(spark):
    table = obs(spark, ROWS).filter("variable = 'TT_10'")
    dense = grid.densify_grid(table, ["value"]).groupBy("year").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("value").isNull()).alias("nulls")
    )
    profiled = {r.year: (r.total_values, r.missing_count) for r in profile.profile_missing(table).collect()}
    assert {r.year: (r.total, r.nulls) for r in dense.collect()} == profiled


def test_range_profile(spark):
    rows = {(r.year, r.variable): r for r in profile.profile_range(obs(spark, ROWS), bounds_frame(spark)).collect()}
    assert (rows[2001, "TT_10"].above_max, rows[2001, "TT_10"].in_range_pct) == (1, 50.0)
    assert rows[2000, "QN"].range_defined is False and rows[2000, "QN"].has_issues is False
    assert (rows[2000, "TT_10"].above_max, rows[2000, "TT_10"].n_valid) == (1, 2)


def test_jumps_cross_stretches_of_time(spark):
    rng = random.Random(4)
    rows, expected, largest = [], 0, 0.0
    for station in (1, 2, 3):
        values = [(i, rng.uniform(0, 20) if rng.random() < 0.7 else None) for i in range(0, 52000, 900)]
        rows += [(2001, station, i, "TT_10", v) for i, v in values]
        valid = [v for _, v in values if v is not None]
        steps = [abs(b - a) for a, b in zip(valid, valid[1:])]
        expected, largest = expected + sum(s > 5 for s in steps), max(largest, *steps)
    rows.append((2001, 9, 0, "PP_10", 1000.0))  # a single value: no row
    (row,) = profile.temporal_jumps(obs(spark, rows), change_frame(spark)).collect()
    assert (row.variable, row.large_jumps, row.max_diff) == ("TT_10", expected, pytest.approx(largest))


def test_status_flags(spark):
    rows = {(r.year, r.variable): r for r in profile.variable_status(
        obs(spark, ROWS), bounds_frame(spark), change_frame(spark)).collect()}
    assert rows[2001, "TT_10"].status == "WARNING" and rows[2001, "TT_10"].jump_issue
    assert not rows[2001, "TT_10"].missing_issue and rows[2000, "QN"].status == "WARNING"


def test_cleaning_counts_add_up(spark):
    stats = profile.cleaning_stats(obs(spark, ROWS), bounds_frame(spark))
    rows = {(r.year, r.variable): r for r in stats.collect()}
    assert (rows[2000, "TT_10"].original_valid, rows[2000, "TT_10"].clean_valid) == (2, 1)
    assert rows[2001, "TT_10"].removed_pct == 50.0
    report = profile.cleaning_report(stats)
    assert report.filter("level = 3").first().removed == sum(r.removed for r in rows.values())
    keep_inf = profile.cleaning_stats(obs(spark, ROWS), bounds_frame(spark, {}), use_inf=False)
    assert keep_inf.filter("removed > 0").isEmpty()


def test_pruning_uses_only_years_with_the_variable(spark):
    missing = profile.profile_missing(obs(spark, ROWS))
    pooled = profile.global_missing_pct(missing, threshold=80.0)
    assert {r.variable: round(r.missing_pct, 4) for r in pooled.collect()} == {"TT_10": 50.0, "QN": 83.3333}
    assert profile.keep_list(pooled) == ["TT_10"]
    summary = {r.year: (r.original_vars, r.remaining_vars) for r in profile.prune_summary(missing, pooled).collect()}
    assert summary == {2000: (2, 1), 2001: (1, 1)}
    wide = spark.createDataFrame([(2000, 1, 1.0, 2.0)], "year int, station_id int, TT_10 double, QN double")
    assert merge.prune_variables(wide, ["TT_10", "absent"]).columns == ["year", "station_id", "TT_10"]


def test_year_summary_knows_leap_years(spark):
    rows = [(y, 1, i, "TT_10", 1.0) for y in (2000, 2001) for i in range(10)]
    got = {r.year: r.data_ratio for r in profile.year_summary(obs(spark, rows)).collect()}
    assert got == {2000: pytest.approx(10 / 52704), 2001: pytest.approx(10 / 52560)}


def test_stations_dedupe_before_the_join(spark):
    versions = spark.createDataFrame(
        [(1, 5, 50.0, 8.0, 1.0), (1, 2, 51.0, 9.0, 2.0), (2, 1, None, 8.0, 3.0)],
        "station_id int, ordinal int, latitude double, longitude double, height double",
    )
    stations = grid.station_dedupe(versions)
    assert [(r.station_id, r.latitude) for r in stations.collect()] == [(1, 51.0)]
    joined = grid.join_station(obs(spark, ROWS), stations)
    assert joined.count() == len(ROWS)
    constants = {r.station_id: r.latitude for r in grid.station_constants(joined).collect()}
    assert constants == {1: 51.0, 2: None}
    checks = profile.coordinate_checks(obs(spark, ROWS), stations, bounds_frame(spark, BOUNDS))
    assert {r.missing_count for r in checks.filter("year = 2000").collect()} == {1}


def test_wide_profile_equals_the_long_one(spark):
    wide = spark.createDataFrame(
        [(2000, 1, 1, 1.0, None), (2000, 2, 2, None, INF), (2001, 1, 1, 2.0, 3.0)],
        "year int, station_id int, time int, a double, b double",
    )
    long = profile.profile_missing(merge.to_long(wide, ["a", "b"])).collect()
    assert sorted(long) == sorted(profile.profile_missing_wide(wide, ["a", "b"]).collect())


def test_only_years_of_a_category_count(spark):
    a = spark.createDataFrame([(2000, 1, 1, 1.0), (2001, 1, 1, None)], "year int, station_id int, time int, a double")
    b = spark.createDataFrame([(2001, 1, 1, 2.0)], "year int, station_id int, time int, b double")
    existing = merge.existing_variables([a, b])
    assert sorted(map(tuple, existing.collect())) == [(2000, "a"), (2001, "a"), (2001, "b")]
    wide = merge.union_folds([a, b]).groupBy("year", "station_id", "time").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    pooled = profile.global_missing_pct(profile.profile_missing_wide(wide, ["a", "b"], existing))
    assert {r.variable: r.missing_pct for r in pooled.collect()} == {"a": 50.0, "b": 0.0}
