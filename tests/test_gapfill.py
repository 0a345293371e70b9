import math
import random

import pytest
from pyspark.sql import functions as F

from gaugeloom.operators.gapfill import fill_gaps, fill_stats, gap_runs, interpolate, overall_fill_stats, pooled_fill_stats
from gaugeloom.operators.grid import densify_grid

N = None


def runs_of(cells):
    runs, start = [], None
    for i, c in enumerate([*cells, 0.0]):
        if c is None and start is None:
            start = i
        elif c is not None and start is not None:
            runs.append((start, i))
            start = None
    return runs


def filled_one_by_one(cells, max_gap=6, max_extrap=2):
    """The rules applied cell by cell, each run seeing what earlier runs were filled with."""
    out, how = list(cells), ["missing" if c is None else "observed" for c in cells]
    if all(c is None for c in cells):
        return out, how
    n = len(cells)
    for a, b in runs_of(cells):
        if a > 0 and b < n and b - a <= max_gap:
            for i in range(a, b):
                out[i] = cells[a - 1] + (cells[b] - cells[a - 1]) * (i - a + 1) / (b - a + 1)
                how[i] = "interpolated"
    for a, b in runs_of(out):
        left, right = a - 1, b
        for near, far, order, name in (
            (left, max(left - 3, 0), range(a, min(a + max_extrap, b)), "extrapolated_forward"),
            (right, min(right + 3, n - 1), range(max(b - max_extrap, a), b), "extrapolated_backward"),
        ):
            if not 0 <= near < n or near == far or out[far] is None:
                continue
            slope = (out[near] - out[far]) / (near - far)
            for i in order:
                if out[i] is None:
                    out[i], how[i] = out[near] + slope * (i - near), name
    return out, how


def frame(spark, series):
    rows = [(2024, s, i, v) for s, cells in series.items() for i, v in enumerate(cells)]
    df = spark.createDataFrame(rows, "year int, station_id long, i int, value double")
    return df.withColumn("time", F.timestamp_add("MINUTE", F.col("i") * 10, F.lit("2024-01-01").cast("timestamp_ntz")))


def check(spark, series, **options):
    width = max(map(len, series.values()))
    series = {s: list(c) + [N] * (width - len(c)) for s, c in series.items()}
    got = {}
    for r in fill_gaps(frame(spark, series), **options).collect():
        got.setdefault(r.station_id, {})[r.pos] = (r.value, r.value_method)
    limits = {k: v for k, v in options.items() if k in ("max_gap", "max_extrap")}
    for s, cells in series.items():
        values, how = filled_one_by_one(cells, **limits)
        assert sorted(got[s]) == list(range(width))
        for i in range(width):
            assert got[s][i][1] == how[i], (s, i, cells)
            assert (values[i] is None) == (got[s][i][0] is None)
            if values[i] is not None:
                assert math.isclose(got[s][i][0], values[i], rel_tol=1e-9, abs_tol=1e-9)


HAND_MADE = {
    1: [1, 2, 3, 4, N, N, N, N, N, N, 11, 12, 13, 14],  # exactly six
    2: [1, 2, 4, 8, N, N, N, N, N, N, N, 9, 7, 6, 5],  # seven: only its edges
    3: [N, 5, 6, 8, 9, 7],
    4: [N, N, 5, 6, 8, 9, 7],
    5: [N, N, N, 5, 6, 8, 9, 7],
    6: [4, 5, 6, 8, 9, N],
    7: [4, 5, 6, 8, 9, N, N],
    8: [4, 5, 6, 8, 9, N, N, N],
    9: [3, N, N, N, 7, 8, 6],  # run of three next to the edge
    10: [N] * 12,
    11: [N, N, N, 4, N, N, N, N],  # one valid cell
    12: [N, N, 4, 5, N, N, N],
    13: [N, 4, N, N, N, N, N, N, N, 5, 6, 7, N, N, N, N, N, N, N, N, 2, 3],
    14: [1.5, 2.5],
}


def test_hand_made_series(spark):
    check(spark, {s: [N if v is None else float(v) for v in c] for s, c in HAND_MADE.items()})


@pytest.mark.parametrize("chunk_cells", [5, 16, 4096])
@pytest.mark.parametrize("max_gap, max_extrap", [(6, 2), (4, 2), (5, 3)])
def test_random_series_across_chunk_borders(spark, chunk_cells, max_gap, max_extrap):
    rng = random.Random(7)
    series = {}
    for s in range(60):
        p = rng.choice([0.2, 0.5, 0.8, 0.95])
        keep = True
        cells = []
        for _ in range(90):
            keep = keep if rng.random() < 0.6 else rng.random() > p
            cells.append(round(rng.uniform(-20, 40), 1) if keep else N)
        series[s] = cells
    check(spark, series, chunk_cells=chunk_cells, max_gap=max_gap, max_extrap=max_extrap)


def test_counts_add_up_and_observed_values_stay(spark):
    obs = frame(spark, {1: [1.0, N, 3.0, N, N, N, N, N, N, N, 4.0, 5.0], 2: [N, 2.0, 3.0, N, 4.0, 5.0, N, N, N, N, N, N]})
    filled = fill_gaps(obs)
    kept = filled.join(obs.select("station_id", "time", F.col("value").alias("was")), ["station_id", "time"])
    assert kept.filter("was is not null and (value <> was or value_method <> 'observed')").isEmpty()
    stats = fill_stats(filled)
    row = pooled_fill_stats(stats).first()
    assert row.missing_before == row.n_interpolated + row.n_extrapolated + row.missing_after
    assert overall_fill_stats(stats).first().missing_before == row.missing_before
    again = fill_gaps(filled.select("year", "station_id", "time", "value"))
    assert again.count() == filled.count()


def test_wide_table_fills_each_variable_on_its_own(spark):
    obs = frame(spark, {1: [1.0, N, 3.0, 4.0]}).withColumn("other", F.when(F.col("i") != 2, F.lit(7.0)))
    rows = {r.pos: r for r in fill_gaps(obs, ["value", "other"]).collect()}
    assert (rows[1].value, rows[1].value_method, rows[1].other_method) == (2.0, "interpolated", "observed")
    assert (rows[2].other, rows[2].other_method) == (7.0, "interpolated")


def test_fill_counts_leave_out_years_without_the_variable(spark):
    rows = [(2000, 1.0, "observed", None, "missing"), (2001, None, "missing", 2.0, "interpolated")]
    filled = spark.createDataFrame(rows, "year int, a double, a_method string, b double, b_method string")
    existing = spark.createDataFrame([(2000, "a"), (2001, "a"), (2001, "b")], "year int, variable string")
    got = fill_stats(filled, ["a", "b"], existing=existing).orderBy("year", "variable").collect()
    assert [(r.year, r.variable, r.missing_before) for r in got] == [(2000, "a", 0), (2001, "a", 1), (2001, "b", 1)]
    assert fill_stats(filled, ["a", "b"]).count() == 4


def test_interpolate_leaves_edges(spark):
    rows = interpolate(frame(spark, {1: [N, 1.0, N, 3.0, N]})).orderBy("pos").collect()
    assert [r.value for r in rows] == [N, 1.0, 2.0, 3.0, N]


@pytest.mark.parametrize("chunk_cells", [3, 4096])
def test_gap_runs_span_chunks(spark, chunk_cells):
    cells = [N, N, 1.0] + [N] * 11 + [2.0, 3.0, N]
    other = [1.0] * 17
    got = {
        (r.gap_start, r.gap_end, r.gap_length, r.left_value, r.right_value)
        for r in gap_runs(frame(spark, {1: cells, 2: other}), chunk_cells=chunk_cells).collect()
    }
    assert got == {(0, 2, 2, N, 1.0), (3, 14, 11, 1.0, 2.0), (16, 17, 1, 3.0, N)}


def test_densify_is_stations_by_times_of_the_year(spark):
    obs = frame(spark, {1: [1.0, 2.0, 3.0], 2: [4.0]})
    later = obs.withColumns({"year": F.lit(2025), "time": F.timestamp_add("YEAR", F.lit(1), "time")}).filter("i < 2")
    dense = densify_grid(obs.unionByName(later), ["value"])
    assert {r.year: r["count"] for r in dense.groupBy("year").count().collect()} == {2024: 6, 2025: 4}


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def test_calendar_holds_steps_nobody_reported(spark):
    """Hourly steps of two years, a step missing everywhere; positions count from the first step of the year."""
    rows = [(2023, 1, "2023-12-31 21:00:00", 1.0), (2023, 1, "2023-12-31 23:00:00", 3.0), (2024, 1, "2024-01-01 02:00:00", 5.0), (2024, 2, "2024-02-29 00:00:00", 7.0)]
    obs = spark.createDataFrame(rows, "year int, station_id long, t string, value double").withColumn("time", F.col("t").cast("timestamp_ntz"))
    reported = fill_gaps(obs, step_seconds=3600)
    assert {(r.year, r.pos) for r in reported.collect()} == {(2023, 0), (2023, 1), (2024, 0), (2024, 1)}
    filled = fill_gaps(obs, step_seconds=3600, calendar=True)
    sizes = {(r.year, r.station_id): r["count"] for r in filled.groupBy("year", "station_id").count().collect()}
    assert sizes == {(2023, 1): 8760, (2024, 1): 8784, (2024, 2): 8784}
    between = filled.filter(F.col("time") == at("2023-12-31 22:00:00")).collect()
    assert [(r.pos, r.value, r.value_method) for r in between] == [(8758, 2.0, "interpolated")]
    assert filled.filter(F.col("time").isNull()).count() == 0
    first = filled.filter("pos = 0").select("year", "time").distinct().collect()
    assert sorted((r.year, r.time.isoformat()) for r in first) == [(2023, "2023-01-01T00:00:00"), (2024, "2024-01-01T00:00:00")]
    (gap,) = gap_runs(obs.filter("year = 2023"), step_seconds=3600, calendar=True, chunk_cells=5).filter("left_value = 1").collect()
    assert (gap.gap_start, gap.gap_end, gap.right_value) == (8758, 8759, 3.0)


@pytest.mark.parametrize("calendar", [False, True])
def test_positions_with_holes_in_the_axis(spark, calendar):
    """Steps far apart, before 1970 and across the words of 64 steps; chunks of a few cells see their neighbours."""
    rnd = random.Random(8)
    steps = sorted(rnd.sample(range(-300, 500), 60))
    cells = {(s, k): float(rnd.randrange(9)) for s in (1, 2) for k in steps if rnd.random() < 0.6}
    steps = sorted({k for _, k in cells})
    rows = [(s, k, v) for (s, k), v in cells.items()]
    time = F.timestamp_add("MINUTE", F.col("k") * 10, at("1969-06-01"))
    obs = spark.createDataFrame(rows, "station_id long, k int, value double").withColumn("time", time).withColumn("year", F.year("time"))
    got = {(r.station_id, r.time): r for r in fill_gaps(obs, chunk_cells=3, calendar=calendar).collect()}
    whole = {(r.station_id, r.time): r for r in fill_gaps(obs, calendar=calendar).collect()}
    assert {k: (r.value, r.value_method, r.pos) for k, r in got.items()} == {k: (r.value, r.value_method, r.pos) for k, r in whole.items()}
    if not calendar:
        assert sorted({r.pos for r in got.values()}) == list(range(len(steps))) and len(got) == 2 * len(steps)
        for s in (1, 2):
            values, how = filled_one_by_one([cells.get((s, k)) for k in steps])
            own = sorted((r.pos, r.value_method) for (station, _), r in got.items() if station == s)
            assert [h for _, h in own] == how


def test_a_time_off_the_step_is_an_error(spark):
    obs = spark.createDataFrame([(2024, 1, 1.0)], "year int, station_id long, value double").withColumn("time", at("2024-01-01 00:05:00"))
    with pytest.raises(Exception, match="not on a step of 600 seconds"):
        fill_gaps(obs).collect()
