"""What the plans of the heavy operators must look like, whatever the data size."""

import re

from gaugeloom.operators import gapfill, grid, inference, profile
from workload import adapters as A
from workload.queries import QUERIES, bounds, limits, obs_values

SF_DIR = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gap_filling_shuffles_cells_once(spark):
    obs = spark.createDataFrame([], "year int, station_id long, time timestamp_ntz, a double, b double")
    plan = physical(gapfill.fill_gaps(obs, ["a", "b"]))
    assert len(re.findall(r"Exchange hashpartitioning\(year#\d+, station_id#\d+L, chunk#\d+", plan)) == 1
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 3 and all("chunk#" in w for w in windows)
    assert plan.count("Sort [year") == 1


def test_checks_read_and_shuffle_observations_once(spark):
    df = profile.variable_status(obs_values(spark, SF_DIR), bounds(spark), limits(spark))
    df.collect()
    final = physical(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "Window" not in final and "Expand" not in final
    assert "ReusedExchange" in final


def test_value_counts_are_shared(spark):
    df = inference.levene_statistic(A.long_lineitem(spark, SF_DIR))
    df.collect()
    final = physical(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and final.count("ReusedExchange") >= 2


def test_counted_values_are_dealt_once_and_sorted_once(spark):
    """By station and bucket; the joins find them in this order. All else that moves has a row per station or bucket."""
    df = inference.levene_statistic(A.long_lineitem(spark, SF_DIR))
    first = physical(df)
    assert len(re.findall(r"Sort \[[^\n]*value#", first)) == 1
    df.collect()
    final = physical(df).split("== Initial Plan ==")[0]
    dealt = [line for line in final.splitlines() if "REPARTITION_BY_COL" in line]
    assert len([line for line in dealt if "ReusedExchange" not in line]) == 1 and len(dealt) == 2


def test_no_cross_joins_and_no_row_udfs(spark):
    for name in ("fill_gaps", "regularize_interval", "resolve_overlaps", "levene", "ks_normality", "duration_stack"):
        plan = physical(QUERIES[name](spark, SF_DIR))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "BatchEvalPython" not in plan, name


def test_grid_skeleton_travels_as_ranges(spark):
    obs = spark.createDataFrame([], "year int, station_id long, time timestamp_ntz, a double")
    plan = physical(grid.densify_grid(obs, ["a"]))
    # Cells appear above the shuffle: the generator comes before it in the printed tree.
    assert plan.index("posexplode(") < plan.index("Exchange hashpartitioning(year")


def test_no_cell_is_joined(spark):
    """35 years of 10-minute steps: positions and times are arithmetic, only observations meet the short axis table."""
    obs = spark.range(35).selectExpr(
        "cast(1990 + id AS int) AS year", "id AS station_id", "make_timestamp_ntz(cast(1990 + id AS int), 2, 3, 4, 50, 0) AS time", "1.0D AS a"
    )
    for calendar in (False, True):
        axis = grid.time_axis(obs, calendar=calendar)
        assert axis.count() == 35
        if calendar:
            assert {r.n_pos for r in axis.collect()} == {52560, 52704}
        plan = physical(gapfill.fill_gaps(obs, ["a"], calendar=calendar))
        cells, _, rows = plan.partition("posexplode(")
        assert "Join" not in cells and "Exchange" not in cells
        assert rows.count("chunk#") and len(re.findall(r"Exchange hashpartitioning\(year#\d+, station_id#\d+L, chunk#\d+", rows)) == 1
