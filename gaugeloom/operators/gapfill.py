"""Finding and filling runs of missing values in dense station series.

A run of at most ``max_gap`` missing cells between two valid cells is filled by
the straight line between them. Of every run that remains, the first
``max_extrap`` cells continue the trend on its left and the last ``max_extrap``
cells that are still empty continue the trend on its right. A trend is the line
through the first and last of up to ``TREND_POINTS`` neighbouring cells; if one
of these two is missing, nothing is filled.

Every one of these rules looks a bounded number of cells to either side. So a
series is cut into chunks that carry a few cells of their neighbours, and all
windows of a chunk share one shuffle and one sort.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from gaugeloom.config import MAX_EXTRAP, MAX_GAP, STEP_SECONDS, TREND_POINTS
from gaugeloom.functions.scalar import band
from gaugeloom.operators.chunks import with_neighbours
from gaugeloom.operators.grid import CHUNK_CELLS, grid_cells, placed, slot_time, time_axis
from gaugeloom.operators.profile import with_rank

OBSERVED = "observed"
INTERPOLATED = "interpolated"
FORWARD = "extrapolated_forward"
BACKWARD = "extrapolated_backward"
MISSING = "missing"


def gap_runs(
    obs: DataFrame,
    value: str = "value",
    series_keys: Sequence[str] = ("station_id",),
    axis_keys: Sequence[str] = ("year",),
    time: str = "time",
    chunk_cells: int = CHUNK_CELLS,
    step_seconds: int = STEP_SECONDS,
    calendar: bool = False,
) -> DataFrame:
    """Runs ``[gap_start, gap_end)`` of missing cells with their length and neighbours.

    Only valid cells are read: a run lies between two valid cells that are not
    adjacent, before the first or after the last one. Series without any valid
    cell have no runs.
    """
    keys = [*axis_keys, *series_keys]
    axis = time_axis(obs, axis_keys, time, step_seconds, calendar)
    valid = (
        placed(obs.filter(F.col(value).isNotNull()).select(*keys, time, value), axis, axis_keys, time, step_seconds)
        .select(*keys, "pos", "n_pos", F.col(value).alias("_v"))
        .withColumn("chunk", F.floor(F.col("pos") / F.lit(chunk_cells)).cast("int"))
    )
    before = (
        with_neighbours(valid, keys, "chunk", ["pos"], ["pos", "_v"], previous="left")
        .withColumn("gap_start", F.coalesce(F.col("left.pos") + 1, F.lit(0)))
        .filter(F.col("gap_start") < F.col("pos"))
        .select(
            *keys,
            "gap_start",
            F.col("pos").alias("gap_end"),
            F.col("left._v").alias("left_value"),
            F.col("_v").alias("right_value"),
        )
    )
    trailing = (
        valid.groupBy(*keys)
        .agg(F.max("pos").alias("last"), F.max("n_pos").alias("n_pos"), F.max_by("_v", "pos").alias("left_value"))
        .filter(F.col("last") < F.col("n_pos") - 1)
        .select(
            *keys,
            (F.col("last") + 1).alias("gap_start"),
            F.col("n_pos").alias("gap_end"),
            "left_value",
            F.lit(None).cast("double").alias("right_value"),
        )
    )
    return before.unionByName(trailing).withColumn("gap_length", F.col("gap_end") - F.col("gap_start"))


def _continued(near: Sequence[tuple[Column, Column]]) -> Column:
    """Continue the trend of the nearest non-missing cell; entries are (value, slope) by distance."""
    (value, slope), *rest = near
    return reduce(
        lambda acc, step: acc.when(step[1][0].isNotNull(), step[1][0] + step[1][1] * F.lit(float(step[0]))),
        enumerate(rest, start=2),
        F.when(value.isNotNull(), value + slope),
    )


def _with_trends(
    lined: DataFrame, value_cols: Sequence[str], along: WindowSpec, max_extrap: int, trend_points: int
) -> DataFrame:
    """Add the forward and backward continuation next to every interpolated column ``_s_c``."""
    reach = trend_points - 1
    sides = ((FORWARD, F.col("pos"), F.lag), (BACKWARD, F.col("n_pos") - 1 - F.col("pos"), F.lead))
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    far = {}
    for c in value_cols:
        # Near the border of the series the trend starts at its first or last cell,
        # which is the first or last row of the border chunk.
        border = {FORWARD: F.first(f"_s_{c}").over(so_far), BACKWARD: F.last(f"_s_{c}").over(whole)}
        for name, _, shift in sides:
            far[f"_far_{name}_{c}"] = shift(f"_s_{c}", reach).over(along)
            far[f"_border_{name}_{c}"] = border[name]
    # The slope points away from the trend's cells; it is NULL if there is no second cell.
    slopes = {
        f"_slope_{name}_{c}": F.when(
            room >= reach, (F.col(f"_s_{c}") - F.col(f"_far_{name}_{c}")) / F.lit(reach)
        ).when(room > 0, (F.col(f"_s_{c}") - F.col(f"_border_{name}_{c}")) / room)
        for c in value_cols
        for name, room, _ in sides
    }
    near = {
        f"_near{d}_{what}_{name}_{c}": shift(source, d).over(along)
        for c in value_cols
        for name, _, shift in sides
        for d in range(1, max_extrap + 1)
        for what, source in (("v", f"_s_{c}"), ("m", f"_slope_{name}_{c}"))
    }
    edges = {
        f"_{name}_{c}": _continued(
            [
                (F.col(f"_near{d}_v_{name}_{c}"), F.col(f"_near{d}_m_{name}_{c}"))
                for d in range(1, max_extrap + 1)
            ]
        )
        for c in value_cols
        for name, *_ in sides
    }
    return lined.withColumns(far).withColumns(slopes).withColumns(near).withColumns(edges)


def fill_gaps(
    obs: DataFrame,
    value_cols: Sequence[str] = ("value",),
    series_keys: Sequence[str] = ("station_id",),
    axis_keys: Sequence[str] = ("year",),
    time: str = "time",
    max_gap: int = MAX_GAP,
    max_extrap: int = MAX_EXTRAP,
    trend_points: int = TREND_POINTS,
    chunk_cells: int = CHUNK_CELLS,
    carried: Sequence[str] = (),
    step_seconds: int = STEP_SECONDS,
    calendar: bool = False,
) -> DataFrame:
    """Densify, interpolate and extrapolate every value column.

    The steps of a group are those that any of its stations reports, or with ``calendar`` all steps of its
    calendar years. Columns in ``carried`` travel along unfilled. Returns ``axis_keys,
    series_keys, time, pos``, these, and per value column ``c`` the
    filled ``c`` plus ``c_method``, one of ``observed``, ``interpolated``,
    ``extrapolated_forward``, ``extrapolated_backward`` and ``missing``.
    Wide tables pass all their variables at once and are shuffled once.

    Trends read the series as it is after interpolation. As long as ``max_gap``
    >= ``max_extrap + trend_points - 2`` (4 with the defaults) no trend can
    reach a cell that was extrapolated, so this equals filling the runs one
    after another from left to right.
    """
    keys = [*axis_keys, *series_keys]
    halo = max_gap + max_extrap + trend_points
    axis = time_axis(obs, axis_keys, time, step_seconds, calendar)
    cells = grid_cells(obs, axis, [*value_cols, *carried], series_keys, axis_keys, time, halo, chunk_cells, step_seconds)
    along = Window.partitionBy(*keys, "chunk").orderBy("pos")

    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    ahead = along.rowsBetween(0, max_gap)
    near, straight = {}, {}
    for c in value_cols:
        at = F.when(F.col(c).isNotNull(), F.col("pos"))
        near[f"_lp_{c}"] = F.last(at, ignorenulls=True).over(so_far)
        near[f"_lv_{c}"] = F.last(c, ignorenulls=True).over(so_far)
        near[f"_rp_{c}"] = F.first(at, ignorenulls=True).over(ahead)
        near[f"_rv_{c}"] = F.first(c, ignorenulls=True).over(ahead)
        lp, lv, rp, rv = (F.col(f"_{n}_{c}") for n in ("lp", "lv", "rp", "rv"))
        on_line = lv + (rv - lv) * (F.col("pos") - lp) / (rp - lp)
        straight[f"_s_{c}"] = F.coalesce(c, F.when((rp - lp > 1) & (rp - lp - 1 <= max_gap), on_line))
    lined = cells.withColumns(near).withColumns(straight)

    if max_extrap > 0:
        lined = _with_trends(lined, value_cols, along, max_extrap, trend_points)

    filled = []
    for c in value_cols:
        steps = [(OBSERVED, F.col(c)), (INTERPOLATED, F.col(f"_s_{c}"))]
        if max_extrap > 0:
            steps += [(FORWARD, F.col(f"_{FORWARD}_{c}")), (BACKWARD, F.col(f"_{BACKWARD}_{c}"))]
        method = reduce(
            lambda acc, s: acc.when(s[1].isNotNull(), s[0]), steps[1:], F.when(steps[0][1].isNotNull(), steps[0][0])
        ).otherwise(MISSING)
        filled += [F.coalesce(*[s[1] for s in steps]).alias(c), method.alias(f"{c}_method")]

    own = F.floor(F.col("pos") / F.lit(chunk_cells)) == F.col("chunk")
    return lined.filter(own).select(*keys, slot_time(step_seconds).alias(time), "pos", *carried, *filled)


def interpolate(obs: DataFrame, max_gap: int = MAX_GAP, **options) -> DataFrame:
    """Only the straight-line part of :func:`fill_gaps`."""
    return fill_gaps(obs, max_gap=max_gap, max_extrap=0, **options)


def fill_stats(
    filled: DataFrame,
    value_cols: Sequence[str] = ("value",),
    axis_keys: Sequence[str] = ("year",),
    existing: DataFrame | None = None,
) -> DataFrame:
    """Fill counts per axis group and variable: each cell is counted once, by its method.

    ``existing`` limits the counts to the axis groups and variables it lists,
    because a column of a wide table is there in all years.
    """
    by_method = [
        F.count_if(F.col(f"{c}_method") == m).alias(f"{c}|{m}")
        for c in value_cols
        for m in (OBSERVED, INTERPOLATED, FORWARD, BACKWARD, MISSING)
    ]
    wide = filled.groupBy(*axis_keys).agg(*by_method)
    per_variable = F.array(
        *[
            F.struct(
                F.lit(c).alias("variable"),
                *[F.col(f"{c}|{m}").alias(m) for m in (OBSERVED, INTERPOLATED, FORWARD, BACKWARD, MISSING)],
            )
            for c in value_cols
        ]
    )
    counts = wide.select(*axis_keys, F.inline(per_variable))
    if existing is not None:
        counts = counts.join(existing, [*axis_keys, "variable"], "left_semi")
    return (
        counts.withColumn("missing_before", F.col(INTERPOLATED) + F.col(FORWARD) + F.col(BACKWARD) + F.col(MISSING))
        .select(
            *axis_keys,
            "variable",
            "missing_before",
            F.col(INTERPOLATED).alias("n_interpolated"),
            F.col(FORWARD).alias("n_forward"),
            F.col(BACKWARD).alias("n_backward"),
            F.col(MISSING).alias("missing_after"),
        )
    )


def _pooled(grouped, *extra: Column) -> DataFrame:
    done = F.col("n_interpolated") + F.col("n_extrapolated")
    return grouped.agg(
        F.sum("missing_before").alias("missing_before"),
        F.sum("n_interpolated").alias("n_interpolated"),
        F.sum(F.col("n_forward") + F.col("n_backward")).alias("n_extrapolated"),
        F.sum("missing_after").alias("missing_after"),
        *extra,
    ).withColumn("success_pct", F.when(F.col("missing_before") > 0, done / F.col("missing_before") * 100.0))


def pooled_fill_stats(stats: DataFrame) -> DataFrame:
    """Fill counts per variable over all groups, with success share, its band and rank."""
    share = F.col("success_pct")
    pooled = _pooled(stats.groupBy("variable")).withColumn("band", band(share, share > 50, share > 10))
    return with_rank(pooled, share.desc())


def fill_report(stats: DataFrame, axis_key: str = "year") -> DataFrame:
    """Rows per group and variable, totals per group (``variable`` is NULL) and over all groups."""
    return _pooled(stats.rollup(axis_key, "variable"), F.grouping_id(axis_key, "variable").alias("level"))


def overall_fill_stats(stats: DataFrame) -> DataFrame:
    """One row: totals, success share and how the filled cells split over the methods."""
    done = F.col("n_interpolated") + F.col("n_extrapolated")
    share = lambda part: F.when(done > 0, F.col(part) / done * 100.0).otherwise(0.0)
    return _pooled(stats.groupBy()).withColumns(
        {"interpolated_pct": share("n_interpolated"), "extrapolated_pct": share("n_extrapolated")}
    )
