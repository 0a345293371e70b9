"""Overlaps, holes and misaligned content of files that announce a date interval.

The catalog is a table ``fold, station_id, start_date, end_date`` with one row
per file. Files with the same interval are counted first; what is sorted are
the distinct intervals of a station, cut into stretches of start dates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeloom.config import DAY_SECONDS, STEP_SECONDS
from gaugeloom.functions.times import chunk_of, day_start, plus_seconds, seconds_between
from gaugeloom.operators.chunks import with_neighbours
from gaugeloom.operators.grid import expand_steps

CHUNK_SECONDS = 32 * DAY_SECONDS
KEYS = ("fold", "station_id")
INTERVAL = ("start_date", "end_date")


def _distinct_intervals(catalog: DataFrame) -> DataFrame:
    return (
        catalog.groupBy(*KEYS, *INTERVAL)
        .agg(F.count(F.lit(1)).alias("n_files"))
        .withColumn("chunk", chunk_of(F.col("start_date"), CHUNK_SECONDS))
    )


def interval_pairs(catalog: DataFrame) -> DataFrame:
    """Neighbouring intervals of a station by start, with the seconds from end to start.

    Copies of an interval are neighbours of each other; ``n_pairs`` counts how
    many file pairs a row stands for.
    """
    distinct = _distinct_intervals(catalog)
    neighbours = (
        with_neighbours(distinct, KEYS, "chunk", INTERVAL, INTERVAL)
        .filter(F.col("previous").isNotNull())
        .select(
            *KEYS,
            F.col("previous.start_date").alias("prev_start"),
            F.col("previous.end_date").alias("prev_end"),
            *INTERVAL,
            F.lit(1).cast("bigint").alias("n_pairs"),
        )
    )
    copies = distinct.filter("n_files > 1").select(
        *KEYS,
        F.col("start_date").alias("prev_start"),
        F.col("end_date").alias("prev_end"),
        *INTERVAL,
        (F.col("n_files") - 1).alias("n_pairs"),
    )
    return neighbours.unionByName(copies).withColumn(
        "diff_seconds", seconds_between(F.col("prev_end"), F.col("start_date"))
    )


def overlap_intervals(catalog: DataFrame) -> DataFrame:
    """Pairs in which the later interval starts before the earlier one ends; touching is allowed."""
    return interval_pairs(catalog).filter("diff_seconds < 0")


def missing_intervals(catalog: DataFrame) -> DataFrame:
    """Pairs with more than one day between end and start."""
    return interval_pairs(catalog).filter(f"diff_seconds > {DAY_SECONDS}")


def overlap_losers(catalog: DataFrame) -> DataFrame:
    """Intervals that lose against a neighbour: the strictly shorter one, on a tie the earlier."""
    pairs = overlap_intervals(catalog)
    length = seconds_between(F.col("start_date"), F.col("end_date"))
    prev_length = seconds_between(F.col("prev_start"), F.col("prev_end"))
    later_loses = length < prev_length
    return pairs.select(
        *KEYS,
        F.when(later_loses, F.col("start_date")).otherwise(F.col("prev_start")).alias("start_date"),
        F.when(later_loses, F.col("end_date")).otherwise(F.col("prev_end")).alias("end_date"),
    ).distinct()


def resolve_overlaps(catalog: DataFrame) -> DataFrame:
    """The catalog without the losers; pairs are judged on the catalog as given."""
    return catalog.join(overlap_losers(catalog), [*KEYS, *INTERVAL], "left_anti")


def fill_missing_intervals(
    catalog: DataFrame,
    value_cols: Sequence[str] = (),
    step_seconds: int = STEP_SECONDS,
    parity_end: bool = False,
) -> DataFrame:
    """Placeholder rows with NULL values for every hole of the catalog.

    They run from one day after the end up to the step before the next start.
    ``parity_end`` stops one day earlier.
    """
    stop = DAY_SECONDS + step_seconds if parity_end else step_seconds
    spans = (
        missing_intervals(catalog)
        .select(
            *KEYS,
            plus_seconds(F.col("prev_end"), DAY_SECONDS).alias("hole_start"),
            plus_seconds(F.col("start_date"), -stop).alias("hole_end"),
        )
        .filter("hole_end >= hole_start")
    )
    rows = expand_steps(spans, "hole_start", "hole_end", "time", step_seconds)
    return rows.select(*KEYS, "time", *[F.lit(None).cast("double").alias(c) for c in value_cols])


def irregular_steps(
    rows: DataFrame,
    keys: Sequence[str] = ("file_id",),
    time: str = "time",
    order: str | None = None,
    step_seconds: int = STEP_SECONDS,
    chunk_rows: int = 65536,
) -> DataFrame:
    """Consecutive rows of a file that are not one step apart.

    Rows are taken by time, or by their position in the file if ``order`` names it.
    """
    chunk = chunk_of(F.col(time), CHUNK_SECONDS) if order is None else F.floor(F.col(order) / F.lit(chunk_rows))
    placed = rows.select(*dict.fromkeys([*keys, time, order or time])).withColumn("chunk", chunk)
    return (
        with_neighbours(placed, keys, "chunk", [order or time], [time])
        .withColumn("delta_seconds", seconds_between(F.col(f"previous.{time}"), F.col(time)))
        .filter(F.col("delta_seconds") != step_seconds)
        .select(*keys, F.col(f"previous.{time}").alias("prev_time"), time, "delta_seconds")
    )


def _minutes(seconds: Column) -> Column:
    return seconds / F.lit(60.0)


def alignment_check(
    rows: DataFrame,
    catalog: DataFrame,
    keys: Sequence[str] = ("file_id",),
    time: str = "time",
    order: str | None = None,
    step_seconds: int = STEP_SECONDS,
) -> DataFrame:
    """Files whose rows do not run from the first to the last step of the announced days."""
    position = order or time
    edges = rows.groupBy(*keys).agg(
        F.min_by(time, position).alias("first_time"), F.max_by(time, position).alias("last_time")
    )
    odd = (
        irregular_steps(rows, keys, time, order, step_seconds)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_irregular"), F.sum("delta_seconds").alias("delta_sum"))
    )
    last_step = DAY_SECONDS - step_seconds
    first, last = F.col("first_time"), F.col("last_time")
    expected_start = day_start(F.col("start_date"))
    expected_end = plus_seconds(day_start(F.col("end_date")), last_step)
    zero = F.lit(0).cast("bigint")
    checked = (
        catalog.join(edges, list(keys))
        .join(odd, list(keys), "left")
        .withColumns({"n_irregular": F.coalesce("n_irregular", zero), "delta_sum": F.coalesce("delta_sum", zero)})
        .withColumns(
            {
                "start_ok": first == day_start(first),
                "end_ok": last == plus_seconds(day_start(last), last_step),
                "date_range_ok": (day_start(first) == expected_start)
                & (day_start(last) == day_start(F.col("end_date"))),
                "missing_start": _minutes(seconds_between(expected_start, first)),
                "missing_end": _minutes(seconds_between(last, expected_end)),
                "missing_intermediate": _minutes(F.col("delta_sum")),
                "length_minutes": _minutes(seconds_between(first, last) - F.col("delta_sum")),
                "expected_length_minutes": _minutes(
                    seconds_between(F.col("start_date"), F.col("end_date")) + F.lit(last_step)
                ),
            }
        )
        .withColumns(
            {
                "missing_minutes": F.col("expected_length_minutes") - F.col("length_minutes"),
                "wrong_minutes": F.abs("missing_start") + F.abs("missing_end") + F.col("missing_intermediate"),
            }
        )
    )
    return checked.filter(~(F.col("start_ok") & F.col("end_ok") & F.col("date_range_ok")) | (F.col("n_irregular") > 0))


def concat_stations(rows: DataFrame, catalog: DataFrame, keys: Sequence[str] = ("file_id",)) -> DataFrame:
    """Rows of all files keyed by station; ``start_date`` and the file key are the reading order."""
    return rows.join(catalog.select(*KEYS, "start_date", *keys), list(keys))
