"""Zone-free arithmetic on ``timestamp_ntz`` columns, in whole seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeloom.config import DAY_SECONDS


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_seconds(t: Column) -> Column:
    return F.timestamp_diff("SECOND", _epoch(), t)


def from_seconds(seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, _epoch())


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def plus_seconds(t: Column, seconds: Column | int) -> Column:
    return F.timestamp_add("SECOND", F.lit(seconds) if isinstance(seconds, int) else seconds, t)


def floor_seconds(t: Column, step: int) -> Column:
    """Round a time down to a multiple of ``step`` counted from the epoch."""
    s = epoch_seconds(t)
    return from_seconds(s - F.pmod(s, F.lit(step)))


def day_start(t: Column) -> Column:
    return floor_seconds(t, DAY_SECONDS)


def chunk_of(t: Column, seconds: int) -> Column:
    """Number of the fixed-width stretch of time that ``t`` falls into."""
    s = epoch_seconds(t)
    return F.floor(s / F.lit(seconds)).cast("bigint")


def year_start(year: Column) -> Column:
    return F.make_timestamp_ntz(year, *[F.lit(n) for n in (1, 1, 0, 0, 0)])


def first_step(t: Column, step_seconds: int) -> Column:
    """Number of the first step at or after a time, counted from the epoch."""
    return F.ceil(epoch_seconds(t) / F.lit(step_seconds)).cast("bigint")


def calendar_steps(year: Column, step_seconds: int) -> Column:
    """Number of steps in a calendar year."""
    return first_step(year_start(year + 1), step_seconds) - first_step(year_start(year), step_seconds)
