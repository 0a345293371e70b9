"""Completing station series to a regular or common time axis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeloom.config import DAY_SECONDS, STEP_SECONDS
from gaugeloom.functions.times import day_start, epoch_seconds, first_step, from_seconds, plus_seconds, seconds_between, year_start
from gaugeloom.session import stored

# Cells of a series that share a task; a series of any length is cut into such pieces.
CHUNK_CELLS = 4096


def slot_of(time: Column, step_seconds: int) -> Column:
    """Number of the step a time lies on, counted from the epoch; a time between two steps is an error."""
    seconds = epoch_seconds(time)
    off = F.raise_error(F.concat(F.lit(f"not on a step of {step_seconds} seconds: "), time.cast("string"))).cast("bigint")
    return F.when(F.pmod(seconds, F.lit(step_seconds)) == 0, F.floor(seconds / F.lit(step_seconds)).cast("bigint")).otherwise(off)


def time_axis(
    obs: DataFrame,
    axis_keys: Sequence[str] = ("year",),
    time: str = "time",
    step_seconds: int = STEP_SECONDS,
    calendar: bool = False,
) -> DataFrame:
    """One row per axis group: ``n_pos`` and the steps that belong to it, as words of 64 bits.

    The steps are those that any station reports, or with ``calendar`` all steps of the calendar years in
    which something is reported. ``words`` holds (word, bits, before) without holes from ``first_word`` on;
    ``before`` counts the steps in earlier words. So the position of a time follows
    from its step by arithmetic. Rows are few and short: ten years of 10-minute steps take some hundred kilobytes.
    """
    keys = list(axis_keys)
    if calendar:
        edge = lambda year: first_step(year_start(year), step_seconds)
        years = obs.filter(F.col(time).isNotNull()).select(*keys, F.year(time).alias("_year")).distinct()
        spans = years.select(*keys, edge(F.col("_year")).alias("_first"), (edge(F.col("_year") + 1) - 1).alias("_last")).filter("_first <= _last")
        word = lambda c: F.floor(F.col(c) / F.lit(64)).cast("bigint")
        parts = spans.withColumn("word", F.explode(F.sequence(word("_first"), word("_last"))))
        lo = F.greatest(F.col("_first") - F.col("word") * 64, F.lit(0)).cast("int")
        hi = F.least(F.col("_last") - F.col("word") * 64, F.lit(63)).cast("int")
        some = F.call_function("shiftleft", F.call_function("shiftrightunsigned", F.lit(-1).cast("bigint"), F.lit(63) - hi + lo), lo)
        parts = parts.select(*keys, "word", some.alias("bits"))
    else:
        slot = obs.filter(F.col(time).isNotNull()).select(*keys, slot_of(F.col(time), step_seconds).alias("_slot"))
        bit = F.pmod("_slot", F.lit(64)).cast("int")
        parts = slot.select(*keys, F.floor(F.col("_slot") / F.lit(64)).cast("bigint").alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("bits"))
    group = Window.partitionBy(*keys)
    size = F.bit_count("bits").cast("bigint")
    counted = (
        parts.groupBy(*keys, "word")
        .agg(F.bit_or("bits").alias("bits"))
        .withColumn("before", F.sum(size).over(group.orderBy("word")) - size)
        .withColumn("n_pos", F.sum(size).over(group).cast("int"))
    )
    entries = F.map_from_entries(F.collect_list(F.struct("word", F.struct("word", "bits", F.col("before").cast("int").alias("before")))))
    axis = counted.groupBy(*keys, "n_pos").agg(entries.alias("_entries"), F.min("word").alias("first_word"), F.max("word").alias("_last"))
    words = F.transform(F.sequence("first_word", "_last"), lambda w: F.element_at("_entries", w))
    return stored(axis.select(*keys, "n_pos", "first_word", words.alias("words")), "axis")


def placed(obs: DataFrame, axis: DataFrame, axis_keys: Sequence[str], time: str, step_seconds: int) -> DataFrame:
    """The rows with their step ``slot``, its position ``pos`` and the axis length ``n_pos``; rows without a time drop out."""
    given = obs.filter(F.col(time).isNotNull()).withColumn("slot", slot_of(F.col(time), step_seconds))
    bit = F.pmod("slot", F.lit(64)).cast("int")
    entry = F.get("words", (F.floor(F.col("slot") / F.lit(64)) - F.col("first_word")).cast("int"))
    lower = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("bigint"), bit))
    pos = entry.before + F.bit_count(entry.bits.bitwiseAND(lower))
    return given.join(axis, list(axis_keys)).select(*obs.columns, "slot", pos.cast("int").alias("pos"), "n_pos")


def grid_cells(
    obs: DataFrame,
    axis: DataFrame,
    value_cols: Sequence[str],
    series_keys: Sequence[str] = ("station_id",),
    axis_keys: Sequence[str] = ("year",),
    time: str = "time",
    halo: int = 0,
    chunk_cells: int = CHUNK_CELLS,
    step_seconds: int = STEP_SECONDS,
) -> DataFrame:
    """Dense cells ``axis_keys, series_keys, chunk, pos, n_pos, slot, value_cols``.

    Observations and one skeleton row per series chunk are shuffled together;
    the skeleton is blown up to cells only after the shuffle, so absent cells
    never travel. Each cell knows its step, so no time is looked up. With ``halo`` > 0 a chunk also holds that many cells of its
    neighbours, for operators that look a bounded distance left and right.
    """
    keys = [*axis_keys, *series_keys]
    size = F.lit(chunk_cells)
    last_chunk = ((F.col("n_pos") - 1) / size).cast("int")
    part = "array<struct<word:bigint,bits:bigint,before:int>>"

    here = placed(obs.select(*keys, time, *value_cols), axis, axis_keys, time, step_seconds)
    first_home = F.greatest(F.lit(0), F.floor((F.col("pos") - halo) / size).cast("int"))
    last_home = F.least(last_chunk, F.floor((F.col("pos") + halo) / size).cast("int"))
    if halo:
        here = here.withColumn("chunk", F.explode(F.sequence(first_home, last_home)))
    else:
        here = here.withColumn("chunk", F.floor(F.col("pos") / size).cast("int"))
    here = here.select(
        *keys, "chunk", "n_pos", F.col("pos").alias("_lo"), F.col("pos").alias("_hi"), F.col("pos").alias("_from"),
        F.col("slot").alias("_slot"), F.lit(None).cast(part).alias("_words"), *value_cols,
    )

    lo = F.greatest(F.lit(0), F.col("chunk") * size - halo)
    hi = F.least(F.col("n_pos"), (F.col("chunk") + 1) * size + halo) - 1
    inside = F.filter("words", lambda w: w.isNotNull() & (w.before <= F.col("_hi")) & (w.before + F.bit_count(w.bits) > F.col("_lo")))
    chunks = (
        axis.withColumn("chunk", F.explode(F.sequence(F.lit(0), last_chunk)))
        .withColumns({"_lo": lo.cast("int"), "_hi": hi.cast("int")})
        .select(*axis_keys, "chunk", "n_pos", "_lo", "_hi", inside.alias("_words"))
    )
    types = dict(obs.dtypes)
    skeleton = (
        obs.filter(F.col(time).isNotNull())
        .select(*keys)
        .distinct()
        .join(chunks, list(axis_keys))
        .select(
            *keys, "chunk", "n_pos", "_lo", "_hi", F.get("_words", F.lit(0)).before.alias("_from"), F.lit(None).cast("bigint").alias("_slot"),
            F.col("_words").cast(part).alias("_words"), *[F.lit(None).cast(types[c]).alias(c) for c in value_cols],
        )
    )
    bits = F.sequence(F.lit(0).cast("bigint"), F.lit(63).cast("bigint"))
    is_set = lambda w, b: F.call_function("getbit", w.bits, b.cast("int")) == 1
    steps = F.flatten(F.transform("_words", lambda w: F.transform(F.filter(bits, lambda b: is_set(w, b)), lambda b: w.word * 64 + b)))
    # A fixed number of partitions: the cells outgrow what the shuffle saw, so
    # merging partitions by shuffled size would make the tasks too large.
    tasks = int(obs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        here.unionByName(skeleton)
        .repartition(tasks, *keys, "chunk")
        .select("*", F.posexplode(F.when(F.col("_slot").isNotNull(), F.array("_slot")).otherwise(steps)).alias("_at", "slot"))
        .withColumn("pos", F.col("_from") + F.col("_at"))
        .filter("pos BETWEEN _lo AND _hi")
        .groupBy(*keys, "chunk", "pos", "n_pos", "slot")
        .agg(*[F.max(c).alias(c) for c in value_cols])
    )


def slot_time(step_seconds: int) -> Column:
    """The time of a cell's step."""
    return from_seconds(F.col("slot") * F.lit(step_seconds))


def densify_grid(
    obs: DataFrame,
    value_cols: Sequence[str],
    series_keys: Sequence[str] = ("station_id",),
    axis_keys: Sequence[str] = ("year",),
    time: str = "time",
    step_seconds: int = STEP_SECONDS,
    calendar: bool = False,
) -> DataFrame:
    """Every station of an axis group at every step of that group; absent cells are NULL.

    The steps of a group are those that any of its stations reports, or with
    ``calendar`` all steps of its calendar years, also those that nobody reported.
    """
    axis = time_axis(obs, axis_keys, time, step_seconds, calendar)
    cells = grid_cells(obs, axis, value_cols, series_keys, axis_keys, time, step_seconds=step_seconds)
    return cells.select(*axis_keys, *series_keys, slot_time(step_seconds).alias(time), "pos", *value_cols)


def expand_steps(
    spans: DataFrame,
    start: str,
    end: str,
    time: str = "time",
    step_seconds: int = STEP_SECONDS,
) -> DataFrame:
    """One row per step from ``start`` to ``end``, both included.

    A span is first cut into pieces of a few thousand steps that are spread over
    the cluster, and only then blown up, so a very long span does not stay in
    one task.
    """
    carried = spans.columns
    tasks = int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = CHUNK_CELLS * step_seconds
    pieces = F.floor(seconds_between(F.col(start), F.col(end)) / F.lit(width)).cast("int")
    piece_start = plus_seconds(F.col(start), F.col("_piece") * F.lit(width))
    piece_len = F.least(
        F.lit(width - step_seconds),
        seconds_between(piece_start, F.col(end)),
    )
    steps = F.sequence(F.lit(0), F.floor(piece_len / F.lit(step_seconds)).cast("int"))
    return (
        spans.filter(F.col(end) >= F.col(start))
        .withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces)))
        .repartition(tasks, *carried, "_piece")
        .withColumn("_at", piece_start)
        .withColumn("_step", F.explode(steps))
        .withColumn(time, plus_seconds(F.col("_at"), F.col("_step") * F.lit(step_seconds)))
        .select(*carried, time)
    )


def regularize_interval(
    rows: DataFrame,
    announced: DataFrame,
    value_cols: Sequence[str],
    keys: Sequence[str] = ("file_id",),
    start: str = "start_date",
    end: str = "end_date",
    time: str = "time",
    step_seconds: int = STEP_SECONDS,
) -> DataFrame:
    """Rows of a file on exactly the steps its name announces.

    ``announced`` holds one interval per file; the last step is the last one of
    the end day. Missing steps are inserted with NULL values, rows outside the
    interval or off the step are dropped. ``is_inserted`` tells them apart.
    """
    spans = announced.select(
        *keys,
        day_start(F.col(start)).alias("_first"),
        plus_seconds(day_start(F.col(end)), DAY_SECONDS - step_seconds).alias("_last"),
    )
    steps = expand_steps(spans, "_first", "_last", time, step_seconds).select(*keys, time)
    measured = rows.select(*keys, time, *value_cols).withColumn("_measured", F.lit(True))
    return steps.join(measured, [*keys, time], "left").select(
        *keys, time, *value_cols, F.col("_measured").isNull().alias("is_inserted")
    )


def join_station(obs: DataFrame, stations: DataFrame, station: str = "station_id") -> DataFrame:
    """Left join with the station dimension, which must hold one row per station."""
    return obs.join(stations, station, "left")


def station_constants(
    merged: DataFrame,
    constants: Sequence[str] = ("latitude", "longitude", "height"),
    station: str = "station_id",
    time: str = "time",
) -> DataFrame:
    """First non-missing value of every constant along a station's time axis."""
    return merged.groupBy(station).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(time))).alias(c) for c in constants]
    )


def station_dedupe(
    stations: DataFrame,
    station: str = "station_id",
    ordinal: str = "ordinal",
    required: Sequence[str] = ("latitude", "longitude"),
) -> DataFrame:
    """First row of every station by ``ordinal``; stations without coordinates drop out."""
    others = [c for c in stations.columns if c != station]
    return (
        stations.groupBy(station)
        .agg(F.min_by(F.struct(*others), ordinal).alias("_row"))
        .select(station, "_row.*")
        .dropna(subset=list(required))
    )
