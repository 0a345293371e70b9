"""Semicolon-separated observation files and station metadata files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeloom.config import FOLD_COLUMNS, SENTINEL
from gaugeloom.functions.scalar import lenient_double, parse_time, without_sentinel
from gaugeloom.sources import station_text
from gaugeloom.sources.catalog import FILE_PATTERN

KEY_COLUMNS = ("STATIONS_ID", "MESS_DATUM")
# Header names of the station metadata files and the names they get.
STATION_COLUMNS = {
    "Stations_id": "station_id",
    "Geogr.Breite": "latitude",
    "Geogr.Laenge": "longitude",
    "Stationshoehe": "height",
}


def latin1_text(raw: Column) -> Column:
    """Text of a line that was read as raw bytes."""
    return F.decode(raw.cast("binary"), "ISO-8859-1")


def all_columns(spark: SparkSession, path: str | list[str], first: str = KEY_COLUMNS[0]) -> list[str]:
    """Column names of all files; the layouts of many files are few, and one row per layout reaches the driver."""
    layouts = station_text.headers(spark, path).select("header").distinct().collect()
    named = sorted(r.header for r in layouts if r.header[0].upper() == first)
    if not named:
        raise ValueError("no file has a header line")
    names: dict[str, str] = {}
    for header in named:
        for c in header:
            names.setdefault(c.upper(), c)
    return list(names.values())


def scan_delimited(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Text columns of observation files, each found by its name in the header of its own file.

    Without ``columns`` all columns that any file has are read. A column that a
    file lacks is NULL in its rows, as are the missing fields of a short line.
    Lines with more fields than the header of their file are left out; :func:`count_rejects` counts them.
    """
    wanted = list(columns or all_columns(spark, path))
    return station_text.scan(spark, path, wanted).filter(~F.col("rejected")).select("file_name", *wanted)


def count_rejects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file_path, n_rows, n_rejected) of every file with rows: lines that are read and lines with too many fields."""
    rows = station_text.scan(spark, path, list(KEY_COLUMNS))
    return rows.groupBy("file_path").agg(F.count_if(~F.col("rejected")).alias("n_rows"), F.count_if("rejected").alias("n_rejected"))


def typed_observations(text: DataFrame, value_cols: Sequence[str], sentinel: float = SENTINEL) -> DataFrame:
    """Station, time and numeric values of scanned text; rows without a readable time drop out."""
    others = [c for c in text.columns if c not in (*KEY_COLUMNS, *value_cols)]
    return (
        text.select(
            *others,
            F.trim(F.col(KEY_COLUMNS[0])).try_cast("bigint").alias("station_id"),
            parse_time(F.col(KEY_COLUMNS[1])).alias("time"),
            *[without_sentinel(lenient_double(F.col(c)), sentinel).alias(c) for c in value_cols],
        )
        .filter(F.col("time").isNotNull())
        .withColumn("year", F.year("time"))
    )


def reading_order(fold: str, file_name: Column, place: Column) -> Column:
    """Rank of a row among rows of the same station and time: category, start date of the file, place in the file."""
    rank = sorted(FOLD_COLUMNS).index(fold) * 100_000_000
    start = F.coalesce(F.regexp_extract(file_name, FILE_PATTERN, 1).try_cast("bigint"), F.lit(0))
    return (F.lit(rank) + start) * F.lit(1 << 33) + F.least(place, F.lit((1 << 33) - 1))


def read_fold(spark: SparkSession, path: str | list[str], fold: str, years: Sequence[int] | None = None) -> DataFrame:
    """Typed observations of one measurement category, ready to be merged with others.

    Files may order their columns differently, lack some or hold others. Of
    several rows for one station and time the one further up in its file ranks first. With
    ``years`` only rows of these years are read.
    """
    measured = FOLD_COLUMNS[fold]
    rows = station_text.scan(spark, path, [*KEY_COLUMNS, *measured]).filter(~F.col("rejected"))
    if years is not None:
        rows = rows.filter(F.col("year").isin(*years))
    ranked = rows.withColumn("order_key", reading_order(fold, F.col("file_name"), F.col("place")))
    return typed_observations(ranked.drop("file_path", "place", "year", "rejected"), measured).withColumn("fold", F.lit(fold))


def station_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Last physical row of every station metadata file, reduced to id and position."""
    raw = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    rows = F.filter(F.split(latin1_text(F.col("value")), "\r?\n"), lambda r: F.trim(r) != "")
    parsed = raw.select(F.col("_metadata.file_name").alias("file_name"), rows.alias("rows")).select(
        "file_name",
        F.transform(F.split(F.get("rows", F.lit(0)), ";", -1), lambda x: F.trim(x)).alias("header"),
        F.transform(F.split(F.element_at("rows", -1), ";", -1), lambda x: F.trim(x)).alias("last"),
    )

    def field(name: str) -> Column:
        return lenient_double(F.get("last", F.array_position("header", F.lit(name)).cast("int") - 1))

    return parsed.select(
        "file_name",
        *[(field(n).cast("bigint") if new == "station_id" else field(n)).alias(new) for n, new in STATION_COLUMNS.items()],
    )


def station_latest(
    versions: DataFrame,
    station: str = "station_id",
    ordinal: str = "ordinal",
    values: Sequence[str] = ("latitude", "longitude", "height"),
) -> DataFrame:
    """Last row of every station by ``ordinal``, its NULLs included."""
    return versions.groupBy(station).agg(
        F.max(ordinal).alias(ordinal), *[F.max_by(c, ordinal).alias(c) for c in values]
    )
