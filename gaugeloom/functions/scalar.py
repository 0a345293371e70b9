"""Column expressions and row-wise filters; all of them stay inside code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from gaugeloom.config import BOUNDS, SENTINEL
from gaugeloom.session import small

Bounds = Mapping[str, tuple[float, float]]


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of the numeric columns, in table order."""
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType) and f.name not in exclude]


def trimmed_names(df: DataFrame) -> DataFrame:
    """Column names without the blanks that padded headers carry."""
    return df.toDF(*[c.strip() for c in df.columns])


# --- single columns ---------------------------------------------------------


def lenient_double(text: Column) -> Column:
    """Number in a padded text field; anything that is no number becomes NULL, and so does NaN."""
    bare = F.trim(text)
    # The JVM also reads "1.5d" and "1.5f" as numbers.
    suffixed = F.lower(F.right(bare, F.lit(1))).isin("d", "f") & ~F.lower(bare).endswith("inf")
    number = F.when(~suffixed, bare.try_cast("double"))
    return F.when(~F.isnan(number), number)


def without_sentinel(value: Column, sentinel: float = SENTINEL) -> Column:
    return F.nullif(value, F.lit(sentinel))


def parse_time(text: Column) -> Column:
    """Time from ``yyyyMMddHHmm``; shorter text is zero-padded on the left, other text gives NULL.

    Built from its digits, so the session's time zone has no say.
    """
    bare = F.trim(text)
    iso = F.lpad(bare, 12, "0")
    for mark, position in ((":", 11), (" ", 9), ("-", 7), ("-", 5)):
        iso = F.overlay(iso, F.lit(mark), position, 0)
    only_digits = (F.length(bare) <= 12) & (F.translate(bare, "0123456789", "") == "")
    return F.when(only_digits, iso.try_cast("timestamp_ntz"))


def parse_day(text: Column) -> Column:
    """Midnight of a ``yyyyMMdd`` day; other text gives NULL."""
    return parse_time(F.when(F.trim(text).rlike("^[0-9]{8}$"), F.rpad(F.trim(text), 12, "0")))


def without_infinity(value: Column) -> Column:
    return F.when(F.abs(value) != float("inf"), value)


def inside(value: Column, lo: Column | float, hi: Column | float) -> Column:
    """The value if it lies within the bounds, both included; an absent bound does not limit."""
    lo, hi = (b if isinstance(b, Column) else F.lit(b) for b in (lo, hi))
    return F.when((value < lo) | (value > hi), F.lit(None)).otherwise(value)


def clipped(value: Column, lo: Column | float, hi: Column | float) -> Column:
    """The value moved to the nearest bound; NULL stays NULL."""
    lo, hi = (b if isinstance(b, Column) else F.lit(b) for b in (lo, hi))
    return F.when(value.isNotNull(), F.greatest(lo, F.least(hi, value)))


def band(metric: Column, good: Column, fair: Column) -> Column:
    """Traffic light: ``good`` and ``fair`` are conditions on the metric, tried in this order."""
    return F.when(metric.isNull(), F.lit(None)).when(good, "green").when(fair, "yellow").otherwise("red")


# --- wide tables ------------------------------------------------------------


def cast_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: lenient_double(F.col(c)) for c in cols})


def sentinel_to_null(df: DataFrame, cols: Sequence[str], sentinel: float = SENTINEL) -> DataFrame:
    return df.withColumns({c: without_sentinel(F.col(c), sentinel) for c in cols})


def filter_inf(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = numeric_columns(df) if cols is None else cols
    floating = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    return df.withColumns({c: without_infinity(F.col(c)) for c in cols if c in floating})


def filter_range(df: DataFrame, bounds: Bounds = BOUNDS, replace_with_null: bool = True) -> DataFrame:
    """Out-of-range values become NULL, or are clipped; columns without bounds are untouched."""
    rule = inside if replace_with_null else clipped
    hit = {c: rule(F.col(c), *bounds[c]) for c in df.columns if c in bounds}
    return df.withColumns(hit) if hit else df


def apply_filters(
    df: DataFrame, bounds: Bounds = BOUNDS, use_inf: bool = True, use_range: bool = True
) -> DataFrame:
    df = filter_inf(df) if use_inf else df
    return filter_range(df, bounds) if use_range else df


# --- long tables (variable, value) --------------------------------------------


def cleaned_long(
    df: DataFrame,
    bounds: DataFrame,
    use_inf: bool = True,
    use_range: bool = True,
    replace_with_null: bool = True,
    value: str = "value",
    out: str = "value",
) -> DataFrame:
    """The same filters on a long table; ``bounds`` has one row per variable and is broadcast."""
    cleaned = F.col(value)
    if use_inf:
        cleaned = without_infinity(cleaned)
    if not use_range:
        return df.withColumn(out, cleaned)
    if replace_with_null:
        cleaned = inside(cleaned, F.col("lo"), F.col("hi"))
    else:
        cleaned = F.coalesce(clipped(cleaned, F.col("lo"), F.col("hi")), cleaned)
    return df.join(small(bounds), "variable", "left").withColumn(out, cleaned).drop("lo", "hi")


# --- years ----------------------------------------------------------------------


def year_slice(df: DataFrame, year: int, time: str = "time") -> DataFrame:
    """Rows of one year, as a range on the time column so that it reaches the scan."""
    first, last = (F.lit(f"{y}-01-01 00:00:00").cast("timestamp_ntz") for y in (year, year + 1))
    return df.filter((F.col(time) >= first) & (F.col(time) < last))


def files_of_year(catalog: DataFrame, year: int) -> DataFrame:
    """Files whose interval touches the year."""
    first, last = (F.lit(d).cast("timestamp_ntz") for d in (f"{year}-01-01", f"{year}-12-31"))
    return catalog.filter((F.col("start_date") <= last) & (F.col("end_date") >= first))
