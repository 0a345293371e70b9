"""Fixed values of the station-observation domain.

The numbers below are domain constants that every run must share; all of them
can be overridden by passing another mapping or DataFrame to the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Physically plausible range per variable, both ends inclusive.
BOUNDS: dict[str, tuple[float, float]] = {
    "TX_10": (-50.0, 45.0),
    "TX5_10": (-50.0, 45.0),
    "TN_10": (-50.0, 45.0),
    "TN5_10": (-50.0, 45.0),
    "TT_10": (-50.0, 45.0),
    "TM5_10": (-50.0, 45.0),
    "TD_10": (-20.0, 40.0),
    "FF_10": (0.0, 45.0),
    "FX_10": (0.0, 55.0),
    "FNX_10": (0.0, 55.0),
    "FMX_10": (0.0, 55.0),
    "DD_10": (0.0, 360.0),
    "DX_10": (0.0, 360.0),
    "RWS_10": (0.0, 100.0),
    "RWS_DAU_10": (0.0, 10.0),
    "RWS_IND_10": (0.0, 3.0),
    "PP_10": (600.0, 1100.0),
    "RF_10": (5.0, 100.0),
    "GS_10": (0.0, 500.0),
    "DS_10": (0.0, 350.0),
    "SD_10": (0.0, 600.0),
    "LS_10": (0.0, 500.0),
    "latitude": (46.0, 56.0),
    "longitude": (5.0, 16.0),
    "height": (-50.0, 3000.0),
}

# Largest plausible change between consecutive valid values.
MAX_CHANGE: dict[str, float] = {
    "TU": 5.0,
    "TX_10": 5.0,
    "TX5_10": 5.0,
    "TN_10": 5.0,
    "TN5_10": 5.0,
    "TT_10": 5.0,
    "TM5_10": 5.0,
    "TD_10": 5.0,
    "FF_10": 30.0,
    "FX_10": 40.0,
    "FNX_10": 40.0,
    "FMX_10": 40.0,
    "PP_10": 5.0,
    "RF_10": 30.0,
}

# Measured columns of each category of raw files, in file order.
FOLD_COLUMNS: dict[str, list[str]] = {
    "air_temp": ["QN", "PP_10", "TT_10", "TM5_10", "RF_10", "TD_10", "eor"],
    "ex_temp": ["QN", "TX_10", "TX5_10", "TN_10", "TN5_10"],
    "ex_wind": ["QN", "FX_10", "FNX_10", "FMX_10", "DX_10"],
    "precip": ["QN", "RWS_DAU_10", "RWS_10", "RWS_IND_10"],
    "solar": ["QN", "DS_10", "GS_10", "SD_10", "LS_10"],
    "wind": ["QN", "FF_10", "DD_10", "eor"],
}

# Columns that describe a row or a station instead of the weather.
CHECK_EXEMPT = ("height", "latitude", "longitude", "QN", "eor")
FILL_EXEMPT = ("height", "latitude", "longitude", "QN")

SENTINEL = -999.0
STEP_SECONDS = 600
DAY_SECONDS = 86400

MIN_VALUES_STATION_YEAR = 30
MIN_YEARS = 2
MIN_VALUES_VARIANCE = 10
MIN_STATIONS_VARIANCE = 2
MIN_VALUES_DISTRIBUTION = 20
ALPHA = 0.05
MAX_MISSING_PCT = 90.0
ENOUGH_ROWS_RATIO = 0.8
MAX_GAP = 6
MAX_EXTRAP = 2
TREND_POINTS = 4
HISTOGRAM_YEARS = 35


def bounds_frame(spark: SparkSession, bounds: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """The bounds as a table ``(variable, lo, hi)``; one row per variable, so it may be broadcast."""
    rows = [(v, float(lo), float(hi)) for v, (lo, hi) in (BOUNDS if bounds is None else bounds).items()]
    return spark.createDataFrame(rows, "variable string, lo double, hi double")


def change_frame(spark: SparkSession, limits: dict[str, float] | None = None) -> DataFrame:
    """The jump limits as a table ``(variable, threshold)``; one row per variable."""
    rows = [(v, float(t)) for v, t in (MAX_CHANGE if limits is None else limits).items()]
    return spark.createDataFrame(rows, "variable string, threshold double")
