import datetime as dt

import pytest
from pyspark.sql import functions as F

from gaugeloom.functions import scalar
from gaugeloom.operators import merge


def one(spark, expr_of, values, kind):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr_of(F.col("v"))).collect()]


def test_lenient_double(spark):
    texts = ["  1.5 ", "-999", "eor", "", None, "Infinity", "-inf", "NaN", "1e3", "1.5d", "2f"]
    assert one(spark, scalar.lenient_double, texts, "string") == [
        1.5, -999.0, None, None, None, float("inf"), float("-inf"), None, 1000.0, None, None,
    ]


def test_cast_before_sentinel_catches_text_sentinels(spark):
    both = lambda c: scalar.without_sentinel(scalar.lenient_double(c))
    assert one(spark, both, [" -999", "-999.0", "7"], "string") == [None, None, 7.0]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_parse_time_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["202403310230", " 202401011200", "bad", "2024010112000", "202413010000", "1", None, "20240101120a"]
        assert one(spark, scalar.parse_time, texts, "string") == [
            dt.datetime(2024, 3, 31, 2, 30), dt.datetime(2024, 1, 1, 12), None, None, None, None, None, None,
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_range_inf_and_clip(spark):
    inf = float("inf")
    values = [0.9, 1.0, 200.0, 200.1, None, inf, -inf]
    df = spark.createDataFrame([(i, v, v) for i, v in enumerate(values)], "i int, a double, b double").orderBy("i")
    bounds = {"a": (1.0, 200.0)}
    col = lambda d, c: [r[c] for r in d.collect()]
    assert col(scalar.filter_range(df, bounds), "a") == [None, 1.0, 200.0, None, None, None, None]
    assert col(scalar.filter_range(df, bounds), "b") == values
    assert col(scalar.filter_range(df, bounds, False), "a") == [1.0, 1.0, 200.0, 200.0, None, 200.0, 1.0]
    assert col(scalar.filter_inf(df), "b") == [0.9, 1.0, 200.0, 200.1, None, None, None]
    assert col(scalar.apply_filters(df, bounds, use_range=False), "a") == [0.9, 1.0, 200.0, 200.1, None, None, None]
    assert col(scalar.apply_filters(df, bounds, use_inf=False), "b") == values


def test_long_and_wide_filters_agree(spark):
    rows = [("a", v) for v in (0.0, 5.0, None, float("inf"), 9.0)] + [("free", 1e9)]
    long = spark.createDataFrame(rows, "variable string, value double")
    limits = spark.createDataFrame([("a", 1.0, 8.0)], "variable string, lo double, hi double")
    clean = sorted((r.variable, r.value) for r in scalar.cleaned_long(long, limits).dropna().collect())
    assert clean == [("a", 5.0), ("free", 1e9)]
    clipped = scalar.cleaned_long(long, limits, use_inf=False, replace_with_null=False)
    assert sorted(r.value for r in clipped.dropna().collect()) == [1.0, 5.0, 8.0, 8.0, 1e9]


def test_year_slice_reaches_the_scan(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = scalar.year_slice(li, 1998, "l_shipdate")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan


def test_first_non_null_takes_the_lowest_order_per_column(spark):
    rows = [(1, 1, None, 5.0, 1), (1, 1, 2.0, 6.0, 2), (1, 1, 3.0, None, 0), (2, 1, None, None, 1)]
    df = spark.createDataFrame(rows, "station_id int, time int, a double, b double, order_key long")
    got = {r.station_id: (r.a, r.b) for r in merge.first_non_null(df, ["a", "b"]).collect()}
    assert got == {1: (3.0, 5.0), 2: (None, None)}


def test_union_keeps_columns_apart(spark):
    a = spark.createDataFrame([(1, 2.0)], "k int, x double")
    b = spark.createDataFrame([(1, 3.0)], "k int, y double")
    assert sorted(map(tuple, merge.union_folds([a, b]).collect()), key=str) == [(1, 2.0, None), (1, None, 3.0)]
