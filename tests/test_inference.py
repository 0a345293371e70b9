import datetime as dt
import math
import random
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeloom.functions import tails
from gaugeloom.functions.tails import beta_cdf, f_upper, kolmogorov_upper
from gaugeloom.operators import inference
from gaugeloom.operators.chunks import bucket_offsets, exact_medians, ranked_values, split_large, value_chunk, value_counts


def long_table(spark, groups):
    rows = [
        (y, s, dt.datetime(y, 1, 1) + dt.timedelta(minutes=10 * i), v, x)
        for (y, v, s), xs in groups.items()
        for i, x in enumerate(xs)
    ]
    return spark.createDataFrame(rows, "year int, station_id int, time timestamp_ntz, variable string, value double")


def samples(seed=5):
    rng = random.Random(seed)
    groups = {(2000, "TT_10", s): [round(rng.gauss(s, 1 + s / 3), 1) for _ in range(40 + s)] for s in range(6)}
    # One station holds a third of the rows; another variable has unique values around zero.
    groups[2000, "TT_10", 99] = [round(rng.gauss(-3, 2), 1) for _ in range(130)]
    groups.update({(2001, "PP_10", s): [rng.uniform(-1, 1) * 10**s for _ in range(31)] for s in range(3)})
    groups[2001, "PP_10", 7] = [5.0] * 9
    return groups


def test_value_chunk_never_decreases(spark):
    values = sorted([0.0, -0.0, float("inf"), float("-inf"), *[random.Random(1).uniform(-1, 1) * 10.0**e for e in range(-300, 300)]])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    chunks = [r[0] for r in df.orderBy("i").select(value_chunk(F.col("v"))).collect()]
    assert chunks == sorted(chunks) and len(set(chunks)) > 500


def test_ranks_and_medians(spark):
    groups = samples()
    df = long_table(spark, groups)
    keys = ["year", "variable", "station_id"]
    counts = value_counts(df, keys)
    medians = {tuple(r)[:3]: r["median"] for r in exact_medians(counts, bucket_offsets(counts, keys), keys).collect()}
    assert medians == {k: pytest.approx(median(v)) for k, v in groups.items()}
    ranked = ranked_values(df, ["variable"]).collect()
    for variable in ("TT_10", "PP_10"):
        values = sorted(x for (_, v, _), xs in groups.items() for x in xs if v == variable)
        for r in (r for r in ranked if r.variable == variable):
            assert (r.n, r.cum, r.prev_cum) == (
                len(values),
                sum(x <= r.value for x in values),
                sum(x < r.value for x in values),
            )


def test_levene_statistic(spark):
    groups = samples()
    rows = {(r.year, r.variable): r for r in inference.levene(long_table(spark, groups)).collect()}
    assert set(rows) == {(2000, "TT_10"), (2001, "PP_10")}
    for (year, variable), row in rows.items():
        xs = [np.array(v) for (y, n, _), v in groups.items() if (y, n) == (year, variable) and len(v) >= 10]
        z = [np.abs(x - np.median(x)) for x in xs]
        n, k = sum(map(len, z)), len(z)
        grand = np.concatenate(z).mean()
        between = sum(len(i) * (i.mean() - grand) ** 2 for i in z)
        within = sum(((i - i.mean()) ** 2).sum() for i in z)
        assert row.levene_w == pytest.approx((n - k) / (k - 1) * between / within)
        assert (row.n_stations, row.n_values) == (k, n)
        assert row.mean_variance == pytest.approx(np.mean([x.var() for x in xs]))
        assert row.homogeneous == (row.levene_p > 0.05) and row.has_issues != row.homogeneous


def test_levene_splits_only_large_stations(spark):
    """Any way of splitting gives the same statistic, and a station of few rows is one bucket."""
    obs = long_table(spark, samples())
    whole, parts = (
        {(r.year, r.variable): r for r in inference.levene_statistic(obs, split_above=most).collect()} for most in (1000, 20)
    )
    assert set(whole) == set(parts) and whole
    for key, row in whole.items():
        assert list(parts[key])[2:] == pytest.approx(list(row)[2:])
    counts = value_counts(obs, inference.SERIES)
    dealt = split_large(counts, inference.SERIES, 20).groupBy(*inference.SERIES)
    for r in dealt.agg(F.sum("cnt").alias("n"), F.count_distinct("bucket").alias("buckets")).collect():
        assert r.buckets == 1 or r.n > 20


def test_stations_of_equal_values_have_no_variance(spark):
    groups = {(2000, "TT_10", 0): [0.07] * 13, (2000, "TT_10", 1): [0.1, 0.2] * 7 + [0.1, 1e6, -3.0]}
    row = inference.levene_statistic(long_table(spark, groups)).first()
    assert row.min_variance == 0.0 and row.variance_ratio == float("inf")


def test_infinite_values_raise_an_issue_but_no_nan(spark):
    groups = samples()
    groups[2000, "TT_10", 0] = groups[2000, "TT_10", 0] + [float("inf")]
    row = inference.levene(long_table(spark, groups)).filter("variable = 'TT_10'").first()
    assert row.levene_w is None and row.levene_p is None and row.has_issues


def test_f_tail():
    # With two numerator degrees of freedom the tail has a closed form.
    for f in (0.1, 1.0, 3.7, 40.0):
        for d2 in (4, 30, 2000):
            assert f_upper(f, 2, d2) == pytest.approx((1 + 2 * f / d2) ** (-d2 / 2), rel=1e-9)
    assert f_upper(0.0, 3, 8) == 1.0 and f_upper(float("inf"), 3, 8) == 0.0
    assert beta_cdf(0.5, 7.5, 7.5) == pytest.approx(0.5)
    assert f_upper(1.0, 5e8, 5e8) == pytest.approx(0.5, abs=1e-4)


def exact_kolmogorov(d, n):
    """P(D < d) as a power of a banded matrix, after Durbin."""
    k = int(n * d) + 1
    m, h = 2 * k - 1, k - n * d
    a = np.array([[1.0 if i - j + 1 >= 0 else 0.0 for j in range(m)] for i in range(m)])
    for i in range(m):
        a[i, 0] -= h ** (i + 1)
        a[m - 1, i] -= h ** (m - i)
    a[m - 1, 0] += (2 * h - 1) ** m if 2 * h - 1 > 0 else 0
    for i in range(m):
        for j in range(m):
            if i - j + 1 > 0:
                a[i, j] /= math.factorial(i - j + 1)
    return np.linalg.matrix_power(a, n)[k - 1, k - 1] * math.factorial(n) / n**n


@pytest.mark.parametrize("n", [20, 50, 100])
def test_kolmogorov_tail_is_close_to_the_exact_law(n):
    for d in (0.08, 0.12, 0.18, 0.25, 0.3):
        assert kolmogorov_upper(d, n) == pytest.approx(1 - exact_kolmogorov(d, n), abs=2e-3)


def test_ks_distance(spark):
    groups = samples()
    for row in inference.ks_normality(long_table(spark, groups)).collect():
        x = np.sort(np.concatenate([v for (y, n, _), v in groups.items() if (y, n) == (row.year, row.variable)]))
        phi = np.array([0.5 + 0.5 * math.erf((v - x.mean()) / x.std() / math.sqrt(2)) for v in x])
        i = np.arange(1, len(x) + 1)
        assert row.ks_d == pytest.approx(max((i / len(x) - phi).max(), (phi - (i - 1) / len(x)).max()))
        assert row.is_normal == (row.ks_p > 0.05)


def test_constant_values_have_no_distance(spark):
    table = long_table(spark, {(2000, "TT_10", 1): [4.0] * 25})
    row = inference.ks_normality(table).first()
    assert row.ks_d is None and row.ks_p is None and row.is_normal is False


def test_interannual_variation(spark):
    rng = random.Random(2)
    groups = {(y, "TT_10", s): [rng.gauss(10 + y % 7, 2) for _ in range(35)] for y in (2000, 2001, 2002) for s in (1, 2)}
    groups[2000, "TT_10", 3] = [1.0] * 40  # only one year
    groups[2001, "TT_10", 3] = [1.0] * 29  # too few values
    row = inference.interannual_cv(inference.station_year_stats(long_table(spark, groups))).first()
    cv = []
    for s in (1, 2):
        means = [np.mean(groups[y, "TT_10", s]) for y in (2000, 2001, 2002)]
        cv.append(np.std(means) / abs(np.mean(means)))
    assert row.n_stations == 2 and row.mean_cv == pytest.approx(np.mean(cv))


def test_normal_distribution_function():
    x = np.concatenate([np.linspace(-12, 12, 40_001), [np.nan, np.inf, -np.inf, 0.0]])
    got = tails.normal_lower(x)
    want = np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in x])
    assert np.nanmax(np.abs(got - want)) < 1e-15 and np.isnan(got[40_001]) and got[40_002] == 1 and got[40_003] < 1e-18


def test_beta_distribution_for_large_parameters():
    """Near its mean the distribution is normal up to terms in 1 / sqrt(n)."""
    for n in (1e6, 1e9, 1e12, 1e14):
        for z in (-2.0, 0.0, 1.0, 3.0):
            x = 0.5 + z / (2 * math.sqrt(2 * n + 1))
            normal = 0.5 * math.erfc(-z / math.sqrt(2))
            assert tails.beta_cdf(x, n, n) == pytest.approx(normal, abs=1e-6)
    assert tails.beta_cdf(0.3, 2.0, 3.0) == pytest.approx(0.3483, abs=1e-12)
    assert tails.f_upper(2.5, 4, 1e13) == pytest.approx(0.0404277, abs=1e-6)  # a chi-square law divided by four


def test_a_fraction_that_does_not_settle_gives_no_number(monkeypatch):
    monkeypatch.setattr(tails, "_beta_fraction", lambda *_: None)
    assert tails.f_upper(1.5, 10, 20) is None
