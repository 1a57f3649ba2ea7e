import datetime as dt

import numpy as np
import pytest

from quern.operators import timeseries

START = dt.date(2024, 1, 1)


def series(spark, values, name=None):
    rows = [(START + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "date date, x double").repartition(5)
    return df


@pytest.mark.parametrize("period", [4, 5, 30])
def test_decomposition_adds_up(spark, period):
    n = 4 * period
    x = np.sin(np.arange(n) * 2 * np.pi / period) + 0.1 * np.arange(n) + np.random.default_rng(1).normal(size=n)
    got = sorted(timeseries.seasonal_decompose_additive(series(spark, x), "x", period).collect(), key=lambda r: r["date"])
    weights = np.ones(period) / period if period % 2 else np.array([0.5, *np.ones(period - 1), 0.5]) / period
    trend = np.convolve(x, weights, "valid")
    half = period // 2
    assert [r["trend"] is None for r in got] == [i < half or i >= n - half for i in range(n)]
    assert [r["trend"] for r in got[half : n - half]] == pytest.approx(list(trend))
    one_period = [r["seasonal"] for r in got[:period]]
    assert sum(one_period) == pytest.approx(0, abs=1e-9)
    for r in got[half : n - half]:
        assert r["trend"] + r["seasonal"] + r["residual"] == pytest.approx(r["observed"])


def test_short_series_is_refused(spark):
    with pytest.raises(ValueError):
        timeseries.seasonal_decompose_additive(series(spark, range(59)), "x", 30)


def test_trailing_mean_needs_all_values(spark):
    got = sorted(timeseries.rolling_mean(series(spark, range(10)), ["x"], 7).collect(), key=lambda r: r["date"])
    assert [r["x_rolling"] for r in got] == [None] * 6 + [3.0, 4.0, 5.0, 6.0]


def test_series_stay_apart(spark):
    a = series(spark, range(8)).selectExpr("'a' AS s", "*")
    b = series(spark, range(100, 108)).selectExpr("'b' AS s", "*")
    got = timeseries.rolling_mean(a.unionByName(b), ["x"], 7, by=["s"]).where("x_rolling IS NOT NULL")
    assert sorted((r["s"], r["x_rolling"]) for r in got.collect()) == [("a", 3.0), ("a", 4.0), ("b", 103.0), ("b", 104.0)]
