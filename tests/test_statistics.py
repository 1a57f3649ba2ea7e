import math

import numpy as np

import pytest
from pyspark.sql import functions as F

from quern.functions import factor, special
from quern.operators import statistics


def integral(f, low, high, steps=200_000):
    """Simpson's rule."""
    x = np.linspace(low, high, steps + 1)
    y = f(x)
    return (high - low) / steps / 3 * (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum())


@pytest.mark.parametrize("t, df", [(0.3, 3.0), (2.1, 11.5), (4.0, 200.0)])
def test_t_tail(t, df):
    front = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
    want = 1 - 2 * integral(lambda x: front * (1 + x * x / df) ** (-(df + 1) / 2), 0, t)
    assert special.t_two_sided(t, df) == pytest.approx(want, abs=1e-10)


@pytest.mark.parametrize("x, df", [(0.5, 1), (3.0, 2), (12.0, 6), (40.0, 17)])
def test_chi_square_tail(x, df):
    front = 1 / (2 ** (df / 2) * math.gamma(df / 2))
    want = integral(lambda u: front * u ** (df / 2 - 1) * np.exp(-u / 2), x, x + 300)
    assert special.chi2_upper(x, df) == pytest.approx(want, rel=1e-8)


def test_f_tail_is_consistent():
    assert special.f_upper(9.0, 1, 25) == pytest.approx(special.t_two_sided(3.0, 25))
    assert special.f_upper(2.0, 3, 1e7) == pytest.approx(special.chi2_upper(6.0, 3), abs=1e-6)
    assert special.t_two_sided(60.0, 50_000) < 1e-300 or special.t_two_sided(60.0, 50_000) >= 0
    assert special.t_quantile(0.95, 10) == pytest.approx(2.2281388519, abs=1e-8)


def test_missing_value_makes_the_answer_missing(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("a", None), ("b", 4.0), ("b", 6.5)], "g string, v double"
    )
    assert statistics.welch_t_test(df, "g", "a", "b", "v").first()["t"] is None
    omitted = statistics.welch_t_test(df, "g", "a", "b", "v", "omit").first()
    assert omitted["t"] == pytest.approx((1.5 - 5.25) / math.sqrt(0.5 / 2 + 3.125 / 2))
    with pytest.raises(ValueError):
        statistics.welch_t_test(df, "g", "a", "b", "v", "drop")


def test_two_by_two_is_corrected(spark):
    cells = {("x", "p"): 12, ("x", "q"): 5, ("y", "p"): 3, ("y", "q"): 9}
    data = [k for k, n in cells.items() for _ in range(n)]
    row = statistics.chi_square_independence(spark.createDataFrame(data, "a string, b string"), "a", "b").first()
    n, det = 29, 12 * 9 - 5 * 3
    want = n * (abs(det) - n / 2) ** 2 / (17 * 12 * 15 * 14)
    assert (row["dof"], row["chi2"]) == (1, pytest.approx(want))


def test_empty_cells_count(spark):
    data = [("x", "p")] * 5 + [("y", "q")] * 7 + [("z", "p")] * 2
    df = spark.createDataFrame(data, "a string, b string")
    row = statistics.chi_square_independence(df, "a", "b").first()
    assert (row["dof"], row["chi2"]) == (2, pytest.approx(14.0))
    expected = statistics.expected_counts(df, "a", "b", ["p", "q"]).collect()
    assert len(expected) == 6 and sum(r["expected"] for r in expected) == pytest.approx(14.0)


@pytest.fixture(scope="module")
def regression(spark):
    random = np.random.default_rng(5)
    x = random.normal(size=(400, 2)) * [1.0, 30.0] + [2.0, 100.0]
    y = 3.0 + x @ [0.5, -0.02] + random.standard_t(5, size=400)
    data = [(i, *map(float, x[i]), float(y[i])) for i in range(400)]
    return x, y, spark.createDataFrame(data, "i long, a double, b double, y double").repartition(6)


def test_least_squares(regression):
    x, y, df = regression
    design = np.column_stack([np.ones(400), x])
    beta, *_ = np.linalg.lstsq(design, y, rcond=None)
    residual = y - design @ beta
    errors = np.sqrt(np.diag(np.linalg.inv(design.T @ design)) * (residual @ residual) / 397)
    table = {r["term"]: r for r in statistics.ols_fit(df, "y", ["a", "b"]).collect()}
    for i, term in enumerate(("const", "a", "b")):
        assert table[term]["coefficient"] == pytest.approx(beta[i])
        assert table[term]["std_error"] == pytest.approx(errors[i])
        assert table[term]["ci_high"] - table[term]["coefficient"] == pytest.approx(
            special.t_quantile(0.95, 397) * errors[i]
        )
    row = statistics.ols_summary(df, "y", ["a", "b"], "i").first()
    steps = np.diff(residual)
    assert row["durbin_watson"] == pytest.approx(steps @ steps / (residual @ residual))
    assert row["condition_number"] == pytest.approx(np.linalg.cond(design))
    assert row["r2"] == pytest.approx(1 - residual @ residual / ((y - y.mean()) ** 2).sum())
    spread = residual.std()
    assert row["kurtosis"] == pytest.approx(((residual / spread) ** 4).mean())
    assert row["aic"] == pytest.approx(6 - 2 * row["log_likelihood"])


def test_least_squares_with_gaps(regression):
    *_, df = regression
    gaps = df.withColumn("a", F.when(F.col("i") != 7, F.col("a")))
    assert all(r["coefficient"] is None for r in statistics.ols_fit(gaps, "y", ["a", "b"]).collect())
    assert statistics.ols_summary(gaps, "y", ["a", "b"], "i").first()["r2"] is None
    assert statistics.ols_summary(gaps, "y", ["a", "b"], "i", "omit").first()["n"] == 399


def test_zero_falls_out_of_the_first_band(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (11.0,), (None,)], "h double")
    bands = lambda **o: [r["b"] for r in statistics.bin_right_closed(df, "h", "b", **o).collect()]
    assert bands() == [None, "Low", "Medium", "Very High", None]
    assert bands(include_lowest=True)[0] == "Low"


def test_anova_far_from_zero(spark):
    near = [(g, float((7 * i + 3 * g) % 11 + g)) for g in range(3) for i in range(40)]
    found = []
    for shift in (0.0, 1e9):
        df = spark.createDataFrame([(g, v + shift) for g, v in near], "g int, v double")
        found.append(statistics.anova_oneway(df, "g", "v").first())
    assert found[1]["f"] == pytest.approx(found[0]["f"], rel=1e-5)
    assert found[1]["p_value"] == pytest.approx(found[0]["p_value"], rel=1e-4)


@pytest.mark.parametrize("t", [0.5, 1.0, 3.0, 12.0])
def test_tails_of_many_rows(t):
    normal = math.erfc(t / math.sqrt(2))
    assert special.t_two_sided(t, 1e12) == pytest.approx(normal, rel=1e-8)
    assert special.t_two_sided(t, 2.1e6) == pytest.approx(special.t_two_sided(t, 1.9e6), rel=2e-3)
    assert special.f_upper(t, 2, 1e12) == pytest.approx(math.exp(-t), rel=1e-9)


def fitted(spark, design, y, **options):
    names = [f"x{i}" for i in range(design.shape[1])]
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(design, y, strict=True))]
    df = spark.createDataFrame(rows, "i long, " + ", ".join(f"{n} double" for n in [*names, "y"])).repartition(7)
    table = {r["term"]: r for r in statistics.ols_fit(df, "y", names, **options).collect()}
    return [table[t] for t in ("const", *names)], statistics.ols_summary(df, "y", names, "i", **options).first()


def test_collinear_regressors_give_the_fit_of_least_norm(spark):
    random = np.random.default_rng(8)
    x = random.normal(size=(300, 3))
    design = np.column_stack([x, x[:, 0] - 2 * x[:, 1], np.zeros(300), np.full(300, 3.0)])
    y = 1 + x @ [2.0, -1.0, 0.5] + random.normal(size=300)
    table, summary = fitted(spark, design, y)
    whole = np.column_stack([np.ones(300), design])
    beta = np.linalg.pinv(whole) @ y
    errors = np.sqrt(np.diag(np.linalg.pinv(whole.T @ whole, rcond=1e-10)) * ((y - whole @ beta) ** 2).sum() / 296)
    assert [r["coefficient"] for r in table] == pytest.approx(list(beta), abs=1e-10)
    assert [r["std_error"] for r in table] == pytest.approx(list(errors), abs=1e-10)
    assert table[5]["coefficient"] == pytest.approx(0, abs=1e-12)  # the column of zeros
    assert (summary["rank"], summary["df_residual"], summary["n"]) == (4, 296, 300)
    assert summary["r2"] == pytest.approx(1 - ((y - whole @ beta) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_badly_scaled_regressors_keep_their_rank(spark):
    random = np.random.default_rng(9)
    x = random.normal(size=(500, 3))
    y = 5 + x @ [1.0, 2.0, 3.0] + 0.01 * random.normal(size=500)
    table, summary = fitted(spark, x * [1e9, 1e-9, 1.0] + [0, 0, 1e6], y)
    plain_table, plain_summary = fitted(spark, x, y)
    got = [r["coefficient"] for r in table]
    wanted = [r["coefficient"] for r in plain_table]
    assert summary["rank"] == plain_summary["rank"] == 4
    assert got[1] * 1e9 == pytest.approx(wanted[1], rel=1e-6) and got[2] / 1e9 == pytest.approx(wanted[2], rel=1e-6)
    assert got[3] == pytest.approx(wanted[3], rel=1e-6)
    assert [r["t"] for r in table[1:]] == pytest.approx([r["t"] for r in plain_table[1:]], rel=1e-5)


def test_fits_without_spare_rows(spark):
    table, summary = fitted(spark, np.array([[1.0], [2.0]]), np.array([3.0, 5.0]))
    assert [r["coefficient"] for r in table] == pytest.approx([1.0, 2.0])
    assert all(r["std_error"] is None and r["p_value"] is None for r in table) and summary["r2"] is None
    exact, summary = fitted(spark, np.arange(50.0).reshape(-1, 1), 2 * np.arange(50.0) + 1)
    assert [r["coefficient"] for r in exact] == pytest.approx([1.0, 2.0]) and summary["rank"] == 2
    empty = spark.createDataFrame([], "x0 double, y double")
    assert all(r["coefficient"] is None for r in statistics.ols_fit(empty, "y", ["x0"]).collect())


def test_triangle_does_not_depend_on_the_layout(spark):
    random = np.random.default_rng(10)
    rows = random.normal(size=(1000, 3))
    df = spark.createDataFrame(rows.tolist(), "a double, b double, y double")
    wanted = np.linalg.qr(np.column_stack([np.ones(1000), rows]), mode="r")
    for parts in (1, 40):
        found = factor.LeastSquares(factor.triangles(df.repartition(parts), ["a", "b", "y"]).first()["parts"])
        whole = np.column_stack([np.ones(1000), rows[:, :2]])
        assert found.coefficients == pytest.approx(np.linalg.lstsq(whole, rows[:, 2])[0])
        assert found.total_ss == pytest.approx((wanted[1:, 3] ** 2).sum())
        assert found.condition == pytest.approx(np.linalg.cond(whole))
