"""Water compliance, weather series and usage statistics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions.scalar import drop_null_rows
from quern.operators import compliance, statistics, timeseries
from quern.plans.registry import oracle, register, rounded

# ---- water ---------------------------------------------------------------------

_MEASURES = ("chlorine", "turbidity", "fluoride")
_LIMITS = compliance.DRINKING_WATER_LIMITS
_NUMERIC = ", ".join(f"try_cast(trim({m}) AS DOUBLE) AS {m}" for m in _MEASURES)
_CLEAN = {
    "coerced": f"SELECT sample_number, sample_date, {_NUMERIC} FROM water",
    "clean": "SELECT * FROM coerced WHERE sample_number IS NOT NULL AND sample_date IS NOT NULL AND "
    + " AND ".join(f"{m} IS NOT NULL" for m in _MEASURES),
}


def _samples(b):
    return compliance.clean_samples(b["water"], _MEASURES, "sample_date")


@register(
    "drop_null_rows",
    oracle("water", select="SELECT * FROM water WHERE COLUMNS(*) IS NOT NULL"),
)
def _(b):
    return drop_null_rows(b["water"])


@register("coerce_numeric", oracle("water", select=f"SELECT sample_number, sample_date, {_NUMERIC} FROM water"))
def _(b):
    return compliance.coerce_numeric(b["water"], _MEASURES)


@register(
    "null_counts_by_column",
    oracle("water", steps=_CLEAN, select=" UNION ALL ".join(
        f"SELECT '{m}' AS column_name, count(*) - count({m}) AS nulls FROM coerced" for m in _MEASURES)),
)
def _(b):
    return compliance.null_counts_by_column(
        compliance.coerce_numeric(b["water"], _MEASURES), _MEASURES
    )


@register(
    "limit_flags",
    oracle("water", steps=_CLEAN, select="SELECT *, " + ", ".join(
        f"{m} > {v}::DOUBLE AS {m}_violation" for m, v in _LIMITS.items()) + " FROM clean"),
)
def _(b):
    return compliance.limit_flags(_samples(b), _LIMITS)


@register(
    "violation_pct",
    oracle("water", steps=_CLEAN, select=" UNION ALL ".join(
        f"SELECT '{m}' AS measure, round(avg(CASE WHEN {m} > {v}::DOUBLE THEN 1 ELSE 0 END) * 1e2, 6) AS pct FROM clean"
        for m, v in _LIMITS.items())),
)
def _(b):
    return rounded(compliance.violation_pct(_samples(b), _LIMITS))


@register(
    "measure_by_date_band",
    oracle("water", steps=_CLEAN, select=" UNION ALL ".join(
        f"SELECT sample_date, '{m}' AS measure, count(*) AS samples, round(avg({m}), 6) AS mean, "
        f"round(avg({m}) - 1.959963984540054e0 * stddev_samp({m}) / sqrt(count(*)), 6) AS low, "
        f"round(avg({m}) + 1.959963984540054e0 * stddev_samp({m}) / sqrt(count(*)), 6) AS high FROM clean GROUP BY 1"
        for m in _MEASURES)),
)
def _(b):
    return rounded(compliance.measure_by_date_band(_samples(b), "sample_date", _MEASURES))


# ---- weather -------------------------------------------------------------------

_DAILY = {
    "daily": "SELECT date, avg(prcp) AS prcp, avg(tavg) AS tavg FROM weather WHERE name IS NOT NULL AND date IS NOT NULL "
    "AND prcp IS NOT NULL AND tavg IS NOT NULL GROUP BY 1"
}


def _daily(b):
    return timeseries.daily_station_mean(b["weather"], ["prcp", "tavg"])


@register("multi_key_sort", oracle("weather", select="SELECT * FROM weather"))
def _(b):
    return timeseries.multi_key_sort(b["weather"], ["date", "name"])


@register(
    "daily_station_mean",
    oracle("weather", steps=_DAILY, select="SELECT date, round(prcp, 9) AS prcp, round(tavg, 9) AS tavg FROM daily"),
)
def _(b):
    return rounded(_daily(b), 9)


_TRAIL = "OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"


@register(
    "rolling_mean_7",
    oracle("weather", steps=_DAILY, select="SELECT date, round(prcp, 9) AS prcp, round(tavg, 9) AS tavg, "
           + ", ".join(f"CASE WHEN count({c}) {_TRAIL} = 7 THEN round(avg({c}) {_TRAIL}, 9) END AS {c}_rolling"
                       for c in ("prcp", "tavg")) + " FROM daily"),
)
def _(b):
    return rounded(timeseries.rolling_mean(_daily(b), ["prcp", "tavg"], 7), 9)


@register(
    "seasonal_decompose_additive",
    oracle("weather", steps={
        **_DAILY,
        "spots": "SELECT date, prcp, row_number() OVER (ORDER BY date) - 1 AS i FROM daily",
        "trended": "SELECT *, CASE WHEN count(*) OVER w = 31 THEN (sum(prcp) OVER l + sum(prcp) OVER r) / 60 END AS trend "
                   "FROM spots WINDOW w AS (ORDER BY i ROWS BETWEEN 15 PRECEDING AND 15 FOLLOWING), "
                   "l AS (ORDER BY i ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING), "
                   "r AS (ORDER BY i ROWS BETWEEN 14 PRECEDING AND 15 FOLLOWING)",
        "phases": "SELECT i % 30 AS phase, avg(prcp - trend) AS m FROM trended GROUP BY 1",
        "season": "SELECT phase, m - (SELECT avg(m) FROM phases) AS seasonal FROM phases",
    }, select="SELECT date, round(prcp, 9) AS observed, round(trend, 9) AS trend, round(seasonal, 9) AS seasonal, "
              "round(prcp - trend - seasonal, 9) AS residual FROM trended JOIN season ON i % 30 = phase"),
)
def _(b):
    return rounded(timeseries.seasonal_decompose_additive(_daily(b), "prcp", 30), 9)


@register(
    "corr_matrix",
    oracle("weather", steps=_DAILY, select=" UNION ALL ".join(
        f"SELECT '{x}' AS row_name, '{y}' AS column_name, round(corr({x}, {y}), 6) AS r FROM daily"
        for x in ("prcp", "tavg") for y in ("prcp", "tavg"))),
)
def _(b):
    return rounded(timeseries.corr_matrix(_daily(b), ["prcp", "tavg"]))


# ---- usage statistics ----------------------------------------------------------

# Upper F tail by Simpson's rule after the substitution tan(phi)^2 = d1 * F / d2;
# a two-sided t tail is the F tail of t^2 with d1 = 1.
_STEPS = 40_000


def _tail(f, d1, d2):
    start = f"atan(sqrt(({d1}) * ({f}) / ({d2})))"
    width = f"((pi() / 2 - {start}) / {_STEPS})"
    phi = f"({start} + k * {width})"
    weight = f"CASE WHEN k = 0 OR k = {_STEPS} THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END"
    return (
        f"(SELECT 2 * exp(lgamma((({d1}) + ({d2})) / 2e0) - lgamma(({d1}) / 2e0) - lgamma(({d2}) / 2e0)) * {width} / 3 "
        f"* sum({weight} * pow(sin({phi}), ({d1}) - 1) * pow(greatest(cos({phi}), 0e0), ({d2}) - 1)) "
        f"FROM range(0, {_STEPS + 1}) steps(k))"
    )


@register(
    "welch_t_test",
    oracle("usage", steps={
        "g": "SELECT gender, count(screen) AS n, avg(screen) AS m, var_samp(screen) AS v FROM usage GROUP BY 1",
        "s": "SELECT a.n AS n1, b.n AS n2, a.m AS mean1, b.m AS mean2, (a.m - b.m) / sqrt(a.v / a.n + b.v / b.n) AS t, "
             "pow(a.v / a.n + b.v / b.n, 2) / (pow(a.v / a.n, 2) / (a.n - 1) + pow(b.v / b.n, 2) / (b.n - 1)) AS df "
             "FROM g a, g b WHERE a.gender = 'Male' AND b.gender = 'Female'",
        "p": f"SELECT *, {_tail('t * t', '1', 'df')} AS p_value FROM s",
    }, select="SELECT n1, n2, round(mean1, 6) AS mean1, round(mean2, 6) AS mean2, round(t, 6) AS t, round(df, 4) AS df, "
              "round(p_value, 6) AS p_value, p_value < 5e-2 AS reject_h0 FROM p"),
)
def _(b):
    return rounded(
        statistics.welch_t_test(b["usage"], "gender", "Male", "Female", "screen"), special={"df": 4}
    )


@register(
    "pearson_test",
    oracle("usage", steps={
        "s": "SELECT count(*) AS n, corr(age, total_usage) AS r FROM usage",
        "t": "SELECT *, r * sqrt((n - 2) / (1 - r * r)) AS t FROM s",
    }, select=f"SELECT n, round(r, 6) AS r, round(t, 6) AS t, round({_tail('t * t', '1', 'n - 2')}, 6) AS p_value FROM t"),
)
def _(b):
    return rounded(statistics.pearson_test(b["usage"], "age", "total_usage"))


@register(
    "anova_oneway",
    oracle("usage", steps={
        "x": "SELECT location, social, avg(social) OVER (PARTITION BY location) AS m, avg(social) OVER () AS g "
             "FROM usage WHERE social IS NOT NULL",
        "s": "SELECT count(DISTINCT location) - 1 AS d1, count(*) - count(DISTINCT location) AS d2, "
             "sum(pow(m - g, 2)) AS ssb, sum(pow(social - m, 2)) AS ssw FROM x",
        "f": "SELECT *, (ssb / d1) / (ssw / d2) AS f FROM s",
    }, select="SELECT d1 AS df_between, d2 AS df_within, round(ssb, 4) AS ss_between, round(ssw, 4) AS ss_within, "
              f"round(f, 6) AS f, round({_tail('f', 'd1', 'd2')}, 6) AS p_value FROM f"),
)
def _(b):
    return rounded(
        statistics.anova_oneway(b["usage"], "location", "social"), special={"ss_between": 4, "ss_within": 4}
    )


_BAND = (
    "CASE WHEN gaming > 0 AND gaming <= 1 THEN 'Low' WHEN gaming > 1 AND gaming <= 5 THEN 'Medium' "
    "WHEN gaming > 5 AND gaming <= 10 THEN 'High' WHEN gaming > 10 THEN 'Very High' END"
)
_BANDED = {"banded": f"SELECT *, {_BAND} AS gaming_band FROM usage"}


def _banded(b):
    return statistics.bin_right_closed(b["usage"], "gaming", "gaming_band")


@register(
    "bin_right_closed",
    oracle("usage", steps=_BANDED, select="SELECT row_id, gaming, gaming_band FROM banded"),
)
def _(b):
    return _banded(b).select("row_id", "gaming", "gaming_band")


@register(
    "crosstab_counts",
    oracle("usage", steps=_BANDED, select="SELECT gender, " + ", ".join(
        f"count(*) FILTER (WHERE gaming_band = '{v}') AS \"{v}\"" for v in statistics.USAGE_LABELS)
        + " FROM banded WHERE gaming_band IS NOT NULL AND gender IS NOT NULL GROUP BY 1"),
)
def _(b):
    return statistics.crosstab_counts(
        _banded(b), "gender", "gaming_band", statistics.USAGE_LABELS
    )


_CELLS = {
    **_BANDED,
    "cells": "SELECT g.gender, v.gaming_band, count(u.gender) AS o FROM (SELECT DISTINCT gender FROM banded WHERE gaming_band IS NOT NULL) g "
             "CROSS JOIN (SELECT DISTINCT gaming_band FROM banded WHERE gaming_band IS NOT NULL) v LEFT JOIN banded u "
             "ON u.gender = g.gender AND u.gaming_band = v.gaming_band GROUP BY 1, 2",
    "expected": "SELECT *, sum(o) OVER (PARTITION BY gender) * sum(o) OVER (PARTITION BY gaming_band) / "
                "CAST(sum(o) OVER () AS DOUBLE) AS e FROM cells",
    "stat": "SELECT CAST(sum(o) AS BIGINT) AS n, (count(DISTINCT gender) - 1) * (count(DISTINCT gaming_band) - 1) AS dof, "
            "sum(pow(o - e, 2) / e) AS chi2 FROM expected",
}


@register(
    "chi_square_independence",  # six degrees of freedom, where the tail has a closed form
    oracle("usage", steps=_CELLS, select="SELECT n, dof, round(chi2, 6) AS chi2, "
           "round(exp(-chi2 / 2) * (1 + chi2 / 2 + pow(chi2 / 2, 2) / 2), 6) AS p_value FROM stat"),
)
def _(b):
    return rounded(statistics.chi_square_independence(_banded(b), "gender", "gaming_band"))


@register(
    "chi_square_expected",
    oracle("usage", steps=_CELLS, select="SELECT gender, gaming_band, o AS observed, round(e, 6) AS expected FROM expected"),
)
def _(b):
    return rounded(
        statistics.expected_counts(_banded(b), "gender", "gaming_band", statistics.USAGE_LABELS)
    )


# Regression by in-place Gauss-Jordan elimination of the covariance matrix.
_XS = ("age", "screen", "social", "productivity", "gaming")
_Y = "total_usage"
_NAMES = (*_XS, _Y)
_OLS = {
    "complete": f"SELECT * FROM usage WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _NAMES)}",
    "base": "SELECT count(*) AS n, [" + ", ".join(f"avg({c})" for c in _NAMES) + "] AS mu, ["
    + ", ".join("[" + ", ".join(f"covar_pop({a}, {b}) * count(*)" for b in _NAMES) + "]" for a in _NAMES)
    + "] AS m FROM complete",
    "sweep": "SELECT 0 AS s, m FROM base UNION ALL SELECT s + 1, [[CASE WHEN i = s + 1 AND j = s + 1 THEN 1 / m[s + 1][s + 1] "
    "WHEN i = s + 1 THEN m[s + 1][j] / m[s + 1][s + 1] WHEN j = s + 1 THEN -m[i][s + 1] / m[s + 1][s + 1] "
    "ELSE m[i][j] - m[i][s + 1] * m[s + 1][j] / m[s + 1][s + 1] END for j in range(1, 7)] for i in range(1, 7)] "
    "FROM sweep WHERE s < 5",
    "solved": "SELECT n, mu, w.m AS w, b.m[6][6] AS tss, w.m[6][6] AS rss, n - 6 AS dfr FROM sweep w, base b WHERE s = 5",
    "terms": "SELECT 'const' AS term, mu[6] - list_sum([w[i][6] * mu[i] for i in range(1, 6)]) AS coefficient, "
    "1e0 / n + list_sum([list_sum([mu[i] * w[i][j] * mu[j] for j in range(1, 6)]) for i in range(1, 6)]) AS u, rss, dfr FROM solved "
    + " ".join(
        f"UNION ALL SELECT '{x}', w[{i}][6], w[{i}][{i}], rss, dfr FROM solved" for i, x in enumerate(_XS, start=1)
    ),
}
_Z = "1.959963984540054e0"
_T_QUANTILE = (
    f"({_Z} + (pow({_Z}, 3) + {_Z}) / (4 * dfr) + (5 * pow({_Z}, 5) + 16 * pow({_Z}, 3) + 3 * {_Z}) / (96 * pow(dfr, 2)))"
)


@register(
    "ols_fit",
    oracle("usage", recursive=True, steps={
        **_OLS,
        "table6": "SELECT term, coefficient, sqrt(u * rss / dfr) AS std_error, dfr, coefficient / sqrt(u * rss / dfr) AS t FROM terms",
        "tails": f"SELECT *, {_tail('t * t', '1', 'dfr')} AS p_value, {_T_QUANTILE} * std_error AS reach FROM table6",
    }, select="SELECT term, round(coefficient, 6) AS coefficient, round(std_error, 6) AS std_error, round(t, 4) AS t, "
              "round(p_value, 6) AS p_value, round(coefficient - reach, 5) AS ci_low, round(coefficient + reach, 5) AS ci_high FROM tails"),
)
def _(b):
    return rounded(
        statistics.ols_fit(b["usage"], _Y, _XS, "omit"), special={"t": 4, "ci_low": 5, "ci_high": 5}
    )


_FITTED = "(SELECT mu[6] - list_sum([w[i][6] * mu[i] for i in range(1, 6)]) FROM solved)" + "".join(
    f" + (SELECT w[{i}][6] FROM solved) * {x}" for i, x in enumerate(_XS, start=1)
)
# Extreme singular values: squaring a positive matrix of trace one ends in the projection on its first direction.
_MATRIX = lambda cell: f"[[{cell} for j in range(1, 7)] for i in range(1, 7)]"
_CONDITION = {
    "normal": "SELECT " + _MATRIX("CASE WHEN i = 1 AND j = 1 THEN n * 1e0 WHEN i = 1 THEN n * mu[j - 1] WHEN j = 1 THEN n * mu[i - 1] "
                                  "ELSE m[i - 1][j - 1] + n * mu[i - 1] * mu[j - 1] END") + " AS a FROM base",
    "inverse": "SELECT " + _MATRIX("CASE WHEN i = 1 AND j = 1 THEN 1e0 / n + list_sum([list_sum([mu[p] * w[p][q] * mu[q] for q in range(1, 6)]) for p in range(1, 6)]) "
                                   "WHEN i = 1 THEN -list_sum([mu[p] * w[p][j - 1] for p in range(1, 6)]) "
                                   "WHEN j = 1 THEN -list_sum([mu[p] * w[p][i - 1] for p in range(1, 6)]) ELSE w[i - 1][j - 1] END") + " AS a FROM solved",
    "squared": "SELECT x, 0 AS s, a AS b FROM (SELECT 1 AS x, a FROM normal UNION ALL SELECT 2, a FROM inverse) UNION ALL SELECT x, s + 1, "
               + _MATRIX("c[i][j] / list_sum([c[p][p] for p in range(1, 7)])") + " FROM (SELECT x, s, "
               + _MATRIX("list_sum([u[i][p] * u[p][j] for p in range(1, 7)])") + " AS c FROM (SELECT x, s, "
               + _MATRIX("b[i][j] / list_sum([b[p][p] for p in range(1, 7)])") + " AS u FROM squared WHERE s < 40))",
    "extreme": "SELECT sqrt((SELECT list_sum([list_sum([b[i][j] * a[j][i] for j in range(1, 7)]) for i in range(1, 7)]) FROM squared, normal WHERE x = 1 AND s = 40) "
               "* (SELECT list_sum([list_sum([b[i][j] * a[j][i] for j in range(1, 7)]) for i in range(1, 7)]) FROM squared, inverse WHERE x = 2 AND s = 40)) AS cond",
}


@register(
    "ols_summary",
    oracle("usage", recursive=True, steps={
        **_OLS,
        "resid": f"SELECT row_id, total_usage - ({_FITTED}) AS e FROM complete",
        "stepped": "SELECT e, e - lag(e) OVER (ORDER BY row_id) AS d FROM resid",
        "shape": "SELECT count(*) AS n, sum(e * e) AS rss, sum(d * d) / sum(e * e) AS dw, "
                 "avg(pow(e, 3)) / pow(avg(e * e), 15e-1) AS skew, avg(pow(e, 4)) / pow(avg(e * e), 2) AS kurt FROM stepped",
        "one": "SELECT CAST(s.n AS DOUBLE) AS n, CAST(dfr AS DOUBLE) AS dfr, tss, s.rss, dw, skew, kurt, 1 - s.rss / tss AS r2, "
               "(tss - s.rss) / 5 / (s.rss / dfr) AS f, -s.n / 2e0 * (ln(2 * pi()) + ln(s.rss / s.n) + 1) AS ll, "
               "s.n / 6e0 * (skew * skew + pow(kurt - 3, 2) / 4) AS jb FROM shape s, solved",
        "k2": "SELECT *, skew * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y, sqrt(2 * (3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / "
              "((n - 2) * (n + 5) * (n + 7) * (n + 9)) - 1)) - 1 AS w2, (kurt - 3 * (n - 1) / (n + 1)) / "
              "sqrt(24 * n * (n - 2) * (n - 3) / (pow(n + 1, 2) * (n + 3) * (n + 5))) AS x, 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * "
              "sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS rb FROM one",
        "k3": "SELECT *, 6 + 8 / rb * (2 / rb + sqrt(1 + 4 / (rb * rb))) AS a FROM k2",
        "k4": "SELECT *, pow(asinh(y / sqrt(2 / (w2 - 1))) / sqrt(ln(w2) / 2), 2) + pow((1 - 2 / (9 * a) - "
              "cbrt((1 - 2 / a) / (1 + x * sqrt(2 / (a - 4))))) / sqrt(2 / (9 * a)), 2) AS om FROM k3",
        "fp": f"SELECT *, {_tail('f', '5', 'dfr')} AS f_p_value FROM k4",
        **_CONDITION,
    }, select="SELECT n, dfr AS df_residual, round(r2, 6) AS r2, round(1 - (1 - r2) * (n - 1) / dfr, 6) AS adj_r2, round(f, 2) AS f, "
              "round(f_p_value, 6) AS f_p_value, round(ll, 4) AS log_likelihood, round(12 - 2 * ll, 4) AS aic, "
              "round(ln(n) * 6 - 2 * ll, 4) AS bic, round(dw, 6) AS durbin_watson, round(jb, 4) AS jarque_bera, "
              "round(exp(-jb / 2), 6) AS jarque_bera_p_value, round(om, 4) AS omnibus, round(exp(-om / 2), 6) AS omnibus_p_value, "
              "round(skew, 6) AS skew, round(kurt, 6) AS kurtosis, round(cond, 4) AS condition_number, 6e0 AS rank FROM fp, extreme"),
)
def _(b):
    summary = statistics.ols_summary(b["usage"], _Y, _XS, "row_id", "omit")
    return rounded(
        summary,
        special={"f": 2, "log_likelihood": 4, "aic": 4, "bic": 4, "jarque_bera": 4, "omnibus": 4, "condition_number": 4},
    )
