"""Tests and regression from sufficient statistics.

Each test is one combinable aggregate over the rows followed by arithmetic on a
handful of numbers. ``nan_policy`` is 'propagate' (a missing value makes the answer
NULL) or 'omit'.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import special
from quern.functions.factor import LeastSquares, triangles
from quern.functions.ordered import cut_points, with_range
from quern.functions.scalar import drop_null_rows, right_closed_bin
from quern.sources.literal import inline_table

ALPHA = 0.05

# Usage bands in hours, right closed.
USAGE_EDGES = (0.0, 1.0, 5.0, 10.0, float("inf"))
USAGE_LABELS = ("Low", "Medium", "High", "Very High")


def _when_complete(complete: Column, value: Column, nan_policy: str) -> Column:
    if nan_policy not in ("propagate", "omit"):
        raise ValueError("nan_policy must be 'propagate' or 'omit'.")
    return value if nan_policy == "omit" else F.when(complete, value)


def welch_t_test(
    df: DataFrame,
    group: str,
    first: str,
    second: str,
    value: str,
    nan_policy: str = "propagate",
    by: Sequence[str] = (),
) -> DataFrame:
    """Unequal-variance t test of two groups; one row (per ``by`` group)."""
    side = lambda g: F.when(F.col(group) == g, F.col(value))
    missing = F.count_if(F.col(group).isin(first, second) & F.col(value).isNull())
    stats = (
        df.where(F.col(group).isin(first, second))
        .groupBy(*by)
        .agg(
            *[
                f(side(g)).alias(f"{name}{i}")
                for i, g in ((1, first), (2, second))
                for name, f in (("n", F.count), ("m", F.avg), ("v", F.var_samp))
            ],
            missing.alias("_missing"),
        )
    )
    e1, e2 = F.col("v1") / F.col("n1"), F.col("v2") / F.col("n2")
    complete = F.col("_missing") == 0
    return (
        stats.withColumn(
            "t", _when_complete(complete, (F.col("m1") - F.col("m2")) / F.sqrt(e1 + e2), nan_policy)
        )
        .withColumn(
            "df",
            _when_complete(
                complete,
                F.pow(e1 + e2, 2)
                / (F.pow(e1, 2) / (F.col("n1") - 1) + F.pow(e2, 2) / (F.col("n2") - 1)),
                nan_policy,
            ),
        )
        .withColumn("p_value", special.t_sf("t", "df"))
        .withColumn("reject_h0", F.coalesce(F.col("p_value") < ALPHA, F.lit(False)))
        .select(*by, "n1", "n2", F.col("m1").alias("mean1"), F.col("m2").alias("mean2"),
                "t", "df", "p_value", "reject_h0")
    )


def pearson_test(
    df: DataFrame, x: str, y: str, nan_policy: str = "propagate", by: Sequence[str] = ()
) -> DataFrame:
    """Correlation with the two-sided p-value of the exact t transform."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    stats = df.groupBy(*by).agg(
        F.count_if(both).alias("n"), F.count_if(~both).alias("_missing"), F.corr(x, y).alias("_r")
    )
    return (
        stats.withColumn("r", _when_complete(F.col("_missing") == 0, F.col("_r"), nan_policy))
        .withColumn("t", F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2.0, 1 - F.col("r") * F.col("r"))))
        .withColumn("p_value", special.t_sf("t", F.col("n") - 2.0))
        .select(*by, "n", "r", "t", "p_value")
    )


def anova_oneway(df: DataFrame, group: str, value: str) -> DataFrame:
    """F test of equal means over all groups; missing values are left out."""
    present = df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    # One number, told beforehand: a difference of two huge sums of squares would lose all digits.
    mean = present.agg(F.avg(value)).first()[0]
    groups = (
        present.groupBy(group)
        .agg(
            F.count(value).alias("n"),
            F.avg(value).alias("m"),
            F.var_pop(value).alias("v"),
        )
    )
    apart = F.col("m") - F.lit(mean)
    pooled = groups.agg(
        F.count("*").alias("k"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("v")).alias("ss_within"),
        F.sum(F.col("n") * apart * apart).alias("ss_between"),
    )
    return (
        pooled.withColumn("df_between", F.col("k") - 1)
        .withColumn("df_within", F.col("n") - F.col("k"))
        .withColumn(
            "f",
            F.try_divide(
                F.col("ss_between") / F.col("df_between"), F.col("ss_within") / F.col("df_within")
            ),
        )
        .withColumn("p_value", special.f_sf("f", "df_between", "df_within"))
        .select("df_between", "df_within", "ss_between", "ss_within", "f", "p_value")
    )


def bin_right_closed(df: DataFrame, column: str, name: str, **options) -> DataFrame:
    """Usage band of a column; with ``include_lowest`` a value of exactly 0 is kept."""
    return df.withColumn(name, right_closed_bin(column, USAGE_EDGES, USAGE_LABELS, **options))


def crosstab_counts(df: DataFrame, a: str, b: str, levels: Sequence[str]) -> DataFrame:
    """Wide contingency table: one row per ``a``, one count per listed level of ``b``."""
    present = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    return present.groupBy(a).agg(*[F.count_if(F.col(b) == level).alias(level) for level in levels])


def _cells(df: DataFrame, a: str, b: str) -> DataFrame:
    return (
        df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .groupBy(a, b)
        .agg(F.count("*").alias("observed"))
        # The windows run over the contingency table, one row per pair of levels.
        .withColumn("_row", F.sum("observed").over(Window.partitionBy(a)))
        .withColumn("_col", F.sum("observed").over(Window.partitionBy(b)))
        .withColumn("_in_row", F.count("*").over(Window.partitionBy(a)))
        .withColumn("_in_col", F.count("*").over(Window.partitionBy(b)))
    )


def chi_square_independence(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson chi-square of two categoricals; continuity correction at one degree.

    chi2 = n * (sum of observed^2 / (row * column) - 1), so empty cells need no rows.
    """
    cells = _cells(df, a, b)
    share = lambda of, per: F.sum(1 / (F.col(of) * F.col(per)))
    stats = cells.agg(
        F.sum("observed").alias("n"),
        F.count_distinct(a).alias("_rows"),
        F.count_distinct(b).alias("_cols"),
        F.sum(F.col("observed") * F.col("observed") / (F.col("_row") * F.col("_col"))).alias("_q"),
        share("_row", "_in_row").alias("_inv_row"),
        share("_col", "_in_col").alias("_inv_col"),
    )
    plain = F.col("n") * (F.col("_q") - 1)
    weight = F.col("n") * F.col("_inv_row") * F.col("_inv_col")  # sum of 1 / expected
    gap = F.sqrt(F.greatest(plain, F.lit(0.0)) / weight)
    corrected = F.pow(gap - F.least(gap, F.lit(0.5)), 2) * weight
    return (
        stats.withColumn("dof", (F.col("_rows") - 1) * (F.col("_cols") - 1))
        .withColumn("chi2", F.when(F.col("dof") == 1, corrected).otherwise(plain))
        .withColumn("p_value", special.chi2_sf("chi2", "dof"))
        .select("n", "dof", "chi2", "p_value")
    )


def expected_counts(df: DataFrame, a: str, b: str, levels: Sequence[str]) -> DataFrame:
    """Observed and expected count of every cell, empty ones included."""
    wide = crosstab_counts(df, a, b, levels)
    long = wide.unpivot([a], list(levels), b, "observed")
    row = F.sum("observed").over(Window.partitionBy(a))
    column = F.sum("observed").over(Window.partitionBy(b))
    total = wide.agg(F.sum(sum((F.col(f"`{v}`") for v in levels), F.lit(0)))).scalar()
    return long.select(a, b, "observed", (row * column / total).alias("expected"))


# ---- ordinary least squares ----------------------------------------------------


def ols_fit(
    df: DataFrame, y: str, xs: Sequence[str], nan_policy: str = "propagate", level: float = 0.95
) -> DataFrame:
    """Coefficient table: term, coefficient, std_error, t, p_value, ci_low, ci_high.

    Collinear regressors give the fit of least norm; without spare rows only coefficients are given.
    """
    if nan_policy not in ("propagate", "omit"):
        raise ValueError("nan_policy must be 'propagate' or 'omit'.")
    terms = ["const", *xs]

    def solve(batches):
        for batch in batches:
            for parts in batch["parts"]:
                fit = LeastSquares(parts)
                if (nan_policy == "propagate" and fit.dropped) or not fit.n:
                    table = {c: [math.nan] * len(terms) for c in _FIT[1:]}
                else:
                    spare, errors = fit.df_residual > 0, fit.errors
                    with np.errstate(divide="ignore", invalid="ignore"):
                        t = fit.coefficients / errors
                    reach = (special.t_quantile(level, fit.df_residual) if spare else math.nan) * errors
                    tails = [_two_sided(v, fit.df_residual) for v in t]
                    table = {
                        "coefficient": fit.coefficients, "std_error": errors, "t": t, "p_value": tails,
                        "ci_low": fit.coefficients - reach, "ci_high": fit.coefficients + reach,
                    }
                # A missing number reads back as NULL.
                yield pd.DataFrame({"term": terms, **table})

    # The input is one row of triangles, whatever the size of the data.
    return triangles(df, [*xs, y]).mapInPandas(
        solve, "term string, " + ", ".join(f"{c} double" for c in _FIT[1:])
    ).select("term", *[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in _FIT[1:]])


def _two_sided(t: float, df: int) -> float:
    if df < 1 or math.isnan(t):
        return math.nan
    return special.t_two_sided(t, df) if math.isfinite(t) else 0.0


_FIT = ("term", "coefficient", "std_error", "t", "p_value", "ci_low", "ci_high")


def _normality(n: int, skew: float, kurtosis: float) -> float:
    """Omnibus K2 of D'Agostino and Pearson from sample skewness and kurtosis."""
    y = skew * math.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta2 = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3)
    beta2 /= (n - 2.0) * (n + 5) * (n + 7) * (n + 9)
    w2 = math.sqrt(2 * (beta2 - 1)) - 1
    z_skew = math.asinh(y / math.sqrt(2 / (w2 - 1))) / math.sqrt(0.5 * math.log(w2))
    spread = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))
    x = (kurtosis - 3.0 * (n - 1) / (n + 1)) / math.sqrt(spread)
    root = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
    root *= math.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2.0) * (n - 3)))
    a = 6 + 8 / root * (2 / root + math.sqrt(1 + 4 / root**2))
    base = (1 - 2 / a) / (1 + x * math.sqrt(2 / (a - 4)))
    z_kurtosis = (1 - 2 / (9 * a) - math.copysign(abs(base) ** (1 / 3), base)) / math.sqrt(2 / (9 * a))
    return z_skew**2 + z_kurtosis**2


def durbin_watson(df: DataFrame, residual: str, order: str) -> DataFrame:
    """Sum of squared steps over sum of squares, in the order of a unique column.

    Steps inside ranges of the order column are summed in parallel; the steps between
    ranges use each range's first and last residual (one row per range).
    """
    ranged = with_range(df, order, cut_points(df, order), "_range")
    inside = Window.partitionBy("_range").orderBy(order)
    step = F.col(residual) - F.lag(residual).over(inside)
    per_range = (
        ranged.withColumn("_step", step)
        .groupBy("_range")
        .agg(
            F.sum(F.col("_step") * F.col("_step")).alias("_steps"),
            F.sum(F.col(residual) * F.col(residual)).alias("_squares"),
            F.min_by(residual, order).alias("_first"),
            F.max_by(residual, order).alias("_last"),
        )
    )
    between = F.col("_first") - F.lag("_last").over(Window.orderBy("_range"))
    return per_range.withColumn("_gap", between).agg(
        (
            (F.coalesce(F.sum("_steps"), F.lit(0.0)) + F.coalesce(F.sum(F.col("_gap") * F.col("_gap")), F.lit(0.0)))
            / F.sum("_squares")
        ).alias("durbin_watson")
    )


def ols_summary(
    df: DataFrame, y: str, xs: Sequence[str], order: str, nan_policy: str = "propagate"
) -> DataFrame:
    """Goodness of fit and residual diagnostics of a regression as one row.

    ``rank`` counts the independent terms, the constant included; degrees of freedom follow it.
    """
    fit = LeastSquares(triangles(df, [*xs, y]).first()["parts"])
    if (nan_policy == "propagate" and fit.dropped) or fit.df_residual < 1:
        empty = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in _SUMMARY)
        return df.sparkSession.sql(f"SELECT {empty}")
    fitted = F.lit(float(fit.coefficients[0]))
    for slope, x in zip(fit.coefficients[1:], xs, strict=True):
        fitted = fitted + F.lit(float(slope)) * F.col(x)
    residuals = drop_null_rows(df, [*xs, y]).select(
        order, (F.col(y) - fitted).alias("residual")
    )
    shape = residuals.agg(
        F.sum(F.col("residual") * F.col("residual")).alias("rss"),
        F.skewness("residual").alias("skew"),
        (F.kurtosis("residual") + 3).alias("kurtosis"),
    ).first()
    watson = durbin_watson(residuals, "residual", order).first()["durbin_watson"]

    n, k, rss = fit.n, fit.rank - 1, shape["rss"]
    if not (rss and fit.total_ss and k):  # an exact fit, or nothing to explain
        known = {"n": n, "df_residual": fit.df_residual, "rank": fit.rank, "condition_number": fit.condition}
        empty = ", ".join(f"CAST({known.get(c, 'NULL')} AS DOUBLE) AS {c}" for c in _SUMMARY)
        return df.sparkSession.sql(f"SELECT {empty}")
    r2 = 1 - rss / fit.total_ss
    f_value = (fit.total_ss - rss) / k / (rss / fit.df_residual)
    log_likelihood = -n / 2 * (math.log(2 * math.pi) + math.log(rss / n) + 1)
    jarque_bera = n / 6 * (shape["skew"] ** 2 + (shape["kurtosis"] - 3) ** 2 / 4)
    omnibus = _normality(n, shape["skew"], shape["kurtosis"])
    values = (
        float(n), float(fit.df_residual), r2, 1 - (1 - r2) * (n - 1) / fit.df_residual, f_value,
        special.f_upper(f_value, k, fit.df_residual), log_likelihood,
        2 * (k + 1) - 2 * log_likelihood, math.log(n) * (k + 1) - 2 * log_likelihood,
        watson, jarque_bera, math.exp(-jarque_bera / 2), omnibus, math.exp(-omnibus / 2),
        shape["skew"], shape["kurtosis"], fit.condition, fit.rank,
    )
    return inline_table(
        df.sparkSession, ", ".join(f"{c} double" for c in _SUMMARY), [tuple(float(v) for v in values)]
    )


_SUMMARY = (
    "n", "df_residual", "r2", "adj_r2", "f", "f_p_value", "log_likelihood", "aic", "bic",
    "durbin_watson", "jarque_bera", "jarque_bera_p_value", "omnibus", "omnibus_p_value",
    "skew", "kurtosis", "condition_number", "rank",
)
