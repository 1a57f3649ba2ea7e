"""Provider payment statistics and the balanced yearly panel.

Columns: prvdr_id, state, smry_ctgry, year, pymt, bene_dual_pct (text, '*' when
suppressed). ``approximate=True`` trades exact percentiles for one sketch pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.ordered import exact_quantiles
from quern.functions.scalar import to_number


def provider_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("smry_ctgry") == "PROVIDER")


def summary_category_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("smry_ctgry").agg(F.count("*").alias("row_count")).orderBy(
        F.desc("row_count")
    )


def null_key_check(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return provider_rows(df).agg(
        F.count("*").alias("total_rows"),
        *[(F.count("*") - F.count(c)).alias(f"null_{c}") for c in columns],
    )


def duplicate_key_check(df: DataFrame, key: str) -> DataFrame:
    return (
        provider_rows(df)
        .groupBy(key)
        .agg(F.count("*").alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def duplicate_ids_top10(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    return duplicate_key_check(df, key).orderBy(F.desc("occurrences"), key).limit(k)


def payment_summary(
    df: DataFrame, measure: str = "pymt", approximate: bool = False, digits: int = 2
) -> DataFrame:
    """Count, mean, deviation, extremes and interpolated quartiles as one row."""
    rows = provider_rows(df)
    quarters = [0.25, 0.5, 0.75]
    if approximate:
        found = F.percentile_approx(measure, quarters, 10_000)
        quartiles = [found[i] for i in range(3)]
    else:
        quartiles = [F.lit(q) for q in exact_quantiles(rows, measure, quarters)]
    return rows.agg(
        F.count(measure).alias("provider_count"),
        F.round(F.avg(measure), digits).alias("mean_pymt"),
        F.round(F.stddev_samp(measure), digits).alias("std_pymt"),
        F.round(F.min(measure), digits).alias("min_pymt"),
        *[
            F.round(q, digits).alias(name)
            for q, name in zip(quartiles, ("p25_pymt", "median_pymt", "p75_pymt"), strict=True)
        ],
        F.round(F.max(measure), digits).alias("max_pymt"),
    )


def top_bottom_groups(df: DataFrame, k: int = 5, digits: int = 2) -> DataFrame:
    """The k lowest and k highest group means; a group in both counts as bottom.

    Two bounded top-k selections instead of two global row numberings.
    """
    means = (
        provider_rows(df)
        .where(F.col("pymt").isNotNull())
        .groupBy("state")
        .agg(F.count("*").alias("provider_count"), F.round(F.avg("pymt"), digits).alias("mean_pymt"))
    )
    bottom = means.orderBy("mean_pymt", "state").limit(k)
    top = means.orderBy(F.desc("mean_pymt"), "state").limit(k)
    return bottom.withColumn("category", F.lit(f"Bottom {k}")).unionByName(
        top.join(bottom.select("state"), "state", "left_anti").withColumn(
            "category", F.lit(f"Top {k}")
        )
    )


def _dual_category() -> Column:
    return (
        F.when(to_number("bene_dual_pct") >= 50, "High Dual (>= 50%)")
        .otherwise("Low Dual (< 50%)")
        .alias("dual_category")
    )


def suppressed_category(df: DataFrame) -> DataFrame:
    """Providers with a published share, labelled high or low."""
    return (
        provider_rows(df)
        .where(F.col("pymt").isNotNull() & to_number("bene_dual_pct").isNotNull())
        .withColumn("dual_category", _dual_category())
    )


def dual_comparison(df: DataFrame, digits: int = 2) -> DataFrame:
    return (
        suppressed_category(df)
        .groupBy("dual_category")
        .agg(
            F.count("*").alias("provider_count"),
            F.round(F.avg("pymt"), digits).alias("mean_pymt"),
            F.round(F.stddev_samp("pymt"), digits).alias("std_pymt"),
        )
        .orderBy("dual_category")
    )


def suppression_share(df: DataFrame) -> DataFrame:
    hidden = F.count_if(to_number("bene_dual_pct").isNull())
    return provider_rows(df).agg(
        F.count("*").alias("total_providers"),
        hidden.alias("suppressed"),
        F.round(F.try_divide(100.0 * hidden, F.count("*")), 1).alias("suppressed_pct"),
    )


def union_all_years(frames: dict[int, DataFrame], columns: Sequence[str]) -> DataFrame:
    """Provider rows of several yearly frames, shared columns only, tagged by year."""
    union = None
    for year, frame in frames.items():
        part = provider_rows(frame).select(*columns, F.lit(year).alias("year"))
        union = part if union is None else union.unionByName(part)
    if union is None:
        raise ValueError("At least one year is required.")
    return union


def rows_by_year(panel: DataFrame) -> DataFrame:
    return panel.groupBy("year").agg(F.count("*").alias("provider_rows")).orderBy("year")


def join_semi_balanced(
    df: DataFrame, key: str = "prvdr_id", period: str = "year", periods: int = 5
) -> DataFrame:
    """Rows of the ids observed in every period."""
    complete = (
        df.groupBy(key)
        .agg(F.count_distinct(period).alias("_periods"))
        .where(F.col("_periods") == periods)
    )
    return df.join(complete, key, "left_semi")


def panel_size(panel: DataFrame) -> DataFrame:
    return panel.agg(F.count_distinct("prvdr_id").alias("providers"))


def panel_balance_check(panel: DataFrame) -> DataFrame:
    return panel.groupBy("year").agg(F.count_distinct("prvdr_id").alias("providers")).orderBy(
        "year"
    )


def payment_trend(panel: DataFrame, digits: int = 2) -> DataFrame:
    return (
        panel.where(F.col("pymt").isNotNull())
        .groupBy("year")
        .agg(F.count("*").alias("providers"), F.round(F.avg("pymt"), digits).alias("mean_pymt"))
        .orderBy("year")
    )
