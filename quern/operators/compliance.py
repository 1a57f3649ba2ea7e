"""Limits on measured values: coercion, violation flags, shares and daily bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.scalar import drop_null_rows, to_number

# Highest permitted level per measure (mg/L, NTU, mg/L).
DRINKING_WATER_LIMITS = {"chlorine": 4.0, "turbidity": 1.0, "fluoride": 4.0}

#: Half width of a 95% normal interval in standard errors.
_Z95 = 1.959963984540054


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: to_number(c) for c in columns})


def null_counts_by_column(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, nulls) from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "nulls")


def clean_samples(df: DataFrame, columns: Sequence[str], date: str) -> DataFrame:
    """Complete rows with numeric measures and a date."""
    complete = drop_null_rows(coerce_numeric(drop_null_rows(df), columns), columns)
    return complete.withColumn(date, F.to_date(date))


def limit_flags(df: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    """A boolean ``<measure>_violation`` per limit; reaching the limit is no violation."""
    return df.withColumns({f"{c}_violation": F.col(c) > F.lit(v) for c, v in limits.items()})


def violation_pct(df: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    """(measure, pct) rows: share of samples above each limit."""
    flags = limit_flags(df, limits)
    shares = flags.agg(
        *[(F.avg(F.col(f"{c}_violation").cast("int")) * 100).alias(c) for c in limits]
    )
    return shares.unpivot([], list(limits), "measure", "pct")


def measure_by_date_band(df: DataFrame, date: str, columns: Sequence[str]) -> DataFrame:
    """Mean per date and measure with a 95% normal interval (NULL for a single sample)."""
    long = df.unpivot([date], list(columns), "measure", "value")
    half = _Z95 * F.stddev_samp("value") / F.sqrt(F.count("value"))
    return long.groupBy(date, "measure").agg(
        F.count("value").alias("samples"),
        F.avg("value").alias("mean"),
        (F.avg("value") - half).alias("low"),
        (F.avg("value") + half).alias("high"),
    )
