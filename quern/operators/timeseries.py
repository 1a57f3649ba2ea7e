"""Daily means, trailing means and additive decomposition of a series.

A series is a DataFrame with a unique date per (optional) ``by`` group. Frames over
positions run in blocks of the dense index, never in one global window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.ordered import row_index, sliding
from quern.functions.scalar import drop_null_rows


def multi_key_sort(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Total order by several columns (a range-partitioned sort)."""
    return df.orderBy(*columns)


def daily_station_mean(
    df: DataFrame, columns: Sequence[str], date: str = "date", by: Sequence[str] = ()
) -> DataFrame:
    """Mean over all complete rows of a day."""
    return (
        drop_null_rows(df).groupBy(*by, date).agg(*[F.avg(c).alias(c) for c in columns])
    )


def rolling_mean(
    daily: DataFrame,
    columns: Sequence[str],
    rows: int = 7,
    date: str = "date",
    by: Sequence[str] = (),
) -> DataFrame:
    """Mean of the last ``rows`` rows; NULL until that many values exist."""

    def trailing(column):
        def make(frame):
            window = frame(-(rows - 1), 0)
            full = F.count(column).over(window) == rows
            return F.when(full, F.avg(column).over(window))

        return make

    indexed = row_index(daily, date, by)
    return sliding(
        indexed, "row_index", rows - 1, 0, {f"{c}_rolling": trailing(c) for c in columns}, by
    ).drop("row_index")


def seasonal_decompose_additive(
    daily: DataFrame,
    column: str,
    period: int = 30,
    date: str = "date",
    by: Sequence[str] = (),
) -> DataFrame:
    """observed = trend + seasonal + residual.

    The trend is a centred moving average over one period (an even period uses half
    weights at both ends); the seasonal part is the mean detrended value per position
    in the period, shifted to mean zero.
    """
    if period < 2:
        raise ValueError("The period must be at least 2.")
    sizes = daily.groupBy(*by).agg(F.count("*").alias("n")) if by else daily.agg(
        F.count("*").alias("n")
    )
    if (sizes.agg(F.min("n").alias("n")).first()["n"] or 0) < 2 * period:
        raise ValueError("The series must cover at least two periods.")

    half = period // 2

    def centred(frame):
        complete = F.count(column).over(frame(-half, half)) == 2 * half + 1
        if period % 2:
            return F.when(complete, F.avg(column).over(frame(-half, half)))
        total = F.sum(column).over(frame(-half, half - 1)) + F.sum(column).over(
            frame(1 - half, half)
        )
        return F.when(complete, total / (2 * period))

    indexed = row_index(daily.select(*by, date, column), date, by)
    trended = sliding(indexed, "row_index", half, half, {"trend": centred}, by).withColumn(
        "_phase", F.pmod(F.col("row_index"), F.lit(period)).cast("int")
    )
    phases = trended.groupBy(*by, "_phase").agg(
        F.avg(F.col(column) - F.col("trend")).alias("_mean")
    )
    # One row per position in the period (and series): at most ``period`` rows a group.
    seasonal = phases.select(
        *by,
        "_phase",
        (F.col("_mean") - F.avg("_mean").over(Window.partitionBy(*by))).alias("seasonal"),
    )
    return trended.join(seasonal if by else F.broadcast(seasonal), [*by, "_phase"]).select(
        *by,
        date,
        F.col(column).alias("observed"),
        "trend",
        "seasonal",
        (F.col(column) - F.col("trend") - F.col("seasonal")).alias("residual"),
    )


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form (row_name, column_name, r), from one aggregate.

    Each pair uses the rows where both values are present.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = [
        F.struct(F.lit(x).alias("row_name"), F.lit(y).alias("column_name"), F.col(f"`{a}|{b}`").alias("r"))
        for a, b in pairs
        for x, y in ([(a, b)] if a == b else [(a, b), (b, a)])
    ]
    return row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
