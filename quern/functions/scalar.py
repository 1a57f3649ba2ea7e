"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio_pct(part: Column | str, whole: Column | str, digits: int = 3) -> Column:
    """Rounded percentage, NULL when the denominator is zero or missing."""
    as_double = lambda c: (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.round(F.try_divide(as_double(part), as_double(whole)) * 100, digits)


def to_number(column: str) -> Column:
    """Text to double; anything that is not a number becomes NULL."""
    return F.expr(f"try_cast(trim(`{column}`) AS DOUBLE)")


def text_before_comma(column: str) -> Column:
    """Text up to the first comma; NULL when there is none."""
    return F.when(F.locate(",", F.col(column)) > 0, F.substring_index(column, ",", 1))


def text_after_comma(column: str) -> Column:
    """Text after the first comma, leading blank kept; NULL when there is none."""
    at = F.locate(",", F.col(column))
    return F.when(at > 0, F.substring(F.col(column), at + 1, F.length(column)))


def part_from_right(column: str, place: int, most: int = 4) -> Column:
    """Part of a comma or dot separated text counted from the right.

    More than ``most`` parts, or fewer than ``place``, gives NULL; so does an empty part.
    """
    parts = F.split(F.translate(F.col(column), ",", "."), "[.]")
    part = F.try_element_at(parts, F.lit(-place))
    return F.when((F.size(parts) <= most) & (part != ""), part)


def right_closed_bin(
    column: str, edges: Sequence[float], labels: Sequence[str], include_lowest: bool = False
) -> Column:
    """Label of the interval (a, b] holding the value; NULL outside all of them."""
    if len(edges) != len(labels) + 1 or list(edges) != sorted(set(edges)):
        raise ValueError("Edges must increase and number one more than the labels.")
    value = F.col(column)
    above = (value >= edges[0]) if include_lowest else (value > edges[0])
    expression = None
    for upper, label in zip(edges[1:], labels, strict=True):
        hit = above & (value <= upper)
        expression = F.when(hit, label) if expression is None else expression.when(hit, label)
    return expression


def safe_share(part: Column, whole: Column) -> Column:
    """part / whole, 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL (or NaN) in any of the columns."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def nan_to_null(df: DataFrame) -> DataFrame:
    """One missing value instead of two, at the scan boundary."""
    floating = {
        f.name: F.nanvl(F.col(f.name), F.lit(None))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(floating) if floating else df
