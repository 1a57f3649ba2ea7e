"""Cleaning of a property register: parsing, filling, recoding, de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import scalar
from quern.functions.ordered import join_null_safe, ordered_cumsum
from quern.session import written


def sort_limit(df: DataFrame, column: str, n: int, tie_break: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(column), tie_break).limit(n)


#: Ways in which registers write a day, tried in turn after the ISO form.
DATE_FORMATS = ("MMMM d, yyyy", "MMM d, yyyy", "M/d/yyyy", "d-MMM-yyyy")


def to_date_column(
    df: DataFrame, column: str, name: str, formats: Sequence[str] = DATE_FORMATS, failed: str | None = None
) -> DataFrame:
    """Date part of a date-time or text column.

    Text is read in ISO form or else by the first of ``formats`` that fits it whole; other text
    gives NULL. ``failed`` names a flag that tells such text from a missing value.
    """
    source = F.col(f"`{column}`")
    if df.schema[column].dataType.simpleString() == "string":
        trimmed = F.trim(source)
        read = [F.to_date(F.try_to_timestamp(trimmed, F.lit(f))) for f in formats]
        day = F.coalesce(F.expr(f"try_cast(trim(`{column}`) AS DATE)"), *read)
    else:
        day = F.to_date(source)
    dated = df.withColumn(name, day)
    return dated.withColumn(failed, source.isNotNull() & F.col(f"`{name}`").isNull()) if failed else dated


def backfill_self_join(df: DataFrame, key: str, row_id: str, column: str) -> DataFrame:
    """Fill missing values from another row with the same key, the one of lowest id.

    One value per key is found by a combinable aggregate, so no pairs of rows are
    formed, and only the rows with a gap travel to the join.
    """
    gap = F.col(column).isNull()
    donors = (
        df.where(~gap).groupBy(key).agg(F.min_by(column, row_id).alias("_fill"))
    )
    filled = (
        df.where(gap)
        .join(donors, key, "left")
        .withColumn(column, F.col("_fill"))
        .select(*df.columns)
    )
    return df.where(~gap).unionByName(filled)


def split_address_at_comma(df: DataFrame, column: str) -> DataFrame:
    return df.withColumns(
        {
            "property_street": scalar.text_before_comma(column),
            "property_city": scalar.text_after_comma(column),
        }
    )


def split_owner_address(df: DataFrame, column: str) -> DataFrame:
    return df.withColumns(
        {
            "owner_street": scalar.part_from_right(column, 3),
            "owner_city": scalar.part_from_right(column, 2),
            "owner_state": scalar.part_from_right(column, 1),
        }
    )


def recode_yes_no(df: DataFrame, column: str) -> DataFrame:
    value = F.col(column)
    return df.withColumn(
        column, F.when(value == "Y", "Yes").when(value == "N", "No").otherwise(value)
    )


def category_counts(df: DataFrame, column: str) -> DataFrame:
    """Values with their non-null count; the NULL value itself counts 0."""
    return df.groupBy(column).agg(F.count(column).alias("occurrences")).orderBy("occurrences")


def duplicate_rows(df: DataFrame, keys: Sequence[str], row_id: str) -> DataFrame:
    """Second and later rows of each business key with their number, by id.

    Only the rows of keys that repeat are numbered; they are written once, and the numbering
    splits a hot key by id ranges.
    """
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select(*keys)
    suspects = written(join_null_safe(df, repeated, keys, "left_semi"), "suspects")
    numbered = ordered_cumsum(suspects, row_id, {"row_num": F.lit(1)}, by=keys)
    return numbered.where(F.col("row_num") > 1)


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], row_id: str) -> DataFrame:
    """The row of lowest id of each business key, by a combinable aggregate."""
    kept = df.groupBy(*keys).agg(
        F.min_by(F.struct(*[c for c in df.columns if c not in keys]), row_id).alias("_row")
    )
    return kept.select(*keys, "_row.*").select(*df.columns)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)
