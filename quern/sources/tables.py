"""Parquet parts, schema description, results written as Parquet, CSV or JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_parquet_parts(
    spark: SparkSession, folder: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """All parts of a folder with the wanted columns; an empty folder is an error.

    Row order is carried by a column such as source_row_number, not by part names.
    """
    try:
        df = spark.read.option("recursiveFileLookup", "false").parquet(folder)
    except AnalysisException as error:
        raise FileNotFoundError(f"No Parquet parts in {folder}") from error
    return df.select(*columns) if columns else df


def concat_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, columns matched by name."""
    if not parts:
        raise ValueError("Nothing to concatenate.")
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def describe_schema(df: DataFrame) -> DataFrame:
    """(column_name, data_type, non_null) rows from one pass."""
    counts = df.agg(*[F.count(f"`{c}`").alias(c) for c in df.columns])
    cells = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"`{f.name}`").alias("non_null"),
        )
        for f in df.schema.fields
    ]
    return counts.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def sink_parquet_parts(df: DataFrame, folder: str, overwrite: bool = False) -> None:
    """Write Parquet parts; existing output is replaced only when asked for."""
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(folder)


def sink_csv_result(df: DataFrame, folder: str, order: Sequence[str] = ()) -> None:
    """Write one small result as one CSV part with a header, sorted by ``order``.

    Only the finished rows meet in one task.
    """
    one = df.repartition(1)
    one = one.sortWithinPartitions(*order) if order else one
    one.write.mode("errorifexists").option("header", True).csv(folder)


def sink_json_metrics(df: DataFrame, folder: str) -> None:
    """Write a record of metrics, NULL fields included."""
    df.write.mode("errorifexists").option("ignoreNullFields", False).json(folder)
