"""Reading tables, bounded Arrow batches and ordered buckets shared by the operators."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.words import raw
from quern.session import scratch_path, ship_package

#: Rows and bytes a Python worker receives at once, so that long texts stay within its memory.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package and bound the Arrow batches; only lowers what the caller has set."""
    ship_package(spark)
    for key, most in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES),
    ):
        now = str(spark.conf.get(key)).lower().removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Cut the lineage with a table in the shared folder; it outlives a lost executor."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plain(df: DataFrame, *made: str) -> tuple[DataFrame, list[str]]:
    """``df`` under the names c0, c1, ... and its own names; columns called like ``made`` (any case) are left out.

    Operators that carry all columns along work on such a frame, so that no name can clash.
    """
    kept = [i for i, name in enumerate(df.columns) if name.lower() not in made]
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).select(*[f"c{i}" for i in kept]), [df.columns[i] for i in kept]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(column: str | Column, folds: int, fold: int = 2) -> Column:
    """True where the crc32 of the id as text leaves ``fold``; a null id counts as ''."""
    value = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(value.cast("string"), F.lit("")).cast("binary")) % folds == fold


def range_cuts(df: DataFrame, column: str, ranges: int) -> list:
    """At most ``ranges`` - 1 ascending cut points that part the column about evenly."""
    shares = [i / ranges for i in range(1, ranges)]
    if not shares:
        return []
    found = df.agg(F.percentile_approx(column, shares, 20 * ranges).alias("cuts")).first()["cuts"]
    return sorted(set(found or []))


def range_of(column: str | Column, cuts: list) -> Column:
    """Number of cut points at or below the value, so that ranges ascend; null goes first.

    A binary search in one literal array: the plan does not grow with the cuts.
    """
    value = F.col(column) if isinstance(column, str) else column
    if not cuts:
        return F.lit(0)
    points = F.lit(cuts)
    steps = F.lit([1 << k for k in reversed(range(len(cuts).bit_length()))])

    def step(low: Column, width: Column) -> Column:
        inside = (low + width <= len(cuts)) & (F.get(points, low + width - 1) <= value)
        return F.when(inside, low + width).otherwise(low)

    return F.when(value.isNull(), F.lit(0)).otherwise(F.aggregate(steps, F.lit(0), step))


def most_frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Every word (by hash) of ``counts`` (word, n) that occurs so often that at most ``most`` do.

    A threshold, found from a histogram, not a cut among equals: only what is returned reaches the driver.
    """
    scale = F.when(F.col("n") < 4096, F.col("n")).otherwise(F.floor(F.log2("n") * 64) + 4096 - 12 * 64)
    steps = sorted(((r["s"], r["c"], r["least"]) for r in counts.groupBy(scale.alias("s")).agg(
        F.count("*").alias("c"), F.min("n").alias("least")).collect()), reverse=True)
    total, least = 0, None
    for _, count, low in steps:
        if total + count > most:
            break
        total, least = total + count, low
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = counts.where(F.col("n") >= least).select("word", "n").toPandas()
    order = np.argsort(found["word"].to_numpy().view(np.uint64))
    return found["word"].to_numpy()[order], found["n"].to_numpy()[order]


def text_slices(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column of about ``most`` bytes, one row at least."""
    places = raw(column)[1]
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(places, places[first] + most, side="right")) - 1)
        yield first, last
        first = last


def vocabulary_file(path: str) -> str:
    """A vocabulary file must be readable on every executor; its path is a parameter."""
    if not os.path.exists(path):
        raise FileNotFoundError(f"Vocabulary file {path} is not on this machine.")
    return path
