"""CSV readers: typed, inferred, tolerant, one file per year, and line numbers."""

from __future__ import annotations

import codecs
import csv
import io
import os
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.scalar import nan_to_null
from quern.sources.files import opened

_CORRUPT = "_corrupt_record"
#: Bytes of a file's beginning that are read at once.
_HEAD = 1 << 16


def scan_csv_typed(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """CSV with declared types; only the wanted columns are parsed.

    Columns are found by each file's own header, so files may differ in order and extra columns;
    a declared and wanted column that a file lacks is an error. A value that is not of its type is NULL.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wanted = [f for f in declared.fields if columns is None or f.name in columns]
    wanted.sort(key=lambda f: list(columns).index(f.name) if columns else 0)
    types = {f.name: f.dataType.simpleString() for f in wanted}
    parts = [_typed(spark, files, record, types) for _, record, files in files_by_header(spark, {0: path})]
    if not parts:
        return spark.createDataFrame([], T.StructType(wanted))
    return nan_to_null(reduce(DataFrame.unionByName, parts))


def _first_records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first record of each listed file that is not blank; little more than it is read."""
    for batch in batches:
        found = []
        for path in batch["path"]:
            with opened(path) as stream:
                found.append(first_record(lambda stream=stream: stream.read(_HEAD)))
        yield batch.assign(record=found)


def first_record(read: Callable[[], bytes]) -> str | None:
    """The first record of a stream of blocks, None if all lines are blank.

    A line break inside quotes belongs to the record.
    """
    held, ended = b"", False
    while True:
        block = read()
        ended = ended or not block
        held += block
        if held.startswith(codecs.BOM_UTF8):
            held = held[len(codecs.BOM_UTF8) :]
        place, quotes = 0, 0
        while (at := held.find(b"\n", place)) >= 0 or (ended and place < len(held)):
            stop = at if at >= 0 else len(held)
            quotes += held.count(b'"', place, stop)
            if quotes % 2 == 0 and held[:stop].strip():
                return held[:stop].rstrip(b"\r").decode()
            place = stop + 1
            if quotes == 0:  # blank so far
                held, place = held[place:], 0
        if ended:
            return held.rstrip(b"\r\n").decode() if held.strip() else None


def files_by_header(spark: SparkSession, paths: Mapping[int, str]) -> list[tuple[int, str, list[str]]]:
    """(key, first record, files that begin with it) of all files below the paths of these keys.

    One job reads the first records of all files, however many they are. Files without a record are left out.
    """
    listed = None
    for key, path in paths.items():
        files = spark.read.format("binaryFile").load(path).where("length > 0").select(F.lit(key).alias("key"), "path")
        listed = files if listed is None else listed.unionByName(files)
    if listed is None:
        return []
    found: dict[tuple[int, str], list[str]] = {}
    heads = listed.repartition("path").mapInPandas(_first_records, "key int, path string, record string")
    for row in heads.where("record IS NOT NULL").collect():
        found.setdefault((row["key"], row["record"]), []).append(row["path"])
    return [(key, record, sorted(files)) for (key, record), files in sorted(found.items())]


def _typed(spark: SparkSession, paths: list[str], record: str, types: Mapping[str, str]) -> DataFrame:
    """Files of one header record as columns of these types, in this order.

    The record gives the places of the columns, so nothing is read to plan the scan.
    """
    names = next(csv.reader(io.StringIO(record, newline="")))
    missing = sorted(set(types) - set(names))
    if missing:
        raise ValueError(f"{paths} lacks the columns {missing}")
    twice = sorted(c for c in types if names.count(c) > 1)
    if twice:
        raise ValueError(f"{paths} has the columns {twice} more than once")
    places = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    reader = spark.read.schema(places).option("header", True).option("multiLine", "\n" in record)
    raw = reader.csv(paths)
    return raw.select(*[F.expr(f"try_cast(c{names.index(c)} AS {t})").alias(c) for c, t in types.items()])


def scan_csv_inferred(spark: SparkSession, path: str, null_value: str = "") -> DataFrame:
    """CSV with types found by an extra pass; for exploration."""
    reader = spark.read.option("header", True).option("inferSchema", True)
    return nan_to_null(reader.option("nullValue", null_value).csv(path))


def scan_csv_tolerant(
    spark: SparkSession, path: str, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """(readable rows, broken lines). No line is lost whatever columns are used later.

    The parser only sees that a value is broken when its column is read, so both results
    carry an always true test that touches every column.
    """
    full = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    df = (
        spark.read.schema(full)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .csv(path)
    )
    text = [F.col(f"`{f.name}`").cast("string") for f in schema.fields]
    parsed = F.length(F.concat_ws("", *text)) >= 0
    good = df.where(parsed & F.col(_CORRUPT).isNull()).drop(_CORRUPT)
    bad = df.where(parsed & F.col(_CORRUPT).isNotNull()).select(F.col(_CORRUPT).alias("line"))
    return good, bad


def scan_csv_yearly_union(
    spark: SparkSession,
    paths: Mapping[int, str],
    columns: Mapping[str, str],
) -> DataFrame:
    """Shared columns (name to type) of one CSV per year, matched by header, with ``year``.

    The header names the columns of each file, so files may differ in order and extra
    columns; nothing is inferred from the data.
    """
    union = None
    for year, record, files in files_by_header(spark, paths):
        part = _typed(spark, files, record, columns).withColumn("year", F.lit(year))
        union = part if union is None else union.unionByName(part)
    if union is None:
        raise ValueError("At least one year is required.")
    return union


def with_line_number(
    df: DataFrame, name: str = "source_row_number", file_name: str | None = None
) -> DataFrame:
    """Line of each row in its file, the header being line 1, so the first row gets 2.

    ``file_name`` adds the file under that name. ``df`` must come straight from a CSV scan. Rows of one file split are read in order,
    so a row is its split's first line plus its place in the split; one count per split
    gives the first lines. Those counts are few (a terabyte is some eight thousand splits);
    Spark sees their size and decides whether the rows can stay in place.
    """
    block = {
        "_file": F.col("_metadata.file_path"),
        "_start": F.col("_metadata.file_block_start"),
    }
    placed = df.select("*", *[c.alias(n) for n, c in block.items()]).withColumn(
        "_place", F.monotonically_increasing_id()
    )
    splits = placed.groupBy("_file", "_start").agg(
        F.count("*").alias("_rows"), F.min("_place").alias("_first")
    )
    earlier = (
        Window.partitionBy("_file")
        .orderBy("_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = splits.select(
        "_file",
        "_start",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    return placed.join(offsets, ["_file", "_start"]).select(
        (F.col("_place") + F.col("_shift") + 2).alias(name),
        *df.columns,
        *([F.col("_file").alias(file_name)] if file_name else []),
    )


def yearly_paths(folder: str, years: Sequence[int], pattern: str = "{year}") -> dict[int, str]:
    return {year: os.path.join(folder, pattern.format(year=year)) for year in years}
