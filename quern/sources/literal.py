"""Tables written out in code, and results published under a name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def values_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Literal rows as a table; text values are converted to the declared types."""
    wanted = spark.createDataFrame([], schema).schema
    if not rows:
        return spark.createDataFrame([], wanted)
    text = [tuple(None if v is None else str(v) for v in row) for row in rows]
    raw = spark.createDataFrame(text, ", ".join(f"`{f.name}` string" for f in wanted.fields))
    return raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted.fields])


def inline_table(spark: SparkSession, columns: str, rows: Sequence[tuple]) -> DataFrame:
    """A few computed numbers as rows of the plan itself (no job to distribute them).

    ``columns`` reads like "position long, rank long"; values are numbers.
    """
    parts = [c.split() for c in columns.split(", ")]
    types = {"long": "bigint"}
    text = lambda v: f"double('{v!r}')" if isinstance(v, float) else repr(v)
    cells = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    names = ", ".join(f"c{i}" for i in range(len(parts)))
    picked = ", ".join(
        f"CAST(c{i} AS {types.get(kind, kind)}) AS {name}" for i, (name, kind) in enumerate(parts)
    )
    return spark.sql(f"SELECT {picked} FROM VALUES {cells} AS t({names})")


def publish_view(name: str, df: DataFrame, table: bool = False) -> DataFrame:
    """Make a result readable under a name: a session view, or a stored table."""
    if table:
        df.write.mode("errorifexists").saveAsTable(name)
        return df.sparkSession.table(name)
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
