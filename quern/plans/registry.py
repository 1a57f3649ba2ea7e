"""The table of named queries and, where SQL can say it, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.plans.bindings import Bindings, view_ctes
from quern.session import configure


class Entry(NamedTuple):
    build: Callable[[Bindings], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Bindings(configure(spark), folder.rstrip("/")))


ENTRIES: dict[str, Entry] = {}


def oracle(
    *views: str, select: str, steps: dict[str, str] | None = None, recursive: bool = False
) -> str:
    """A SELECT over named views and intermediate steps."""
    ctes = view_ctes(views) + [f"{name} AS ({text})" for name, text in (steps or {}).items()]
    start = "WITH RECURSIVE" if recursive else "WITH"
    return f"{start} {', '.join(ctes)} {select}" if ctes else select


def register(name: str, sql: str | None = None):
    """Add a builder under a name."""

    def add(build: Callable[[Bindings], DataFrame]):
        if name in ENTRIES:
            raise ValueError(f"{name} is already registered.")
        ENTRIES[name] = Entry(build, sql)
        return build

    return add


def rounded(df: DataFrame, digits: int = 6, special: dict[str, int] | None = None) -> DataFrame:
    """Round the floating point columns so that both engines print the same value."""
    return df.withColumns(
        {
            f.name: F.round(f.name, (special or {}).get(f.name, digits))
            for f in df.schema.fields
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        }
    )
