"""Named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from countertide.catalog import logical_sql
from countertide.sources.bindings import Tables

DIGITS = 6


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return comparable(self.build(Tables(spark, folder)))


REGISTRY: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Doubles rounded and arrays joined, so that rows of two engines can be compared."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            c = F.round(c, DIGITS)
        elif isinstance(field.dataType, T.ArrayType):
            c = F.array_join(c, "|")
        out.append(c.alias(field.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, doubles: str = ""):
    """Register a query. ``doubles`` names the columns to round in the SQL as well."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Query(name, build, _complete(sql, doubles.split()) if sql else None)
        return build

    return register


def _complete(sql: str, doubles: list[str]) -> str:
    """Put the logical tables in front and round the named columns."""
    body = sql.strip()
    if doubles:
        # Adding zero turns a negative zero into a positive one, which is what Spark's round gives.
        rounded = ", ".join(f"round({c}, {DIGITS}) + 0.0 AS {c}" for c in doubles)
        body = f"SELECT * REPLACE ({rounded}) FROM (\n{body}\n)"
    elif body.startswith("WITH"):
        body = f"SELECT * FROM (\n{body}\n)"
    needed = logical_sql.needed_by(body)
    return f"WITH {needed}\n{body}" if needed else body

