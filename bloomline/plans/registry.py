"""Registered queries with their equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def tidy(df: DataFrame) -> DataFrame:
    """Comparable output: doubles to six decimals, timestamps as text."""
    def column(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            return (F.round(c, 6) + 0.0).alias(f.name)
        if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        return c
    return df.select([column(f) for f in df.schema])


def query(name: str, sql: str | None = None, doubles: str = ""):
    """Register a query; ``doubles`` lists the SQL columns to round like ``tidy``."""
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: tidy(fn(spark, sf_dir))
        if sql:
            rounded = ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in doubles.split())
            ORACLES[name] = f"SELECT * REPLACE ({rounded}) FROM (\n{sql}\n) AS q" if rounded else sql
        return fn
    return register
