"""Data-quality checks: each takes tables and column names and returns a small frame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bloomline.functions.text import round_exact

ROW = "row_count"


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([
        df.agg(F.count("*").alias(ROW)).select(F.lit(name).alias("table_name"), ROW)
        for name, df in tables.items()
    ])


def range_distinct(df: DataFrame, col: str, distinct: list[str] | None = None) -> DataFrame:
    """Coverage of one column and exact distinct counts."""
    return df.agg(
        F.min(col).alias(f"min_{col}"),
        F.max(col).alias(f"max_{col}"),
        *[F.count_distinct(c).alias(f"distinct_{c}") for c in (distinct or [col])],
    )


def measure_range(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.agg(*[f(c).alias(f"{p}_{c}") for c in cols for p, f in (("min", F.min), ("max", F.max))])


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Total, present and missing values of every listed column in one pass."""
    return df.agg(
        F.count("*").alias("total_rows"),
        *[F.count(c).alias(f"non_null_{c}") for c in cols],
        *[(F.count("*") - F.count(c)).alias(f"null_{c}") for c in cols],
    )


@dataclass(frozen=True)
class Metrics:
    """What is counted of a table while it is written: rows, missing values, and the range of measures."""
    nulls: tuple[str, ...] = ()
    measures: tuple[str, ...] = ()

    def aggregates(self) -> list[Column]:
        return [
            F.count(F.lit(1)).alias(ROW),
            *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in self.nulls],
            *[f(F.col(c).cast("double")).alias(f"{p}_{c}") for c in self.measures for p, f in (("min", F.min), ("max", F.max))],
        ]


class Stored:
    """Metrics of one table as its write observed them; frames like those of the functions here, without a scan."""

    def __init__(self, spark: SparkSession, values: dict[str, float | None]) -> None:
        self.spark, self.values = spark, values

    def frame(self, **columns: float | None) -> DataFrame:
        # A single row of literals.
        return self.spark.range(1).select(*[F.lit(v).cast("double").alias(c) for c, v in columns.items()])

    def rows(self) -> DataFrame:
        return self.frame(**{ROW: self.values[ROW]})

    def nulls(self, cols: list[str]) -> DataFrame:
        total = self.values[ROW]
        return self.frame(total_rows=total, **{f"non_null_{c}": total - self.values[f"null_{c}"] for c in cols},
                          **{f"null_{c}": self.values[f"null_{c}"] for c in cols})

    def range(self, cols: list[str]) -> DataFrame:
        return self.frame(**{f"{p}_{c}": self.values[f"{p}_{c}"] for c in cols for p in ("min", "max")})


def null_rows(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull()).groupBy(col).agg(F.count("*").alias("records"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("records")).where("records > 1")


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key the dimension lacks; a NULL key is an orphan.

    The fact is counted per key first, so a hot key is one row of the join.
    """
    per_key = fact.groupBy(key).agg(F.count("*").alias("_n"))
    return per_key.join(dim.select(key), on=key, how="left_anti").agg(
        F.coalesce(F.sum("_n"), F.lit(0).cast("long")).alias("unmatched")
    )


def reconcile(left: DataFrame, right: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Two row counts side by side with their difference."""
    a, b = names
    both = union_all([
        left.agg(F.count("*").alias(a)), right.agg(F.count("*").alias(b)),
    ]).agg(F.max(a).alias(a), F.max(b).alias(b))
    return both.withColumn("difference", F.col(a) - F.col(b))


def distribution(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("records"))


def top(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First ``n`` rows; each task keeps its own ``n`` before they meet."""
    return df.orderBy(*order).limit(n)


def group_by_dim(
    fact: DataFrame, dim: DataFrame, on: str, by: str, measure: str | None = None
) -> DataFrame:
    """Rows and average measure per dimension attribute; unmatched rows under NULL.

    The fact is folded per join key first: the join sees one row per key.
    """
    parts = [F.count("*").alias("_n")]
    if measure:
        parts += [F.sum(measure).alias("_sum"), F.count(measure).alias("_cnt")]
    joined = fact.groupBy(on).agg(*parts).join(dim.select(on, by), on=on, how="left")
    out = [F.sum("_n").alias("records")]
    if measure:
        out.append(round_exact(F.try_divide(F.sum("_sum"), F.sum("_cnt"))).alias(f"avg_{measure}"))
    return joined.groupBy(by).agg(*out)


def out_of_range(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    return df.where((F.col(col) < low) | (F.col(col) > high))


def load_summary(good: DataFrame, reject: DataFrame, cols: list[str]) -> DataFrame:
    """Rows prepared, missing values among them, and failed items."""
    prepared = good.agg(
        F.count("*").alias("rows_prepared"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in cols],
    )
    failed = reject.agg(F.count("*").alias("failed_items"))
    both = union_all([prepared, failed])
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


@dataclass(frozen=True)
class Check:
    """A named one-row or many-row result, reported as (metric, value).

    ``frame`` holds numeric metrics, and the columns named in ``keys``, whose
    values follow the metric's name in brackets. ``passes`` maps the value to a
    verdict; without it a check only informs.
    """

    name: str
    frame: DataFrame
    passes: Callable[[Column], Column] | None = None
    keys: tuple[str, ...] = ()


def count_check(name: str, rows: DataFrame, passes=lambda v: v == 0) -> Check:
    """Number of offending rows, zero expected."""
    return Check(name, rows.agg(F.count("*").alias("rows")), passes)


def run_checks(checks: list[Check]) -> DataFrame:
    """All checks in order as (position, check_name, metric, value, passed)."""
    def report(i: int, check: Check) -> DataFrame:
        metrics = [c for c in check.frame.columns if c not in check.keys]
        group = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in check.keys])
        values = check.frame.select(group.alias("_group"), *[F.col(c).cast("double").alias(c) for c in metrics])
        long = values.unpivot(["_group"], metrics, "metric", "value")
        if check.keys:
            long = long.withColumn("metric", F.concat("metric", F.lit("["), "_group", F.lit("]")))
        verdict = check.passes(F.col("value")) if check.passes else F.lit(None).cast("boolean")
        return long.select(
            F.lit(i).alias("position"), F.lit(check.name).alias("check_name"),
            "metric", "value", verdict.alias("passed"),
        )
    return union_all([report(i, c) for i, c in enumerate(checks, 1)])
