"""Declared tables: bring a frame to a schema and verify it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bloomline.schemas import Table


def conform(df: DataFrame, table: Table, defaults: dict | None = None) -> DataFrame:
    """Column order, types and defaults of a declared table; absent columns are NULL."""
    fill = {**table.defaults, **(defaults or {})}

    def column(f):
        c = F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)
        if f.name in fill:
            c = F.coalesce(c, F.lit(fill[f.name]))
        return c.cast(f.dataType).alias(f.name)

    return df.select([column(f) for f in table.schema])


def violations(df: DataFrame, table: Table) -> DataFrame:
    """One row per broken rule: NULL in a required column, or a repeated key."""
    required = [f.name for f in table.schema if not f.nullable]
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    out = nulls.unpivot([], required, "rule", "violations").select(
        F.concat(F.lit("not null: "), "rule").alias("rule"), "violations"
    )
    if table.key:
        repeated = df.groupBy(*table.key).count().where("count > 1")
        out = out.unionByName(
            repeated.agg(F.count("*").alias("violations")).select(
                F.lit("unique key: " + ", ".join(table.key)).alias("rule"), "violations"
            )
        )
    return out.where("violations > 0")


def verify(df: DataFrame, table: Table) -> DataFrame:
    """Raise with the broken rules; the rule list is bounded by the schema."""
    broken = violations(df, table).collect()
    if broken:
        raise ValueError("; ".join(f"{r.rule} ({r.violations})" for r in broken))
    return df
