"""Wide event CSV: title row, header row, then one row per location."""

from __future__ import annotations

import csv
import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from bloomline.config import FIRST_YEAR
from bloomline.functions.text import blank_to_null, drop_empty_columns

SUFFIX = "rm"
YEAR = re.compile(r"(?:19|20)\d{2}")


def repair_header(cells: list[str]) -> list[str]:
    """Column names from the header row.

    ``2026.0`` reads ``2026``; each ``rm`` belongs to the column before it; a
    repeated name gets a running number.
    """
    names, owner, uses = [], "", {}
    for cell in cells:
        name = cell.strip()
        if YEAR.fullmatch(name.removesuffix(".0")):
            name = name.removesuffix(".0")
        if name == SUFFIX:
            name = owner + SUFFIX
        else:
            owner = name
        uses[name] = uses.get(name, -1) + 1
        names.append(f"{name}_{uses[name]}" if uses[name] else name)
    return names


def read_wide_csv(
    spark: SparkSession, path: str, header_path: str | None = None, encoding: str = "UTF-8"
) -> DataFrame:
    """Read a landed CSV as strings under repaired names, empty columns dropped.

    The title and header lines come first in the single file at ``path``; a body
    of many files keeps them in ``header_path``. Only those two lines reach the
    driver; the body is read in parallel, and repeats of the two rows in it drop
    out by comparing whole rows.
    """
    lines = spark.read.option("encoding", encoding).text(header_path or path).head(2)
    if len(lines) < 2:
        raise ValueError(f"{path}: a title row and a header row are required")
    title, header = (next(csv.reader([row.value])) for row in lines)
    fields = [f"_{i}" for i in range(len(header))]
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    body = (
        spark.read.schema(schema)
        .option("encoding", encoding)
        .csv(path, header=False, mode="PERMISSIVE")
    )

    def same_as(cells: list[str]) -> Column:
        padded = (cells + [""] * len(fields))[: len(fields)]
        row = F.array(*[F.coalesce(F.col(f), F.lit("")) for f in fields])
        return row == F.array(*[F.lit(c) for c in padded])

    kept = body.where(~same_as(title) & ~same_as(header))
    return blank_to_null(drop_empty_columns(kept.toDF(*repair_header(header))))


def year_columns(names: list[str], first: int = FIRST_YEAR, last: int | None = None) -> list[str]:
    """Columns that are plain years within ``first``..``last`` (default: this year)."""
    last = last or dt.date.today().year
    return [n for n in names if YEAR.fullmatch(n.strip()) and first <= int(n) <= last]


def year_attributes(
    names: list[str], suffix: str = SUFFIX, first: int = FIRST_YEAR, last: int | None = None
) -> dict[int, str]:
    """Year to the name of its attribute column (``1953rm``)."""
    by_year = {
        n.strip().lower().removesuffix(suffix): n
        for n in names
        if n.strip().lower().endswith(suffix)
    }
    return {int(y): by_year[y] for y in year_columns(list(by_year), first, last)}
