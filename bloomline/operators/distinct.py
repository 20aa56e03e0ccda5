"""Exact distinct counts from bitmaps over dictionary numbers, which merge between loads without the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bloomline.operators.quality import union_all
from bloomline.session import materialize

BITS = 32768  # of one bitmap: the width of Spark's bitmap functions
SIDE_BY_SIDE = 32  # bitmaps of one column that a single aggregate row may hold; longer dictionaries group by bitmap


def extend_dictionary(known: DataFrame | None, df: DataFrame, col: str) -> DataFrame:
    """(value, number) of every value of ``col``: known numbers stay, new values are numbered after them. Null has no number.

    Numbers come from the position in the written list of new values: they are
    unique, and dense but for a gap between its partitions.
    """
    values = df.where(F.col(col).isNotNull()).select(F.col(col).alias("value")).distinct()
    if known is not None:
        values = values.join(known.select("value"), "value", "left_anti")
    new = materialize(values, "dictionary")
    start = 0 if known is None else known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
    sizes = {r["_p"]: r["n"] for r in new.groupBy(F.spark_partition_id().alias("_p")).agg(F.count("*").alias("n")).collect()}
    before, offsets = start, {}
    for part in sorted(sizes):
        offsets[part], before = before, before + sizes[part]
    within = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    shift = F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair]) if offsets else F.create_map(F.lit(0), F.lit(0))
    numbered = new.select("value", (within + F.try_element_at(shift, F.spark_partition_id())).cast("long").alias("number"))
    numbered = materialize(numbered, "dictionary")
    return numbered if known is None else known.unionByName(numbered)


def bitmaps(df: DataFrame, numbers: dict[str, Column], sizes: dict[str, int]) -> DataFrame:
    """(name, bucket, bitmap) of the numbers that occur in each of several columns, in one pass over the rows.

    ``numbers`` are columns of numbers from 0 (null counts nowhere), ``sizes``
    how many numbers each may have. Rows are not expanded by column: bitmaps are
    aggregates next to each other.
    """
    few = {name: -(-max(1, sizes[name]) // BITS) for name in numbers}
    placed = df.select(*[c.alias(f"_{i}") for i, c in enumerate(numbers.values())])
    frames, aggregates, out = [], [], []
    for i, (name, buckets) in enumerate(few.items()):
        n = F.col(f"_{i}")
        if buckets > SIDE_BY_SIDE:
            frames.append(placed.where(n.isNotNull()).groupBy(F.floor(n / BITS).alias("bucket")).agg(
                F.bitmap_construct_agg(n % BITS).alias("bitmap")).select(F.lit(name).alias("name"), "bucket", "bitmap"))
            continue
        for b in range(buckets):
            inside = F.when((n >= b * BITS) & (n < (b + 1) * BITS), n - b * BITS)
            aggregates.append(F.bitmap_construct_agg(inside).alias(f"b{i}_{b}"))
            out.append(F.struct(F.lit(name).alias("name"), F.lit(b).cast("long").alias("bucket"), F.col(f"b{i}_{b}").alias("bitmap")))
    if aggregates:
        frames.append(placed.agg(*aggregates).select(F.inline(F.array(*out))))
    return union_all(frames)


def merge_bitmaps(loads: list[DataFrame]) -> DataFrame:
    """The bitmaps of several loads as those of their union."""
    return union_all(loads).groupBy("name", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_counts(maps: DataFrame, names: list[str]) -> DataFrame:
    """One row with ``distinct_<name>`` of every name."""
    counted = [F.coalesce(F.sum(F.when(F.col("name") == n, F.bitmap_count("bitmap"))), F.lit(0).cast("long")).alias(f"distinct_{n}") for n in names]
    return maps.agg(*counted)
