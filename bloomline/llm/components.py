"""Connected components of a link table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bloomline.llm import ragged
from bloomline.session import materialize


def _contract(links: DataFrame) -> DataFrame:
    """Links of each Arrow batch to a spanning forest of stars: never more rows, often far fewer."""
    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = ragged.spanning_stars(np.asarray(batch.column(0)), np.asarray(batch.column(1)))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return links.mapInArrow(forest, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """Pairs (a, b) of numbers to (node, root): the smallest number reachable from each linked node.

    Alternating large-star and small-star rounds. Each round is joins and
    minima over link rows, pre-aggregated before the shuffle, and writes its
    links to the shared folder; rounds end when no link changes. Nulls and
    self-links are ignored; no links give no rows.
    """
    edges = links.toDF("a", "b").where("a <> b")
    edges = materialize(_contract(edges).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Large star: every larger neighbour moves to the node's minimum.
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        # Small star: smaller neighbours and the node itself move to the minimum.
        joined = large.join(low, "a")
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b")))
        edges = materialize(_contract(small).distinct(), "links")
    roots = edges.groupBy("a").agg(F.min("b").alias("root"))
    return roots.select(F.col("a").alias("node"), "root").unionByName(
        roots.select(F.col("root").alias("node"), "root").distinct())
