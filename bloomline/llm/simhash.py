"""Near-duplicates by SimHash: exact comparison of fingerprints in tiles."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from bloomline.llm import ragged
from bloomline.llm.components import components
from bloomline.session import materialize

TILE = 512  # fingerprints compared with as many others in one numpy step


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """SimHash of the text's word shingles, as a signed 64-bit integer.

    Bit i is 1 if it is set in over half the shingles' XXH64; repeats count.
    Fewer words than ``width`` are one shingle, no words give 0.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - width + 1)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words))) + np.arange(len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[:n]
    stops = ends[width - 1:] if len(words) >= width else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts.tolist(), stops.tolist())), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, n, 1 << 14):
        ones += np.unpackbits(hashes[k:k + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the fingerprint ``fp`` (signed 64 bits) of every whole text."""
    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ragged.slices(batches, "text"):
            fps = [fingerprint(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["key", "fp"])

    chosen = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    return chosen.mapInArrow(shingles, f"key {kind}, fp long").withColumnRenamed("key", key)


def band_masks(radius: int, count: int) -> list[int]:
    """Bit masks such that any two fingerprints within ``radius`` bits agree under one of them.

    The 64 bits fall into ``radius`` + k blocks; at least k blocks hold no
    differing bit, so every choice of k blocks is a mask. More fingerprints need
    longer masks to keep tiles small, at the price of more masks: k grows until
    the masked bits exceed the binary logarithm of ``count``.
    """
    for k in range(1, 7):
        blocks = radius + k
        edges = [round(64 * i / blocks) for i in range(blocks + 1)]
        parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
        if 64 * k // blocks + 2 >= math.log2(max(2, count)):
            break
    return [sum(chosen) for chosen in itertools.combinations(parts, k)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def near_pairs(cell: np.ndarray, side: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of fingerprints within ``radius`` bits in the same cell.

    Rows of a cell have side 0 or 2 (the two tiles of a pair: compared across)
    or 1 (one tile: compared among themselves). Within a cell rows lie in order
    of their population count and are compared tile by tile with exclusive-or
    and bit counts; a tile pair whose population counts differ by more than
    ``radius`` throughout is skipped.
    """
    count = np.bitwise_count(fp)
    order = np.lexsort((fp, count, cell))
    cell, side, fp, count = cell[order], side[order], fp[order], count[order]
    left, right = [], []
    edges = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1], [True]]))
    sizes = np.diff(edges)
    # Cells of up to 32 rows: all of them at once, each row against the d-th row after it.
    small = np.repeat(sizes <= 32, sizes)
    for d in range(1, int(min(32, sizes.max(initial=0)))):
        at = np.flatnonzero(small[:-d] & (cell[:-d] == cell[d:]))
        at = at[(count[at + d] - count[at].astype(np.int64) <= radius)]
        at = at[np.bitwise_count(fp[at] ^ fp[at + d]) <= radius]
        at = at[(side[at] == 1) | (side[at] != side[at + d])]
        left.append(fp[at])
        right.append(fp[at + d])
    for start, stop in zip(edges[:-1][sizes > 32].tolist(), edges[1:][sizes > 32].tolist()):
        for a in range(start, stop, TILE):
            ea = min(a + TILE, stop)
            found_a, found_b = [], []
            for b in range(a, stop, TILE):
                if int(count[b]) - int(count[ea - 1]) > radius:
                    break
                eb = min(b + TILE, stop)
                close = np.bitwise_count(fp[a:ea, None] ^ fp[None, b:eb]) <= radius
                if side[start] != 1 or (side[start:stop] != 1).any():
                    close &= side[a:ea, None] != side[None, b:eb]
                i, j = np.nonzero(close)
                keep = a + i < b + j
                found_a.append(fp[a + i[keep]])
                found_b.append(fp[b + j[keep]])
            u, v = ragged.spanning_stars(np.concatenate(found_a), np.concatenate(found_b))
            left.append(u)
            right.append(v)
    if not left:
        return fp[:0], fp[:0]
    return ragged.spanning_stars(np.concatenate(left), np.concatenate(right))


def _cells(banded: DataFrame, radius: int, most: int) -> DataFrame:
    """Rows (band, value, fp) to cells of bounded size: adds cell and side.

    A group of more than ``most`` fingerprints is dealt into tiles by population
    count and hash; each pair of tiles whose population counts are within
    ``radius`` is a cell of its own, so a hot group spreads over many tasks.
    """
    sizes = banded.groupBy("band", "value").count().where(F.col("count") > most).drop("count")
    hot = banded.join(sizes, ["band", "value"], "left_semi").withColumn("ones", F.bit_count("fp"))
    plain = banded.join(sizes, ["band", "value"], "left_anti")
    cell = plain.select(F.xxhash64("band", "value").alias("cell"), F.lit(1).alias("side"), "fp")
    parts = hot.groupBy("band", "value", "ones").agg(F.ceil(F.count("*") / F.lit(most)).cast("int").alias("parts"))
    # At most 65 population counts for a group: the list of its tiles.
    listed = parts.groupBy("band", "value").agg(F.sort_array(F.collect_list(F.struct("ones", "parts"))).alias("tiles"))
    mine = F.struct(F.col("ones").alias("ones"), F.pmod(F.xxhash64("fp"), F.expr(
        "element_at(filter(tiles, t -> t.ones = ones), 1).parts")).cast("int").alias("part"))
    others = F.flatten(F.transform(F.filter("tiles", lambda t: F.abs(t["ones"] - F.col("ones")) <= radius), lambda t: F.transform(
        F.sequence(F.lit(0), t["parts"] - 1), lambda p: F.struct(t["ones"].alias("ones"), p.cast("int").alias("part")))))
    spread = (hot.join(listed, ["band", "value"]).withColumn("mine", mine).select("band", "value", "fp", "mine", F.explode(others).alias("other"))
              .select(F.xxhash64("band", "value", F.least("mine", "other"), F.greatest("mine", "other")).alias("cell"),
                      F.when(F.col("mine") == F.col("other"), 1).when(F.col("mine") < F.col("other"), 0).otherwise(2).alias("side"), "fp"))
    return cell.unionByName(spread)


def link_fingerprints(distinct: DataFrame, radius: int, most: int = 4096) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` within ``radius`` bits of each other."""
    masks = band_masks(radius, distinct.count())
    banded = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("band"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("value")) for i, m in enumerate(masks)])).alias("b"))
    banded = banded.select("b.band", "b.value", "fp")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task's cells: sorted by cell, so that no more than the rows of whole cells are held.
        held: list[pa.RecordBatch] = []

        def links(table: pa.Table) -> pa.RecordBatch:
            column = lambda n: np.asarray(table[n].combine_chunks())
            a, b = near_pairs(column("cell"), column("side"), column("fp").view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            last = batch.column(0)[batch.num_rows - 1].as_py()
            cut = int(np.searchsorted(np.asarray(batch.column(0)), last))
            held.append(batch.slice(0, cut))
            if cut and sum(x.num_rows for x in held) > 100_000:
                yield links(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield links(pa.Table.from_batches(held))

    cells = _cells(materialize(banded, "bands"), radius, most)
    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint and component of every text: ``key``, fingerprint (16 hex digits), component_id.

    Fingerprints within ``radius`` bits are linked; ``component_id`` is the
    smallest ``key`` (an integer) reachable, itself included. Null and empty
    texts have fingerprint zero and are linked like any other. Repeated rows
    stay; null keys keep their row and never name a component that has another
    key. An empty table gives no rows; other columns are ignored.
    """
    rows = materialize(fingerprints(docs, key, text).withColumnRenamed(key, "key"), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("key").alias("first"))
    roots = components(link_fingerprints(distinct.select("fp"), radius))
    # A component's smallest key is that of its fingerprints' smallest keys.
    rooted = materialize(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = rooted.join(named, "root").select("fp", "component_id")
    digits: Column = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(by_fp, "fp").select(F.col("key").alias(key), digits.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose key names their component, all columns kept: one document of each group.

    Rows that repeat a key count as one document and stay together.
    """
    found = near_duplicates(docs, radius, key, text)
    kept = found.where(F.col(key).eqNullSafe(F.col("component_id"))).select(F.col(key).alias("_kept")).distinct()
    return docs.join(kept, docs[key].eqNullSafe(kept["_kept"]), "left_semi")
