"""URL lists: a blocked Bloom filter in front of an exact hash join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from bloomline.llm import ragged

WORDS = 8  # 64-bit words of a block: one cache line
PROBES = 8  # bits set for a key, one in each word


def host_of(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    found = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: str | Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _places(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each key, and the bits it sets in the block's words (keys x WORDS)."""
    block = (hashes >> np.uint64(32)) % np.uint64(blocks)
    second = ragged.mix64(hashes)
    shift = (second[:, None] >> (np.arange(WORDS, dtype=np.uint64) * np.uint64(6))[None, :]) & np.uint64(63)
    return block.astype(np.int64), np.uint64(1) << shift


def build_filter(keys: DataFrame, column: str, bits_per_key: int = 16, most_blocks: int = 1 << 19) -> np.ndarray:
    """Blocked Bloom filter of a string column: an array of blocks, each of ``WORDS`` words.

    Tasks set their own keys' bits and send non-empty blocks only; equal blocks
    meet by key and are combined with OR. ``most_blocks`` bounds the filter (32
    MB by default); a longer list only lets more misses through to the join.
    """
    count = keys.count()
    blocks = int(min(most_blocks, max(1, -(-count * bits_per_key // (64 * WORDS)))))
    kinds = ", ".join(f"w{i} long" for i in range(WORDS))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, bits = _places(ragged.hash_values(ragged.texts(batch, "key")), blocks)
            found, back = np.unique(block, return_inverse=True)
            own = np.zeros((len(found), WORDS), dtype=np.uint64)
            np.bitwise_or.at(own, back, bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found)] + [pa.array(own[:, i].view(np.int64)) for i in range(WORDS)],
                names=["block"] + [f"w{i}" for i in range(WORDS)])

    parts = (keys.select(F.col(column).cast("string").alias("key")).where("key IS NOT NULL").mapInArrow(put, "block long, " + kinds)
             .groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]))
    table = np.zeros((blocks, WORDS), dtype=np.uint64)
    for row in parts.toLocalIterator():
        table[row["block"]] = np.array(row[1:], dtype=np.int64).view(np.uint64)
    return table


def may_hold(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """False for keys that are certainly not in the filter."""
    block, bits = _places(hashes, len(table))
    return ((table[block] & bits) == bits).all(axis=1)


def candidates(host: str, path: str, lengths: list[int]) -> list[str]:
    """List keys that could fit a url: each domain above its host, with each listed length of its path's beginning."""
    if not host:
        return []
    names, at = [host], host.find(".")
    while at >= 0:
        names.append(host[at + 1:])
        at = host.find(".", at + 1)
    return [name + path[:n] for name in names for n in lengths if n <= len(path)]


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """Verdict of every url: ``key``, host, path, rule, verdict.

    ``rules`` has host, path, verdict and named (is it to be shown as ``rule``).
    A rule fits its host and all subdomains if the url's path starts with the
    rule's; the longest (host and path together) wins, among equal ones the
    first by rule, then by verdict. Unnamed rules are a plain list: they decide
    only where no named rule fits. Urls that nothing fits get ``default``, as do
    null urls and urls without ``://``, whose host and path are empty. Repeated
    pages are judged each; repeated rules count once; an empty rule table fits
    nothing; other columns are ignored.

    Canonical keys (host and path) go into a blocked Bloom filter. Each url's
    few candidate keys are tested in it, and only those that pass are joined
    with the rules, which removes the false positives.
    """
    listed = (rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
              .select(F.concat("host", "path").alias("rule"), "host", "path", "verdict", "named").distinct())
    table = build_filter(listed, "rule")
    # Distinct lengths of rule paths: as many as the longest path at most.
    lengths = sorted(r[0] for r in listed.select(F.length("path")).distinct().collect())

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, names = [], []
            for i, (host, path) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                found = candidates(host, path, lengths)
                names.extend(found)
                rows.extend([i] * len(found))
            keys, index = ragged.dictionary(pa.array(names, pa.string()))
            ok = may_hold(table, ragged.hash_values(keys))[index] if names else np.zeros(0, bool)
            kept = np.flatnonzero(ok)
            owner = np.asarray(rows, dtype=np.int64)[kept]
            order = pa.array([names[k] for k in kept.tolist()], pa.string())
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), order)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["key", "host", "path", "hits"])

    chosen = pages.select(F.col(key).alias("key"), host_of(url).alias("host"), path_of(url).alias("path"))
    kind = chosen.schema["key"].dataType.simpleString()
    tested = chosen.mapInArrow(passing, f"key {kind}, host string, path string, hits array<string>")
    # Urls meet the rules once per distinct set of passing keys, not once per page: a hot host costs one row.
    sets = tested.where(F.size("hits") > 0).select("hits").distinct().withColumn("hit", F.explode("hits"))
    plain = listed.select(F.col("rule").alias("hit"), "host", "path", "verdict", "named")
    best = F.struct(F.col("named"), F.length("hit").alias("length"), F.col("hit"), F.col("verdict"))
    decided = sets.join(plain, "hit").groupBy("hits").agg(
        F.max_by(F.struct(F.when(F.col("named"), F.col("hit")).alias("rule"), "verdict"), best).alias("decision"))
    joined = tested.join(decided, "hits", "left")
    return joined.select(F.col("key").alias(key), "host", "path", F.col("decision.rule").alias("rule"),
                         F.coalesce("decision.verdict", F.lit(default)).alias("verdict"))
