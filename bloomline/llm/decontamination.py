"""Benchmark passages in training documents, through a positional inverted index."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from bloomline.llm import ragged
from bloomline.session import scratch_path

#: Word bytes are 0-9, a-z (A-Z lower-cased) and all of non-ASCII characters; every other byte separates.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

Item = tuple[str, tuple[bytes, ...]]
Phrase = tuple[bytes, ...]


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split() if text else []


def phrases(items: list[Item], window: int) -> dict[Phrase, list[str]]:
    """Every window of ``window`` words, or a shorter item as a whole, with the items that hold it."""
    found: dict[Phrase, set[str]] = defaultdict(set)
    for name, words in items:
        for i in range(max(1, len(words) - window + 1) if words else 0):
            found[words[i:i + window]].add(name)
    return {k: sorted(v) for k, v in found.items()}


def positional_index(docs: DataFrame, vocabulary: list[bytes] | None = None, least: int = 1,
                     key: str = "doc_id", text: str = "text") -> DataFrame:
    """Postings of every document's words, and one row per document.

    Rows with a term: shard, term, rows and positions (packed lists: the
    document's row in the shard, the word's place in it). Rows without: shard,
    key, row, n_words. A shard is a slice of one task's documents. With a
    ``vocabulary`` only its words are stored, and only where ``least`` or more
    of them are neighbours, since no shorter run can hold a phrase of them.
    """
    fixed = None if vocabulary is None else {w: i for i, w in enumerate(vocabulary)}

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for n, batch in enumerate(ragged.slices(batches, "text")):
            shard, number = f"{task}-{n}", {} if fixed is None else fixed
            counts, where, terms, owners = [], [], [], []
            for row, text in enumerate(ragged.texts(batch, "text").to_pylist()):
                words = words_of(text)
                counts.append(len(words))
                if fixed is None:
                    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int32, count=len(words))
                else:
                    ids = np.fromiter(map(number.get, words, [-1] * len(words)), dtype=np.int32, count=len(words))
                known = np.flatnonzero(np.diff(np.concatenate([[0], ids >= 0, [0]])))
                for a, b in zip(known[::2].tolist(), known[1::2].tolist()):
                    if b - a >= least:
                        where.append(np.arange(a, b))
                        terms.append(ids[a:b])
                        owners.append(np.full(b - a, row))
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * rows), batch.column(0), pa.array(np.arange(rows)), pa.array(counts, pa.int64()),
                 pa.nulls(rows, pa.binary()), pa.nulls(rows, pa.binary()), pa.nulls(rows, pa.binary())], names=names)
            if not terms:
                continue
            term, at, owner = np.concatenate(terms), np.concatenate(where), np.concatenate(owners)
            order = np.argsort(term, kind="stable")
            found, begins = np.unique(term[order], return_index=True)
            lists = np.split(order, begins[1:])
            spelled, size = list(number), len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * size), pa.nulls(size, batch.column(0).type), pa.nulls(size, pa.int64()), pa.nulls(size, pa.int64()),
                 pa.array([spelled[i] for i in found.tolist()], pa.binary()),
                 pa.array([owner[x].astype("<i8").tobytes() for x in lists], pa.binary()),
                 pa.array([at[x].astype("<i8").tobytes() for x in lists], pa.binary())], names=names)

    names = ["shard", "key", "row", "n_words", "term", "rows", "positions"]
    chosen = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    return chosen.mapInArrow(index, f"shard string, key {kind}, row long, n_words long, term binary, rows binary, positions binary")


def _exact(postings: dict[bytes, np.ndarray], phrase: Phrase) -> np.ndarray:
    """Starts of a phrase: offset-adjusted posting lists, intersected from the rarest term on."""
    order = sorted(range(len(phrase)), key=lambda i: len(postings[phrase[i]]))
    starts = postings[phrase[order[0]]] - order[0]
    for i in order[1:]:
        if not len(starts):
            break
        listed = postings[phrase[i]]
        at = np.searchsorted(listed, starts + i)
        starts = starts[(at < len(listed)) & (listed[np.minimum(at, len(listed) - 1)] == starts + i)]
    return starts


def _near(postings: dict[bytes, np.ndarray], phrase: Phrase, slop: int) -> np.ndarray:
    """Starts of windows that hold the terms in order with at most ``slop`` other words between neighbours."""
    starts = ends = postings[phrase[0]]
    for term in phrase[1:]:
        listed = postings[term]
        at = np.searchsorted(listed, ends, side="right")
        found = at < len(listed)
        following = listed[np.minimum(at, len(listed) - 1)]
        found &= following - ends <= slop + 1
        starts, ends = starts[found], following[found]
    return starts


def search(index: DataFrame, found: dict[Phrase, list[str]], slop: int = 0) -> DataFrame:
    """Documents that hold phrases: shard, row, spans, items, near_items.

    Each shard is searched on its own, in the numbering ``row * 2^32 + position``
    of all its words, so that no occurrence crosses documents. ``spans`` are the
    word ranges (end exclusive) of exact occurrences, merged where they touch.
    ``near_items`` lists the items found with up to ``slop`` words between
    neighbours (greedy from each start); it equals ``items`` for slop 0.
    """
    wanted = list(found.items())
    by_term: dict[bytes, list[int]] = defaultdict(list)
    for i, (phrase, _) in enumerate(wanted):
        by_term[phrase[0]].append(i)
    span = 1 << 32

    def look(table: pa.Table) -> pa.Table:
        postings = {}
        for term, rows, places in zip(table["term"].to_pylist(), table["rows"].to_pylist(), table["positions"].to_pylist()):
            postings[term] = np.frombuffer(rows, "<i8") * span + np.frombuffer(places, "<i8")
        hits, items, near = defaultdict(list), defaultdict(set), defaultdict(set)
        for term in postings:
            for i in by_term.get(term, ()):
                phrase, names = wanted[i]
                if any(t not in postings for t in phrase):
                    continue
                for start in _exact(postings, phrase).tolist():
                    row, place = divmod(start, span)
                    hits[row].append((place, place + len(phrase)))
                    items[row].update(names)
                    near[row].update(names)
                if slop:
                    for start in _near(postings, phrase, slop).tolist():
                        near[start // span].update(names)
        order = sorted(near)
        spans = []
        for row in order:
            merged: list[list[int]] = []
            for a, b in sorted(hits[row]):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            spans.append([{"start": a, "end": b} for a, b in merged])
        return pa.table({
            "shard": pa.array([table["shard"][0].as_py()] * len(order), pa.string()), "row": pa.array(order, pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            "items": pa.array([sorted(items[r]) for r in order], pa.list_(pa.string())),
            "near_items": pa.array([sorted(near[r]) for r in order], pa.list_(pa.string()))})

    return (index.where("term IS NOT NULL").select("shard", "term", "rows", "positions").groupBy("shard")
            .applyInArrow(look, "shard string, row long, spans array<struct<start:long,end:long>>, items array<string>, near_items array<string>"))


def blocks(benchmark: DataFrame, key: str, text: str, block_bytes: int) -> Iterator[list[Item]]:
    """The benchmark's items in blocks of bounded size, by hash of the item, so that each can be sent to all tasks."""
    chosen = benchmark.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text")).where("text IS NOT NULL AND key IS NOT NULL")
    size = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // block_bytes))
    for n in range(count):
        part = chosen if count == 1 else chosen.where(F.pmod(F.xxhash64("text"), F.lit(count)) == n)
        yield [(r["key"], tuple(words_of(r["text"]))) for r in part.collect()]


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = 10, slop: int = 0, key: str = "doc_id", text: str = "text",
                   item_key: str = "item_id", item_text: str = "text", block_bytes: int = 4 << 20) -> DataFrame:
    """Benchmark windows in every document: ``key``, n_words, n_hit, n_items, items, near_items, contaminated.

    An item's windows are its runs of ``window`` words, or the item itself if
    shorter; one without words has none. Null and empty texts have no words and
    no hits. Items of one id are one item; items without an id are left out.
    Repeated rows are judged each; an empty table gives no rows; an empty
    benchmark contaminates nothing. Other columns are ignored.

    The index of the documents is written to the shared folder, then searched
    shard by shard. The benchmark is the query set. Up to ``block_bytes`` it goes
    to all tasks whole and its words limit the index; beyond that the index has
    all words, and is searched with one block of the benchmark after the other.
    """
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "index")
    queries = blocks(benchmark, item_key, item_text, block_bytes)
    items, following = next(queries), next(queries, None)
    found = phrases(items, window)
    vocabulary = sorted({w for p in found for w in p}) if following is None else None
    least = min((len(p) for p in found), default=1) if vocabulary and not slop else 1
    (positional_index(docs, vocabulary, least, key, text)
     .withColumn("posting", F.col("term").isNotNull()).write.partitionBy("posting").parquet(path))
    index = spark.read.schema(f"shard string, key {docs.schema[key].dataType.simpleString()}, row long, n_words long, term binary, "
                              "rows binary, positions binary, posting boolean").parquet(path)
    hits = search(index.where("posting"), found, slop)
    if following is not None:
        hits = hits.unionByName(search(index.where("posting"), phrases(following, window), slop))
        for items in queries:
            hits = hits.unionByName(search(index.where("posting"), phrases(items, window), slop))
        all_of = lambda c: F.flatten(F.collect_list(c)).alias(c)
        hits = hits.groupBy("shard", "row").agg(all_of("spans"), all_of("items"), all_of("near_items"))
    out = index.where("NOT posting").select("shard", "row", "key", "n_words").join(hits, ["shard", "row"], "left")
    # Spans of several blocks may overlap: walk over them in order and count what is new.
    covered = F.aggregate(
        F.array_sort("spans"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(s["end"] - F.greatest(s["start"], acc["end"]), F.lit(0).cast("long"))).alias("n"),
            F.greatest(acc["end"], s["end"]).alias("end")))["n"]
    names = lambda c: F.coalesce(F.array_sort(F.array_distinct(c)), F.array().cast("array<string>"))
    n_hit = F.coalesce(covered, F.lit(0).cast("long"))
    return out.select(F.col("key").alias(key), "n_words", n_hit.alias("n_hit"), F.size(names("items")).cast("long").alias("n_items"),
                      names("items").alias("items"), names("near_items").alias("near_items"), (n_hit > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without a benchmark window, all columns kept.

    Rows are told apart by key and text, so that one text's hit doesn't remove
    another row of the same key. Documents without a key are judged by text alone.
    """
    named = docs.select(F.struct(F.col(key).alias("key"), F.xxhash64(F.col(text).cast("string")).alias("hash")).alias("row"),
                        F.col(text).alias("text"))
    found = benchmark_hits(named, benchmark, window, key="row", text="text").where("contaminated").select(
        F.col("row.key").alias("_key"), F.col("row.hash").alias("_hash")).distinct()
    return docs.join(found, docs[key].eqNullSafe(found["_key"]) & (F.xxhash64(docs[text].cast("string")) == found["_hash"]), "left_anti")


def items_digest(items):
    """SHA-256 of the item ids, sorted as strings and joined by commas."""
    return F.sha2(F.array_join(F.array_sort(items), ",").cast("binary"), 256)
