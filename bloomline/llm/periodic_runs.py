"""Runs of periodically repeated words in texts, found by uniting suffix classes in descending order of common prefixes."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from bloomline.llm import ragged

SLICE_BYTES = 4 << 20  # text in memory at once, or one longer document
STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Limits:
    """A run has at least ``words`` words and ``periods`` times its period."""
    words: int = 6
    periods: int = 4

    def length(self, period):
        return np.maximum(self.words, self.periods * period)

    @property
    def prefix(self) -> int:
        """Least common prefix of two neighbouring occurrences in any such run."""
        period = np.arange(1, max(2, self.words + 1))
        return int((self.length(period) - period).min())


@dataclass
class Suffixes:
    """Suffixes that share enough words with another one of their document, in an order that keeps every class together."""
    places: np.ndarray  # where they start
    lcp: np.ndarray     # words shared with the next one


def _empty() -> Suffixes:
    return Suffixes(np.zeros(0, np.int64), np.zeros(0, np.int64))


def _repeated(ids: np.ndarray, doc: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """Places whose ``width`` words may stand elsewhere in the document: equal hashes, so never one too few."""
    places = np.flatnonzero(np.arange(len(ids)) + width <= ends)
    if not len(places):
        return places
    h = doc[places].astype(np.uint64)
    for j in range(width):
        h *= STEP
        h += ids[places + j].astype(np.uint64)
    order = np.argsort(h)
    sorted_h = h[order]
    same = np.concatenate([[False], sorted_h[1:] == sorted_h[:-1], [False]])
    return np.sort(places[order[same[1:] | same[:-1]]])


def sort_suffixes(ids: np.ndarray, doc: np.ndarray, ends: np.ndarray, least: int) -> Suffixes:
    """Suffixes of all documents of a slice by prefix doubling, with their common prefixes.

    ``ids`` are word numbers, ``doc`` and ``ends`` each place's document and its
    end. Suffixes that share fewer than ``least`` words with every other one of
    their document are left out where that is seen at once.
    """
    width = min(4, least)
    a = _repeated(ids, doc, ends, width)
    n = len(a)
    if not n:
        return _empty()
    columns = [doc[a], *[ids[a + j] for j in range(width)]]
    order = np.lexsort(columns[::-1])
    new = np.zeros(n, bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[order[1:]] != c[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    where = np.full(len(ids) + 1, -1, np.int64)
    where[a] = np.arange(n)
    k, levels = width, [(width, rank)]
    while True:
        ranked = rank[order]
        same = np.concatenate([[False], ranked[1:] == ranked[:-1], [False]])
        slots = np.flatnonzero(same[1:] | same[:-1])
        if not len(slots):
            break
        items = order[slots]
        following = a[items] + k
        at = where[np.minimum(following, len(ids))]
        known = (following < ends[a[items]]) & (at >= 0)
        # A following part that is alone or past the end gets a label of its own, but stands with the words it begins with.
        second = np.where(known, rank[at], n + items)
        starts = [np.where(following + j < ends[a[items]], ids[np.minimum(following + j, len(ids) - 1)], -1) for j in range(width - 1)]
        resort = np.lexsort((second, *starts[::-1], ranked[slots]))
        items, second, first = items[resort], second[resort], ranked[slots][resort]
        order[slots] = items
        new = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        rank = rank.copy()
        rank[items] = slots[np.maximum.accumulate(np.where(new, np.arange(len(items)), 0))]
        k *= 2
        levels.append((k, rank))
    places = a[order]
    left, right = places[:-1].copy(), places[1:].copy()
    stop_left, stop_right = ends[left], ends[right]
    lcp = np.zeros(max(0, n - 1), np.int64)
    for k, rank in reversed(levels):
        i, j = where[np.minimum(left, len(ids))], where[np.minimum(right, len(ids))]
        equal = (left < stop_left) & (right < stop_right) & (i >= 0) & (j >= 0) & (rank[i] == rank[j])
        step = np.where(equal, k, 0)
        lcp, left, right = lcp + step, left + step, right + step
    going = lcp > 0
    for _ in range(width - 1):
        inside = going & (left < stop_left) & (right < stop_right)
        going = inside & (ids[np.minimum(left, len(ids) - 1)] == ids[np.minimum(right, len(ids) - 1)])
        lcp, left, right = lcp + going, left + going, right + going
    return Suffixes(places, lcp)


def seeds(suffixes: Suffixes, least: int) -> Iterator[tuple[int, int, int]]:
    """Pairs of places that become neighbours in a class, and the common prefix that united them.

    Neighbouring suffixes are the edges, taken by decreasing common prefix. Each
    class keeps its places in order; the smaller of two classes moves into the
    larger one, and only neighbours from different classes are new.
    """
    places, lcp = suffixes.places.tolist(), suffixes.lcp
    edges = np.flatnonzero(lcp >= least)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    parent, members = {}, {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for edge, shared in zip(edges.tolist(), lcp[edges].tolist()):
        a, b = root(edge), root(edge + 1)
        small, large = members.pop(a, None) or [places[edge]], members.pop(b, None) or [places[edge + 1]]
        if len(small) > len(large):
            small, large, a, b = large, small, b, a
        at = [bisect_left(large, p) for p in small]
        last = len(small) - 1
        for i, (p, k) in enumerate(zip(small, at)):
            if k and (i == 0 or at[i - 1] != k):
                yield large[k - 1], p, shared
            if k < len(large) and (i == last or at[i + 1] != k):
                yield p, large[k], shared
        for p, k in zip(reversed(small), reversed(at)):
            large.insert(k, p)
        parent[a] = b
        members[b] = large


def runs_of(ids: np.ndarray, offsets: np.ndarray, limits: Limits) -> np.ndarray:
    """Runs in the word sequences ``ids[offsets[d]:offsets[d + 1]]``: rows of document, start, length, period, in order.

    Two neighbours at a distance within their common prefix make a repetition
    whose smallest period is that distance; if the words before them differ, it
    starts there and can't be longer, so that each run is found once.
    """
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    ends = offsets[1:][doc] if len(doc) else doc
    least = limits.prefix
    if len(ids) < 2:
        return np.zeros((0, 4), np.int64)
    found = np.fromiter((x for p, q, shared in seeds(sort_suffixes(ids, doc, ends, least), least)
                         if q - p <= shared for x in (p, q, shared)), np.int64).reshape(-1, 3)
    p, q, shared = found.T
    period, length = q - p, q - p + shared
    begins = offsets[:-1][doc[p]]
    starts = (p == begins) | (ids[p - 1] != ids[q - 1])
    picked = starts & (length >= limits.length(period))
    rows = np.stack([doc[p], p - begins, length, period], axis=1)[picked]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, limits: Limits = Limits(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every periodic run of words in every document: ``key``, n_words, runs (start, length, period), collapsed.

    A word is a run of bytes outside 0x20 and 0x09-0x0D. A run is a stretch of
    words with smallest period ``period``, within the limits, that can't be
    extended; runs are listed by start, then period. ``collapsed`` is the text's
    words joined by one space, without those that lie in a run after its first
    period. Null and empty texts have no words, no runs and an empty collapsed
    text. Repeated rows and equal keys are judged each, a null key is kept, an
    empty table gives no rows, other columns are ignored.

    Documents are judged one by one, in slices of a few MB or of one longer
    document; there is no shuffle. Memory is a small multiple of the slice.
    """
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ragged.slices(batches, "text", SLICE_BYTES):
            words, offsets = ragged.split_words(ragged.texts(batch, "text"))
            _, ids = ragged.dictionary(words)
            rows = runs_of(ids, offsets, limits)
            change = np.zeros(len(ids) + 1, np.int64)
            begins = offsets[rows[:, 0]] + rows[:, 1]
            np.add.at(change, begins + rows[:, 3], 1)
            np.add.at(change, begins + rows[:, 2], -1)
            keep = np.cumsum(change)[:-1] == 0
            kept = np.concatenate([[0], np.cumsum(keep)])[offsets]
            left = words if keep.all() else words.filter(pa.array(keep))
            collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept, pa.int32()), left), " ")
            counts = np.concatenate([[0], np.cumsum(np.bincount(rows[:, 0], minlength=batch.num_rows))])
            listed = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(rows[:, i]) for i in (1, 2, 3)], fields=list(RUNS.value_type)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), listed, collapsed], names=["key", "n_words", "runs", "collapsed"])

    chosen = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    found = chosen.mapInArrow(
        find, f"key {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return found.select(F.col("key").alias(key), "n_words", "runs", "collapsed")


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period of a list in order; the first of equal ones; null without any."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def runs_text(runs: Column) -> Column:
    """One line of ``start,length,period`` for each run."""
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                              r["period"].cast("string"), F.lit("\n"))
    return F.array_join(F.transform(runs, line), "")


def looped(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents of which one in ten loops from a word on: ``key`` and ``text``.

    With h = crc32 of the decimal key and g = h div 10, a text whose h is
    divisible by 10 repeats, from word a = g mod n on, the next
    1 + (n - a) div (3 + g mod 8) words up to its old number of words. Other
    texts, those without words and those without a key stay as they are.
    """
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    rows = docs.select(F.col(key), F.col(text).cast("string").alias(text), h.alias("_h"), F.floor(h / 10).alias("_g"))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    # Nested so that each value is computed once; texts that don't loop aren't split.
    rows = rows.withColumn("_words", F.when(F.col("_h") % 10 == 0, words))
    n = F.size("_words")
    a = F.col("_g") % n
    period = 1 + F.floor((n - F.col("_a")) / (3 + F.col("_g") % 8))
    rows = rows.withColumn("_a", F.when(n > 0, a).cast("int")).withColumn("_p", period.cast("int"))
    unit = F.slice("_words", F.col("_a") + 1, F.col("_p"))
    times = F.ceil((n - F.col("_a")) / F.col("_p")).cast("int")
    loop = F.slice(F.flatten(F.array_repeat(unit, times)), F.lit(1), n - F.col("_a"))
    text_of = F.array_join(F.concat(F.slice("_words", F.lit(1), F.col("_a")), loop), " ")
    return rows.select(key, F.when(F.col("_a").isNotNull(), text_of).otherwise(F.col(text)).alias(text))
