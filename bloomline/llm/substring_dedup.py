"""Passages that repeat across documents: MinHash banding over paragraphs, exact verification, components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from bloomline.llm import ragged
from bloomline.llm.components import components
from bloomline.llm.url_filters import build_filter, may_hold
from bloomline.session import materialize

SHARD_BYTES = 16 << 20  # text behind one shard of packed rows
SLICE_BYTES = 2 << 20  # text whose paragraphs are in memory at once
STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """Shingle width, similarity, and the bands tuned to it: a pair at the similarity collides with ``recall``."""
    width: int = 5
    similarity: float = 0.8
    rows: int = 2
    recall: float = 0.997
    least_words: int = 20
    most: int = 1024

    @property
    def bands(self) -> int:
        """Fewest bands b with 1 - (1 - s^rows)^b >= recall."""
        b = 1
        while 1 - (1 - self.similarity ** self.rows) ** b < self.recall:
            b += 1
        return b

    @property
    def least_shingles(self) -> int:
        """Shorter paragraphs can't reach the similarity without equal shingles: m of m + 1 is the closest."""
        m = 1
        while m / (m + 1) < self.similarity:
            m += 1
        return m


SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
STOPS = np.zeros(256, dtype=bool)
STOPS[[33, 46, 63]] = True


@dataclass
class Paragraphs:
    """Paragraphs of a slice of documents that have at least one shingle, in order."""
    doc: np.ndarray      # row in the slice
    ordinal: np.ndarray  # number among the document's paragraphs
    start: np.ndarray    # byte range in the document
    end: np.ndarray
    words: np.ndarray
    uid: np.ndarray      # hash of the word sequence
    shingles: np.ndarray
    offsets: np.ndarray  # shingles of paragraph i: offsets[i]:offsets[i + 1]


def paragraphs(column: pa.Array, width: int) -> Paragraphs:
    """Cut texts after each word that ends in . ! or ?, and at line ends; drop paragraphs of under ``width`` words.

    Sentences are the paragraphs, since passages are often copied into the
    middle of a line. Words are runs outside 0x20 and 0x09-0x0D, A-Z lower-cased.
    """
    data, texts = ragged.raw_bytes(column)
    text_of = np.repeat(np.arange(len(column)), np.diff(texts))
    blank = SPACES[data]
    fresh = np.ones(len(data), dtype=bool)
    fresh[1:] = blank[:-1] | (text_of[1:] != text_of[:-1])
    starts = np.flatnonzero(fresh & ~blank)
    last = np.ones(len(data), dtype=bool)
    last[:-1] = fresh[1:] | blank[1:]
    ends = np.flatnonzero(last & ~blank) + 1
    values, index = ragged.dictionary(ragged.split_words(pc.ascii_lower(column))[0])
    hashes = ragged.hash_values(values)[index]
    count = len(starts)
    lines = np.cumsum(data == 10)
    cut = np.zeros(count + 1, dtype=bool)
    cut[0] = cut[count] = True
    if count:
        doc = text_of[starts]
        cut[1:count] = STOPS[data[ends[:-1] - 1]] | (lines[starts[1:]] != lines[starts[:-1]]) | (doc[1:] != doc[:-1])
    edges = np.flatnonzero(cut) if count else np.zeros(1, dtype=np.int64)
    sizes = np.diff(edges)
    keep = sizes >= width
    first, sizes = edges[:-1][keep], sizes[keep]
    owner = text_of[starts[first]] if len(first) else np.zeros(0, dtype=np.int64)
    head = np.searchsorted(owner, owner)
    place, at = ragged.positions(np.append(edges, edges[-1]), np.flatnonzero(keep))
    within = np.arange(len(place)) - np.repeat(at[:-1], sizes)
    uid = ragged.segment_sum(ragged.mix64(hashes[place] + STEP * within.astype(np.uint64)), at) if len(place) else np.zeros(0, np.uint64)
    grams = np.zeros(max(0, count - width + 1), dtype=np.uint64)
    for k in range(width):
        grams = ragged.mix64(grams * STEP + hashes[k:count - width + 1 + k]) if len(grams) else grams
    each = sizes - width + 1
    offsets = np.concatenate([[0], np.cumsum(each)])
    shingles = grams[np.arange(offsets[-1]) + np.repeat(first - offsets[:-1], each)]
    return Paragraphs(owner, np.arange(len(first)) - head, starts[first] - texts[owner], ends[first + sizes - 1] - texts[owner],
                      sizes, uid, shingles, offsets)


def band_keys(found: Paragraphs, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Distinct paragraphs long enough for near copies, and their key in each band (paragraphs x bands)."""
    long = np.flatnonzero(np.diff(found.offsets) >= settings.least_shingles)
    _, one = np.unique(found.uid[long], return_index=True)
    picked = long[one]
    at, offsets = ragged.positions(found.offsets, picked)
    shingles = found.shingles[at]
    keys = np.zeros((len(picked), settings.bands), dtype=np.uint64)
    for b in range(settings.bands):
        for r in range(settings.rows):
            seed = ragged.mix64(np.array([b * settings.rows + r + 1], dtype=np.uint64))[0]
            least = ragged.segment_reduce(np.minimum, ragged.mix64(shingles ^ seed), offsets, 0)
            keys[:, b] = ragged.mix64(keys[:, b] + least + np.uint64(b))
    return picked, keys


def _by_shard(shard: np.ndarray, columns: list[np.ndarray]) -> tuple[pa.Array, list[pa.Array]]:
    """Rows to one packed row per shard: the shards, and each column's values as bytes."""
    order = np.argsort(shard, kind="stable")
    found, begins = np.unique(shard[order], return_index=True)
    packed = [pa.array([part.tobytes() for part in np.split(c[order], begins[1:])], pa.binary()) for c in columns]
    return pa.array(found, pa.int64()), packed


def _joined(table: pa.Table, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(table[name].to_pylist()), dtype=kind)


def shard_count(docs: DataFrame, text: str, least: int = 32) -> int:
    """Shards of packed rows so that each stands for about ``SHARD_BYTES`` of text, but at least so many."""
    size = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    return max(least, -(-size // SHARD_BYTES))


def colliding(docs: DataFrame, shards: int, settings: Settings) -> DataFrame:
    """Groups of different paragraphs that share a band: (bucket, uid). Equal groups of several bands count once."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ragged.slices(batches, "text", SLICE_BYTES):
            found = paragraphs(ragged.texts(batch, "text"), settings.width)
            picked, keys = band_keys(found, settings)
            uid = np.repeat(found.uid[picked], settings.bands)
            flat = keys.ravel()
            shard, packed = _by_shard(((flat & np.uint64(0xFFFFFFFF)) % np.uint64(shards)).astype(np.int64),
                                      [(flat >> np.uint64(32)).astype("<u4"), uid.astype("<u8")])
            yield pa.RecordBatch.from_arrays([shard, *packed], names=["shard", "keys", "uids"])

    def meet(table: pa.Table) -> pa.Table:
        key, uid = _joined(table, "keys", "<u4"), _joined(table, "uids", "<u8")
        order = np.lexsort((uid, key))
        key, uid = key[order], uid[order]
        keep = np.concatenate([[True], (key[1:] != key[:-1]) | (uid[1:] != uid[:-1])])
        key, uid = key[keep], uid[keep]
        edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        sizes = np.diff(edges)
        group = np.repeat(np.arange(len(sizes)), sizes)
        several = np.repeat(sizes > 1, sizes)
        # A group is named by its members, so the same group in another band has the same name.
        name = ragged.mix64(ragged.segment_sum(ragged.mix64(uid), edges) + STEP * sizes.astype(np.uint64))
        return pa.table({"bucket": name[group[several]].view(np.int64), "uid": uid[several].view(np.int64)})

    return (docs.mapInArrow(emit, "shard long, keys binary, uids binary")
            .groupBy("shard").applyInArrow(meet, "bucket long, uid long").distinct())


def shingle_sets(docs: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """(uid, shingles) of the wanted paragraphs: a second pass, thinned by a bounded Bloom filter of their uids."""
    table = build_filter(wanted.select(F.col("uid").cast("string").alias("k")), "k")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ragged.slices(batches, "text", SLICE_BYTES):
            found = paragraphs(ragged.texts(batch, "text"), settings.width)
            long = np.flatnonzero(np.diff(found.offsets) >= settings.least_shingles)
            _, one = np.unique(found.uid[long], return_index=True)
            picked = long[one]
            names = pa.array(found.uid[picked].view(np.int64)).cast(pa.string())
            picked = picked[may_hold(table, ragged.hash_values(names))] if len(picked) else picked
            sets = [np.unique(found.shingles[found.offsets[i]:found.offsets[i + 1]]).tobytes() for i in picked.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(found.uid[picked].view(np.int64)), pa.array(sets, pa.binary())], names=["uid", "shingles"])

    return docs.mapInArrow(emit, "uid long, shingles binary").groupBy("uid").agg(F.first("shingles").alias("shingles"))


def verified(uids: list[int], sides: list[int], sets: list[bytes], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of a group's paragraphs whose exact Jaccard similarity reaches the limit.

    Pairs that are connected already need no comparison, so a group of near
    copies costs about one comparison a member.
    """
    shingles = [frozenset(np.frombuffer(s, "<u8").tolist()) for s in sets]
    root = list(range(len(uids)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links: list[tuple[int, int]] = []
    for i in range(1, len(uids)):
        for j in range(i):
            if sides[i] == sides[j] != 1 or top(i) == top(j):
                continue
            a, b = shingles[i], shingles[j]
            if min(len(a), len(b)) < similarity * max(len(a), len(b)):
                continue
            common = len(a & b)
            if common >= similarity * (len(a) + len(b) - common):
                root[max(top(i), top(j))] = min(top(i), top(j))
                links.append((uids[i], uids[j]))
    return np.array([a for a, _ in links], dtype=np.int64), np.array([b for _, b in links], dtype=np.int64)


def verified_links(groups: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) between paragraphs of a group; a large group is dealt into pairs of tiles, each a task's work of its own."""
    most = settings.most
    sizes = groups.groupBy("bucket").agg(F.ceil(F.count("*") / F.lit(most)).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int")
    dealt = groups.join(sizes, "bucket").withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = dealt.select(
        F.xxhash64("bucket", F.least("part", "other"), F.greatest("part", "other")).alias("cell"),
        F.when(F.col("part") == F.col("other"), 1).when(F.col("part") < F.col("other"), 0).otherwise(2).alias("side"), "uid").join(sets, "uid")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, uids, sides, found = None, [], [], []

        def links() -> pa.RecordBatch:
            a, b = verified(uids, sides, found, settings.similarity)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            for c, side, uid, shingles in zip(*(batch.column(n).to_pylist() for n in ("cell", "side", "uid", "shingles"))):
                if c != cell and uids:
                    yield links()
                    uids, sides, found = [], [], []
                cell = c
                uids.append(uid)
                sides.append(side)
                found.append(shingles)
        if uids:
            yield links()

    return (cells.select("cell", "side", "uid", "shingles").repartition("cell").sortWithinPartitions("cell", "uid")
            .mapInArrow(compare, "a long, b long"))


def occurrences(docs: DataFrame, classes: DataFrame, shards: int, settings: Settings) -> DataFrame:
    """Every paragraph that occurs in several documents or has near copies.

    (root, linked, key, row, ordinal, start, end, words, keeper): ``keeper`` is
    the smallest document with the same words; for linked paragraphs that of
    the class has yet to be found. Repeated rows count once.
    """
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ragged.slices(batches, "text", SLICE_BYTES):
            found = paragraphs(ragged.texts(batch, "text"), settings.width)
            key = np.asarray(pc.fill_null(batch.column(0), np.iinfo(np.int64).max), dtype=np.int64)[found.doc]
            row = np.asarray(batch.column(1), dtype=np.int64)[found.doc]
            numbers = np.stack([found.ordinal, found.start, found.end, found.words], axis=1).astype("<i4")
            records = np.rec.fromarrays([key, row, numbers], dtype=RECORD) if len(key) else np.zeros(0, RECORD)
            shard, packed = _by_shard((found.uid % np.uint64(shards)).astype(np.int64), [found.uid.astype("<u8"), records])
            yield pa.RecordBatch.from_arrays([shard, *packed], names=["shard", "uids", "places"])

    def resolve(places: pa.Table, linked: pa.Table) -> pa.Table:
        if not places.num_rows:
            return pa.table({n: pa.array([], t) for n, t in OCCURRENCE})
        uid, place = _joined(places, "uids", "<u8"), _joined(places, "places", RECORD)
        order = np.lexsort((place["n"][:, 0], place["row"], place["key"], uid))
        uid, place = uid[order], place[order]
        same = (uid[1:] == uid[:-1]) & (place["key"][1:] == place["key"][:-1]) & (place["row"][1:] == place["row"][:-1]) & (
            place["n"][1:, 0] == place["n"][:-1, 0])
        keep = np.concatenate([[True], ~same])
        uid, place = uid[keep], place[keep]
        begins = np.flatnonzero(np.concatenate([[True], uid[1:] != uid[:-1]]))
        sizes = np.diff(np.append(begins, len(uid)))
        known = np.asarray(linked["node"], dtype=np.int64).view(np.uint64)
        roots = np.asarray(linked["root"], dtype=np.int64)
        by = np.argsort(known)
        known, roots = known[by], roots[by]
        distinct = uid[begins]
        at = np.minimum(np.searchsorted(known, distinct), max(0, len(known) - 1))
        is_linked = known[at] == distinct if len(known) else np.zeros(len(distinct), bool)
        root = np.where(is_linked, roots[at] if len(known) else 0, distinct.view(np.int64))
        group = np.repeat(np.arange(len(sizes)), sizes)
        keeper = place["key"][begins][group]
        chosen = is_linked[group] | (sizes > 1)[group]
        numbers = place["n"][chosen]
        return pa.table({
            "root": root[group][chosen], "linked": is_linked[group][chosen], "key": place["key"][chosen], "row": place["row"][chosen],
            **{n: numbers[:, i].astype(np.int32) for i, n in enumerate(("ordinal", "start", "end", "words"))}, "keeper": keeper[chosen]})

    packed = docs.select("key", "row", "text").mapInArrow(emit, "shard long, uids binary, places binary")
    mapped = classes.withColumn("shard", F.expr(f"cast(cast(cast(node as decimal(20,0)) + if(node < 0, 18446744073709551616BD, 0BD) as decimal(20,0)) % {shards} as long)"))
    kinds = ", ".join(f"{n} {'boolean' if n == 'linked' else 'int' if t == pa.int32() else 'long'}" for n, t in OCCURRENCE)
    return packed.groupBy("shard").cogroup(mapped.groupBy("shard")).applyInArrow(resolve, kinds)


RECORD = np.dtype([("key", "<i8"), ("row", "<i8"), ("n", "<i4", (4,))])
OCCURRENCE = [("root", pa.int64()), ("linked", pa.bool_()), ("key", pa.int64()), ("row", pa.int64()), ("ordinal", pa.int32()),
              ("start", pa.int32()), ("end", pa.int32()), ("words", pa.int32()), ("keeper", pa.int64())]


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Documents by their key as a long, and the text's hash, which tells rows that share a key apart."""
    chosen = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return chosen.select("key", F.xxhash64("text").alias("row"), "text")


def repeated_passages(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Passages that an earlier document has too: ``key``, row, start, end, n_words, source_id, class_id.

    Paragraphs (sentences of five words or more) are linked if equal, or if
    their five-word shingles reach the Jaccard similarity; linked paragraphs
    form classes. The occurrence in the smallest document stays; those in other
    documents are marked. Neighbouring marked paragraphs (shorter sentences
    between them don't count) with the same ``source_id`` are one passage, a
    byte range of the text; runs of under ``least_words`` marked words in all
    are left alone. ``source_id`` is the document that keeps the passage's
    paragraphs, ``class_id`` the class of its first paragraph, ``row`` the hash
    of the text.

    ``key`` is an integer; a null key comes after all others. Null, empty and
    short texts have no passages. Repeated rows (same key and text) count as one
    document; so do different texts of one key, whose passages stay in both. An
    empty table gives no rows; other columns are ignored.
    """
    keyed = _keyed(docs, key, text)
    shards = shard_count(keyed, "text")
    groups = materialize(colliding(keyed.select("text"), shards, settings), "groups")
    wanted = groups.select("uid").distinct()
    # The filter may let others pass; the join with the groups drops them.
    links = verified_links(groups, shingle_sets(keyed.select("text"), wanted, settings), settings)
    classes = components(links)
    found = materialize(occurrences(keyed, classes, shards, settings), "occurrences")
    keepers = found.where("linked").groupBy("root").agg(F.min("keeper").alias("first"))
    linked = found.where("linked").join(keepers, "root").withColumn("keeper", F.col("first")).drop("first")
    marked = found.where("NOT linked").unionByName(linked).where("keeper <> key")
    # Consecutive ordinals less their rank are equal within a run.
    rank = F.expr("row_number() OVER (PARTITION BY key, row ORDER BY ordinal)")
    runs = marked.withColumn("run", F.col("ordinal") - rank)
    runs = runs.withColumn("total", F.expr("sum(words) OVER (PARTITION BY key, row, run)")).where(F.col("total") >= settings.least_words)
    spans = runs.groupBy("key", "row", "run", "keeper").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("n_words"), F.min_by("root", "ordinal").alias("class_id"))
    none = np.iinfo(np.int64).max
    return spans.select(F.when(F.col("key") != none, F.col("key")).alias(key), "row", "start", "end", "n_words",
                        F.when(F.col("keeper") != none, F.col("keeper")).alias("source_id"), "class_id")


def remove_passages(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text",
                    length: str = "n_chars") -> DataFrame:
    """``docs`` without their repeated passages; a document that is left without words goes.

    All columns stay; ``length``, where present, is set to the characters left
    in changed texts. Untouched documents, also empty ones, stay as they are.
    """
    extra = "_spans"
    while extra in docs.columns:
        extra = "_" + extra
    spans = repeated_passages(docs, settings, key, text).groupBy(F.col(key).alias("_key"), F.col("row").alias("_row")).agg(
        F.collect_list(F.struct("start", "end")).alias(extra))
    joined = docs.join(spans, docs[key].cast("long").eqNullSafe(spans["_key"]) & (F.xxhash64(docs[text].cast("string")) == spans["_row"]), "left")
    joined = joined.select(*[docs[c] for c in docs.columns], spans[extra])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans_of = batch.column(batch.num_columns - 1).to_pylist()
            touched = [i for i, s in enumerate(spans_of) if s]
            columns = {n: batch.column(i) for i, n in enumerate(names)}
            keep = np.ones(batch.num_rows, dtype=bool)
            if touched:
                texts = columns[text].to_pylist()
                sizes = columns[length].to_pylist() if length in columns else None
                for i in touched:
                    raw, at, parts = texts[i].encode(), 0, []
                    for s in sorted(spans_of[i], key=lambda s: s["start"]):
                        parts.append(raw[at:max(at, s["start"])])
                        at = max(at, s["end"])
                    parts.append(raw[at:])
                    left = b"".join(parts)
                    keep[i] = bool(left.split())
                    texts[i] = left.decode()
                    if sizes:
                        sizes[i] = len(texts[i])
                columns[text] = pa.array(texts, columns[text].type)
                if sizes:
                    columns[length] = pa.array(sizes, columns[length].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names).filter(pa.array(keep))

    names = docs.columns
    return joined.mapInArrow(cut, docs.schema)
