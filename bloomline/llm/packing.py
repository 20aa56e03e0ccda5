"""Documents to fixed-length token sequences: cutting, and bounded-space best-fit packing."""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from bloomline.llm import ragged
from bloomline.llm.bpe import merges
from bloomline.session import materialize

CACHED = 400_000  # distinct pieces kept by a worker process; only speed depends on it
LETTERS = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"


class Encoder:
    """Token ids of texts under a vocabulary that drops white space and marks word ends."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library, self.merges = Tokenizer.from_file(path), merges(path)
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.offsets = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _learn(self, values: pa.Array, names: list[str]) -> None:
        """Words of Latin letters merge in numpy; everything else goes through the library."""
        if len(self.known) + len(names) > CACHED:
            self._clear()
        fresh = np.fromiter((p not in self.known for p in names), dtype=bool, count=len(names))
        latin = np.asarray(pc.match_substring_regex(values, LETTERS)).astype(bool)
        simple, other = values.filter(pa.array(fresh & latin)), values.filter(pa.array(fresh & ~latin)).to_pylist()
        data, offsets = ragged.raw_bytes(pc.utf8_lower(simple))
        flat, out = self.merges.encode(data, offsets)
        coded = [e.ids for e in self.library.encode_batch(other, add_special_tokens=False)]
        sizes = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
        ids = np.fromiter((i for e in coded for i in e), dtype=np.int64, count=int(sizes.sum()))
        self.flat = np.concatenate([self.flat, flat, ids])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + out[1:], self.offsets[-1] + out[-1] + np.cumsum(sizes)])
        at = len(self.known)
        self.known.update(zip(simple.to_pylist() + other, range(at, at + len(simple) + len(other))))

    def batch(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and their offsets.

        No token spans white space, and a letter never shares one with a full
        stop or comma after it, so texts fall into pieces there and each
        distinct piece is encoded once. Texts that may hold a special string
        are encoded whole.
        """
        special = np.asarray(pc.match_substring(column, "<|")).astype(bool)
        plain = column if not special.any() else pc.if_else(pa.array(special), "", column)
        plain = pc.replace_substring(pc.ascii_lower(plain), "\n", " ")
        plain = pc.replace_substring_regex(plain, r"([a-zß-öø-ÿ])([.,])", r"\1 \2")
        lists = pc.split_pattern(plain, " ")
        values, index = ragged.dictionary(lists.flatten())
        ends = np.asarray(lists.offsets, dtype=np.int64) - lists.offsets[0].as_py()
        names = values.to_pylist()
        self._learn(values, names)
        place = np.fromiter((self.known[p] for p in names), dtype=np.int64, count=len(names))
        at, out = ragged.positions(self.offsets, place[index])
        ids, offsets = self.flat[at], out[ends]
        if special.any():
            parts = [ids[offsets[i]:offsets[i + 1]] for i in range(len(column))]
            for i in np.flatnonzero(special).tolist():
                parts[i] = np.array(self.library.encode(column[i].as_py(), add_special_tokens=False).ids, dtype=np.int64)
            ids = np.concatenate(parts)
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, offsets


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut_pieces(docs: DataFrame, vocabulary: str, capacity: int, separator: int = 0,
               key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's ids and a closing separator, cut into pieces of at most ``capacity`` ids."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for batch in ragged.slices(batches, "text", 4 << 20):
            ids, offsets = own.batch(ragged.texts(batch, "text"))
            sizes = np.diff(offsets) + 1
            flat = np.full(int(sizes.sum()), separator, dtype="<u4")
            begins = np.concatenate([[0], np.cumsum(sizes)])
            flat[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes - 1)] = ids
            count = -(-sizes // capacity)
            owner = np.repeat(np.arange(len(sizes)), count)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * capacity
            length = np.minimum(capacity, sizes[owner] - start)
            raw = memoryview(flat).cast("B")
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in
                   zip((begins[owner] + start).tolist(), (begins[owner] + start + length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), pa.array(piece.astype(np.int32)), pa.array(start),
                 pa.array(length), pa.array(crc, pa.int64())],
                names=["key", "piece", "start", "length", "ids_crc32"])

    chosen = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    return chosen.mapInArrow(cut, f"key {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: list[int], capacity: int, open_bins: int) -> tuple[list[int], list[int]]:
    """Online best fit with at most ``open_bins`` open bins: bin number and offset of each item.

    Bit ``f`` of ``free`` is set while some open bin has ``f`` units left. An
    item goes to the lowest set bit at or above its length, the tightest fit. If
    no bin has room and all are in use, the fullest (the lowest set bit) closes.
    """
    free, by_space, opened, made = 0, [[] for _ in range(capacity + 1)], 0, 0
    where, offset = [], []
    for n in lengths:
        fits = free >> n
        if fits:
            space = n + (fits & -fits).bit_length() - 1
            bin_number = by_space[space].pop()
            opened -= 1
        else:
            if opened == open_bins:
                fullest = (free & -free).bit_length() - 1
                by_space[fullest].pop()
                opened -= 1
                if not by_space[fullest]:
                    free &= ~(1 << fullest)
            space, bin_number, made = capacity, made, made + 1
        if space < capacity and not by_space[space]:
            free &= ~(1 << space)
        where.append(bin_number)
        offset.append(capacity - space)
        left = space - n
        if left:
            by_space[left].append(bin_number)
            free |= 1 << left
            opened += 1
    return where, offset


#: Bits of a sequence's number: round, group, bin within the group.
GROUP_BITS, BIN_BITS = 38, 18
ROUNDS, LARGEST_GROUP = 127, 1 << (BIN_BITS - 2)
LEAST_SAVED = 1 / 256  # a round that saves a smaller share of the bins it packed again is the last


def _pack_once(items: DataFrame, groups: int, level: int, capacity: int, open_bins: int) -> DataFrame:
    """Pack items (id, length) within hashed groups: adds offset and sequence, a number of its own for each round, group and bin."""
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("id", "ascending")])
        where, offset = best_fit(table["length"].to_pylist(), capacity, open_bins)
        first = (level << GROUP_BITS | table["group"][0].as_py()) << BIN_BITS
        return pa.table({"id": table["id"], "length": table["length"],
                         "sequence": pa.array([first + b for b in where], pa.int64()), "offset": pa.array(offset, pa.int64())})

    return (items.withColumn("group", F.pmod(F.xxhash64("id"), F.lit(groups)))
            .groupBy("group").applyInArrow(pack, "id long, length long, sequence long, offset long"))


def pack_sequences(docs: DataFrame, vocabulary: str, capacity: int = 2048, separator: int = 0,
                   open_bins: int = 2048, group_items: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack documents into sequences of at most ``capacity`` tokens.

    Result: ``key``, piece, start, length, ids_crc32, sequence_id, offset, one
    row per piece; a document is its token ids and ``separator``. Only longer
    documents are cut. Null and empty texts are the separator alone; repeated
    rows are packed each; an empty table gives no rows; other columns are ignored.

    Pieces are written once. Pieces of full length are sequences already. The
    rest are dealt by hash into groups of about ``group_items``; each group is
    packed by bounded-space best fit. Bins with room for the shortest one left are
    items of the next round, dealt anew into groups of the same size, until one
    group holds them or a round hardly saves any.
    """
    if group_items > LARGEST_GROUP:
        raise ValueError(f"group_items is at most {LARGEST_GROUP}")
    pieces = materialize(
        cut_pieces(docs, vocabulary, capacity, separator, key, text).withColumn("id", F.monotonically_increasing_id()),
        "pieces")
    # Numbers of packed sequences are 0 or more.
    full = pieces.where(F.col("length") == capacity).select(
        "*", (-1 - F.col("id")).alias("sequence"), F.lit(0).cast("long").alias("offset"))
    items = pieces.where(F.col("length") < capacity).select("id", "length")
    groups = max(1, math.ceil(items.count() / group_items))
    placed = materialize(_pack_once(items, groups, 0, capacity, open_bins), "packed")
    level = 0
    while groups > 1 and level < ROUNDS:
        level += 1
        bins = placed.groupBy("sequence").agg(F.sum("length").alias("length"))
        slack = bins.where(F.col("length") <= capacity - capacity // 64).withColumnRenamed("sequence", "id")
        slack = materialize(slack, "slack")
        # A bin without room for the shortest one can't be put together with any.
        shortest = slack.agg(F.min("length")).first()[0]
        if shortest is None:
            break
        slack = slack.where(F.col("length") <= capacity - shortest)
        before = slack.count()
        if before < 2:
            break
        groups = max(1, math.ceil(before / group_items))
        moved = materialize(_pack_once(slack, groups, level, capacity, open_bins), "repacked").select(
            F.col("id").alias("sequence"), F.col("sequence").alias("to"), F.col("offset").alias("shift"))
        placed = placed.join(moved, "sequence", "left").select(
            "id", F.coalesce("to", "sequence").alias("sequence"),
            (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"), "length")
        # A bin's first item lies at its beginning.
        if before - moved.where("shift = 0").count() < LEAST_SAVED * before:
            break
    rest = pieces.join(placed.drop("length"), "id").select(*full.columns)
    out = full.unionByName(rest)
    return out.select(F.col("key").alias(key), "piece", "start", "length", "ids_crc32",
                      F.col("sequence").alias("sequence_id"), "offset")
