"""Text probabilities from logistic mixing of hashed-context bit predictors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from bloomline.llm import ragged
from bloomline.llm.substring_dedup import shard_count
from bloomline.session import materialize, scratch_path

END = 0x20  # closes every token; no word holds it
LEVELS = 8  # confidence levels of the longest context that gate the weights
STEP = np.uint64(0x9E3779B97F4A7C15)
SALTS = np.arange(1, 17, dtype=np.uint64) * STEP


@dataclass(frozen=True)
class Settings:
    """Sizes of the model; ``head`` bytes of a token are predicted by one model of all tokens, the rest by its shard's."""
    topics: int = 8
    turns: int = 5
    head: int = 4
    head_bits: int = 18
    tail_bits: int = 21
    head_orders: tuple[int, ...] = (1, 2)
    tail_orders: tuple[int, ...] = (1, 2, 3, 4, 6)
    rate: float = 0.02
    step: int = 256
    chunk: int = 1 << 13
    doubt: float = 0.05


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -18, 18)))


#: Byte classes of the frequency vectors: each letter, digits, other ASCII, and 32 classes of the other bytes.
CLASSES = np.array([b - 97 if 97 <= b <= 122 else b - 65 if 65 <= b <= 90 else 26 if 48 <= b <= 57 else 28 + b % 32 if b >= 128 else 27
                    for b in range(256)])
WIDTH = 60


def _frequencies(docs: DataFrame) -> DataFrame:
    """Shares of the byte classes in each training text, as one packed row per slice."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ragged.slices(batches, "text"):
            data, offsets = ragged.raw_bytes(ragged.texts(batch, "text"))
            keep = ~BLANK[data]
            owner = np.repeat(np.arange(batch.num_rows), np.diff(offsets))[keep]
            counts = np.bincount(owner * WIDTH + CLASSES[data[keep]], minlength=batch.num_rows * WIDTH).reshape(-1, WIDTH).astype(np.float64)
            shares = counts / np.maximum(1, counts.sum(axis=1, keepdims=True))
            yield pa.RecordBatch.from_arrays([pa.array([shares[counts.sum(axis=1) > 0].astype("<f4").tobytes()], pa.binary())], names=["shares"])

    return docs.where("train").select("text").mapInArrow(emit, "shares binary")


BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def _summed(frame: DataFrame, fn, size: int) -> np.ndarray:
    """Sum over all slices of ``fn(shares)``, an array of ``size`` numbers, which is also all that the driver gets."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for x in batch.column(0).to_pylist():
                total += fn(np.frombuffer(x, "<f4").reshape(-1, WIDTH).astype(np.float64))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["at", "n"])

    out = np.zeros(size)
    for r in frame.mapInArrow(emit, "at long, n double").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]
    # Sums of doubles depend on their order: rounding makes reruns agree.
    return np.round(out, 6)


def topic_centres(docs: DataFrame, settings: Settings) -> np.ndarray:
    """Centres of the training texts' byte frequencies: k-means from the cells of the leading principal components."""
    frame = materialize(_frequencies(docs), "frequencies")
    moments = _summed(frame, lambda x: np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()]), 1 + WIDTH + WIDTH * WIDTH)
    count, mean = max(1.0, moments[0]), moments[1:1 + WIDTH] / max(1.0, moments[0])
    spread = moments[1 + WIDTH:].reshape(WIDTH, WIDTH) / count - np.outer(mean, mean)
    axes = np.linalg.eigh(spread)[1][:, ::-1][:, :int(np.log2(settings.topics))]

    def centres(assign) -> np.ndarray:
        sums = _summed(frame, lambda x: np.concatenate([
            np.bincount(assign(x), minlength=settings.topics),
            np.stack([np.bincount(assign(x), weights=x[:, i], minlength=settings.topics) for i in range(WIDTH)], axis=1).ravel()]),
            settings.topics * (1 + WIDTH))
        sizes, total = sums[:settings.topics], sums[settings.topics:].reshape(settings.topics, WIDTH)
        return np.where(sizes[:, None] > 0, total / np.maximum(1, sizes)[:, None], mean)

    found = centres(lambda x: ((x - mean) @ axes > 0) @ (1 << np.arange(axes.shape[1])))
    for _ in range(settings.turns):
        found = centres(lambda x, c=found: np.argmin((c ** 2).sum(axis=1) - 2 * x @ c.T, axis=1))
    return found


def topics(values: pa.Array, index: np.ndarray, offsets: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """For each word and, last, each text's end: the centre nearest to the byte frequencies of the text before it.

    Words come first, in order, then the ends. Nothing before: one topic of its own.
    """
    data, edges = ragged.raw_bytes(values)
    length = np.concatenate([[0.0], np.cumsum(np.diff(edges)[index], dtype=np.float64)])
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.concatenate([np.arange(len(index)), offsets[1:]])
    start = np.concatenate([offsets[:-1][owner], offsets[:-1]])
    before = length[at] - length[start]
    found, least = np.zeros(len(at), dtype=np.int64), np.full(len(at), np.inf)
    for n, centre in enumerate(centres):
        dots = ragged.segment_sum(centre[CLASSES[data]], edges)[index]
        running = np.concatenate([[0.0], np.cumsum(dots)])
        # Rounded, so that the same beginning has the same topic wherever its text lies in a slice.
        score = np.round((centre ** 2).sum() - 2 * (running[at] - running[start]) / np.maximum(1, before), 9)
        found[score < least] = n
        least = np.minimum(least, score)
    return np.where(before > 0, found, len(centres))


class Trie:
    """Distinct (prefix, next byte) edges of sorted distinct tokens, with the training count of each.

    All contexts are functions of the prefix within the token, so an edge is
    predicted once however many tokens run through it.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, counts: np.ndarray):
        """``data`` and ``offsets`` hold the tokens in byte order, each opened by its topic and closed by ``END``."""
        # A shard has far fewer than 2^31 bytes; what is as long as all tokens together is narrow and let go early.
        sizes = np.diff(offsets)
        token = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        place = np.arange(len(data), dtype=np.int32)
        place -= offsets[:-1].astype(np.int32)[token]
        prefix = self._prefixes(data, offsets, token, place)
        shared = (token > 0) & (place < sizes.astype(np.int32)[token - 1])
        inside = np.flatnonzero(shared)
        shared[inside] = prefix[offsets[:-1][token[inside] - 1] + place[inside]] == prefix[inside]
        del inside
        by_place = np.argsort(place.astype(np.uint16 if place.max(initial=0) < 1 << 16 else np.uint32), kind="stable")
        edge = np.empty(len(data), dtype=np.int32)
        edge[by_place] = np.cumsum(~shared[by_place], dtype=np.int32) - 1
        del by_place
        self.edge, self.offsets = edge, offsets
        at = np.empty(int(edge.max(initial=-1)) + 1, dtype=np.int64)
        new = np.flatnonzero(~shared)
        at[edge[new]] = new
        del new, shared
        self.byte, self.place = data[at], place[at].astype(np.int64)
        self.count = np.bincount(edge, weights=counts[token], minlength=len(at))
        del token, place
        self.history = np.zeros(len(at), dtype=np.uint64)
        for k in range(1, 7):
            inside = self.place >= k
            self.history[inside] |= data[at[inside] - k].astype(np.uint64) << np.uint64(8 * (k - 1))
        self.topic = data[np.maximum(at - self.place, 0)].astype(np.uint64)
        self.prefix = np.where(self.place > 0, prefix[at - (self.place > 0)], np.uint64(0))

    @staticmethod
    def _prefixes(data: np.ndarray, offsets: np.ndarray, token: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Hash of each token's bytes up to and including each place."""
        power = np.multiply.accumulate(np.full(int(place.max(initial=0)) + 1, np.uint64(0xD6E8FEB86659FD93)))
        sums = data.astype(np.uint64)
        sums += np.uint64(1)
        sums *= power[place]
        np.cumsum(sums, out=sums)
        base = np.concatenate([np.zeros(1, np.uint64), sums[offsets[1:] - 1]])[:-1]
        sums -= base[token]
        for start in range(0, len(sums), 1 << 18):
            sums[start:start + (1 << 18)] = ragged.mix64(sums[start:start + (1 << 18)])
        return sums

    def contexts(self, picked: np.ndarray, orders: tuple[int, ...]) -> list[np.ndarray]:
        """Hashes of the last bytes, by order, and of the whole prefix, which comes last."""
        out = []
        for n, k in enumerate(orders):
            part = self.history[picked] & np.uint64((1 << (8 * k)) - 1)
            # Short prefixes keep their start: a context of k bytes knows when fewer precede.
            start = np.minimum(self.place[picked], k).astype(np.uint64) << np.uint64(56)
            out.append(ragged.mix64(ragged.mix64((part | start) + SALTS[n]) + self.topic[picked]))
        out.append(ragged.mix64(self.prefix[picked] + SALTS[-1]))
        return out


DEPTHS = np.arange(8, dtype=np.uint64)


def _bits(byte: np.ndarray) -> np.ndarray:
    """The eight bits of each byte, highest first."""
    return np.unpackbits(byte[:, None], axis=1)


def _slots(context: np.ndarray, byte: np.ndarray, bits: int) -> np.ndarray:
    """Table slots (edges x 8) of the context's nodes on the byte's way from its highest bit down."""
    node = (np.uint64(1) << DEPTHS)[None, :] | (byte.astype(np.uint64)[:, None] >> (np.uint64(8) - DEPTHS)[None, :])
    return (((context[:, None] + node * np.uint64(0xC2B2AE3D27D4EB4F)) * STEP) >> np.uint64(64 - bits)).astype(np.int64)


def count_bits(trie: Trie, picked: np.ndarray, orders: tuple[int, ...], bits: int, chunk: int) -> np.ndarray:
    """How often each bit followed each node, over training tokens: (contexts, slots, 2)."""
    table = np.zeros((len(orders) + 1, 2 << bits), dtype=np.float32)
    picked = picked[trie.count[picked] > 0]
    for start in range(0, len(picked), chunk):
        part = picked[start:start + chunk]
        bit, weight = _bits(trie.byte[part]), np.repeat(trie.count[part].astype(np.float32), 8)
        for n, context in enumerate(trie.contexts(part, orders)):
            np.add.at(table[n], (2 * _slots(context, trie.byte[part], bits) + bit).ravel(), weight)
    return table.reshape(len(orders) + 1, -1, 2)


class Mixer:
    """Weights by gate over the predictors' stretched probabilities, and a final adaptive table.

    Each context gives two inputs: its stretched probability, and the same
    shrunk by its confidence. The gate is the bit depth and the confidence of
    the longest context. The final table maps (gate, stretched output) to what
    was seen there, and is averaged with the output.
    """

    def __init__(self, contexts: int, settings: Settings):
        self.doubt, self.rate = np.float32(settings.doubt), settings.rate
        self.weights = np.full((8 * LEVELS, 2 * contexts), 0.5 / contexts, dtype=np.float32)
        self.squares = np.full(self.weights.shape, 1e-6)
        self.steps = 24
        self.seen = np.zeros((8 * LEVELS * self.steps, 2))

    def inputs(self, counts: np.ndarray, slots: list[np.ndarray], bit: np.ndarray, without: bool) -> tuple[np.ndarray, np.ndarray]:
        """Inputs (2 contexts x events) and gates. ``without`` takes the predicted occurrence itself out of the counts,
        so that learning sees each occurrence as new, as an online model would."""
        columns, total = [], None
        for n, slot in enumerate(slots):
            pair = counts[n][slot.ravel()]
            zero, one = pair[:, 0], pair[:, 1]
            if without:
                zero, one = np.maximum(zero - (1 - bit), 0), np.maximum(one - bit, 0)
            s = np.log((one + self.doubt) / (zero + self.doubt))
            total = zero + one
            columns += [s, s * (total / (total + 2))]
        level = np.minimum(LEVELS - 1, np.log2(total + 1)).astype(np.int64)
        return np.stack(columns), level * 8 + np.tile(np.arange(8), len(total) // 8)

    def mix(self, inputs: np.ndarray, gate: np.ndarray) -> np.ndarray:
        return np.einsum("ki,ik->i", inputs, self.weights[gate])

    def learn(self, inputs: np.ndarray, gate: np.ndarray, x: np.ndarray, bit: np.ndarray, weight: np.ndarray) -> None:
        """One online step down the coding cost of a few edges' bits; each weight's rate adapts to its past gradients."""
        error = (bit - squash(x)) * weight
        size = len(self.weights)
        total = np.bincount(gate, weights=weight, minlength=size)
        step = np.stack([np.bincount(gate, weights=error * row, minlength=size) for row in inputs], axis=1) / np.maximum(total, 1e-9)[:, None]
        self.squares += step * step
        self.weights += (self.rate * step / np.sqrt(self.squares)).astype(np.float32)

    def _cell(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        return gate * self.steps + np.clip((x + 12).astype(np.int64), 0, self.steps - 1)

    def observe(self, x: np.ndarray, gate: np.ndarray, bit: np.ndarray, weight: np.ndarray) -> None:
        flat = 2 * self._cell(x, gate) + bit
        self.seen += np.bincount(flat, weights=weight, minlength=2 * len(self.seen)).reshape(-1, 2)

    def refine(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        p = squash(x.astype(np.float64))
        pair = self.seen[self._cell(x, gate)]
        return np.clip((p + (pair[:, 1] + 30 * p) / (pair.sum(axis=1) + 30)) / 2, 1e-9, 1 - 1e-9)


def train(mixer: Mixer, trie: Trie, picked: np.ndarray, counts: np.ndarray, orders: tuple[int, ...], bits: int, settings: Settings) -> None:
    """One online pass over the training edges, in an order fixed by their hash: predict, note what came, adapt."""
    known = picked[trie.count[picked] > 0]
    known = known[np.argsort(ragged.mix64(trie.prefix[known] + trie.byte[known].astype(np.uint64) * STEP))]
    for start in range(0, len(known), settings.step):
        part = known[start:start + settings.step]
        slots = [_slots(c, trie.byte[part], bits) for c in trie.contexts(part, orders)]
        bit, weight = _bits(trie.byte[part]).ravel(), np.repeat(trie.count[part], 8)
        inputs, gate = mixer.inputs(counts, slots, bit, True)
        x = mixer.mix(inputs, gate)
        # What came before the weights settled says little about the settled output.
        if 4 * start >= len(known):
            mixer.observe(x, gate, bit, weight)
        mixer.learn(inputs, gate, x, bit, weight)


def observe_all(mixer: Mixer, trie: Trie, picked: np.ndarray, counts: np.ndarray, orders: tuple[int, ...], bits: int, chunk: int) -> None:
    """Note what came at every training edge, with settled weights."""
    known = picked[trie.count[picked] > 0]
    for start in range(0, len(known), chunk):
        part = known[start:start + chunk]
        slots = [_slots(c, trie.byte[part], bits) for c in trie.contexts(part, orders)]
        bit = _bits(trie.byte[part]).ravel()
        inputs, gate = mixer.inputs(counts, slots, bit, True)
        mixer.observe(mixer.mix(inputs, gate), gate, bit, np.repeat(trie.count[part], 8))


def edge_logs(mixer: Mixer, trie: Trie, picked: np.ndarray, counts: np.ndarray, orders: tuple[int, ...], bits: int, chunk: int) -> np.ndarray:
    """log10 probability of each picked edge's byte: the sum over its eight bits."""
    out = np.zeros(len(trie.byte))
    for start in range(0, len(picked), chunk):
        part = picked[start:start + chunk]
        slots = [_slots(c, trie.byte[part], bits) for c in trie.contexts(part, orders)]
        bit = _bits(trie.byte[part]).ravel()
        inputs, gate = mixer.inputs(counts, slots, bit, False)
        p = mixer.refine(mixer.mix(inputs, gate), gate)
        out[part] = np.log10(np.where(bit == 1, p, 1 - p)).reshape(-1, 8).sum(axis=1)
    return out


def _tokens(docs: DataFrame, shards: int, centres: np.ndarray, settings: Settings, kind: str) -> DataFrame:
    """Each slice of documents as packed rows: per shard its distinct tokens with training counts, and one row of token numbers.

    A token here is its topic's letter and its bytes.
    """
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for n, batch in enumerate(ragged.slices(batches, "text")):
            name = f"{task}-{n}"
            words, offsets = ragged.split_words(pc.ascii_lower(ragged.texts(batch, "text")))
            values, index = ragged.dictionary(words)
            texts, end = len(offsets) - 1, len(values)
            owner = np.concatenate([np.repeat(np.arange(texts), np.diff(offsets)), np.arange(texts)])
            topic = topics(values, index, offsets, centres)
            distinct, number = np.unique(np.append(index, np.full(texts, end)) * 16 + topic, return_inverse=True)
            train = np.asarray(batch.column("train")).astype(bool)
            counts = np.bincount(number[train[owner]], minlength=len(distinct))
            data, edges = ragged.raw_bytes(values)
            edges = np.append(edges, edges[-1])  # the end token has no bytes
            at, edges = ragged.positions(edges, distinct // 16)
            sizes = np.diff(edges)
            spelled = np.insert(data[at], edges[:-1], (65 + distinct % 16).astype(np.uint8))
            edges = edges + np.arange(len(edges))
            head = np.zeros(len(distinct), dtype=np.uint64)
            padded = np.append(spelled, np.zeros(settings.head + 1, np.uint8))
            for k in range(settings.head):
                head = (head << np.uint64(8)) | np.where(sizes > k, padded[edges[:-1] + 1 + k], END).astype(np.uint64)
            sizes = np.diff(edges)
            shard = (ragged.mix64(head) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            found, begins = np.unique(shard[order], return_index=True)
            rows = []
            for s, part in zip(found.tolist(), np.split(order, begins[1:])):
                at, _ = ragged.positions(edges, part)
                rows.append((s, spelled[at].tobytes(), sizes[part].astype("<i4").tobytes(), counts[part].astype("<i8").tobytes(), part.astype("<i4").tobytes()))
            # Token numbers of each text, with multiplicity: sorted, so differences are small.
            pairs, times = np.unique(owner * len(distinct) + number, return_counts=True)
            text_of, number = pairs // len(distinct), pairs % len(distinct)
            packed = pa.compress(np.diff(number, prepend=0).astype("<i4").tobytes(), "zstd", asbytes=True), pa.compress(times.astype("<i4").tobytes(), "zstd", asbytes=True)
            ends = np.searchsorted(text_of, np.arange(texts + 1)).astype("<i8").tobytes()
            total = np.diff(offsets).astype("<i8").tobytes()
            columns = list(zip(*rows))
            none = len(rows)
            keys = pa.ListArray.from_arrays(pa.array([0] * (none + 1), pa.int32()), batch.column("key").slice(0, 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * none), pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]],
                 keys, pa.array([[]] * none, pa.list_(pa.bool_())), pa.array([0] * none, pa.int64())], names=NAMES)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.nulls(1, pa.int64()), *[pa.array([x], pa.binary()) for x in (packed[0], packed[1], ends, total)],
                 pa.ListArray.from_arrays(pa.array([0, texts], pa.int32()), batch.column("key")),
                 pa.array([(~train).tolist()], pa.list_(pa.bool_())), pa.array([len(distinct)], pa.int64())], names=NAMES)

    return docs.mapInArrow(emit, f"batch string, shard long, a binary, b binary, c binary, d binary, keys array<{kind}>, "
                                 "held array<boolean>, size long")


NAMES = ["batch", "shard", "a", "b", "c", "d", "keys", "held", "size"]


def _shard_tokens(table: pa.Table) -> pa.Table:
    """A shard's tokens over all slices: distinct, in byte order, with summed counts, and where each slice's went."""
    data = np.frombuffer(b"".join(table["a"].to_pylist()), dtype=np.uint8)
    rows = [np.frombuffer(x, "<i4") for x in table["b"].to_pylist()]
    sizes = np.concatenate(rows).astype(np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    tokens = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(edges.astype("<i8").tobytes()), pa.py_buffer(data.tobytes())])
    values, index = ragged.dictionary(tokens)
    order = np.asarray(pc.sort_indices(values), dtype=np.int64)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    place = rank[index]
    counts = np.bincount(place, weights=np.concatenate([np.frombuffer(x, "<i8") for x in table["c"].to_pylist()]).astype(np.float64), minlength=len(order))
    values = values.take(pa.array(order))
    flat, offsets = ragged.raw_bytes(values)
    # Counts of the words whatever their topic, for the base.
    bare = np.delete(flat, offsets[:-1])
    word = pa.Array.from_buffers(pa.large_binary(), len(order), [None, pa.py_buffer((offsets - np.arange(len(offsets))).astype("<i8").tobytes()),
                                                                 pa.py_buffer(bare.tobytes())])
    words, which = ragged.dictionary(word)
    by_word = np.bincount(which, weights=counts, minlength=len(words))
    return pa.table({
        "shard": table["shard"].slice(0, 1), "bytes": pa.array([flat.tobytes()], pa.binary()),
        "sizes": pa.array([np.diff(offsets).astype("<i4").tobytes()], pa.binary()), "counts": pa.array([counts.astype("<f8").tobytes()], pa.binary()),
        "words": pa.array([by_word[which].astype("<f8").tobytes()], pa.binary()),
        "tokens": pa.array([int(counts.sum())], pa.int64()), "known": pa.array([int((by_word > 0).sum())], pa.int64()),
        "batches": pa.array([table["batch"].to_pylist()], pa.list_(pa.string())), "lengths": pa.array([[len(x) for x in rows]], pa.list_(pa.int64())),
        "places": pa.array([place.astype("<i4").tobytes()], pa.binary()), "numbers": pa.array([b"".join(table["d"].to_pylist())], pa.binary())})


SHARD = ("shard long, bytes binary, sizes binary, counts binary, words binary, tokens long, known long, batches array<string>, lengths array<long>, "
         "places binary, numbers binary")


def _trie(row: dict) -> tuple[Trie, np.ndarray]:
    """The trie of a shard's tokens and their counts."""
    sizes = np.frombuffer(row["sizes"], "<i4").astype(np.int64)
    counts = np.frombuffer(row["counts"], "<f8")
    offsets = np.concatenate([[0], np.cumsum(sizes + 1)])
    data = np.full(int(offsets[-1]), END, dtype=np.uint8)
    spelled = np.ones(len(data), dtype=bool)
    spelled[offsets[1:] - 1] = False
    data[spelled] = np.frombuffer(row["bytes"], np.uint8)
    del spelled
    return Trie(data, offsets, counts), counts


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one, their binary columns as views of the batch; what the work before a row took goes back to the system."""
    for batch in batches:
        for i in range(batch.num_rows):
            ragged.release()
            values = zip(batch.schema.names, [column[i] for column in batch.columns])
            yield {name: v.as_buffer() if pa.types.is_binary(v.type) else v.as_py() for name, v in values}
    ragged.release()


def _first(trie: Trie, settings: Settings) -> np.ndarray:
    """Edges of the first bytes after the topic, which is given and costs nothing."""
    return np.flatnonzero((trie.place > 0) & (trie.place <= settings.head))


def _head_counts(shards: DataFrame, settings: Settings) -> np.ndarray:
    """Bit counts of all tokens' first bytes: a fixed number of slots, summed over shards and sent to all tasks."""
    contexts, slots = len(settings.head_orders) + 1, 1 << settings.head_bits

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            trie, _ = _trie(row)
            flat = count_bits(trie, _first(trie, settings), settings.head_orders, settings.head_bits, settings.chunk).ravel()
            at = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at].astype(np.float64))], names=["slot", "n"])

    # At most contexts * slots * 2 rows, whatever the input.
    summed = shards.select("bytes", "sizes", "counts").mapInArrow(emit, "slot long, n double").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(contexts * slots * 2, dtype=np.float32)
    table[np.asarray(summed["slot"])] = np.asarray(summed["n"])
    return table.reshape(contexts, slots, 2)


def _head_mixer(shards: DataFrame, head, settings: Settings) -> Mixer:
    """The mixer of the first bytes: weights learned online in every shard and averaged by its tokens; then its final
    table, which sums over all shards what the averaged weights make of their training bits."""
    fresh = lambda: Mixer(len(settings.head_orders) + 1, settings)

    def summed(fn) -> list[tuple[int, float, float]]:
        """Sums over shards of a fixed number of values each, and of the tokens behind them."""
        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows(batches):
                trie, counts = _trie(row)
                flat, n = fn(trie, counts.sum()), counts.sum()
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat), pa.array(np.full(len(flat), n))], names=["at", "w", "n"])

        return (shards.select("bytes", "sizes", "counts").mapInArrow(emit, "at long, w double, n double").groupBy("at")
                .agg(F.sum("w").alias("w"), F.sum("n").alias("n")).where("n > 0 AND NOT isnan(w)").collect())

    def learned(trie: Trie, tokens: float) -> np.ndarray:
        mixer = fresh()
        train(mixer, trie, _first(trie, settings), head.value, settings.head_orders, settings.head_bits, settings)
        return mixer.weights.ravel().astype(np.float64) * tokens

    mixer = fresh()
    for at, w, n in summed(learned):
        mixer.weights.ravel()[at] = w / n
    weights = mixer.weights

    def observed(trie: Trie, tokens: float) -> np.ndarray:
        settled = fresh()
        settled.weights = weights
        observe_all(settled, trie, _first(trie, settings), head.value, settings.head_orders, settings.head_bits, settings.chunk)
        return settled.seen.ravel()

    for at, w, _ in summed(observed):
        mixer.seen.ravel()[at] = w
    return mixer


def _shard_scores(shards: DataFrame, head, opening: Mixer, settings: Settings) -> DataFrame:
    """log10 probability and training count of every token, packed by the slice of documents that asked for it."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            trie, counts = _trie(row)
            first, rest = _first(trie, settings), np.flatnonzero(trie.place > settings.head)
            logs = edge_logs(opening, trie, first, head.value, settings.head_orders, settings.head_bits, settings.chunk)
            mixer = Mixer(len(settings.tail_orders) + 1, settings)
            seen = count_bits(trie, rest, settings.tail_orders, settings.tail_bits, settings.chunk)
            train(mixer, trie, rest, seen, settings.tail_orders, settings.tail_bits, settings)
            logs += edge_logs(mixer, trie, rest, seen, settings.tail_orders, settings.tail_bits, settings.chunk)
            score = ragged.segment_reduce(np.add, logs[trie.edge], trie.offsets, 0)
            place, number = np.frombuffer(row["places"], "<i4"), np.frombuffer(row["numbers"], "<i4")
            ends = np.cumsum(row["lengths"])[:-1]
            split = lambda x: [p.tobytes() for p in np.split(x, ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["batches"]), *[pa.array(split(x), pa.binary()) for x in (number, np.frombuffer(row["words"], "<f8")[place], score[place])]],
                names=["batch", "numbers", "counts", "scores"])

    return shards.mapInArrow(emit, "batch string, numbers binary, counts binary, scores binary")


def score_texts(docs: DataFrame, folds: int = 10, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """log10 probabilities of whole texts: ``key``, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A text is its words (A-Z lower-cased, cut at 0x20 and 0x09-0x0D) and one
    end. Learning uses all rows but the held-out fold (CRC-32 of the key as text,
    modulo ``folds``, is 0). ``base_score`` is the smoothed unigram. ``score``
    spells each token as bytes and a closing byte and predicts every bit: hashed
    contexts (the topic that the text before the token suggests, with the
    token's last bytes or its whole beginning) hold bit counts, logistic mixing
    by gated weights combines them, and an adaptive table refines the result: ``-score / log10(2)`` is the text's total bits.

    Null and empty texts are the end alone; a null key is in training; repeated
    rows are learned and scored each; an empty table gives no rows; without
    training rows every bit costs one. Other columns are ignored.

    Distinct tokens are counted once for a slice of documents, then meet in
    shards by their first bytes. A shard's model predicts the bytes after these,
    with counts that stay there however large the corpus; the first bytes have
    a model of fixed size over all shards. Scores go back by slice.
    """
    spark = docs.sparkSession
    chosen = docs.select(
        F.col(key).alias("key"), F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds != 0, F.lit(True)).alias("train"),
        F.col(text).cast("string").alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    shards = shard_count(chosen, "text", least=8)
    path = scratch_path(spark, "tokens")
    _tokens(chosen, shards, topic_centres(chosen, settings), settings, kind).withColumn("words", F.col("shard").isNotNull()).write.partitionBy("words").parquet(path)
    parts = spark.read.schema(f"batch string, shard long, a binary, b binary, c binary, d binary, keys array<{kind}>, held array<boolean>, "
                              "size long, words boolean").parquet(path)
    merged = materialize(parts.where("words").select("batch", "shard", "a", "b", "c", "d").groupBy("shard")
                         .applyInArrow(_shard_tokens, SHARD), "shards")
    totals = merged.agg(F.sum("tokens").alias("n"), F.sum("known").alias("v")).first()
    n, v = int(totals["n"] or 0), int(totals["v"] or 0)
    # A row is a shard: spread them before the heavy work.
    spread = merged.repartition(shards, "shard")
    head = spark.sparkContext.broadcast(_head_counts(spread, settings))
    opening = _head_mixer(spread, head, settings)
    scores = _shard_scores(spread, head, opening, settings)

    def finish(texts: pa.Table, scored: pa.Table) -> pa.Table:
        out = []
        for row in texts.to_pylist():
            count, log = np.zeros(row["size"]), np.zeros(row["size"])
            for part in scored.to_pylist():
                at = np.frombuffer(part["numbers"], "<i4")
                count[at], log[at] = np.frombuffer(part["counts"], "<f8"), np.frombuffer(part["scores"], "<f8")
            ends = np.frombuffer(row["c"], "<i8")
            raw = [pa.decompress(row[x], decompressed_size=4 * int(ends[-1]), codec="zstd", asbytes=True) for x in ("a", "b")]
            number, times = np.cumsum(np.frombuffer(raw[0], "<i4"), dtype=np.int64), np.frombuffer(raw[1], "<i4").astype(np.float64)
            base = np.log10((count + 0.1) / (n + 0.1 * (v + 1)))
            total = lambda x: ragged.segment_reduce(np.add, times * x[number], ends, 0)
            size = np.frombuffer(row["d"], "<i8")
            out.append(pa.table({
                "key": pa.array(row["keys"], table_type), "held_out": pa.array(row["held"], pa.bool_()), "n_tokens": size + 1,
                "n_known": total((count > 0).astype(np.float64)).astype(np.int64), "train_tokens": np.full(len(size), n),
                "base_score": total(base), "score": total(log)}))
        return pa.concat_tables(out) if out else empty

    sample = pa.schema([("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64())])
    table_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "smallint": pa.int16()}[kind]
    empty = pa.schema([("key", table_type), *sample]).empty_table()
    texts = parts.where("NOT words").select("batch", "a", "b", "c", "d", "keys", "held", "size")
    out = texts.groupBy("batch").cogroup(scores.groupBy("batch")).applyInArrow(
        finish, f"key {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumnRenamed("key", key)
