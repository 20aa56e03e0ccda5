"""Text quality from supervised subword embeddings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bloomline.llm import ragged

SLICE_BYTES = 2 << 20  # text whose n-grams are in memory at once
WORDS, PIECES, REPEAT, CLOSE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0, 1


@dataclass(frozen=True)
class Settings:
    """Fixed size of the model and of its training sample, whatever the corpus."""
    bits: int = 16
    dimensions: int = 16
    lengths: tuple[int, ...] = (1, 2, 3, 4)
    rows_per_class: int = 1000
    steps: int = 800
    batch: int = 16
    rate: float = 0.5
    bound: float = 4.0


def features(words: pa.Array, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each distinct word: the word itself and its character n-grams, with ``<`` and ``>`` as its edges.

    N-grams run over bytes; rows 0 and 1 of the table are kept for a word that
    repeats its predecessor and for the end of a text.
    """
    data, offsets = ragged.raw_bytes(words)
    sizes = np.diff(offsets) + 2
    begins = np.concatenate([[0], np.cumsum(sizes)])
    letters = np.full(int(begins[-1]), 60, dtype=np.uint64)
    letters[begins[1:] - 1] = 62
    letters[np.arange(len(data)) + np.repeat(2 * np.arange(len(words)) + 1, np.diff(offsets))] = data
    owner = np.repeat(np.arange(len(words)), sizes)
    last = begins[1:][owner]
    size = np.uint64((1 << settings.bits) - 2)
    bucket, of = [], []
    gram = np.zeros(len(letters), dtype=np.uint64)
    for n in range(1, max(settings.lengths) + 1):
        gram[:len(letters) - n + 1] = (gram[:len(letters) - n + 1] << np.uint64(8)) | letters[n - 1:]
        if n in settings.lengths:
            at = np.flatnonzero(np.arange(len(letters)) + n <= last)
            bucket.append(ragged.mix64(gram[at] + np.uint64((PIECES * n) & (2**64 - 1))) % size)
            of.append(owner[at])
    bucket.append(ragged.mix64(ragged.hash_values(words) ^ np.uint64(WORDS)) % size)
    of.append(np.arange(len(words)))
    bucket, of = np.concatenate(bucket).astype(np.int64) + 2, np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return bucket[order], np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(words)))])


def _repeats(index: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text, how many words equal the word before."""
    same = np.zeros(len(index), dtype=np.int64)
    same[1:] = index[1:] == index[:-1]
    heads = offsets[:-1][offsets[1:] > offsets[:-1]]
    same[heads] = 0
    return ragged.segment_sum(same, offsets)


def bags(column: pa.Array, settings: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets and their shares for each text."""
    words, offsets = ragged.split_words(column)
    values, index = ragged.dictionary(words)
    bucket, begins = features(values, settings)
    again = _repeats(index, offsets)
    out = []
    for i in range(len(column)):
        at, _ = ragged.positions(begins, index[offsets[i]:offsets[i + 1]])
        found, counts = np.unique(np.concatenate([bucket[at], np.full(again[i], REPEAT), [CLOSE]]), return_counts=True)
        # Repeats weigh as much as all n-grams of the word they repeat.
        counts = counts.astype(np.float32)
        counts[found == REPEAT] *= max(1.0, len(at) / max(1, offsets[i + 1] - offsets[i]))
        out.append((found.astype(np.int32), counts / counts.sum()))
    return out


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, settings: Settings) -> np.ndarray:
    """Stochastic gradient descent on averaged vectors and a two-way softmax.

    Returns, for each bucket, the difference of the two logits that it
    contributes: averaging and output are linear, so this is the whole model.
    """
    rng = np.random.default_rng(5)
    table = rng.uniform(-1, 1, (1 << settings.bits, settings.dimensions)).astype(np.float32) / settings.dimensions
    output = np.zeros((2, settings.dimensions), dtype=np.float32)
    step = 0
    while step < settings.steps:
        order = rng.permutation(len(rows))
        for start in range(0, len(rows), settings.batch):
            if step == settings.steps:
                break
            rate = settings.rate * (1 - step / settings.steps)
            step += 1
            chosen = order[start:start + settings.batch]
            at = np.concatenate([rows[i][0] for i in chosen])
            share = np.concatenate([rows[i][1] for i in chosen])
            sizes = np.array([len(rows[i][0]) for i in chosen])
            hidden = np.add.reduceat(table[at] * share[:, None], np.concatenate([[0], np.cumsum(sizes)[:-1]]))
            logits = hidden @ output.T
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(chosen)), labels[chosen]] -= 1
            back = p @ output
            output -= rate * (p.T @ hidden)
            # A text's logits move by the sum of its squared shares: long texts, whose shares are small, need larger
            # steps. The bound on a text's vectors keeps texts that contradict each other from driving them apart.
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            scale = np.minimum(settings.dimensions, 1 / np.add.reduceat(share * share, starts))
            np.subtract.at(table, at, rate * share[:, None] * np.repeat(back * scale[:, None], sizes, axis=0))
            np.clip(output, -settings.bound, settings.bound, out=output)
    return (table @ (output[1] - output[0])).astype(np.float32)


def held_out(key, folds: int):
    """True for rows kept from training: CRC-32 of the id as text, modulo ``folds``, is 0. A null id is never held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str, folds: int, settings: Settings,
        key: str = "doc_id", text: str = "text") -> bytes | None:
    """Logit weights learned from at most ``rows_per_class`` labelled rows of each class; None without labels.

    The sample is the rows of lowest XXH64 of their id, so it depends on the
    ids alone. Ids with several labels count as their smallest.
    """
    eligible = (labels.where(~held_out(key, folds) & F.col(label).isin(0, 1) & F.col(key).isNotNull())
                .groupBy(F.col(key).alias("key")).agg(F.min(label).cast("int").alias("label")))
    shares = {r["label"]: r["count"] for r in eligible.groupBy("label").count().collect()}
    if not shares:
        return None
    picked = None
    for value in (0, 1):
        part = eligible.where(F.col("label") == value).orderBy(F.xxhash64("key"), "key").limit(settings.rows_per_class)
        picked = part if picked is None else picked.unionAll(part)
    # At most 2 * rows_per_class ids: a fixed bound, so the texts need not be shuffled.
    sample = (docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
              .join(F.broadcast(picked), "key").select("key", "text", "label"))

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("text", "ascending")])
        rows = [bag for part in ragged.slices(table.combine_chunks().to_batches(), "text", SLICE_BYTES)
                for bag in bags(ragged.texts(part, "text"), settings)]
        y = np.asarray(table["label"]).astype(np.int64)
        weights = train(rows, y, settings) if 0 < y.sum() < len(y) else np.zeros(1 << settings.bits, np.float32)
        # The classes were sampled at rates of their own; the constant restores the shares among all labels.
        shift = np.log(max(shares.get(1, 0), 0.5) / max(shares.get(0, 0), 0.5)) - np.log(max(y.sum(), 0.5) / max((1 - y).sum(), 0.5))
        return pa.table({"model": pa.array([np.append(weights, np.float32(shift)).astype("<f4").tobytes()], pa.binary())})

    found = sample.groupBy(F.lit(0).alias("all")).applyInArrow(learn, "model binary").collect()
    return bytes(found[0]["model"]) if found else None


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, threshold: float = 0.3,
                  settings: Settings = Settings(), key: str = "doc_id", text: str = "text", keep: bool = False) -> DataFrame:
    """Probability of label 1 for every text: ``key``, held_out, score, predicted (1 if score >= ``threshold``).

    Learned on a bounded sample of labelled rows outside the held-out fold; only
    texts are inputs. Null and empty texts score by the end-of-text vector
    alone; without labels every score is 0.5. Repeated rows score alike. An
    empty table gives no rows. With ``keep`` all columns of ``docs`` follow
    instead, restricted to the predicted rows.
    """
    model = fit(docs, labels, label, folds, settings, key, text)

    def scores(column: pa.Array) -> np.ndarray:
        if model is None:
            return np.full(len(column), 0.5)
        learned = np.frombuffer(model, dtype="<f4")
        weights, shift = learned[:-1].astype(np.float64), float(learned[-1])
        words, offsets = ragged.split_words(column)
        values, index = ragged.dictionary(words)
        bucket, begins = features(values, settings)
        value, size = ragged.segment_sum(weights[bucket], begins), np.diff(begins).astype(np.float64)
        again, count = _repeats(index, offsets), np.diff(offsets)
        total = ragged.segment_sum(size[index], offsets)
        extra = again * np.maximum(1.0, total / np.maximum(1, count))
        logit = ragged.segment_sum(value[index], offsets) + extra * weights[REPEAT] + weights[CLOSE]
        return 1 / (1 + np.exp(-(logit / (total + extra + 1) + shift)))

    if keep:
        def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in ragged.slices(batches, text, SLICE_BYTES):
                yield batch.filter(pa.array(scores(ragged.texts(batch, text)) >= threshold))

        return docs.mapInArrow(filtered, docs.schema)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ragged.slices(batches, "text", SLICE_BYTES):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores(ragged.texts(batch, "text")))], names=["key", "held_out", "score"])

    chosen = docs.select(F.col(key).alias("key"), held_out(key, folds).alias("held_out"), F.col(text).cast("string").alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    out = chosen.mapInArrow(scored, f"key {kind}, held_out boolean, score double")
    return out.select(F.col("key").alias(key), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
