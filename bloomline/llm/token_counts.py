"""Token counts of whole texts under a byte-level BPE vocabulary."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from bloomline.llm import ragged
from bloomline.llm.bpe import merges

#: The pre-token pattern of byte-level BPE, and Unicode white space.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
CACHED = 800_000  # piece counts kept by a worker process; only speed depends on it


class Counter:
    """Counts tokens; keeps the counts of pieces that it has met."""

    def __init__(self, path: str, special: str):
        self.merges, self.special = merges(path), special
        self.pre_token = regex.compile(PRE_TOKEN, regex.V1 | regex.UNICODE)
        self.pieces: dict[str, int] = {}
        self.words: dict[str, int] = {}

    def _merged(self, words: list[str]) -> None:
        """Add the symbol counts of pre-tokens to the cache."""
        data, offsets = ragged.raw_bytes(pa.array(words, pa.large_string()))
        _, out = self.merges.encode(data, offsets)
        self.words.update(zip(words, np.diff(out).tolist()))

    def count(self, pieces: list[str]) -> np.ndarray:
        """Tokens of each piece; a piece is split into pre-tokens on its own."""
        if len(self.pieces) + len(self.words) > 2 * CACHED:
            self.pieces, self.words = {}, {}
        known = self.pieces
        fresh = [p for p in pieces if p not in known]
        split = [self.pre_token.findall(p) for p in fresh]
        unknown = {w for ws in split for w in ws if w not in self.words}
        if unknown:
            self._merged(list(unknown))
        size = self.words
        for piece, ws in zip(fresh, split):
            known[piece] = sum([size[w] for w in ws])
        return np.fromiter((known[p] for p in pieces), dtype=np.int64, count=len(pieces))

    def whole(self, text: str) -> int:
        """Tokens of a text that can't be cut at blanks; each special string in it is one token."""
        parts = text.split(self.special) if self.special else [text]
        words = [w for part in parts for w in self.pre_token.findall(part)]
        unknown = {w for w in words if w not in self.words}
        if unknown:
            self._merged(list(unknown))
        total = sum([self.words[w] for w in words]) + len(parts) - 1
        if len(self.words) > 2 * CACHED:
            self.words = {}
        return total

    def batch(self, column: pa.Array) -> np.ndarray:
        """Tokens of each text.

        A blank between two other characters always begins a pre-token, so texts
        whose blanks are all of that kind are cut there and each distinct piece
        is counted once. Other texts are taken whole.
        """
        odd = f"[{SPACE}] | [{SPACE}]| $"
        if self.special:
            odd += "|" + regex.escape(self.special).replace("\\<", "<").replace("\\>", ">")
        apart = np.asarray(pc.match_substring_regex(column, odd)).astype(bool)
        out = np.zeros(len(column), dtype=np.int64)
        for i in np.flatnonzero(apart).tolist():
            out[i] = self.whole(column[i].as_py())
        plain = column.filter(pa.array(~apart))
        if len(plain):
            lists = pc.split_pattern(plain, " ")
            offsets = np.asarray(lists.offsets, dtype=np.int64) - lists.offsets[0].as_py()
            values, index = ragged.dictionary(lists.flatten())
            names = values.to_pylist()
            size = self.count([" " + x for x in names])[index]
            heads = offsets[:-1]
            first, back = np.unique(index[heads], return_inverse=True)
            size[heads] = self.count([names[i] for i in first])[back]
            out[~apart] = ragged.segment_sum(size, offsets)
        return out


@functools.cache
def counter(path: str, special: str) -> Counter:
    """One per worker process, so that cached counts serve all its tasks."""
    return Counter(path, special)


def token_counts(docs: DataFrame, vocabulary: str, special: str = "<|endoftext|>", limit: int = 1024,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """Bytes and tokens of every text: ``key``, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    One narrow stage. Pre-tokens of a batch lie in ragged arrays and all merge
    their lowest-rank pair in step (``Merges.encode``). Null text counts as
    empty: no bytes, no tokens. Rows are neither dropped nor merged, so repeated
    rows repeat; other columns are ignored, whatever their names. ``vocabulary``
    is a path that every executor can open.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(vocabulary, special)
        for batch in ragged.slices(batches, "text"):
            column = ragged.texts(batch, "text")
            tokens = own.batch(column)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.cast(pc.binary_length(column), pa.int64()), pa.array(tokens), pa.array(tokens > limit)],
                names=["key", "n_bytes", "n_tokens", "over_limit"])

    chosen = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = chosen.schema["key"].dataType.simpleString()
    out = chosen.mapInArrow(count, f"key {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("key", key)
