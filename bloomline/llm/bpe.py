"""Byte-pair merging of many short sequences at once in numpy."""

from __future__ import annotations

import functools
import json

import numpy as np

from bloomline.llm import ragged

NONE = np.iinfo(np.int32).max


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(spare)
            spare += 1
    return [letters[b] for b in range(256)]


class Merges:
    """Ranked merges of a vocabulary file as a hash table of symbol pairs.

    ``suffix`` marks the last symbol of a word in vocabularies that have one.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.first = np.array([vocab[x] for x in letters], dtype=np.int64)
        self.last = np.array([vocab[x + self.suffix] for x in letters], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.uint64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.uint64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self._build((left << np.uint64(20)) | right, made)

    def _build(self, keys: np.ndarray, made: np.ndarray, bits: int = 20) -> None:
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.full(1 << bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.rank = np.full(1 << bits, NONE, dtype=np.int32)
        self.made = np.zeros(1 << bits, dtype=np.int32)
        todo, slot = np.arange(len(keys)), ragged.mix64(keys) & self.mask
        while len(todo):
            free = self.rank[slot[todo]] == NONE
            _, one = np.unique(slot[todo[free]], return_index=True)
            placed = todo[free][one]
            self.keys[slot[placed]], self.rank[slot[placed]], self.made[slot[placed]] = keys[placed], placed, made[placed]
            todo = np.setdiff1d(todo, placed, assume_unique=True)
            slot[todo] = (slot[todo] + np.uint64(1)) & self.mask

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; rank ``NONE`` where no merge is known."""
        key = (left.astype(np.uint64) << np.uint64(20)) | right.astype(np.uint64)
        slot = ragged.mix64(key) & self.mask
        rank, made = self.rank[slot], self.made[slot]
        wrong = np.flatnonzero((self.keys[slot] != key) & (rank != NONE))
        while len(wrong):
            slot[wrong] = (slot[wrong] + np.uint64(1)) & self.mask
            at = slot[wrong]
            rank[wrong], made[wrong] = self.rank[at], self.made[at]
            wrong = wrong[(self.keys[at] != key[wrong]) & (self.rank[at] != NONE)]
        return rank, made

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of each byte sequence ``data[offsets[i]:offsets[i + 1]]``, flat, and their offsets.

        All sequences advance together. In one round every sequence merges each
        occurrence, from the left and without overlap, of the pair of lowest rank
        that it holds; sequences without a known pair leave the batch.
        """
        count = len(offsets) - 1
        lengths = offsets[1:] - offsets[:-1]
        symbol = self.first[data]
        ends = offsets[1:][lengths > 0] - 1
        symbol[ends] = self.last[data[ends]]
        owner = np.repeat(np.arange(count), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            inner = owner[:-1] == owner[1:]
            rank = np.full(len(symbol), NONE, dtype=np.int32)
            made = np.zeros(len(symbol), dtype=np.int32)
            at = np.flatnonzero(inner)
            rank[at], made[at] = self.find(symbol[at], symbol[at + 1])
            starts = np.flatnonzero(np.concatenate([[True], ~inner]))
            sizes = np.diff(np.append(starts, len(symbol)))
            lowest = np.minimum.reduceat(rank, starts)
            active = np.repeat(lowest != NONE, sizes)
            if not active.all():
                done.append((owner[~active], symbol[~active]))
            hit = (rank == np.repeat(lowest, sizes)) & active
            # Equal neighbours such as "aaa" give runs of hits: take every second one.
            index = np.arange(len(hit))
            last_miss = np.maximum.accumulate(np.where(hit, -1, index))
            hit &= (index - last_miss) % 2 == 1
            symbol[hit] = made[hit]
            keep = active
            keep[1:] &= ~hit[:-1]
            symbol, owner = symbol[keep], owner[keep]
        if not done:
            return np.zeros(0, np.int64), np.zeros(count + 1, np.int64)
        owner = np.concatenate([o for o, _ in done])
        symbol = np.concatenate([s for _, s in done])
        order = np.argsort(owner, kind="stable")
        out = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=count))])
        return symbol[order], out


@functools.cache
def merges(path: str) -> Merges:
    """One table per worker process and file."""
    return Merges(path)
