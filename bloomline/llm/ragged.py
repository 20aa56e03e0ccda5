"""Arrow batches to ragged numpy arrays, and back to packed columns."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def texts(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    """A text column without nulls (null counts as empty), in one chunk."""
    column = batch.column(name)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column, "")


def release() -> None:
    """Give memory that is free but kept by the allocators back to the system: worker processes live long and are many."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _gathered(batches: Iterator[pa.RecordBatch], name: str, limit: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            own = pc.sum(pc.binary_length(batch.column(name))).as_py() or 0
            if held and size + own > limit:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
            held.append(batch)
            size += own
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def slices(batches: Iterator[pa.RecordBatch], name: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Row slices of about ``limit`` bytes of text, or of one longer row, which bounds a task's memory.

    Small batches are put together first, since most operators work once on each distinct word of a slice.
    """
    for batch in _gathered(batches, name, limit):
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(name)), 0), dtype=np.int64)
        ends = np.cumsum(size)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            release()
            start = stop


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Runs of bytes outside 0x20 and 0x09-0x0D: all words, and where each text's words begin and end."""
    lists = pc.ascii_split_whitespace(column)
    words = lists.flatten()
    keep = np.asarray(pc.greater(pc.binary_length(words), 0))
    before = np.concatenate([[0], np.cumsum(keep)])
    offsets = np.asarray(lists.offsets, dtype=np.int64) - lists.offsets[0].as_py()
    return (words if keep.all() else words.filter(pa.array(keep))), before[offsets]


def dictionary(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct values and, for each word, the index of its value."""
    coded = words.dictionary_encode()
    return coded.dictionary, np.asarray(coded.indices, dtype=np.int64)


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values of a string array, end to end, and the offsets between them."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def segment_sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each segment ``offsets[i]:offsets[i + 1]``; 0 for an empty one."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def segment_reduce(ufunc: np.ufunc, values: np.ndarray, offsets: np.ndarray, empty) -> np.ndarray:
    """``ufunc`` over each segment; ``empty`` for an empty one. Exact for floats, unlike a difference of sums."""
    out = np.full(len(offsets) - 1, empty, dtype=values.dtype)
    full = offsets[1:] > offsets[:-1]
    if full.any():
        out[full] = ufunc.reduceat(values, offsets[:-1][full])
    return out


def positions(offsets: np.ndarray, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices into the flat data of the picked segments in order, and the offsets of the result."""
    lengths = (offsets[1:] - offsets[:-1])[picked]
    out = np.concatenate([[0], np.cumsum(lengths)])
    return np.arange(out[-1]) + np.repeat(offsets[:-1][picked] - out[:-1], lengths), out


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hash_values(column: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the distinct values' bytes."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    data, offsets = raw_bytes(column)
    view = memoryview(np.ascontiguousarray(data))
    return np.fromiter((digest(view[a:b], seed) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())),
                       dtype=np.uint64, count=len(column))


def spanning_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between numbers to (number, smallest number of its component), without the roots themselves.

    Hook-and-jump over numpy arrays: each round lowers the roots of both ends to
    the smaller root, then shortens all chains.
    """
    if not len(a):
        return a[:0], b[:0]
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = flat[:len(a)], flat[len(a):]
    root = np.arange(len(nodes))
    while True:
        ru, rv = root[u], root[v]
        differ = ru != rv
        if not differ.any():
            break
        u, v, ru, rv = u[differ], v[differ], ru[differ], rv[differ]
        np.minimum.at(root, np.maximum(ru, rv), np.minimum(ru, rv))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]
