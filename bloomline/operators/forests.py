"""Random forests on histograms: the upper nodes from sums over the cluster, the rest of a tree where its rows fit a task."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bloomline.operators.boosting import bins_of, quantile_cuts

# Tasks get this module's functions by value: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows that one task may grow trees, or what is below a node of one, from, in about 80 bytes a row.
TASK_ROWS = 3_000_000
#: Tasks that share the trees of a model.
GROUPS = 16
LEAST_GAIN = 1e-9
#: Rows that go through all trees at a time.
CHUNK = 1 << 13


@dataclass(frozen=True)
class Settings:
    trees: int = 300
    depth: int = 10
    least_rows: int = 5
    bins: int = 32
    seed: int = 42

    @property
    def nodes(self) -> int:
        return 2 ** (self.depth + 1) - 1


@dataclass
class Rows:
    """Rows of one piece of a partition; ``key`` decides how often each tree draws a row."""
    bins: np.ndarray     # rows x features
    y: np.ndarray
    key: np.ndarray
    members: np.ndarray  # rows x models: whether the model is trained on the row

    def of(self, model: int) -> Rows:
        used = self.members[:, model]
        return Rows(self.bins[used], self.y[used], self.key[used], self.members[used][:, :0])


def together(parts: list[Rows]) -> Rows:
    """Pieces as one, in an order that does not depend on them."""
    whole = [np.concatenate([getattr(p, name) for p in parts]) for name in ("bins", "y", "key", "members")]
    order = np.argsort(whole[2], kind="stable")
    return Rows(*(x[order] for x in whole))


#: How often a row is drawn, by 16 random bits: the Poisson distribution of mean 1.
DRAWS = np.searchsorted(np.exp(-1) * np.cumsum(1 / np.cumprod([1.0, *range(1, 9)])), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


def drawn(key: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Rows of a tree with replacement: a function of key, tree and seed, wherever the row is."""
    x = key + np.uint64(((seed << 20) + tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return DRAWS[x >> np.uint64(48)]


def histogram(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, slot: np.ndarray, count: int, width: int) -> np.ndarray:
    """Sums of targets and of weights by feature, slot (an open node) and bin."""
    out = np.empty((2, bins.shape[1], count * width))
    weight = weight.astype(np.float64)
    base, weighted = slot * width, y * weight
    for f in range(bins.shape[1]):
        at = base + bins[:, f]
        out[0, f] = np.bincount(at, weighted, count * width)
        out[1, f] = np.bincount(at, weight, count * width)
    return out


@dataclass
class Found:
    """The best split of every slot, and the sums of its left child and of its node."""
    feature: np.ndarray  # -1 without one
    bin: np.ndarray      # values up to this bin go left
    left: np.ndarray
    whole: np.ndarray


def best(sums: np.ndarray, settings: Settings) -> Found:
    """The split that lowers the squared error most; then the first feature, then the first bin."""
    features, count = sums.shape[1], sums.shape[2] // settings.bins
    below = np.cumsum(sums.reshape(2, features, count, settings.bins), axis=-1)
    left, whole = below[..., :-1], below[..., -1]
    right = whole[..., None] - left
    allowed = (left[1] >= settings.least_rows) & (right[1] >= settings.least_rows)
    score = lambda s: np.divide(s[0] ** 2, s[1], out=np.zeros_like(s[0]), where=s[1] > 0)
    gain = np.where(allowed, score(left) + score(right) - score(whole)[..., None], -np.inf)
    by_slot = np.moveaxis(gain, 1, 0).reshape(count, -1)
    chosen = by_slot.argmax(axis=1)
    feature, at = np.divmod(chosen, settings.bins - 1)
    slots = np.arange(count)
    return Found(np.where(by_slot[slots, chosen] > LEAST_GAIN, feature, -1), at, left[:, feature, slots, at], whole[:, 0])


@dataclass
class Tree:
    """A tree as a heap: children of node i are 2 i + 1 and 2 i + 2; feature -1 is a leaf."""
    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        nodes = 2 ** (depth + 1) - 1
        return cls(np.full(nodes, -1, np.int8), np.zeros(nodes, np.uint8), np.zeros(nodes))

    def split(self, nodes: np.ndarray, found: Found) -> tuple[np.ndarray, np.ndarray]:
        """Enter the splits of open nodes; the children of each, and the rows these have (none where nothing is split)."""
        done = found.feature >= 0
        self.feature[nodes], self.bin[nodes] = found.feature, found.bin
        mean = lambda s: np.divide(s[0], s[1], out=np.zeros_like(s[0]), where=s[1] > 0)
        self.value[nodes] = mean(found.whole)
        children = np.stack([2 * nodes + 1, 2 * nodes + 2], axis=1)
        parts = np.stack([found.left, found.whole - found.left], axis=2)
        self.value[children[done]] = mean(parts)[done]
        return children, np.where(done[:, None], parts[1], 0)

    def graft(self, node: int, part: Tree) -> None:
        """What was grown below a node."""
        for level in range((len(part.feature) + 1).bit_length() - 1):
            here, there = 2 ** level - 1, (node + 1) * 2 ** level - 1
            for name in ("feature", "bin", "value"):
                getattr(self, name)[there:there + 2 ** level] = getattr(part, name)[here:here + 2 ** level]

    def node_of(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """Node that each row reaches within ``depth`` steps."""
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(depth):
            f = self.feature[at]
            at = np.where(f < 0, at, 2 * at + 1 + (bins[rows, np.maximum(f, 0)] > self.bin[at]))
        return at


def children_sums(whole: np.ndarray, counted: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Histograms of both children of each node, left ones first, from the node's and the counted child's; ``right`` marks where that is the right one."""
    rest = whole - counted
    rest[0][rest[1] == 0] = 0  # nothing of the rounding stays where no row is
    swapped = right[:, None]
    return np.stack([np.where(swapped, rest, counted), np.where(swapped, counted, rest)], axis=3)


def grow(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, settings: Settings, depth: int) -> Tree:
    """A tree of rows that are all here, level by level; of two children the smaller one is counted, the other has the rest."""
    tree, nodes, slot = Tree.empty(depth), np.zeros(1, np.int64), np.zeros(len(y), np.int64)
    features, width = bins.shape[1], settings.bins
    sums = histogram(bins, y, weight, slot, 1, width)
    for level in range(depth):
        found = best(sums, settings)
        children, sizes = tree.split(nodes, found)
        open_ = (sizes >= 2 * settings.least_rows) & (level + 1 < depth)
        if not open_.any():
            break
        split_value = bins.ravel().take(np.arange(0, bins.size, features) + np.maximum(found.feature, 0).take(slot))
        child = slot + slot
        child += split_value > found.bin.astype(np.uint8).take(slot)
        parents = np.flatnonzero(open_.any(axis=1))
        right = sizes[parents].argmin(axis=1)
        number = np.full(sizes.size, -1)
        number[2 * parents + right] = np.arange(len(parents))
        at = number.take(child)
        picked = np.flatnonzero(at >= 0)
        counted = histogram(bins.take(picked, axis=0), y.take(picked), weight.take(picked), at.take(picked), len(parents), width)
        shape = 2, features, -1, width
        both = children_sums(sums.reshape(shape)[:, :, parents], counted.reshape(shape), right == 1)
        sums = both.reshape(shape)[:, :, open_[parents].ravel()].reshape(2, features, -1)
        following = np.where(open_.ravel(), np.cumsum(open_) - 1, -1)
        slot, nodes = following.take(child), children[open_]
        if not open_.all():
            kept = np.flatnonzero(slot >= 0)
            bins, y, weight, slot = bins.take(kept, axis=0), y.take(kept), weight.take(kept), slot.take(kept)
    return tree


def packed(df: DataFrame, members: list[Column], cuts: list[np.ndarray], features: list[str], target: str, key: list[str], width: int) -> RDD:
    """Binned rows in pieces of an Arrow batch; absent values share the last bin."""
    p, models = len(features), len(members)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = [np.asarray(batch.column(i).fill_null(float("nan"))) for i in range(p)]
                flags = np.stack([np.asarray(batch.column(p + 2 + m).fill_null(False)) for m in range(models)], axis=1)
                parts = [np.minimum(bins_of(values, cuts), width - 1).astype(np.uint8), np.asarray(batch.column(p), dtype=np.float64),
                         np.asarray(batch.column(p + 1)), flags]
                yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in parts], names=names)

    def unpack(row) -> Rows:
        y = np.frombuffer(row[1])
        return Rows(np.frombuffer(row[0], np.uint8).reshape(len(y), p), y, np.frombuffer(row[2], np.uint64),
                    np.frombuffer(row[3], bool).reshape(len(y), models))

    names = ["bins", "y", "key", "members"]
    chosen = df.where(F.col(target).isNotNull()).select(
        *[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)], F.col(target).cast("double").alias("y"),
        F.xxhash64(*key).alias("key"), *[c.alias(f"m{m}") for m, c in enumerate(members)])
    return chosen.mapInArrow(pack, "bins binary, y binary, key binary, members binary").rdd.map(unpack)


Trees = dict[tuple[int, int], Tree]


def grow_in_tasks(rows: RDD, models: int, settings: Settings) -> Trees:
    """All trees of few rows: each group of a model's trees in a task."""
    def deal(piece: Rows) -> Iterator[tuple[int, Rows]]:
        for m in range(models):
            own = piece.of(m)
            yield from ((m * GROUPS + g, own) for g in range(GROUPS))

    def work(part: Iterator[tuple[int, Rows]]) -> Iterator[tuple[int, int, Tree]]:
        found = list(part)
        if found:
            m, group = divmod(found[0][0], GROUPS)
            own = together([piece for _, piece in found])
            found.clear()
            for t in range(group, settings.trees, GROUPS):
                weight = drawn(own.key, t, settings.seed)
                used = weight > 0
                yield m, t, grow(own.bins[used], own.y[used], weight[used], settings, settings.depth)

    done = rows.flatMap(deal).partitionBy(models * GROUPS, lambda k: k).mapPartitions(work).collect()
    return {(m, t): tree for m, t, tree in done}


def grow_on_cluster(rows: RDD, models: int, settings: Settings, task_rows: int, count: int) -> Trees:
    """Nodes of more than ``task_rows`` rows from histograms summed over all pieces, as many slots as there are such nodes;
    the rows of the others meet by tree and node, and what is below is grown there."""
    context, width = rows.context, settings.bins
    trees = {(m, t): Tree.empty(settings.depth) for m in range(models) for t in range(settings.trees)}
    shared = {k: np.zeros(1, np.int64) for k in trees}
    dealt: dict[tuple[int, int], list[int]] = {k: [] for k in trees}

    def heads(level: int, wanted: dict) -> dict:
        """Splits down to the nodes of a level. Broadcasts are plain arrays, which need no module of ours."""
        return {k: (trees[k].feature[:2 ** (level + 1) - 1].copy(), trees[k].bin[:2 ** (level + 1) - 1].copy()) for k in wanted}

    def located(part: Iterator[Rows], known: dict, wanted: dict, level: int) -> Iterator[tuple]:
        """For each tree its drawn rows in wanted nodes, and the place of the node among them."""
        pieces = list(part)
        whole = together(pieces) if pieces else None
        for m in range(models if pieces else 0):
            own = whole.of(m)
            for t in range(settings.trees):
                nodes = wanted.get((m, t), ())
                if len(nodes):
                    weight = drawn(own.key, t, settings.seed)
                    head = Tree(*known[m, t], np.zeros(0))
                    slots = np.full(2 ** (level + 1) - 1, -1, np.int64)
                    slots[nodes] = np.arange(len(nodes))
                    slot = np.where(weight > 0, slots[head.node_of(own.bins, level)], -1)
                    at = np.flatnonzero(slot >= 0)
                    yield (m, t), own.bins[at], own.y[at], weight[at], slot[at]

    level = 0
    while shared:
        sent = context.broadcast((heads(level, shared), shared))

        def sums(part: Iterator[Rows], sent=sent, level=level) -> Iterator[tuple]:
            known, wanted = sent.value
            for k, bins, y, weight, slot in located(part, known, wanted, level):
                yield k, histogram(bins, y, weight, slot, len(wanted[k]), width)

        found = rows.mapPartitions(sums).reduceByKey(np.add).mapValues(lambda s: best(s, settings)).collect()
        sent.unpersist()
        level += 1
        nodes, shared = shared, {}
        for k, splits in found:
            children, sizes = trees[k].split(nodes[k], splits)
            if level < settings.depth:
                dealt[k] += children[(sizes >= 2 * settings.least_rows) & (sizes <= task_rows)].tolist()
                if (sizes > task_rows).any():
                    shared[k] = children[sizes > task_rows]
    wanted = {k: np.array(v) for k, v in dealt.items() if v}
    if not wanted:
        return trees
    sent = context.broadcast((heads(level, wanted), wanted))

    def send(part: Iterator[Rows]) -> Iterator[tuple]:
        known, wanted = sent.value
        for k, bins, y, weight, slot in located(part, known, wanted, level):
            order = np.argsort(slot, kind="stable")
            edges = np.searchsorted(slot[order], np.arange(len(wanted[k]) + 1))
            for node, start, stop in zip(wanted[k].tolist(), edges, edges[1:]):
                at = order[start:stop]
                if len(at):
                    yield (*k, node), (bins[at], y[at], weight[at])

    def below(item: tuple) -> tuple:
        (m, t, node), parts = item
        whole = [np.concatenate(x) for x in zip(*parts)]
        return m, t, node, grow(*whole, settings, settings.depth - (node + 1).bit_length() + 1)

    # About 64 MB of rows in a task, which groups them on disk if need be.
    tasks = max(context.defaultParallelism, count * len(trees) * 20 >> 26)
    for m, t, node, part in rows.mapPartitions(send).groupByKey(tasks).map(below).toLocalIterator(prefetchPartitions=True):
        trees[m, t].graft(node, part)
    sent.unpersist()
    return trees


@dataclass(frozen=True)
class RandomForestRegressionModel:
    """A fitted model: bounds of bins, and the trees, whose mean it predicts."""
    features: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    bins: int
    trees: tuple[Tree, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        """``prediction`` for every row, in Arrow batches; an absent value goes with the largest ones."""
        cuts, width, trees = [np.array(c) for c in self.cuts], self.bins, self.trees
        depth = (len(trees[0].feature) + 1).bit_length() - 2

        def predict(*columns: pd.Series) -> pd.Series:
            bins = np.minimum(bins_of([c.to_numpy(dtype=np.float64, na_value=np.nan) for c in columns], cuts), width - 1)
            out = np.zeros(len(bins))
            for start in range(0, len(bins), CHUNK):
                piece, own = bins[start:start + CHUNK], out[start:start + CHUNK]
                for tree in trees:
                    own += tree.value[tree.node_of(piece, depth)]
            return pd.Series(out / len(trees))

        scored = F.pandas_udf(predict, "double")
        return df.withColumn("prediction", scored(*[F.col(f).cast("double") for f in self.features]))

    def save(self, spark: SparkSession, path: str) -> None:
        """A row for each tree, and the bounds."""
        rows = [(i, t.feature.tolist(), t.bin.tolist(), t.value.tolist()) for i, t in enumerate(self.trees)]
        spark.createDataFrame(rows, TREE_COLUMNS).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
        head = [(list(self.features), [list(c) for c in self.cuts], self.bins)]
        spark.createDataFrame(head, HEAD_COLUMNS).coalesce(1).write.mode("overwrite").json(f"{path}/head")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> RandomForestRegressionModel:
        head = spark.read.schema(HEAD_COLUMNS).json(f"{path}/head").first()
        trees = [Tree(np.array(r["feature"], np.int8), np.array(r["bin"], np.uint8), np.array(r["value"]))
                 for r in spark.read.parquet(f"{path}/trees").orderBy("tree").collect()]
        return cls(tuple(head["features"]), tuple(map(tuple, head["cuts"])), head["bins"], tuple(trees))


TREE_COLUMNS = "tree int, feature array<int>, bin array<int>, value array<double>"
HEAD_COLUMNS = "features array<string>, cuts array<array<double>>, bins int"


def fit_forests(df: DataFrame, members: list[Column], features: list[str], target: str, key: list[str],
                settings: Settings = Settings(), task_rows: int = TASK_ROWS) -> list[RandomForestRegressionModel]:
    """A forest for each training set; ``members`` says for each which rows it is trained on (null is no).

    A tree draws rows with replacement, by a hash of ``key``, and splits where the squared error falls most,
    at quantiles of each feature. Up to ``task_rows`` rows, groups of trees grow in tasks of their own. With more, the
    upper nodes are split on histograms summed on the executors, until a node's rows are no more than ``task_rows``.
    """
    cuts = quantile_cuts(df.select([F.col(f).cast("double").alias(f) for f in features]), features,
                         [i / settings.bins for i in range(1, settings.bins)])
    rows = packed(df, members, cuts, features, target, key, settings.bins).persist()
    try:
        count = rows.map(lambda r: len(r.y)).sum()
        if not count:
            raise ValueError("no rows to fit")
        if count <= task_rows:
            trees = grow_in_tasks(rows, len(members), settings)
        else:
            tasks = rows.context.defaultParallelism
            spread = rows.map(lambda r: (int(r.key[0] >> np.uint64(8)) % tasks, r)).partitionBy(tasks, lambda k: k).values().persist()
            try:
                trees = grow_on_cluster(spread, len(members), settings, task_rows, count)
            finally:
                spread.unpersist()
    finally:
        rows.unpersist()
    listed = tuple(tuple(map(float, c)) for c in cuts)
    return [RandomForestRegressionModel(tuple(features), listed, settings.bins, tuple(trees[m, t] for t in range(settings.trees))) for m in range(len(members))]
