"""Gradient-boosted trees on histograms, several training sets (folds, refits) in the same passes."""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field, fields

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bloomline.session import ensure_checkpoint_dir

# Tasks get this module's functions by value: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MISSING = 255  # the bin of absent values
SLOTS_A_TASK = 32  # slots whose histograms meet in one task


@dataclass(frozen=True)
class Settings:
    """Size of the trees and of the steps; ``leaves`` bounds a tree that grows where the gain is largest."""
    rounds: int = 300
    rate: float = 0.05
    depth: int = 6
    least_rows: int = 20
    leaves: int = 31
    least_gain: float = 1e-7
    checkpoint_every: int = 25

    @property
    def nodes(self) -> int:
        return 2 ** (self.depth + 1) - 1


@dataclass
class Trees:
    """A tree of each model as a heap: children of node i are 2 i + 1 and 2 i + 2; feature -1 is a leaf."""
    feature: np.ndarray       # models x nodes
    bin: np.ndarray           # values up to this bin go left
    missing_left: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, models: int, nodes: int) -> Trees:
        shape = (models, nodes)
        return cls(np.full(shape, -1, np.int16), np.zeros(shape, np.int16), np.zeros(shape, bool), np.zeros(shape))


def node_of(trees: Trees, model: int, bins: np.ndarray, depth: int) -> np.ndarray:
    """Node that each row reaches within ``depth`` steps."""
    at = np.zeros(len(bins), np.int64)
    rows = np.arange(len(bins))
    feature, upto, missing_left = trees.feature[model], trees.bin[model], trees.missing_left[model]
    for _ in range(depth):
        f = feature[at]
        b = bins[rows, np.maximum(f, 0)]
        left = np.where(b == MISSING, missing_left[at], b <= upto[at])
        at = np.where(f < 0, at, 2 * at + 2 - left)
    return at


@dataclass
class Block:
    """Rows of one piece of a partition, and what the models of this round predict for them."""
    bins: np.ndarray     # rows x features
    y: np.ndarray
    members: np.ndarray  # rows x models: whether the model is trained on the row
    predicted: np.ndarray


def step(block: Block, trees: Trees, depth: int) -> Block:
    """The block after a round's trees."""
    moved = np.stack([trees.value[m][node_of(trees, m, block.bins, depth)] for m in range(block.members.shape[1])], axis=1)
    return Block(block.bins, block.y, block.members, block.predicted + moved)


def histogram(block: Block, trees: Trees, slots: np.ndarray, count: int, level: int) -> np.ndarray:
    """Sums of gradients and numbers of rows by feature, slot and bin; a slot is an open node of a model's tree."""
    features = block.bins.shape[1]
    out = np.zeros((2, features, count * 256))
    for m in range(block.members.shape[1]):
        if (slots[m] < 0).all():
            continue
        slot = slots[m][node_of(trees, m, block.bins, level)]
        used = np.flatnonzero(block.members[:, m] & (slot >= 0))
        base, gradient, bins = slot[used] * 256, (block.predicted[:, m] - block.y)[used], block.bins[used]
        for f in range(features):
            at = base + bins[:, f]
            out[0, f] += np.bincount(at, gradient, minlength=count * 256)
            out[1, f] += np.bincount(at, minlength=count * 256)
    return out


@dataclass
class Split:
    gain: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray   # gradient sum and rows of the left child, by slot
    whole: np.ndarray  # the same of the node


def best_splits(sums: np.ndarray, settings: Settings) -> Split:
    """Best split of every slot: the largest gain, then the first feature, missing to the right first, then the first bin."""
    features, count = sums.shape[1], sums.shape[2] // 256
    g, n = sums.reshape(2, features, count, 256)
    missing = np.stack([g[..., MISSING], n[..., MISSING]])
    below = np.cumsum(np.stack([g[..., :MISSING], n[..., :MISSING]]), axis=-1)
    whole = below[..., -1] + missing
    # features x slots x (missing right, missing left) x bins
    left = np.stack([below, below + missing[..., None]], axis=3)
    right = whole[..., None, None] - left
    score = lambda s: np.divide(s[0] ** 2, s[1], out=np.zeros_like(s[0]), where=s[1] > 0)
    gain = score(left) + score(right) - score(whole)[..., None, None]
    allowed = (left[1] >= settings.least_rows) & (right[1] >= settings.least_rows)
    gain = np.where(allowed, gain, -np.inf)
    by_slot = np.moveaxis(gain, 1, 0).reshape(count, -1)
    best = by_slot.argmax(axis=1)
    feature, rest = np.divmod(best, 2 * MISSING)
    side, at = np.divmod(rest, MISSING)
    slots = np.arange(count)
    return Split(by_slot[slots, best], feature, at, side == 1, left[:, feature, slots, side, at], whole[:, 0])


def joined(parts: list[Split]) -> Split:
    """Splits of following ranges of slots; the slots are the last axis."""
    return Split(*(np.concatenate([getattr(p, f.name) for p in parts], axis=-1) for f in fields(Split)))


@dataclass
class Growth:
    """A round's trees while they grow: splits and sums of all nodes so far."""
    trees: Trees
    gain: np.ndarray
    sums: np.ndarray  # gradient and rows, models x nodes
    open: list[tuple[int, int]] = field(default_factory=list)

    @classmethod
    def start(cls, models: int, settings: Settings) -> Growth:
        shape = (models, settings.nodes)
        return cls(Trees.empty(models, settings.nodes), np.full(shape, -np.inf), np.zeros((2, *shape)), [(m, 0) for m in range(models)])

    def slots(self) -> np.ndarray:
        out = np.full(self.gain.shape, -1, np.int64)
        for s, (m, node) in enumerate(self.open):
            out[m, node] = s
        return out

    def add(self, found: Split, settings: Settings, level: int) -> None:
        """Splits of the open nodes; the next open ones are children with rows for two more."""
        following = []
        for s, (m, node) in enumerate(self.open):
            self.sums[:, m, node] = found.whole[:, s]
            if not found.gain[s] > settings.least_gain:
                continue
            t = self.trees
            t.feature[m, node], t.bin[m, node], t.missing_left[m, node] = found.feature[s], found.bin[s], found.missing_left[s]
            self.gain[m, node] = found.gain[s]
            for child, part in ((2 * node + 1, found.left[:, s]), (2 * node + 2, found.whole[:, s] - found.left[:, s])):
                self.sums[:, m, child] = part
                if level + 1 < settings.depth and part[1] >= 2 * settings.least_rows:
                    following.append((m, child))
        self.open = following

    def finish(self, settings: Settings) -> Trees:
        """Trees of at most ``leaves`` leaves, split where the gain is largest first, with Newton values of squared error."""
        t = self.trees
        for m in range(len(self.gain)):
            kept, queue, leaves = set(), [(-self.gain[m, 0], 0)], 1
            while queue and leaves < settings.leaves:
                worst, node = heapq.heappop(queue)
                if worst == np.inf:
                    break
                kept.add(node)
                leaves += 1
                for child in (2 * node + 1, 2 * node + 2):
                    if self.gain[m, child] > -np.inf:
                        heapq.heappush(queue, (-self.gain[m, child], child))
            dropped = [i for i in np.flatnonzero(t.feature[m] >= 0).tolist() if i not in kept]
            t.feature[m, dropped] = -1
        g, n = self.sums
        t.value[:] = np.where(t.feature < 0, -settings.rate * np.divide(g, n, out=np.zeros_like(g), where=n > 0), 0)
        return t


def quantile_cuts(df: DataFrame, features: list[str], asked: list[float] | None = None) -> list[np.ndarray]:
    """At most 254 bounds of bins for each feature, from one pass; a value belongs to the first bound that it doesn't exceed."""
    found = df.approxQuantile(features, asked or [i / 254 for i in range(254)], 1 / 2540)
    # NaN sorts behind all values; it has the bin of absent ones.
    return [np.unique([x for x in values if x == x]) for values in found]


def bins_of(values: list[np.ndarray], cuts: list[np.ndarray]) -> np.ndarray:
    out = np.empty((len(values[0]), len(cuts)), np.uint8)
    for i, (v, c) in enumerate(zip(values, cuts)):
        out[:, i] = np.where(np.isnan(v), MISSING, np.searchsorted(c, v))
    return out


def blocks(df: DataFrame, members: list[Column], cuts: list[np.ndarray], features: list[str], target: str) -> RDD:
    """Binned rows in blocks of an Arrow batch."""
    p, models = len(features), len(members)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = [np.asarray(batch.column(i).fill_null(float("nan"))) for i in range(p)]
                flags = np.stack([np.asarray(batch.column(p + 1 + m).fill_null(False)) for m in range(models)], axis=1)
                parts = [bins_of(values, cuts), np.asarray(batch.column(p), dtype=np.float64), flags]
                yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in parts], names=names)

    def unpack(row) -> Block:
        y = np.frombuffer(row[1])
        flags = np.frombuffer(row[2], bool).reshape(len(y), models)
        return Block(np.frombuffer(row[0], np.uint8).reshape(len(y), p), y, flags, np.zeros(flags.shape))

    names = ["bins", "y", "members"]
    chosen = df.where(F.col(target).isNotNull()).select(
        *[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)], F.col(target).cast("double").alias("y"),
        *[c.alias(f"m{m}") for m, c in enumerate(members)])
    return chosen.mapInArrow(pack, "bins binary, y binary, members binary").rdd.map(unpack)


class SharedRows:
    """Rows of the cluster: a job for each sum; the blocks' predictions go to the checkpoint folder every few changes."""

    def __init__(self, state: RDD, checkpoint_every: int) -> None:
        self.state, self.every, self.changes, self.old = state.persist(), checkpoint_every, 0, None

    def total(self, fn, shape: tuple[int, ...]) -> np.ndarray:
        def add(part: Iterator[Block]) -> Iterator[np.ndarray]:
            yield sum((fn(b) for b in part), np.zeros(shape))

        parts = self.state.mapPartitions(add)
        # By way of the executors if there are many.
        out = parts.treeReduce(np.add) if parts.getNumPartitions() > 8 else sum(parts.collect())
        self.computed()
        return out

    def splits(self, fn, shape: tuple[int, int, int], settings: Settings) -> Split:
        """Histograms meet on the executors, a range of slots in each task: the driver gets a few numbers for each slot."""
        slots = shape[2] // 256
        tasks = min(self.state.getNumPartitions(), -(-slots // SLOTS_A_TASK))
        edges = [slots * t // tasks * 256 for t in range(tasks + 1)]

        def add(part: Iterator[Block]) -> Iterator[tuple[int, np.ndarray]]:
            sums = sum((fn(b) for b in part), np.zeros(shape))
            for t in range(tasks):
                yield t, np.ascontiguousarray(sums[:, :, edges[t]:edges[t + 1]])

        met = self.state.mapPartitions(add).reduceByKey(np.add, tasks, lambda t: t)
        found = dict(met.mapValues(lambda sums: best_splits(sums, settings)).collect())
        self.computed()
        return joined([found[t] for t in range(tasks)])

    def computed(self) -> None:
        if self.old is not None:
            self.old.unpersist()
            self.old = None

    def advance(self, change) -> None:
        self.old, self.state = self.state, self.state.map(change).persist()
        self.changes += 1
        if self.changes % self.every == 0:
            self.state.checkpoint()

    def close(self) -> None:
        for rdd in (self.old, self.state):
            if rdd is not None:
                rdd.unpersist()


def boost(rows: SharedRows, models: int, features: int, settings: Settings) -> tuple[np.ndarray, list[Trees]]:
    """Means that the models start from, and their trees by round; all models grow in the same passes over the rows."""
    sums = rows.total(lambda b: np.stack([(b.members * b.y[:, None]).sum(axis=0), b.members.sum(axis=0)]), (2, models))
    base = np.divide(sums[0], sums[1], out=np.zeros(models), where=sums[1] > 0)
    rows.advance(lambda b: Block(b.bins, b.y, b.members, b.predicted + base))
    rounds: list[Trees] = []
    for _ in range(settings.rounds):
        growth = Growth.start(models, settings)
        for level in range(settings.depth):
            if not growth.open:
                break
            grow_level(rows, growth, features, level, settings)
        grown = growth.finish(settings)
        rounds.append(grown)
        rows.advance(lambda b, t=grown: step(b, t, settings.depth))
    return base, rounds


def grow_level(rows: SharedRows, growth: Growth, features: int, level: int, settings: Settings) -> None:
    trees, slots, count = growth.trees, growth.slots(), len(growth.open)
    found = rows.splits(lambda b: histogram(b, trees, slots, count, level), (2, features, count * 256), settings)
    growth.add(found, settings, level)


def histogram_here(bins: np.ndarray, gradient: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of gradients and numbers of rows by feature and bin; ``bins`` is features x rows."""
    out = np.empty((2, len(bins), 256))
    own = gradient[rows]
    for f, column in enumerate(bins):
        at = column[rows].astype(np.intp)
        out[0, f] = np.bincount(at, own, 256)
        out[1, f] = np.bincount(at, minlength=256)
    return out


def grow_here(trees: Trees, number: int, bins: np.ndarray, gradient: np.ndarray, counts: np.ndarray, settings: Settings) -> None:
    """The tree ``number`` of rows that are all here, and its step in their gradients; ``counts`` are rows by feature and bin.

    The node of the largest gain is split first. Rows stay sorted by node, and only the smaller child of a node is counted:
    the other one has the rest of the node's histogram.
    """
    rows = np.arange(bins.shape[1])
    spans, sums, queue, leaves = {0: (0, len(rows))}, {}, [], 1

    def offer(nodes: list[int], histograms: list[np.ndarray]) -> None:
        found = best_splits(np.concatenate(histograms, axis=2), settings)
        for s, node in enumerate(nodes):
            sums[node] = found.whole[:, s]
            if found.gain[s] > settings.least_gain:
                heapq.heappush(queue, (-found.gain[s], node, histograms[s], found.feature[s], found.bin[s], found.missing_left[s], found.left[:, s]))

    offer([0], [np.array([[np.bincount(column, gradient, 256) for column in bins], counts], np.float64)])
    while queue and leaves < settings.leaves:
        _, node, whole, feature, upto, missing_left, left = heapq.heappop(queue)
        trees.feature[number, node], trees.bin[number, node], trees.missing_left[number, node] = feature, upto, missing_left
        start, stop = spans.pop(node)
        side = np.arange(256) <= upto
        side[MISSING] = missing_left
        here = rows[start:stop]
        goes_left = side[bins[feature][here]]
        parts = here[goes_left], here[~goes_left]
        middle = start + len(parts[0])
        rows[start:middle], rows[middle:stop] = parts
        children = 2 * node + 1, 2 * node + 2
        spans[children[0]], spans[children[1]] = (start, middle), (middle, stop)
        sums[children[0]], sums[children[1]] = left, sums[node] - left
        leaves += 1
        small = int(len(parts[1]) < len(parts[0]))
        room = children[0] < 2 ** settings.depth - 1 and leaves < settings.leaves
        wanted = [c for c in (0, 1) if room and len(parts[c]) >= 2 * settings.least_rows]
        if wanted:
            counted = histogram_here(bins, gradient, parts[small])
            rest = whole - counted
            rest[0][rest[1] == 0] = 0  # nothing of the rounding stays where no row is
            offer([children[c] for c in wanted], [counted if c == small else rest for c in wanted])
    for node, (start, stop) in spans.items():
        g, n = sums[node]
        trees.value[number, node] = -settings.rate * g / n if n else 0
        gradient[rows[start:stop]] += trees.value[number, node]


def boost_here(bins: np.ndarray, y: np.ndarray, settings: Settings) -> tuple[float, Trees]:
    """What ``boost`` gives for one model whose rows are all here; ``bins`` is features x rows."""
    base = float(y.mean()) if len(y) else 0.0
    trees, gradient = Trees.empty(settings.rounds, settings.nodes), base - y
    counts = np.stack([np.bincount(column, minlength=256) for column in bins])
    for number in range(settings.rounds):
        grow_here(trees, number, bins, gradient, counts, settings)
    return base, trees


def predicted(base: float, trees: Trees, bins: np.ndarray, depth: int, chunk: int = 1 << 13) -> np.ndarray:
    """Sums over all trees for rows x features, some rows at a time."""
    out = np.full(len(bins), base)
    for start in range(0, len(bins), chunk):
        piece, own = bins[start:start + chunk], out[start:start + chunk]
        for r in range(len(trees.feature)):
            own += trees.value[r][node_of(trees, r, piece, depth)]
    return out


@dataclass(frozen=True)
class BoostedTrees:
    """A fitted model: bounds of bins, the mean it starts from, and its trees by round."""
    features: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    base: float
    trees: Trees

    def transform(self, df: DataFrame) -> DataFrame:
        """``prediction`` for every row, in Arrow batches; a null or NaN value goes the way that absent values went."""
        cuts, base, trees = [np.array(c) for c in self.cuts], self.base, self.trees
        depth = (trees.feature.shape[1] + 1).bit_length() - 2

        def predict(*columns: pd.Series) -> pd.Series:
            bins = bins_of([c.to_numpy(dtype=np.float64, na_value=np.nan) for c in columns], cuts)
            return pd.Series(predicted(base, trees, bins, depth))

        scored = F.pandas_udf(predict, "double")
        return df.withColumn("prediction", scored(*[F.col(f).cast("double") for f in self.features]))

    def save(self, spark: SparkSession, path: str) -> None:
        """Nodes and bounds as tables; their size is that of the settings, not of the data."""
        t = self.trees
        used = np.argwhere((t.feature >= 0) | (t.value != 0)).tolist()
        nodes = [(r, i, int(t.feature[r, i]), int(t.bin[r, i]), bool(t.missing_left[r, i]), float(t.value[r, i])) for r, i in used]
        spark.createDataFrame(nodes, NODE_COLUMNS).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        head = [(list(self.features), [list(c) for c in self.cuts], self.base, *t.feature.shape)]
        spark.createDataFrame(head, HEAD_COLUMNS).coalesce(1).write.mode("overwrite").json(f"{path}/head")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        head = spark.read.schema(HEAD_COLUMNS).json(f"{path}/head").first()
        t = Trees.empty(head["rounds"], head["nodes"])
        for r in spark.read.parquet(f"{path}/nodes").collect():
            at = r["round"], r["node"]
            t.feature[at], t.bin[at], t.missing_left[at], t.value[at] = r["feature"], r["bin"], r["missing_left"], r["value"]
        return cls(tuple(head["features"]), tuple(map(tuple, head["cuts"])), head["base"], t)


NODE_COLUMNS = "round int, node int, feature int, bin int, missing_left boolean, value double"
HEAD_COLUMNS = "features array<string>, cuts array<array<double>>, base double, rounds int, nodes int"


#: Rows of which one task takes a model's whole fit, in about 65 bytes a row besides the rows as they came. A fit on the cluster is up to 1,800 jobs.
TASK_ROWS = 3_000_000


def fit_boosted(df: DataFrame, members: list[Column], features: list[str], target: str, settings: Settings = Settings(),
                train: int | None = None, task_rows: int = TASK_ROWS) -> tuple[list[BoostedTrees], list[float | None]]:
    """A model for each training set, all grown level by level.

    ``members`` says for each model which rows it is trained on (null is no).
    With ``train``, the number of a model, the mean absolute error of every other
    model on the rows that ``train`` has and it has not is returned too (None
    without such rows): for folds, their validation errors.

    A pass over the blocks sums gradients by model, open node, feature and bin
    for all models at once; these sums, whose size depends on the settings alone,
    meet on the executors, and the driver gets the splits chosen there and sends
    them with the next pass. Predictions
    so far stay with their blocks. These passes are jobs, up to ``depth`` for each
    round. Up to ``task_rows`` rows, each model is fitted in a task of its own
    instead, to the same trees.
    """
    ensure_checkpoint_dir(df.sparkSession)
    models, p = len(members), len(features)
    cuts = quantile_cuts(df.select([F.col(f).cast("double").alias(f) for f in features]), features)
    start = blocks(df, members, cuts, features, target).persist()

    def missed(b: Block, known: np.ndarray) -> np.ndarray:
        outside = known & ~b.members
        return np.stack([(np.abs(b.predicted - b.y[:, None]) * outside).sum(axis=0), outside.sum(axis=0)])

    def whole(part: Iterator[tuple[int, Block]]) -> Iterator[tuple[int, float, Trees, np.ndarray]]:
        pieces = list(part)
        if pieces:
            bins, y, used = (np.concatenate([getattr(b, name) for _, b in pieces]) for name in ("bins", "y", "members"))
            number = pieces[0][0]
            pieces.clear()
            base, trees = boost_here(np.ascontiguousarray(bins[used].T), y[used], settings)
            off = np.abs(predicted(base, trees, bins[~used], settings.depth) - y[~used])
            yield number, base, trees, np.array([off.sum(), len(off)])

    def of_model(b: Block, m: int) -> tuple[int, Block]:
        """Rows that the model is trained on, and those that only ``train`` has."""
        own = b.members[:, m]
        kept = own | b.members[:, train if train is not None else m]
        return m, Block(b.bins[kept], b.y[kept], own[kept], b.predicted[:0])

    try:
        if start.map(lambda b: len(b.y)).sum() <= task_rows:
            dealt = start.flatMap(lambda b: [of_model(b, m) for m in range(models)]).partitionBy(models)
            found = sorted(dealt.mapPartitions(whole).collect(), key=lambda r: r[0])
            if not found:
                raise ValueError("no rows to fit")
            bases, trees = [r[1] for r in found], [r[2] for r in found]
            off = np.stack([r[3] for r in found], axis=1)
        else:
            rows = SharedRows(start.map(lambda b: b), settings.checkpoint_every)
            try:
                base, rounds = boost(rows, models, p, settings)
                off = rows.total(lambda b: missed(b, b.members[:, [train if train is not None else 0]]), (2, models))
            finally:
                rows.close()
            bases, trees = base.tolist(), [stacked(rounds, m) for m in range(models)]
    finally:
        start.unpersist()
    errors = [float(o / k) if k and train is not None else None for o, k in off.T]
    listed = tuple(tuple(map(float, c)) for c in cuts)
    return [BoostedTrees(tuple(features), listed, b, t) for b, t in zip(bases, trees)], errors


def stacked(rounds: list[Trees], model: int) -> Trees:
    """The trees of one model, by round."""
    return Trees(*(np.stack([getattr(t, name)[model] for t in rounds]) for name in ("feature", "bin", "missing_left", "value")))
