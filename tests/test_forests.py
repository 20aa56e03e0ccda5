"""Forests against a plain numpy version, in tasks and on the cluster."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from bloomline.operators import boosting, forests as f, model

SMALL = f.Settings(trees=5, depth=4, least_rows=4, bins=8)
NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    random = np.random.default_rng(5)
    x = np.round(random.normal(size=(400, 3)) * [1, 30, 1000], 3)
    y = np.rint(100 + 10 * x[:, 0] - np.abs(x[:, 1]) / 3 + random.normal(size=400))
    table = [(*map(float, r), float(t), i) for i, (r, t) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(table, "a double, b double, c double, y double, k long").repartition(4).persist()


def plain(x, y, weight, cuts, settings, depth):
    """Predictions of a tree for its rows, by trying every bound of every column."""
    mean = lambda r: (y[r] * weight[r]).sum() / weight[r].sum()
    score = lambda r: (y[r] * weight[r]).sum() ** 2 / weight[r].sum()
    out = np.zeros(len(y))

    def grow(here, depth):
        found = (1e-9, None)
        for j, bounds in enumerate(cuts):
            for bound in bounds if depth else ():
                left, right = here & (x[:, j] <= bound), here & (x[:, j] > bound)
                if min(weight[left].sum(), weight[right].sum()) >= settings.least_rows:
                    gain = score(left) + score(right) - score(here)
                    if gain > found[0] + 1e-7:
                        found = (gain, (left, right))
        if found[1] is None:
            out[here] = mean(here)
        else:
            for part in found[1]:
                grow(part, depth - 1)

    grow(np.ones(len(y), bool), depth)
    return out


def test_forests(spark, rows, tmp_path):
    x, y, df = rows
    members = [F.col("k") % 3 != 0, F.lit(True)]
    in_tasks = f.fit_forests(df, members, NAMES, "y", ["k"], SMALL)
    for limit in (150, 20):
        on_cluster = f.fit_forests(df, members, NAMES, "y", ["k"], SMALL, task_rows=limit)
        for one, two in zip(in_tasks, on_cluster):
            assert all((s.feature == t.feature).all() and s.value == pytest.approx(t.value) for s, t in zip(one.trees, two.trees))
    key = np.array([r["h"] for r in df.orderBy("k").select(F.xxhash64("k").alias("h")).collect()]).astype(np.int64).view(np.uint64)
    for fitted, used in zip(in_tasks, (np.arange(400) % 3 != 0, np.ones(400, bool))):
        trees = []
        for t in range(SMALL.trees):
            weight = np.where(used, f.drawn(key, t, SMALL.seed), 0).astype(float)
            trees.append((weight > 0, plain(x[weight > 0], y[weight > 0], weight[weight > 0], fitted.cuts, SMALL, SMALL.depth)))
        bins = np.minimum(boosting.bins_of(list(x.T), [np.array(c) for c in fitted.cuts]), SMALL.bins - 1)
        for tree, (drawn, want) in zip(fitted.trees, trees):
            assert tree.value[tree.node_of(bins, SMALL.depth)][drawn] == pytest.approx(want)
    in_tasks[0].save(spark, str(tmp_path / "forest"))
    again = f.RandomForestRegressionModel.load(spark, str(tmp_path / "forest"))
    total = lambda m: m.transform(df).agg(F.sum("prediction")).first()[0]
    assert total(again) == pytest.approx(total(in_tasks[0]))
    with pytest.raises(ValueError, match="no rows"):
        f.fit_forests(df.limit(0), members, NAMES, "y", ["k"], SMALL)


def test_candidate_is_this_forest(spark, rows):
    """Folds and refits are one fit of seven training sets, whose trees are tasks, and not seven fits one level a job."""
    x, y, df = rows
    names = dict(zip(["a", "b", "c"], model.FEATURES))
    table = df.select(*[F.col(a).alias(b) for a, b in names.items()], *[F.col("a").alias(b) for b in model.FEATURES[3:]],
                      F.col("y").alias(model.TARGET), F.when(F.col("k") % 5 == 0, "test").otherwise("train").alias("split"), (F.col("k") % 3).cast("int").alias("fold"))
    fitted = model.fit_forest(table, {"numTrees": 4, "maxDepth": 4, "minInstancesPerNode": 5}, 3)
    assert isinstance(fitted.final, f.RandomForestRegressionModel) and 0 < fitted.mae < np.abs(y - y.mean()).mean() and fitted.spread > 0


def test_draws_are_poisson():
    counts = np.bincount(f.drawn(np.arange(100_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), 3, 42), minlength=4) / 100_000
    assert counts[:4] == pytest.approx(np.exp(-1) / np.array([1, 1, 2, 6]), abs=0.01)


def test_many_rows_stay_in_tasks(spark, monkeypatch):
    """Rows of a tree are not sent tree by tree while those of a model fit a task."""
    df = spark.range(110_000, numPartitions=4).select(
        (F.col("id") % 977).cast("double").alias("a"), (F.col("id") % 13 + F.col("id") % 977 / 100).cast("double").alias("y"), "id")
    monkeypatch.setattr(f, "grow_on_cluster", None)
    fitted = f.fit_forests(df, [F.lit(True)], ["a"], "y", ["id"], f.Settings(trees=2, depth=3))
    assert len(fitted[0].trees) == 2


def test_children_share_the_sums():
    random = np.random.default_rng(6)
    bins, slot, child = random.integers(0, 4, (300, 2)).astype(np.uint8), random.integers(0, 3, 300), random.integers(0, 2, 300)
    y, weight = np.rint(random.normal(size=300) * 9), random.integers(1, 4, 300).astype(np.uint8)
    sums = lambda used: f.histogram(bins[used], y[used], weight[used], slot[used], 3, 4).reshape(2, 2, 3, 4)
    right = np.array([True, False, True])
    both = f.children_sums(sums(child >= 0), sums(child == right[slot]), right)
    assert (both[:, :, :, 0] == sums(child == 0)).all() and (both[:, :, :, 1] == sums(child == 1)).all()
