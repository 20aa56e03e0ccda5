"""Splits of boosted trees are chosen on the executors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from bloomline.operators import boosting


def test_driver_gets_splits_not_histograms(spark, monkeypatch):
    """Whatever a level's histograms take, the driver gets totals of a few numbers for each model."""
    random = np.random.default_rng(5)
    x = random.normal(size=(400, 3))
    table = [(*map(float, r), float(np.rint(9 * r[0] - abs(r[1]))), i) for i, r in enumerate(x)]
    df = spark.createDataFrame(table, "a double, b double, c double, y double, k long").repartition(4).persist()
    fit = lambda limit: boosting.fit_boosted(df, [F.lit(True), F.col("k") % 2 == 0], ["a", "b", "c"], "y", boosting.Settings(
        rounds=3, depth=4, least_rows=5), task_rows=limit)[0]
    want, sizes, slots = fit(10_000), [], []
    total, joined = boosting.SharedRows.total, boosting.joined
    monkeypatch.setattr(boosting.SharedRows, "total", lambda rows, fn, shape: sizes.append(np.prod(shape)) or total(rows, fn, shape))
    monkeypatch.setattr(boosting, "joined", lambda parts: slots.append(len(parts)) or joined(parts))
    monkeypatch.setattr(boosting, "SLOTS_A_TASK", 2)
    got = fit(0)
    assert max(sizes) <= 4 and max(slots) > 1
    for one, two in zip(want, got):
        assert (one.trees.feature == two.trees.feature).all() and one.trees.value == pytest.approx(two.trees.value)


def test_many_rows_need_no_job_for_each_level(spark, monkeypatch):
    """A task holds a model's rows and grows all its trees, node by node; the passes over the cluster are for more rows than that."""
    df = spark.range(60_000, numPartitions=4).select(
        (F.col("id") % 977).cast("double").alias("a"), (F.col("id") % 61).cast("double").alias("b"),
        (F.col("id") % 13 + F.col("id") % 977 / 100).cast("double").alias("y"), "id")
    fit = lambda: boosting.fit_boosted(df, [F.lit(True), F.col("id") % 3 > 0], ["a", "b"], "y", boosting.Settings(rounds=3, depth=4), train=0)
    monkeypatch.setattr(boosting, "SharedRows", None)
    models, errors = fit()
    assert len(models) == 2 and errors[0] is None and errors[1] > 0


def test_larger_child_has_the_rest():
    """Sums of the child that is not counted are those of its rows; where it has none, they are exactly zero."""
    random = np.random.default_rng(2)
    bins, y = random.integers(0, 6, (3, 500)).astype(np.uint8), random.normal(size=500)
    settings = boosting.Settings(rounds=4, depth=5, least_rows=3, leaves=12)
    base, here = boosting.boost_here(bins, y, settings)
    gradient = base - y
    for number in range(settings.rounds):
        node = boosting.node_of(here, number, bins.T, settings.depth)
        assert (here.feature[number] >= 0).sum() == 11
        for leaf in np.unique(node):
            assert here.value[number, leaf] == pytest.approx(-settings.rate * gradient[node == leaf].mean())
        gradient += here.value[number][node]
    assert boosting.predicted(base, here, bins.T, settings.depth, chunk=64) - y == pytest.approx(gradient)
