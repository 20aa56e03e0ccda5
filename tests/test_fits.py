"""Linear and boosted fits against plain numpy versions."""

import heapq

import numpy as np
import pytest
from pyspark.sql import functions as F

from bloomline.operators import boosting as b, linear

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def table():
    """Columns a to d (d is the sum of a and b), a target, a split and folds; some values are absent."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 4)) * [1, 30, 1000, 1] + [10, 0, 5000, 0]
    x[:, 3] = x[:, 0] + x[:, 1]
    y = 3 * x[:, 0] - x[:, 1] / 10 + np.sin(x[:, 2] / 300) + rng.normal(size=300) / 10
    fold = rng.integers(0, 3, 300)
    return x, y, fold


def frame(spark, x, y, fold, parts=3):
    value = lambda v: None if np.isnan(v) else float(v)
    rows = [(*map(value, r), float(t), int(f), "train" if i % 5 else "test") for i, (r, t, f) in enumerate(zip(x, y, fold))]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, y double, fold int, split string").repartition(parts)


def plain_line(x, y):
    """The smallest solution on centred columns."""
    centred = x - x.mean(axis=0)
    coefficients = np.linalg.lstsq(centred, y - y.mean(), rcond=1e-10)[0]
    return coefficients, y.mean() - x.mean(axis=0) @ coefficients


def close(model, x, y):
    coefficients, intercept = plain_line(x, y)
    assert model.coefficients == pytest.approx(coefficients, rel=1e-6, abs=1e-8)
    assert model.intercept == pytest.approx(intercept, rel=1e-6, abs=1e-6)


def test_lines_of_folds(spark, table):
    x, y, fold = table
    grams = linear.gram_sums(frame(spark, x, y, fold), ["split", "fold"], NAMES, "y")
    left_out, train, final = linear.fold_models(grams, NAMES)
    used = np.arange(300) % 5 > 0
    for f, model in left_out.items():
        close(model, x[used & (fold != f)], y[used & (fold != f)])
    close(train, x[used], y[used])
    close(final, x, y)


def test_lines_of_odd_rows(spark, table, tmp_path):
    x, y, fold = (t.copy() for t in table)
    x[:, 2] = 7.5  # constant
    x[3, 0] = x[4, 1] = np.nan
    whole = ~np.isnan(x).any(axis=1)
    df = frame(spark, x, y, fold)
    model = linear.solve(linear.gram_sums(df, [], NAMES, "y")[()], NAMES)
    close(model, x[whole], y[whole])
    model.save(spark, str(tmp_path / "line"))
    assert linear.LinearModel.load(spark, str(tmp_path / "line")) == model
    got = {r["y"]: r["prediction"] for r in model.transform(df).collect()}
    assert got[y[3]] is None and got[y[0]] == pytest.approx(x[0] @ model.coefficients + model.intercept)
    with pytest.raises(ValueError, match="no rows"):
        linear.solve(linear.Gram(np.zeros((6, 6))), NAMES)


def plain_tree(x, gradient, s, cuts):
    """A tree grown where the gain is largest, by trying every bound of every column with absent values on either side."""
    def best(rows):
        found = (s.least_gain, None)
        score = lambda r: gradient[r].sum() ** 2 / r.sum() if r.any() else 0
        for j, bounds in enumerate(cuts):
            absent = np.isnan(x[:, j])
            for with_left in (False, True):
                for bound in bounds:
                    left = rows & np.where(absent, with_left, x[:, j] <= bound)
                    right = rows & ~left
                    if min(left.sum(), right.sum()) >= s.least_rows:
                        gain = score(left) + score(right) - score(rows)
                        if gain > found[0] + 1e-9:
                            found = (gain, (left, right))
        return found

    leaves, queue, number = [], [], 0

    def offer(rows, depth):
        nonlocal number
        gain, parts = best(rows) if depth < s.depth and rows.sum() >= 2 * s.least_rows else (0, None)
        if parts is None:
            leaves.append(rows)
        else:
            heapq.heappush(queue, (-gain, number, rows, parts, depth))
            number += 1

    offer(np.ones(len(x), bool), 0)
    while queue and len(leaves) + len(queue) < s.leaves:
        _, _, _, parts, depth = heapq.heappop(queue)
        for part in parts:
            offer(part, depth + 1)
    out = np.zeros(len(x))
    for rows in leaves + [entry[2] for entry in queue]:
        out[rows] = -s.rate * gradient[rows].mean()
    return out


@pytest.mark.parametrize("settings", [b.Settings(rounds=4, rate=0.3, depth=3, least_rows=8, leaves=6, checkpoint_every=2),
                                      b.Settings(rounds=3, rate=0.5, depth=4, least_rows=20)])
@pytest.mark.parametrize("task_rows", [0, b.TASK_ROWS])
def test_boosting(spark, table, tmp_path, settings, task_rows):
    x, y, fold = (t.copy() for t in table)
    x[::7, 1] = np.nan
    df = frame(spark, x, y, fold)
    train = F.col("split") == "train"
    members = [train & (F.col("fold") != f) for f in range(3)] + [train, F.lit(True)]
    names = NAMES[:3]
    models, errors = b.fit_boosted(df, members, names, "y", settings, train=3, task_rows=task_rows)
    used = np.arange(300) % 5 > 0
    sets = [used & (fold != f) for f in range(3)] + [used, np.ones(300, bool)]
    cuts = [np.array(c) for c in models[0].cuts]
    for number, rows in enumerate(sets):
        own, own_y = x[rows][:, :3], y[rows]
        want = np.full(rows.sum(), own_y.mean())
        for _ in range(settings.rounds):
            want = want + plain_tree(own, want - own_y, settings, cuts)
        got = {r["y"]: r["prediction"] for r in models[number].transform(df).select("y", "prediction").collect()}
        assert [got[t] for t in own_y] == pytest.approx(want.tolist())
        if number < 3:
            outside = used & (fold == number)
            assert errors[number] == pytest.approx(np.mean([abs(got[t] - t) for t in y[outside]]))
    assert errors[3:] == [None, None]
    models[0].save(spark, str(tmp_path / "trees"))
    again = b.BoostedTrees.load(spark, str(tmp_path / "trees"))
    total = lambda m: m.transform(df).agg(F.sum("prediction")).first()[0]
    assert total(again) == pytest.approx(total(models[0]))


def test_boosting_of_odd_rows(spark):
    empty = spark.createDataFrame([], "a double, y double")
    with pytest.raises(ValueError, match="no rows"):
        b.fit_boosted(empty, [F.lit(True)], ["a"], "y", b.Settings(rounds=1))
    same = spark.createDataFrame([(None, 2.0), (None, 4.0), (float("nan"), None)], "a double, y double")
    models, _ = b.fit_boosted(same, [F.lit(True), F.lit(None).cast("boolean")], ["a"], "y", b.Settings(rounds=2, least_rows=1))
    assert [r["prediction"] for r in models[0].transform(same).collect()] == [3.0] * 3
    assert models[1].base == 0.0  # a model without rows
