"""Least squares from sums of products: one pass for any number of folds, none of which is fitted on its own rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import combinations_with_replacement
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Gram:
    """Sums of products of all columns, the target last, and of 1 as the first; rows of one group or of several."""
    sums: np.ndarray

    def __add__(self, other: Gram) -> Gram:
        return Gram(self.sums + other.sums)

    def __sub__(self, other: Gram) -> Gram:
        return Gram(self.sums - other.sums)

    @property
    def rows(self) -> float:
        return self.sums[0, 0]


def gram_sums(df: DataFrame, by: list[str], features: list[str], target: str) -> dict[tuple, Gram]:
    """Sums of products of each group, in one aggregate; a row with a null or NaN value has no part in them."""
    columns = [F.col(c).cast("double") for c in (*features, target)]
    usable = reduce(lambda a, b: a & b, [c.isNotNull() & ~F.isnan(c) for c in columns])
    columns = [F.lit(1.0), *columns]
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    totals = [F.sum(columns[i] * columns[j]).alias(f"s{i}_{j}") for i, j in pairs]
    out = {}
    for row in df.where(usable).groupBy(*by).agg(*totals).collect():
        sums = np.zeros((len(columns), len(columns)))
        for (i, j), value in zip(pairs, row[len(by):]):
            sums[i, j] = sums[j, i] = value
        out[tuple(row[:len(by)])] = Gram(sums)
    return out


def total(grams: list[Gram]) -> Gram:
    return reduce(add, grams)


@dataclass(frozen=True)
class LinearModel:
    """Coefficients and intercept; predictions are a built-in expression."""
    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def prediction(self) -> Column:
        return reduce(add, [F.col(f).cast("double") * F.lit(c) for f, c in zip(self.features, self.coefficients)], F.lit(self.intercept))

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.prediction())

    def save(self, spark: SparkSession, path: str) -> None:
        row = [(list(self.features), list(self.coefficients), self.intercept)]
        spark.createDataFrame(row, "features array<string>, coefficients array<double>, intercept double").coalesce(1).write.mode("overwrite").json(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearModel:
        row = spark.read.schema("features array<string>, coefficients array<double>, intercept double").json(path).first()
        return cls(tuple(row["features"]), tuple(row["coefficients"]), row["intercept"])


def solve(gram: Gram, features: list[str], tolerance: float = 1e-9) -> LinearModel:
    """The least-squares line; of the many for collinear features, that with the smallest coefficients.

    Rank is decided on the correlations, where units don't matter: directions
    with less than ``tolerance`` of a feature's variance count as none.
    """
    n = gram.rows
    if not n:
        raise ValueError("no rows to fit")
    mean = gram.sums[0, 1:] / n
    centred = gram.sums[1:, 1:] - n * np.outer(mean, mean)
    x, y = centred[:-1, :-1], centred[:-1, -1]
    # A constant feature's variance is what is left of its sums after rounding.
    floor = 1e-12 * np.diag(gram.sums)[1:-1]
    scale = np.sqrt(np.where(np.diag(x) > floor, np.diag(x), 0))
    inverse = np.divide(1, scale, out=np.zeros_like(scale), where=scale > 0)
    values, vectors = np.linalg.eigh(x * np.outer(inverse, inverse))
    used = values > tolerance
    scaled = vectors[:, used] @ ((vectors[:, used].T @ (y * inverse)) / values[used])
    coefficients = scaled * inverse
    free = vectors[:, ~used & (np.abs(vectors.T @ (scale > 0)) > 0)] * inverse[:, None]
    if free.size:
        left, sizes, _ = np.linalg.svd(free, full_matrices=False)
        basis = left[:, sizes > 1e-12 * max(sizes.max(), 1e-300)]
        coefficients = coefficients - basis @ (basis.T @ coefficients)
    return LinearModel(tuple(features), tuple(map(float, coefficients)), float(mean[-1] - mean[:-1] @ coefficients))


def fold_models(grams: dict[tuple, Gram], features: list[str], train: str = "train") -> tuple[dict[int, LinearModel], LinearModel, LinearModel]:
    """From sums by (split, fold): a model for each fold without its rows, one of all training rows, and one of all rows."""
    folds = {fold: g for (split, fold), g in grams.items() if split == train}
    whole = total(list(folds.values()))
    left_out = {fold: solve(whole - g, features) for fold, g in folds.items() if (whole - g).rows}
    return left_out, solve(whole, features), solve(total(list(grams.values())), features)


def held_out_prediction(models: dict[int, LinearModel], fold: str = "fold") -> Column:
    """Each row's prediction by the model that has not seen its fold."""
    first, *rest = sorted(models)
    chosen = F.when(F.col(fold) == first, models[first].prediction())
    for f in rest:
        chosen = chosen.when(F.col(fold) == f, models[f].prediction())
    return chosen
