"""Training sets, splits, candidate regressors, metrics and model choice."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bloomline.config import (
    CANDIDATE_MODELS, CV_FOLDS, FEATURES, FIRST_BLOOM, REQUIRED_FEATURES, SEED, TARGET, TEST_PERCENT,
)
from bloomline.operators import forests
from bloomline.operators.boosting import BoostedTrees, Settings, fit_boosted
from bloomline.operators.linear import LinearModel, fold_models, gram_sums, held_out_prediction, solve, total
from bloomline.session import ensure_checkpoint_dir

ROW_KEY = ["location_code", "year", "event_type"]


def training_set(features: DataFrame, event_type: str = FIRST_BLOOM) -> DataFrame:
    """Complete training rows of one event."""
    return features.where(F.col("event_type") == event_type).dropna(subset=[TARGET, *REQUIRED_FEATURES])


def prediction_set(features: DataFrame, event_type: str = FIRST_BLOOM) -> DataFrame:
    return features.where(F.col("event_type") == event_type).dropna(subset=REQUIRED_FEATURES)


def feature_null_counts(df: DataFrame, cols: list[str] = FEATURES) -> DataFrame:
    """NULLs per feature, one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def validate_features(df: DataFrame, cols: list[str] = FEATURES) -> DataFrame:
    """Raise on absent columns or NULL values, naming the counts."""
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise ValueError(f"missing feature columns: {absent}")
    bad = {c: n for c, n in feature_null_counts(df, cols).first().asDict().items() if n}
    if bad:
        raise ValueError(f"null feature values: {bad}")
    return df


def _bucket(keys: list[str], start: int, buckets: int) -> Column:
    """Stable bucket of a row: eight hex digits of its key's md5, modulo ``buckets``."""
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return (F.conv(F.substring(F.md5(key), start, 8), 16, 10).cast("long") % buckets).cast("int")


def hash_split(
    df: DataFrame, keys: list[str] = ROW_KEY, test_percent: int = TEST_PERCENT
) -> DataFrame:
    """Mark every row ``train`` or ``test``; the same key always lands on the same side."""
    return df.withColumn("split", F.when(_bucket(keys, 1, 100) < test_percent, "test").otherwise("train"))


def cv_fold(df: DataFrame, keys: list[str] = ROW_KEY, folds: int = CV_FOLDS) -> DataFrame:
    """Fold number from other hash digits than the split uses."""
    return df.withColumn("fold", _bucket(keys, 9, folds))


Model = LinearModel | BoostedTrees | forests.RandomForestRegressionModel


@dataclass(frozen=True)
class Fitted:
    """A candidate: mean and spread of its validation errors, its fit on the training rows, and its fit on all rows."""
    mae: float
    spread: float
    model: Model
    final: Model

    @property
    def kind(self) -> str:
        return type(self.model).__name__


def forest(rows: DataFrame, members: list[Column], params: dict) -> list[forests.RandomForestRegressionModel]:
    names = {"numTrees": "trees", "maxDepth": "depth", "minInstancesPerNode": "least_rows"}
    settings = forests.Settings(seed=SEED, **{names[k]: v for k, v in params.items()})
    key = [c for c in ROW_KEY if c in rows.columns] or [*FEATURES, TARGET]
    return forests.fit_forests(rows, members, FEATURES, TARGET, key, settings)


def boosting(params: dict) -> Settings:
    names = {"maxIter": "rounds", "stepSize": "rate", "maxDepth": "depth", "minInstancesPerNode": "least_rows", "maxLeaves": "leaves"}
    return Settings(**{names[k]: v for k, v in params.items()})


def fit_linear(rows: DataFrame, params: dict, folds: int) -> Fitted:
    """All fits from one pass of sums by split and fold; a second pass for the validation errors."""
    left_out, model, final = fold_models(gram_sums(rows, ["split", "fold"], FEATURES, TARGET), FEATURES)
    error = F.avg(F.abs(held_out_prediction(left_out) - F.col(TARGET))).alias("mae")
    by_fold = rows.where("split = 'train'").groupBy("fold").agg(error).where("mae IS NOT NULL").orderBy("fold")
    errors = [r["mae"] for r in by_fold.collect()]
    return Fitted(float(np.mean(errors)), float(np.std(errors)), model, final)


def fit_boosting(rows: DataFrame, params: dict, folds: int) -> Fitted:
    """Folds, training rows and all rows as training sets of the same passes."""
    train = F.col("split") == "train"
    members = [train & (F.col("fold") != f) for f in range(folds)] + [train, F.lit(True)]
    models, errors = fit_boosted(rows, members, FEATURES, TARGET, boosting(params), train=folds)
    errors = [e for e in errors[:folds] if e is not None]
    return Fitted(float(np.mean(errors)), float(np.std(errors)), models[folds], models[folds + 1])


def fit_forest(rows: DataFrame, params: dict, folds: int) -> Fitted:
    """Folds, training rows and all rows as training sets of the same passes."""
    train = F.col("split") == "train"
    members = [train & (F.col("fold") != f) for f in range(folds)] + [train, F.lit(True)]
    models = forest(rows, members, params)
    held = [models[f].transform(rows.where(train & (F.col("fold") == f))).select("fold", "prediction", TARGET) for f in range(folds)]
    by_fold = reduce(DataFrame.unionAll, held).groupBy("fold").agg(F.avg(F.abs(F.col("prediction") - F.col(TARGET))).alias("mae"))
    errors = [r["mae"] for r in by_fold.where("mae IS NOT NULL").orderBy("fold").collect()]
    return Fitted(float(np.mean(errors)), float(np.std(errors)), models[folds], models[folds + 1])


BUILDERS: dict[str, Callable[[DataFrame, dict, int], Fitted]] = {
    "linear_regression": fit_linear,
    "random_forest": fit_forest,
    "hist_gradient_boosting": fit_boosting,
}


def with_prediction(model: Model, df: DataFrame) -> DataFrame:
    return model.transform(df)


def save_model(spark: SparkSession, model: Model, path: str) -> None:
    model.save(spark, path)


def load_model(spark: SparkSession, name: str, path: str) -> Model:
    """A stored fit of the candidate ``name``."""
    loaders = {"linear_regression": LinearModel, "random_forest": forests.RandomForestRegressionModel, "hist_gradient_boosting": BoostedTrees}
    return loaders[name].load(spark, path)


def regression_metrics(
    df: DataFrame,
    y: str = TARGET,
    pred: str = "prediction",
    by: list[str] | None = None,
    min_rows: int = 1,
) -> DataFrame:
    """MAE, RMSE, R² and row count, overall or per group of at least ``min_rows``."""
    error = F.col(pred) - F.col(y)
    out = df.groupBy(*(by or [])).agg(
        F.avg(F.abs(error)).alias("mae_days"),
        F.sqrt(F.avg(error * error)).alias("rmse_days"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop(y))).alias("r2_score"),
        F.count("*").alias("evaluation_row_count"),
    )
    return out.where(F.col("evaluation_row_count") >= min_rows)


def metrics_per_group(df: DataFrame, by: list[str], y: str = TARGET, pred: str = "prediction") -> DataFrame:
    """Per-group error; a single test row says nothing and is skipped."""
    scored = regression_metrics(df, y, pred, by, min_rows=2)
    return scored.select(*by, "mae_days", "rmse_days", F.col("evaluation_row_count").alias("n_test_rows"))


def compact(train: DataFrame, rows: int = 50_000) -> DataFrame:
    """Training rows in as few partitions as their number needs: tree fits run many short jobs over them."""
    return train.coalesce(max(1, -(-train.count() // rows)))


def concurrently(spark: SparkSession, work: dict[str, Callable]) -> dict:
    """Results of independent pieces of work, each run by a thread with a scheduler pool of its own.

    With ``spark.scheduler.mode`` FAIR the pools share the cores evenly; without
    it, jobs of one piece fill what the others leave free.
    """
    context = spark.sparkContext

    def run(name: str):
        context.setLocalProperty("spark.scheduler.pool", name)
        return work[name]()

    with ThreadPoolExecutor(max_workers=max(1, len(work))) as pool:
        started = {name: pool.submit(inheritable_thread_target(spark)(run), name) for name in work}
        return {name: future.result() for name, future in started.items()}


def choose(metrics: DataFrame, by: str = "cv_mae_days") -> DataFrame:
    """Model rows with ``is_best_model``: the lowest error, then the first name."""
    best = metrics.agg(F.min_by("model_name", F.struct(by, "model_name")).alias("_best"))
    # A single row.
    return metrics.join(F.broadcast(best), on=F.col("model_name") == F.col("_best"), how="left").select(
        *metrics.columns, F.col("_best").isNotNull().alias("is_best_model")
    )


def ranked(rows: list[dict], spark) -> list[dict]:
    """Metric rows with ``choose`` applied, best first; as many as there are candidates."""
    table = spark.createDataFrame([(r["model_name"], float(r["cv_mae_days"])) for r in rows], "model_name string, cv_mae_days double")
    best = choose(table).where("is_best_model").first()["model_name"]
    return sorted(rows, key=lambda r: (r["model_name"] != best, r["cv_mae_days"], r["model_name"]))


def fit_candidates(
    split: DataFrame, candidates: dict[str, dict] = CANDIDATE_MODELS, folds: int = CV_FOLDS
) -> dict[str, Fitted]:
    """All candidates at once, each cross-validated and fitted on the training rows and on all rows."""
    for name in candidates:
        if name not in BUILDERS:
            raise ValueError(f"unknown model: {name}")
    ensure_checkpoint_dir(split.sparkSession)
    rows = compact(cv_fold(split, folds=folds)).persist()
    try:
        return concurrently(split.sparkSession, {
            name: lambda name=name: BUILDERS[name](rows, candidates[name], folds) for name in candidates})
    finally:
        rows.unpersist()


def select_best_model(
    split: DataFrame, candidates: dict[str, dict] = CANDIDATE_MODELS, folds: int = CV_FOLDS
) -> tuple[list[dict], Model, dict[str, Model]]:
    """Metric rows of every candidate, best first, the winner's fit on the training rows, and all fits on all rows.

    The mean and spread of the validation errors choose; held-out rows measure.
    The driver sees one metric row per candidate; the fits run on the cluster.
    """
    fitted = fit_candidates(split, candidates, folds)
    test = split.where("split = 'test'").persist()
    try:
        measured = concurrently(split.sparkSession, {
            name: lambda f=f: regression_metrics(with_prediction(f.model, test)).first() for name, f in fitted.items()})
    finally:
        test.unpersist()
    rows = [{
        "model_name": name,
        "model_type": f.kind,
        "cv_mae_days": f.mae,
        "cv_mae_std": f.spread,
        **(measured[name].asDict() if measured[name] else {}),
    } for name, f in fitted.items()]
    rows = ranked(rows, split.sparkSession)
    return rows, fitted[rows[0]["model_name"]].model, {name: f.final for name, f in fitted.items()}


def fit_final_model(train: DataFrame, name: str, candidates: dict[str, dict] = CANDIDATE_MODELS) -> Model:
    """Fit a candidate on every row."""
    if name not in BUILDERS or name not in candidates:
        raise ValueError(f"unknown model: {name}")
    ensure_checkpoint_dir(train.sparkSession)
    if name == "linear_regression":
        return solve(total(list(gram_sums(train, [], FEATURES, TARGET).values())), FEATURES)
    if name == "hist_gradient_boosting":
        return fit_boosted(compact(train), [F.lit(True)], FEATURES, TARGET, boosting(candidates[name]))[0][0]
    return forest(compact(train), [F.lit(True)], candidates[name])[0]


def station_extremes(metrics: DataFrame) -> DataFrame:
    """The stations with the smallest and the largest error, in one row."""
    order = F.struct("mae_days", "location_code")
    return metrics.agg(
        F.min_by("location_code", order).alias("best_station"),
        F.min("mae_days").alias("best_mae"),
        F.max_by("location_code", order).alias("worst_station"),
        F.max("mae_days").alias("worst_mae"),
        F.count("*").alias("stations"),
    )
