"""Forecast rows from model predictions, and the stored model."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from bloomline.config import CANDIDATE_MODELS, FEATURES, MODEL_VERSION
from bloomline.functions.dates import doy_to_date, predicted_doy, timestamp
from bloomline.functions.labels import prediction_status
from bloomline.operators.model import Model, fit_final_model, save_model, validate_features, with_prediction
from bloomline.operators.quality import union_all
from bloomline.schemas import FORECAST
from bloomline.sources.contracts import conform


def model_rows(
    spark: SparkSession, selection: list[dict], training_row_count: int, model_version: str = MODEL_VERSION
) -> DataFrame:
    """Candidate metrics as a table, one row per model; the first one is the best."""
    rows = [
        (r["model_name"], model_version, rank == 0, training_row_count,
         r["rmse_days"], r["mae_days"], r["r2_score"])
        for rank, r in enumerate(selection)
    ]
    return spark.createDataFrame(rows, MODEL_COLUMNS)


MODEL_COLUMNS = (
    "model_name string, model_version string, is_best_model boolean, training_row_count int, "
    "rmse_days double, mae_days double, r2_score double"
)


def build_forecast(
    predicted: DataFrame,
    models: DataFrame,
    trained_at: dt.datetime,
    station_metrics: DataFrame | None = None,
) -> DataFrame:
    """Forecast fact rows of any number of models.

    ``predicted`` has location_code, year, event_type, using_climate_normals,
    model_name and prediction; ``models`` is one row per model as in
    ``model_rows``. Station errors apply to the best model; a station with too
    few test rows falls back to the model's own error.
    """
    doy = predicted_doy(F.col("prediction"))
    rows = predicted.select(
        "location_code",
        F.col("year").alias("forecast_year"),
        "event_type",
        doy.alias("predicted_day_of_year"),
        doy_to_date(F.col("year"), doy).alias("predicted_event_date"),
        "model_name",
        prediction_status(F.col("using_climate_normals")).alias("prediction_status"),
    ).join(models, on="model_name")
    station = F.lit(None).cast("double")
    if station_metrics is not None:
        known = station_metrics.select("location_code", F.col("mae_days").alias("_station_mae"))
        rows = rows.join(known, on="location_code", how="left")
        station = F.when(F.col("is_best_model"), F.col("_station_mae"))
    return conform(
        rows.withColumns({
            "trained_at": timestamp(trained_at),
            "station_mae_days": F.coalesce(station, "mae_days"),
            "source_name": F.concat(F.lit("model_"), "model_name"),
        }),
        FORECAST,
    )


def build_all(
    train: DataFrame,
    prediction: DataFrame,
    selection: list[dict],
    trained_at: dt.datetime,
    station_metrics: DataFrame | None = None,
    candidates: dict[str, dict] = CANDIDATE_MODELS,
    fitted: dict[str, Model] | None = None,
    model_version: str = MODEL_VERSION,
) -> DataFrame:
    """Forecasts of every candidate refitted on all rows; the first of ``selection`` is best."""
    validate_features(prediction)
    frames = []
    for row in selection:
        name = row["model_name"]
        model = (fitted or {}).get(name) or fit_final_model(train, name, candidates)
        frames.append(with_prediction(model, prediction).withColumn("model_name", F.lit(name)))
    models = model_rows(train.sparkSession, selection, train.count(), model_version)
    return build_forecast(union_all(frames), models, trained_at, station_metrics)


def metadata_row(
    spark: SparkSession,
    selection: list[dict],
    training_row_count: int,
    saved_at: dt.datetime,
    model_version: str = MODEL_VERSION,
) -> DataFrame:
    """The model document: choice, metrics of every candidate, features, row count."""
    fields = (
        "model_name string, model_type string, cv_mae_days double, cv_mae_std double, "
        "mae_days double, rmse_days double, r2_score double, evaluation_row_count long"
    )
    candidates = spark.createDataFrame(
        [[r.get(f.split()[0]) for f in fields.split(", ")] for r in selection], fields
    )
    best = selection[0]
    metrics = F.struct(*[
        F.lit(best.get(m)).alias(m) for m in ("mae_days", "rmse_days", "r2_score", "evaluation_row_count")
    ])
    return candidates.agg(
        F.collect_list(F.struct(*candidates.columns)).alias("selection_results")
    ).select(
        F.lit(best["model_name"]).alias("model_name"),
        F.lit(model_version).alias("model_version"),
        F.array(*[F.lit(f) for f in FEATURES]).alias("features"),
        F.lit("cv_mae_days_5fold").alias("selection_metric"),
        metrics.alias("metrics"),
        F.lit(training_row_count).alias("training_row_count"),
        "selection_results",
        F.lit(saved_at.strftime("%Y%m%d_%H%M%S")).alias("saved_at_utc"),
    )


def save_artifact(
    model: Model, metadata: DataFrame, path: str, station_metrics: DataFrame | None = None
) -> None:
    """Model, its JSON document, and the per-station metrics as their own JSON rows."""
    save_model(metadata.sparkSession, model, f"{path}/model")
    metadata.coalesce(1).write.mode("overwrite").json(f"{path}/metadata")
    if station_metrics is not None:
        station_metrics.write.mode("overwrite").json(f"{path}/station_metrics")
