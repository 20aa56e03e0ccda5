"""Declared tables: column types, not-null flags, defaults and business keys."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    schema: T.StructType
    key: tuple[str, ...] = ()
    defaults: dict = field(default_factory=dict)


TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(text: str, required: tuple[str, ...] = ()) -> T.StructType:
    """Schema from ``name type, ...``; needs no running session."""
    named = [column.split() for column in text.split(", ")]
    return T.StructType([T.StructField(n, TYPES[t], n not in required) for n, t in named])


RAW_EVENTS = Table(_struct(
    "raw_ingested_at timestamp_ntz, source_name string, source_url string, "
    "station_code_raw string, location_name_raw string, year int, rm_raw string, "
    "event_type string, event_date_raw string, data_status string, page_notes string"
))

RAW_CLIMATE = Table(_struct(
    "source_url string, station_name string, station_code string, year int, month int, "
    "mean_temp_c double, precipitation_mm double, raw_ingested_at timestamp_ntz"
))

STATION_METADATA = Table(
    _struct(
        "station_code string, station_name string, latitude double, longitude double, "
        "source_url string, metadata_ingested_at timestamp_ntz",
        required=("station_code",),
    ),
    key=("station_code",),
)

FORECAST_KEY = ("location_code", "forecast_year", "event_type", "model_version", "model_name")

FORECAST = Table(
    _struct(
        "location_code string, forecast_year int, event_type string, "
        "predicted_day_of_year int, predicted_event_date date, model_name string, "
        "model_version string, is_best_model boolean, trained_at timestamp_ntz, "
        "training_row_count int, rmse_days double, mae_days double, "
        "station_mae_days double, r2_score double, prediction_status string, "
        "source_name string",
        required=(
            "location_code", "forecast_year", "event_type", "predicted_day_of_year",
            "predicted_event_date", "model_name", "model_version", "is_best_model",
            "trained_at", "prediction_status",
        ),
    ),
    key=FORECAST_KEY,
    defaults={"is_best_model": False},
)
