"""Status and class labels shown next to a forecast."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from bloomline.config import LOW_RELIABILITY_MAE, MODEL_LABELS


def prediction_status(uses_normals: Column) -> Column:
    return F.when(uses_normals, "estimated").otherwise("predicted")


def anomaly_class(forecast_doy: Column, average_doy: Column) -> Column:
    """Forecast against the long-term average; a day either way is on par."""
    delta = forecast_doy - average_doy
    return (
        F.when(delta.isNull(), "none")
        .when(F.abs(delta) <= 1, "on par")
        .when(delta < 0, "earlier")
        .otherwise("later")
    )


def reliability_class(station_mae: Column, mae: Column, limit: float = LOW_RELIABILITY_MAE) -> Column:
    """``low`` above the limit, else the error as ``±n d``, ties to the even number.

    A mean's last digits depend on the order of its sum: they go first, so that 13.499999999999998 is a tie.
    """
    error = F.round(F.coalesce(station_mae, mae), 9)
    return (
        F.when(error.isNull(), "none")
        .when(error > limit, "low")
        .otherwise(F.concat(F.lit("±"), F.rint(error).cast("int").cast("string"), F.lit(" d")))
    )


def label_lookup(key: Column, labels: dict[str, str] = MODEL_LABELS) -> Column:
    """Display name of a key, the key itself where none is known."""
    pairs = [F.lit(x) for item in labels.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), key)
