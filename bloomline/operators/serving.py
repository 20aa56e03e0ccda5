"""Queries behind the dashboard, computed for every station at once.

A caller filters the result on a station or year; the predicate moves down to the
scans. Joins carry no broadcast hint: Spark compares the dimension with its size
threshold, statically and again at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from bloomline.config import DEFAULT_FULL_BLOOM_GAP, FIRST_BLOOM, HISTORY_YEARS, LOCATION_WIDTH
from bloomline.functions.codes import location_code, pad_location
from bloomline.functions.dates import date_label, range_label
from bloomline.functions.text import round_exact


def best_forecasts(forecast: DataFrame, event_type: str = FIRST_BLOOM) -> DataFrame:
    return forecast.where(F.col("is_best_model") & (F.col("event_type") == event_type))


def available_years(forecast: DataFrame, event_type: str = FIRST_BLOOM) -> DataFrame:
    return best_forecasts(forecast, event_type).select("forecast_year").distinct().orderBy("forecast_year")


def station_list(stations: DataFrame) -> DataFrame:
    return stations.select(
        "station_code", "location_code", "station_name", "latitude", "longitude"
    ).orderBy("station_name", "station_code")


def climate_timeseries(climate: DataFrame, stations: DataFrame, months: DataFrame) -> DataFrame:
    """Monthly measures with station name and season."""
    months = months.select("date_key", "season", F.col("date_key").alias("_month"))
    return (
        climate.join(stations.select("station_code", "station_name"), on="station_code", how="left")
        .join(months, on="date_key", how="left")
        .select(
            "station_code", "station_name", F.col("_month").alias("date_key"),
            "mean_temp_c", "precipitation_mm", "season",
        )
        .orderBy("station_code", "date_key")
    )


def climate_kpis(climate: DataFrame) -> DataFrame:
    """Months, whole years, averages and extremes of each station."""
    two = round_exact
    return (
        climate.groupBy("station_code")
        .agg(
            F.count("*").alias("total_months"),
            two(F.avg("mean_temp_c")).alias("avg_temp_c"),
            two(F.avg("precipitation_mm")).alias("avg_precipitation_mm"),
            two(F.min("mean_temp_c")).alias("min_temp_c"),
            two(F.max("mean_temp_c")).alias("max_temp_c"),
        )
        .withColumn("total_years", F.expr("total_months div 12"))
    )


def event_history(events: DataFrame, event_type: str = FIRST_BLOOM) -> DataFrame:
    return events.where(F.col("event_type") == event_type).select(
        "location_code", "year", "date_key", "day_of_year", "event_type", "data_status", "source_name"
    ).orderBy("location_code", "year", "date_key")


def late_season_temp(climate: DataFrame, months: tuple[int, ...] = (2, 3)) -> DataFrame:
    """Yearly mean temperature over the chosen months."""
    return (
        climate.where(F.month("date_key").isin(*months))
        .groupBy("station_code", F.year("date_key").alias("year"))
        .agg(round_exact(F.avg("mean_temp_c")).alias("mean_temp_feb_mar"))
    )


def event_temp_features(
    events: DataFrame,
    climate: DataFrame,
    event_type: str = FIRST_BLOOM,
    months: tuple[int, ...] = (2, 3),
    width: int = LOCATION_WIDTH,
) -> DataFrame:
    """Event dates next to the late-winter temperature of their station."""
    temperature = late_season_temp(climate, months).withColumn(
        "_location", location_code(F.col("station_code"), width)
    )
    history = event_history(events, event_type).withColumn(
        "_location", pad_location(F.col("location_code"), width)
    )
    return history.join(temperature, on=["_location", "year"], how="left").select(
        "location_code", "station_code", "year", "date_key", "day_of_year", "mean_temp_feb_mar"
    ).orderBy("location_code", "year", "station_code")


FORECAST_COLUMNS = [
    "location_code", "forecast_year", "predicted_day_of_year", "predicted_event_date",
    "model_name", "model_version", "prediction_status", "is_best_model", "trained_at",
    "station_mae_days", "mae_days",
]


def best_forecast(
    forecast: DataFrame, location_code: str, year: int, event_type: str = FIRST_BLOOM
) -> DataFrame:
    """The best model's forecast of one location and year, newest first."""
    return (
        best_forecasts(forecast, event_type)
        .where((F.col("location_code") == location_code) & (F.col("forecast_year") == year))
        .select(FORECAST_COLUMNS)
        .orderBy(F.desc("trained_at"), F.desc("model_version"), "model_name")
        .limit(1)
    )


def forecast_map(
    forecast: DataFrame,
    stations: DataFrame,
    event_type: str = FIRST_BLOOM,
    width: int = LOCATION_WIDTH,
) -> DataFrame:
    """Best-model forecasts with coordinates and labels; stations off the map drop out."""
    located = stations.where(
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    ).select(
        "station_code", "location_code", "station_name", "latitude", "longitude",
        pad_location(F.col("location_code"), width).alias("_location"),
    )
    best = best_forecasts(forecast, event_type).select(
        pad_location(F.col("location_code"), width).alias("_location"),
        "forecast_year", "predicted_day_of_year", "predicted_event_date",
        "model_name", "mae_days", "station_mae_days", "rmse_days",
    )
    return best.join(located, on="_location").select(
        *located.columns[:-1], *[c for c in best.columns[1:] if c != "station_mae_days"],
        F.coalesce("station_mae_days", "mae_days").alias("station_mae_days"),
        F.date_format("predicted_event_date", "dd MMM yyyy").alias("bloom_label"),
    ).orderBy("station_name", "forecast_year", "station_code")


def historical_avg(
    events: DataFrame, n: int = HISTORY_YEARS, event_type: str = FIRST_BLOOM
) -> DataFrame:
    """Average day of year over the ``n`` most recent events of each location.

    The rank limit also runs ahead of the shuffle: ``n`` rows per location and task.
    """
    recent = Window.partitionBy("location_code").orderBy(F.desc("year"), "day_of_year")
    return (
        events.where((F.col("event_type") == event_type) & F.col("day_of_year").isNotNull())
        .select("location_code", "year", "day_of_year", F.row_number().over(recent).alias("_rank"))
        .where(F.col("_rank") <= n)
        .groupBy("location_code")
        .agg(F.round(F.avg("day_of_year")).cast("int").alias("avg_day_of_year"))
    )


def trailing_years(df: DataFrame, reference_year: int | Column, n: int = HISTORY_YEARS) -> DataFrame:
    """Rows of the ``n`` years up to the reference year, and later ones."""
    return df.where(F.col("year") >= reference_year - n + 1)


def trend(events: DataFrame, n: int = HISTORY_YEARS, event_type: str = FIRST_BLOOM) -> DataFrame:
    """Straight line through the last ``n`` years of each location, at both ends.

    Events are folded to one row per location and year, so a window sees at most
    one row per calendar year; the line then follows from exact integer sums.
    """
    x = F.col("year").cast("long")
    yearly = (
        events.where((F.col("event_type") == event_type) & F.col("day_of_year").isNotNull())
        .groupBy("location_code", "year")
        .agg(F.count("*").alias("n"), F.sum("day_of_year").alias("sy"))
    )
    last = F.max("year").over(Window.partitionBy("location_code"))
    sums = (
        yearly.withColumn("_last", last)
        .where(F.col("year") >= F.col("_last") - n + 1)
        .groupBy("location_code")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * x).alias("sx"),
            F.sum("sy").alias("sy"),
            F.sum(F.col("n") * x * x).alias("sxx"),
            F.sum(F.col("sy") * x).alias("sxy"),
            F.min("year").alias("first_year"),
            F.max("year").alias("last_year"),
        )
    )
    slope = F.try_divide(F.expr("n * sxy - sx * sy"), F.expr("n * sxx - sx * sx"))
    at = lambda c: F.col("sy") / F.col("n") + F.col("slope") * (F.col(c) - F.col("sx") / F.col("n"))
    return (
        sums.where("n >= 2")
        .withColumn("slope", slope)
        .where("slope IS NOT NULL")
        .select(
            "location_code", "first_year", "last_year", "slope",
            at("first_year").alias("trend_start"), at("last_year").alias("trend_end"),
        )
    )


def visit_windows(
    forecast: DataFrame,
    gaps: DataFrame,
    default_gap: int = DEFAULT_FULL_BLOOM_GAP,
    event_type: str = FIRST_BLOOM,
    width: int = LOCATION_WIDTH,
) -> DataFrame:
    """Full bloom, peak, best-visit and falling-petals dates of each best forecast."""
    gap = gaps.select(pad_location(F.col("location_code"), width).alias("_location"), "avg_gap_days")
    best = (
        best_forecasts(forecast, event_type)
        .where(F.col("predicted_event_date").isNotNull())
        .select(
            "location_code", "forecast_year",
            F.col("predicted_event_date").alias("first_bloom"),
            pad_location(F.col("location_code"), width).alias("_location"),
        )
    )
    full = F.date_add("first_bloom", F.coalesce("avg_gap_days", F.lit(default_gap)))
    dated = best.join(gap, on="_location", how="left").withColumn("full_bloom", full)
    # Days relative to full bloom.
    offsets = {
        "peak_start": -1, "peak_end": 1,
        "visit_start": -3, "visit_end": 5,
        "petals_start": 3, "petals_end": 10,
    }
    return dated.select(
        "location_code", "forecast_year", "first_bloom", "full_bloom",
        *[F.date_add("full_bloom", days).alias(name) for name, days in offsets.items()],
    )


def window_labels(windows: DataFrame) -> DataFrame:
    """Readable first bloom, full bloom and visit range."""
    return windows.select(
        "location_code", "forecast_year",
        date_label(F.col("first_bloom")).alias("first_bloom_label"),
        date_label(F.col("full_bloom"), "d MMM").alias("full_bloom_label"),
        range_label(F.col("visit_start"), F.col("visit_end")).alias("visit_label"),
    )


def spots_table(spark: SparkSession, spots: dict[str, list[tuple[str, str]]]) -> DataFrame:
    """A spots dictionary as rows (station_name, spot, district)."""
    rows = [(station, spot, district) for station, listed in spots.items() for spot, district in listed]
    return spark.createDataFrame(rows, "station_name string, spot string, district string")


def visit_spots(stations: DataFrame, spots: DataFrame, key: str = "station_name") -> DataFrame:
    """Spots of each station, matched on the upper-case name."""
    named = spots.withColumn("_key", F.upper(F.col(key))).drop(key)
    return stations.withColumn("_key", F.upper(F.col(key))).join(named, on="_key").drop("_key")
