"""Raw to staging: typing, filtering, latest-row dedupe, guarded dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from bloomline.config import OBSERVED
from bloomline.functions.dates import looks_like_month_day, month_day_to_date
from bloomline.functions.text import add_lineage


def latest_per_key(
    df: DataFrame,
    keys: list[str],
    order: str = "raw_ingested_at",
    tie_break: list[str] | None = None,
) -> DataFrame:
    """Newest row of each key.

    A NULL timestamp loses against any real one; ``tie_break`` columns, highest
    first, decide between equal timestamps. The rank filter is also applied
    before the shuffle, so a hot key sends one row per map task.
    """
    by = [F.col(c).desc_nulls_last() for c in [order, *(tie_break or [])]]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*by)))
    return ranked.where("_rank = 1").drop("_rank")


CLIMATE_KEY = ["station_code", "year", "month"]


def stage_climate(raw: DataFrame) -> DataFrame:
    """Typed monthly climate, one row per station and month."""
    typed = raw.where(F.col("year").isNotNull() & F.col("month").between(1, 12)).select(
        F.trim("station_code").alias("station_code"),
        F.trim("station_name").alias("station_name"),
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        F.make_date("year", "month", F.lit(1)).alias("month_start_date"),
        F.col("mean_temp_c").cast("double").alias("mean_temp_c"),
        F.col("precipitation_mm").cast("double").alias("precipitation_mm"),
        "source_url",
        "raw_ingested_at",
    )
    return latest_per_key(
        typed, CLIMATE_KEY, tie_break=["mean_temp_c", "precipitation_mm", "station_name", "source_url"]
    )


def stage_events(raw: DataFrame) -> DataFrame:
    """Events with their parsed date; unreadable dates stay as NULL rows."""
    date = month_day_to_date(F.col("year"), F.col("event_date_raw"))
    return raw.select(
        F.col("station_code_raw").alias("location_code"),
        F.trim("location_name_raw").alias("location_name"),
        "year",
        date.alias("event_date"),
        F.dayofyear(date).alias("day_of_year"),
        "event_type", "data_status", "source_name", "source_url",
        "rm_raw", "event_date_raw", "raw_ingested_at",
    )


def impossible_dates(staged: DataFrame) -> DataFrame:
    """Rejects: the text reads like a date, the calendar has no such day."""
    return staged.where(looks_like_month_day(F.col("event_date_raw")) & F.col("event_date").isNull())


def station_driver_list(staged_climate: DataFrame) -> DataFrame:
    """Stations whose metadata is to be fetched."""
    return (
        staged_climate.select("station_name", "station_code")
        .dropna()
        .distinct()
        .orderBy("station_code", "station_name")
    )


def build_raw_events(
    long: DataFrame, event_type: str, source_name: str, source_url: str,
    page_notes: str, ingested_at: dt.datetime | Column,
) -> DataFrame:
    """Long event rows with a date, plus lineage columns."""
    return add_lineage(
        long.where(F.col("event_date_raw").isNotNull()),
        event_type=event_type, data_status=OBSERVED, source_name=source_name,
        source_url=source_url, page_notes=page_notes, raw_ingested_at=ingested_at,
    )


def join_measures(
    temperature: DataFrame,
    precipitation: DataFrame,
    keys: tuple[str, ...] = ("station_code", "station_name", "year", "month"),
) -> DataFrame:
    """Both monthly measures side by side; a month may lack either."""
    return temperature.join(precipitation, on=list(keys), how="full")
