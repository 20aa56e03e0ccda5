"""Star schema: date, month, station and location dimensions; climate, event and gap facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from bloomline.config import FIRST_BLOOM, FULL_BLOOM, MAX_GAP_DAYS, STATION_BASE
from bloomline.functions.codes import location_number
from bloomline.functions.dates import season
from bloomline.session import scratch_path


def dim_date(staged_events: DataFrame) -> DataFrame:
    """Distinct event dates; attributes are derived after the dedupe."""
    dates = staged_events.select(F.col("event_date").alias("date_key")).dropna().distinct()
    return _dated(dates)


def _dated(dates: DataFrame) -> DataFrame:
    d = F.col("date_key")
    return dates.select(
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.dayofyear(d).alias("day_of_year"),
        F.quarter(d).alias("quarter"),
        season(F.month(d)).alias("season"),
    )


def dim_month(staged_climate: DataFrame) -> DataFrame:
    return _monthly(staged_climate.select(F.col("month_start_date").alias("date_key")).distinct())


def _monthly(months: DataFrame) -> DataFrame:
    d = F.col("date_key")
    return months.select(
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        season(F.month(d)).alias("season"),
    )


def dim_station(staged_climate: DataFrame, metadata: DataFrame, base: int = STATION_BASE) -> DataFrame:
    """Station profile with coordinates.

    ``metadata`` has one row per station, so the climate rows are aggregated
    before the join instead of after it.
    """
    profile = staged_climate.groupBy("station_code", "station_name").agg(
        F.min("month_start_date").alias("first_observation"),
        F.max("month_start_date").alias("last_observation"),
        F.count("*").alias("record_count"),
    )
    return _located(profile, metadata, base)


def _located(profile: DataFrame, metadata: DataFrame, base: int) -> DataFrame:
    located = profile.join(
        metadata.select("station_code", "latitude", "longitude"), on="station_code", how="left"
    )
    return located.select(
        "station_code",
        location_number(F.col("station_code"), base).alias("location_code"),
        "station_name", "latitude", "longitude",
        "first_observation", "last_observation", "record_count",
    )


def dim_location(staged_events: DataFrame) -> DataFrame:
    return staged_events.groupBy("location_code", "location_name").agg(
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.count("*").alias("record_count"),
    )


def one_scan(staged: DataFrame, name: str, profile: list[str], single: str, aggregates: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Groups by ``profile`` and distinct values of ``single`` from one scan.

    The grouping sets are folded together and written once, a folder for each;
    the grouping id tells a missing key from one that isn't grouped by.
    """
    which = F.grouping_id().cast("int")
    folded = staged.groupingSets([profile, [single]], *profile, single).agg(which.alias("_grouped"), *aggregates)
    path = scratch_path(staged.sparkSession, name)
    folded.write.partitionBy("_grouped").parquet(path)
    # Bits of the id stand for the keys in order, set where a key is not grouped by.
    stored = staged.sparkSession.read.schema(folded.schema).parquet(path)
    of_profile = stored.where(F.col("_grouped") == 1).drop("_grouped", single)
    of_single = stored.where(F.col("_grouped") == (1 << (len(profile) + 1)) - 2).select(single)
    return of_profile, of_single


def climate_dimensions(
    staged_climate: DataFrame, metadata: DataFrame, base: int = STATION_BASE
) -> dict[str, DataFrame]:
    """``dim_station`` and ``dim_month`` from one scan of the staged climate."""
    stations, months = one_scan(
        staged_climate.withColumn("_month", F.col("month_start_date")), "climate-dimensions", ["station_code", "station_name"], "_month", [
            F.min("month_start_date").alias("first_observation"),
            F.max("month_start_date").alias("last_observation"),
            F.count("*").alias("record_count"),
        ]
    )
    return {
        "dim_station": _located(stations, metadata, base),
        "dim_month": _monthly(months.withColumnRenamed("_month", "date_key")),
    }


def event_dimensions(staged_events: DataFrame) -> dict[str, DataFrame]:
    """``dim_location`` and ``dim_date`` from one scan of the staged events."""
    locations, dates = one_scan(
        staged_events, "event-dimensions", ["location_code", "location_name"], "event_date", [
            F.min("year").alias("first_year"),
            F.max("year").alias("last_year"),
            F.count("*").alias("record_count"),
        ]
    )
    return {
        "dim_location": locations,
        "dim_date": _dated(dates.dropna().withColumnRenamed("event_date", "date_key")),
    }


def fact_climate(staged_climate: DataFrame) -> DataFrame:
    return staged_climate.select(
        "station_code", F.col("month_start_date").alias("date_key"), "mean_temp_c", "precipitation_mm"
    )


def fact_events(staged_events: DataFrame) -> DataFrame:
    return staged_events.select(
        "location_code", F.col("event_date").alias("date_key"), "year", "event_type",
        "day_of_year", "data_status", "source_name",
    )


def event_gap(
    events: DataFrame,
    first: str = FIRST_BLOOM,
    second: str = FULL_BLOOM,
    low: int = 0,
    high: int = MAX_GAP_DAYS,
) -> DataFrame:
    """Average days from one event to the next per location.

    Every pair of a first and a second event of one location and year counts, if
    ``low`` to ``high`` days apart. Rows are first counted per day of year, which
    bounds a (location, year) to 366 rows however often an event is repeated; a
    range frame then looks back from each second event, so no pair is ever built.
    """
    type_is = lambda name: F.count_if(F.col("event_type") == name)
    daily = (
        events.where(F.col("event_type").isin(first, second) & F.col("day_of_year").isNotNull())
        .groupBy("location_code", "year", "day_of_year")
        .agg(type_is(first).alias("n_first"), type_is(second).alias("n_second"))
    )
    back = (
        Window.partitionBy("location_code", "year").orderBy("day_of_year").rangeBetween(-high, -low)
    )
    doy = F.col("day_of_year").cast("long")
    reached = daily.select(
        "location_code",
        (F.col("n_second") * F.sum("n_first").over(back)).alias("pairs"),
        (F.col("n_second") * (doy * F.sum("n_first").over(back)
                              - F.sum(F.col("n_first") * doy).over(back))).alias("days"),
    )
    return (
        reached.where("pairs > 0")
        .groupBy("location_code")
        .agg(
            F.round(F.sum("days") / F.sum("pairs")).cast("int").alias("avg_gap_days"),
            F.sum("pairs").alias("obs_count"),
        )
    )
