"""Month cells: counts and sums of climate rows, stored between loads.

A stored cell is one station, year and month. Its counts and sums add up, so
cells of several stations of one location merge, and a load replaces the cells
of its own station years and touches nothing else. Normals, training features
and the features of the coming season read cells instead of the climate fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bloomline.config import BASELINE_YEARS
from bloomline.functions.codes import location_code

# Months that a target year looks at.
SEASON = [9, 10, 11, 12, 1, 2, 3]
STATION_YEAR = ["station_code", "year"]


def partial_sums() -> list[Column]:
    return [
        F.count("*").alias("n"),
        F.count("mean_temp_c").alias("temp_n"),
        F.sum("mean_temp_c").alias("temp_sum"),
        F.count("precipitation_mm").alias("precip_n"),
        F.sum("precipitation_mm").alias("precip_sum"),
    ]


def month_cells(climate: DataFrame, width: int, months: list[int] = SEASON) -> DataFrame:
    """Climate rows of the months folded to one row per location, year and month."""
    d = F.col("date_key")
    return (
        climate.where(F.month(d).isin(months))
        .groupBy(
            location_code(F.col("station_code"), width).alias("location_code"),
            F.year(d).alias("year"),
            F.month(d).alias("month"),
        )
        .agg(*partial_sums())
    )


def station_cells(climate: DataFrame, width: int) -> DataFrame:
    """Cells to be stored: all months, one row per station, year and month.

    Two stations may share a location code, so the station stays a key. A row
    without a date belongs to no month and is left out.
    """
    d = F.col("date_key")
    folded = climate.where(d.isNotNull()).groupBy(
        "station_code", F.year(d).alias("year"), F.month(d).alias("month")
    ).agg(*partial_sums())
    return folded.select(
        "station_code", location_code(F.col("station_code"), width).alias("location_code"), *folded.columns[1:]
    )


def replace_station_years(stored: DataFrame, load: DataFrame, cleared: DataFrame | None = None) -> DataFrame:
    """Stored cells with those of the load's station years taken from the load.

    ``cleared`` (station_code, year) names station years that were read again and
    have no rows any more. A missing station code is a value like any other.
    """
    replaced = load.select(STATION_YEAR)
    if cleared is not None:
        replaced = replaced.unionByName(cleared.select(STATION_YEAR))
    replaced = replaced.distinct()
    same = stored["station_code"].eqNullSafe(replaced["station_code"]) & (stored["year"] == replaced["year"])
    return stored.join(replaced, same, "left_anti").unionByName(load)


def location_cells(stored: DataFrame, months: list[int] | None = None) -> DataFrame:
    """Stored cells merged over the stations of a location."""
    kept = stored if months is None else stored.where(F.col("month").isin(months))
    sums = [F.sum(c).alias(c) for c in ("n", "temp_n", "temp_sum", "precip_n", "precip_sum")]
    return kept.groupBy("location_code", "year", "month").agg(*sums)


def cell_normals(
    cells: DataFrame, first: int = BASELINE_YEARS[0], last: int = BASELINE_YEARS[1]
) -> DataFrame:
    """Average of each measure per location and month over the baseline years, out of cells."""
    return (
        cells.where(F.col("year").between(first, last))
        .groupBy("location_code", "month")
        .agg(
            F.try_divide(F.sum("temp_sum"), F.sum("temp_n")).alias("avg_temp"),
            F.try_divide(F.sum("precip_sum"), F.sum("precip_n")).alias("avg_precip"),
        )
    )
