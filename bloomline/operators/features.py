"""Climatological normals and the seasonal features of a target year.

A target year looks at September to December of the year before and January to
March of its own. Climate rows are first folded to *month cells* (one row per
location, year and month with counts and sums, see ``cells``), so repeated or hot
rows combine before any shuffle, and each month is labelled with the one target year it feeds
instead of being joined to every event of its location.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from bloomline.config import BASELINE_YEARS, FIRST_BLOOM, LOCATION_WIDTH, REQUIRED_FEATURES
from bloomline.functions.codes import location_code, pad_location
from bloomline.functions.dates import forecast_year
from bloomline.operators.cells import SEASON, cell_normals, location_cells, month_cells
from bloomline.operators.reshape import month_grid

# Months that feed each feature.
AUTUMN, WINTER, EARLY_YEAR = [9, 10, 11], [12, 1, 2], [1, 2, 3]
TEMPERATURE_MEANS = {
    "last_autumn_mean_temp": AUTUMN,
    "winter_mean_temp": WINTER,
    "january_mean_temp": [1],
    "february_mean_temp": [2],
    "march_mean_temp": [3],
}


def climate_normals(
    climate: DataFrame,
    first: int = BASELINE_YEARS[0],
    last: int = BASELINE_YEARS[1],
    width: int = LOCATION_WIDTH,
) -> DataFrame:
    """Average of each measure per location and month over the baseline years."""
    baseline = F.col("date_key").between(dt.date(first, 1, 1), dt.date(last, 12, 31))
    return (
        climate.where(baseline)
        .groupBy(
            location_code(F.col("station_code"), width).alias("location_code"),
            F.month("date_key").alias("month"),
        )
        .agg(F.avg("mean_temp_c").alias("avg_temp"), F.avg("precipitation_mm").alias("avg_precip"))
    )


def fill_with_normals(climate: DataFrame, normals: DataFrame, width: int = LOCATION_WIDTH) -> DataFrame:
    """Climate rows with missing measures replaced by the normal of their month."""
    keyed = climate.withColumns({
        "location_code": location_code(F.col("station_code"), width),
        "month": F.month("date_key"),
    })
    return keyed.join(normals, on=["location_code", "month"], how="left").select(
        *[c for c in climate.columns if c not in ("mean_temp_c", "precipitation_mm")],
        "location_code",
        F.coalesce("mean_temp_c", "avg_temp").alias("mean_temp_c"),
        F.coalesce("precipitation_mm", "avg_precip").alias("precipitation_mm"),
    )


def with_normals(cells: DataFrame, first: int, last: int) -> DataFrame:
    """Month cells next to the normals of their location and month.

    A window partition is one location and month, so at most one cell per
    calendar year; the fact is read once and nothing is joined.
    """
    def inside(c: str) -> str:
        baseline = f"CASE WHEN year BETWEEN {first} AND {last} THEN {c} END"
        return f"sum({baseline}) OVER (PARTITION BY location_code, month)"

    return cells.select(
        "*",
        F.expr(f"try_divide({inside('temp_sum')}, {inside('temp_n')}) AS avg_temp"),
        F.expr(f"try_divide({inside('precip_sum')}, {inside('precip_n')}) AS avg_precip"),
    )


def filled(measure: str, normal: str, sum_as: str, count_as: str) -> list[Column]:
    """Sum and count of a cell once its missing values take the normal."""
    usable = f"CASE WHEN {normal} IS NULL THEN 0 ELSE n - {measure}_n END"
    return [
        F.expr(f"coalesce({measure}_sum, 0D) + {usable} * coalesce({normal}, 0D) AS {sum_as}"),
        F.expr(f"{measure}_n + {usable} AS {count_as}"),
    ]


def filled_cells() -> list[Column]:
    return filled("temp", "avg_temp", "t_sum", "t_n") + filled("precip", "avg_precip", "p_sum", "p_n")


def season_aggregates() -> list[Column]:
    """The seven features over the filled cells (t_sum, t_n, p_sum, p_n) of one season."""
    def over(months: list[int], c: str) -> str:
        return f"sum({c}) FILTER (WHERE month IN ({', '.join(map(str, months))}))"

    def total(months: list[int], m: str) -> str:
        return f"CASE WHEN {over(months, m + '_n')} > 0 THEN {over(months, m + '_sum')} END"

    means = [
        F.expr(f"try_divide({over(months, 't_sum')}, {over(months, 't_n')}) AS {name}")
        for name, months in TEMPERATURE_MEANS.items()
    ]
    return means + [
        F.expr(f"{total(EARLY_YEAR, 't')} AS january_march_cumulative_temp"),
        F.expr(f"{total(WINTER, 'p')} AS winter_precipitation_mm"),
    ]


def season_features(
    climate: DataFrame,
    baseline: tuple[int, int] = BASELINE_YEARS,
    width: int = LOCATION_WIDTH,
) -> DataFrame:
    """Features of every (location, target year) the climate covers."""
    return season_features_of(month_cells(climate, width), baseline)


def season_features_of(cells: DataFrame, baseline: tuple[int, int] = BASELINE_YEARS) -> DataFrame:
    """The same from month cells, one per location, year and season month."""
    seasons = with_normals(cells, *baseline).select(
        "location_code",
        F.expr("year + CASE WHEN month >= 9 THEN 1 ELSE 0 END AS year"),
        "month",
        *filled_cells(),
    )
    return seasons.groupBy("location_code", "year").agg(*season_aggregates())


def training_features(
    events: DataFrame,
    climate: DataFrame,
    event_fanout: bool = False,
    baseline: tuple[int, int] = BASELINE_YEARS,
    width: int = LOCATION_WIDTH,
) -> DataFrame:
    """Dated events with the features of their season; incomplete seasons drop out.

    With ``event_fanout`` the two sums are multiplied by the number of event rows
    of the same location and year, as a join ahead of the aggregation would do;
    by default they are the plain sums, matching ``prediction_features``.
    """
    return _with_features(events, season_features(climate, baseline, width), event_fanout, width)


def stored_training_features(
    events: DataFrame,
    stored: DataFrame,
    event_fanout: bool = False,
    baseline: tuple[int, int] = BASELINE_YEARS,
    width: int = LOCATION_WIDTH,
) -> DataFrame:
    """``training_features`` out of stored month cells."""
    features = season_features_of(location_cells(stored, SEASON), baseline)
    return _with_features(events, features, event_fanout, width)


def _with_features(events: DataFrame, features: DataFrame, event_fanout: bool, width: int) -> DataFrame:
    dated = events.where(F.col("date_key").isNotNull() & F.col("day_of_year").isNotNull()).select(
        pad_location(F.col("location_code"), width).alias("location_code"),
        "year", "event_type", F.col("date_key").alias("event_date"),
        "day_of_year", "data_status", "source_name",
    )
    features = features.dropna(subset=REQUIRED_FEATURES)
    if event_fanout:
        rows = dated.groupBy("location_code", "year").agg(F.count("*").alias("_rows"))
        features = features.join(rows, on=["location_code", "year"]).withColumns({
            c: F.col(c) * F.col("_rows")
            for c in ("january_march_cumulative_temp", "winter_precipitation_mm")
        }).drop("_rows")
    joined = dated.join(features, on=["location_code", "year"])
    return joined.select(*dated.columns, *[c for c in features.columns if c not in ("location_code", "year")])


def prediction_grid(
    events: DataFrame,
    as_of: dt.date | Column | None = None,
    event_type: str = FIRST_BLOOM,
    width: int = LOCATION_WIDTH,
) -> DataFrame:
    """Every location of the event with the seven months its forecast needs."""
    locations = (
        events.where(F.col("event_type") == event_type)
        .select(pad_location(F.col("location_code"), width).alias("location_code"))
        .distinct()
    )
    return month_grid(locations, forecast_year(as_of))


def prediction_features(
    events: DataFrame,
    climate: DataFrame,
    as_of: dt.date | Column | None = None,
    event_type: str = FIRST_BLOOM,
    baseline: tuple[int, int] = BASELINE_YEARS,
    width: int = LOCATION_WIDTH,
) -> DataFrame:
    """Features of the coming season; months not yet observed take their normal.

    The actual months are cut out of the fact by a date range that reaches the
    scan. ``using_climate_normals`` tells whether any temperature was filled.
    """
    grid = prediction_grid(events, as_of, event_type, width)
    y, d = forecast_year(as_of), F.col("date_key")
    actual = month_cells(
        climate.where(
            (d >= F.make_date(y - 1, F.lit(9), F.lit(1))) & (d < F.make_date(y, F.lit(4), F.lit(1)))
        ),
        width,
    )
    normals = climate_normals(climate.where(F.month(d).isin(SEASON)), *baseline, width)
    return _coming_season(grid, actual, normals, event_type)


def stored_prediction_features(
    events: DataFrame,
    stored: DataFrame,
    as_of: dt.date | Column | None = None,
    event_type: str = FIRST_BLOOM,
    baseline: tuple[int, int] = BASELINE_YEARS,
    width: int = LOCATION_WIDTH,
) -> DataFrame:
    """``prediction_features`` out of stored month cells.

    Years and months are columns of the cells, so both filters reach the scan.
    """
    grid = prediction_grid(events, as_of, event_type, width)
    y, month = forecast_year(as_of), F.col("month")
    coming = ((F.col("year") == y - 1) & (month >= 9)) | ((F.col("year") == y) & (month <= 3))
    normals = cell_normals(stored.where(month.isin(SEASON)), *baseline)
    return _coming_season(grid, location_cells(stored.where(coming)), normals, event_type)


def _coming_season(grid: DataFrame, actual: DataFrame, normals: DataFrame, event_type: str) -> DataFrame:
    """Grid months with their cells, missing values taken from the normals, folded to features."""
    months = grid.join(actual, on=["location_code", "year", "month"], how="left").join(
        normals, on=["location_code", "month"], how="left"
    )
    # A month without any climate row is one missing value of both measures.
    present = months.withColumns({
        "n": F.coalesce("n", F.lit(1)),
        "temp_n": F.coalesce("temp_n", F.lit(0)),
        "precip_n": F.coalesce("precip_n", F.lit(0)),
    })
    seasons = present.select(
        "location_code", "forecast_year", "month", *filled_cells(),
        F.expr("temp_n < n AS is_estimated"),
    )
    return (
        seasons.groupBy("location_code", F.col("forecast_year").alias("year"))
        .agg(*season_aggregates(), F.bool_or("is_estimated").alias("using_climate_normals"))
        .withColumn("event_type", F.lit(event_type))
    )
