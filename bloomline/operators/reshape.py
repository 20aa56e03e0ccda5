"""Wide to long, season grids and calendar spines. All are narrow: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bloomline.config import FIRST_YEAR, MONTHS
from bloomline.functions.text import clean_numeric, clean_text, month_number, normalize_mmdd
from bloomline.sources.wide_csv import SUFFIX, year_attributes, year_columns


def unpivot_months(df: DataFrame, id_cols: list[str], value: str, year_col: str = "Year") -> DataFrame:
    """Year rows with twelve month columns to (ids, year, month, value)."""
    absent = [c for c in [year_col, *MONTHS] if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {absent}")
    ids = [c for c in id_cols if c != year_col]
    long = df.select(*ids, year_col, *MONTHS).unpivot([*ids, year_col], MONTHS, "_month", "_cell")
    return long.select(
        *ids,
        F.col(year_col).try_cast("double").cast("int").alias("year"),
        month_number(F.col("_month")).alias("month"),
        clean_numeric(F.col("_cell")).alias(value),
    ).where(F.col("year").isNotNull())


def unpivot_years(
    df: DataFrame,
    id_cols: list[str],
    suffix: str = SUFFIX,
    first: int = FIRST_YEAR,
    last: int | None = None,
) -> DataFrame:
    """Year columns, each with its attribute column, to one row per year.

    Both families unfold in a single ``inline`` pass, so the attribute needs no
    join back onto the dates.
    """
    years = year_columns(df.columns, first, last)
    if not years:
        raise ValueError("no year columns found")
    attributes = year_attributes(df.columns, suffix, first, last)
    ids = [c for c in id_cols if c in df.columns]

    def cell(name: str) -> Column:
        attribute = attributes.get(int(name))
        return F.struct(
            F.lit(int(name)).alias("year"),
            F.col(f"`{name}`").cast("string").alias("event_date_raw"),
            (F.col(f"`{attribute}`") if attribute else F.lit(None)).cast("string").alias("rm_raw"),
        )

    named = df.withColumns({c: clean_text(F.col(c)) for c in ids})
    if "location_name_raw" in ids:
        named = named.where(F.col("location_name_raw").isNotNull())
    long = named.select(*ids, F.inline(F.array(*[cell(y) for y in years])))
    # Cells are cleaned after they are unfolded: one expression instead of one per year.
    return long.withColumns({
        "event_date_raw": normalize_mmdd(F.col("event_date_raw")),
        "rm_raw": clean_text(F.col("rm_raw")),
    })


# Months of a forecast season and their year relative to the forecast.
SEASON_MONTHS = [(9, -1), (10, -1), (11, -1), (12, -1), (1, 0), (2, 0), (3, 0)]


def month_grid(
    locations: DataFrame,
    year: Column,
    months: list[tuple[int, int]] = SEASON_MONTHS,
) -> DataFrame:
    """Every location with each (month, calendar year) of the season."""
    cells = [
        F.struct(F.lit(m).alias("month"), (F.col("forecast_year") + offset).alias("year"))
        for m, offset in months
    ]
    return locations.withColumn("forecast_year", year).select(
        *locations.columns, "forecast_year", F.inline(F.array(*cells))
    )


def calendar_spine(
    windows: DataFrame,
    start: str = "first_bloom",
    end: str = "petals_end",
    keys: tuple[str, ...] = ("location_code",),
) -> DataFrame:
    """One row per day from first bloom to the day after the petals have fallen."""
    last = F.date_add(F.col(end), 1)
    n = F.datediff(last, F.col(start)) + 1
    days = windows.withColumn("n_days", n).select(
        *windows.columns, "n_days",
        F.posexplode(F.sequence(F.col(start), last)).alias("day_index", "day"),
    )
    day = F.col("day")
    return days.select(
        *keys,
        "day",
        "day_index",
        (F.col("day_index") / F.greatest(F.col("n_days") - 1, F.lit(1))).alias("phase"),
        day.between(F.col("peak_start"), F.col("peak_end")).alias("is_peak"),
        day.between(F.col("visit_start"), F.col("visit_end")).alias("is_visit"),
        (day == F.col("full_bloom")).alias("is_full_bloom"),
    )
