"""Calendar arithmetic, seasons and date labels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F


def as_column(as_of: dt.date | Column | None) -> Column:
    """The run date; ``None`` means today."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def timestamp(ts: dt.datetime | Column) -> Column:
    """Wall-clock literal, free of any session time zone."""
    return ts if isinstance(ts, Column) else F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def season(month: Column) -> Column:
    """Season name of a month number, NULL outside 1..12."""
    return (
        F.when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .when(month.isin(9, 10, 11), "Autumn")
        .when(month.isin(12, 1, 2), "Winter")
    )


MONTH_DAY = r"^\d{1,2}-\d{1,2}$"


def looks_like_month_day(raw: Column) -> Column:
    return F.trim(raw).rlike(MONTH_DAY)


def month_day_to_date(year: Column, raw: Column) -> Column:
    """Date of an ``M-d`` text in a year; other text and impossible days are NULL."""
    text = F.concat_ws("-", year.cast("string"), F.trim(raw))
    return F.when(looks_like_month_day(raw), F.try_to_date(text, "yyyy-M-d"))


def forecast_year(as_of: dt.date | Column | None = None) -> Column:
    """From June on the next spring is forecast, before that this one."""
    d = as_column(as_of)
    return F.year(d) + F.when(F.month(d) >= 6, 1).otherwise(0)


def active_year(years: DataFrame, as_of: dt.date | None = None, col: str = "forecast_year") -> DataFrame:
    """Earliest forecast year not in the past, else the latest one."""
    y, now = F.col(col), F.year(as_column(as_of))
    return years.agg(
        F.coalesce(F.min(F.when(y >= now, y)), F.max(y)).alias("active_year")
    )


def predicted_doy(c: Column) -> Column:
    """Predicted value to a day of year: half-even rounding, clipped to 1..366."""
    return F.least(F.greatest(F.rint(c), F.lit(1.0)), F.lit(366.0)).cast("int")


def doy_to_date(year: Column, doy: Column) -> Column:
    """Day 366 of a common year is 1 January of the next year."""
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), (doy - 1).cast("int"))


def doy_label(year: Column, doy: Column) -> Column:
    return F.date_format(doy_to_date(year, doy), "dd MMM")


def date_label(c: Column, fmt: str = "dd MMM yyyy", missing: str = "N/A") -> Column:
    return F.coalesce(F.date_format(c, fmt), F.lit(missing))


def range_label(start: Column, end: Column) -> Column:
    """``05 Apr – 09 Apr 2026``."""
    text = F.concat(F.date_format(start, "dd MMM"), F.lit(" – "), F.date_format(end, "dd MMM yyyy"))
    return F.coalesce(text, F.lit("Not available"))
