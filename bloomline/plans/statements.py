"""Dashboard statements as SQL with named parameter markers over registered views.

A value is bound, never pasted into the text; tables are named by markers too,
so that one statement serves any version of a table. A null ``location_code`` or
``station_code`` means all of them. Catalyst folds bound values, so a filter on
one reaches the scan as a literal would.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from bloomline.config import FIRST_BLOOM, FULL_BLOOM, HISTORY_YEARS, LOCATION_WIDTH, MAX_GAP_DAYS


def two_digits(value: str) -> str:
    """Rounding half up after float noise is gone."""
    return f"round(round({value}, 9), 2)"


def chosen(column: str, marker: str) -> str:
    return f"(:{marker} IS NULL OR {column} = :{marker})"


STATEMENTS = {
    "available_years": """
SELECT DISTINCT forecast_year FROM IDENTIFIER(:forecast)
WHERE is_best_model AND event_type = :event_type ORDER BY forecast_year""",
    "station_list": """
SELECT station_code, location_code, station_name, latitude, longitude FROM IDENTIFIER(:dim_station)
ORDER BY station_name, station_code""",
    "climate_timeseries": f"""
SELECT f.station_code, s.station_name, m.date_key, f.mean_temp_c, f.precipitation_mm, m.season
FROM IDENTIFIER(:fact_climate) AS f
LEFT JOIN IDENTIFIER(:dim_station) AS s ON f.station_code = s.station_code
LEFT JOIN IDENTIFIER(:dim_month) AS m ON f.date_key = m.date_key
WHERE {chosen('f.station_code', 'station_code')} ORDER BY f.station_code, m.date_key""",
    "climate_kpis": f"""
SELECT station_code, count(*) AS total_months, count(*) div 12 AS total_years,
       {two_digits('avg(mean_temp_c)')} AS avg_temp_c, {two_digits('avg(precipitation_mm)')} AS avg_precipitation_mm,
       {two_digits('min(mean_temp_c)')} AS min_temp_c, {two_digits('max(mean_temp_c)')} AS max_temp_c
FROM IDENTIFIER(:fact_climate) WHERE {chosen('station_code', 'station_code')} GROUP BY station_code""",
    "bloom_history": f"""
SELECT location_code, year, date_key, day_of_year, event_type, data_status, source_name FROM IDENTIFIER(:fact_events)
WHERE event_type = :event_type AND {chosen('location_code', 'location_code')} ORDER BY location_code, year, date_key""",
    "bloom_temp_features": f"""
WITH late AS (
  SELECT station_code, year(date_key) AS year, {two_digits('avg(mean_temp_c)')} AS mean_temp_feb_mar
  FROM IDENTIFIER(:fact_climate) WHERE month(date_key) IN (2, 3) GROUP BY station_code, year(date_key))
SELECT e.location_code, t.station_code, e.year, e.date_key, e.day_of_year, t.mean_temp_feb_mar
FROM IDENTIFIER(:fact_events) AS e
LEFT JOIN late AS t ON right(t.station_code, :width) = lpad(e.location_code, :width, '0') AND t.year = e.year
WHERE e.event_type = :event_type AND {chosen('e.location_code', 'location_code')} ORDER BY e.location_code, e.year, t.station_code""",
    "bloom_forecast": """
SELECT location_code, forecast_year, predicted_day_of_year, predicted_event_date, model_name, model_version, prediction_status,
       is_best_model, trained_at, station_mae_days, mae_days
FROM IDENTIFIER(:forecast)
WHERE location_code = :location_code AND forecast_year = :year AND event_type = :event_type AND is_best_model
ORDER BY trained_at DESC, model_version DESC, model_name LIMIT 1""",
    "forecast_map": """
SELECT s.station_code, s.location_code, s.station_name, s.latitude, s.longitude, f.forecast_year, f.predicted_day_of_year,
       f.predicted_event_date, f.model_name, f.mae_days, f.rmse_days, coalesce(f.station_mae_days, f.mae_days) AS station_mae_days,
       date_format(f.predicted_event_date, 'dd MMM yyyy') AS bloom_label
FROM IDENTIFIER(:forecast) AS f
JOIN IDENTIFIER(:dim_station) AS s ON lpad(f.location_code, :width, '0') = lpad(s.location_code, :width, '0')
WHERE f.is_best_model AND f.event_type = :event_type AND (:year IS NULL OR f.forecast_year = :year)
  AND s.latitude IS NOT NULL AND s.longitude IS NOT NULL
ORDER BY s.station_name, f.forecast_year, s.station_code""",
    "bloom_gap": f"""
WITH daily AS (
  SELECT location_code, year, day_of_year, count_if(event_type = :event_type) AS n_first, count_if(event_type = :second_type) AS n_second
  FROM IDENTIFIER(:fact_events)
  WHERE event_type IN (:event_type, :second_type) AND day_of_year IS NOT NULL AND {chosen('location_code', 'location_code')}
  GROUP BY location_code, year, day_of_year),
reached AS (
  SELECT location_code, n_second, day_of_year, sum(n_first) OVER back AS firsts, sum(n_first * day_of_year) OVER back AS days FROM daily
  WINDOW back AS (PARTITION BY location_code, year ORDER BY day_of_year RANGE BETWEEN :most_days PRECEDING AND CURRENT ROW))
SELECT location_code, CAST(round(sum(n_second * (day_of_year * firsts - days)) / sum(n_second * firsts)) AS INT) AS avg_gap_days,
       sum(n_second * firsts) AS obs_count
FROM reached WHERE n_second * firsts > 0 GROUP BY location_code""",
    "historical_avg_last_n": f"""
WITH aged AS (
  SELECT location_code, day_of_year, row_number() OVER (PARTITION BY location_code ORDER BY year DESC, day_of_year) AS age
  FROM IDENTIFIER(:fact_events)
  WHERE event_type = :event_type AND day_of_year IS NOT NULL AND {chosen('location_code', 'location_code')})
SELECT location_code, CAST(round(avg(day_of_year)) AS INT) AS avg_day_of_year FROM aged WHERE age <= :n GROUP BY location_code""",
}
DEFAULTS = {
    "event_type": FIRST_BLOOM, "second_type": FULL_BLOOM, "location_code": None, "station_code": None, "year": None,
    "n": HISTORY_YEARS, "width": LOCATION_WIDTH, "most_days": MAX_GAP_DAYS,
}


def run(spark: SparkSession, name: str, tables: dict[str, DataFrame], **values) -> DataFrame:
    """A statement over the given tables; values are bound to its markers, others take their defaults."""
    unknown = set(values) - set(DEFAULTS)
    if unknown:
        raise ValueError(f"unknown parameters: {sorted(unknown)}")
    views = {}
    for table, df in tables.items():
        views[table] = f"{table}_{uuid.uuid4().hex}"
        df.createOrReplaceTempView(views[table])
    try:
        # The plan holds the views' own plans from here on.
        return spark.sql(STATEMENTS[name], args=DEFAULTS | values | views)
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)
