"""Dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from bloomline.functions import labels
from bloomline.functions.codes import pad_location
from bloomline.operators import marts, reshape, serving
from bloomline.plans import adapters as a
from bloomline.plans.adapters import table
from bloomline.plans.registry import query
from bloomline.session import materialize
from bloomline.plans.sql import day_label, pad, two_digits, with_

W = a.WIDTH


@query("available_years", with_("forecast", """
SELECT DISTINCT forecast_year FROM forecast WHERE is_best_model AND event_type = 'sakura_bloom'"""))
def _(spark, sf):
    return serving.available_years(a.baseline_forecast(spark, sf))


@query("station_list", with_("dim_station", """
SELECT station_code, location_code, station_name, latitude, longitude FROM dim_station"""),
       doubles="latitude longitude")
def _(spark, sf):
    return serving.station_list(a.dim_station(spark, sf))


@query("climate_timeseries", with_("fact_climate dim_station dim_month", """
SELECT f.station_code, s.station_name, m.date_key, f.mean_temp_c, f.precipitation_mm, m.season
FROM fact_climate f LEFT JOIN dim_station s ON f.station_code = s.station_code
LEFT JOIN dim_month m ON f.date_key = m.date_key"""), doubles="mean_temp_c precipitation_mm")
def _(spark, sf):
    staged = materialize(a.staged_climate(spark, sf), "staged-climate")
    stations = marts.dim_station(staged, a.metadata(spark, sf), a.STATION_BASE)
    return serving.climate_timeseries(marts.fact_climate(staged), stations, marts.dim_month(staged))


@query("climate_kpis", with_("climate", f"""
SELECT station_code, count(*) AS total_months, count(*) // 12 AS total_years,
       {two_digits('avg(mean_temp_c)')} AS avg_temp_c, {two_digits('avg(precipitation_mm)')} AS avg_precipitation_mm,
       {two_digits('min(mean_temp_c)')} AS min_temp_c, {two_digits('max(mean_temp_c)')} AS max_temp_c
FROM climate GROUP BY station_code"""),
       doubles="avg_temp_c avg_precipitation_mm min_temp_c max_temp_c")
def _(spark, sf):
    return serving.climate_kpis(a.climate(spark, sf))


@query("bloom_history", with_("events", """
SELECT location_code, year, date_key, day_of_year, event_type, data_status, source_name
FROM events WHERE event_type = 'sakura_bloom'"""))
def _(spark, sf):
    return serving.event_history(a.events(spark, sf))


@query("late_season_temp", with_("climate", f"""
SELECT station_code, CAST(year(date_key) AS INTEGER) AS year, {two_digits('avg(mean_temp_c)')} AS mean_temp_feb_mar
FROM climate WHERE month(date_key) IN (2, 3) GROUP BY 1, 2"""), doubles="mean_temp_feb_mar")
def _(spark, sf):
    return serving.late_season_temp(a.climate(spark, sf))


@query("bloom_temp_features", with_("events climate", f"""
SELECT e.location_code, t.station_code, e.year, e.date_key, e.day_of_year, t.mean_temp_feb_mar
FROM events e
LEFT JOIN (SELECT station_code, year(date_key) AS year, {two_digits('avg(mean_temp_c)')} AS mean_temp_feb_mar
           FROM climate WHERE month(date_key) IN (2, 3) GROUP BY 1, 2) AS t
  ON right(t.station_code, {W}) = {pad('e.location_code')} AND t.year = e.year
WHERE e.event_type = 'sakura_bloom'"""), doubles="mean_temp_feb_mar")
def _(spark, sf):
    return serving.event_temp_features(a.events(spark, sf), a.climate(spark, sf), width=W)


@query("bloom_forecast", with_("forecast", f"""
SELECT location_code, forecast_year, predicted_day_of_year, predicted_event_date, model_name, model_version,
       prediction_status, is_best_model, trained_at, station_mae_days, mae_days
FROM forecast
WHERE location_code = {pad("'7'")} AND forecast_year = 2002 AND event_type = 'sakura_bloom' AND is_best_model
ORDER BY trained_at DESC, model_version DESC, model_name LIMIT 1"""), doubles="station_mae_days mae_days")
def _(spark, sf):
    return serving.best_forecast(a.baseline_forecast(spark, sf), "7".zfill(W), 2002)


@query("forecast_map", with_("forecast dim_station", f"""
SELECT s.station_code, s.location_code, s.station_name, s.latitude, s.longitude, f.forecast_year,
       f.predicted_day_of_year, f.predicted_event_date, f.model_name, f.mae_days, f.rmse_days,
       f.station_mae_days, {day_label('f.predicted_event_date')} AS bloom_label
FROM forecast f JOIN dim_station s ON f.location_code = {pad('s.location_code')}
WHERE f.is_best_model AND s.latitude IS NOT NULL AND s.longitude IS NOT NULL"""),
       doubles="latitude longitude mae_days rmse_days station_mae_days")
def _(spark, sf):
    return serving.forecast_map(a.baseline_forecast(spark, sf), a.dim_station(spark, sf), width=W)


RECENT = """
SELECT location_code, CAST(round(avg(day_of_year)) AS INTEGER) AS avg_day_of_year
FROM (SELECT location_code, day_of_year,
             row_number() OVER (PARTITION BY location_code ORDER BY year DESC) AS age
      FROM events WHERE event_type = 'sakura_bloom' AND day_of_year IS NOT NULL) AS aged
WHERE age <= {n} GROUP BY location_code"""


@query("historical_avg_last_n", with_("events", RECENT.format(n=5)))
def _(spark, sf):
    return serving.historical_avg(a.events(spark, sf), n=5)


@query("bloom_trend", with_("events", """
SELECT location_code, first_year, last_year, slope,
       intercept + slope * first_year AS trend_start, intercept + slope * last_year AS trend_end
FROM (SELECT e.location_code, min(e.year) AS first_year, max(e.year) AS last_year,
             regr_slope(e.day_of_year, e.year) AS slope, regr_intercept(e.day_of_year, e.year) AS intercept
      FROM events e
      JOIN (SELECT location_code, max(year) AS newest FROM events
            WHERE event_type = 'sakura_bloom' GROUP BY location_code) AS n ON e.location_code = n.location_code
      WHERE e.event_type = 'sakura_bloom' AND e.year >= n.newest - 4
      GROUP BY e.location_code HAVING count(*) >= 2) AS fitted"""), doubles="slope trend_start trend_end")
def _(spark, sf):
    return serving.trend(a.events(spark, sf), n=5)


@query("trailing_years", with_("events", """
SELECT location_code, year, date_key, day_of_year FROM events
WHERE event_type = 'sakura_bloom' AND year >= 2002 - 5 + 1"""))
def _(spark, sf):
    history = serving.event_history(a.events(spark, sf)).select("location_code", "year", "date_key", "day_of_year")
    return serving.trailing_years(history, 2002, n=5)


def windows(spark, sf):
    return serving.visit_windows(
        a.baseline_forecast(spark, sf), marts.event_gap(a.events(spark, sf)), width=W
    )


@query("visit_windows", with_("windows", """
SELECT location_code, forecast_year, first_bloom, CAST(full_bloom AS DATE) AS full_bloom,
       CAST(peak_start AS DATE) AS peak_start, CAST(peak_end AS DATE) AS peak_end,
       CAST(visit_start AS DATE) AS visit_start, CAST(visit_end AS DATE) AS visit_end,
       CAST(petals_start AS DATE) AS petals_start, CAST(petals_end AS DATE) AS petals_end
FROM windows"""))
def _(spark, sf):
    return windows(spark, sf)


@query("visit_calendar", with_("windows", """
SELECT location_code, CAST(first_bloom + CAST(i AS INTEGER) AS DATE) AS day, CAST(i AS INTEGER) AS day_index,
       i / greatest(n - 1, 1) AS phase,
       first_bloom + CAST(i AS INTEGER) BETWEEN peak_start AND peak_end AS is_peak,
       first_bloom + CAST(i AS INTEGER) BETWEEN visit_start AND visit_end AS is_visit,
       first_bloom + CAST(i AS INTEGER) = full_bloom AS is_full_bloom
FROM (SELECT *, (petals_end - first_bloom) + 2 AS n,
             unnest(range(0, (petals_end - first_bloom) + 2)) AS i FROM windows) AS days"""), doubles="phase")
def _(spark, sf):
    return reshape.calendar_spine(windows(spark, sf))


@query("date_labels", with_("windows", f"""
SELECT location_code, forecast_year, {day_label('first_bloom')} AS first_bloom_label,
       day(full_bloom) || strftime(full_bloom, ' %b') AS full_bloom_label,
       strftime(visit_start, '%d %b') || ' – ' || {day_label('visit_end')} AS visit_label
FROM windows"""))
def _(spark, sf):
    return serving.window_labels(windows(spark, sf))


@query("bloom_anomaly_class", with_("forecast events", f"""
SELECT f.location_code, f.model_name, f.predicted_day_of_year, h.avg_day_of_year,
       CASE WHEN h.avg_day_of_year IS NULL THEN 'none'
            WHEN abs(f.predicted_day_of_year - h.avg_day_of_year) <= 1 THEN 'on par'
            WHEN f.predicted_day_of_year < h.avg_day_of_year THEN 'earlier' ELSE 'later' END AS anomaly
FROM forecast f LEFT JOIN ({RECENT.format(n=5)}) AS h ON {pad('h.location_code')} = f.location_code"""))
def _(spark, sf):
    average = serving.historical_avg(a.events(spark, sf), n=5).withColumn(
        "location_code", pad_location(F.col("location_code"), W)
    )
    joined = a.baseline_forecast(spark, sf).join(average, on="location_code", how="left")
    return joined.select(
        "location_code", "model_name", "predicted_day_of_year", "avg_day_of_year",
        labels.anomaly_class(F.col("predicted_day_of_year"), F.col("avg_day_of_year")).alias("anomaly"),
    )


@query("reliability_class", with_("forecast", """
SELECT location_code, model_name,
       CASE WHEN station_mae_days IS NULL AND mae_days IS NULL THEN 'none'
            WHEN coalesce(station_mae_days, mae_days) > 20 THEN 'low'
            ELSE '±' || CAST(round_even(coalesce(station_mae_days, mae_days), 0) AS INTEGER) || ' d'
       END AS reliability
FROM forecast"""))
def _(spark, sf):
    return a.baseline_forecast(spark, sf).select(
        "location_code", "model_name",
        labels.reliability_class(F.col("station_mae_days"), F.col("mae_days")).alias("reliability"),
    )


@query("label_lookup", with_("forecast", """
SELECT location_code, model_name,
       CASE model_name WHEN 'station_mean' THEN 'Station mean' ELSE model_name END AS model_label
FROM forecast"""))
def _(spark, sf):
    return a.baseline_forecast(spark, sf).select(
        "location_code", "model_name",
        labels.label_lookup(F.col("model_name"), {"station_mean": "Station mean"}).alias("model_label"),
    )


@query("spots_lookup", """
SELECT n.n_nationkey, n.n_name AS station_name, s.s_name AS spot, r.r_name AS district
FROM nation n JOIN supplier s ON s.s_nationkey = n.n_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey""")
def _(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    spots = (
        table(spark, sf, "supplier")
        .join(nation, on=F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, on=F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.lower("n_name").alias("station_name"), F.col("s_name").alias("spot"), F.col("r_name").alias("district"))
    )
    stations = nation.select("n_nationkey", F.col("n_name").alias("station_name"))
    return serving.visit_spots(stations, spots)
