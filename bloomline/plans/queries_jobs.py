"""Whole-run queries: landed files to the forecast map and the check report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from bloomline.config import PRECIP_VIEW
from bloomline.operators import serving
from bloomline.plans import adapters as a, jobs
from bloomline.plans.registry import query
from bloomline.plans.sql import day_label, pad, with_
from bloomline.session import scratch_path


def landing(spark: SparkSession, sf: str) -> jobs.Landing:
    """Stored pages and files, as the fetchers would leave them."""
    store = jobs.Warehouse(spark, scratch_path(spark, "landing"))
    return jobs.Landing(
        store.rebuild("climate_pages", a.climate_pages(spark, sf)),
        store.rebuild("caption_pages", a.caption_pages(spark, sf)),
        {kind: a.land_wide_csv(spark, sf, store.path(flag), flag) for kind, flag in jobs.EVENT_FLAGS.items()},
    )


def warehouse(spark: SparkSession, name: str) -> jobs.Warehouse:
    return jobs.Warehouse(spark, scratch_path(spark, name), a.STATION_BASE, a.WIDTH)


#: Months of the season before the bloom of 2002.
SEASON = "(2001, 9), (2001, 10), (2001, 11), (2001, 12), (2002, 1), (2002, 2), (2002, 3)"


@query("monthly_run", with_("forecast dim_station windows fact_climate", f"""
, seen AS (
  SELECT right(station_code, {a.WIDTH}) AS location_code, count(mean_temp_c) AS months FROM fact_climate
  JOIN (VALUES {SEASON}) AS season(y, m) ON year(date_key) = y AND month(date_key) = m GROUP BY 1)
SELECT s.station_code, s.station_name, s.latitude, s.longitude, f.forecast_year, f.predicted_day_of_year, f.predicted_event_date,
       f.model_name, f.mae_days, f.rmse_days, f.station_mae_days, {day_label('f.predicted_event_date')} AS bloom_label,
       right(s.station_code, {a.WIDTH}) AS location_code, w.first_bloom, CAST(w.full_bloom AS DATE) AS full_bloom,
       CAST(w.peak_start AS DATE) AS peak_start, CAST(w.peak_end AS DATE) AS peak_end,
       CAST(w.visit_start AS DATE) AS visit_start, CAST(w.visit_end AS DATE) AS visit_end,
       CAST(w.petals_start AS DATE) AS petals_start, CAST(w.petals_end AS DATE) AS petals_end,
       coalesce(n.months, 0) < 7 AS using_climate_normals
FROM forecast f JOIN dim_station s ON f.location_code = {pad('s.location_code')}
LEFT JOIN windows w ON w.location_code = right(s.station_code, {a.WIDTH}) AND w.forecast_year = f.forecast_year
LEFT JOIN seen n ON n.location_code = right(s.station_code, {a.WIDTH})
WHERE f.is_best_model AND s.latitude IS NOT NULL AND s.longitude IS NOT NULL"""),
       doubles="latitude longitude mae_days rmse_days station_mae_days")
def monthly_run(spark: SparkSession, sf: str) -> DataFrame:
    """Staging to marts and features, baseline forecast from the event fact, map rows with their visit windows."""
    wh = warehouse(spark, "monthly-run")
    wh.rebuild("staging/climate", a.staged_climate(spark, sf))
    wh.rebuild("staging/events", a.staged_events(spark, sf))
    wh.rebuild("staging/metadata", a.metadata(spark, sf))
    jobs.run_marts(wh, a.AUTUMN_RUN)
    rows = wh.rebuild("marts/bloom_rows", a.split_rows(wh.read("marts/fact_events")))
    fact = wh.rebuild("marts/forecast", a.baseline_forecast_of(rows))
    windows = serving.visit_windows(fact, wh.read("marts/event_gap"), width=a.WIDTH)
    located = serving.forecast_map(fact, wh.read("marts/dim_station"), width=a.WIDTH)
    upcoming = wh.read("marts/prediction_features").select("location_code", "using_climate_normals")
    return (
        located.drop("location_code")
        .withColumn("location_code", F.right("station_code", F.lit(a.WIDTH)))
        .join(windows, on=["location_code", "forecast_year"], how="left")
        .join(upcoming, on="location_code", how="left")
    )


@query("monthly_checks")
def monthly_checks(spark: SparkSession, sf: str) -> DataFrame:
    """The complete run over landed pages and files with all candidates; its check report."""
    return jobs.run_all(
        warehouse(spark, "monthly-checks"), landing(spark, sf), a.AUTUMN_RUN, a.RUN_TIME, "shipments")


@query("raw_load_summary", """
SELECT 12 * years AS rows_prepared, 12 * years - months AS missing_mean_temp_c,
       12 * years - months AS missing_precipitation_mm, CAST(0 AS BIGINT) AS failed_items
FROM (SELECT count(DISTINCT (l_suppkey, year(l_shipdate))) AS years,
             count(DISTINCT (l_suppkey, year(l_shipdate), month(l_shipdate))) AS months FROM lineitem) AS n""")
def raw_load_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Parse the landed pages and files into raw tables; rows, gaps and failures."""
    return jobs.run_raw(warehouse(spark, "raw"), landing(spark, sf), a.RUN_TIME, "shipments")


BROKEN, UNLISTED = 7, 5


@query("station_failures", f"""
SELECT CAST({a.STATION_BASE} + l_suppkey AS VARCHAR) AS station_code,
       CASE WHEN l_suppkey % {BROKEN} = 0 THEN 0 ELSE 12 * count(DISTINCT year(l_shipdate)) END AS n_rows,
       CASE WHEN l_suppkey % {BROKEN} = 0 THEN 'expected at least 2 tables, got 0' END AS parse_error
FROM lineitem WHERE l_suppkey % {UNLISTED} <> 0 AND CAST({a.STATION_BASE} + l_suppkey AS VARCHAR) NOT IN ('{a.STATION_BASE + 1}')
GROUP BY l_suppkey""")
def station_failures(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each listed station; one whose precipitation page is broken fails as a whole."""
    number = F.col("station_code").cast("long") - a.STATION_BASE
    pages = a.climate_pages(spark, sf).withColumn(
        "html", F.when((number % BROKEN == 0) & (F.col("view") == PRECIP_VIEW), "<p>maintenance</p>").otherwise(F.col("html")))
    # A list page per nation; retired stations carry the marker in their name.
    option = F.format_string("<option value='%s'>Station %s%s</option>", F.col("station_code"), F.col("s_suppkey").cast("string"),
                             F.when(F.col("s_suppkey") == 1, " (OLD)").otherwise(""))
    listing = (
        a.table(spark, sf, "supplier").where(F.col("s_suppkey") % UNLISTED != 0)
        .withColumn("station_code", a.station_code(F.col("s_suppkey")))
        .groupBy("s_nationkey").agg(F.concat_ws("", F.lit("<select name=block_no>"), F.collect_list(option), F.lit("</select>")).alias("html"))
    )
    measures, failed = jobs.parse_climate(jobs.listed_stations(pages, listing.select("html")))
    loaded = measures.groupBy("station_code").agg(F.count("*").alias("n_rows")).withColumn("parse_error", F.lit(None).cast("string"))
    return loaded.unionByName(failed.select("station_code", F.lit(0).cast("long").alias("n_rows"), "parse_error"))
