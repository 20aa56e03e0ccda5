"""Data-quality and sink queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from bloomline.config import FIRST_BLOOM, PLAUSIBLE_DOY
from bloomline.functions.dates import timestamp
from bloomline.operators import distinct, marts, quality
from bloomline.plans import adapters as a, jobs
from bloomline.plans.adapters import table
from bloomline.plans.registry import query
from bloomline.plans.sql import FORECAST_DOUBLES, two_digits, with_
from bloomline.schemas import FORECAST, FORECAST_KEY
from bloomline.session import materialize, scratch_path
from bloomline.sources import contracts, html, sinks


def stored(table_of, spark, sf):
    """A table several checks read, written first."""
    return materialize(table_of(spark, sf), table_of.__name__)


@query("dq_row_counts", with_("stg_climate stg_events dim_station dim_date forecast", """
SELECT 'climate' AS table_name, count(*) AS row_count FROM stg_climate
UNION ALL SELECT 'events', count(*) FROM stg_events
UNION ALL SELECT 'stations', count(*) FROM dim_station
UNION ALL SELECT 'dates', count(*) FROM dim_date
UNION ALL SELECT 'forecast', count(*) FROM forecast"""))
def _(spark, sf):
    climate, staged = stored(a.staged_climate, spark, sf), stored(a.staged_events, spark, sf)
    return quality.row_counts({
        "climate": climate,
        "events": staged,
        "stations": marts.dim_station(climate, a.metadata(spark, sf), a.STATION_BASE),
        "dates": marts.dim_date(staged),
        "forecast": a.baseline_forecast(spark, sf),
    })


@query("topk_values", with_("stg_events", """
SELECT event_date_raw, count(*) AS records FROM stg_events
GROUP BY event_date_raw ORDER BY records DESC, event_date_raw LIMIT 30"""))
def _(spark, sf):
    counted = quality.distribution(a.staged_events(spark, sf), ["event_date_raw"])
    return quality.top(counted, 30, F.desc("records"), "event_date_raw")


@query("dq_preview", with_("dim_station", """
SELECT * FROM dim_station ORDER BY station_code LIMIT 20"""), doubles="latitude longitude")
def _(spark, sf):
    return quality.top(a.dim_station(spark, sf), 20, "station_code")


@query("dq_range_distinct", with_("stg_events", """
SELECT min(year) AS min_year, max(year) AS max_year, count(DISTINCT year) AS distinct_year,
       count(DISTINCT location_name) AS distinct_location_name
FROM stg_events"""))
def _(spark, sf):
    return quality.range_distinct(a.staged_events(spark, sf), "year", ["year", "location_name"])


@query("dq_distinct_bitmaps", with_("stg_events", """
SELECT min(year) AS min_year, max(year) AS max_year, count(DISTINCT year) AS distinct_year,
       count(DISTINCT location_name) AS distinct_location_name
FROM stg_events"""))
def _(spark, sf):
    """The same from two loads, one for each event type: their bitmaps merge, the second load only adds new names."""
    staged = stored(a.staged_events, spark, sf)
    loads = [staged.where(F.col("event_type") == FIRST_BLOOM), staged.where(F.col("event_type") != FIRST_BLOOM)]
    names, maps = None, []
    for rows in loads:
        names = distinct.extend_dictionary(names, rows, "location_name")
        size = names.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
        numbered = rows.join(names, rows["location_name"] == names["value"], "left")
        maps.append(distinct.bitmaps(numbered, {"year": F.col("year").cast("long"), "location_name": F.col("number")},
                                     {"year": 10_000, "location_name": size}))
    counts = distinct.distinct_counts(distinct.merge_bitmaps(maps), ["year", "location_name"])
    # A single row each.
    return quality.measure_range(staged, ["year"]).join(F.broadcast(counts))


@query("dq_date_coverage", with_("fact_climate", """
SELECT min(date_key) AS min_date_key, max(date_key) AS max_date_key FROM fact_climate"""))
def _(spark, sf):
    return quality.measure_range(marts.fact_climate(a.staged_climate(spark, sf)), ["date_key"])


@query("dq_measure_range", with_("climate", """
SELECT min(mean_temp_c) AS min_mean_temp_c, max(mean_temp_c) AS max_mean_temp_c,
       min(precipitation_mm) AS min_precipitation_mm, max(precipitation_mm) AS max_precipitation_mm
FROM climate"""), doubles="min_mean_temp_c max_mean_temp_c min_precipitation_mm max_precipitation_mm")
def _(spark, sf):
    return quality.measure_range(a.climate(spark, sf), ["mean_temp_c", "precipitation_mm"])


NULL_COLS = ["mean_temp_c", "precipitation_mm"]


@query("dq_null_counts", with_("climate", "SELECT count(*) AS total_rows, " + ", ".join(
    f"count({c}) AS non_null_{c}, count(*) - count({c}) AS null_{c}" for c in NULL_COLS) + " FROM climate"))
def _(spark, sf):
    return quality.null_counts(a.climate(spark, sf), NULL_COLS)


@query("dq_null_rows", with_("stg_events", """
SELECT event_date, count(*) AS records FROM stg_events WHERE event_date IS NULL GROUP BY event_date"""))
def _(spark, sf):
    return quality.null_rows(a.staged_events(spark, sf), "event_date")


@query("dq_duplicate_keys", with_("stg_events", """
SELECT location_code, year, event_type, count(*) AS records FROM stg_events
GROUP BY location_code, year, event_type HAVING count(*) > 1"""))
def _(spark, sf):
    return quality.duplicate_keys(a.staged_events(spark, sf), ["location_code", "year", "event_type"])


@query("dq_orphans", with_("fact_events dim_date dim_location", """
SELECT 'date_key' AS key, count(*) AS unmatched
FROM fact_events f LEFT JOIN dim_date d ON f.date_key = d.date_key WHERE d.date_key IS NULL
UNION ALL
SELECT 'location_code', count(*)
FROM fact_events f LEFT JOIN dim_location d ON f.location_code = d.location_code
WHERE d.location_code IS NULL"""))
def _(spark, sf):
    staged = stored(a.staged_events, spark, sf)
    fact = marts.fact_events(staged)
    dims = {"date_key": marts.dim_date(staged), "location_code": marts.dim_location(staged)}
    return quality.union_all([
        quality.orphans(fact, dim, key).select(F.lit(key).alias("key"), "unmatched")
        for key, dim in dims.items()
    ])


@query("dq_reconcile", with_("fact_events stg_events", """
SELECT fact_rows, staging_rows_with_date, fact_rows - staging_rows_with_date AS difference
FROM (SELECT (SELECT count(*) FROM fact_events) AS fact_rows,
             (SELECT count(*) FROM stg_events WHERE event_date IS NOT NULL) AS staging_rows_with_date) AS c"""))
def _(spark, sf):
    staged = stored(a.staged_events, spark, sf)
    return quality.reconcile(
        marts.fact_events(staged), staged.where(F.col("event_date").isNotNull()),
        ("fact_rows", "staging_rows_with_date"),
    )


@query("dq_distribution", with_("stg_events", """
SELECT source_name, data_status, event_type, year, count(*) AS records
FROM stg_events GROUP BY source_name, data_status, event_type, year"""))
def _(spark, sf):
    return quality.distribution(
        a.staged_events(spark, sf), ["source_name", "data_status", "event_type", "year"]
    ).orderBy("year", F.desc("records"))


def by_dimension(dim: str) -> str:
    return with_(f"climate {dim}", f"""
SELECT d.season, count(*) AS records, {two_digits('avg(c.mean_temp_c)')} AS avg_mean_temp_c
FROM climate c LEFT JOIN {dim} d ON c.date_key = d.date_key GROUP BY d.season""")


@query("dq_group_by_dim", by_dimension("dim_month"), doubles="avg_mean_temp_c")
def _(spark, sf):
    months = marts.dim_month(a.staged_climate(spark, sf))
    return quality.group_by_dim(a.climate(spark, sf), months, "date_key", "season", "mean_temp_c")


@query("dq_group_by_event_dates", by_dimension("dim_date"), doubles="avg_mean_temp_c")
def _(spark, sf):
    days = marts.dim_date(a.staged_events(spark, sf))
    return quality.group_by_dim(a.climate(spark, sf), days, "date_key", "season", "mean_temp_c")


@query("dq_group_by_station", with_("climate dim_station", """
SELECT s.station_name, count(*) AS records
FROM climate c LEFT JOIN dim_station s ON c.station_code = s.station_code GROUP BY s.station_name"""))
def _(spark, sf):
    return quality.group_by_dim(
        a.climate(spark, sf), a.dim_station(spark, sf), "station_code", "station_name"
    )


@query("dq_out_of_range", with_("forecast", """
SELECT location_code, forecast_year, model_name, predicted_day_of_year, predicted_event_date, is_best_model
FROM forecast WHERE predicted_day_of_year < 30 OR predicted_day_of_year > 160"""))
def _(spark, sf):
    return quality.out_of_range(
        a.baseline_forecast(spark, sf), "predicted_day_of_year", *PLAUSIBLE_DOY
    ).select(
        "location_code", "forecast_year", "model_name", "predicted_day_of_year",
        "predicted_event_date", "is_best_model",
    )


@query("dq_report", with_("stg_events dim_date forecast", """
SELECT 1 AS position, 'forecast rows' AS check_name, 'row_count' AS metric,
       CAST(count(*) AS DOUBLE) AS value, count(*) > 0 AS passed FROM forecast
UNION ALL
SELECT 2, 'forecast key is unique', 'rows', CAST(count(*) AS DOUBLE), count(*) = 0
FROM (SELECT 1 FROM forecast GROUP BY location_code, forecast_year, event_type, model_version, model_name
      HAVING count(*) > 1) AS d
UNION ALL
SELECT 3, 'event key is unique', 'rows', CAST(count(*) AS DOUBLE), count(*) = 0
FROM (SELECT 1 FROM stg_events GROUP BY location_code, year, event_type HAVING count(*) > 1) AS d
UNION ALL
SELECT 4, 'event dates are known', 'unmatched', CAST(count(*) AS DOUBLE), count(*) = 0
FROM stg_events e LEFT JOIN dim_date d ON e.event_date = d.date_key WHERE d.date_key IS NULL
UNION ALL
SELECT 5, 'event nulls', 'null_event_date', CAST(count(*) - count(event_date) AS DOUBLE), NULL FROM stg_events
UNION ALL
SELECT 6, 'implausible forecast days', 'rows', CAST(count(*) AS DOUBLE), count(*) = 0
FROM forecast WHERE predicted_day_of_year < 30 OR predicted_day_of_year > 160"""), doubles="value")
def _(spark, sf):
    staged, fact = stored(a.staged_events, spark, sf), stored(a.baseline_forecast, spark, sf)
    zero = lambda v: v == 0
    return quality.run_checks([
        quality.Check("forecast rows", fact.agg(F.count("*").alias("row_count")), lambda v: v > 0),
        quality.count_check("forecast key is unique", quality.duplicate_keys(fact, list(FORECAST_KEY))),
        quality.count_check("event key is unique",
                            quality.duplicate_keys(staged, ["location_code", "year", "event_type"])),
        quality.Check("event dates are known",
                      quality.orphans(marts.fact_events(staged), marts.dim_date(staged), "date_key"), zero),
        quality.Check("event nulls", quality.null_counts(staged, ["event_date"]).select("null_event_date")),
        quality.count_check("implausible forecast days",
                            quality.out_of_range(fact, "predicted_day_of_year", *PLAUSIBLE_DOY)),
    ])


@query("dq_load_summary", with_("metadata", """
SELECT count(*) AS rows_prepared, count(*) - count(latitude) AS missing_latitude,
       count(*) - count(longitude) AS missing_longitude,
       (SELECT count(*) FROM supplier WHERE s_acctbal > 9000) AS failed_items
FROM metadata"""))
def _(spark, sf):
    captions = a.caption_pages(spark, sf)
    located = html.caption_coordinates(captions)
    failed = captions.where(~F.col("html").contains("<caption"))
    return quality.load_summary(located, failed, ["latitude", "longitude"])


# --- Sinks

HALF_R, HALF_A = ("R", "N"), ("A",)


def flagged(spark, sf, flags):
    """Shipments per supplier of some return flags."""
    return (
        table(spark, sf, "lineitem").where(F.col("l_returnflag").isin(list(flags)))
        .groupBy("l_suppkey", "l_returnflag").agg(F.count("*").alias("n"))
    )


@query("sink_append_roundtrip", """
SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY l_suppkey, l_returnflag""")
def _(spark, sf):
    path = scratch_path(spark, "append")
    for flags in (HALF_R, HALF_A):
        sinks.append(flagged(spark, sf, flags), path)
    return spark.read.parquet(path)


@query("sink_overwrite_roundtrip", """
SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY l_suppkey, l_returnflag""")
def _(spark, sf):
    path = scratch_path(spark, "overwrite")
    for flags in (HALF_R, HALF_R + HALF_A):
        sinks.overwrite(flagged(spark, sf, flags), path)
    return spark.read.parquet(path)


PARTITION_SQL = with_("raw_events", """
SELECT location_code, year, event_type, data_status, source_name, 'second' AS load
FROM raw_events WHERE data_status = 'observed' AND event_type = 'sakura_bloom'
UNION ALL
SELECT location_code, year, event_type, data_status, source_name, 'first' AS load
FROM raw_events WHERE data_status = 'observed' AND event_type <> 'sakura_bloom'""")


@query("partition_replace", PARTITION_SQL)
def _(spark, sf):
    path, keys = scratch_path(spark, "partitions"), ["source_name", "event_type", "data_status"]
    raw = a.raw_events(spark, sf).select(F.col("station_code_raw").alias("location_code"), "year", *keys)
    sinks.replace_partitions(raw.withColumn("load", F.lit("first")), path, keys)
    again = raw.where((F.col("data_status") == "observed") & (F.col("event_type") == "sakura_bloom"))
    sinks.replace_partitions(again.withColumn("load", F.lit("second")), path, keys)
    # A reload of the unreadable rows that finds none clears them.
    none = raw.limit(0).withColumn("load", F.lit("third"))
    sinks.replace_partitions(none, path, keys, [("shipments", "sakura_fullbloom", "estimated")])
    return spark.read.parquet(path)


@query("versioned_partition_replace", PARTITION_SQL)
def _(spark, sf):
    """The same three loads as versions of parts; the reload and the cleared part switch with one commit."""
    wh, keys = jobs.Warehouse(spark, scratch_path(spark, "parts")), ["source_name", "event_type", "data_status"]
    raw = a.raw_events(spark, sf).select(F.col("station_code_raw").alias("location_code"), "year", *keys)
    wh.commit(wh.stage_parts("raw/events", raw.withColumn("load", F.lit("first")), keys))
    again = raw.where((F.col("data_status") == "observed") & (F.col("event_type") == "sakura_bloom"))
    wh.commit(wh.stage_parts("raw/events", again.withColumn("load", F.lit("second")), keys, [("shipments", "sakura_fullbloom", "estimated")]))
    return wh.read("raw/events")


@query("forecast_upsert", with_("forecast", """
SELECT location_code, forecast_year, event_type, model_name, model_version, source_name FROM forecast
UNION ALL
SELECT location_code, forecast_year, event_type, model_name, 'v2', source_name FROM forecast
UNION ALL
SELECT location_code, 2001, event_type, model_name, model_version, source_name FROM forecast"""))
def _(spark, sf):
    path = scratch_path(spark, "forecast")
    fact = stored(a.baseline_forecast, spark, sf)
    old = quality.union_all([
        fact.withColumn("source_name", F.lit("stale")),
        fact.withColumn("model_version", F.lit("v2")),
        fact.withColumn("forecast_year", F.lit(2001)),
    ])
    sinks.write_forecast(spark, old, path)
    for _ in range(2):
        sinks.write_forecast(spark, fact, path)
    return spark.read.parquet(path).select(
        "location_code", "forecast_year", "event_type", "model_name", "model_version", "source_name"
    )


@query("schema_conform", with_("events", """
SELECT location_code, year AS forecast_year, event_type, day_of_year AS predicted_day_of_year,
       date_key AS predicted_event_date, 'observed' AS model_name, 'v0' AS model_version,
       FALSE AS is_best_model, '2001-11-04 00:00:00' AS trained_at,
       CAST(NULL AS INTEGER) AS training_row_count, CAST(NULL AS DOUBLE) AS rmse_days,
       CAST(NULL AS DOUBLE) AS mae_days, CAST(NULL AS DOUBLE) AS station_mae_days,
       CAST(NULL AS DOUBLE) AS r2_score, 'predicted' AS prediction_status, source_name
FROM events"""), doubles=FORECAST_DOUBLES)
def _(spark, sf):
    e = a.events(spark, sf).select(
        "location_code", F.col("year").cast("string").alias("forecast_year"), "event_type",
        F.col("day_of_year").alias("predicted_day_of_year"), F.col("date_key").alias("predicted_event_date"),
        F.lit("observed").alias("model_name"), F.lit("v0").alias("model_version"),
        timestamp(a.RUN_TIME).alias("trained_at"), F.lit("predicted").alias("prediction_status"), "source_name",
    )
    # Verification reads the rows twice.
    return contracts.verify(materialize(contracts.conform(e, FORECAST), "conformed"), FORECAST)
