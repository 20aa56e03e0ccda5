"""SQL of the logical tables, as CTEs for the queries' equivalents.

Written from the plain definition of each table, with joins where the DataFrame
form aggregates first, so that agreement shows the rewrite is right.
"""

from __future__ import annotations

from bloomline.config import MONTHS
from bloomline.plans.adapters import PAGE_URL, STATION_BASE as BASE, WIDTH

CODE = f"CAST({BASE} + l_suppkey AS VARCHAR)"


def season(month: str) -> str:
    return (f"CASE WHEN {month} IN (12, 1, 2) THEN 'Winter' WHEN {month} IN (3, 4, 5) THEN 'Spring' "
            f"WHEN {month} IN (6, 7, 8) THEN 'Summer' WHEN {month} IN (9, 10, 11) THEN 'Autumn' END")


def pad(code: str) -> str:
    return f"lpad({code}, {WIDTH}, '0')"


def two_digits(value: str) -> str:
    """Decimal rounding of a computed double, half away from zero."""
    return f"CAST(round(CAST({value} AS DECIMAL(30, 9)), 2) AS DOUBLE)"


def day_label(d: str) -> str:
    return f"strftime({d}, '%d %b %Y')"


CTES = {
    "climate": ((), f"""
  SELECT {CODE} AS station_code,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS date_key,
         avg(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS mean_temp_c,
         round(sum(CASE WHEN l_returnflag <> 'N' THEN l_extendedprice END), 2) AS precipitation_mm
  FROM lineitem GROUP BY 1, 2"""),
    "events": ((), """
  SELECT CAST(l_suppkey AS VARCHAR) AS location_code,
         CAST(year(l_shipdate) AS INTEGER) AS year,
         CASE l_returnflag WHEN 'R' THEN 'sakura_bloom' ELSE 'sakura_fullbloom' END AS event_type,
         CAST(min(l_shipdate) AS DATE) AS date_key,
         CAST(dayofyear(min(l_shipdate)) AS INTEGER) AS day_of_year,
         'observed' AS data_status, 'shipments' AS source_name
  FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_suppkey, 2, l_returnflag"""),
    "raw_climate": ((), f"""
  SELECT '{PAGE_URL}' || {CODE} || '&v=' || l_linestatus AS source_url,
         'Station ' || l_suppkey AS station_name, {CODE} AS station_code,
         CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
         avg(l_quantity) AS mean_temp_c, round(sum(l_extendedprice), 2) AS precipitation_mm,
         max(l_shipdate) AS raw_ingested_at
  FROM lineitem GROUP BY l_suppkey, l_linestatus, year(l_shipdate), month(l_shipdate)"""),
    "stg_climate": (("raw_climate",), """
  SELECT station_code, station_name, year, month,
         make_date(year, month, 1) AS month_start_date,
         mean_temp_c, precipitation_mm, source_url, raw_ingested_at
  FROM (SELECT *, row_number() OVER (
          PARTITION BY station_code, year, month
          ORDER BY raw_ingested_at DESC NULLS LAST, mean_temp_c DESC NULLS LAST,
                   precipitation_mm DESC NULLS LAST, source_url DESC) AS pick
        FROM raw_climate WHERE month BETWEEN 1 AND 12) AS ranked
  WHERE pick = 1"""),
    "raw_events": ((), f"""
  SELECT CAST(l_suppkey AS VARCHAR) AS location_code, 'Station ' || l_suppkey AS location_name,
         CAST(year(l_shipdate) AS INTEGER) AS year,
         CASE l_returnflag WHEN 'R' THEN 'sakura_bloom' ELSE 'sakura_fullbloom' END AS event_type,
         CASE WHEN l_returnflag = 'N' THEN strftime(min(l_shipdate), '%m/%d')
              ELSE ' ' || month(min(l_shipdate)) || strftime(min(l_shipdate), '-%d') END AS event_date_raw,
         CASE WHEN l_returnflag = 'N' THEN 'estimated' ELSE 'observed' END AS data_status,
         'shipments' AS source_name, '{PAGE_URL}' || l_suppkey AS source_url,
         CAST(count(*) AS VARCHAR) AS rm_raw
  FROM lineitem GROUP BY l_suppkey, year(l_shipdate), l_returnflag"""),
    "stg_events": (("raw_events",), r"""
  SELECT *, CAST(dayofyear(event_date) AS INTEGER) AS day_of_year
  FROM (SELECT *, CASE WHEN regexp_full_match(trim(event_date_raw), '\d{1,2}-\d{1,2}')
                       THEN CAST(strptime(year || '-' || trim(event_date_raw), '%Y-%m-%d') AS DATE)
                  END AS event_date FROM raw_events) AS dated"""),
    "metadata": ((), f"""
  SELECT CAST({BASE} + s_suppkey AS VARCHAR) AS station_code, s_name AS station_name,
         CASE WHEN s_acctbal <= 9000
              THEN round(20 + s_nationkey + (s_suppkey % 600) / 600.0, 6) END AS latitude,
         CASE WHEN s_acctbal <= 9000
              THEN round((CASE WHEN s_acctbal < 0 THEN -1 ELSE 1 END)
                         * (120 + s_nationkey + (599 - s_suppkey % 600) / 600.0), 6) END AS longitude,
         '{PAGE_URL}' || ({BASE} + s_suppkey) AS source_url
  FROM supplier"""),
    "dim_station": (("stg_climate", "metadata"), f"""
  SELECT c.station_code, CAST(CAST(c.station_code AS BIGINT) - {BASE} AS VARCHAR) AS location_code,
         c.station_name, m.latitude, m.longitude,
         min(c.month_start_date) AS first_observation, max(c.month_start_date) AS last_observation,
         count(*) AS record_count
  FROM stg_climate c LEFT JOIN metadata m ON c.station_code = m.station_code
  GROUP BY c.station_code, c.station_name, m.latitude, m.longitude"""),
    "dim_month": (("stg_climate",), f"""
  SELECT DISTINCT month_start_date AS date_key, year, month,
         CAST(quarter(month_start_date) AS INTEGER) AS quarter, {season('month')} AS season
  FROM stg_climate"""),
    "dim_date": (("stg_events",), f"""
  SELECT DISTINCT event_date AS date_key, CAST(year(event_date) AS INTEGER) AS year,
         CAST(month(event_date) AS INTEGER) AS month, CAST(day(event_date) AS INTEGER) AS day,
         CAST(dayofyear(event_date) AS INTEGER) AS day_of_year,
         CAST(quarter(event_date) AS INTEGER) AS quarter, {season('month(event_date)')} AS season
  FROM stg_events WHERE event_date IS NOT NULL"""),
    "dim_location": (("stg_events",), """
  SELECT location_code, location_name, min(year) AS first_year, max(year) AS last_year,
         count(*) AS record_count
  FROM stg_events GROUP BY location_code, location_name"""),
    "fact_climate": (("stg_climate",), """
  SELECT station_code, month_start_date AS date_key, mean_temp_c, precipitation_mm FROM stg_climate"""),
    "fact_events": (("stg_events",), """
  SELECT location_code, event_date AS date_key, year, event_type, day_of_year, data_status, source_name
  FROM stg_events"""),
    "normals": (("climate",), f"""
  SELECT right(station_code, {WIDTH}) AS location_code, CAST(month(date_key) AS INTEGER) AS month,
         avg(mean_temp_c) AS avg_temp, avg(precipitation_mm) AS avg_precip
  FROM climate WHERE year(date_key) BETWEEN 1991 AND 2020 GROUP BY 1, 2"""),
    "gap": (("events",), """
  SELECT a.location_code,
         CAST(round(avg(b.day_of_year - a.day_of_year)) AS INTEGER) AS avg_gap_days,
         count(*) AS obs_count
  FROM events a JOIN events b ON a.location_code = b.location_code AND a.year = b.year
  WHERE a.event_type = 'sakura_bloom' AND b.event_type = 'sakura_fullbloom'
    AND b.day_of_year - a.day_of_year BETWEEN 0 AND 30
  GROUP BY a.location_code"""),
    # Each event meets every month of its station; sums count once per event row.
    "season_rows": (("events", "climate", "normals"), f"""
  SELECT {pad('e.location_code')} AS location_code, e.year AS year, e.event_type,
         month(c.date_key) AS m, year(c.date_key) - e.year AS y,
         coalesce(c.mean_temp_c, n.avg_temp) AS t, coalesce(c.precipitation_mm, n.avg_precip) AS p
  FROM events e
  JOIN climate c ON right(c.station_code, {WIDTH}) = {pad('e.location_code')}
  LEFT JOIN normals n ON n.location_code = right(c.station_code, {WIDTH}) AND n.month = month(c.date_key)
  WHERE e.date_key IS NOT NULL AND e.day_of_year IS NOT NULL"""),
    "season_fan": (("season_rows",), """
  SELECT location_code, year, count(DISTINCT event_type) AS fan,
         avg(t) FILTER (WHERE y = -1 AND m IN (9, 10, 11)) AS last_autumn_mean_temp,
         avg(t) FILTER (WHERE (y = -1 AND m = 12) OR (y = 0 AND m IN (1, 2))) AS winter_mean_temp,
         avg(t) FILTER (WHERE y = 0 AND m = 1) AS january_mean_temp,
         avg(t) FILTER (WHERE y = 0 AND m = 2) AS february_mean_temp,
         avg(t) FILTER (WHERE y = 0 AND m = 3) AS march_mean_temp,
         sum(t) FILTER (WHERE y = 0 AND m IN (1, 2, 3)) AS january_march_cumulative_temp,
         sum(p) FILTER (WHERE (y = -1 AND m = 12) OR (y = 0 AND m IN (1, 2))) AS winter_precipitation_mm
  FROM season_rows GROUP BY location_code, year"""),
    "training_fan": (("events", "season_fan"), f"""
  SELECT f.location_code, e.year, e.event_type, e.date_key AS event_date, e.day_of_year,
         e.data_status, e.source_name, f.last_autumn_mean_temp, f.winter_mean_temp,
         f.january_mean_temp, f.february_mean_temp, f.march_mean_temp,
         f.january_march_cumulative_temp, f.winter_precipitation_mm, f.fan
  FROM events e JOIN season_fan f ON {pad('e.location_code')} = f.location_code AND e.year = f.year
  WHERE f.last_autumn_mean_temp IS NOT NULL AND f.winter_mean_temp IS NOT NULL
    AND f.january_mean_temp IS NOT NULL AND f.february_mean_temp IS NOT NULL
    AND f.march_mean_temp IS NOT NULL AND f.january_march_cumulative_temp IS NOT NULL"""),
    "training": (("training_fan",), """
  SELECT * EXCLUDE (fan) REPLACE (
         january_march_cumulative_temp / fan AS january_march_cumulative_temp,
         winter_precipitation_mm / fan AS winter_precipitation_mm)
  FROM training_fan"""),
    # Held-out scores and forecasts of the station-average baselines.
    "bloom_rows": (("events",), f"""
  SELECT location_code, year, event_type, day_of_year,
         CASE WHEN CAST('0x' || substr(md5(k), 1, 8) AS BIGINT) % 100 < 20
              THEN 'test' ELSE 'train' END AS split,
         CAST(CAST('0x' || substr(md5(k), 9, 8) AS BIGINT) % 5 AS INTEGER) AS fold
  FROM (SELECT {pad('location_code')} AS location_code, year, event_type, day_of_year,
               {pad('location_code')} || '|' || year || '|' || event_type AS k
        FROM events WHERE event_type = 'sakura_bloom') AS keyed"""),
    "scores": (("bloom_rows",), """
  SELECT r.location_code, r.year, r.fold, r.day_of_year, f.model_name, f.prediction
  FROM bloom_rows r
  JOIN (SELECT location_code, 'station_mean' AS model_name, avg(day_of_year) AS prediction
        FROM bloom_rows WHERE split = 'train' GROUP BY location_code
        UNION ALL
        SELECT location_code, 'station_earliest', min(day_of_year)
        FROM bloom_rows WHERE split = 'train' GROUP BY location_code
        UNION ALL
        SELECT location_code, 'station_latest', max(day_of_year)
        FROM bloom_rows WHERE split = 'train' GROUP BY location_code) AS f
    ON r.location_code = f.location_code
  WHERE r.split = 'test'"""),
    "model_metrics": (("scores",), """
  SELECT s.model_name, avg(abs(prediction - day_of_year)) AS mae_days,
         sqrt(avg((prediction - day_of_year) * (prediction - day_of_year))) AS rmse_days,
         1 - avg((prediction - day_of_year) * (prediction - day_of_year)) / var_pop(day_of_year) AS r2_score,
         count(*) AS evaluation_row_count, any_value(c.cv_mae_days) AS cv_mae_days
  FROM scores s
  JOIN (SELECT model_name, avg(fold_mae) AS cv_mae_days
        FROM (SELECT model_name, fold, avg(abs(prediction - day_of_year)) AS fold_mae
              FROM scores GROUP BY model_name, fold) AS folds
        GROUP BY model_name) AS c ON s.model_name = c.model_name
  GROUP BY s.model_name"""),
    "ranked_models": (("model_metrics",), """
  SELECT *, row_number() OVER (ORDER BY cv_mae_days, model_name) = 1 AS is_best_model
  FROM model_metrics"""),
    "station_mae": (("scores", "ranked_models"), """
  SELECT s.location_code, avg(abs(s.prediction - s.day_of_year)) AS station_mae
  FROM scores s JOIN ranked_models m ON s.model_name = m.model_name AND m.is_best_model
  GROUP BY s.location_code HAVING count(*) >= 2"""),
    "refit": (("bloom_rows",), """
  SELECT location_code, 'station_mean' AS model_name, avg(day_of_year) AS prediction
  FROM bloom_rows GROUP BY location_code
  UNION ALL SELECT location_code, 'station_earliest', min(day_of_year) FROM bloom_rows GROUP BY location_code
  UNION ALL SELECT location_code, 'station_latest', max(day_of_year) FROM bloom_rows GROUP BY location_code"""),
    "forecast": (("refit", "ranked_models", "station_mae", "bloom_rows"), """
  SELECT location_code, forecast_year, event_type, predicted_day_of_year,
         CAST(make_date(forecast_year, 1, 1) + CAST(predicted_day_of_year - 1 AS INTEGER) AS DATE)
           AS predicted_event_date,
         model_name, model_version, is_best_model, trained_at, training_row_count, rmse_days,
         mae_days, station_mae_days, r2_score, prediction_status, source_name
  FROM (SELECT r.location_code, 2002 AS forecast_year, 'sakura_bloom' AS event_type,
               CAST(least(greatest(round_even(r.prediction, 0), 1), 366) AS INTEGER) AS predicted_day_of_year,
               r.model_name, 'v3' AS model_version, m.is_best_model,
               '2001-11-04 00:00:00' AS trained_at,
               CAST((SELECT count(*) FROM bloom_rows) AS INTEGER) AS training_row_count,
               m.rmse_days, m.mae_days,
               CASE WHEN m.is_best_model THEN coalesce(s.station_mae, m.mae_days)
                    ELSE m.mae_days END AS station_mae_days,
               m.r2_score, 'estimated' AS prediction_status, 'model_' || r.model_name AS source_name
        FROM refit r JOIN ranked_models m ON r.model_name = m.model_name
        LEFT JOIN station_mae s ON r.location_code = s.location_code) AS rows_of_models"""),
    "windows": (("forecast", "gap"), f"""
  SELECT location_code, forecast_year, first_bloom, full_bloom,
         full_bloom - 1 AS peak_start, full_bloom + 1 AS peak_end,
         full_bloom - 3 AS visit_start, full_bloom + 5 AS visit_end,
         full_bloom + 3 AS petals_start, full_bloom + 10 AS petals_end
  FROM (SELECT f.location_code, f.forecast_year, f.predicted_event_date AS first_bloom,
               f.predicted_event_date + coalesce(g.avg_gap_days, 8) AS full_bloom
        FROM forecast f LEFT JOIN gap g ON {pad('g.location_code')} = f.location_code
        WHERE f.is_best_model) AS w"""),
    "wide_values": ((), """
  SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
         sum(l_quantity) + 0.5 AS mean_temp_c, CAST(count(*) AS DOUBLE) AS precipitation_mm
  FROM lineitem GROUP BY 1, 2, 3"""),
}
FORECAST_DOUBLES = "rmse_days mae_days station_mae_days r2_score"
FEATURE_DOUBLES = (
    "last_autumn_mean_temp winter_mean_temp january_mean_temp february_mean_temp march_mean_temp "
    "january_march_cumulative_temp winter_precipitation_mm"
)


def with_(names: str, body: str) -> str:
    """``body`` under the named CTEs and everything they need."""
    order: list[str] = []

    def need(name: str) -> None:
        for dependency in CTES[name][0]:
            need(dependency)
        if name not in order:
            order.append(name)

    for name in names.split():
        need(name)
    ctes = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order)
    return f"WITH {ctes}\n{body}"


def prediction_sql(year: int) -> str:
    """Seven season months of every location, filled from the normals."""
    return with_("events climate normals", f"""
SELECT location_code, {year} AS year, 'sakura_bloom' AS event_type,
       avg(t) FILTER (WHERE m IN (9, 10, 11)) AS last_autumn_mean_temp,
       avg(t) FILTER (WHERE m IN (12, 1, 2)) AS winter_mean_temp,
       avg(t) FILTER (WHERE m = 1) AS january_mean_temp,
       avg(t) FILTER (WHERE m = 2) AS february_mean_temp,
       avg(t) FILTER (WHERE m = 3) AS march_mean_temp,
       sum(t) FILTER (WHERE m IN (1, 2, 3)) AS january_march_cumulative_temp,
       sum(p) FILTER (WHERE m IN (12, 1, 2)) AS winter_precipitation_mm,
       bool_or(estimated) AS using_climate_normals
FROM (SELECT l.location_code, g.m, coalesce(c.mean_temp_c, n.avg_temp) AS t,
             coalesce(c.precipitation_mm, n.avg_precip) AS p, c.mean_temp_c IS NULL AS estimated
      FROM (SELECT DISTINCT {pad('location_code')} AS location_code
            FROM events WHERE event_type = 'sakura_bloom') AS l
      CROSS JOIN (VALUES (9, {year - 1}), (10, {year - 1}), (11, {year - 1}), (12, {year - 1}),
                         (1, {year}), (2, {year}), (3, {year})) AS g(m, y)
      LEFT JOIN climate c ON right(c.station_code, {WIDTH}) = l.location_code
                         AND year(c.date_key) = g.y AND month(c.date_key) = g.m
      LEFT JOIN normals n ON n.location_code = l.location_code AND n.month = g.m) AS filled
GROUP BY location_code""")


#: Without the sum of three others, which adds nothing to a prediction.
INDEPENDENT = [f for f in FEATURE_DOUBLES.split() if f != "january_march_cumulative_temp"]


def with_lines(body: str, folds: int = 5, as_of_year: int = 2002) -> str:
    """``body`` over ``lines``: least-squares predictions of every row by model k, by orthogonalising one feature after the other.

    Models 0 to 4 leave a fold out, 5 has all training rows, 6 all rows; rows of
    the coming season have split 'upcoming'.
    """
    values = ", ".join(f"CAST({f} AS DOUBLE) AS x{i}" for i, f in enumerate(INDEPENDENT))
    n = len(INDEPENDENT)
    mean = lambda c: f"avg({c}) FILTER (WHERE fitted) OVER (PARTITION BY k)"
    slope = lambda y, x: f"coalesce(sum({x} * {y}) FILTER (WHERE fitted) OVER (PARTITION BY k) / nullif(sum({x} * {x}) FILTER (WHERE fitted) OVER (PARTITION BY k), 0), 0)"
    kept = "location_code, year, split, fold, k, fitted, y"
    steps = [f"line0 AS (SELECT {kept}, {', '.join(f'x{i} - {mean(f'x{i}')} AS x{i}' for i in range(n))}, "
             f"y - {mean('y')} AS rest, {mean('y')} AS prediction FROM fits)"]
    for i in range(n):
        others = "".join(f", x{j} - x{i} * {slope(f'x{j}', f'x{i}')} AS x{j}" for j in range(i + 1, n))
        part = f"x{i} * {slope('rest', f'x{i}')}"
        steps.append(f"line{i + 1} AS (SELECT {kept}{others}, rest - {part} AS rest, prediction + {part} AS prediction FROM line{i})")
    return with_("training", f"""
, keyed AS (SELECT *, location_code || '|' || year || '|' || event_type AS key FROM training WHERE event_type = 'sakura_bloom'),
given AS (
  SELECT location_code, year, CASE WHEN CAST('0x' || substr(md5(key), 1, 8) AS BIGINT) % 100 < 20 THEN 'test' ELSE 'train' END AS split,
         CAST(CAST('0x' || substr(md5(key), 9, 8) AS BIGINT) % {folds} AS INTEGER) AS fold, CAST(day_of_year AS DOUBLE) AS y, {values}
  FROM keyed
  UNION ALL SELECT location_code, year, 'upcoming', NULL, NULL, {values} FROM ({prediction_sql(as_of_year)}) AS p),
fits AS (
  SELECT given.*, k, CASE WHEN split = 'upcoming' THEN FALSE WHEN k < {folds} THEN split = 'train' AND fold <> k
                          WHEN k = {folds} THEN split = 'train' ELSE TRUE END AS fitted
  FROM given CROSS JOIN range({folds + 2}) AS m(k)),
{(',' + chr(10)).join(steps)},
lines AS (SELECT {kept}, prediction FROM line{n})
{body}""")


def wide_event_rows(flag: str) -> str:
    """Long form of the wide event table: first shipment of each supplier and year."""
    return f"""
SELECT CAST(l_suppkey AS VARCHAR) AS station_code_raw, 'Station ' || l_suppkey AS location_name_raw,
       CAST(year(l_shipdate) AS INTEGER) AS year,
       strftime(min(l_shipdate), '%m-%d') AS event_date_raw, CAST(count(*) AS VARCHAR) AS rm_raw
FROM lineitem WHERE l_returnflag = '{flag}'
GROUP BY l_suppkey, year(l_shipdate)"""
