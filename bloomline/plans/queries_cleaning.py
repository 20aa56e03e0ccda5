"""Cleaning, scalar, reshape and source queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from bloomline.config import MONTHS, PRECIP_VIEW, TEMP_VIEW
from bloomline.functions import codes, dates, labels, text
from bloomline.operators import quality, reshape, staging
from bloomline.plans import adapters as a, jobs
from bloomline.plans.adapters import table
from bloomline.plans.registry import query
from bloomline.plans.sql import wide_event_rows, with_
from bloomline.sources import html, wide_csv
from bloomline.session import scratch_path


@query("clean_text", r"""
SELECT o_orderkey,
       CASE o_orderstatus WHEN 'F' THEN trim(o_orderpriority) END AS cleaned
FROM orders""")
def _(spark, sf):
    raw = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" 　"), "o_orderpriority", F.lit(" ")))
        .when(F.col("o_orderstatus") == "O", " - ")
        .otherwise("－")
    )
    return table(spark, sf, "orders").select("o_orderkey", text.clean_text(raw).alias("cleaned"))


@query("normalize_mmdd", r"""
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%m/%d')
            ELSE strftime(o_orderdate, '%m-%d') END AS order_day,
       CASE WHEN o_custkey = 0 THEN NULL
            WHEN o_custkey BETWEEN 100 AND 9999 AND o_custkey // 100 BETWEEN 1 AND 12
                 AND o_custkey % 100 BETWEEN 1 AND 31
            THEN lpad(CAST(o_custkey // 100 AS VARCHAR), 2, '0') || '-'
                 || lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0')
            ELSE CAST(o_custkey AS VARCHAR) END AS customer_day
FROM orders""")
def _(spark, sf):
    d, status = F.col("o_orderdate"), F.col("o_orderstatus")
    number = (F.month(d) * 100 + F.dayofmonth(d)).cast("string")
    raw = (
        F.when(status == "F", F.concat(number, F.lit(".0")))
        .when(status == "O", number)
        .otherwise(F.date_format(d, "MM/dd"))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey",
        text.normalize_mmdd(raw).alias("order_day"),
        text.normalize_mmdd(F.col("o_custkey").cast("string")).alias("customer_day"),
    )


@query("extract_year", r"""
SELECT doc_id,
       CAST(nullif(regexp_extract(translate(text, '０１２３４５６７８９', '0123456789'),
                                  '(?:19|20)[0-9]{2}'), '') AS INTEGER) AS year
FROM documents""")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.extract_year(F.col("text")).alias("year"))


@query("clean_numeric", r"""
SELECT p_partkey, CAST(p_size + 0.5 AS DOUBLE) AS from_size,
       TRY_CAST(nullif(regexp_replace(p_brand, '[^0-9.-]', '', 'g'), '') AS DOUBLE) AS from_brand,
       TRY_CAST(nullif(regexp_replace(p_name, '[^0-9.-]', '', 'g'), '') AS DOUBLE) AS from_name
FROM part""", doubles="from_size from_brand from_name")
def _(spark, sf):
    size = F.concat(F.lit("　"), F.col("p_size").cast("string"), F.lit(".5 ]"))
    return table(spark, sf, "part").select(
        "p_partkey",
        text.clean_numeric(size).alias("from_size"),
        text.clean_numeric(F.col("p_brand")).alias("from_brand"),
        text.clean_numeric(F.col("p_name")).alias("from_name"),
    )


@query("month_number", r"""
SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month, CAST(NULL AS INTEGER) AS unknown
FROM orders""")
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        text.month_number(F.date_format("o_orderdate", "MMM")).alias("month"),
        text.month_number(F.col("o_orderpriority")).alias("unknown"),
    )


@query("parse_coordinate", r"""
SELECT s_suppkey, round(20 + s_nationkey + (s_suppkey % 600) / 600.0, 6) AS north,
       -round(20 + s_nationkey + (s_suppkey % 600) / 600.0, 6) AS south,
       CAST(NULL AS DOUBLE) AS unparsable
FROM supplier""", doubles="north south unparsable")
def _(spark, sf):
    written = lambda h: a.coordinate_text(20 + F.col("s_nationkey"), F.col("s_suppkey") % 600, F.lit(h))
    variant = F.translate(written("S"), "o'", "°′")
    return table(spark, sf, "supplier").select(
        "s_suppkey",
        text.parse_coordinate(written("N")).alias("north"),
        text.parse_coordinate(F.replace(variant, F.lit("S"), F.lit(" S"))).alias("south"),
        text.parse_coordinate(F.col("s_name")).alias("unparsable"),
    )


SPACES = r"[\x{09}-\x{0D}\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


@query("normalize_whitespace", f"""
SELECT doc_id, trim(regexp_replace(text, '{SPACES}', ' ', 'g')) AS normalized FROM documents""")
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", text.normalize_whitespace(F.col("text")).alias("normalized")
    )


@query("blank_to_null", f"""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_orderpriority END AS o_orderpriority FROM orders""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
        .when(F.col("o_orderstatus") == "O", " \t　").otherwise("").alias("o_orderpriority"),
    )
    return text.blank_to_null(orders)


@query("drop_empty_columns", """
SELECT c_custkey, c_name, c_mktsegment FROM customer""")
def _(spark, sf):
    customers = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_custkey") < 0, "x").alias("nothing"), "c_mktsegment"
    )
    return text.drop_empty_columns(customers)


@query("rename_aliases", """
SELECT CAST(l_suppkey AS VARCHAR) AS station_code_raw, 'Station ' || l_suppkey AS location_name_raw,
       CAST(count(*) AS VARCHAR) AS n
FROM lineitem GROUP BY l_suppkey""")
def _(spark, sf):
    counted = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count("*").cast("string").alias("n"))
    return text.rename_aliases(counted.select(
        F.col("l_suppkey").cast("string").alias("地点番号"),
        F.concat(F.lit("Station "), F.col("l_suppkey").cast("string")).alias(" 地点 "), "n",
    ))


@query("add_lineage", """
SELECT o_orderkey, 'orders' AS source_name, 'observed' AS data_status, '2001-11-04 00:00:00' AS raw_ingested_at
FROM orders""")
def _(spark, sf):
    return text.add_lineage(
        table(spark, sf, "orders").select("o_orderkey"),
        source_name="orders", data_status="observed",
        raw_ingested_at=dates.timestamp(a.RUN_TIME),
    )


@query("code_conversions", """
SELECT s_suppkey, right(CAST(47000 + s_suppkey AS VARCHAR), 3) AS last_digits,
       CAST(s_suppkey AS VARCHAR) AS plain, lpad(CAST(s_suppkey AS VARCHAR), 3, '0') AS padded
FROM supplier""")
def _(spark, sf):
    code = (47000 + F.col("s_suppkey")).cast("string")
    plain = codes.location_number(code)
    return table(spark, sf, "supplier").select(
        "s_suppkey", codes.location_code(code).alias("last_digits"),
        plain.alias("plain"), codes.pad_location(plain).alias("padded"),
    )


@query("doy_to_date", with_("events", """
SELECT location_code, year, event_type, doy,
       CAST(make_date(year, 1, 1) + (doy - 1) AS DATE) AS predicted_date
FROM (SELECT location_code, year, event_type,
             CAST(least(greatest(round_even(day_of_year * 3.5 - 4, 0), 1), 366) AS INTEGER) AS doy
      FROM events) AS clipped"""))
def _(spark, sf):
    e = a.events(spark, sf).withColumn("doy", dates.predicted_doy(F.col("day_of_year") * 3.5 - 4))
    return e.select(
        "location_code", "year", "event_type", "doy",
        dates.doy_to_date(F.col("year"), F.col("doy")).alias("predicted_date"),
    )


@query("doy_label", with_("events", """
SELECT location_code, year, event_type, strftime(date_key, '%d %b') AS label,
       strftime(CAST(make_date(2026, 1, 1) + (day_of_year - 1) AS DATE), '%d %b') AS label_2026
FROM events"""))
def _(spark, sf):
    doy = F.col("day_of_year")
    return a.events(spark, sf).select(
        "location_code", "year", "event_type",
        dates.doy_label(F.col("year"), doy).alias("label"),
        dates.doy_label(F.lit(2026), doy).alias("label_2026"),
    )


@query("forecast_year_rule", """
SELECT o_orderkey,
       CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS forecast_year
FROM orders""")
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.forecast_year(F.col("o_orderdate")).alias("forecast_year")
    )


@query("active_year", """
SELECT 'before' AS run, CAST(min(CASE WHEN y >= 1990 THEN y END) AS INTEGER) AS active_year
FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders) AS years
UNION ALL
SELECT 'during', CAST(min(CASE WHEN y >= 1998 THEN y END) AS INTEGER)
FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders) AS years
UNION ALL
SELECT 'after', CAST(max(year(o_orderdate)) AS INTEGER) FROM orders""")
def _(spark, sf):
    years = table(spark, sf, "orders").select(F.year("o_orderdate").alias("forecast_year")).distinct()
    runs = {"before": 1990, "during": 1998, "after": 2026}
    return quality.union_all([
        dates.active_year(years, dt.date(y, 3, 1)).select(F.lit(run).alias("run"), "active_year")
        for run, y in runs.items()
    ])


@query("filter_not_null", with_("stg_events", """
SELECT location_code, year, event_type, event_date FROM stg_events WHERE event_date IS NOT NULL"""))
def _(spark, sf):
    return a.staged_events(spark, sf).select(
        "location_code", "year", "event_type", "event_date"
    ).dropna(subset=["event_date"])


@query("parse_good_reject_split", """
SELECT o_orderkey, d AS event_date,
       CASE WHEN d IS NULL THEN 'no such day' END AS parse_error
FROM (SELECT o_orderkey,
             CASE WHEN day(o_orderdate) < day(last_day(o_orderdate))
                  THEN CAST(o_orderdate + INTERVAL 1 DAY AS DATE) END AS d
      FROM orders) AS parsed""")
def _(spark, sf):
    d = F.col("o_orderdate")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.year(d).alias("year"),
        F.concat_ws("-", F.month(d).cast("string"), (F.dayofmonth(d) + 1).cast("string")).alias("raw"),
    )
    date = dates.month_day_to_date(F.col("year"), F.col("raw"))
    parsed = orders.select(
        "o_orderkey", date.alias("event_date"), F.when(date.isNull(), "no such day").alias("parse_error")
    )
    good, reject = html.split_good_reject(parsed)
    return quality.union_all([good, reject])


# --- Wide sources

@query("wide_header_repair", wide_event_rows("R"))
def _(spark, sf):
    body, header = a.land_wide_csv(spark, sf, scratch_path(spark, "wide-csv"))
    wide = text.rename_aliases(wide_csv.read_wide_csv(spark, body, header))
    long = reshape.unpivot_years(wide, ["station_code_raw", "location_name_raw"])
    return long.where(F.col("event_date_raw").isNotNull())


@query("unpivot_years_pair", wide_event_rows("A"))
def _(spark, sf):
    wide = text.rename_aliases(a.wide_events(spark, sf, "A"))
    long = reshape.unpivot_years(wide, ["station_code_raw", "location_name_raw"])
    return long.where(F.col("event_date_raw").isNotNull())


@query("year_column_select", f"""
SELECT station_code_raw, year, event_date_raw FROM ({wide_event_rows("R")}) AS w
WHERE year BETWEEN 1997 AND 2000""")
def _(spark, sf):
    wide = text.rename_aliases(a.wide_events(spark, sf, "R"))
    long = reshape.unpivot_years(wide, ["station_code_raw", "location_name_raw"], first=1997, last=2000)
    return long.where(F.col("event_date_raw").isNotNull()).select("station_code_raw", "year", "event_date_raw")


#: Every month of the years that a supplier has shipments in; months without any stay, as NULL.
ALL_MONTHS = """(SELECT l_suppkey, year, CAST(m AS INTEGER) AS month FROM
  (SELECT DISTINCT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem) AS years, range(1, 13) AS months(m)) AS cells
LEFT JOIN wide_values USING (l_suppkey, year, month)"""


@query("unpivot_months", with_("wide_values", f"""
SELECT CAST({a.STATION_BASE} + l_suppkey AS VARCHAR) AS station_code, year, month, mean_temp_c
FROM {ALL_MONTHS}"""), doubles="mean_temp_c")
def _(spark, sf):
    wide = a.month_columns(a.wide_months(spark, sf), "t_")
    return reshape.unpivot_months(wide, ["station_code"], "mean_temp_c")


@query("join_full_outer", with_("wide_values", f"""
SELECT CAST({a.STATION_BASE} + l_suppkey AS VARCHAR) AS station_code, 'Station ' || l_suppkey AS station_name,
       year, month, mean_temp_c, precipitation_mm
FROM {ALL_MONTHS}"""), doubles="mean_temp_c precipitation_mm")
def _(spark, sf):
    measures, _ = jobs.parse_climate(a.climate_pages(spark, sf))
    return measures


def page_cells(measure: str, end: str) -> str:
    """SQL of a year row's cells as text, joined by ``|``."""
    months = " || '|' || ".join(f"coalesce(CAST(max(CASE WHEN month = {m} THEN {measure} END) AS VARCHAR) || '{end}', '')" for m in range(1, 13))
    return f"CAST(year AS VARCHAR) || '|' || {months} || '|x'"


PAGE_HEADER = "|".join(["Year", *MONTHS, "Annual"])


@query("html_table_rows", f"""
WITH monthly AS (
  SELECT CAST({a.STATION_BASE} + l_suppkey AS VARCHAR) AS page, year(l_shipdate) AS year, month(l_shipdate) AS month,
         CAST(sum(l_quantity) AS BIGINT) AS t, count(*) AS p
  FROM lineitem GROUP BY 1, 2, 3),
lines AS (
  SELECT page, {TEMP_VIEW} AS view, year, {page_cells('t', '.5 ]')} AS cells FROM monthly GROUP BY page, year
  UNION ALL SELECT page, {PRECIP_VIEW}, year, {page_cells('p', '.0)')} FROM monthly GROUP BY page, year
  UNION ALL SELECT DISTINCT page, v.view, 0, '{PAGE_HEADER}' FROM monthly, (VALUES ({TEMP_VIEW}), ({PRECIP_VIEW})) AS v(view))
SELECT page, view, CAST(row_number() OVER (PARTITION BY page, view ORDER BY year) - 1 AS INTEGER) AS row_no, cells, NULL AS parse_error FROM lines
UNION ALL
SELECT url, NULL, NULL, NULL, 'expected at least 2 tables, got ' || len(regexp_extract_all(html, '(?is)<table\\b[^>]*>(.*?)</table>')) FROM pages""")
def _(spark, sf):
    """Every cell of the second table of all climate pages, and the scraped pages, which have none."""
    station = a.climate_pages(spark, sf).select(F.col("station_code").alias("page"), "view", "html")
    scraped = table(spark, sf, "pages").select(F.col("url").alias("page"), F.lit(None).cast("int").alias("view"), "html")
    rows = html.html_table_rows(station.unionByName(scraped))
    return rows.select("page", "view", "row_no", F.array_join("cells", "|").alias("cells"), "parse_error")


@query("html_option_list", r"""
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY min(position)) - 1 AS INTEGER) AS position,
       name, code
FROM (SELECT page_id, unnest(range(1, len(codes) + 1)) AS position,
             unnest(codes) AS code, unnest(names) AS name
      FROM (SELECT page_id,
                   regexp_extract_all(html, '<li><a href="/([^"]*)">([^<]*)</a>', 1) AS codes,
                   regexp_extract_all(html, '<li><a href="/([^"]*)">([^<]*)</a>', 2) AS names
            FROM pages) AS lists) AS items
WHERE code <> '' AND name <> '' AND code NOT IN ('The', 'und')
GROUP BY page_id, name, code""")
def _(spark, sf):
    listed = html.html_option_list(
        table(spark, sf, "pages").select("page_id", "html"),
        scope=None, item=r'<li><a href="/([^"]*)">([^<]*)</a>', code_groups=(1,), text_group=2, deny_codes=["The", "und"],
    )
    return listed.select("page_id", "position", "name", "code")


@query("caption_coordinates", with_("metadata", """
SELECT station_code, station_name, latitude, longitude FROM metadata"""), doubles="latitude longitude")
def _(spark, sf):
    return html.caption_coordinates(a.caption_pages(spark, sf).drop("source_url"))


@query("station_driver_list", with_("stg_climate", """
SELECT DISTINCT station_name, station_code FROM stg_climate"""))
def _(spark, sf):
    return staging.station_driver_list(a.staged_climate(spark, sf))


@query("union_by_name", with_("events", """
SELECT location_code, year, date_key, NULL AS rm_raw FROM events
UNION ALL
SELECT CAST(l_suppkey AS VARCHAR), CAST(year(l_shipdate) AS INTEGER), NULL, CAST(count(*) AS VARCHAR)
FROM lineitem GROUP BY l_suppkey, year(l_shipdate), l_returnflag"""))
def _(spark, sf):
    return quality.union_all([
        a.events(spark, sf).select("location_code", "year", "date_key"),
        a.raw_events(spark, sf).select("year", F.col("station_code_raw").alias("location_code"), "rm_raw"),
    ])
