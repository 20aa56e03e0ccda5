"""The logical tables, derived from the benchmark tables.

A supplier plays a station, its shipments the weather and the flowering dates.
Every frame is an aggregate with map-side combine over whole tables.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bloomline.config import FIRST_BLOOM, FULL_BLOOM, MONTHS, PRECIP_VIEW, TEMP_VIEW
from bloomline.functions.codes import pad_location
from bloomline.functions.dates import timestamp
from bloomline.operators import forecast as fc, marts, model, staging
from bloomline.schemas import STATION_METADATA
from bloomline.session import materialize
from bloomline.sources import html as pages_of
from bloomline.sources.contracts import conform

# Nine digits hold every supplier key, so codes stay unique at any scale.
STATION_BASE, WIDTH = 47_000_000_000, 9
AUTUMN_RUN, SPRING_RUN = dt.date(2001, 11, 4), dt.date(2001, 5, 1)
RUN_TIME = dt.datetime(2001, 11, 4)
PAGE_URL = "https://weather.example/monthly?station="


@functools.cache
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table; file listing and schema are looked up once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def station_code(suppkey: Column) -> Column:
    return (F.lit(STATION_BASE).cast("long") + suppkey).cast("string")


def _month_start() -> Column:
    return F.trunc(F.to_date("l_shipdate"), "month")


def climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Climate fact: some months lack one measure, as in scraped tables."""
    monthly = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", _month_start().alias("date_key")).agg(
        F.avg(F.when(F.col("l_linestatus") == "F", F.col("l_quantity"))).alias("mean_temp_c"),
        F.round(
            F.sum(F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice"))), 2
        ).alias("precipitation_mm"),
    )
    return monthly.select(
        station_code(F.col("l_suppkey")).alias("station_code"),
        "date_key", "mean_temp_c", "precipitation_mm",
    )


def raw_climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw climate: two competing versions of most station months, one per line status."""
    versions = table(spark, sf_dir, "lineitem").groupBy(
        "l_suppkey", _month_start().alias("_month"), "l_linestatus"
    ).agg(
        F.avg("l_quantity").alias("mean_temp_c"),
        F.round(F.sum("l_extendedprice"), 2).alias("precipitation_mm"),
        F.max("l_shipdate").alias("raw_ingested_at"),
    )
    code = station_code(F.col("l_suppkey"))
    return versions.select(
        F.concat(F.lit(PAGE_URL), code, F.lit("&v="), "l_linestatus").alias("source_url"),
        F.concat(F.lit(" Station "), F.col("l_suppkey").cast("string"), F.lit(" ")).alias("station_name"),
        F.concat(code, F.lit(" ")).alias("station_code"),
        F.year("_month").alias("year"),
        F.month("_month").alias("month"),
        "mean_temp_c", "precipitation_mm", "raw_ingested_at",
    )


def _first_shipments(spark: SparkSession, sf_dir: str, flags: list[str]) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_returnflag").isin(flags))
        .groupBy("l_suppkey", F.year("l_shipdate").alias("year"), "l_returnflag")
        .agg(F.to_date(F.min("l_shipdate")).alias("date_key"), F.count("*").alias("n"))
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event fact: first returned (R) and first accepted (A) shipment of each year."""
    kind = F.when(F.col("l_returnflag") == "R", FIRST_BLOOM).otherwise(FULL_BLOOM)
    return _first_shipments(spark, sf_dir, ["R", "A"]).select(
        F.col("l_suppkey").cast("string").alias("location_code"),
        "year",
        kind.alias("event_type"),
        "date_key",
        F.dayofyear("date_key").alias("day_of_year"),
        F.lit("observed").alias("data_status"),
        F.lit("shipments").alias("source_name"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events as text; flag N gives a second, unreadable full-bloom row."""
    flag, day = F.col("l_returnflag"), F.col("date_key")
    return _first_shipments(spark, sf_dir, ["R", "A", "N"]).select(
        timestamp(RUN_TIME).alias("raw_ingested_at"),
        F.lit("shipments").alias("source_name"),
        F.concat(F.lit(PAGE_URL), F.col("l_suppkey").cast("string")).alias("source_url"),
        F.col("l_suppkey").cast("string").alias("station_code_raw"),
        F.concat(F.lit(" Station "), F.col("l_suppkey").cast("string")).alias("location_name_raw"),
        "year",
        F.col("n").cast("string").alias("rm_raw"),
        F.when(flag == "R", FIRST_BLOOM).otherwise(FULL_BLOOM).alias("event_type"),
        F.when(flag == "N", F.date_format(day, "MM/dd"))
        .otherwise(F.date_format(day, " M-dd")).alias("event_date_raw"),
        F.when(flag == "N", "estimated").otherwise("observed").alias("data_status"),
        F.lit("first shipment").alias("page_notes"),
    )


def staged_climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_climate(raw_climate(spark, sf_dir))


def staged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_events(raw_events(spark, sf_dir))


def coordinate_text(degrees: Column, tenths: Column, hemisphere: Column) -> Column:
    """``35o39.2'N`` out of whole degrees and tenths of a minute."""
    minutes = F.format_string("%02d.%d", F.floor(tenths / 10).cast("int"), (tenths % 10).cast("int"))
    return F.concat(degrees.cast("string"), F.lit("o"), minutes, F.lit("'"), hemisphere)


def caption_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metadata page per supplier; a few of them without a caption."""
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    tenths = key % 600
    lat = coordinate_text(20 + nation, tenths, F.lit("N"))
    lon = coordinate_text(120 + nation, 599 - tenths, F.when(F.col("s_acctbal") < 0, "W").otherwise("E"))
    caption = F.concat(
        F.lit('<table><caption class="m">'), "s_name", F.lit("&nbsp;\n <b>Lat</b> "), lat,
        F.lit("  Lon&nbsp;"), lon, F.lit("</caption></table>"),
    )
    return table(spark, sf_dir, "supplier").select(
        station_code(key).alias("station_code"),
        F.col("s_name").alias("station_name"),
        F.concat(F.lit(PAGE_URL), station_code(key)).alias("source_url"),
        F.when(F.col("s_acctbal") > 9000, "<table></table>").otherwise(caption).alias("html"),
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = pages_of.caption_coordinates(caption_pages(spark, sf_dir))
    return conform(
        located.withColumn("metadata_ingested_at", timestamp(RUN_TIME)), STATION_METADATA
    )


def dim_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.dim_station(staged_climate(spark, sf_dir), metadata(spark, sf_dir), STATION_BASE)


def wide_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year rows with annotated month cells, both measures: ``t_Jan`` .. ``p_Dec``.

    Shipments fold to months before the months become columns.
    """
    monthly = table(spark, sf_dir, "lineitem").groupBy(
        "l_suppkey", F.year("l_shipdate").alias("Year"), F.month("l_shipdate").alias("month")
    ).agg(F.sum("l_quantity").cast("long").alias("t"), F.count("*").alias("p"))
    cells = [
        F.max(F.when(F.col("month") == i, F.col(measure))).alias(f"{measure}_{name}")
        for measure in ("t", "p") for i, name in enumerate(MONTHS, 1)
    ]
    wide = monthly.groupBy("l_suppkey", "Year").agg(*cells)
    noted = lambda name: F.concat(F.col(name).cast("string"), F.lit(".5 ]" if name[0] == "t" else ".0)　"))
    return wide.select(
        station_code(F.col("l_suppkey")).alias("station_code"),
        F.concat(F.lit("Station "), F.col("l_suppkey").cast("string")).alias("station_name"),
        F.col("Year").cast("string").alias("Year"),
        *[noted(n).alias(n) for n in wide.columns[2:]],
    )


def month_columns(wide: DataFrame, prefix: str) -> DataFrame:
    return wide.select(
        "station_code", "station_name", "Year", *[F.col(prefix + m).alias(m) for m in MONTHS]
    )


def climate_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station pages, one per measure: a navigation table, then the year table.

    A page lists one row per year, so what is collected is bounded by the calendar.
    """
    wide = wide_months(spark, sf_dir)

    def line(prefix: str) -> Column:
        cells = [F.coalesce(F.col(prefix + m), F.lit("")) for m in MONTHS]
        tds = [x for c in cells for x in (F.lit("<td class='num'>"), c, F.lit("</td>"))]
        return F.concat(F.lit("<tr><td>"), "Year", F.lit("</td>"), *tds, F.lit("<td>x</td></tr>\n"))

    lines = wide.select("station_code", "station_name", F.struct("Year", line("t_").alias("t"), line("p_").alias("p")).alias("row"))
    header = "".join(f"<th>{m}</th>" for m in ["Year", *MONTHS, "Annual"])
    lead = f"<html><table><tr><td>menu</td></tr></table>\n<TABLE border='1'><tr>{header}</tr>"

    def page(view: int, cell: str) -> Column:
        body = F.array_join(F.transform("rows", lambda r: r[cell]), "")
        return F.struct(F.lit(view).alias("view"), F.concat(F.lit(lead), body, F.lit("</TABLE></html>")).alias("html"))

    return (
        lines.groupBy("station_code", "station_name")
        .agg(F.sort_array(F.collect_list("row")).alias("rows"))
        .select(
            "station_code", "station_name",
            F.concat(F.lit(PAGE_URL), "station_code").alias("source_url"),
            F.inline(F.array(page(TEMP_VIEW, "t"), page(PRECIP_VIEW, "p"))),
        )
    )


def wide_events(spark: SparkSession, sf_dir: str, flag: str = "R") -> DataFrame:
    """One row per station, ``<year>`` and ``<year>rm`` columns, dates as ``MDD.0``."""
    day = F.col("date_key")
    yearly = _first_shipments(spark, sf_dir, [flag]).select(
        "l_suppkey", "year", "n", (F.month(day) * 100 + F.dayofmonth(day)).alias("mdd")
    )
    inside = lambda y, c: F.max(F.when(F.col("year") == y, F.col(c)))
    span = table(spark, sf_dir, "lineitem").agg(F.year(F.min("l_shipdate")), F.year(F.max("l_shipdate"))).first()
    years = range(span[0], span[1] + 1) if span[0] is not None else range(0)
    cells = [x for y in years for x in (inside(y, "mdd").alias(str(y)), inside(y, "n").alias(f"{y}rm"))]
    wide = yearly.groupBy("l_suppkey").agg(*cells)
    return wide.select(
        F.col("l_suppkey").cast("string").alias("番号"),
        F.concat(F.lit("Station "), F.col("l_suppkey").cast("string")).alias("地点名"),
        *[
            (F.col(n).cast("string") if n.endswith("rm") else F.concat(F.col(n).cast("string"), F.lit(".0"))).alias(n)
            for n in wide.columns[1:]
        ],
    )


def land_wide_csv(spark: SparkSession, sf_dir: str, path: str, flag: str = "R") -> tuple[str, str]:
    """Write ``wide_events`` as landed CSV: header lines apart from the body files."""
    wide = wide_events(spark, sf_dir, flag)
    names = wide.columns
    header = [n if n in names[:2] else "rm" if n.endswith("rm") else f"{n}.0" for n in names]
    lines = spark.createDataFrame([("Flowering dates,,",), (",".join([*header, ""]),)], "value string")
    lines.coalesce(1).write.mode("overwrite").text(f"{path}/header")
    row = F.concat_ws(",", *[F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in names], F.lit(""))
    wide.select(row.alias("value")).write.mode("overwrite").text(f"{path}/body")
    return f"{path}/body", f"{path}/header"


# --- Station averages stand in for trained models where a result is checked in SQL.

BASELINES = {"station_mean": F.avg, "station_earliest": F.min, "station_latest": F.max}


def _fit_baselines(rows: DataFrame) -> DataFrame:
    fitted = rows.groupBy("location_code").agg(
        *[f("day_of_year").cast("double").alias(n) for n, f in BASELINES.items()]
    )
    return fitted.unpivot("location_code", list(BASELINES), "model_name", "prediction")


def bloom_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_rows(events(spark, sf_dir))


def split_rows(events: DataFrame) -> DataFrame:
    """First-bloom rows of an event fact with their split and fold."""
    e = events.where(F.col("event_type") == FIRST_BLOOM)
    return model.cv_fold(model.hash_split(
        e.select(pad_location(F.col("location_code"), WIDTH).alias("location_code"),
                 "year", "event_type", "day_of_year")
    ))


def baseline_scores(rows: DataFrame) -> DataFrame:
    """Held-out rows with the prediction of each baseline fitted on the other rows."""
    fitted = _fit_baselines(rows.where("split = 'train'"))
    return rows.where("split = 'test'").join(fitted, on="location_code")


def baseline_metrics(scores: DataFrame) -> DataFrame:
    """One metric row per baseline, ``cv_mae_days`` averaged over the folds."""
    folds = scores.groupBy("model_name", "fold").agg(
        F.avg(F.abs(F.col("prediction") - F.col("day_of_year"))).alias("fold_mae")
    ).groupBy("model_name").agg(F.avg("fold_mae").alias("cv_mae_days"))
    return model.regression_metrics(scores, by=["model_name"]).join(folds, on="model_name")


def stored_bloom_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bloom_rows`` written once, since splits, fits and scores all start from it."""
    return materialize(bloom_rows(spark, sf_dir), "bloom-rows")


def baseline_forecast(spark: SparkSession, sf_dir: str, as_of: dt.date = AUTUMN_RUN) -> DataFrame:
    """Forecast fact of all baselines for the run date."""
    return baseline_forecast_of(stored_bloom_rows(spark, sf_dir), as_of)


def baseline_forecast_of(rows: DataFrame, as_of: dt.date = AUTUMN_RUN) -> DataFrame:
    """The same from given event rows with their splits and folds."""
    spark = rows.sparkSession
    scores = baseline_scores(rows)
    ranked = model.ranked([r.asDict() for r in baseline_metrics(scores).collect()], spark)
    models = fc.model_rows(spark, ranked, rows.count())
    year = as_of.year + (as_of.month >= 6)
    predicted = _fit_baselines(rows).withColumns({
        "year": F.lit(year), "event_type": F.lit(FIRST_BLOOM), "using_climate_normals": F.lit(True),
    })
    of_best = scores.where(F.col("model_name") == ranked[0]["model_name"])
    station = model.metrics_per_group(of_best, ["location_code"])
    return fc.build_forecast(predicted, models, RUN_TIME, station)
