"""The monthly run: raw, staging, metadata, marts, forecast, checks.

Each step reads the parquet tables of the steps before it and writes its own, so
a rerun after a lost executor or a failed step starts from written tables.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from bloomline.config import (
    CANDIDATE_MODELS, DENY_STATION_CODES, FIRST_BLOOM, FULL_BLOOM, LOCATION_WIDTH, MODEL_VERSION, PLAUSIBLE_DOY,
    PRECIP_VIEW, RETIRED_MARKER, STATION_BASE, TEMP_VIEW,
)
from bloomline.functions.dates import timestamp
from bloomline.functions.text import rename_aliases
from bloomline.operators import cells, features, forecast as fc, marts, model, quality, reshape, staging
from bloomline.schemas import FORECAST, FORECAST_KEY, RAW_CLIMATE, RAW_EVENTS, STATION_METADATA
from bloomline.session import materialize
from bloomline.sources import html, sinks, wide_csv
from bloomline.sources.contracts import conform, verify


MEASURES = ("mean_temp_c", "precipitation_mm")
EVENT_COLUMNS = ("location_code", "date_key", "year", "event_type", "day_of_year")
#: Metrics that the write of a table observes, so that no check scans it for them.
OBSERVED = {
    "staging/climate": quality.Metrics(),
    "staging/events": quality.Metrics(nulls=("event_date", "event_date_raw", "location_name")),
    "marts/fact_climate": quality.Metrics(nulls=MEASURES, measures=MEASURES),
    "marts/fact_events": quality.Metrics(nulls=EVENT_COLUMNS),
    "marts/training_features": quality.Metrics(nulls=("day_of_year",)),
    **{f"marts/{name}": quality.Metrics() for name in (
        "dim_date", "dim_month", "dim_station", "dim_location", "event_gap", "prediction_features")},
}


def part_of(keys: list[str]) -> Column:
    """Name of a row's part of a table."""
    return F.md5(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).cast("binary"))


@dataclass(frozen=True)
class Warehouse:
    """Parquet tables below one root, a folder per layer and table.

    A rebuilt table is written to a new folder and takes effect with a row in
    the commit log, which readers resolve. One append to the log, a single file,
    switches any number of tables. Older folders stay until they are cleaned.
    """

    spark: SparkSession
    root: str
    station_base: int = STATION_BASE
    width: int = LOCATION_WIDTH

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def current(self) -> dict[str, tuple[int, str]]:
        """Last commit number and folder of each rebuilt table, or part of one: a row per table or part."""
        log = sinks.read_if_present(self.spark, self.path("_commits"))
        if log is None:
            return {}
        last = log.groupBy("name").agg(F.max("number").alias("number"), F.max_by("folder", "number").alias("folder"))
        return {r["name"]: (r["number"], r["folder"]) for r in last.collect()}

    def read(self, name: str) -> DataFrame:
        found = self.current()
        if name in found or not any(n.startswith(f"{name}#") for n in found):
            return self.spark.read.parquet(self.path(found[name][1] if name in found else name))
        parts = [folder for n, (_, folder) in found.items() if n.startswith(f"{name}#") and folder]
        if parts:
            return self.spark.read.parquet(*map(self.path, sorted(parts)))
        # All parts are cleared: any older folder has the columns.
        log = self.spark.read.parquet(self.path("_commits"))
        older = log.where(F.col("name").startswith(f"{name}#") & (F.col("folder") != "")).first()
        return self.spark.read.parquet(self.path(older["folder"])).limit(0)

    def stage(self, name: str, df: DataFrame) -> str:
        """Write a table's next version; readers don't see it before ``commit``.

        The metrics named for it in ``OBSERVED`` are taken by the same write and stored with its folder.
        """
        folder = f"{name}/{uuid.uuid4().hex}"
        wanted = OBSERVED.get(name)
        if wanted is None:
            df.write.parquet(self.path(folder))
            return folder
        seen = Observation()
        df.observe(seen, *wanted.aggregates()).write.parquet(self.path(folder))
        rows = [(folder, metric, None if value is None else float(value)) for metric, value in seen.get.items()]
        table = self.spark.createDataFrame(rows, "folder string, metric string, value double")
        sinks.append(table.coalesce(1), self.path("_metrics"))
        return folder

    def observed(self, names: list[str]) -> dict[str, quality.Stored]:
        """Stored metrics of the tables' current versions, for those that have any."""
        table = sinks.read_if_present(self.spark, self.path("_metrics"))
        if table is None:
            return {}
        current = self.current()
        folders = {current[n][1]: n for n in names if n in current}
        values: dict[str, dict[str, float | None]] = {}
        for r in table.where(F.col("folder").isin(list(folders))).collect():
            values.setdefault(folders[r["folder"]], {})[r["metric"]] = r["value"]
        return {name: quality.Stored(self.spark, v) for name, v in values.items()}

    def stage_parts(
        self, name: str, df: DataFrame, keys: list[str], cleared: list[tuple] | None = None, whole: bool = False
    ) -> dict[str, str]:
        """Write the next version of the parts of a table that ``df`` has, one for each value of ``keys``.

        Parts named in ``cleared``, or with ``whole`` all parts, that ``df`` lacks become empty. Other parts stay.
        A table has few parts: their values are listed on the driver. Nothing is
        seen before ``commit``, which switches all parts, and other tables, at once.
        """
        folder = f"{name}/{uuid.uuid4().hex}"
        df.withColumn("_part", part_of(keys)).write.partitionBy("_part").parquet(self.path(folder))
        written = sinks.read_if_present(self.spark, self.path(folder))
        values = [] if written is None else written.select(F.col("_part").cast("string")).distinct().collect()
        found = {r["_part"]: f"{folder}/_part={r['_part']}" for r in values}
        if cleared:
            found = dict.fromkeys(self.part_names(df.schema, keys, cleared), "") | found
        staged = {f"{name}#{p}": where for p, where in found.items()}
        if whole:
            staged = {n: "" for n in self.current() if n.startswith(f"{name}#")} | staged
        return staged

    def part_names(self, schema: T.StructType, keys: list[str], values: list[tuple]) -> list[str]:
        kinds = T.StructType([T.StructField(k, schema[k].dataType) for k in keys])
        named = self.spark.createDataFrame(values, kinds)
        return [r["_part"] for r in named.select(part_of(keys).alias("_part")).collect()]

    def read_parts(self, name: str, like: DataFrame, keys: list[str], values: list[tuple]) -> DataFrame:
        """The named parts of a table; without any of them no rows, in the columns of ``like``."""
        wanted = {f"{name}#{p}" for p in self.part_names(like.schema, keys, values)} if values else set()
        return self.read_folders({n: folder for n, (_, folder) in self.current().items() if n in wanted}, like)

    def read_folders(self, folders: dict[str, str], like: DataFrame) -> DataFrame:
        """Staged or committed folders as one table; without any of them no rows, in the columns of ``like``."""
        paths = sorted(self.path(folder) for folder in folders.values() if folder)
        return self.spark.read.parquet(*paths) if paths else self.spark.createDataFrame([], like.schema)

    def commit(self, folders: dict[str, str]) -> None:
        """Switch tables to staged folders, all at once.

        The number is claimed with a file that must not exist yet, so that no two
        writers share one; a later number wins.
        """
        number = 1 + max((n for n, _ in self.current().values()), default=0)
        while not sinks.create_once(self.spark, self.path(f"_numbers/{number}")):
            number += 1
        rows = [(number, name, folder) for name, folder in folders.items()]
        log = self.spark.createDataFrame(rows, "number long, name string, folder string")
        sinks.append(log.coalesce(1), self.path("_commits"))

    def rebuild(self, name: str, df: DataFrame) -> DataFrame:
        """Replace a table by a query over other tables."""
        self.commit({name: self.stage(name, df)})
        return self.read(name)


@dataclass(frozen=True)
class Landing:
    """What the fetchers left behind: stored pages and wide CSV files.

    ``climate_pages``: station_code, station_name, source_url, view, html.
    ``caption_pages``: station_code, station_name, source_url, html.
    ``event_files``: event type to (body path, header path or None).
    ``station_pages``: html of the pages that list the stations; without any,
    all stations but the denied and retired ones are taken.
    ``encoding``: that of the event files.
    """

    climate_pages: DataFrame
    caption_pages: DataFrame
    event_files: dict[str, tuple[str, str | None]]
    station_pages: DataFrame | None = None
    encoding: str = "UTF-8"


def listed_stations(pages: DataFrame, listing: DataFrame | None) -> DataFrame:
    """Pages of the stations to load: listed ones, never denied or retired ones."""
    retired = F.coalesce(F.col("station_name").contains(RETIRED_MARKER), F.lit(False))
    pages = pages.where(~F.trim("station_code").isin(DENY_STATION_CODES) & ~retired)
    if listing is None:
        return pages
    wanted = html.html_option_list(listing).select(F.col("code").alias("_code")).distinct()
    return pages.join(wanted, F.trim(pages["station_code"]) == wanted["_code"], "left_semi")


def parse_climate(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Monthly measures of all stations whose pages are readable, and the stations that failed.

    A station with one unreadable page fails as a whole: half of its measures
    would look like missing ones. The parsed rows are written once; both
    measures and the failures read them.
    """
    parsed = materialize(html.html_table_columns(pages.drop("source_url")), "parsed-pages")
    good, bad = html.split_good_reject(parsed)
    failed = bad.groupBy("station_code").agg(F.min("parse_error").alias("parse_error"))
    good = good.join(failed, "station_code", "left_anti")
    keys = ["station_code", "station_name"]
    measure = lambda view, name: reshape.unpivot_months(good.where(F.col("view") == view), keys, name)
    joined = staging.join_measures(
        measure(TEMP_VIEW, "mean_temp_c"), measure(PRECIP_VIEW, "precipitation_mm")
    )
    return joined, failed


def run_raw(wh: Warehouse, landing: Landing, run_ts: dt.datetime, source_name: str) -> DataFrame:
    """Parse the landed files into the raw tables, which switch with one commit; returns the load summary."""
    stamp = timestamp(run_ts)
    measures, failed = parse_climate(listed_stations(landing.climate_pages, landing.station_pages))
    urls = landing.climate_pages.where(F.col("view") == TEMP_VIEW).select("station_code", "source_url")
    climate = measures.join(urls, on="station_code", how="left").withColumn("raw_ingested_at", stamp)
    folders = {"raw/climate": wh.stage("raw/climate", conform(climate, RAW_CLIMATE))}
    loaded = html.require_rows(wh.spark.read.parquet(wh.path(folders["raw/climate"])), "station data")

    for event_type, (body, header) in landing.event_files.items():
        wide = rename_aliases(wide_csv.read_wide_csv(wh.spark, body, header, encoding=landing.encoding))
        long = reshape.unpivot_years(wide, ["station_code_raw", "location_name_raw"])
        raw = staging.build_raw_events(long, event_type, source_name, body, "wide event table", stamp)
        folders |= wh.stage_parts("raw/events", conform(raw, RAW_EVENTS), ["source_name", "event_type", "data_status"])
    wh.commit(folders)
    return quality.load_summary(loaded, failed, ["mean_temp_c", "precipitation_mm"])


def run_staging(wh: Warehouse, caption_pages: DataFrame, run_ts: dt.datetime) -> None:
    """Staging tables, then the metadata of the stations found in them."""
    climate = wh.rebuild("staging/climate", staging.stage_climate(wh.read("raw/climate")))
    wh.rebuild("staging/events", staging.stage_events(wh.read("raw/events")))
    wanted = staging.station_driver_list(climate).select("station_code").distinct()
    located = html.caption_coordinates(caption_pages.join(wanted, on="station_code", how="left_semi"))
    stamped = located.withColumn("metadata_ingested_at", timestamp(run_ts))
    table = wh.rebuild("staging/metadata", conform(stamped, STATION_METADATA))
    verify(html.require_rows(table, "station metadata"), STATION_METADATA)


def build_dimensions(
    climate: DataFrame, events: DataFrame, metadata: DataFrame, base: int = STATION_BASE
) -> dict[str, DataFrame]:
    """All dimensions, from one scan of each staged table."""
    return marts.event_dimensions(events) | marts.climate_dimensions(climate, metadata, base)


def run_marts(wh: Warehouse, as_of: dt.date | Column | None = None) -> None:
    """Write the marts, then the month cells and from them both feature tables; one commit for all.

    Each staged table is scanned once for its dimensions and once for its fact.
    """
    climate, events = wh.read("staging/climate"), wh.read("staging/events")
    layer = build_dimensions(climate, events, wh.read("staging/metadata"), wh.station_base)
    layer |= {"fact_climate": marts.fact_climate(climate), "fact_events": marts.fact_events(events)}
    folders = {f"marts/{name}": wh.stage(f"marts/{name}", df) for name, df in layer.items()}
    written = lambda name: wh.spark.read.parquet(wh.path(folders[f"marts/{name}"]))
    folders["marts/event_gap"] = wh.stage("marts/event_gap", marts.event_gap(written("fact_events")))
    folded = cells.station_cells(written("fact_climate"), wh.width)
    parts = stage_cells(wh, folded, whole=True)
    stored = wh.read_folders(parts, folded)
    wh.commit(folders | parts | stage_features(wh, written("fact_events"), stored, as_of))


CELLS = "marts/month_cells"


def stage_cells(wh: Warehouse, folded: DataFrame, **parts) -> dict[str, str]:
    """Write month cells in parts by year; small years share tasks, large ones are split over several."""
    return wh.stage_parts(CELLS, folded.hint("rebalance", F.col("year")), ["year"], **parts)


def stage_features(
    wh: Warehouse, events: DataFrame, stored: DataFrame, as_of: dt.date | Column | None
) -> dict[str, str]:
    """Write both feature tables out of month cells."""
    built = {
        "training_features": features.stored_training_features(events, stored, width=wh.width),
        "prediction_features": features.stored_prediction_features(events, stored, as_of, width=wh.width),
    }
    return {f"marts/{name}": wh.stage(f"marts/{name}", df) for name, df in built.items()}


def load_climate(
    wh: Warehouse,
    rows: DataFrame,
    as_of: dt.date | Column | None = None,
    cleared: list[tuple[str, int]] | None = None,
) -> None:
    """Bring the month cells and features forward with climate rows of some station years.

    ``rows`` has every row of each station year it has any of, in the columns of
    the climate fact; ``cleared`` lists station years that have none any more.
    Only the calendar years met are read and written again, the climate fact not
    at all: it follows with the next ``run_marts``. Cells and features switch
    with one commit. Loads of one warehouse come one after the other.
    """
    load = materialize(cells.station_cells(rows, wh.width), "month-cells")
    gone = wh.spark.createDataFrame(cleared, "station_code string, year int") if cleared else None
    # Bounded by the calendar.
    years = {r["year"] for r in load.select("year").distinct().collect()} | {year for _, year in cleared or []}
    touched = [(year,) for year in sorted(years)]
    before = wh.read_parts(CELLS, load, ["year"], touched)
    after = stage_cells(wh, cells.replace_station_years(before, load, gone), cleared=touched)
    current = {n: folder for n, (_, folder) in wh.current().items() if n.startswith(f"{CELLS}#")}
    stored = wh.read_folders(current | after, load)
    wh.commit(after | stage_features(wh, wh.read("marts/fact_events"), stored, as_of))


def run_forecast(
    wh: Warehouse,
    run_ts: dt.datetime,
    candidates: dict[str, dict] = CANDIDATE_MODELS,
    event_type: str = FIRST_BLOOM,
    model_version: str = MODEL_VERSION,
) -> list[dict] | None:
    """Choose and store a model, and upsert the forecasts of all candidates fitted on all rows.

    Returns the candidates' metric rows, best first, or ``None`` without input.
    """
    train = model.training_set(wh.read("marts/training_features"), event_type).persist()
    try:
        if train.isEmpty():
            return None
        model.validate_features(train)
        selection, best, finals = model.select_best_model(model.hash_split(train), candidates)
        held_out = model.hash_split(train).where("split = 'test'")
        station = model.metrics_per_group(model.with_prediction(best, held_out), ["location_code"])

        name = selection[0]["model_name"]
        document = fc.metadata_row(wh.spark, selection, train.count(), run_ts, model_version)
        stamp = run_ts.strftime("%Y%m%d_%H%M%S")
        fc.save_artifact(finals[name], document, wh.path(f"models/{name}_{model_version}_{stamp}"), station)

        upcoming = model.prediction_set(wh.read("marts/prediction_features"), event_type)
        if upcoming.isEmpty():
            return selection
        rows = fc.build_all(
            train, upcoming, selection, run_ts, station, candidates, finals, model_version
        )
        scored = materialize(rows, "forecast-rows")
        sinks.write_forecast(wh.spark, verify(scored, FORECAST), wh.path("marts/forecast"))
        return selection
    finally:
        train.unpersist()


def standard_checks(
    tables: dict[str, DataFrame], observed: dict[str, quality.Stored] | None = None
) -> list[quality.Check]:
    """The checks of one run over the written tables.

    What the writes have ``observed`` of a table is not counted again.
    """
    stored = observed or {}
    zero = lambda v: v == 0
    some = lambda v: v > 0

    def null_counts(name: str, cols: list[str]) -> DataFrame:
        return stored[name].nulls(cols) if name in stored else quality.null_counts(tables[name], cols)

    def rows(name: str) -> quality.Check:
        found = stored[name].rows() if name in stored else tables[name].agg(F.count("*").alias("row_count"))
        return quality.Check(f"{name}: rows", found, some)

    def reconciled() -> DataFrame:
        if "fact_events" in stored and "stg_events" in stored:
            fact, staged = stored["fact_events"].values, stored["stg_events"].values
            return stored["fact_events"].frame(difference=fact["row_count"] - (staged["row_count"] - staged["null_event_date"]))
        return quality.reconcile(tables["fact_events"], tables["stg_events"].where("event_date IS NOT NULL"),
                                 ("fact_rows", "staging_rows_with_date")).select("difference")

    unique = lambda name, keys: quality.count_check(
        f"{name}: unique {', '.join(keys)}", quality.duplicate_keys(tables[name], keys)
    )
    nulls = lambda name, cols: quality.Check(
        f"{name}: nulls", null_counts(name, cols).select([f"null_{c}" for c in cols]), zero,
    )
    measures = (stored["fact_climate"].range(list(MEASURES)) if "fact_climate" in stored
                else quality.measure_range(tables["fact_climate"], list(MEASURES)))
    checks = [rows(name) for name in tables]
    checks += [
        unique("dim_station", ["station_code"]),
        unique("fact_climate", ["station_code", "date_key"]),
        unique("fact_events", ["location_code", "year", "event_type"]),
        nulls("fact_events", list(EVENT_COLUMNS)),
        nulls("training_features", ["day_of_year"]),
        quality.Check("fact_climate: measures", measures),
        quality.Check("fact_events: unmatched locations", quality.orphans(
            tables["fact_events"], tables["dim_location"], "location_code"), zero),
        quality.Check("fact_events: unmatched dates", quality.orphans(
            tables["fact_events"], tables["dim_date"], "date_key"), zero),
    ]
    grouped = lambda name, frame, *keys: quality.Check(name, frame, keys=keys)
    climate, dates = tables["fact_climate"], tables["dim_month"]
    checks += [
        quality.Check("fact_climate: years", quality.range_distinct(
            climate.select(F.year("date_key").alias("year")), "year")),
        quality.Check("fact_climate: filled", null_counts("fact_climate", list(MEASURES))),
        grouped("fact_climate: by station", quality.group_by_dim(
            climate, tables["dim_station"], "station_code", "station_name"), "station_name"),
        grouped("fact_climate: by season", quality.group_by_dim(
            climate, dates, "date_key", "season", "mean_temp_c"), "season"),
        grouped("fact_climate: by quarter", quality.distribution(
            climate.select(F.quarter("date_key").alias("quarter")), ["quarter"]), "quarter"),
    ]
    if "stg_events" in tables:
        staged = tables["stg_events"]
        checks += [
            quality.Check("fact_events: reconciled", reconciled(), zero),
            quality.Check("stg_events: years", quality.range_distinct(staged, "year")),
            quality.Check("stg_events: locations", staged.agg(F.count_distinct("location_name").alias("distinct_locations"))),
            quality.Check("stg_events: missing", null_counts("stg_events", ["event_date_raw", "location_name"])
                          .select("null_event_date_raw", "null_location_name")),
            grouped("stg_events: by year", quality.distribution(staged, ["year"]), "year"),
            grouped("stg_events: by type", quality.distribution(staged, ["event_type", "data_status"]), "event_type", "data_status"),
            unique("stg_events", ["location_name", "year", "event_type"]),
        ]
    if "forecast" in tables:
        required = ["location_code", "forecast_year", "event_type", "model_name", "model_version",
                    "predicted_day_of_year", "predicted_event_date", "is_best_model"]
        checks += [
            unique("forecast", list(FORECAST_KEY)),
            nulls("forecast", required),
            quality.count_check("forecast: implausible days", quality.out_of_range(
                tables["forecast"], "predicted_day_of_year", *PLAUSIBLE_DOY)),
        ]
    return checks


CHECKED = ["dim_date", "dim_month", "dim_station", "dim_location", "fact_climate", "fact_events",
           "event_gap", "training_features", "prediction_features"]


def run_checks(wh: Warehouse) -> DataFrame:
    tables = {name: wh.read(f"marts/{name}") for name in CHECKED}
    tables |= {"stg_events": wh.read("staging/events"), "stg_climate": wh.read("staging/climate")}
    forecast = sinks.read_if_present(wh.spark, wh.path("marts/forecast"))
    if forecast is not None:
        tables["forecast"] = forecast
    paths = {f"marts/{name}": name for name in CHECKED} | {"staging/events": "stg_events", "staging/climate": "stg_climate"}
    stored = {paths[path]: values for path, values in wh.observed(list(paths)).items()}
    return quality.run_checks(standard_checks(tables, stored))


def run_all(
    wh: Warehouse,
    landing: Landing,
    as_of: dt.date,
    run_ts: dt.datetime,
    source_name: str,
    candidates: dict[str, dict] = CANDIDATE_MODELS,
) -> DataFrame:
    """One monthly run; returns the check report."""
    run_raw(wh, landing, run_ts, source_name)
    run_staging(wh, landing.caption_pages, run_ts)
    run_marts(wh, as_of)
    run_forecast(wh, run_ts, candidates)
    return run_checks(wh)


EVENT_FLAGS = {FIRST_BLOOM: "R", FULL_BLOOM: "A"}
