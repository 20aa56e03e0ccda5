"""Metrics observed by writes, and distinct counts from merged bitmaps."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from bloomline.operators import distinct, quality
from bloomline.plans import adapters as a, jobs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    wh = jobs.Warehouse(spark, str(tmp_path_factory.mktemp("observed")), a.STATION_BASE, a.WIDTH)
    for name, table in (("climate", a.staged_climate), ("events", a.staged_events), ("metadata", a.metadata)):
        wh.rebuild(f"staging/{name}", table(spark, SF))
    jobs.run_marts(wh, a.AUTUMN_RUN)
    return wh


def tables_of(wh):
    return {name: wh.read(f"marts/{name}") for name in jobs.CHECKED} | {
        "stg_events": wh.read("staging/events"), "stg_climate": wh.read("staging/climate")}


def rows(report):
    return sorted((r.position, r.check_name, r.metric, r.value, r.passed) for r in report.collect())


def scans(df, table):
    return df._jdf.queryExecution().executedPlan().toString().count(f"/{table}/")


def test_report_is_the_same_without_the_scans(written):
    counted = quality.run_checks(jobs.standard_checks(tables_of(written)))
    observed = jobs.run_checks(written)
    assert rows(observed) == rows(counted)
    for table in ("fact_climate", "fact_events", "staging/events"):
        assert scans(observed, table) < scans(counted, table)
    # Nothing but its rows is asked of these, and the write has counted them.
    for table in ("event_gap", "prediction_features", "training_features", "staging/climate"):
        assert scans(observed, table) == 0 and scans(counted, table) > 0


def test_metrics_belong_to_a_version(spark, tmp_path):
    wh = jobs.Warehouse(spark, str(tmp_path), a.STATION_BASE, a.WIDTH)
    frame = lambda n: spark.range(n).select(
        F.when(F.col("id") > 0, F.col("id") / 2).alias("mean_temp_c"), F.lit(None).cast("double").alias("precipitation_mm"))
    wh.rebuild("marts/fact_climate", frame(5))
    assert wh.observed(["marts/fact_climate"])["marts/fact_climate"].values == {
        "row_count": 5.0, "null_mean_temp_c": 1.0, "null_precipitation_mm": 5.0, "min_mean_temp_c": 0.5, "max_mean_temp_c": 2.0,
        "min_precipitation_mm": None, "max_precipitation_mm": None}
    staged = wh.stage("marts/fact_climate", frame(9))  # not committed yet
    assert wh.observed(["marts/fact_climate"])["marts/fact_climate"].values["row_count"] == 5.0
    wh.commit({"marts/fact_climate": staged})
    assert wh.observed(["marts/fact_climate"])["marts/fact_climate"].values["row_count"] == 9.0
    empty = wh.rebuild("marts/fact_climate", frame(0))
    assert empty.count() == 0 and wh.observed(["marts/fact_climate"])["marts/fact_climate"].values["row_count"] == 0.0


@pytest.mark.parametrize("side_by_side", [distinct.SIDE_BY_SIDE, 0])
def test_bitmaps_of_loads(spark, monkeypatch, side_by_side):
    monkeypatch.setattr(distinct, "SIDE_BY_SIDE", side_by_side)
    rng = random.Random(8)
    data = [(rng.choice([None, *[f"n{i}" for i in range(60)]]), rng.choice([None, 0, 5, 32767, 32768, 70000]), i % 3) for i in range(500)]
    df = spark.createDataFrame(data, "name string, n long, part int").repartition(4)
    names, maps = None, []
    for part in range(3):
        load = df.where(F.col("part") == part)
        before = {} if names is None else {r["value"]: r["number"] for r in names.collect()}
        names = distinct.extend_dictionary(names, load, "name")
        now = {r["value"]: r["number"] for r in names.collect()}
        assert before.items() <= now.items() and sorted(now.values()) == list(range(len(now)))
        numbered = load.join(names, load["name"] == names["value"], "left")
        maps.append(distinct.bitmaps(numbered, {"name": F.col("number"), "n": F.col("n")}, {"name": len(now), "n": 70001}))
    got = distinct.distinct_counts(distinct.merge_bitmaps(maps), ["name", "n", "absent"]).first()
    assert tuple(got) == (len({r[0] for r in data} - {None}), 5, 0)
    one = distinct.distinct_counts(maps[0], ["name"]).first()[0]
    assert one == len({r[0] for r in data if r[2] == 0} - {None})
    nothing = distinct.bitmaps(df.limit(0), {"n": F.col("n")}, {"n": 10})
    assert distinct.distinct_counts(nothing, ["n"]).first()[0] == 0


def test_parts_switch_with_one_commit(spark, tmp_path):
    wh = jobs.Warehouse(spark, str(tmp_path), a.STATION_BASE, a.WIDTH)
    rows_of = lambda: sorted((r.k or "", r.n, r.v) for r in wh.read("t").select("k", "n", "v").collect())
    frame = lambda rows: spark.createDataFrame(rows, "k string, n int, v int")
    wh.commit(wh.stage_parts("t", frame([("a", 1, 1), ("a", 2, 1), (None, 1, 1), ("b/ c", 1, 1)]), ["k", "n"]))
    # One part replaced, one cleared, the others stay; nothing is seen before the commit.
    staged = wh.stage_parts("t", frame([("a", 1, 2)]), ["k", "n"], cleared=[("b/ c", 1), ("a", 1)])
    assert len(rows_of()) == 4
    wh.commit(staged)
    assert rows_of() == [("", 1, 1), ("a", 1, 2), ("a", 2, 1)]
    wh.commit(wh.stage_parts("t", frame([]), ["k", "n"], cleared=[("a", 1), ("a", 2), (None, 1)]))
    assert rows_of() == [] and wh.read("t").columns == ["k", "n", "v"]


def test_writers_get_numbers_of_their_own(spark, tmp_path, monkeypatch):
    wh = jobs.Warehouse(spark, str(tmp_path), a.STATION_BASE, a.WIDTH)
    wh.rebuild("t", spark.range(1))
    known = wh.current()
    monkeypatch.setattr(jobs.Warehouse, "current", lambda self: known)  # what a second writer saw before the first one committed
    wh.commit({"t": wh.stage("t", spark.range(2))})
    wh.commit({"t": wh.stage("t", spark.range(3))})
    monkeypatch.undo()
    assert wh.read("t").count() == 3
    log = spark.read.parquet(wh.path("_commits"))
    assert log.count() == log.select("number").distinct().count() == 3


def test_raw_tables_switch_together(spark, tmp_path, monkeypatch):
    """An event file that can't be read leaves the climate of the run before."""
    from bloomline.plans import queries_jobs
    from bloomline.sources import wide_csv

    wh = jobs.Warehouse(spark, str(tmp_path), a.STATION_BASE, a.WIDTH)
    landing = queries_jobs.landing(spark, SF)
    jobs.run_raw(wh, landing, dt.datetime(2026, 1, 1), "shipments")
    before = wh.current()

    def broken(*args, **kwargs):
        raise RuntimeError("unreadable")

    monkeypatch.setattr(wide_csv, "read_wide_csv", broken)
    with pytest.raises(RuntimeError, match="unreadable"):
        jobs.run_raw(wh, landing, dt.datetime(2026, 1, 2), "shipments")
    assert wh.current() == before
