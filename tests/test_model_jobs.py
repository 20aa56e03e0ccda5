"""Checks, models and the complete run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bloomline.config import CANDIDATE_MODELS, FEATURES, FIRST_BLOOM
from bloomline.operators import features, forecast as fc, model, quality
from bloomline.plans import adapters as a, jobs, queries_jobs

SF = "/root/testdata/sf0.001"
NOW = dt.datetime(2026, 1, 2, 3, 4, 5)
#: Small fits for planted rows; the registered queries use the configured sizes.
SMALL_CANDIDATES = {
    "linear_regression": CANDIDATE_MODELS["linear_regression"],
    "random_forest": {**CANDIDATE_MODELS["random_forest"], "numTrees": 20},
    "hist_gradient_boosting": {**CANDIDATE_MODELS["hist_gradient_boosting"], "maxIter": 10},
}


def planted(spark, n=400):
    """Rows whose day of year is a line through two features."""
    df = spark.range(n).select(
        F.format_string("%03d", F.col("id") % 40).alias("location_code"),
        (1980 + F.floor(F.col("id") / 40)).cast("int").alias("year"),
        F.lit(FIRST_BLOOM).alias("event_type"),
        *[(F.abs(F.hash("id", F.lit(f))) % 1000 / 100.0).alias(f) for f in FEATURES],
    )
    noise = (F.abs(F.hash("location_code", "year")) % 100 / 100.0) - 0.5
    return df.withColumn("day_of_year", F.rint(100 - 2 * F.col(FEATURES[0]) - F.col(FEATURES[4]) + noise).cast("int"))


def test_validation(spark):
    df = planted(spark, 10)
    assert model.validate_features(df) is df
    with pytest.raises(ValueError, match="winter_precipitation_mm.*4"):
        model.validate_features(df.withColumn(
            "winter_precipitation_mm", F.when(F.col("location_code") >= "004", F.col("winter_precipitation_mm"))))
    with pytest.raises(ValueError, match="missing feature"):
        model.validate_features(df.drop(FEATURES[0]))
    with pytest.raises(ValueError, match="unknown model"):
        model.fit_final_model(df, "nope")
    with pytest.raises(ValueError, match="unknown model"):
        model.select_best_model(model.hash_split(df), {"nope": {}})


def test_split_is_stable_and_near_the_share(spark):
    df = planted(spark, 4000)
    counts = {r.split: r["count"] for r in model.hash_split(df).groupBy("split").count().collect()}
    assert 0.15 < counts["test"] / 4000 < 0.25
    again = model.hash_split(df.repartition(5)).join(model.hash_split(df), on=model.ROW_KEY + ["split"])
    assert again.count() == 4000
    folds = [r["count"] for r in model.cv_fold(df).groupBy("fold").count().collect()]
    assert len(folds) == 5 and min(folds) > 600


def test_metrics(spark):
    df = spark.createDataFrame(
        [("a", 10.0, 12.0), ("a", 20.0, 19.0), ("b", 30.0, 30.0)], "location_code string, y double, p double")
    row = model.regression_metrics(df, "y", "p").first()
    assert (row.mae_days, row.rmse_days, row.r2_score, row.evaluation_row_count) == pytest.approx(
        (1.0, (5 / 3) ** 0.5, 1 - 5 / 200, 3))
    assert [(r.location_code, r.mae_days, r.n_test_rows) for r in
            model.metrics_per_group(df, ["location_code"], "y", "p").collect()] == [("a", 1.5, 2)]


def test_champion_is_the_lowest_error(spark):
    metrics = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", 3.0)], "model_name string, cv_mae_days double")
    assert {r.model_name: r.is_best_model for r in model.choose(metrics).collect()} == {"a": True, "b": False, "c": False}


def test_candidates_recover_a_planted_line(spark):
    assert set(CANDIDATE_MODELS) == set(model.BUILDERS)
    rows, best, finals = model.select_best_model(model.hash_split(planted(spark)), SMALL_CANDIDATES, folds=2)
    assert [r["cv_mae_days"] for r in rows] == sorted(r["cv_mae_days"] for r in rows)
    assert rows[0]["model_name"] == "linear_regression" and rows[0]["r2_score"] > 0.9
    assert set(finals) == set(SMALL_CANDIDATES) and {r["model_type"] for r in rows} == {
        "LinearModel", "RandomForestRegressionModel", "BoostedTrees"}
    again = model.fit_final_model(planted(spark), "linear_regression")
    assert again.coefficients == pytest.approx(finals["linear_regression"].coefficients)
    scored = model.with_prediction(best, planted(spark))
    assert scored.where(F.isnan("prediction") | F.col("prediction").isNull()).count() == 0


def test_forecast_rows(spark):
    predicted = spark.createDataFrame(
        [("1", 2026, FIRST_BLOOM, True, "m", 92.5), ("2", 2026, FIRST_BLOOM, None, "m", 400.0),
         ("1", 2026, FIRST_BLOOM, False, "n", 93.5)],
        "location_code string, year int, event_type string, using_climate_normals boolean, model_name string, prediction double")
    selection = [{"model_name": "m", "rmse_days": 2.0, "mae_days": 1.0, "r2_score": 0.5},
                 {"model_name": "n", "rmse_days": 3.0, "mae_days": 2.0, "r2_score": 0.4}]
    station = spark.createDataFrame([("1", 0.25)], "location_code string, mae_days double")
    rows = fc.build_forecast(predicted, fc.model_rows(spark, selection, 7), NOW, station).collect()
    got = {(r.model_name, r.location_code): (r.predicted_day_of_year, str(r.predicted_event_date), r.station_mae_days,
                                             r.prediction_status, r.is_best_model, r.source_name) for r in rows}
    assert got == {
        ("m", "1"): (92, "2026-04-02", 0.25, "estimated", True, "model_m"),
        ("m", "2"): (366, "2027-01-01", 1.0, "predicted", True, "model_m"),
        ("n", "1"): (94, "2026-04-04", 2.0, "predicted", False, "model_n"),
    }
    assert rows[0].trained_at == NOW and rows[0].training_row_count == 7


def test_quality(spark):
    fact = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, None), (None, 5.0)], "k int, v double")
    dim = spark.createDataFrame([(1, "x"), (3, "y")], "k int, name string")
    assert quality.orphans(fact, dim, "k").first().unmatched == 2
    assert quality.orphans(fact.where("k = 1"), dim, "k").first().unmatched == 0
    assert {(r.name, r.records, r.avg_v) for r in quality.group_by_dim(fact, dim, "k", "name", "v").collect()} == {
        ("x", 2, 2.0), (None, 2, 5.0)}
    assert quality.reconcile(fact, dim, ("a", "b")).first().asDict() == {"a": 4, "b": 2, "difference": 2}
    report = quality.run_checks([
        quality.Check("nulls", quality.null_counts(fact, ["v"]).select("null_v"), lambda v: v == 0),
        quality.count_check("dup", quality.duplicate_keys(fact, ["k"])),
        quality.Check("info", quality.measure_range(fact, ["v"])),
    ]).orderBy("position", "metric").collect()
    assert [(r.check_name, r.metric, r.value, r.passed) for r in report] == [
        ("nulls", "null_v", 1.0, False), ("dup", "rows", 1.0, False),
        ("info", "max_v", 5.0, None), ("info", "min_v", 1.0, None)]


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    wh = jobs.Warehouse(spark, str(tmp_path_factory.mktemp("wh")), a.STATION_BASE, a.WIDTH)
    landing = queries_jobs.landing(spark, SF)
    run = lambda: jobs.run_all(wh, landing, a.AUTUMN_RUN, NOW, "shipments", {"linear_regression": {}}).collect()
    return wh, run(), run


def test_run_all_is_idempotent(finished):
    wh, report, run = finished
    read = lambda: sorted(map(str, wh.read("marts/forecast").drop("trained_at").collect()))
    before, raw = read(), wh.read("raw/events").count()
    again = run()
    assert read() == before and before and wh.read("raw/events").count() == raw
    key = lambda rows: sorted((r.position, r.metric, str(r.value), str(r.passed)) for r in rows)
    assert key(again) == key(report)


def test_run_all_passes_its_checks(finished):
    _, report, _ = finished
    failed = {r.check_name for r in report if r.passed is False}
    assert failed <= {"forecast: implausible days"}
    assert {"fact_climate: unique station_code, date_key", "dim_station: rows"} <= {r.check_name for r in report}


def test_null_precipitation_raises(spark):
    rows = planted(spark, 50).withColumn(FEATURES[6], F.when(F.col("year") > 1980, F.col(FEATURES[6])))
    with pytest.raises(ValueError, match="winter_precipitation_mm"):
        model.validate_features(model.training_set(rows))


def test_failed_marts_leave_the_old_ones(spark, tmp_path, monkeypatch):
    """All marts of a run appear with one commit; a run that fails midway leaves those of the run before."""
    wh = jobs.Warehouse(spark, str(tmp_path), a.STATION_BASE, a.WIDTH)
    for name, table in (("climate", a.staged_climate), ("events", a.staged_events), ("metadata", a.metadata)):
        wh.rebuild(f"staging/{name}", table(spark, SF))
    jobs.run_marts(wh, a.AUTUMN_RUN)
    before = {name: sorted(map(str, wh.read(f"marts/{name}").collect())) for name in jobs.CHECKED}
    wh.rebuild("staging/events", wh.read("staging/events").limit(3))

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(features, "prediction_features", broken)
    with pytest.raises(RuntimeError, match="lost"):
        jobs.run_marts(wh, a.AUTUMN_RUN)
    assert before == {name: sorted(map(str, wh.read(f"marts/{name}").collect())) for name in jobs.CHECKED}
    monkeypatch.undo()
    jobs.run_marts(wh, a.AUTUMN_RUN)
    assert wh.read("marts/fact_events").count() <= 3


def test_forecast_without_training_rows(spark, finished, tmp_path):
    wh = jobs.Warehouse(spark, str(tmp_path))
    done = finished[0]
    wh.rebuild("marts/training_features", done.read("marts/training_features").limit(0))
    assert jobs.run_forecast(wh, NOW) is None
