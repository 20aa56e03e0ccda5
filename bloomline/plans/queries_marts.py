"""Staging, star schema, features and model-input queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from bloomline.config import CANDIDATE_MODELS, FEATURES, TARGET
from bloomline.functions.labels import prediction_status
from bloomline.operators import cells, features, forecast as fc, marts, model
from bloomline.operators.linear import fold_models, gram_sums, held_out_prediction
from bloomline.plans import adapters as a, jobs
from bloomline.plans.registry import query
from bloomline.plans.sql import FEATURE_DOUBLES, FORECAST_DOUBLES, pad, prediction_sql, with_, with_lines
from bloomline.session import materialize, scratch_path

W = a.WIDTH


@query("stg_climate", with_("stg_climate", """
SELECT station_code, station_name, year, month, month_start_date, mean_temp_c, precipitation_mm,
       source_url, strftime(raw_ingested_at, '%Y-%m-%d %H:%M:%S') AS raw_ingested_at
FROM stg_climate"""), doubles="mean_temp_c precipitation_mm")
def _(spark, sf):
    return a.staged_climate(spark, sf)


@query("stg_events", with_("stg_events", """
SELECT location_code, location_name, year, event_date, day_of_year, event_type, data_status,
       source_name, source_url, rm_raw, event_date_raw, '2001-11-04 00:00:00' AS raw_ingested_at
FROM stg_events"""))
def _(spark, sf):
    return a.staged_events(spark, sf)


@query("dim_date", with_("dim_date", "SELECT * FROM dim_date"))
def _(spark, sf):
    return marts.dim_date(a.staged_events(spark, sf))


@query("dim_month", with_("dim_month", "SELECT * FROM dim_month"))
def _(spark, sf):
    return marts.dim_month(a.staged_climate(spark, sf))


@query("dim_station", with_("dim_station", "SELECT * FROM dim_station"), doubles="latitude longitude")
def _(spark, sf):
    return a.dim_station(spark, sf)


@query("dim_location", with_("dim_location", "SELECT * FROM dim_location"))
def _(spark, sf):
    return marts.dim_location(a.staged_events(spark, sf))


def all_dimensions(spark, sf):
    return jobs.build_dimensions(a.staged_climate(spark, sf), a.staged_events(spark, sf), a.metadata(spark, sf), a.STATION_BASE)


@query("dimensions_one_scan", with_("dim_station dim_month dim_location dim_date", """
SELECT 'dim_station' AS dim, station_code || '|' || location_code || '|' || station_name AS member, first_observation AS first_day,
       last_observation AS last_day, record_count AS n, latitude, longitude, CAST(NULL AS VARCHAR) AS season FROM dim_station
UNION ALL SELECT 'dim_month', year || '|' || month || '|' || quarter, date_key, date_key, NULL, NULL, NULL, season FROM dim_month
UNION ALL SELECT 'dim_location', location_code || '|' || location_name, make_date(first_year, 1, 1), make_date(last_year, 1, 1),
       record_count, NULL, NULL, NULL FROM dim_location
UNION ALL SELECT 'dim_date', year || '|' || month || '|' || day || '|' || day_of_year || '|' || quarter, date_key, date_key,
       NULL, NULL, NULL, season FROM dim_date"""), doubles="latitude longitude")
def _(spark, sf):
    """All four dimensions, from one scan of each staged table."""
    dims, none = all_dimensions(spark, sf), F.lit(None)

    def members(name, keys, first, last, n=none, latitude=none, longitude=none, season=none):
        return dims[name].select(
            F.lit(name).alias("dim"), F.concat_ws("|", *keys).alias("member"), first.alias("first_day"), last.alias("last_day"),
            n.cast("long").alias("n"), latitude.cast("double").alias("latitude"), longitude.cast("double").alias("longitude"),
            season.cast("string").alias("season"))

    day, january = F.col("date_key"), lambda year: F.make_date(F.col(year), F.lit(1), F.lit(1))
    return (
        members("dim_station", ["station_code", "location_code", "station_name"], F.col("first_observation"), F.col("last_observation"),
                F.col("record_count"), F.col("latitude"), F.col("longitude"))
        .unionByName(members("dim_month", ["year", "month", "quarter"], day, day, season=F.col("season")))
        .unionByName(members("dim_location", ["location_code", "location_name"], january("first_year"), january("last_year"), F.col("record_count")))
        .unionByName(members("dim_date", ["year", "month", "day", "day_of_year", "quarter"], day, day, season=F.col("season")))
    )


@query("fact_climate", with_("fact_climate", "SELECT * FROM fact_climate"),
       doubles="mean_temp_c precipitation_mm")
def _(spark, sf):
    return marts.fact_climate(a.staged_climate(spark, sf))


@query("fact_events", with_("fact_events", "SELECT * FROM fact_events"))
def _(spark, sf):
    return marts.fact_events(a.staged_events(spark, sf))


@query("bloom_gap", with_("gap", "SELECT * FROM gap"))
def _(spark, sf):
    return marts.event_gap(a.events(spark, sf))


@query("climate_normals", with_("normals", "SELECT * FROM normals"), doubles="avg_temp avg_precip")
def _(spark, sf):
    return features.climate_normals(a.climate(spark, sf), width=W)


@query("fill_with_normals", with_("climate normals", f"""
SELECT c.station_code, c.date_key, n.location_code,
       coalesce(c.mean_temp_c, n.avg_temp) AS mean_temp_c,
       coalesce(c.precipitation_mm, n.avg_precip) AS precipitation_mm
FROM climate c LEFT JOIN normals n
  ON n.location_code = right(c.station_code, {W}) AND n.month = month(c.date_key)"""),
       doubles="mean_temp_c precipitation_mm")
def _(spark, sf):
    climate = a.climate(spark, sf)
    return features.fill_with_normals(climate, features.climate_normals(climate, width=W), W)


@query("training_features", with_("training", "SELECT * FROM training"), doubles=FEATURE_DOUBLES)
def training(spark, sf):
    return features.training_features(a.events(spark, sf), a.climate(spark, sf), width=W)


@query("training_features_fanout",
       with_("training_fan", "SELECT * EXCLUDE (fan) FROM training_fan"), doubles=FEATURE_DOUBLES)
def _(spark, sf):
    return features.training_features(
        a.events(spark, sf), a.climate(spark, sf), event_fanout=True, width=W
    )


@query("prediction_grid", with_("events", f"""
SELECT l.location_code, 2002 AS forecast_year, CAST(g.m AS INTEGER) AS month, CAST(g.y AS INTEGER) AS year
FROM (SELECT DISTINCT {pad('location_code')} AS location_code
      FROM events WHERE event_type = 'sakura_bloom') AS l
CROSS JOIN (VALUES (9, 2001), (10, 2001), (11, 2001), (12, 2001), (1, 2002), (2, 2002), (3, 2002)) AS g(m, y)"""))
def _(spark, sf):
    return features.prediction_grid(a.events(spark, sf), a.AUTUMN_RUN, width=W)


def prediction(spark, sf, as_of):
    return features.prediction_features(a.events(spark, sf), a.climate(spark, sf), as_of, width=W)


@query("prediction_features", prediction_sql(2002), doubles=FEATURE_DOUBLES)
def _(spark, sf):
    return prediction(spark, sf, a.AUTUMN_RUN)


@query("prediction_features_spring", prediction_sql(2001), doubles=FEATURE_DOUBLES)
def _(spark, sf):
    return prediction(spark, sf, a.SPRING_RUN)


@query("prediction_status", f"""
SELECT location_code, CASE WHEN using_climate_normals THEN 'estimated' ELSE 'predicted' END AS prediction_status
FROM ({prediction_sql(2001)}) AS p""")
def _(spark, sf):
    return prediction(spark, sf, a.SPRING_RUN).select(
        "location_code", prediction_status(F.col("using_climate_normals")).alias("prediction_status")
    )


# --- Stored month cells

def forwarded_warehouse(spark, sf):
    """Cells and features of a first load, brought forward by a second one.

    The first load has the even years of one half of the stations wrong, lacks
    those of the other half, and has a year that the second load clears.
    """
    wh = jobs.Warehouse(spark, scratch_path(spark, "month-cells"), a.STATION_BASE, W)
    wh.rebuild("marts/fact_events", a.events(spark, sf))
    climate = materialize(a.climate(spark, sf), "climate")
    even, late = F.year("date_key") % 2 == 0, F.col("station_code").cast("long") % 2 == 0
    withdrawn = climate.orderBy("station_code").limit(1).select("station_code", F.make_date(F.lit(1950), F.lit(2), F.lit(1)).alias("date_key"),
                                                               F.lit(9.0).alias("mean_temp_c"), F.lit(9.0).alias("precipitation_mm"))
    wrong = climate.where(~(even & late)).withColumn("mean_temp_c", F.when(even, F.col("mean_temp_c") + 1).otherwise(F.col("mean_temp_c")))
    jobs.load_climate(wh, wrong.unionByName(withdrawn), a.AUTUMN_RUN)
    jobs.load_climate(wh, climate.where(even), a.AUTUMN_RUN, [(r["station_code"], 1950) for r in withdrawn.collect()])
    return wh


@query("month_cells_forwarded", with_("climate", f"""
SELECT station_code, right(station_code, {W}) AS location_code, CAST(year(date_key) AS INTEGER) AS year,
       CAST(month(date_key) AS INTEGER) AS month, count(*) AS n, count(mean_temp_c) AS temp_n, sum(mean_temp_c) AS temp_sum,
       count(precipitation_mm) AS precip_n, sum(precipitation_mm) AS precip_sum
FROM climate GROUP BY 1, 2, 3, 4"""), doubles="temp_sum precip_sum")
def _(spark, sf):
    """Stored cells after a second load: those of the final rows."""
    return forwarded_warehouse(spark, sf).read(jobs.CELLS)


@query("climate_normals_stored", with_("normals", "SELECT * FROM normals"), doubles="avg_temp avg_precip")
def _(spark, sf):
    return cells.cell_normals(cells.station_cells(a.climate(spark, sf), W))


@query("training_features_forwarded", with_("training", "SELECT * FROM training"), doubles=FEATURE_DOUBLES)
def _(spark, sf):
    """Training features from cells that a second load brought forward."""
    return forwarded_warehouse(spark, sf).read("marts/training_features")


@query("prediction_features_forwarded", prediction_sql(2002), doubles=FEATURE_DOUBLES)
def _(spark, sf):
    return forwarded_warehouse(spark, sf).read("marts/prediction_features")


# --- Model input, splits, metrics, forecasts

@query("model_training_set", with_("training", """
SELECT * FROM training WHERE event_type = 'sakura_bloom'"""), doubles=FEATURE_DOUBLES)
def _(spark, sf):
    return model.training_set(training(spark, sf))


@query("feature_null_counts", with_("training", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {f} IS NULL) AS {f}" for f in FEATURES) + " FROM training"))
def _(spark, sf):
    return model.feature_null_counts(training(spark, sf))


@query("hash_split", with_("bloom_rows", "SELECT location_code, year, event_type, split FROM bloom_rows"))
def _(spark, sf):
    return a.bloom_rows(spark, sf).select("location_code", "year", "event_type", "split")


@query("cv_fold_assignment", with_("bloom_rows", """
SELECT location_code, year, event_type, fold FROM bloom_rows"""))
def _(spark, sf):
    return a.bloom_rows(spark, sf).select("location_code", "year", "event_type", "fold")


def scores(spark, sf):
    return a.baseline_scores(a.stored_bloom_rows(spark, sf))


@query("regression_metrics", with_("model_metrics", """
SELECT model_name, mae_days, rmse_days, r2_score, evaluation_row_count FROM model_metrics"""),
       doubles="mae_days rmse_days r2_score")
def _(spark, sf):
    return model.regression_metrics(scores(spark, sf), by=["model_name"])


@query("metrics_per_group", with_("scores", """
SELECT model_name, location_code, avg(abs(prediction - day_of_year)) AS mae_days,
       sqrt(avg((prediction - day_of_year) * (prediction - day_of_year))) AS rmse_days,
       count(*) AS n_test_rows
FROM scores GROUP BY model_name, location_code HAVING count(*) >= 2"""), doubles="mae_days rmse_days")
def _(spark, sf):
    return model.metrics_per_group(scores(spark, sf), ["model_name", "location_code"])


@query("champion_select", with_("ranked_models", """
SELECT model_name, mae_days, rmse_days, r2_score, evaluation_row_count, cv_mae_days, is_best_model
FROM ranked_models"""), doubles="mae_days rmse_days r2_score cv_mae_days")
def _(spark, sf):
    return model.choose(a.baseline_metrics(scores(spark, sf)))


@query("station_extremes", with_("station_mae", """
SELECT (SELECT location_code FROM station_mae ORDER BY station_mae, location_code LIMIT 1) AS best_station,
       min(station_mae) AS best_mae,
       (SELECT location_code FROM station_mae ORDER BY station_mae DESC, location_code DESC LIMIT 1) AS worst_station,
       max(station_mae) AS worst_mae, count(*) AS stations
FROM station_mae"""), doubles="best_mae worst_mae")
def _(spark, sf):
    scored = materialize(scores(spark, sf), "scores")
    best = model.choose(a.baseline_metrics(scored)).where("is_best_model").select("model_name")
    # A single row.
    of_best = scored.join(F.broadcast(best), on="model_name", how="left_semi")
    return model.station_extremes(model.metrics_per_group(of_best, ["location_code"]))


@query("forecast_fact", with_("forecast", """
SELECT * FROM forecast WHERE is_best_model"""), doubles=FORECAST_DOUBLES)
def _(spark, sf):
    return a.baseline_forecast(spark, sf).where("is_best_model")


@query("forecast_all_models", with_("forecast", "SELECT * FROM forecast"), doubles=FORECAST_DOUBLES)
def _(spark, sf):
    return a.baseline_forecast(spark, sf)


def complete_rows(spark, sf):
    """Training rows that may be fitted; a NULL feature is an error, never a dropped row."""
    rows = materialize(model.training_set(training(spark, sf)), "training-rows")
    return model.validate_features(rows)


def model_forecast(spark, sf, name):
    """Measure a candidate on held-out rows, refit it on all, forecast the autumn run."""
    rows = model.hash_split(complete_rows(spark, sf))
    measured = model.with_prediction(model.fit_final_model(rows.where("split = 'train'"), name), rows.where("split = 'test'"))
    metrics = model.regression_metrics(measured).first().asDict()
    fitted = model.fit_final_model(rows, name)
    upcoming = model.validate_features(materialize(model.prediction_set(prediction(spark, sf, a.AUTUMN_RUN)), "upcoming"))
    predicted = model.with_prediction(fitted, upcoming).withColumn("model_name", F.lit(name))
    models = fc.model_rows(spark, [{"model_name": name, **metrics}], rows.count())
    return fc.build_forecast(predicted, models, a.RUN_TIME)


@query("model_linear")
def _(spark, sf):
    return model_forecast(spark, sf, "linear_regression")


@query("model_random_forest")
def _(spark, sf):
    return model_forecast(spark, sf, "random_forest")


@query("model_gbt")
def _(spark, sf):
    return model_forecast(spark, sf, "hist_gradient_boosting")


def stored_artifact(spark, sf, candidates):
    """Choose among candidates, store the winner, and read it back: its document and its forecasts."""
    split = model.hash_split(complete_rows(spark, sf))
    rows, best, _ = model.select_best_model(split, candidates)
    path = scratch_path(spark, "artifact")
    fc.save_artifact(best, fc.metadata_row(spark, rows, split.count(), a.RUN_TIME), path)
    return spark.read.json(f"{path}/metadata"), model.load_model(spark, rows[0]["model_name"], f"{path}/model"), split


@query("model_artifact_metadata")
def _(spark, sf):
    metadata, reloaded, split = stored_artifact(spark, sf, CANDIDATE_MODELS)
    scored = model.regression_metrics(model.with_prediction(reloaded, split.where("split = 'test'"))).select(
        F.col("mae_days").alias("reloaded_mae_days"))
    # A single row.
    return metadata.select(
        "model_name", "model_version", "training_row_count", "selection_metric", "saved_at_utc",
        F.size("features").alias("n_features"), F.size("selection_results").alias("n_candidates"), "metrics.mae_days",
    ).join(F.broadcast(scored))


LINEAR = {"linear_regression": CANDIDATE_MODELS["linear_regression"]}


@query("linear_cv_folds", with_lines("""
SELECT fold, avg(abs(prediction - y)) AS mae_days, count(*) AS n_rows FROM lines
WHERE k = fold AND split = 'train' GROUP BY fold"""), doubles="mae_days")
def _(spark, sf):
    """Validation error of each fold, all folds from one pass of sums."""
    rows = model.cv_fold(model.hash_split(complete_rows(spark, sf)))
    left_out, _, _ = fold_models(gram_sums(rows, ["split", "fold"], FEATURES, TARGET), FEATURES)
    return rows.where("split = 'train'").groupBy("fold").agg(
        F.avg(F.abs(held_out_prediction(left_out) - F.col(TARGET))).alias("mae_days"), F.count("*").alias("n_rows"))


@query("linear_selection", with_lines("""
SELECT 'linear_regression' AS model_name, cv.*, h.*
FROM (SELECT avg(mae) AS cv_mae_days, stddev_pop(mae) AS cv_mae_std FROM (
        SELECT avg(abs(prediction - y)) AS mae FROM lines WHERE k = fold AND split = 'train' GROUP BY fold) AS folds) AS cv,
     (SELECT avg(abs(prediction - y)) AS mae_days, sqrt(avg((prediction - y) * (prediction - y))) AS rmse_days,
             1 - avg((prediction - y) * (prediction - y)) / var_pop(y) AS r2_score, count(*) AS evaluation_row_count
      FROM lines WHERE k = 5 AND split = 'test') AS h"""),
       doubles="cv_mae_days cv_mae_std mae_days rmse_days r2_score")
def _(spark, sf):
    """Mean and spread of the validation errors, and the held-out measures of the fit on the training rows."""
    rows, _, _ = model.select_best_model(model.hash_split(complete_rows(spark, sf)), LINEAR)
    names = "model_name string, cv_mae_days double, cv_mae_std double, mae_days double, rmse_days double, r2_score double, evaluation_row_count long"
    return spark.createDataFrame([[r[c.split()[0]] for c in names.split(", ")] for r in rows], names)


@query("linear_forecast", with_lines("""
SELECT location_code, CAST(year AS INTEGER) AS year, prediction FROM lines WHERE k = 6 AND split = 'upcoming'"""), doubles="prediction")
def _(spark, sf):
    """The candidate refitted on all rows, applied to the coming season."""
    _, _, finals = model.select_best_model(model.hash_split(complete_rows(spark, sf)), LINEAR)
    upcoming = materialize(model.prediction_set(prediction(spark, sf, a.AUTUMN_RUN)), "upcoming")
    return model.with_prediction(finals["linear_regression"], model.validate_features(upcoming)).select("location_code", "year", "prediction")


@query("linear_artifact", with_lines("""
SELECT 'linear_regression' AS model_name, 'v3' AS model_version, (SELECT count(*) FROM lines WHERE k = 6 AND split <> 'upcoming') AS training_row_count,
       7 AS n_features, 1 AS n_candidates, avg(abs(prediction - y)) AS mae_days, avg(prediction) AS avg_prediction
FROM lines WHERE k = 5 AND split = 'test'"""), doubles="mae_days avg_prediction")
def _(spark, sf):
    """Document of the stored linear model, and what the model read back predicts for the held-out rows."""
    metadata, reloaded, split = stored_artifact(spark, sf, LINEAR)
    scored = model.with_prediction(reloaded, split.where("split = 'test'")).agg(F.avg("prediction").alias("avg_prediction"))
    # A single row.
    return metadata.select("model_name", "model_version", "training_row_count", F.size("features").alias("n_features"),
                           F.size("selection_results").alias("n_candidates"), "metrics.mae_days").join(F.broadcast(scored))
