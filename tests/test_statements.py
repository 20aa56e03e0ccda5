"""Statements with bound parameters against their DataFrame forms."""

import pytest
from pyspark.sql import functions as F

from bloomline.operators import marts, serving
from bloomline.plans import adapters as a, statements
from bloomline.session import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return {name: materialize(table(spark, SF), name) for name, table in (
        ("fact_events", a.events), ("fact_climate", a.climate), ("forecast", a.baseline_forecast), ("dim_station", a.dim_station))}


def rows(df):
    return sorted(map(str, df.collect()))


def test_values_of_one_place(spark, tables):
    events, climate = tables["fact_events"], tables["fact_climate"]
    place = events.where("event_type = 'sakura_fullbloom'").first()["location_code"]
    of = lambda df: df.where(F.col("location_code") == place)
    history = statements.run(spark, "bloom_history", {"fact_events": events}, location_code=place, event_type="sakura_fullbloom")
    assert rows(history) == rows(of(serving.event_history(events, "sakura_fullbloom"))) != []
    gap = statements.run(spark, "bloom_gap", {"fact_events": events}, location_code=place, most_days=200)
    assert rows(gap) == rows(of(marts.event_gap(events, high=200)))
    mean = statements.run(spark, "historical_avg_last_n", {"fact_events": events}, location_code=place, n=2)
    assert rows(mean) == rows(of(serving.historical_avg(events, n=2)))
    station = climate.first()["station_code"]
    kpis = statements.run(spark, "climate_kpis", {"fact_climate": climate}, station_code=station)
    assert rows(kpis.select(sorted(kpis.columns))) == rows(
        serving.climate_kpis(climate).where(F.col("station_code") == station).select(sorted(kpis.columns))) != []
    best = statements.run(spark, "bloom_forecast", {"forecast": tables["forecast"]}, location_code="7".zfill(a.WIDTH), year=2002)
    assert rows(best) == rows(serving.best_forecast(tables["forecast"], "7".zfill(a.WIDTH), 2002)) != []
    maps = {"forecast": tables["forecast"], "dim_station": tables["dim_station"]}
    assert statements.run(spark, "forecast_map", maps, year=1990, width=a.WIDTH).count() == 0
    located = statements.run(spark, "forecast_map", maps, year=2002, width=a.WIDTH)
    assert rows(located.select(sorted(located.columns))) == rows(
        serving.forecast_map(tables["forecast"], tables["dim_station"], width=a.WIDTH).select(sorted(located.columns)))


def test_values_are_bound(spark, tables):
    odd = "x' OR '1' = '1"
    assert statements.run(spark, "bloom_history", {"fact_events": tables["fact_events"]}, location_code=odd).count() == 0
    with pytest.raises(ValueError, match="unknown parameters"):
        statements.run(spark, "bloom_history", {"fact_events": tables["fact_events"]}, place="x")
    found = statements.run(spark, "bloom_history", {"fact_events": tables["fact_events"]}, location_code="7")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    assert "EqualTo(location_code,7)" in found._jdf.queryExecution().explainString(mode)


def test_no_view_is_left(spark, tables):
    before = {t.name for t in spark.catalog.listTables()}
    statements.run(spark, "station_list", {"dim_station": tables["dim_station"]})
    assert {t.name for t in spark.catalog.listTables()} == before
