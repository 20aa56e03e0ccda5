"""The dashboard statements over the test tables; each agrees with the same SQL as its DataFrame form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bloomline.operators import marts
from bloomline.plans import adapters as a, queries_marts, queries_serving, statements  # noqa: F401  (their SQL is registered first)
from bloomline.plans.registry import ORACLES, query
from bloomline.session import materialize

TABLES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "forecast": a.baseline_forecast,
    "fact_events": a.events,
    "fact_climate": a.climate,
    "dim_station": a.dim_station,
    "dim_month": lambda spark, sf: marts.dim_month(a.staged_climate(spark, sf)),
}
#: Tables that a statement reads, and the values of the registered run.
RUNS: dict[str, tuple[list[str], dict]] = {
    "available_years": (["forecast"], {}),
    "station_list": (["dim_station"], {}),
    "climate_kpis": (["fact_climate"], {}),
    "bloom_history": (["fact_events"], {}),
    "bloom_temp_features": (["fact_events", "fact_climate"], {"width": a.WIDTH}),
    "bloom_forecast": (["forecast"], {"location_code": "7".zfill(a.WIDTH), "year": 2002}),
    "forecast_map": (["forecast", "dim_station"], {"width": a.WIDTH}),
    "bloom_gap": (["fact_events"], {}),
    "historical_avg_last_n": (["fact_events"], {"n": 5}),
}


def register(name: str, tables: list[str], values: dict) -> None:
    @query(f"statement_{name}", ORACLES[name])
    def _(spark: SparkSession, sf: str) -> DataFrame:
        return statements.run(spark, name, {t: TABLES[t](spark, sf) for t in tables}, **values)


for _name, (_tables, _values) in RUNS.items():
    register(_name, _tables, _values)


@query("statement_climate_timeseries", ORACLES["climate_timeseries"])
def climate_timeseries(spark: SparkSession, sf: str) -> DataFrame:
    staged = materialize(a.staged_climate(spark, sf), "staged-climate")
    return statements.run(spark, "climate_timeseries", {
        "fact_climate": marts.fact_climate(staged), "dim_month": marts.dim_month(staged),
        "dim_station": marts.dim_station(staged, a.metadata(spark, sf), a.STATION_BASE)})
