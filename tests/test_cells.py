"""Stored month cells: merging, replacement by station years, and loads against a full rebuild."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from bloomline.config import FEATURES
from bloomline.operators import cells, features
from bloomline.plans import adapters as a, jobs

CLIMATE = "station_code string, date_key date, mean_temp_c double, precipitation_mm double"
STATIONS = ["47001", "48001", "47002", None]  # the first two share a location code of three digits
AS_OF = dt.date(2003, 11, 1)


def rows_of(rng, years):
    measure = lambda: rng.choice([None, float(rng.randrange(-40, 200))])
    return [(s, dt.date(y, m, 1), measure(), measure())
            for s in STATIONS for y in years for m in range(1, 13) for _ in range(rng.randrange(3))]


def brute_cells(rows):
    found = {}
    for station, day, t, p in rows:
        if day is not None:
            found.setdefault((station, day.year, day.month), []).append((t, p))
    filled = lambda values: (len(v := [x for x in values if x is not None]), sum(v) if v else None)
    return sorted(((s or "", y, m), len(v), *filled(t for t, _ in v), *filled(p for _, p in v)) for (s, y, m), v in found.items())


def stored_cells(df):
    return sorted(((r.station_code or "", r.year, r.month), r.n, r.temp_n, r.temp_sum, r.precip_n, r.precip_sum) for r in df.collect())


def rounded(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else str(v) for v in r) for r in df.collect()), key=str)


@pytest.fixture
def events(spark):
    rows = [(loc, y, "sakura_bloom", dt.date(y, 4, 2), 92, "observed", "s") for loc in ("001", "2") for y in range(2000, 2004)]
    return spark.createDataFrame(
        rows, "location_code string, year int, event_type string, date_key date, day_of_year int, data_status string, source_name string")


@pytest.fixture
def wh(spark, tmp_path, events):
    made = jobs.Warehouse(spark, str(tmp_path), width=3)
    made.rebuild("marts/fact_events", events)
    return made


def test_stored_features_are_those_of_the_fact(spark, events):
    data = rows_of(random.Random(1), range(1999, 2004)) + [("47001", None, 1.0, 1.0)]
    climate = spark.createDataFrame(data, CLIMATE).repartition(3)
    stored = cells.station_cells(climate, 3)
    assert stored_cells(stored) == brute_cells(data)
    assert rounded(cells.cell_normals(stored).select("location_code", "month", "avg_temp", "avg_precip")) == rounded(
        features.climate_normals(climate, width=3))
    for fanout in (False, True):
        of_fact = features.training_features(events, climate, fanout, width=3)
        assert of_fact.count() > 0
        assert rounded(features.stored_training_features(events, stored, fanout, width=3)) == rounded(of_fact)
    of_fact = features.prediction_features(events, climate, AS_OF, width=3)
    assert rounded(features.stored_prediction_features(events, stored, AS_OF, width=3)) == rounded(of_fact)


@pytest.mark.parametrize("seed", [1])
def test_loads_equal_a_rebuild(spark, wh, events, seed):
    """Repeated loads of random station years leave what one load of the final rows leaves."""
    rng = random.Random(seed)
    final = {}
    for step in range(2):
        loaded = [(s, y) for s in STATIONS for y in range(1999, 2004) if step == 0 or rng.random() < 0.3]
        fresh = rows_of(rng, range(1999, 2004))
        load = {key: [r for r in fresh if (r[0], r[1].year) == key] for key in loaded}
        final |= load
        # A station year without any row is named, or its old cells would stay.
        jobs.load_climate(wh, spark.createDataFrame([r for v in load.values() for r in v], CLIMATE), AS_OF,
                          [key for key, v in load.items() if not v] or None)
    data = [r for v in final.values() for r in v]
    climate = spark.createDataFrame(data, CLIMATE)
    assert stored_cells(wh.read(jobs.CELLS)) == brute_cells(data)
    assert rounded(wh.read("marts/training_features")) == rounded(features.training_features(events, climate, width=3))
    assert rounded(wh.read("marts/prediction_features")) == rounded(
        features.prediction_features(events, climate, AS_OF, width=3))


def test_a_load_writes_only_its_years(spark, wh):
    data = rows_of(random.Random(4), range(1999, 2004))
    jobs.load_climate(wh, spark.createDataFrame(data, CLIMATE), AS_OF)
    parts = lambda: {n: folder for n, (_, folder) in wh.current().items() if n.startswith(jobs.CELLS)}
    before, kept = parts(), [r for r in data if r[0] != "47002" or r[1].year != 2001]
    jobs.load_climate(wh, spark.createDataFrame([("47002", dt.date(2001, 1, 1), 7.0, None)], CLIMATE), AS_OF)
    assert len(before) == 5 and sum(before[n] != folder for n, folder in parts().items()) == 1
    assert stored_cells(wh.read(jobs.CELLS)) == brute_cells([*kept, ("47002", dt.date(2001, 1, 1), 7.0, None)])


def test_empty_loads(spark, wh):
    nothing = spark.createDataFrame([], CLIMATE)
    jobs.load_climate(wh, nothing, AS_OF)
    assert wh.read("marts/training_features").count() == 0
    upcoming = wh.read("marts/prediction_features")
    assert upcoming.count() == 2 and upcoming.where(F.col("january_mean_temp").isNotNull()).count() == 0
    row = [("47001", dt.date(2001, 1, 1), 1.0, 1.0)]
    jobs.load_climate(wh, spark.createDataFrame(row, CLIMATE), AS_OF)
    jobs.load_climate(wh, nothing, AS_OF, [("47001", 2001), ("47009", 1980)])
    assert wh.read(jobs.CELLS).count() == 0
    assert wh.read(jobs.CELLS).columns[:4] == ["station_code", "location_code", "year", "month"]


def test_a_rebuild_drops_years_that_are_gone(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    wh = jobs.Warehouse(spark, str(tmp_path), a.STATION_BASE, a.WIDTH)
    for name, table in (("climate", a.staged_climate), ("events", a.staged_events), ("metadata", a.metadata)):
        wh.rebuild(f"staging/{name}", table(spark, sf))
    jobs.run_marts(wh, a.AUTUMN_RUN)
    fact = wh.read("marts/fact_climate")
    assert stored_cells(wh.read(jobs.CELLS)) == stored_cells(cells.station_cells(fact, a.WIDTH))
    jobs.load_climate(wh, spark.createDataFrame([("47000000001", dt.date(1950, 1, 1), 1.0, 1.0)], CLIMATE), a.AUTUMN_RUN)
    assert wh.read(jobs.CELLS).where("year = 1950").count() == 1
    jobs.run_marts(wh, a.AUTUMN_RUN)
    assert wh.read(jobs.CELLS).where("year = 1950").count() == 0
    assert stored_cells(wh.read(jobs.CELLS)) == stored_cells(cells.station_cells(fact, a.WIDTH))
