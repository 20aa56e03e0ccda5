"""Staging, marts, features and serving on small fixtures, against brute force."""

import datetime as dt
import itertools
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from bloomline.config import FIRST_BLOOM as A, FULL_BLOOM as B, REQUIRED_FEATURES
from bloomline.operators import features, marts, reshape, serving, staging

D, TS = dt.date, dt.datetime
EVENT = "location_code string, year int, event_type string, date_key date, day_of_year int, data_status string, source_name string"
CLIMATE = "station_code string, date_key date, mean_temp_c double, precipitation_mm double"


def half_up(x):
    return int(Decimal(x).quantize(Decimal(1), ROUND_HALF_UP))


def event(loc, year, kind, doy):
    day = D(year, 1, 1) + dt.timedelta(doy - 1) if doy else None
    return (loc, year, kind, day, doy, "observed", "t")


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [("k", TS(2026, 1, 1), 1), ("k", TS(2026, 1, 2), 2), ("k", None, 9),
         ("t", TS(2026, 1, 1), 1), ("t", TS(2026, 1, 1), 3), ("n", None, 5)],
        "key string, raw_ingested_at timestamp_ntz, v int")
    got = {r.key: r.v for r in staging.latest_per_key(df, ["key"], tie_break=["v"]).collect()}
    assert got == {"k": 2, "t": 3, "n": 5}
    plan = staging.latest_per_key(df, ["key"], tie_break=["v"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_stage_climate_drops_bad_months(spark):
    rows = [(m, y) for m in (0, 1, 12, 13, None) for y in (2001, None)]
    raw = spark.createDataFrame(
        [(" u", " S ", " 1 ", y, m, 1.0, 2.0, TS(2026, 1, 1)) for m, y in rows],
        "source_url string, station_name string, station_code string, year int, month int, "
        "mean_temp_c double, precipitation_mm double, raw_ingested_at timestamp_ntz")
    got = staging.stage_climate(raw).orderBy("month").collect()
    assert [(r.station_code, r.station_name, r.month_start_date) for r in got] == [
        ("1", "S", D(2001, 1, 1)), ("1", "S", D(2001, 12, 1))]


def test_stage_events_keeps_and_reports_bad_dates(spark):
    raw = spark.createDataFrame(
        [("1", "a ", 2025, d) for d in ("03-26", "02-30", "1326", None)],
        "station_code_raw string, location_name_raw string, year int, event_date_raw string",
    ).withColumns({c: F.lit("x") for c in ("event_type", "data_status", "source_name", "source_url", "rm_raw", "raw_ingested_at")})
    staged = staging.stage_events(raw)
    assert [r.day_of_year for r in staged.collect()] == [85, None, None, None]
    assert [r.event_date_raw for r in staging.impossible_dates(staged).collect()] == ["02-30"]


def brute_gap(rows):
    gaps = {}
    for x, y in itertools.product(rows, rows):
        if (x[0], x[1]) == (y[0], y[1]) and x[2] == A and y[2] == B and x[4] and y[4] and 0 <= y[4] - x[4] <= 30:
            gaps.setdefault(x[0], []).append(y[4] - x[4])
    return {k: (half_up(Decimal(sum(v)) / len(v)), len(v)) for k, v in gaps.items()}


def test_event_gap_bounds_and_rounding(spark):
    rows = [event("a", 2000 + i, A, 80) for i in range(4)]
    rows += [event("a", 2000 + i, B, 80 + gap) for i, gap in enumerate((-1, 0, 30, 31))]
    rows += [event("b", 2001, A, 80), event("b", 2001, B, 81), event("b", 2002, A, 80), event("b", 2002, B, 82)]
    got = {r.location_code: (r.avg_gap_days, r.obs_count) for r in marts.event_gap(spark.createDataFrame(rows, EVENT)).collect()}
    assert got == {"a": (15, 2), "b": (2, 2)} == brute_gap(rows)


def test_event_gap_with_a_hot_location_and_repeats(spark):
    rng = random.Random(7)
    rows = [event(rng.choice(["hot", "hot", "x", "y"]), rng.choice([2001, 2002]), rng.choice([A, B]),
                  rng.choice([None, *range(70, 120)])) for _ in range(400)]
    got = {r.location_code: (r.avg_gap_days, r.obs_count) for r in marts.event_gap(spark.createDataFrame(rows, EVENT)).collect()}
    assert got == brute_gap(rows)


def test_dimensions(spark):
    staged = spark.createDataFrame(
        [("47047", "S", D(2000, 1, 1)), ("47047", "S", D(2000, 5, 1)), ("47100", "T", D(2000, 5, 1))],
        "station_code string, station_name string, month_start_date date")
    meta = spark.createDataFrame([("47047", 1.0, 2.0)], "station_code string, latitude double, longitude double")
    got = {r.station_code: r for r in marts.dim_station(staged, meta).collect()}
    assert (got["47047"].location_code, got["47047"].latitude, got["47047"].record_count) == ("47", 1.0, 2)
    assert got["47100"].latitude is None
    assert {(r.date_key, r.quarter, r.season) for r in marts.dim_month(staged).collect()} == {
        (D(2000, 1, 1), 1, "Winter"), (D(2000, 5, 1), 2, "Spring")}


def test_dimensions_from_one_scan(spark, tmp_path):
    """The same rows as from a scan for each, missing keys and empty tables included."""
    rng = random.Random(6)
    some = lambda *values: rng.choice([None, *values])
    climate = [(some("47047", "47100"), some("S", "T"), some(D(2000, 1, 1), D(2000, 5, 1), D(1999, 12, 1))) for _ in range(60)]
    events = [(some("1", "2"), some("S", "T"), some(D(2000, 3, 31), D(2001, 4, 2)), some(2000, 2001)) for _ in range(60)]
    meta = spark.createDataFrame([("47047", 1.0, 2.0)], "station_code string, latitude double, longitude double")
    for i, n in enumerate((60, 1, 0)):
        path = f"{tmp_path}/climate{i}"
        spark.createDataFrame(climate[:n], "station_code string, station_name string, month_start_date date").repartition(3).write.parquet(path)
        staged = spark.read.parquet(path)
        dated = spark.createDataFrame(events[:n], "location_code string, location_name string, event_date date, year int").repartition(3)
        got = marts.climate_dimensions(staged, meta) | marts.event_dimensions(dated)
        want = {"dim_station": marts.dim_station(staged, meta), "dim_month": marts.dim_month(staged),
                "dim_location": marts.dim_location(dated), "dim_date": marts.dim_date(dated)}
        assert got.keys() == want.keys()
        for name, df in got.items():
            assert df.columns == want[name].columns and df.dtypes == want[name].dtypes
            assert sorted(map(str, df.collect())) == sorted(map(str, want[name].collect())), name
            # What is read back is the written groups, not the staged table.
            assert path not in df._jdf.queryExecution().executedPlan().toString()


def climate_rows(rng, codes, years):
    """Months with gaps, missing measures and repeated rows."""
    rows = []
    for code, y, m in itertools.product(codes, years, range(1, 13)):
        for _ in range(rng.choice([0, 1, 1, 1, 2])):
            rows.append((code, D(y, m, 1), rng.choice([None, round(rng.uniform(-5, 25), 1)]),
                         rng.choice([None, round(rng.uniform(0, 300), 1)])))
    return rows


def mean(values):
    values = [v for v in values if v is not None]
    return sum(values) / len(values) if values else None


def total(values):
    values = [v for v in values if v is not None]
    return sum(values) if values else None


def normals_of(climate):
    out = {}
    for loc, m in {(c[0][-3:], c[1].month) for c in climate}:
        base = [c for c in climate if c[0][-3:] == loc and c[1].month == m and 1991 <= c[1].year <= 2020]
        out[loc, m] = (mean(c[2] for c in base), mean(c[3] for c in base))
    return out


def season_of(months, fan=1):
    """Features of (month, t, p) rows of one season, each event row repeating them."""
    t = lambda *ms: [x[1] for x in months if x[0] in ms]
    p = lambda *ms: [x[2] for x in months if x[0] in ms]
    return (mean(t(9, 10, 11)), mean(t(12, 1, 2)), mean(t(1)), mean(t(2)), mean(t(3)),
            total(t(1, 2, 3) * fan), total(p(12, 1, 2) * fan))


def brute_training(events, climate, fanout):
    normals, out = normals_of(climate), {}
    dated = [e for e in events if e[3] and e[4]]
    for e in dated:
        loc = e[0].rjust(3, "0")
        months = []
        for c in climate:
            y, m = c[1].year, c[1].month
            if c[0][-3:] == loc and ((y == e[1] and m <= 3) or (y == e[1] - 1 and m >= 9)):
                nt, np_ = normals.get((loc, m), (None, None))
                months.append((m, nt if c[2] is None else c[2], np_ if c[3] is None else c[3]))
        fan = sum(x[0] == e[0] and x[1] == e[1] for x in dated) if fanout else 1
        f = season_of(months, fan)
        if all(v is not None for v in f[:6]):
            out[loc, e[1], e[2], e[4]] = f
    return out


@pytest.mark.parametrize("fanout", [False, True])
def test_training_features(spark, fanout):
    rng = random.Random(11)
    climate = climate_rows(rng, ["47047", "47401", "99401"], range(1989, 1996))
    events = [event(loc, y, k, doy) for loc in ("47", "401", "7") for y in range(1990, 1996)
              for k, doy in ((A, 85), (B, rng.choice([None, 93])))]
    got = features.training_features(
        spark.createDataFrame(events, EVENT), spark.createDataFrame(climate, CLIMATE), fanout)
    want = brute_training(events, climate, fanout)
    names = got.columns[7:]
    rows = {(r.location_code, r.year, r.event_type, r.day_of_year): [r[n] for n in names] for r in got.collect()}
    assert rows.keys() == want.keys() and rows
    for k, v in want.items():
        assert rows[k] == pytest.approx(list(v), nan_ok=True) if None not in v else [x is None for x in rows[k]] == [x is None for x in v]


def test_fanout_doubles_only_with_both_events(spark):
    climate = [("47047", D(y, m, 1), 1.0, 10.0) for y in (2000, 2001, 2002) for m in range(1, 13)]
    events = [event("47", 2001, A, 85), event("47", 2001, B, 93), event("47", 2002, A, 85)]
    frames = [spark.createDataFrame(events, EVENT), spark.createDataFrame(climate, CLIMATE)]
    sums = lambda fan: {(r.year, r.event_type): (r.january_march_cumulative_temp, r.winter_precipitation_mm)
                        for r in features.training_features(*frames, fan).collect()}
    assert set(sums(False).values()) == {(3.0, 30.0)}
    assert sums(True) == {(2001, A): (6.0, 60.0), (2001, B): (6.0, 60.0), (2002, A): (3.0, 30.0)}


def test_normals_use_the_baseline_years(spark):
    climate = [("47047", D(y, 1, 1), float(y), None) for y in (1990, 1991, 2020, 2021)]
    row = features.climate_normals(spark.createDataFrame(climate, CLIMATE)).collect()
    assert [(r.location_code, r.month, r.avg_temp, r.avg_precip) for r in row] == [("047", 1, 2005.5, None)]


def test_prediction_features_against_brute_force(spark):
    rng = random.Random(3)
    climate = climate_rows(rng, ["47047", "47401", "99401"], range(1994, 2002))
    events = [event(loc, 1999, A, 85) for loc in ("47", "401", "7")] + [event("8", 1999, B, 90)]
    got = features.prediction_features(
        spark.createDataFrame(events, EVENT), spark.createDataFrame(climate, CLIMATE), D(2001, 5, 1))
    normals, want = normals_of(climate), {}
    for loc in ("047", "401", "007"):
        months, estimated = [], False
        for m in (9, 10, 11, 12, 1, 2, 3):
            y = 2000 if m >= 9 else 2001
            actual = [c for c in climate if c[0][-3:] == loc and c[1] == D(y, m, 1)] or [(None, None, None, None)]
            nt, np_ = normals.get((loc, m), (None, None))
            for c in actual:
                estimated |= c[2] is None
                months.append((m, nt if c[2] is None else c[2], np_ if c[3] is None else c[3]))
        want[loc] = (*season_of(months), estimated)
    names = [*REQUIRED_FEATURES, "winter_precipitation_mm", "using_climate_normals"]
    rows = {r.location_code: tuple(r[n] for n in names) for r in got.collect()}
    assert rows.keys() == want.keys()
    for loc, expected in want.items():
        assert [x is None for x in rows[loc]] == [x is None for x in expected]
        assert [x for x in rows[loc] if x is not None] == pytest.approx([x for x in expected if x is not None])
    assert {r.year for r in got.collect()} == {2001}


@pytest.mark.parametrize("missing, estimated", [(None, False), ("temp", True), ("precip", False)])
def test_estimated_flag(spark, missing, estimated):
    rows = [("47047", D(y, m, 1), None if missing == "temp" and (y, m) == (2001, 2) else 1.0,
             None if missing == "precip" and (y, m) == (2001, 2) else 1.0)
            for y in (2000, 2001) for m in range(1, 13)]
    got = features.prediction_features(
        spark.createDataFrame([event("47", 2000, A, 85)], EVENT), spark.createDataFrame(rows, CLIMATE), D(2001, 5, 1))
    assert got.first().using_climate_normals is estimated


def test_historical_average(spark):
    rows = [event("a", y, A, 80 + y % 7) for y in range(1980, 2020)] + [event("b", 2000, A, 81), event("b", 2001, A, 82)]
    got = {r.location_code: r.avg_day_of_year for r in serving.historical_avg(spark.createDataFrame(rows, EVENT)).collect()}
    recent = [80 + y % 7 for y in range(2000, 2020)]
    assert got == {"a": half_up(Decimal(sum(recent)) / 20), "b": 82}


def test_trend(spark):
    rows = [event("a", y, A, 100 - (y - 2000)) for y in range(1990, 2021)] + [event("one", 2000, A, 80)]
    got = serving.trend(spark.createDataFrame(rows, EVENT)).collect()
    assert [(r.location_code, r.first_year, r.last_year) for r in got] == [("a", 2001, 2020)]
    assert (got[0].slope, got[0].trend_start, got[0].trend_end) == pytest.approx((-1, 99, 80))


def test_windows_and_calendar(spark):
    forecast = spark.createDataFrame(
        [("047", 2026, A, D(2026, 3, 25), True), ("100", 2026, A, D(2026, 3, 25), True), ("9", 2026, A, D(2026, 3, 25), False)],
        "location_code string, forecast_year int, event_type string, predicted_event_date date, is_best_model boolean")
    gaps = spark.createDataFrame([("100", 5)], "location_code string, avg_gap_days int")
    windows = serving.visit_windows(forecast, gaps)
    row = {r.location_code: r for r in windows.collect()}
    assert tuple(row["047"])[2:] == (
        D(2026, 3, 25), D(2026, 4, 2), D(2026, 4, 1), D(2026, 4, 3), D(2026, 3, 30), D(2026, 4, 7), D(2026, 4, 5), D(2026, 4, 12))
    assert row["100"].full_bloom == D(2026, 3, 30) and set(row) == {"047", "100"}
    days = reshape.calendar_spine(windows.where("location_code = '047'")).orderBy("day_index").collect()
    assert len(days) == 20 and days[0].day == D(2026, 3, 25) and days[-1].day == D(2026, 4, 13)
    assert (days[0].phase, days[-1].phase) == (0.0, 1.0)
    assert [d.day_index for d in days if d.is_peak] == [7, 8, 9] and [d.day_index for d in days if d.is_full_bloom] == [8]
    assert [d.day_index for d in days if d.is_visit] == list(range(5, 14))
