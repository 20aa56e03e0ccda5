"""Edge cases of the cleaners, calendar rules, codes and labels."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bloomline.functions import codes, dates, labels, text

D = dt.date


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize("fn, pairs", [
    (text.clean_text, {"": None, " - ": None, "—": None, "－": None, "―": None, "nan": None,
                       "None": None, None: None, " 　A b　": "A b", "--": "--"}),
    (text.normalize_mmdd, {"521.0": "05-21", "326": "03-26", "1231": "12-31", "0": None, "0.0": None,
                           "1326": "1326", "399": "399", "Mar 26": "Mar 26", "３２６": "03-26",
                           " 402 ": "04-02", "3/26": "3/26", "12": "12", "-": None, "230": "02-30",
                           "100": "100", "15.0": "15"}),
    (text.extract_year, {"2026年": 2026, "Year 1999": 1999, "1899": None, "x": None, "": None, "20260": 2026}),
    (text.clean_numeric, {"5.1 ]": 5.1, "12.5)": 12.5, "　": None, "--": None, "-3.2": -3.2, "": None,
                          "1.2.3": None, None: None, "×": None}),
    (text.month_number, {"Jan": 1, "Dec": 12, "Annual": None, None: None}),
    (text.parse_coordinate, {"35o39.2'N": 35.653333, "35o30.0'S": -35.5, "x": None, "136°03.7′E": 136.061667,
                             "10 o 30' W": -10.5, None: None, "35º39.2’N": 35.653333}),
    (text.normalize_whitespace, {"  a \n b ": "a b", "": ""}),
])
def test_text(spark, fn, pairs):
    assert apply(spark, fn, list(pairs)) == list(pairs.values())


def test_cleaners_never_emit_nan(spark):
    out = apply(spark, text.clean_numeric, ["nan", "NaN", "inf", "."])
    assert out == [None] * 4


def test_frame_cleaners(spark):
    df = spark.createDataFrame(
        [("a", " ", None, 1), ("b", "x", None, 2)], "`地点` string, v string, empty string, n int"
    )
    out = text.rename_aliases(text.blank_to_null(text.drop_empty_columns(df)))
    assert out.columns == ["location_name_raw", "v", "n"]
    assert [r.v for r in out.orderBy("n").collect()] == [None, "x"]
    other = spark.createDataFrame([("a", 1)], "Place string, n int")
    assert text.rename_aliases(other).columns == ["location_name_raw", "n"]


def test_month_day(spark):
    df = spark.createDataFrame(
        [(2025, "03-26"), (2025, "02-30"), (2025, "1326"), (2025, None), (2024, " 2-29 "), (2023, "2-29")],
        "y int, raw string",
    )
    got = [r.d for r in df.select(dates.month_day_to_date(F.col("y"), F.col("raw")).alias("d")).collect()]
    assert got == [D(2025, 3, 26), None, None, None, D(2024, 2, 29), None]


def test_season(spark):
    assert apply(spark, dates.season, [*range(1, 13), None, 13], "int") == (
        ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter", None, None]
    )


def test_forecast_year(spark):
    days = [D(2026, 5, 31), D(2026, 6, 1), D(2026, 12, 31), D(2026, 1, 1)]
    assert apply(spark, dates.forecast_year, days, "date") == [2026, 2027, 2027, 2026]


@pytest.mark.parametrize("years, expected", [([2024, 2025], 2025), ([2026, 2027], 2026), ([2025, 2028], 2028)])
def test_active_year(spark, years, expected):
    df = spark.createDataFrame([(y,) for y in years], "forecast_year int")
    assert dates.active_year(df, D(2026, 3, 1)).first().active_year == expected


def test_predicted_day(spark):
    values = [0.4, 92.5, 93.5, 400.0, -7.0]
    assert apply(spark, dates.predicted_doy, values, "double") == [1, 92, 94, 366, 1]
    to_date = lambda c: dates.doy_to_date(F.lit(2026), dates.predicted_doy(c))
    assert apply(spark, to_date, values[:4], "double") == [
        D(2026, 1, 1), D(2026, 4, 2), D(2026, 4, 4), D(2027, 1, 1)
    ]


def test_day_of_year(spark):
    assert apply(spark, F.dayofyear, [D(2024, 12, 31), D(2023, 12, 31)], "date") == [366, 365]


def test_labels(spark):
    days = [D(2026, 4, 5), None]
    assert apply(spark, dates.date_label, days, "date") == ["05 Apr 2026", "N/A"]
    assert apply(spark, lambda c: dates.date_label(c, "d MMM"), days, "date") == ["5 Apr", "N/A"]
    spread = lambda c: dates.range_label(c, F.date_add(c, 4))
    assert apply(spark, spread, days, "date") == ["05 Apr – 09 Apr 2026", "Not available"]


def test_codes(spark):
    assert apply(spark, codes.location_code, ["47047"]) == ["047"]
    assert apply(spark, codes.location_number, ["47047"]) == ["47"]
    assert apply(spark, codes.pad_location, ["47", "401"]) == ["047", "401"]


def test_classes(spark):
    delta = lambda c: labels.anomaly_class(c, F.lit(100))
    assert apply(spark, delta, [98, 99, 100, 101, 102, None], "int") == [
        "earlier", "on par", "on par", "on par", "later", "none"
    ]
    own = lambda c: labels.reliability_class(c, F.lit(None).cast("double"))
    assert apply(spark, own, [20.5, 20.0, 2.5, 3.5, None], "double") == ["low", "±20 d", "±2 d", "±4 d", "none"]
    # Means of the same errors, added up in another order.
    assert apply(spark, own, [13.499999999999998, 12.500000000000002, 20.000000000000004], "double") == ["±14 d", "±12 d", "±20 d"]
    assert apply(spark, labels.label_lookup, ["random_forest", "other"]) == ["Random Forest", "other"]
    assert apply(spark, labels.prediction_status, [True, False, None], "boolean") == [
        "estimated", "predicted", "predicted"
    ]


def test_visit_spots(spark):
    from bloomline.operators.serving import spots_table, visit_spots

    stations = spark.createDataFrame([("Tokyo",), ("Nowhere",)], "station_name string")
    spots = {"TOKYO": [("East Garden", "North"), ("River Walk", "South")], "ELSEWHERE": [("Hill", "West")]}
    rows = visit_spots(stations, spots_table(spark, spots)).collect()
    assert {(r.station_name, r.spot) for r in rows} == {("Tokyo", "East Garden"), ("Tokyo", "River Walk")}
