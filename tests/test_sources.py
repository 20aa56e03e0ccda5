"""Wide CSV, stored pages, declared tables and sinks."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from bloomline.functions.text import rename_aliases
from bloomline.operators import reshape
from bloomline.schemas import FORECAST, STATION_METADATA
from bloomline.sources import contracts, html, page_tables, sinks, wide_csv

CSV = "\n".join([
    "Flowering dates,,,,,,",
    "番号,地点名,1953,rm,1954.0,rm,",
    "401,A,521.0,8,0,0,",
    "47,B,-,,1231,8,",
    "12, ,326,8,401,8,",
])


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "wide.csv"
    path.write_text(CSV, encoding="utf-8")
    return str(path)


def test_header_repair():
    assert wide_csv.repair_header(["番号", "1953", "rm", "2026.0", "rm", "", "", "rm"]) == [
        "番号", "1953", "1953rm", "2026", "2026rm", "", "_1", "rm"
    ]
    assert wide_csv.repair_header(["rm", "x", "x", "x"]) == ["rm", "x", "x_1", "x_2"]


def test_year_columns():
    names = ["1952", "1953", "1953rm", "2025", "2026", "2026rm", "x2025"]
    assert wide_csv.year_columns(names, last=2025) == ["1953", "2025"]
    assert wide_csv.year_attributes(names, last=2026) == {1953: "1953rm", 2026: "2026rm"}


def test_wide_csv_to_long(spark, csv_file):
    wide = wide_csv.read_wide_csv(spark, csv_file)
    assert wide.columns == ["番号", "地点名", "1953", "1953rm", "1954", "1954rm"]
    long = reshape.unpivot_years(rename_aliases(wide), ["station_code_raw", "location_name_raw"], last=2026)
    rows = {(r.station_code_raw, r.year): (r.event_date_raw, r.rm_raw) for r in long.collect()}
    assert rows == {
        ("401", 1953): ("05-21", "8"), ("401", 1954): (None, "0"),
        ("47", 1953): (None, None), ("47", 1954): ("12-31", "8"),
    }


def test_wide_csv_needs_header(spark, tmp_path):
    path = tmp_path / "short.csv"
    path.write_text("only a title\n")
    with pytest.raises(ValueError):
        wide_csv.read_wide_csv(spark, str(path))


def test_unpivot_needs_years_and_months(spark):
    df = spark.createDataFrame([("a", 1)], "location_name_raw string, x int")
    with pytest.raises(ValueError):
        reshape.unpivot_years(df, ["location_name_raw"])
    with pytest.raises(ValueError):
        reshape.unpivot_months(df, [], "v")


def test_unpivot_then_pivot(spark):
    months = reshape.MONTHS
    wide = spark.createDataFrame(
        [("s", "2001", *[f"{i}.5 ]" for i in range(12)]), ("s", "note", *["1"] * 12)],
        ["station", "Year", *months],
    )
    long = reshape.unpivot_months(wide, ["station"], "v")
    back = long.groupBy("station", "year").pivot("month", list(range(1, 13))).agg(F.first("v")).collect()
    assert [tuple(r) for r in back] == [("s", 2001, *[i + 0.5 for i in range(12)])]


PAGE = """<table><tr><td>menu</td></tr></table>
<TABLE class='x'><tr><th>Year</th>%s<th>Annual</th></tr>
<tr><td><a href='#'>2001</a></td>%s<td>9</td></tr></TABLE>"""


def test_table_columns(spark):
    head = "".join(f"<th>{m}</th>" for m in reshape.MONTHS)
    cells = "".join(f"<td>&nbsp;{i} ]</td>" for i in range(12))
    pages = spark.createDataFrame(
        [("ok", PAGE % (head, cells)), ("short", "<table></table>"), ("odd", PAGE % ("<th>Jan</th>", "<td>1</td>"))],
        "page string, html string",
    )
    good, bad = html.split_good_reject(html.html_table_columns(pages))
    row = good.first()
    assert good.count() == 1 and (row.page, row.Year, row.Jan, row.Dec) == ("ok", "2001", "0 ]", "11 ]")
    errors = {r.page: r.parse_error for r in bad.collect()}
    assert errors["short"] == "expected at least 2 tables, got 1"
    assert errors["odd"].startswith("missing columns: Feb, Mar")


def test_option_list(spark):
    page = """<select name="other"><option value="9">X</option></select>
    <select name="block_no"><option value="">Select</option>
    <option value="47662">TOKYO&nbsp; WMO Station ID:47662</option>
    <option value="47429">MORI Station No:1</option><option value="47001">X (OLD)</option>
    <option value="47662">TOKYO  WMO Station ID:47662</option>
    <option value="47600"> WAJIMA </option></select>"""
    listed = html.html_option_list(spark.createDataFrame([(page,)], "html string"))
    assert [(r.position, r.name, r.code) for r in listed.collect()] == [
        (0, "TOKYO", "47662"), (1, "WAJIMA", "47600")
    ]
    empty = html.html_option_list(spark.createDataFrame([("<p>",)], "html string"))
    with pytest.raises(ValueError):
        html.require_rows(empty, "stations")


def test_caption(spark):
    pages = spark.createDataFrame(
        [("a", "<caption class=\"m\"><b>X</b> Lat&nbsp;35o39.2'N \n Lon 136o03.7'E</caption>"), ("b", "<p>none</p>")],
        "page string, html string",
    )
    got = {r.page: (r.latitude, r.longitude) for r in html.caption_coordinates(pages).collect()}
    assert got == {"a": (35.653333, 136.061667), "b": (None, None)}


@pytest.mark.parametrize("caption, at", [
    ("<caption class='m'>Lat 35&deg;30&#8242;N Lon 10&#xB0;0'W</caption>", (35.5, -10.0)),
    ("<caption id=x class='big m'>Lat 35&#176;30'15\"S Lon 12.5 E</caption>", (-35.504167, 12.5)),
    ("<CAPTION CLASS=m>Lat 1o0'N</CAPTION>", (1.0, None)),
    ("<caption class='mm'>Lat 1o0'N Lon 1o0'E</caption>", (None, None)),
])
def test_caption_spellings(spark, caption, at):
    row = html.caption_coordinates(spark.createDataFrame([(caption,)], "html string")).first()
    assert (row.latitude, row.longitude) == at


def test_option_spellings(spark):
    page = "<SELECT id=s name='block_no'><option selected value='1'>A<option value=2>B</option><option value=\"3\" x>C</option></SELECT>"
    rows = html.html_option_list(spark.createDataFrame([(page,)], "html string")).collect()
    assert [(r.code, r.name) for r in rows] == [("1", "A"), ("2", "B"), ("3", "C")]


def test_table_spellings(spark):
    rows = lambda page: [(r.parse_error, r.cells) for r in html.html_table_rows(
        spark.createDataFrame([(page,)], "html string")).collect()]
    # Cells and rows without end tags, a cell over two columns, entities.
    assert rows("<table></table><table><tr><td>a<td colspan=2>b&#38;c<tr><th>d</th><td colspan='0'>&deg;</table>") == [
        (None, ["a", "b&c", "b&c"]), (None, ["d", "\u00b0"])]
    # A table within the first one is the second table.
    assert rows("<table><tr><td><table><tr><td>in</td></tr></table></td></tr></table>") == [(None, ["in"])]
    # Text of a nested table belongs to the outer cell; a table without an end goes up to the page's.
    assert rows("<table></table><table><tr><td>x<table><tr><td>y</td></tr></table><td>z</td></tr><tr><td>w</td></tr></table>") == [
        (None, ["x y", "z"]), (None, ["w"])]
    assert rows("<table></table><table><tr><td>x") == [(None, ["x"])]
    # Comments, scripts and quoted signs hold no tags.
    assert rows("<!-- <table> --><script>'<table>'</script><table title='>'></table><table><tr><td>a<!-- <td> -->b</table>") == [(None, ["ab"])]
    assert rows("<p>")[0][0] == "expected at least 2 tables, got 0"
    assert rows(None)[0][0] == "expected at least 2 tables, got 0"


def plain_grid(rows):
    """Cells at the first free columns of a sheet; rows are what their columns hold, in order."""
    sheet, last = {}, len(rows)
    for r, cells in enumerate(rows):
        for text, columns, deep in cells:
            column = 0
            for _ in range(columns):
                while (r, column) in sheet:
                    column += 1
                for below in range(deep):
                    sheet.setdefault((r + below, column), text)
                last = max(last, r + deep)
    return [[sheet[k] for k in sorted(k for k in sheet if k[0] == r)] for r in range(last)]


def test_spans_fill_a_grid():
    rng = random.Random(6)
    for _ in range(500):
        rows = [[(f"{r}.{c}", rng.choice([1, 1, 2, 3]) if r == 0 else 1, rng.choice([1, 1, 2, 4])) for c in range(rng.randint(0, 4))] for r in range(rng.randint(0, 6))]
        page = "".join("<tr>" + "".join(f"<td colspan={c} rowspan='{d}'>{t}" for t, c, d in cells) for cells in rows)
        assert page_tables.read_table(f"<table></table><table>{page}</table>", 1) == (2, plain_grid(rows))
    wide = page_tables.read_table("<table><tr><td colspan=250>x</td><td>y", 0)[1]
    assert [len(r) for r in wide] == [251]


def test_page_reading_is_linear():
    """Pages made to slow a reader down: open quotes, lone signs, deep nesting, comments without an end."""
    for part in ("<td a='", "<", "<table><tr><td>", "<!--", "<script>", "&", "</", "<td colspan="):
        start = time.perf_counter()
        page_tables.read_table("<table></table><table><tr><td>" + part * 20_000, 1)
        assert time.perf_counter() - start < 10, part


def test_contract(spark):
    now = dt.datetime(2026, 1, 1)
    df = spark.createDataFrame(
        [("001", 2026), ("001", 2026)], "location_code string, forecast_year int"
    ).withColumns({
        "event_type": F.lit("e"), "predicted_day_of_year": F.lit(90),
        "predicted_event_date": F.lit(dt.date(2026, 3, 31)), "model_name": F.lit("m"),
        "model_version": F.lit("v"), "trained_at": F.lit(now), "prediction_status": F.lit(None),
    })
    shaped = contracts.conform(df, FORECAST)
    assert shaped.columns == FORECAST.schema.names
    assert shaped.first().is_best_model is False
    rules = {r.rule: r.violations for r in contracts.violations(shaped, FORECAST).collect()}
    assert rules.pop("not null: prediction_status") == 2
    assert list(rules.values()) == [1] and next(iter(rules)).startswith("unique key")
    with pytest.raises(ValueError):
        contracts.verify(shaped, FORECAST)
    ok = spark.createDataFrame([("a",)], "station_code string")
    assert contracts.verify(contracts.conform(ok, STATION_METADATA), STATION_METADATA).count() == 1


def test_upsert_takes_the_cross_product(spark):
    schema = "model_name string, forecast_year int, model_version string, event_type string, v int"
    old = spark.createDataFrame(
        [("a", 2001, "v", "e", 1), ("a", 2002, "v", "e", 1), ("b", 2001, "v", "e", 1), ("b", 2003, "v", "e", 1),
         ("a", 2001, "w", "e", 1), ("a", 2001, "v", "f", 1)], schema)
    new = spark.createDataFrame([("a", 2001, "v", "e", 2), ("b", 2002, "v", "e", 2)], schema)
    got = sorted(tuple(r) for r in sinks.upsert_cross(old, new).collect())
    assert got == sorted([
        ("a", 2001, "v", "e", 2), ("b", 2002, "v", "e", 2),
        ("b", 2003, "v", "e", 1), ("a", 2001, "w", "e", 1), ("a", 2001, "v", "f", 1),
    ])


def test_missing_table_reads_as_none(spark, tmp_path):
    assert sinks.read_if_present(spark, str(tmp_path / "none")) is None
