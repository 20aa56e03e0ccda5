"""Tables, option lists and captions of stored HTML pages, one page per row.

A page is parsed inside its own row, so a scan over any number of pages is one
narrow stage: captions and lists with built-in functions, tables by a pass over
their tags in Arrow batches. Pages that cannot be read carry a ``parse_error``
instead of stopping the job.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from bloomline.config import DENY_STATION_CODES, MONTHS, NAME_SUFFIXES, RETIRED_MARKER
from bloomline.functions.text import normalize_whitespace, parse_coordinate
from bloomline.sources.page_tables import read_table

BATCH_PAGES = 200

# Named entities resolved in cell text, `&amp;` last.
ENTITIES = {
    "&nbsp;": " ", "&ensp;": " ", "&emsp;": " ", "&thinsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'",
    "&deg;": "\u00b0", "&prime;": "\u2032", "&Prime;": "\u2033", "&middot;": "\u00b7", "&minus;": "-", "&ndash;": "-", "&mdash;": "\u2014",
    "&amp;": "&",
}
NUMERIC = r"&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"


def attribute(name: str, value: str) -> str:
    """Pattern of an attribute with one word among its values, in double, single or no quotes."""
    return rf"""\b{name}\s*=\s*(?:"(?:[^">]*\s)?{value}(?:\s[^">]*)?"|'(?:[^'>]*\s)?{value}(?:\s[^'>]*)?'|{value}(?=[\s>/]))"""


SELECT = rf"(?is)<select\b[^>]*{attribute('name', 'block_no')}[^>]*>(.*?)</select\s*>"
# Groups 1 to 3 hold the code (one of them, by its quotes), group 4 the visible text.
OPTION = r"""(?is)<option\b[^>]*\bvalue\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))[^>]*>([^<]*)"""
CAPTION = rf"(?is)<caption\b[^>]*{attribute('class', 'm')}[^>]*>(.*?)</caption\s*>"


def plain_text(html: Column) -> Column:
    """Visible text of a fragment, whitespace collapsed."""
    bare = F.when(html.contains("<"), F.regexp_replace(html, r"<[^>]*>", " ")).otherwise(html)
    named = reduce(
        lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ENTITIES.items(), _numeric_entities(bare)
    )
    return normalize_whitespace(F.when(html.contains("&"), named).otherwise(bare))


def _numeric_entities(text: Column) -> Column:
    """``&#176;`` and ``&#xB0;`` as the characters they stand for; impossible ones stay."""
    def character(entity: Column) -> Column:
        digits = F.regexp_extract(entity, "([0-9a-fA-F]+);", 1)
        code = F.when(entity.rlike("&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).cast("long")
        valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(entity)

    found = F.array_distinct(_all(text, NUMERIC, 0))
    return F.aggregate(found, text, lambda t, e: F.replace(t, e, character(e)))


def _all(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed a single time per row."""
    return F.try_element_at(F.transform(F.array(value), use), F.lit(1))


def _table(html: Column, index: int) -> Column:
    """Number of tables on a page, and the rows of the one at ``index``."""
    def read(pages: pa.Array) -> pa.Array:
        found = [read_table(page, index) for page in pages.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([n for n, _ in found], pa.int32()), pa.array([rows for _, rows in found], pa.list_(pa.list_(pa.string())))],
            names=["found", "rows"])

    return F.arrow_udf(read, "struct<found:int, rows:array<array<string>>>")(html)


def _read(pages: DataFrame, html_col: str, keep: list[str], index: int) -> DataFrame:
    """Pages with their table; batches of pages are kept small, since pages are long."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(pages.sparkSession.conf.get(setting)) > BATCH_PAGES:
        pages.sparkSession.conf.set(setting, str(BATCH_PAGES))
    return pages.select(*keep, _table(F.col(html_col).cast("string"), index).alias("_page"))


def _too_few(page: Column, index: int) -> Column:
    found = page["found"]
    return F.when(found <= index, F.concat(F.lit(f"expected at least {index + 1} tables, got "), found.cast("string")))


def _no_error() -> Column:
    return F.lit(None).cast("string")


def _no_cells() -> Column:
    return F.lit(None).cast("array<string>")


def html_table_rows(pages: DataFrame, html_col: str = "html", table_index: int = 1) -> DataFrame:
    """One row per table row: ``row_no`` and its ``cells``; short pages keep one error row."""
    keep = [c for c in pages.columns if c != html_col]

    def entry(error: Column, row_no: Column, cells: Column) -> Column:
        return F.struct(
            error.alias("parse_error"), row_no.cast("int").alias("row_no"), cells.alias("cells")
        )

    page = F.col("_page")
    error = _too_few(page, table_index)
    listed = F.transform(page["rows"], lambda r, i: entry(_no_error(), i, r))
    rows = F.when(error.isNotNull(), F.array(entry(error, F.lit(None), _no_cells()))).otherwise(listed)
    return _read(pages, html_col, keep, table_index).select(*keep, F.inline(rows))


def html_table_columns(
    pages: DataFrame,
    html_col: str = "html",
    columns: list[str] | None = None,
    table_index: int = 1,
) -> DataFrame:
    """Table body under its header's names, one string column for each of ``columns``.

    A page with too few tables or without one of the columns becomes an error row.
    The error comes out of the same generator as the cells, so a filter on it
    never repeats the parsing.
    """
    columns = columns or ["Year", *MONTHS]
    keep = [c for c in pages.columns if c != html_col]
    wanted = F.array(*[F.lit(c) for c in columns])

    def entry(error: Column, cells: Column) -> Column:
        return F.struct(error.alias("parse_error"), cells.alias("_cells"))

    def body(rows: Column) -> Column:
        header = F.coalesce(F.try_element_at(rows, F.lit(1)), F.array().cast("array<string>"))
        missing = F.array_except(wanted, header)
        error = F.when(
            F.size(missing) > 0, F.concat(F.lit("missing columns: "), F.array_join(missing, ", "))
        )
        aligned = lambda r: F.transform(
            wanted, lambda name: F.try_element_at(r, F.array_position(header, name).cast("int"))
        )
        lines = F.transform(
            F.slice(rows, 2, F.greatest(F.size(rows), F.lit(1))), lambda r: entry(_no_error(), aligned(r))
        )
        return F.when(error.isNotNull(), F.array(entry(error, _no_cells()))).otherwise(lines)

    page = F.col("_page")
    error = _too_few(page, table_index)
    lines = F.when(error.isNotNull(), F.array(entry(error, _no_cells()))).otherwise(_once(page["rows"], body))
    parsed = _read(pages, html_col, keep, table_index).select(*keep, F.inline(lines))
    return parsed.select(
        *keep, "parse_error",
        *[F.try_element_at("_cells", F.lit(i)).alias(c) for i, c in enumerate(columns, 1)],
    )


def html_option_list(
    pages: DataFrame,
    html_col: str = "html",
    scope: str | None = SELECT,
    item: str = OPTION,
    code_groups: tuple[int, ...] = (1, 2, 3),
    text_group: int = 4,
    deny_codes: list[str] = DENY_STATION_CODES,
    drop_marker: str = RETIRED_MARKER,
    suffixes: list[str] = NAME_SUFFIXES,
) -> DataFrame:
    """(name, code) items of each page in page order, every pair once.

    ``item`` captures the code in one of ``code_groups`` and the visible text in ``text_group``.
    Duplicates leave inside the page's array, so no shuffle is needed.
    """
    keep = [c for c in pages.columns if c != html_col]
    html = F.col(html_col)
    area = F.regexp_extract(html, scope, 1) if scope else html
    cut = "|".join(suffixes)

    def entry(code: Column, text: Column) -> Column:
        label = F.regexp_replace(text, f"(?s)(?:{cut}).*", "") if cut else text
        return F.struct(plain_text(label).alias("name"), F.trim(code).alias("code"))

    def codes(text: Column) -> Column:
        first, *others = [_all(text, item, g) for g in code_groups]
        return reduce(lambda a, b: F.zip_with(a, b, lambda x, y: F.concat(x, y)), others, first)

    items = _once(area, lambda text: F.zip_with(codes(text), _all(text, item, text_group), entry))
    wanted = F.filter(
        items,
        lambda i: (i["code"] != "") & ~i["code"].isin(deny_codes or [""])
        & (i["name"] != "") & ~i["name"].contains(drop_marker),
    )
    listed = pages.select(*keep, F.posexplode(F.array_distinct(wanted)).alias("position", "_item"))
    return listed.select(*keep, "position", "_item.name", "_item.code")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail when an ingestion step found nothing at all."""
    if df.isEmpty():
        raise ValueError(f"no {what} found")
    return df


def caption_coordinates(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Latitude and longitude of the page caption; none found: NULL."""
    keep = [c for c in pages.columns if c != html_col]

    def located(text: Column) -> Column:
        # A coordinate stands right after its label, before the next one.
        latitude = F.regexp_extract(text, r"\bLat\b(.*?)(?:\bLon\b|$)", 1)
        longitude = F.regexp_extract(text, r"\bLon\b(.*)", 1)
        return F.struct(parse_coordinate(latitude).alias("latitude"), parse_coordinate(longitude).alias("longitude"))

    text = _once(F.regexp_extract(F.col(html_col), CAPTION, 1), plain_text)
    return pages.select(*keep, _once(text, located).alias("_at")).select(
        *keep, "_at.latitude", "_at.longitude"
    )


def split_good_reject(df: DataFrame, error_col: str = "parse_error") -> tuple[DataFrame, DataFrame]:
    """Readable rows, and the failure list."""
    failed = F.col(error_col).isNotNull()
    return df.where(~failed).drop(error_col), df.where(failed)
