"""Rows of one table of a page, read from its tags in a single pass."""

from __future__ import annotations

import html
import re
import sys

from pyspark import cloudpickle

# Tasks get this module's functions by value: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Entities that are plain hyphens here, and the largest spans that the HTML standard allows.
HYPHENS = {"&minus;": "-", "&ndash;": "-"}
MOST_COLUMNS, MOST_ROWS = 1000, 65534

NAME = re.compile(r"/?([a-zA-Z][a-zA-Z0-9]*)")
#: What a tag holds up to its end; a quoted value may hold the end's character.
REST = re.compile(r"""(?:[^>"']|"[^"]*"|'[^']*')*+>""")
LONGEST = 1024  # characters within which a tag's quotes are looked at
VALUE = r"""\s*=\s*(?:"\s*(\d{1,9})|'\s*(\d{1,9})|(\d{1,9}))"""
COLUMNS, ROWS = re.compile(r"(?i)(?<![\w-])colspan" + VALUE), re.compile(r"(?i)(?<![\w-])rowspan" + VALUE)
RAW = {name: re.compile(rf"(?i)</{name}\s*>") for name in ("script", "style", "textarea", "title")}
BLANKS = re.compile("[ \t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")

STRUCTURE = {"tr", "td", "th", "thead", "tbody", "tfoot"}

Cell = tuple[str, int, int]  # text, columns, rows


def span(pattern: re.Pattern, attributes: str, most: int) -> int:
    found = pattern.search(attributes)
    return min(max(int(next(g for g in found.groups() if g)), 1), most) if found else 1


def visible(parts: list[str]) -> str:
    text = "".join(parts)
    if "&" in text:
        for name, character in HYPHENS.items():
            text = text.replace(name, character)
        text = html.unescape(text)
    return BLANKS.sub(" ", text).strip(" ")


def tokens(page: str):
    """(name, is end tag, columns, rows, text after it) of every tag; comments, scripts and styles are no text.

    The page is split at its opening signs; what a piece says up to the closing
    sign is looked up, since most tags of a page are alike. Only quotes that hold
    such signs, comments and scripts are looked for beyond their piece, each
    character at most once more.
    """
    pieces = page.split("<")
    n, known = len(pieces), {}
    yield "", False, 1, 1, pieces[0]
    at, i = len(pieces[0]), 1
    while i < n:
        piece = pieces[i]
        i += 1
        stop = at + 1 + len(piece)
        head, closed, text = piece.partition(">")
        tag = known.get(head)
        if tag is None:
            name = NAME.match(head)
            tag = known[head] = (name[1].lower() if name else "", head.startswith("/"), span(COLUMNS, head, MOST_COLUMNS),
                                 span(ROWS, head, MOST_ROWS), head.count('"') % 2 or head.count("'") % 2)
        name, closing, columns, rows, quoted = tag
        end = None
        if head.startswith("!--"):
            name, end = "", page.find("-->", at + 4)
            end = len(page) if end < 0 else end + 3
        elif not name:
            # Other markup goes up to its end; a lone sign is text.
            if not (closed and head.startswith(("!", "?", "/"))):
                text = "<" + piece
        elif quoted or not closed:
            begin = at + 1 + NAME.match(head).end()
            whole = REST.match(page, begin, begin + LONGEST)
            end = whole.end() if whole else None
            if whole:
                held = page[begin:end]
                columns, rows = span(COLUMNS, held, MOST_COLUMNS), span(ROWS, held, MOST_ROWS)
            elif not closed:
                name, text = "", "<" + piece
        if name in RAW and not closing:
            ended = RAW[name].search(page, end or at + 1 + len(head))
            end = ended.start() if ended else len(page)
        if end is not None:
            while stop < end and i < n:
                stop += 1 + len(pieces[i])
                i += 1
            text = page[end:stop]
        at = stop
        yield name, closing, columns, rows, text


def spread(rows: list[list[Cell]]) -> list[list[str]]:
    """Cells repeated over the columns and the rows that they span; spans past the last row make rows of their own."""
    out: list[list[str]] = []
    held: list[tuple[int, str, int]] = []  # column, text and rows still to fill, by column
    number = 0
    while number < len(rows) or held:
        line: list[str] = []
        left, held = held, []
        place = 0

        def put(column: int, text: str, more: int) -> None:
            if more:
                held.append((column, text, more))
            line.append(text)

        for text, columns, deep in rows[number] if number < len(rows) else []:
            while place < len(left) and left[place][0] <= len(line):
                put(left[place][0], left[place][1], left[place][2] - 1)
                place += 1
            for _ in range(columns):
                put(len(line), text, deep - 1)
        for column, text, more in left[place:]:
            put(column, text, more - 1)
        out.append(line)
        number += 1
    return out


def read_table(page: str | None, wanted: int) -> tuple[int, list[list[str]]]:
    """Number of tables of a page, and the rows of one of them, each a list of its cells' texts.

    Tables are numbered by their opening tags, nested ones included. A cell's
    text includes what a table inside it says, whose rows and cells are none of
    the outer table. Cells, rows and tables end at their end tags, where the next
    one begins, or with the page; a cell outside a row begins one. A row without
    cells counts. Null is a page without tables.
    """
    count, stack = 0, []
    rows: list[list[Cell]] = []
    row: list[Cell] | None = None
    cell: list[str] | None = None
    sizes = (1, 1)

    def end_cell() -> None:
        nonlocal cell
        if cell is not None:
            row.append((visible(cell), *sizes))
            cell = None

    def end_row() -> None:
        nonlocal row
        end_cell()
        if row is not None:
            rows.append(row)
            row = None

    for tag, closing, columns, deep, text in tokens(page or ""):
        if tag and cell is not None:
            cell.append(" ")
        if tag == "table":
            if not closing:
                stack.append(count)
                count += 1
            elif stack:
                if stack.pop() == wanted:
                    end_row()
        elif tag in STRUCTURE and stack and stack[-1] == wanted:
            if tag == "td" or tag == "th":
                end_cell()
                if not closing:
                    if row is None:
                        row = []
                    cell, sizes = [], (columns, deep)
            else:
                end_row()
                if tag == "tr" and not closing:
                    row = []
        if cell is not None:
            cell.append(text)
    end_row()
    return count, spread(rows)
