"""Change-order workbooks: a banner row, then headers, then data.

Many workbooks are read at a time as binary files and unpacked in tasks, one
workbook after another; a task holds the packed files of one Arrow batch, whose
bytes Spark bounds. Spark has no spreadsheet reader; everything after the
unpacking is ordinary columns.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline import fixed
from scrubline.functions.text import clean_cell, null_tokens
from scrubline.workspace import written

HEADER_ROW = 2
BATCH_ROWS = 5000

# Built-in number formats that show dates or times.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}


def workbook_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, content) of the workbooks."""
    return spark.read.format("binaryFile").load(paths).select("path", "content")


def read_change_orders(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return change_orders(workbook_files(spark, paths))


def change_orders(files: DataFrame, tokens: list[str] | None = None) -> DataFrame:
    """Change orders of workbooks given as (path, content).

    Known headers get their canonical name, others pass through. Dates come out
    as ISO text; blank cells and cells that mean "no value" as NULL.
    """
    # Every workbook is unpacked once; header and rows are read from the stored sheets.
    sheets = written(files.mapInPandas(_sheets, "names array<string>, cells array<string>"), "sheets")
    # One row per distinct header, whatever the number of workbooks.
    heads = sheets.select("names").distinct().select(F.posexplode("names").alias("position", "name"))
    order = heads.groupBy("name").agg(F.min("position").alias("position"))
    names = [row.name for row in order.orderBy("position", "name").collect()]
    renamed = [fixed.CHANGE_ORDER_HEADERS.get(name, name) for name in names]
    for name in renamed:
        if renamed.count(name) > 1:
            raise ValueError(f"more than one source column maps to {name}")
    if not names:
        return files.sparkSession.createDataFrame(
            [], ", ".join(f"{c} string" for c in fixed.CHANGE_ORDER_HEADERS.values())
        )
    # A header that a workbook lacks has position 0, so its cells are NULL.
    cells = [F.get("cells", F.array_position("names", F.lit(n)).cast("int") - 1) for n in names]
    rows = sheets.where(F.col("cells").isNotNull())
    return rows.select(
        *[clean_cell(null_tokens(c, tokens)).alias(n) for c, n in zip(cells, renamed, strict=True)]
    )


# --- in tasks -----------------------------------------------------------------------


def _contents(batches: Iterator[pd.DataFrame]) -> Iterator[bytes]:
    for batch in batches:
        yield from batch["content"]


def _column_names(cells: dict[int, str]) -> list[str]:
    """Stripped headers; blank ones are numbered, repeated ones get a suffix."""
    names: list[str] = []
    for at in range(max(cells, default=-1) + 1):
        name = (cells.get(at) or "").strip() or f"Unnamed: {at}"
        repeats = sum(1 for n in names if n == name or re.fullmatch(re.escape(name) + r"\.\d+", n))
        names.append(f"{name}.{repeats}" if name in names else name)
    return names


def _sheets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The header of each workbook, with its rows one by one; a first row has no cells."""
    for content in _contents(batches):
        yield from _sheet_batches(content)


def _sheet_batches(content: bytes) -> Iterator[pd.DataFrame]:
    names: list[str] = []
    waiting: list[list[str | None] | None] = []
    expected = HEADER_ROW + 1

    def frame(rows: list) -> pd.DataFrame:
        return pd.DataFrame({"names": [names] * len(rows), "cells": pd.Series(rows, dtype=object)})

    for number, cells in _sheet_rows(content):
        if number < HEADER_ROW:
            continue
        if number == HEADER_ROW:
            names = _column_names(cells)
            waiting.append(None)
            continue
        if not names:
            return
        # Rows the file leaves out are blank rows of the sheet.
        waiting.extend([None] * len(names) for _ in range(number - expected))
        waiting.append([cells.get(at) for at in range(len(names))])
        expected = number + 1
        while len(waiting) >= BATCH_ROWS:
            yield frame(waiting[:BATCH_ROWS])
            waiting = waiting[BATCH_ROWS:]
    if waiting:
        yield frame(waiting)


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _text_of(element: ElementTree.Element) -> str:
    """Text of a string item without its phonetic guide."""
    parts = []
    for child in element:
        if _local(child.tag) == "t":
            parts.append(child.text or "")
        elif _local(child.tag) == "r":
            parts.extend(t.text or "" for t in child if _local(t.tag) == "t")
    return "".join(parts)


def _sheet_rows(content: bytes) -> Iterator[tuple[int, dict[int, str]]]:
    """(row number, {column: text}) of the first sheet's rows that hold a value."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        parts = set(book.namelist())
        workbook = ElementTree.fromstring(book.read("xl/workbook.xml"))
        links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
        targets = {link.get("Id"): link.get("Target") for link in links}
        sheet = next(e for e in workbook.iter() if _local(e.tag) == "sheet")
        link = next(v for k, v in sheet.attrib.items() if _local(k) == "id")
        target = targets[link]
        target = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        settings = [e for e in workbook.iter() if _local(e.tag) == "workbookPr"]
        since_1904 = any(e.get("date1904") in ("1", "true") for e in settings)
        epoch = dt.datetime(1904, 1, 1) if since_1904 else dt.datetime(1899, 12, 30)

        strings: list[str] = []
        if "xl/sharedStrings.xml" in parts:
            with book.open("xl/sharedStrings.xml") as part:
                for _, element in ElementTree.iterparse(part):
                    if _local(element.tag) == "si":
                        strings.append(_text_of(element))
                        element.clear()
        dates = _date_styles(book.read("xl/styles.xml")) if "xl/styles.xml" in parts else set()

        number = 0
        with book.open(target) as part:
            for _, element in ElementTree.iterparse(part):
                if _local(element.tag) != "row":
                    continue
                number = int(element.get("r") or number + 1)
                cells: dict[int, str] = {}
                at = -1
                for cell in element:
                    if _local(cell.tag) != "c":
                        continue
                    at = _column_number(cell.get("r")) if cell.get("r") else at + 1
                    text = _cell_text(cell, strings, dates, epoch)
                    if text is not None:
                        cells[at] = text
                element.clear()
                if cells:
                    yield number, cells


def _column_number(reference: str) -> int:
    number = 0
    for char in reference:
        if not char.isalpha():
            break
        number = number * 26 + ord(char.upper()) - ord("A") + 1
    return number - 1


def _date_styles(styles: bytes) -> set[int]:
    """Positions of the cell styles whose number format shows a date or time."""
    root = ElementTree.fromstring(styles)
    date_formats = set(DATE_FORMATS)
    for element in root.iter():
        if _local(element.tag) == "numFmt":
            code = re.sub(r'"[^"]*"|\[(?!h|m|s)[^\]]*\]|\\.', "", element.get("formatCode", "").lower())
            if re.search(r"[dmyhs]", code) and "general" not in code:
                date_formats.add(int(element.get("numFmtId")))
    formats = next((e for e in root if _local(e.tag) == "cellXfs"), [])
    return {at for at, e in enumerate(formats) if int(e.get("numFmtId", 0)) in date_formats}


def _cell_text(
    cell: ElementTree.Element, strings: list[str], dates: set[int], epoch: dt.datetime
) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        inline = next((e for e in cell if _local(e.tag) == "is"), None)
        return None if inline is None else _text_of(inline)
    value = next((e.text for e in cell if _local(e.tag) == "v"), None)
    if value is None or kind == "e":
        return None
    if kind == "s":
        return strings[int(value)]
    if kind == "b":
        return "True" if value.strip() == "1" else "False"
    if kind == "d":
        return str(dt.datetime.fromisoformat(value))
    if kind != "n":
        return value
    amount = float(value)
    if int(cell.get("s", 0)) in dates:
        moment = epoch + dt.timedelta(milliseconds=round(amount * 86_400_000))
        return str(moment.time()) if 0 <= amount < 1 else str(moment)
    return str(int(amount)) if amount == int(amount) else repr(amount)
