"""CSV sources: encodings, drifting headers, null tokens, canonical columns.

Files are read together in groups that share an encoding, a header and whether
quoted cells hold line breaks, so any number of files takes a handful of scans.
Files are split either way; those with such cells by records, see quoted_lines
(UTF-16 files with them are not). Rows with more cells than the header has
are never cut: they stop the read, or are left out and listed as rejects.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from scrubline import fixed
from scrubline.functions.text import null_tokens
from scrubline.sources import quoted_lines

Rename = Callable[[str], str]

# Bytes 0x80-0x9F of windows-1252, where it differs from ISO-8859-1.
_CP1252_BYTES = [b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
_LATIN1 = bytes(_CP1252_BYTES).decode("latin-1")
_CP1252 = bytes(_CP1252_BYTES).decode("cp1252")


# Columns read of a UTF-16 header; Spark has no other way to ask for all of them.
WIDEST_HEADER = 512

# Where a row stands: ``source.file``, ``source.block``, ``source.row``, in that order.
POSITION = "source"

_BAD = "_more_cells_than_header"


def _raw_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_block_length").alias("length"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )


def probe_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, header, encoding, multi_line) per file, from one pass over the raw lines.

    Every line is checked, so a single non-UTF-8 byte anywhere in a file makes
    it windows-1252, and a single line with a quote left open makes it a file
    with line breaks in cells. The scan splits large files and combines per file
    before it shuffles.
    """
    lines = _raw_lines(spark, paths)
    first = F.when((F.col("block") == 0) & (F.length("value") > 0), F.col("at"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    found = lines.groupBy("path").agg(
        # The header is in the block that starts the file; ids rise within a block.
        F.min_by("value", first).alias("header"),
        F.bool_and(F.is_valid_utf8("value")).alias("is_utf8"),
        F.bool_or(quotes % 2 != 0).alias("multi_line"),
    )
    return found.select("path", "header", _encoding().alias("encoding"), "multi_line")


def _encoding() -> Column:
    start = F.hex(F.substring(F.col("header").cast("binary"), 1, 2))
    return (
        F.when(start.isin("FFFE", "FEFF"), "utf-16")
        .when(F.col("is_utf8"), "utf-8")
        .otherwise("windows-1252")
    )


def probe_headers(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, header) per file, for files of a known encoding.

    A task stops after the first rows of a block that is so large that no other file is packed with it.
    """
    full = _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    # Each file counts with this many bytes more when Spark packs files into tasks.
    opening = _bytes(spark.conf.get("spark.sql.files.openCostInBytes"))
    # With a bound on the number of tasks Spark packs more into one than its size allows.
    bounded = spark.conf.get("spark.sql.files.maxPartitionNum", None) is not None

    def first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: set[str] = set()
        for batch in batches:
            text = batch[(batch["block"] == 0) & (batch["value"].str.len() > 0)]
            heads = text.drop_duplicates("path")
            heads = heads[~heads["path"].isin(known)]
            known.update(heads["path"])
            yield heads[["path", "value"]].rename(columns={"value": "header"})
            if not bounded and len(batch) and batch["length"].iloc[0] + opening > full:
                return

    return _raw_lines(spark, paths).mapInPandas(first_lines, "path string, header string")


def _bytes(size: str) -> int:
    """A size setting such as ``128m`` in bytes."""
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)(?:i?b)?", size.strip().lower()).groups()
    return int(number) << (10 * " kmgt".index(unit or " "))


def header_columns(header: str | None) -> list[str]:
    return next(csv.reader([header.removeprefix("\ufeff")])) if header else []


@dataclass(frozen=True)
class Group:
    """Files that are read together."""

    header: tuple[str, ...]
    encoding: str
    multi_line: bool


def _raw_rows(spark: SparkSession, paths: str | list[str], group: Group) -> DataFrame:
    """Cells c0, c1, ..., the position, and the record where it has too many cells."""
    windows = group.encoding.lower() in ("windows-1252", "cp1252")
    columns = [f"c{i}" for i in range(len(group.header))]
    schema = StructType([StructField(c, StringType()) for c in [*columns, _BAD]])
    encoding = "ISO-8859-1" if windows else group.encoding
    options = {"columnNameOfCorruptRecord": _BAD, "quote": '"', "escape": '"'}
    if group.multi_line and encoding.lower() in ("iso-8859-1", "utf-8"):
        # Records are cut out of the lines first, so that a file is read by many tasks.
        found = quoted_lines.records(spark, paths).where("not first")
        record = F.decode("record", encoding) if windows else F.col("record").cast("string")
        # Where lines end with a carriage return and a line feed, breaks within cells become line feeds too.
        ends = F.regexp_replace(F.replace(record, F.lit("\r\n"), F.lit("\n")), "\r$", "")
        record = F.when(F.endswith(record, F.lit("\r")), ends).otherwise(record)
        cells = F.from_csv(record, schema.simpleString()[7:-1].replace(":", " "), options)
        parsed = found.select(cells.alias("cells"), "path", "block", "at")
        raw = parsed.select("cells.*", F.struct(F.col("path").alias("file"), "block", F.col("at").alias("row")).alias(POSITION))
    else:
        raw = (
            spark.read.schema(schema)
            .options(**options)
            .option("header", True)
            .option("enforceSchema", True)
            # All cells of a record are counted, whichever are asked for.
            .option("columnPruning", False)
            .option("multiLine", group.multi_line or group.encoding == "utf-16")
            .option("encoding", encoding)
            .csv(paths)
        )
        position = F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        )
        raw = raw.select(*columns, _BAD, position.alias(POSITION))
    decoded = (lambda c: F.translate(c, _LATIN1, _CP1252)) if windows else F.col
    # Spark marks every record with another number of cells. Those with fewer are
    # filled up; empty cells at the end are no data.
    unquoted = F.regexp_replace(_BAD, r'"(?:[^"]|"")*"', "x")
    cells = F.length(F.regexp_replace(F.regexp_replace(unquoted, r"[,\s]+$", ""), "[^,]", "")) + 1
    # Spark does not give out the record alone, so its presence is tied to a cell.
    too_many = (cells > len(columns)) & (F.col(columns[0]).isNull() | F.col(columns[0]).isNotNull())
    return raw.select(
        *[decoded(c).alias(c) for c in columns],
        POSITION,
        F.when(too_many, decoded(_BAD)).alias(_BAD),
    )


def _checked(rows: DataFrame, bad_rows: str) -> DataFrame:
    if bad_rows == "skip":
        return rows.where(F.col(_BAD).isNull())
    if bad_rows != "raise":
        raise ValueError("bad_rows is raise or skip")
    message = F.concat(F.lit("more cells than the header has: "), F.col(_BAD))
    return rows.where(F.when(F.col(_BAD).isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True))


def _utf16_headers(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """The first record of each file, from one job over all of them."""
    columns = [f"c{i}" for i in range(WIDEST_HEADER)]
    rows = (
        spark.read.schema(", ".join(f"{c} string" for c in columns))
        .option("encoding", "UTF-16")
        .option("multiLine", True)
        .csv(paths)
    )
    path, at = F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at")
    rows = rows.select(path, at, F.array(*columns).alias("cells"))
    found = rows.groupBy("path").agg(F.min_by("cells", "at").alias("cells")).collect()
    last = {r.path: max((i for i, c in enumerate(r.cells) if c is not None), default=-1) for r in found}
    return {r.path: [c or "" for c in r.cells[: last[r.path] + 1]] for r in found}


def _groups(
    spark: SparkSession,
    paths: str | list[str],
    encoding: str,
    header: list[str] | None,
    multi_line: bool | None,
) -> list[tuple[Group, str | list[str]]]:
    """The groups of files to read, with their paths: one entry per header and encoding."""
    if header is not None and encoding != "auto" and multi_line is not None:
        return [(Group(tuple(header), encoding, multi_line), paths)]
    if encoding != "auto" and multi_line is not None:
        probed = probe_headers(spark, paths).withColumns(
            {"encoding": F.lit(encoding), "multi_line": F.lit(multi_line)}
        )
    else:
        probed = probe_files(spark, paths)
    # One row per file, as in the file listing the driver holds anyway.
    files = probed.collect()
    kinds = {f.path: f.encoding if encoding == "auto" else encoding for f in files}
    wide = [path for path, kind in kinds.items() if kind.lower() == "utf-16"]
    wide_headers = _utf16_headers(spark, wide) if wide and header is None else {}
    groups: dict[Group, list[str]] = {}
    for file in files:
        names = header or wide_headers.get(file.path) or header_columns(file.header)
        if names:
            split = file.multi_line if multi_line is None else multi_line
            group = Group(tuple(names), kinds[file.path], bool(split))
            groups.setdefault(group, []).append(file.path)
    return sorted(groups.items(), key=str)


def _union(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _read(
    spark: SparkSession,
    paths: str | list[str],
    columns: list[str],
    rename_for: Callable[[list[str]], Rename],
    encoding: str,
    header: list[str] | None,
    tokens: list[str] | None,
    multi_line: bool | None,
    bad_rows: str,
    positions: bool,
) -> DataFrame:
    parts = []
    for group, files in _groups(spark, paths, encoding, header, multi_line):
        names = list(group.header)
        rows = _checked(_raw_rows(spark, files, group), bad_rows)
        kept = [null_tokens(F.col(f"c{i}"), tokens).alias(f"c{i}") for i in range(len(names))]
        wanted, rename = rows.select(*kept, POSITION), rename_for(names)
        renamed = [rename(name) for name in names]
        places = {name: f"c{i}" for i, name in enumerate(renamed)}
        for column in columns:
            if renamed.count(column) > 1:
                raise ValueError(f"more than one source column maps to {column}")
        cells = [
            (F.col(places[c]) if c in places else F.lit(None)).cast("string").alias(c) for c in columns
        ]
        parts.append(wanted.select(*cells, *([POSITION] if positions else [])))
    if not parts:
        place = f", {POSITION} struct<file: string, block: bigint, row: bigint>" if positions else ""
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns) + place)
    return _union(parts)


def csv_rejects(
    spark: SparkSession,
    paths: str | list[str],
    encoding: str = "auto",
    header: list[str] | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """(file, record): the records that have more cells than their file's header."""
    parts = []
    for group, files in _groups(spark, paths, encoding, header, multi_line):
        rows = _raw_rows(spark, files, group).where(F.col(_BAD).isNotNull())
        parts.append(rows.select(F.col(f"{POSITION}.file").alias("file"), F.col(_BAD).alias("record")))
    return _union(parts) if parts else spark.createDataFrame([], "file string, record string")


# --- parts ------------------------------------------------------------------------


def parts_layout(header: list[str]) -> str:
    """``v1`` for the legacy header names, else ``v2``."""
    return "v1" if {"partNo", "measure"} <= set(header) else "v2"


def read_parts(
    spark: SparkSession,
    paths: str | list[str],
    schema: str = "auto",
    encoding: str = "auto",
    header: list[str] | None = None,
    tokens: list[str] | None = None,
    multi_line: bool | None = None,
    bad_rows: str = "raise",
    positions: bool = False,
) -> DataFrame:
    """Parts exports of either layout; ``auto`` decides per file by its header.

    One pass over the lines finds out encoding, header and whether quoted cells
    hold line breaks. With an ``encoding`` and ``multi_line`` given, only the
    first rows of large files are looked at; with a ``header`` too, none.
    ``bad_rows`` says what rows with more cells than the header do: ``raise`` or
    ``skip`` (see ``csv_rejects``). ``positions`` adds where a row stands, a
    column ``source`` that sorts in file order.
    """

    def rename_for(header: list[str]) -> Rename:
        layout = schema if schema in ("v1", "v2") else parts_layout(header)
        names = fixed.PART_HEADERS_V1 if layout == "v1" else fixed.PART_HEADERS_V2
        return lambda c: names.get(c, c)

    columns = fixed.PART_COLUMNS
    return _read(
        spark, paths, columns, rename_for, encoding, header, tokens, multi_line, bad_rows, positions
    )


# --- suppliers --------------------------------------------------------------------


def supplier_header(column: str) -> str:
    name = column.strip().lower().replace(" ", "_")
    return fixed.SUPPLIER_HEADERS.get(name, name)


def read_suppliers(
    spark: SparkSession,
    paths: str | list[str],
    encoding: str = "auto",
    header: list[str] | None = None,
    tokens: list[str] | None = None,
    multi_line: bool | None = None,
    bad_rows: str = "raise",
    positions: bool = False,
) -> DataFrame:
    """Suppliers exports; header names are matched regardless of case and spaces.

    Options are those of ``read_parts``.
    """
    columns = fixed.SUPPLIER_COLUMNS
    rename_for = lambda _: supplier_header
    return _read(
        spark, paths, columns, rename_for, encoding, header, tokens, multi_line, bad_rows, positions
    )
