"""Records of CSV files whose quoted cells hold line breaks, from many blocks of one file.

A line that begins outside of quotes begins a record. Whether a block of a file begins outside is
known only when all blocks before it are: so every block first says in which state it ends for either
state it may begin in. These are two bits a block, and composing them in file order tells each block
its own state. Then every block cuts its lines into records by itself, and only the pieces of records
that run on over the end of a block are brought together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from scrubline.workspace import written

# One cell with what ends it: a quoted one, where two quotes stand for one and text may follow, or a
# plain one, which does not begin with a quote. A quote within a plain cell is text.
_CELL = re.compile(rb'"(?:[^"]|"")*+"[^,]*(?:,|\Z)|(?!")[^,]*(?:,|\Z)')
_CLOSED = re.compile(rb'(?:[^"]|"")*+"[^,]*(?:,|\Z)')


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a quoted cell is open at the end of a line that begins in one, or does not."""
    if b'"' not in line:
        return inside
    at = 0
    if inside:
        closed = _CLOSED.match(line)
        if not closed:
            return True
        at = closed.end()
        if at == len(line) and not closed[0].endswith(b","):
            return False
    while at < len(line):
        cell = _CELL.match(line, at)
        if not cell:
            return True
        at = cell.end()
        if not cell[0].endswith(b","):
            return False
    return False


def raw_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path``, ``block``, ``at`` (rising within a block) and the raw bytes of every line.

    Lines end at line feeds only, so a carriage return before one is kept.
    """
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").cast("binary").alias("line"),
    )


def block_ends(lines: DataFrame) -> DataFrame:
    """``path``, ``block``, ``out``, ``in``: whether a block ends inside a cell, by how it begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], tuple[bool, bool]] = {}
        for batch in batches:
            names, blocks, texts = (batch.column(i) for i in (0, 1, 3))
            for path, block, line in zip(names.to_pylist(), blocks.to_pylist(), texts.to_pylist(), strict=True):
                out, in_ = found.get((path, block), (False, True))
                found[path, block] = ends_inside(line, out), ends_inside(line, in_)
        yield pa.RecordBatch.from_pylist(
            [{"path": p, "block": b, "out": o, "in": i} for (p, b), (o, i) in found.items()], schema=_ENDS
        )

    return lines.mapInArrow(run, "path string, block long, out boolean, in boolean")


_ENDS = pa.schema([("path", pa.string()), ("block", pa.int64()), ("out", pa.bool_()), ("in", pa.bool_())])


def block_states(ends: DataFrame) -> DataFrame:
    """``path``, ``block``, ``inside``: whether a block begins inside a quoted cell; one row a block.

    A block that ends alike however it begins sets the state; one that differs keeps or turns it.
    """
    order = Window.partitionBy("path").orderBy("block")
    turned = F.sum(F.when(F.col("out") & ~F.col("in"), 1).otherwise(0)).over(order)
    steps = ends.withColumn("turns", turned)
    fixed = F.col("out") == F.col("in")
    last = F.last(F.when(fixed, F.struct(F.col("out").alias("state"), "turns")), ignorenulls=True).over(order)
    after = F.coalesce(last["state"], F.lit(False)).cast("int") + F.col("turns") - F.coalesce(last["turns"], F.lit(0))
    stated = steps.withColumn("after", after % 2 == 1)
    before = F.coalesce(F.lag("after").over(order), F.lit(False))
    return stated.select("path", "block", before.alias("inside"))


def records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path``, ``block``, ``at``, ``record``, ``first``: the records of files in UTF-8 or another encoding
    that keeps ASCII.

    Every task reads the lines of its blocks. ``at`` rises in the order of a block's records, and
    ``first`` is true for the first record of a file; empty lines between records are left out. The bytes
    of a record are as they are in the file.
    """
    lines = raw_lines(spark, paths)
    states = written(block_states(written(block_ends(lines), "ends")), "states")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The lines of the record that is being read, and where it begins.
        parts: list[bytes] = []
        here = place = None
        state = begun = headed = False

        def piece(ended: bool) -> dict:
            nonlocal headed
            record = b"\n".join(parts)
            parts.clear()
            first = here[1] == 0 and not headed and bool(record.strip(b"\r"))
            headed |= first
            named = {"path": here[0], "block": here[1], "at": place, "record": record}
            return named | {"begun": begun, "ended": ended, "first": first}

        for batch in batches:
            out = []
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for path, block, at, line, inside in zip(*columns, strict=True):
                if here != (path, block):
                    if parts:
                        out.append(piece(False))
                    here, state, headed = (path, block), inside, False
                if not parts:
                    place, begun = at, not state
                parts.append(line)
                state = ends_inside(line, state)
                if not state:
                    out.append(piece(True))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_PIECES)
        if parts:
            yield pa.RecordBatch.from_pylist([piece(False)], schema=_PIECES)

    # A row for each block of a file, as many as the splits that the driver plans; a shuffle would lose the order.
    joined = lines.join(F.broadcast(states), ["path", "block"]).select("path", "block", "at", "line", "inside")
    schema = "path string, block long, at long, record binary, begun boolean, ended boolean, first boolean"
    pieces = written(joined.mapInArrow(run, schema), "records")
    whole = pieces.where("begun and ended")
    # A few pieces a block: its first record's end, its last one's beginning, or all of a block within one.
    torn = pieces.where("not (begun and ended)")
    order = Window.partitionBy("path").orderBy("block", "at")
    start = F.last(F.when(F.col("begun"), F.struct("block", "at")), ignorenulls=True).over(order)
    placed = torn.withColumn("start", start).groupBy("path", "start")
    sorted_parts = F.array_sort(F.collect_list(F.struct("block", "at", "record")))
    text = F.array_join(F.transform(sorted_parts, lambda p: F.hex(p["record"])), "0A")
    mended = placed.agg(F.unhex(text).alias("record"), F.max("first").alias("first"))
    mended = mended.select("path", "start.block", "start.at", "record", "first")
    every = whole.select("path", "block", "at", "record", "first").unionByName(mended)
    return every.where(~_is_blank(F.col("record")))


_PIECES = pa.schema(
    [
        ("path", pa.string()),
        ("block", pa.int64()),
        ("at", pa.int64()),
        ("record", pa.binary()),
        ("begun", pa.bool_()),
        ("ended", pa.bool_()),
        ("first", pa.bool_()),
    ]
)


def _is_blank(record: Column) -> Column:
    return F.hex(record).isin("", "0D")
