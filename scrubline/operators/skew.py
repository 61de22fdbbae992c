"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.workspace import written

def hot_keys(df: DataFrame, key: str, limit: int) -> DataFrame | None:
    """(key, rows, cols) for keys with more than ``limit`` rows, or None without any.

    Both sides of such a key are cut into so many pieces that one of ``df`` holds
    about ``limit`` rows at most.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > limit)
    splits = F.ceil(F.col("n") / limit)
    return _stored(counts.select(key, splits.alias("rows"), splits.alias("cols")))


def hot_cells(left: DataFrame, right: DataFrame, key: str, limit: int) -> DataFrame | None:
    """(key, rows, cols) for keys with more than ``limit`` rows on either side, or None.

    A cell of such a key holds about ``limit`` rows of each side at most.
    """
    sides = []
    for at, df in enumerate((left, right)):
        counts = df.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > limit)
        splits, one = F.ceil(F.col("n") / limit), F.lit(1).cast("bigint")
        pair = (one, splits) if at else (splits, one)
        sides.append(counts.select(key, pair[0].alias("rows"), pair[1].alias("cols")))
    merged = sides[0].unionByName(sides[1]).groupBy(key)
    return _stored(merged.agg(F.max("rows").alias("rows"), F.max("cols").alias("cols")))


def _stored(hot: DataFrame) -> DataFrame | None:
    # Stored, so that Spark knows its size and broadcasts it only while it is small.
    hot = written(hot, "hot")
    return None if hot.isEmpty() else hot


def grid_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    hot: DataFrame | None,
    left_salt: str,
    right_salt: str,
    condition: Column | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Inner join on ``key`` with every hot key cut into a grid of cells.

    The left side of a hot key is cut into ``rows`` pieces and the right side into
    ``cols`` by a hash of their salt column, and each piece meets each piece of the
    other side in a join key of its own. Every pair still meets exactly once. The
    sides must share no column name except ``key``. ``parts`` fixes the number of tasks.
    """
    on = [key]
    if hot is not None:
        left = _spread(left, key, hot, left_salt, "rows", "_row", "cols", "_col")
        right = _spread(right, key, hot, right_salt, "cols", "_col", "rows", "_row")
        on = [key, "_row", "_col"]
    if parts:
        left, right = left.repartition(parts, *on), right.repartition(parts, *on)
    # Sizes are underestimated after explodes, so never let them pick a broadcast.
    joined = left.hint("shuffle_hash").join(right.hint("shuffle_hash"), on)
    if condition is not None:
        joined = joined.where(condition)
    return joined.drop("_row", "_col")


def _spread(
    df: DataFrame, key: str, hot: DataFrame, salt: str, pieces: str, own: str, copies: str, other: str
) -> DataFrame:
    one = F.lit(1).cast("bigint")
    # The piece depends on the row alone, so a recomputed task repeats it.
    return (
        df.join(hot, key, "left")
        .withColumn(own, F.pmod(F.xxhash64(salt), F.coalesce(pieces, one)))
        .withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(copies, one) - 1)))
        .drop("rows", "cols")
    )
