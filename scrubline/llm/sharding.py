"""Shards of near equal bytes by sampled splitters.

Documents are ordered by a hash of their text, so copies lie side by side, and then by a hash of
their id. Keys sampled with chances in proportion to size give quantile boundaries for many more
ranges than shards. The exact load of every range is summed; ranges that turn out overfull are
sampled again and cut, and runs of ranges become shards.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.ordering import running_totals
from scrubline.llm.sampling import SPARE
from scrubline.llm.tables import broadcast_if_small, spare_name
from scrubline.workspace import written

SHARDS = 8
# Ranges per shard; a shard misses its share by about half a range at most.
RANGES_PER_SHARD = 128
# Keys sampled per range wanted.
SAMPLES_PER_RANGE = 8
# A range above this many times its share is cut again.
OVERFULL = 2.0


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32`` and the two key columns of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    number = F.col("doc_id").cast("long")
    return docs.select(
        number.alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("k1"),
        F.xxhash64(number).alias("k2"),
    )


def _told_apart(rows: DataFrame) -> DataFrame:
    """``rows`` with a key of its own for every row that repeats both doc_id and text.

    Which of several equal rows gets which key does not matter. Only the keys that repeat are joined.
    """
    repeated = rows.groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1").select("k1", "k2", F.lit(True).alias("again"))
    numbered = rows.withColumn("number", F.monotonically_increasing_id())
    joined = numbered.join(broadcast_if_small(written(repeated, "repeated")), ["k1", "k2"], "left")
    own = F.when(F.col("again"), F.xxhash64("k2", "number")).otherwise(F.col("k2"))
    return joined.select(*[own.alias(c) if c == "k2" else c for c in rows.columns])


def _sample(rows: DataFrame, wanted: int, total: int) -> list[tuple[int, int]]:
    """``wanted`` keys at most, drawn without replacement with chances in proportion to size.

    The smallest of exponential variables with rate ``size``; their randomness is a hash of the key.
    About ``total * t`` of them lie below a small ``t``, so a task hands on few more than are wanted.
    """
    unit = (F.shiftrightunsigned(F.xxhash64("k1", "k2", "doc_id", F.lit(7)), 11) + 1) / float(1 << 53)
    drawn = rows.select("k1", "k2", (-F.log(unit) / F.col("size")).alias("turn"))
    drawn = drawn.where(F.col("turn") < SPARE * wanted / max(total, 1))
    return sorted((r.k1, r.k2) for r in drawn.orderBy("turn", "k1", "k2").limit(wanted).collect())


def _boundaries(keys: list[tuple[int, int]], ranges: int) -> set[tuple[int, int]]:
    """Quantiles of the sampled keys, moved to where a group of equal texts begins.

    Only a group that fills several quantiles is cut inside.
    """
    if not keys:
        return set()
    picked = [keys[len(keys) * i // ranges] for i in range(1, ranges)]
    lowest = -(1 << 63)
    inside: dict[int, list[tuple[int, int]]] = {}
    for key in picked:
        inside.setdefault(key[0], []).append(key)
    found = {(k1, lowest) for k1 in inside}
    for cuts in inside.values():
        if len(cuts) > 1:
            found.update(cuts)
    return found


def _in_ranges(rows: DataFrame, splitters: list[tuple[int, int]]) -> DataFrame:
    """Add ``range``: how many splitters are not above the key."""
    firsts = np.array([k for k, _ in splitters], np.int64)
    seconds = np.array([k for _, k in splitters], np.int64)

    @F.pandas_udf("int")
    def range_of(k1: pd.Series, k2: pd.Series) -> pd.Series:
        one, two = k1.to_numpy(), k2.to_numpy()
        low = np.searchsorted(firsts, one, "left")
        high = np.searchsorted(firsts, one, "right")
        found = high.copy()
        for i in np.flatnonzero(high > low):
            found[i] = low[i] + np.searchsorted(seconds[low[i] : high[i]], two[i], "right")
        return pd.Series(found.astype(np.int32))

    return rows.withColumn("range", range_of("k1", "k2"))


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard`` per row.

    The law is ``bytes``: shards have near equal sums of ``size`` (UTF-8 bytes plus 1), to within
    about one document or a thousandth. Equal texts stay in one shard unless their group is larger
    than a range. ``slot`` counts a shard's rows from 0 in key order. Null texts are of size 1 with
    the checksum of no bytes; null ids are sharded like others, and so are rows that repeat doc_id and
    text, each with a key of its own; an empty table gives no rows; other columns are ignored.
    """
    rows = written(_told_apart(written(sized(docs), "sized")), "sized")
    ranges = shards * RANGES_PER_SHARD
    total = rows.agg(F.sum("size")).first()[0] or 0
    splitters = _boundaries(_sample(rows, ranges * SAMPLES_PER_RANGE, total), ranges)
    while True:
        ranged = _in_ranges(rows, sorted(splitters))
        loads = ranged.groupBy("range").agg(
            F.sum("size").alias("load"),
            (F.min(F.struct("k1", "k2")) < F.max(F.struct("k1", "k2"))).alias("divisible"),
        )
        # One row per range: a thousand or a few.
        loads = loads.orderBy("range").collect()
        full = [r["range"] for r in loads if r["divisible"] and r["load"] > OVERFULL * total / ranges]
        if not full:
            break
        before = len(splitters)
        for at in range(0, len(full), 16):
            some = full[at : at + 16]
            dense = ranged.where(F.col("range").isin(some))
            load = sum(r["load"] for r in loads if r["range"] in some)
            extra = _sample(dense, len(some) * 4 * SAMPLES_PER_RANGE, load)
            splitters |= _boundaries(extra, 4 * len(some))
        if len(splitters) == before:
            break
    middle, owner = 0, np.zeros(len(splitters) + 1, np.int32)
    for r in loads:
        owner[r["range"]] = min(shards - 1, int(shards * (middle + r["load"] / 2) / total))
        middle += r["load"]
    return _numbered(ranged, owner)


def _numbered(ranged: DataFrame, owner: np.ndarray) -> DataFrame:
    @F.pandas_udf("int")
    def shard_of(found: pd.Series) -> pd.Series:
        return pd.Series(owner[found.to_numpy()])

    placed = ranged.withColumn("shard", shard_of("range")).withColumn("one", F.lit(1))
    slots = running_totals(placed, ["k1", "k2", "doc_id"], ["one"], ["shard"])
    return slots.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("before_one").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write the documents below ``path`` in one folder per shard, named ``shard``.

    The name gets underscores in front where ``docs`` has such a column. Rows that share ``doc_id`` and
    text are dealt to the shards that hold them, by the numbers there.
    """
    key, crc, spread, place = (spare_name(docs, c) for c in ("key_of_row", "crc_of_row", "spread_of_row", "shard"))
    counts = shard(docs, shards).groupBy("doc_id", "text_crc32", "shard").agg(F.count("*").alias("n"))
    # An entry per shard at most.
    each = F.array_sort(F.collect_list(F.struct("shard", "n"))).alias(spread)
    placed = counts.groupBy(F.col("doc_id").alias(key), F.col("text_crc32").alias(crc)).agg(each)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(key)) & (F.crc32(text) == F.col(crc))
    total = F.aggregate(spread, F.lit(0).cast("long"), lambda sum_, entry: sum_ + entry["n"])
    turn = F.pmod(F.xxhash64(F.monotonically_increasing_id()), total)
    # What is left of the row's turn after each shard; the first that takes it below zero has the row.
    start = F.struct(turn.alias("left"), F.lit(-1).alias("shard"))
    step = lambda at, entry: F.struct(
        (at["left"] - entry["n"]).alias("left"), F.when(at["left"] >= 0, entry["shard"]).otherwise(at["shard"]).alias("shard")
    )
    chosen = F.aggregate(spread, start, step, lambda at: at["shard"])
    joined = docs.join(placed, same).withColumn(place, chosen).drop(key, crc, spread)
    joined.write.partitionBy(place).parquet(path)
