"""Vectors in tasks: reading them from Arrow, and packing sorted rows into blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from scrubline.llm.tables import shuffle_partitions


def usable(embedding: Column) -> Column:
    """Neither null nor holding a null or non-finite component."""
    finite = F.forall(
        embedding,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")),
    )
    return F.coalesce(finite, F.lit(False))


def rows_of(column: pa.Array) -> list[np.ndarray]:
    """The vectors of a list column as double arrays."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(column.offsets.to_numpy())
    return np.split(values, np.cumsum(sizes)[:-1]) if len(sizes) else []


def matrix(rows: list[np.ndarray], width: int) -> np.ndarray:
    """Vectors below each other, short ones filled up with zeros."""
    found = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        found[i, : len(row)] = row[:width]
    return found


def centres(sample: np.ndarray, wanted: int, steps: int = 8) -> np.ndarray:
    """Centres by Lloyd's steps, started from rows drawn with a fixed seed."""
    if not len(sample):
        return sample
    dice = np.random.default_rng(0)
    found = sample[np.sort(dice.permutation(len(sample))[: min(wanted, len(sample))])]
    for _ in range(steps):
        nearest = squared_distances(sample, found).argmin(axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, sample)
        counts = np.bincount(nearest, minlength=len(found))[:, None]
        found = np.where(counts > 0, sums / np.maximum(counts, 1), found)
    return found


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Between all rows of ``a`` and of ``b``; tiny negative values become zero."""
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.maximum(squares, 0)


def packed(df: DataFrame, keys: list[str], order: list[str], size: int) -> DataFrame:
    """Blocks of up to ``size`` rows with the same ``keys``, consecutive in ``order``.

    A row per block: ``block`` (its number), the keys, and every other column as an array. Rows are
    range-partitioned by keys and order, so a key of any size becomes many blocks in many tasks.
    """
    carried = [c for c in df.columns if c not in keys]
    sorted_rows = df.select(*keys, *carried)
    ranges = shuffle_partitions(df.sparkSession)
    sorted_rows = sorted_rows.repartitionByRange(ranges, *keys, *order).sortWithinPartitions(*keys, *order)
    fields = {f.name: f for f in sorted_rows.schema.fields}
    schema = StructType(
        [StructField("block", LongType())]
        + [fields[k] for k in keys]
        + [StructField(c, ArrayType(fields[c].dataType)) for c in carried]
    )
    names = ["block", *keys, *carried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            n = batch.num_rows
            changes = np.zeros(n, bool)
            for i in range(len(keys)):
                key = batch.column(i).to_numpy(zero_copy_only=False)
                changes[1:] |= key[1:] != key[:-1]
            begins = np.flatnonzero(changes).tolist()
            cuts = [0]
            for end in [*begins, n]:
                cuts.extend(range(cuts[-1] + size, end, size))
                if end > cuts[-1]:
                    cuts.append(end)
            firsts = pa.array(cuts[:-1], pa.int64())
            offsets = pa.array(cuts, pa.int32())
            columns = [pa.array(range(number, number + len(cuts) - 1), pa.int64())]
            columns += [batch.column(i).take(firsts) for i in range(len(keys))]
            columns += [
                pa.ListArray.from_arrays(offsets, batch.column(i))
                for i in range(len(keys), batch.num_columns)
            ]
            number += len(cuts) - 1
            if n:
                yield pa.RecordBatch.from_arrays(columns, names)

    return sorted_rows.mapInArrow(run, schema)
