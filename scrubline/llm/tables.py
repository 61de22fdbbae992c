"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Rows that a Python task turns into objects at a time.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_slices(
    df: DataFrame,
    rule: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str | StructType,
    rows: int = SLICE_ROWS,
) -> DataFrame:
    """``rule`` over slices of a few rows, so that what it makes of them stays small in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                yield rule(batch.slice(start, rows))
            # What a long batch took goes back, as other workers share the executor's memory.
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def union_all(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def spare_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores in front as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def is_empty(df: DataFrame) -> bool:
    return df.limit(1).count() == 0


def stored_bytes(df: DataFrame) -> int:
    """Spark's own estimate of a stored table's size, to decide about a broadcast."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, most_bytes: int = 8 << 20) -> DataFrame:
    """Hint a broadcast of a stored table only below a size; else Spark shuffles both sides.

    The size is that of the stored files; in memory a table takes several times as much.
    """
    return F.broadcast(df) if stored_bytes(df) <= most_bytes else df
