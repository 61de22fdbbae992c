"""Running totals over a sorted table without gathering it, or a group of it, in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scrubline.llm.tables import broadcast_if_small, shuffle_partitions
from scrubline.workspace import written


def running_totals(
    df: DataFrame, order: list[str], values: list[str], groups: list[str] | None = None
) -> DataFrame:
    """Add ``before_<value>``: the sum of the value over earlier rows of the same group.

    Rows are range-partitioned by group and order, so a group of any size spreads over ranges. Each
    range is summed, the sums of earlier ranges (one row per range and group) are added up, and only
    rows of one range meet in a window. Group columns must not be null.
    """
    groups = groups or []
    ranges = shuffle_partitions(df.sparkSession)
    ranged = df.repartitionByRange(ranges, *groups, *order)
    ranged = written(ranged.withColumn("_range", F.spark_partition_id()), "ranged")
    sums = ranged.groupBy("_range", *groups).agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
    earlier = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "_range",
        *groups,
        *[F.coalesce(F.sum(f"_sum_{v}").over(earlier), F.lit(0)).alias(f"_offset_{v}") for v in values],
    )
    offsets = broadcast_if_small(written(offsets, "offsets"))
    within = (
        Window.partitionBy("_range", *groups)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = ranged.join(offsets, ["_range", *groups])
    return joined.select(
        *[c for c in df.columns],
        *[
            (F.col(f"_offset_{v}") + F.coalesce(F.sum(v).over(within), F.lit(0))).alias(f"before_{v}")
            for v in values
        ],
    )
