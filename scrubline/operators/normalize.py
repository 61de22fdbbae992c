"""Normalizers: the same rows with one column brought to its canonical form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.functions import fields
from scrubline.operators.detect import state_vocabulary
from scrubline.operators.grouping import canonical_name_map
from scrubline.workspace import written

# Rows of one name beyond which its mapping is broadcast.
HOT_NAME_ROWS = 100_000


def normalize_parts(df: DataFrame, col: str = "part_number") -> DataFrame:
    return df.withColumn(col, fields.normalized_part_number(F.col(col)))


def normalize_states(df: DataFrame, col: str = "state") -> DataFrame:
    """Known variants to their canonical state; other values stay as they are."""
    if col not in df.columns:
        return df
    # The vocabulary is a fixed list of a dozen rows, so broadcasting it is safe.
    vocabulary = F.broadcast(state_vocabulary(df.sparkSession))
    joined = df.join(vocabulary, df[col].cast("string") == vocabulary.variant, "left")
    return joined.withColumn(col, F.coalesce(vocabulary.canonical, df[col])).select(*df.columns)


def normalize_suppliers(
    df: DataFrame, col: str = "name", order_col: str = "supplier_code", **limits
) -> tuple[DataFrame, DataFrame]:
    """Names to the canonical name of their group, and the mapping used."""
    mapping = canonical_name_map(df, col, order_col, **limits)
    return apply_name_map(df, mapping, col), mapping


def apply_name_map(df: DataFrame, mapping: DataFrame, col: str = "name", hot_rows: int = HOT_NAME_ROWS) -> DataFrame:
    """``df`` with names replaced by the canonical ones of ``mapping`` (variant, canonical).

    Names of many rows, NULL among them, are few; they and their mapping are broadcast, so their rows
    stay where they are. All other rows are shuffled to their mapping.
    """
    name = F.col(f"`{col}`")
    counts = df.groupBy(name.alias("hot_name")).agg(F.count("*").alias("n")).where(F.col("n") > hot_rows)
    # At most a row for each ``hot_rows`` rows of the table.
    hot = counts.join(mapping.withColumnRenamed("variant", "hot_name"), "hot_name", "left")
    hot = written(hot.select("hot_name", "canonical"), "hot-names")
    if hot.isEmpty():
        return _mapped(df, mapping, col, df[col] == mapping.variant)
    crowd = F.broadcast(hot)
    same = df[col].eqNullSafe(crowd.hot_name)
    names = F.broadcast(hot.select(F.col("hot_name").alias("any_hot_name")))
    rest = df.join(names, df[col].eqNullSafe(names.any_hot_name), "left_anti")
    spread = _mapped(df, crowd, col, same, "inner")
    return spread.unionByName(_mapped(rest, mapping, col, rest[col] == mapping.variant))


def _mapped(df: DataFrame, mapping: DataFrame, col: str, same: Column, how: str = "left") -> DataFrame:
    joined = df.join(mapping, same, how)
    return joined.select(
        *[F.coalesce(mapping.canonical, df[c]).alias(c) if c == col else df[c] for c in df.columns]
    )
