"""Bounded samples for fitting, drawn without sending more than a few times their size anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows let through before the exact cut, as a multiple of the rows wanted.
SPARE = 2.0


def smallest_hashes(df: DataFrame, keys: list[str], wanted: int, rows: int) -> DataFrame:
    """The ``wanted`` rows with the smallest hash of ``keys``; ``rows`` is the table's count.

    A threshold on the hash comes first, so that a task hands on its share of the sample and not
    ``wanted`` rows of its own.
    """
    dice = F.shiftrightunsigned(F.xxhash64(*keys), 11) / float(1 << 53)
    let_through = SPARE * wanted / max(rows, 1)
    few = df.where(dice < let_through) if let_through < 1 else df
    return few.orderBy(dice, *keys).limit(wanted)
