"""Scoring arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrubline.fixed import HEALTH_GREEN, HEALTH_YELLOW


def share(part: Column, whole: Column) -> Column:
    """``part / whole``, and 1.0 where there was nothing to find."""
    return F.when(whole == 0, F.lit(1.0)).otherwise(
        F.try_divide(part.cast("double"), whole.cast("double"))
    )


def f1(precision: Column, recall: Column) -> Column:
    both = precision + recall
    return F.when(both == 0, F.lit(0.0)).otherwise(F.try_divide(2 * precision * recall, both))


def rounded(rate: Column) -> Column:
    """Four digits, ties to even."""
    return F.bround(rate, 4)


def health(rate: Column) -> Column:
    return (
        F.when(rate >= HEALTH_GREEN, "green")
        .when(rate >= HEALTH_YELLOW, "yellow")
        .otherwise("red")
    )


def percent(rate: Column) -> Column:
    """One decimal and a percent sign."""
    return F.format_string("%.1f%%", F.bround(rate * 100, 1))
