"""Sinks: cleaned tables and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_clean_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """A folder of UTF-8 CSV files with headers, quotes doubled and spaces kept."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_report(df: DataFrame, path: str, mode: str = "error") -> None:
    """A folder of JSON lines; types JSON does not have become text."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
