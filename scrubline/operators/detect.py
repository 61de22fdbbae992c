"""Detectors for rows that are wrong on their own.

Each detector returns a long defect table ``(category, record_key, value,
detail)`` with one row per offending input row. Counts come from aggregating
that table; keys are never collected. A row whose key is NULL stays in the
table, so it is counted, and is left out when keys are scored.

A column the input does not have means an empty result, not an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline import fixed
from scrubline.functions import fields

DEFECT_SCHEMA = "category string, record_key string, value string, detail string"


def defect(category: str, df: DataFrame, key: str, value: Column, detail: Column) -> Column:
    """One defect of a row of ``df`` as a struct; the key is NULL if ``df`` has no such column."""
    record_key = F.col(key).cast("string") if key in df.columns else F.lit(None).cast("string")
    return F.struct(
        F.lit(category).alias("category"),
        record_key.alias("record_key"),
        value.cast("string").alias("value"),
        detail.cast("string").alias("detail"),
    )


def defects(category: str, df: DataFrame, key: str, value: Column, detail: Column) -> DataFrame:
    return df.select(defect(category, df, key, value, detail).alias("found")).select("found.*")


def no_defects(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DEFECT_SCHEMA)


# --- part numbers ---------------------------------------------------------------


def non_standard_part_numbers(df: DataFrame, col: str = "part_number") -> DataFrame:
    tagged = df.withColumn("era", fields.era(F.col(col)))
    wrong = tagged.where(F.col("era") != "current")
    return defects(fixed.PART_NUMBERS, wrong, col, F.col(col), F.col("era"))


def era_distribution(df: DataFrame, col: str = "part_number") -> DataFrame:
    """Rows per era, most frequent first; eras that do not occur have no row."""
    return (
        df.groupBy(fields.era(F.col(col)).alias("era"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "era")
    )


def unknown_part_numbers(df: DataFrame, col: str = "part_number") -> DataFrame:
    """The raw values that match no era, one row per input row."""
    return df.where(fields.era(F.col(col)) == "unknown").select(F.col(col).alias("part_number"))


def part_number_summary(df: DataFrame, col: str = "part_number") -> DataFrame:
    kind = fields.era(F.col(col))
    return df.select(kind.alias("era")).agg(
        F.count_if(F.col("era") != "current").alias("non_standard_count"),
        F.count_if(F.col("era") == "unknown").alias("unknown_format_count"),
    )


# --- emails ---------------------------------------------------------------------


def invalid_emails(df: DataFrame, col: str = "contact_email") -> DataFrame:
    if col not in df.columns:
        return no_defects(df.sparkSession)
    wrong = df.where(fields.invalid_email(F.col(col)))
    return defects(
        fixed.INVALID_EMAILS, wrong, "supplier_code", F.col(col), F.lit("malformed address")
    )


def invalid_email_examples(
    df: DataFrame, order_col: str = "supplier_code", col: str = "contact_email", n: int = 10
) -> DataFrame:
    """The first ``n`` malformed addresses in ``order_col`` order."""
    if col not in df.columns:
        return df.sparkSession.createDataFrame([], "contact_email string")
    return (
        df.where(fields.invalid_email(F.col(col)))
        .orderBy(order_col, col)
        .limit(n)
        .select(F.col(col).alias("contact_email"))
    )


# --- states ---------------------------------------------------------------------


def state_vocabulary(spark: SparkSession) -> DataFrame:
    """(variant, canonical) for every known spelling, the canonical ones included."""
    rows = [
        F.struct(F.lit(variant).alias("variant"), F.lit(canonical).alias("canonical"))
        for variant, canonical in fixed.STATE_VOCABULARY
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _with_canonical_state(df: DataFrame, col: str, how: str) -> DataFrame:
    # The vocabulary is a fixed list of a dozen rows, so broadcasting it is safe.
    vocabulary = F.broadcast(state_vocabulary(df.sparkSession))
    return df.join(vocabulary, df[col].cast("string") == vocabulary.variant, how)


def state_variants(df: DataFrame, col: str = "state") -> DataFrame:
    if col not in df.columns:
        return no_defects(df.sparkSession)
    known = _with_canonical_state(df, col, "inner")
    wrong = known.where(F.col("variant") != F.col("canonical"))
    return defects(fixed.STATE_VARIANTS, wrong, "co_number", F.col(col), F.col("canonical"))


def state_variant_counts(df: DataFrame, col: str = "state") -> DataFrame:
    return state_variants(df, col).groupBy(F.col("value").alias("state")).agg(
        F.count("*").alias("n")
    )


def unknown_states(df: DataFrame, col: str = "state") -> DataFrame:
    """Distinct non-null states that are in no vocabulary entry."""
    if col not in df.columns:
        return df.sparkSession.createDataFrame([], "state string")
    present = df.where(F.col(col).isNotNull()).select(F.col(col).cast("string").alias("state"))
    return _with_canonical_state(present, "state", "left_anti").distinct()


# --- dates ----------------------------------------------------------------------


DATE_COLUMNS = ("opened_at", "closed_at")


def impossible_dates(
    df: DataFrame,
    open_col: str = "opened_at",
    close_col: str = "closed_at",
    formats: list[str] | None = None,
) -> DataFrame:
    """Rows closed before they were opened; values that do not parse are skipped."""
    if open_col not in df.columns or close_col not in df.columns:
        return no_defects(df.sparkSession)
    opened, closed = _as_timestamps(df, [open_col, close_col], formats)
    wrong = df.where(fields.closed_before_opened(opened, closed))
    return defects(
        fixed.IMPOSSIBLE_DATES,
        wrong,
        "co_number",
        F.col(close_col),
        F.concat(F.lit("opened "), F.col(open_col).cast("string")),
    )


def unparsed_dates(
    df: DataFrame, columns: tuple[str, ...] = DATE_COLUMNS, formats: list[str] | None = None
) -> DataFrame:
    """(column, n): values that hold text but no date, which the date check skips."""
    present = [c for c in columns if c in df.columns]
    counts = [
        F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNotNull() & value.isNull()).alias("n"))
        for c, value in zip(present, _as_timestamps(df, present, formats), strict=True)
    ]
    if not counts:
        return df.sparkSession.createDataFrame([], "column string, n bigint")
    return df.agg(F.array(*counts).alias("found")).select(F.inline("found"))


def date_orders(df: DataFrame, columns: tuple[str, ...] = DATE_COLUMNS) -> DataFrame:
    """(column, separator, day_first, month_first, either, order): how text columns write day and month.

    Counts values like 13/1/2024 that only read with the day first, like 1/13/2024 that only read with
    the month first, and like 3/4/2024 that read both ways. ``order`` is what the first two say by
    majority; ``ambiguous`` if they are equal, as where there are none: then the month is taken first.
    One pass over the rows gives a row for each column and separator in use.
    """
    found = []
    for c in columns:
        if c not in df.columns or _is_typed(df, c):
            continue
        text = F.trim(F.col(c).cast("string"))
        part = lambda at, text=text: F.regexp_extract(text, fields.DAY_AND_MONTH, at)
        first, second = part(1).try_cast("int"), part(3).try_cast("int")
        for separator in fields.SEPARATORS:
            counts = {
                "day_first": first.between(13, 31) & second.between(1, 12),
                "month_first": first.between(1, 12) & second.between(13, 31),
                "either": first.between(1, 12) & second.between(1, 12),
            }
            counted = [F.count_if((part(2) == separator) & is_so).alias(name) for name, is_so in counts.items()]
            found.append(F.struct(F.lit(c).alias("column"), F.lit(separator).alias("separator"), *counted))
    if not found:
        schema = "column string, separator string, day_first bigint, month_first bigint, either bigint, order string"
        return df.sparkSession.createDataFrame([], schema)
    days, months = F.col("day_first"), F.col("month_first")
    order = F.when(days > months, "day_first").when(months > days, "month_first").otherwise("ambiguous")
    rows = df.agg(F.array(*found).alias("found")).select(F.inline("found"))
    return rows.where(days + months + F.col("either") > 0).withColumn("order", order)


def _is_typed(df: DataFrame, col: str) -> bool:
    return df.schema[col].dataType.typeName() in ("timestamp", "timestamp_ntz", "date")


def _as_timestamps(df: DataFrame, columns: list[str], formats: list[str] | None) -> list[Column]:
    """The columns as timestamps. Without ``formats``, text columns are first asked for their order of day
    and month, in one pass that returns a few rows; a stream takes the month first."""
    text = [c for c in columns if not _is_typed(df, c)]
    day_first = dict.fromkeys(columns, "")
    if formats is None and text and not df.isStreaming:
        for row in date_orders(df, tuple(text)).where(F.col("order") == "day_first").collect():
            day_first[row["column"]] += row["separator"]
    # Typed columns are compared as they are, so the scan can still use them.
    return [F.col(c) if c not in text else fields.lenient_timestamp(F.col(c), formats, day_first[c]) for c in columns]


def change_order_defects(
    df: DataFrame,
    state_col: str = "state",
    open_col: str = "opened_at",
    close_col: str = "closed_at",
    formats: list[str] | None = None,
) -> DataFrame:
    """State variants and impossible dates in one pass over the rows."""
    checks = []
    rows = df
    if open_col in df.columns and close_col in df.columns:
        opened, closed = _as_timestamps(df, [open_col, close_col], formats)
        detail = F.concat(F.lit("opened "), F.col(open_col).cast("string"))
        found = defect(fixed.IMPOSSIBLE_DATES, df, "co_number", F.col(close_col), detail)
        checks.append(F.when(fields.closed_before_opened(opened, closed), found))
    if state_col in df.columns:
        rows = _with_canonical_state(df, state_col, "left")
        found = defect(fixed.STATE_VARIANTS, df, "co_number", F.col(state_col), F.col("canonical"))
        checks.append(F.when(F.col("variant") != F.col("canonical"), found))
    if not checks:
        return no_defects(df.sparkSession)
    present = F.filter(F.array(*checks), lambda found: found.isNotNull())
    return rows.select(F.explode(present).alias("found")).select("found.*")


# --- summaries ------------------------------------------------------------------


def defect_summary(defect_table: DataFrame) -> DataFrame:
    """Defects per category: all rows, and rows that carry a key."""
    return defect_table.groupBy("category").agg(
        F.count("*").alias("defect_count"),
        F.count("record_key").alias("keyed_count"),
    )
