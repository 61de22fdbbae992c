"""Report tables: counts and short previews per check, totals, envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from scrubline import fixed
from scrubline.functions import rates
from scrubline.operators import detect as d
from scrubline.operators.scoring import COUNTS

RATES = ("recall", "precision", "f1")
PREVIEW_ITEMS = 3
PREVIEW_LENGTH = 120

CHECK_NAMES, GROUPS_CHECK = fixed.CHECK_NAMES, fixed.GROUPS_CHECK


def previews(defect_table: DataFrame) -> DataFrame:
    """(category, details): the first keys of each category, cut to a short line.

    The row-number limit is applied before the shuffle too, so each task passes
    on a few rows per category.
    """
    keyed = defect_table.where(F.col("record_key").isNotNull())
    by_key = Window.partitionBy("category").orderBy("record_key")
    first = keyed.select("category", "record_key", F.row_number().over(by_key).alias("at")).where(
        F.col("at") <= PREVIEW_ITEMS + 1
    )
    items = F.array_sort(F.collect_list("record_key"))
    shown = F.array_join(F.slice(items, 1, PREVIEW_ITEMS), ", ")
    more = F.when(F.count("*") > PREVIEW_ITEMS, "...").otherwise("")
    line = F.concat(F.lit("record_keys: ["), shown, F.lit("]"), more)
    return first.groupBy("category").agg(F.substring(line, 1, PREVIEW_LENGTH).alias("details"))


def field_previews(details_table: DataFrame) -> DataFrame:
    """(check, details): the first items of every field of ``details`` of a check, in a short line.

    Fields and their items come in the order of their text. Items with an amount, as states with their
    counts, show it in whole numbers. The row-number limit is applied before the shuffle too.
    """
    amount = F.floor("amount").cast("string")
    shown = F.concat_ws(": ", F.concat_ws(" < ", "item", "parent"), amount)
    by_item = Window.partitionBy("check", "field").orderBy("shown")
    rows = details_table.select("check", "field", shown.alias("shown"))
    first = rows.withColumn("at", F.row_number().over(by_item)).where(F.col("at") <= PREVIEW_ITEMS + 1)
    items = F.array_sort(F.collect_list("shown"))
    more = F.when(F.count("*") > PREVIEW_ITEMS, "...").otherwise("")
    line = F.concat(F.col("field"), F.lit(": ["), F.array_join(F.slice(items, 1, PREVIEW_ITEMS), ", "), F.lit("]"), more)
    lines = first.groupBy("check", "field").agg(line.alias("line"))
    # A check has a handful of fields.
    joined = F.array_join(F.array_sort(F.collect_list("line")), " | ")
    return lines.groupBy("check").agg(F.substring(joined, 1, PREVIEW_LENGTH).alias("details"))


def check_rows(
    defect_table: DataFrame, categories: list[str], groups: DataFrame | None = None
) -> DataFrame:
    """(check, defect_count, details), one row per check that ran."""
    spark = defect_table.sparkSession
    listed = [
        F.struct(F.lit(c).alias("category"), F.lit(CHECK_NAMES[c]).alias("check"))
        for c in categories
        if c in CHECK_NAMES
    ]
    kind = "array<struct<category: string, check: string>>"
    run = spark.range(1).select(F.inline(F.array(*listed).cast(kind)))
    counted = defect_table.groupBy("category").agg(F.count("*").alias("n"))
    rows = (
        run.join(counted, "category", "left")
        .join(previews(defect_table), "category", "left")
        .select(
            "check",
            F.coalesce("n", F.lit(0)).alias("defect_count"),
            F.coalesce("details", F.lit("")).alias("details"),
        )
    )
    if groups is None:
        return rows
    grouped = groups.agg(F.count_distinct("canonical").alias("defect_count")).select(
        F.lit(GROUPS_CHECK).alias("check"), "defect_count", F.lit("").alias("details")
    )
    return rows.unionByName(grouped)


def details(
    parts: DataFrame | None = None,
    change_orders: DataFrame | None = None,
    suppliers: DataFrame | None = None,
    groups: DataFrame | None = None,
    defect_table: DataFrame | None = None,
    formats: list[str] | None = None,
) -> DataFrame:
    """(check, field, item, parent, amount): what stands behind the counts of the checks.

    Long on purpose: lists of values, keys and group members may be as long as the
    sources, and no row holds more than one of them.
    """

    def rows(check: str, field: str, df: DataFrame, item: str, amount: str = "", parent: str = "") -> DataFrame:
        cell = lambda c, kind: (F.col(c) if c else F.lit(None)).cast(kind)
        return df.select(
            F.lit(check).alias("check"),
            F.lit(field).alias("field"),
            cell(item, "string").alias("item"),
            cell(parent, "string").alias("parent"),
            cell(amount, "double").alias("amount"),
        )

    tables = []
    if parts is not None:
        check = CHECK_NAMES[fixed.PART_NUMBERS]
        unknown = d.unknown_part_numbers(parts).groupBy("part_number").agg(F.count("*").alias("n"))
        tables += [
            rows(check, "eras", d.era_distribution(parts), "era", "n"),
            rows(check, "unknown", unknown, "part_number", "n"),
        ]
    if suppliers is not None:
        check, shown = CHECK_NAMES[fixed.INVALID_EMAILS], d.invalid_email_examples(suppliers)
        tables.append(rows(check, "examples", shown, "contact_email"))
    if change_orders is not None:
        states, dates = CHECK_NAMES[fixed.STATE_VARIANTS], CHECK_NAMES[fixed.IMPOSSIBLE_DATES]
        unparsed = d.unparsed_dates(change_orders, formats=formats)
        tables += [
            rows(states, "counts", d.state_variant_counts(change_orders), "state", "n"),
            rows(states, "unknown", d.unknown_states(change_orders), "state"),
            rows(dates, "unparsed", unparsed, "column", "n"),
        ]
        if formats is None:
            orders = d.date_orders(change_orders).withColumn("n", F.col("day_first") + F.col("month_first") + F.col("either"))
            orders = orders.withColumn("shown", F.concat("column", F.lit(" "), "separator"))
            tables.append(rows(dates, "day_order", orders, "order", "n", "shown"))
    if groups is not None:
        sizes = groups.groupBy("canonical").agg(F.count("*").alias("n"))
        tables += [
            rows(GROUPS_CHECK, "groups", sizes, "canonical", "n"),
            rows(GROUPS_CHECK, "variants", groups, "variant", "score", "canonical"),
        ]
    if defect_table is not None:
        keyed = defect_table.where(F.col("record_key").isNotNull())
        for category, check in CHECK_NAMES.items():
            tables.append(rows(check, "record_keys", keyed.where(F.col("category") == category), "record_key"))
    if not tables:
        raise ValueError("there is nothing to report on")
    result = tables[0]
    for more in tables[1:]:
        result = result.unionByName(more)
    return result


def summary(checks: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """(metric, value): the overall scores if there are any, else the defect total."""
    if scores is None:
        return checks.agg(F.coalesce(F.sum("defect_count"), F.lit(0)).alias("n")).select(
            F.lit("defect_count").alias("metric"), F.col("n").cast("string").alias("value")
        )
    overall = scores.where(F.col("category") == fixed.OVERALL)
    cell = lambda c: rates.percent(F.col(c)) if c in RATES else F.col(c).cast("string")
    lines = [
        F.struct(F.lit(c).alias("metric"), cell(c).alias("value")) for c in (*COUNTS, *RATES)
    ]
    pairs = F.array(*lines)
    return overall.select(F.inline(pairs))


def envelope(df: DataFrame, **labels: str) -> DataFrame:
    """Report rows with what they were made from, such as ``source`` and ``type``."""
    return df.select(*[F.lit(v).alias(k) for k, v in labels.items()], *df.columns)


def report_rows(checks: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """One table for the JSON report: detection rows, and validation rows if any."""
    detection = checks.select(
        F.lit("detection").alias("section"),
        F.col("check").alias("name"),
        F.to_json(F.struct("defect_count", "details")).alias("body"),
    )
    if scores is None:
        return detection
    body = F.to_json(F.struct(*[c for c in scores.columns if c != "category"]))
    return detection.unionByName(
        scores.select(
            F.lit("validation").alias("section"), F.col("category").alias("name"), body.alias("body")
        )
    )
