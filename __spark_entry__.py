
from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks.fixtures import as_csv, as_lines, as_manifests, as_workbooks, messy  # noqa: E402
from checks.oracles import ORACLES, SHOWN_NAME  # noqa: E402
from scrubline import fixed  # noqa: E402
from scrubline.functions import fields, text  # noqa: E402
from scrubline.operators import detect as d  # noqa: E402
from scrubline.operators import grouping, normalize, scoring, similarity  # noqa: E402
from scrubline.plans import pipelines, reports  # noqa: E402
from scrubline.sources import csv_files, manifests, sinks, workbooks  # noqa: E402
from scrubline.workspace import scratch_path, written  # noqa: E402

try:
    import corpus_pipeline  # noqa: E402
    from scrubline.llm import queries as llm  # noqa: E402
except ImportError as missing:
    # The training-data operators are an optional part, with libraries of their own. Anything that is
    # missing from the rest of the package is an error.
    if (missing.name or "").startswith("scrubline.") and not missing.name.startswith("scrubline.llm"):
        raise
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]

ALL_CATEGORIES = list(fixed.MANIFEST_RECORDS)
ROW_CATEGORIES = [c for c in ALL_CATEGORIES if c != fixed.NEAR_DUPLICATES]


def entry(spark: SparkSession) -> DataFrame:
    """The scorecard of all five checks on the smallest tables."""
    return scorecard_all(spark, "/root/testdata/sf0.001")


# --- detections -----------------------------------------------------------------


def row_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defects of the four checks that look at one row at a time."""
    return (
        d.non_standard_part_numbers(messy(spark, sf_dir, "parts_messy"))
        .unionByName(d.invalid_emails(messy(spark, sf_dir, "suppliers_messy")))
        .unionByName(d.change_order_defects(messy(spark, sf_dir, "change_orders_messy")))
    )


def all_detections(spark: SparkSession, sf_dir: str) -> pipelines.Detection:
    return pipelines.detect(
        parts=messy(spark, sf_dir, "parts_messy"),
        suppliers=messy(spark, sf_dir, "suppliers_messy"),
        change_orders=messy(spark, sf_dir, "change_orders_messy"),
    )


def impossible_dates_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date check on text, as CSV and workbook sources deliver it."""
    orders = messy(spark, sf_dir, "change_orders_messy")
    text = orders.withColumns({c: F.col(c).cast("string") for c in ("opened_at", "closed_at")})
    return d.impossible_dates(text).select("record_key")


def dates_in_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change orders with dates as people write them; every seventh two have none."""
    orders = messy(spark, sf_dir, "change_orders_messy")
    patterns = ["yyyy-MM-dd", "M/d/yyyy", "d MMM yyyy", "yyyyMMdd", "yyyy-MM-dd'T'HH:mm:ss"]
    kind = F.col("o_orderkey") % 7
    for column in ("opened_at", "closed_at"):
        text = F.when(kind == 5, F.lit("08:00:00")).otherwise("soon")
        if column == "opened_at":
            text = F.date_format(column, "yyyy-MM-dd")
        for at, pattern in enumerate(patterns):
            text = F.when(kind == at, F.date_format(column, pattern)).otherwise(text)
        orders = orders.withColumn(column, F.when(F.col(column).isNotNull(), text))
    return orders


def impossible_dates_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pipelines.detect(change_orders=dates_in_formats(spark, sf_dir)).defects
    return found.where(F.col("category") == fixed.IMPOSSIBLE_DATES).select("record_key")


def dates_day_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change orders opened at dates like 13/1/2024 or 13.1.2024 8:05, closed at dates like 1/13/2024.

    Orders of a month with 12 days or fewer alone could be read both ways; their columns say how.
    """
    orders = messy(spark, sf_dir, "change_orders_messy")
    opened = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("opened_at", "d.M.yyyy H:mm"))
    opened = opened.otherwise(F.date_format("opened_at", "d/M/yyyy"))
    return orders.withColumns({"opened_at": opened, "closed_at": F.date_format("closed_at", "M/d/yyyy")})


def impossible_dates_day_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.change_order_defects(dates_day_first(spark, sf_dir)).where(
        F.col("category") == fixed.IMPOSSIBLE_DATES
    ).select("record_key")


def date_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How both columns write dates, and a column of days up to the twelfth, which nothing settles."""
    rows = dates_day_first(spark, sf_dir)
    early = F.when(F.split("opened_at", "[/.]")[0].cast("int") <= 12, F.replace("opened_at", F.lit("/"), F.lit("-")))
    return d.date_orders(rows.withColumn("early", early), ("opened_at", "closed_at", "early"))


def unparsed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.unparsed_dates(dates_in_formats(spark, sf_dir))


def impossible_dates_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date rule across a join of two fact tables."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    wrong = joined.where(fields.closed_before_opened(F.col("o_orderdate"), F.col("l_shipdate")))
    return wrong.select("l_orderkey", "l_linenumber", "o_orderdate", "l_shipdate")


def missing_column_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts without key columns are whole; without the checked column they are zero."""
    suppliers = messy(spark, sf_dir, "suppliers_messy")
    orders = messy(spark, sf_dir, "change_orders_messy")
    cases = {
        "emails without codes": d.invalid_emails(suppliers.drop("supplier_code")),
        "states without numbers": d.state_variants(orders.drop("co_number")),
        "dates without numbers": d.impossible_dates(orders.drop("co_number")),
        "no email column": d.invalid_emails(suppliers.drop("contact_email")),
        "no state column": d.state_variants(orders.drop("state")),
        "no close column": d.impossible_dates(orders.drop("closed_at")),
    }
    parts = [
        found.agg(F.count("*").alias("defect_count"), F.count("record_key").alias("keyed_count")).select(
            F.lit(name).alias("input"), "defect_count", F.col("keyed_count").cast("int")
        )
        for name, found in cases.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# --- scores ---------------------------------------------------------------------


def row_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.outcomes(
        row_defects(spark, sf_dir), messy(spark, sf_dir, "truth"), ROW_CATEGORIES
    )


def scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = scoring.category_counts(row_outcomes(spark, sf_dir), ROW_CATEGORIES)
    return scoring.scorecard_of(counts, unrounded=True)


def scorecard_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = all_detections(spark, sf_dir)
    return pipelines.score(found, messy(spark, sf_dir, "truth"), unrounded=True)


def outcomes_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of every key of all five checks, the near-duplicate pairs listed."""
    found = all_detections(spark, sf_dir)
    truth = messy(spark, sf_dir, "truth")
    return scoring.outcomes(found.all_defects(), truth, found.categories, found.duplicates.parts)


def pair_scorecard(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Scores of near-duplicate pairs alone, for codes that repeat, share names or hold arrows."""
    index = similarity.duplicate_index(messy(spark, sf_dir, f"suppliers_{kind}"))
    counts = scoring.pair_counts(index, messy(spark, sf_dir, f"truth_{kind}"))
    return scoring.scorecard_of(counts, unrounded=True)


def validated(spark: SparkSession, sf_dir: str) -> pipelines.Validation:
    """All checks scored against manifest files."""
    return pipelines.validation(manifest(spark, sf_dir), all_detections(spark, sf_dir))


def validation_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = scoring.with_health(validated(spark, sf_dir).scorecard)
    return shown.select(
        "category", *scoring.COUNTS, "recall", "precision", "f1", "health", "recall_percent"
    )


def validation_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key on which detection and manifest disagree, pairs included."""
    found = validated(spark, sf_dir)
    wrong = found.false_positives.unionByName(found.pair_false_positives())
    missed = found.false_negatives.withColumn("outcome", F.lit("false_negative"))
    return wrong.withColumn("outcome", F.lit("false_positive")).unionByName(missed)


def full_report(spark: SparkSession, sf_dir: str, truth: DataFrame | None = None) -> pipelines.Report:
    return pipelines.report(
        parts=messy(spark, sf_dir, "parts_messy"),
        suppliers=messy(spark, sf_dir, "suppliers_messy"),
        change_orders=messy(spark, sf_dir, "change_orders_messy"),
        manifest=truth,
    )


def report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as JSON, written with the sink and read back."""
    result = full_report(spark, sf_dir, manifest(spark, sf_dir))
    out = scratch_path(spark, "report")
    rows = reports.report_rows(result.checks, result.scorecard)
    sinks.write_report(reports.envelope(rows, source="tables"), out)
    return spark.read.json(out).select(
        "source",
        "section",
        "name",
        F.coalesce(F.get_json_object("body", "$.defect_count").cast("bigint"), F.lit(-1)).alias("defect_count"),
        F.coalesce(F.get_json_object("body", "$.recall").cast("double"), F.lit(-1.0)).alias("recall"),
    )


def manifest_integrity_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest with one problem of each kind, made of the true counts."""
    truth = messy(spark, sf_dir, "truth").where("record_key is not null")
    by = {c: F.col("category") == c for c in fixed.MANIFEST_RECORDS}
    counts = {c: F.count_if(is_it) for c, is_it in by.items()}
    keys = {c: F.collect_list(F.when(is_it, F.col("record_key"))) for c, is_it in by.items()}
    parts, pairs, emails, states, dates = (
        fixed.PART_NUMBERS, fixed.NEAR_DUPLICATES, fixed.INVALID_EMAILS, fixed.STATE_VARIANTS,
        fixed.IMPOSSIBLE_DATES,
    )
    named = lambda c, value: value.alias(fixed.MANIFEST_COUNTS[c][1])
    listed = lambda c, value: value.alias(fixed.MANIFEST_RECORDS[c])
    document = F.struct(
        F.lit(2).alias("manifest_version"),
        F.struct(
            F.struct(named(parts, counts[parts])).alias("parts"),
            F.struct(named(emails, counts[emails] + 1)).alias("suppliers"),
            F.struct(named(states, counts[states]), named(dates, counts[dates])).alias("change_orders"),
        ).alias("defects"),
        F.struct(
            listed(parts, keys[parts]), listed(pairs, keys[pairs]), listed(emails, keys[emails]),
            listed(dates, counts[dates]),
        ).alias("defect_records"),
    )
    documents = manifests.manifest_documents(truth.agg(F.to_json(document).alias("value")))
    found = manifests.manifest_integrity(documents, ALL_CATEGORIES)
    shown = {c: F.coalesce(c, F.lit(-1)) for c in ("expected", "listed")}
    return found.drop("position").withColumns(shown)


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests.read_manifest(spark, as_manifests(messy(spark, sf_dir, "truth")))


def manifest_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests.manifest_integrity(manifest(spark, sf_dir), ALL_CATEGORIES).drop("position")


# --- files ----------------------------------------------------------------------

V1_FILE = {column: header for header, column in fixed.PART_HEADERS_V1.items()}
V2_FILE = {
    "part_number": "part_number",
    "name": "name",
    "uom": "uom",
    "category": "category",
    "status": "status",
    "legacy_ref": "legacy_ref",
}


def parts_file(spark: SparkSession, sf_dir: str, headers: dict[str, str]) -> str:
    parts = messy(spark, sf_dir, "parts_messy").withColumn("legacy_ref", F.lit("old"))
    return as_csv(parts, headers)


def csv_auto_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = [parts_file(spark, sf_dir, headers) for headers in (V1_FILE, V2_FILE)]
    return csv_files.read_parts(spark, folders)


def suppliers_cp1252_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = messy(spark, sf_dir, "suppliers_messy").withColumn("name", F.expr(SHOWN_NAME))
    headers = {"name": "Supplier Name", "supplier_code": "code", "contact_email": "email"}
    return csv_files.read_suppliers(spark, as_csv(suppliers, headers, windows=True))


def csv_clean_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized parts, written with the sink and read back."""
    cleaned, _ = pipelines.normalize("parts", messy(spark, sf_dir, "parts_messy"))
    out = scratch_path(spark, "clean")
    sinks.write_clean_csv(cleaned, out)
    return csv_files.read_parts(spark, out)


def lines_with_rejects(spark: SparkSession, sf_dir: str) -> str:
    """Supplier lines, every seventh with a comma too many in an unquoted name."""
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    extra = F.when(F.col("s_suppkey") % 7 == 0, ",more, cells").otherwise("")
    line = F.concat("s_name", F.lit(","), F.col("s_suppkey").cast("string"), extra)
    return as_lines(suppliers.select(line.alias("value")).repartition(3), "name,code")


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_files.csv_rejects(spark, lines_with_rejects(spark, sf_dir)).select("record")


def csv_rows_beside_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_files.read_suppliers(spark, lines_with_rejects(spark, sf_dir), bad_rows="skip")


def csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with line breaks and quotes inside quoted cells."""
    suppliers = messy(spark, sf_dir, "suppliers_messy")
    broken = F.when(F.col("s_suppkey") % 3 == 0, F.concat("name", F.lit('\n"next" line')))
    suppliers = suppliers.withColumn("name", F.coalesce(broken, "name"))
    headers = {"name": "Supplier", "supplier_code": "code", "contact_email": "email"}
    return csv_files.read_suppliers(spark, as_csv(suppliers, headers))


def normalize_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers from files that are not sorted by code: the first name in a file leads."""
    suppliers = messy(spark, sf_dir, "suppliers_messy").orderBy(F.desc("s_suppkey"))
    headers = {"supplier_code": "code", "name": "name", "contact_email": "email"}
    read = csv_files.read_suppliers(spark, as_csv(suppliers, headers), positions=True)
    cleaned, _ = pipelines.normalize("suppliers", read, order_col=csv_files.POSITION)
    return cleaned.drop(csv_files.POSITION)


def workbook_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = as_workbooks(messy(spark, sf_dir, "change_orders_messy"))
    return workbooks.read_change_orders(spark, f"{folder}/*.xlsx")


def cleaned_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cell rules: line breaks, white space around, and the text that means "no value"."""
    kind = F.col("o_orderkey") % 4
    cell = F.when(kind == 0, " nan\t").when(kind == 1, F.concat(F.lit(" one\n"), F.col("co_number")))
    cell = cell.when(kind == 2, "nano")
    orders = messy(spark, sf_dir, "change_orders_messy")
    return orders.select("co_number", text.clean_cell(cell).alias("cell"))


# --- reports --------------------------------------------------------------------


def supplier_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.name_groups(messy(spark, sf_dir, "suppliers_messy"))


def checks_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    defects = written(row_defects(spark, sf_dir), "defects")
    return reports.check_rows(defects, ROW_CATEGORIES, supplier_groups(spark, sf_dir))


def stream_part_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part-number check on a stream of files, run until it has read them all."""
    schema = spark.read.parquet(f"{sf_dir}/part.parquet").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/part*.parquet")
    stream.createOrReplaceTempView("part")
    from checks.fixtures import PARTS

    defects = d.non_standard_part_numbers(spark.sql(PARTS))
    out, progress = scratch_path(spark, "stream"), scratch_path(spark, "progress")
    query = (
        defects.writeStream.format("parquet")
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return spark.read.schema(defects.schema).parquet(out)


def queries() -> dict[str, Query]:
    def on(table: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
        return lambda spark, sf_dir: operator(messy(spark, sf_dir, table))

    parts, suppliers, orders = "parts_messy", "suppliers_messy", "change_orders_messy"
    groups_of = lambda then: lambda spark, sf_dir: then(supplier_groups(spark, sf_dir))
    found = {
        "era_distribution": on(parts, d.era_distribution),
        "part_number_non_standard": on(parts, d.non_standard_part_numbers),
        "part_number_summary": on(parts, d.part_number_summary),
        "unknown_part_numbers": on(parts, d.unknown_part_numbers),
        "normalize_part_numbers": on(parts, normalize.normalize_parts),
        "invalid_emails": on(suppliers, d.invalid_emails),
        "invalid_email_examples": on(suppliers, d.invalid_email_examples),
        "state_variants": on(orders, d.state_variants),
        "state_variant_counts": on(orders, d.state_variant_counts),
        "unknown_states": on(orders, d.unknown_states),
        "normalize_states": on(orders, normalize.normalize_states),
        "impossible_dates": on(orders, d.impossible_dates),
        "change_order_defects": on(orders, d.change_order_defects),
        "impossible_dates_text": impossible_dates_text,
        "impossible_dates_lineitem": impossible_dates_lineitem,
        "supplier_duplicate_pairs": on(suppliers, similarity.duplicate_pairs),
        "name_duplicate_matches": on(suppliers, similarity.name_matches),
        "name_duplicate_groups": groups_of(lambda g: g.select("canonical", "variant", "score")),
        "name_groups_in_order": groups_of(
            lambda g: grouping.listed(g).select("canonical", "variant", "score", "position")
        ),
        "report_field_previews": lambda s, sf: reports.field_previews(full_report(s, sf).details),
        "name_duplicate_group_count": groups_of(grouping.group_count),
        "canonical_name_map": on(suppliers, grouping.canonical_name_map),
        "normalize_suppliers": on(suppliers, lambda df: normalize.normalize_suppliers(df)[0]),
        "scorecard": scorecard,
        "scorecard_all": scorecard_all,
        "scorecard_outcomes": row_outcomes,
        "scorecard_outcomes_all": outcomes_all,
        "false_positives": lambda s, sf: scoring.false_positives(row_outcomes(s, sf)),
        "false_negatives": lambda s, sf: scoring.false_negatives(row_outcomes(s, sf)),
        "expected_counts": lambda s, sf: manifests.expected_counts(manifest(s, sf)),
        "truth_keys": lambda s, sf: manifests.truth_keys(manifest(s, sf)),
        "manifest_integrity": manifest_integrity,
        "csv_v1_roundtrip": lambda s, sf: csv_files.read_parts(s, parts_file(s, sf, V1_FILE), "v1"),
        "csv_v2_roundtrip": lambda s, sf: csv_files.read_parts(s, parts_file(s, sf, V2_FILE), "v2"),
        "csv_auto_schema": csv_auto_schema,
        "suppliers_cp1252_roundtrip": suppliers_cp1252_roundtrip,
        "workbook_scan": workbook_scan,
        "cleaned_cells": cleaned_cells,
        "missing_column_guards": missing_column_guards,
        "defect_summary": lambda s, sf: d.defect_summary(row_defects(s, sf)),
        "report_checks": lambda s, sf: checks_table(s, sf).drop("details"),
        "report_previews": lambda s, sf: reports.previews(row_defects(s, sf)),
        "detection_total": lambda s, sf: reports.summary(checks_table(s, sf)),
        "stream_part_defects": stream_part_defects,
        "csv_clean_sink": csv_clean_sink,
        "csv_rejects": csv_rejects,
        "csv_rows_beside_rejects": csv_rows_beside_rejects,
        "csv_line_breaks": csv_line_breaks,
        "impossible_dates_formats": impossible_dates_formats,
        "unparsed_dates": unparsed_dates,
        "impossible_dates_day_first": impossible_dates_day_first,
        "date_orders": date_orders,
        "normalize_file_order": normalize_file_order,
        "numbered_name_groups": lambda s, sf: grouping.name_groups(
            messy(s, sf, "numbered")
        ).select("canonical", "variant", "score"),
        "scorecard_repeated_codes": lambda s, sf: pair_scorecard(s, sf, "repeated"),
        "scorecard_shared_name": lambda s, sf: pair_scorecard(s, sf, "shared"),
        "scorecard_many_names": lambda s, sf: pair_scorecard(s, sf, "many"),
        "scorecard_arrow_codes": lambda s, sf: pair_scorecard(s, sf, "arrows"),
        "validation_scorecard": validation_scorecard,
        "validation_keys": validation_keys,
        "report_sections": lambda s, sf: full_report(s, sf).details,
        "report_json": report_json,
        "manifest_integrity_problems": manifest_integrity_problems,
    }
    if llm:
        found |= llm.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = dict(ORACLES)
    if llm:
        found |= llm.ORACLES
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
