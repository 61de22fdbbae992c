"""The user-level pipelines: detect, normalize, validate, report.

Sources are DataFrames of the readers in ``scrubline.sources``. Results are
DataFrames too; ``scrubline.sources.sinks`` writes them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline import fixed
from scrubline.operators import detect as d
from scrubline.operators import grouping, normalize as n, scoring, similarity
from scrubline.plans import reports
from scrubline.sources import manifests
from scrubline.workspace import written

Options = dict[str, object]


@dataclass(frozen=True)
class Check:
    """Something to look for in one kind of source.

    ``find`` yields defect rows of the categories in one pass; ``index`` yields a
    duplicate index instead, for pairs that are not listed by default.
    """

    entity: str
    categories: list[str]
    find: Callable[[DataFrame, Options], DataFrame] | None = None
    index: Callable[[DataFrame, Options], similarity.DuplicateIndex] | None = None


def _duplicates(df: DataFrame, options: Options) -> similarity.DuplicateIndex:
    return options.get("duplicates") or similarity.duplicate_index(df)


# The checks of each source, in the order they are reported. Add to it with ``register``.
CHECKS: list[Check] = [
    Check("parts", [fixed.PART_NUMBERS], lambda df, _: d.non_standard_part_numbers(df)),
    Check("suppliers", [fixed.NEAR_DUPLICATES], index=_duplicates),
    Check("suppliers", [fixed.INVALID_EMAILS], lambda df, _: d.invalid_emails(df)),
    Check(
        "change_orders",
        [fixed.STATE_VARIANTS, fixed.IMPOSSIBLE_DATES],
        lambda df, options: d.change_order_defects(df, formats=options.get("formats")),
    ),
]


def register(check: Check) -> None:
    """Add a check; ``detect`` then runs it on the sources of its entity."""
    if (check.find is None) == (check.index is None):
        raise ValueError("a check has either find or index")
    CHECKS.append(check)


@dataclass
class Detection:
    """Defect rows of the checks that ran, and which checks those were.

    Near-duplicate pairs are kept as an index, because they can be many more
    than the rows; ``all_defects`` lists them too.
    """

    defects: DataFrame
    categories: list[str]
    duplicates: similarity.DuplicateIndex | None = None

    def all_defects(self) -> DataFrame:
        if self.duplicates is None:
            return self.defects
        pairs = self.duplicates.pairs().select(
            F.lit(fixed.NEAR_DUPLICATES).alias("category"),
            similarity.pair_key().alias("record_key"),
            F.format_string("%.1f", "score").alias("value"),
            F.lit("similar names").alias("detail"),
        )
        return self.defects.unionByName(pairs)


def detect(
    formats: list[str] | None = None,
    duplicates: similarity.DuplicateIndex | None = None,
    **sources: DataFrame | None,
) -> Detection:
    """Run the checks of each source given: ``parts``, ``suppliers``, ``change_orders``.

    ``formats`` are those of dates that are not in ISO form. ``duplicates`` is the
    index of the suppliers, where it is known already.
    """
    entities = list(dict.fromkeys(check.entity for check in CHECKS))
    given = {entity: df for entity, df in sources.items() if df is not None}
    if not given:
        raise ValueError("provide at least one of: " + ", ".join(entities))
    for entity in given:
        if entity not in entities:
            raise ValueError(f"no check looks at {entity}; there are: " + ", ".join(entities))
    options: Options = {"formats": formats, "duplicates": duplicates}
    tables, categories, index = [], [], None
    for entity, df in given.items():
        for check in CHECKS:
            if check.entity != entity:
                continue
            categories.extend(check.categories)
            if check.index is not None:
                index = check.index(df, options)
            else:
                tables.append(check.find(df, options))
    table = tables[0] if tables else d.no_defects(next(iter(given.values())).sparkSession)
    for more in tables[1:]:
        table = table.unionByName(more)
    return Detection(table, categories, index)


def normalize(
    entity: str, df: DataFrame, order_col: str = "supplier_code"
) -> tuple[DataFrame, DataFrame | None]:
    """Cleaned rows, and for suppliers the name mapping that was applied.

    The first name in the order of ``order_col`` is the canonical one; with rows
    read with ``positions``, ``source`` is the order of the files.
    """
    if entity == "parts":
        return n.normalize_parts(df), None
    if entity == "suppliers":
        return n.normalize_suppliers(df, order_col=order_col)
    if entity == "change_orders":
        return n.normalize_states(df), None
    raise ValueError(f"unknown entity {entity}")


def score(detection: Detection, truth: DataFrame, unrounded: bool = False) -> DataFrame:
    """Scorecard of a detection against truth keys."""
    by_row = [c for c in detection.categories if c != fixed.NEAR_DUPLICATES]
    counts = scoring.category_counts(
        scoring.outcomes(detection.defects, truth, by_row), by_row
    )
    if detection.duplicates is not None:
        counts = counts.unionByName(scoring.pair_counts(detection.duplicates, truth))
    return scoring.scorecard_of(counts, unrounded)


def validate(manifest: DataFrame, detection: Detection) -> DataFrame:
    """Scorecard of a detection against a manifest, which is checked first."""
    manifest = written(manifest, "manifest")
    manifests.check_manifest(manifest, detection.categories)
    return score(detection, manifests.truth_keys(manifest))


@dataclass
class Validation:
    """Scores with the keys behind them.

    ``false_positives`` holds those of row checks; duplicates that the truth does
    not name may be as many as all pairs, so they are listed on request.
    """

    scorecard: DataFrame
    false_positives: DataFrame
    false_negatives: DataFrame
    pairs: similarity.DuplicateIndex | None
    truth: DataFrame

    def pair_false_positives(self) -> DataFrame | None:
        return None if self.pairs is None else scoring.unwanted_pairs(self.pairs, self.truth)


def validation(manifest: DataFrame, detection: Detection) -> Validation:
    """Scores against a manifest, which is checked first, and the keys that disagree."""
    # The documents are parsed once and stored so; checks and keys read that.
    manifest = written(manifest, "manifest")
    manifests.check_manifest(manifest, detection.categories)
    truth = written(manifests.truth_keys(manifest), "truth")
    by_row = [c for c in detection.categories if c != fixed.NEAR_DUPLICATES]
    outcomes = written(scoring.outcomes(detection.defects, truth, by_row), "outcomes")
    counts = scoring.category_counts(outcomes, by_row)
    missed = scoring.false_negatives(outcomes)
    if detection.duplicates is not None:
        counts = counts.unionByName(scoring.pair_counts(detection.duplicates, truth))
        missed = missed.unionByName(scoring.missed_pairs(detection.duplicates, truth))
    scores = scoring.scorecard_of(counts)
    extra = scoring.false_positives(outcomes)
    return Validation(scores, extra, missed, detection.duplicates, truth)


@dataclass
class Report:
    """Everything a full run yields."""

    checks: DataFrame
    groups: DataFrame | None
    summary: DataFrame
    scorecard: DataFrame | None
    details: DataFrame
    validation: Validation | None


def report(
    parts: DataFrame | None = None,
    suppliers: DataFrame | None = None,
    change_orders: DataFrame | None = None,
    manifest: DataFrame | None = None,
    formats: list[str] | None = None,
    order_col: str | None = None,
) -> Report:
    """Run all checks over the sources given, and score them if there is a manifest.

    Suppliers are stored once, because groups, pairs and emails all read them, and
    their names are joined once, for pairs and groups alike; defects are stored
    once, because checks, details and scores read them.
    """
    groups = duplicates = None
    if suppliers is not None:
        suppliers = written(suppliers, "suppliers")
        if {"supplier_code", "name"} <= set(suppliers.columns):
            duplicates, groups = grouping.index_and_groups(suppliers, order_col=order_col)
            groups = written(groups, "groups")
    detection = detect(
        formats, duplicates, parts=parts, suppliers=suppliers, change_orders=change_orders
    )
    detection.defects = written(detection.defects, "defects")
    checks = reports.check_rows(detection.defects, detection.categories, groups)
    details = reports.details(parts, change_orders, suppliers, groups, detection.defects, formats)
    checked = None if manifest is None else validation(manifest, detection)
    scores = None if checked is None else checked.scorecard
    return Report(checks, groups, reports.summary(checks, scores), scores, details, checked)
