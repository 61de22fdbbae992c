"""Scoring detections against ground truth, at row-key level.

Detections and truth are both long tables ``(category, record_key)``. Which
categories were run is an input of its own: a category that ran and found
nothing is scored, one that did not run is not, and key rows cannot tell the
two apart.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline import fixed
from scrubline.functions import rates
from scrubline.operators.similarity import ARROW, DuplicateIndex, pair_key
from scrubline.workspace import written

# Groups of codes that may share a key before their pairs are counted instead of listed.
HOT_GROUPS = 64

COUNTS = ["expected", "detected", "matched", "false_positives", "false_negatives"]


def scored_categories(spark: SparkSession, categories: list[str]) -> DataFrame:
    """The categories that were run and that the scorer knows; others are skipped."""
    known = [c for c in dict.fromkeys(categories) if c in fixed.MANIFEST_RECORDS]
    listed = F.array(*map(F.lit, known)).cast("array<string>")
    return spark.range(1).select(F.explode(listed).alias("category"))


def outcomes(
    detected: DataFrame, truth: DataFrame, categories: list[str], parts: int | None = None
) -> DataFrame:
    """(category, record_key, outcome) for every distinct key on either side.

    One shuffle: both sides are tagged and grouped on (category, record_key), so
    duplicate keys collapse before they travel and no category, however large,
    is ever brought together in one task. ``parts`` is the number of tasks for the
    keys, where listed pairs are among them (``DuplicateIndex.parts``); then a task
    holds its share alone, and keys travel as they come.
    """
    found = _keys(detected, categories).select(
        "category", "record_key", F.lit(1).alias("found"), F.lit(0).alias("wanted")
    )
    wanted = _keys(truth, categories).select(
        "category", "record_key", F.lit(0).alias("found"), F.lit(1).alias("wanted")
    )
    both = found.unionByName(wanted)
    if parts:
        both = both.repartition(parts, "category", "record_key")
    merged = both.groupBy("category", "record_key").agg(F.max("found").alias("found"), F.max("wanted").alias("wanted"))
    outcome = (
        F.when((F.col("found") == 1) & (F.col("wanted") == 1), "matched")
        .when(F.col("found") == 1, "false_positive")
        .otherwise("false_negative")
    )
    return merged.select("category", "record_key", outcome.alias("outcome"))


def _keys(df: DataFrame, categories: list[str]) -> DataFrame:
    known = [c for c in categories if c in fixed.MANIFEST_RECORDS]
    return df.where(F.col("category").isin(known) & F.col("record_key").isNotNull())


def false_positives(outcome_table: DataFrame) -> DataFrame:
    """Detected keys the truth does not hold, sorted."""
    return _only(outcome_table, "false_positive")


def false_negatives(outcome_table: DataFrame) -> DataFrame:
    """Keys of the truth that were not detected, sorted."""
    return _only(outcome_table, "false_negative")


def _only(outcome_table: DataFrame, kind: str) -> DataFrame:
    keys = outcome_table.where(F.col("outcome") == kind).select("category", "record_key")
    return keys.orderBy("category", "record_key")


def category_counts(outcome_table: DataFrame, categories: list[str]) -> DataFrame:
    """The five counts per category that was run, zeros included."""
    spark = outcome_table.sparkSession
    is_a = F.col("outcome").__eq__
    counted = outcome_table.groupBy("category").agg(
        F.count_if(is_a("matched") | is_a("false_negative")).alias("expected"),
        F.count_if(is_a("matched") | is_a("false_positive")).alias("detected"),
        F.count_if(is_a("matched")).alias("matched"),
        F.count_if(is_a("false_positive")).alias("false_positives"),
        F.count_if(is_a("false_negative")).alias("false_negatives"),
    )
    run = scored_categories(spark, categories)
    filled = run.join(counted, "category", "left")
    return filled.select("category", *[F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS])


def pair_counts(index: DuplicateIndex, truth: DataFrame) -> DataFrame:
    """The five counts for near-duplicate pairs, without listing the pairs.

    Codes are grouped by the set of keys they occur on, and pairs of codes are counted from the sizes
    of these groups. Pairs of the truth are looked up by the groups of their two codes.
    """
    wanted = _wanted_pairs(truth)
    sets = key_sets(index)
    counted = {
        "detected": _detected_pairs(index, sets),
        "matched": _readings(wanted, index, sets).agg(F.count_distinct("record_key").alias("matched")),
        "expected": wanted.agg(F.count("*").alias("expected")),
    }
    rows = None
    for name, part in counted.items():
        row = part.select(*[(F.col(c) if c == name else F.lit(0)).cast("bigint").alias(c) for c in counted])
        rows = row if rows is None else rows.unionByName(row)
    sums = rows.agg(*[F.sum(c).alias(c) for c in counted])
    return sums.select(
        F.lit(fixed.NEAR_DUPLICATES).alias("category"),
        "expected",
        "detected",
        "matched",
        (F.col("detected") - F.col("matched")).alias("false_positives"),
        (F.col("expected") - F.col("matched")).alias("false_negatives"),
    )


def _wanted_pairs(truth: DataFrame) -> DataFrame:
    return _keys(truth, [fixed.NEAR_DUPLICATES]).select("record_key").distinct()


@dataclass
class KeySets:
    """Codes grouped by the set of keys they occur on, as stored tables.

    ``codes`` is (member, group, most): the group of each code and how often one key of it occurs at
    most. ``groups`` is (group, codes, twice, alike): how many codes, how many of them with a key
    that occurs twice, and whether two keys of the set are similar. ``kids`` is (group, kid).
    """

    codes: DataFrame
    groups: DataFrame
    kids: DataFrame


def _set_print() -> Column:
    """A fingerprint of the set of ``kid`` values of a group of rows, whatever their order and number.

    Two sets share it with a chance of one in 2^128 for each pair of sets.
    """
    one, two = F.xxhash64("kid"), F.xxhash64(F.lit(1), "kid")
    return F.struct(F.count("*").alias("n"), F.bit_xor(one).alias("one"), F.bit_xor(two).alias("two"))


def key_sets(index: DuplicateIndex) -> KeySets:
    """The key sets of ``index``. No set becomes an array: a code may hold a third of all keys."""
    codes = index.members.groupBy("member").agg(_set_print().alias("print"), F.max("n").alias("most"))
    codes = written(codes, "prints")
    # A code that stands for its group's keys; ids are fixed by being written.
    first = codes.groupBy("print").agg(F.min("member").alias("member"))
    named = written(first.withColumn("group", F.monotonically_increasing_id()), "named")
    codes = written(codes.join(named.drop("member"), "print").drop("print"), "codes")
    kids = written(index.members.join(named.drop("print"), "member").select("group", "kid"), "kids")
    onward = index.edges.select(F.col("a").alias("kid"), F.col("b").alias("next"))
    similar = kids.join(onward, "kid").select("group", F.col("next").alias("kid"))
    alike = similar.join(kids, ["group", "kid"], "left_semi").select("group").distinct().withColumn("alike", F.lit(True))
    sizes = codes.groupBy("group").agg(F.count("*").alias("codes"), F.count_if(F.col("most") > 1).alias("twice"))
    groups = sizes.join(alike, "group", "left").withColumn("alike", F.coalesce("alike", F.lit(False)))
    return KeySets(codes, written(groups, "groups"), kids)


def _detected_pairs(index: DuplicateIndex, sets: KeySets) -> DataFrame:
    """One row, ``detected``: how many different pair keys the index stands for.

    Groups that share a key, or have similar ones, are listed pair by pair where few groups have that
    key. A group's hot keys, those of many groups, are its profile. Groups whose profiles share a hot
    key, or have similar ones, are counted by their numbers, and taken out of what is listed. So
    what is stored grows with the codes, not with the square of those that share a name.
    """
    kids, groups = sets.kids, sets.groups
    busy = kids.groupBy("kid").agg(F.count("*").alias("groups")).where(F.col("groups") > HOT_GROUPS)
    hot = written(busy.select("kid"), "hot")
    within = groups.select((F.col("codes") * (F.col("codes") - 1) / 2).cast("bigint").alias("n"))
    # A code pairs with itself if it has one key twice, or two similar ones.
    itself = groups.select(F.when(F.col("alike"), F.col("codes")).otherwise(F.col("twice")).alias("n"))
    same_text = _same_text(index, sets).select((-F.col("n")).alias("n"))
    every = [within, itself, same_text]
    if hot.isEmpty():
        every.append(_listed_pairs(index, sets).select("n"))
    else:
        every += _counted_pairs(index, sets, hot)
    return reduce(DataFrame.unionByName, every).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("detected"))


def _counted_pairs(index: DuplicateIndex, sets: KeySets, hot: DataFrame) -> list[DataFrame]:
    """``n``: pairs of codes of different groups, where some keys are ``hot``."""
    kids, groups = sets.kids, sets.groups
    hot_kids = kids.join(hot, "kid", "left_semi")
    prints = hot_kids.groupBy("group").agg(_set_print().alias("print"))
    prints = written(prints, "prints")
    first = prints.groupBy("print").agg(F.min("group").alias("group"))
    first = written(first.withColumn("profile", F.monotonically_increasing_id()), "first")
    profiled = written(prints.join(first.drop("group"), "print").select("group", "profile"), "profiled")
    # (profile, kid), and which profiles share or resemble each other.
    faces = written(hot_kids.join(first.drop("print"), "group").select("profile", "kid"), "faces")
    x, y = faces.select("kid", F.col("profile").alias("x")), faces.select("kid", F.col("profile").alias("y"))
    hot_edges = index.edges.join(hot.withColumnRenamed("kid", "a"), "a", "left_semi")
    hot_edges = hot_edges.join(hot.withColumnRenamed("kid", "b"), "b", "left_semi")
    met = [x.join(y, "kid").select("x", "y")]
    for a, b in (("a", "b"), ("b", "a")):
        onward = hot_edges.select(F.col(a).alias("kid"), F.col(b).alias("next"))
        met.append(x.join(onward, "kid").select(F.col("next").alias("kid"), "x").join(y, "kid").select("x", "y"))
    both = met[0].unionByName(met[1]).unionByName(met[2])
    beside = written(both.where("x <= y").distinct(), "beside")
    sums = groups.join(profiled, "group").groupBy("profile").agg(
        F.sum("codes").alias("n"), F.sum(F.col("codes") * F.col("codes")).alias("squares")
    )
    sums = written(sums, "sums")
    across = beside.where("x < y").join(sums.select(F.col("profile").alias("x"), F.col("n").alias("x_n")), "x")
    across = across.join(sums.select(F.col("profile").alias("y"), F.col("n").alias("y_n")), "y")
    # Groups of one profile share its keys.
    inside = sums.select(((F.col("n") * F.col("n") - F.col("squares")) / 2).cast("bigint").alias("n"))
    pairs = _listed_pairs(index, sets, hot, hot_edges)
    for side in ("x", "y"):
        pairs = pairs.join(profiled.toDF(side, f"{side}_profile"), side, "left")
    low, high = F.least("x_profile", "y_profile"), F.greatest("x_profile", "y_profile")
    placed = pairs.withColumns({"low": F.when(F.isnotnull("x_profile") & F.isnotnull("y_profile"), low), "high": high})
    listed = placed.join(beside.toDF("low", "high"), ["low", "high"], "left_anti").select("n")
    return [across.select((F.col("x_n") * F.col("y_n")).alias("n")), inside, listed]


def _listed_pairs(
    index: DuplicateIndex, sets: KeySets, hot: DataFrame | None = None, hot_edges: DataFrame | None = None
) -> DataFrame:
    """(x, y, n): each two groups that meet by a key or edge which is not hot, and how many pairs of codes that is."""
    sized = sets.kids.join(sets.groups.select("group", "codes"), "group")
    x = sized.select("kid", F.col("group").alias("x"), F.col("codes").alias("x_codes"))
    y = sized.select("kid", F.col("group").alias("y"), F.col("codes").alias("y_codes"))
    edges, cold = index.edges.select("a", "b"), x
    if hot is not None:
        edges = edges.join(hot_edges.select("a", "b"), ["a", "b"], "left_anti")
        cold = x.join(hot, "kid", "left_anti")
    met = [cold.join(y, "kid").where("x < y")]
    for a, b in (("a", "b"), ("b", "a")):
        onward = edges.select(F.col(a).alias("kid"), F.col(b).alias("next"))
        near = x.join(onward, "kid").select(F.col("next").alias("kid"), "x", "x_codes").join(y, "kid")
        met.append(near.where("x < y"))
    pairs = reduce(DataFrame.unionByName, met).drop("kid").distinct()
    return pairs.select("x", "y", (F.col("x_codes") * F.col("y_codes")).alias("n"))


def _same_text(index: DuplicateIndex, sets: KeySets) -> DataFrame:
    """``n``: for pair keys that several detected pairs share, the pairs beyond the first.

    That takes an arrow within the codes of both: ``a->b`` with ``c``, ``a`` with ``b->c``.
    """
    arrows = index.members.where(F.col("member").contains(ARROW)).select("member").distinct()
    split = _splits(arrows, "member")
    first = split.select(F.col("head").alias("a"), F.col("tail").alias("b"))
    second = split.select(F.col("head").alias("b"), F.col("tail").alias("c"))
    shared = first.join(second, "b").select(F.concat_ws(ARROW, "a", "b", "c").alias("record_key"))
    found = _readings(shared.distinct(), index, sets).groupBy("record_key").agg(
        F.count_distinct("later", "earlier").alias("n")
    )
    return found.select((F.col("n") - 1).alias("n"))


def _splits(df: DataFrame, col: str) -> DataFrame:
    """``head`` and ``tail`` of ``col`` for each arrow in it, after its other columns."""
    parts = F.split(F.col(col), ARROW)
    at = F.explode(F.when(F.size(parts) > 1, F.sequence(F.lit(1), F.size(parts) - 1)))
    cut = df.select("*", parts.alias("_parts"), at.alias("_at"))
    head = F.array_join(F.slice("_parts", F.lit(1), F.col("_at")), ARROW)
    tail = F.array_join(F.slice("_parts", F.col("_at") + 1, F.size("_parts")), ARROW)
    return cut.withColumns({"head": head, "tail": tail}).drop("_parts", "_at")


def _readings(wanted: DataFrame, index: DuplicateIndex, sets: KeySets) -> DataFrame:
    """(record_key, later, earlier): the readings of pair keys that are detected pairs.

    Both codes are looked up, and then each two groups once: the keys of the smaller set, and those
    similar to them, are looked for in the larger set.
    """
    asked = _splits(wanted, "record_key").toDF("record_key", "later", "earlier")
    asked = asked.where(F.col("later") >= F.col("earlier"))
    later = sets.codes.select(F.col("member").alias("later"), F.col("group").alias("p"), "most")
    earlier = sets.codes.select(F.col("member").alias("earlier"), F.col("group").alias("q"))
    placed = written(asked.join(later, "later").join(earlier, "earlier"), "placed")
    alike = sets.groups.select(F.col("group").alias("p"), "alike")
    same = placed.where("p = q").join(alike, "p")
    # Two codes of a group share its keys; a code pairs with itself only by two of its rows.
    same = same.where((F.col("later") != F.col("earlier")) | (F.col("most") > 1) | F.col("alike"))

    sizes = sets.kids.groupBy("group").agg(F.count("*").alias("keys"))
    apart = placed.where("p <> q").select("p", "q").distinct()
    sized = apart.join(sizes.toDF("p", "p_keys"), "p").join(sizes.toDF("q", "q_keys"), "q")
    swap = F.col("p_keys") > F.col("q_keys")
    small, large = F.when(swap, F.col("q")).otherwise(F.col("p")), F.when(swap, F.col("p")).otherwise(F.col("q"))
    sides = written(sized.select("p", "q", small.alias("small"), large.alias("large")), "sides")
    own = sides.join(sets.kids.toDF("small", "kid"), "small").select("p", "q", "large", "kid")
    tried = [own]
    for a, b in (("a", "b"), ("b", "a")):
        onward = index.edges.select(F.col(a).alias("kid"), F.col(b).alias("next"))
        tried.append(own.join(onward, "kid").select("p", "q", "large", F.col("next").alias("kid")))
    held = sets.kids.toDF("large", "kid")
    found = reduce(DataFrame.unionByName, tried).join(held, ["large", "kid"], "left_semi").select("p", "q").distinct()
    across = placed.join(found, ["p", "q"], "left_semi")
    shown = ["record_key", "later", "earlier"]
    return same.select(*shown).unionByName(across.select(*shown))


def missed_pairs(index: DuplicateIndex, truth: DataFrame) -> DataFrame:
    """(category, record_key): pairs of the truth that the index does not hold."""
    wanted = _wanted_pairs(truth)
    found = _readings(wanted, index, key_sets(index)).select("record_key")
    missed = wanted.join(found, "record_key", "left_anti")
    return missed.select(F.lit(fixed.NEAR_DUPLICATES).alias("category"), "record_key")


def unwanted_pairs(index: DuplicateIndex, truth: DataFrame) -> DataFrame:
    """(category, record_key): detected pairs the truth does not hold. Lists all pairs."""
    pairs = index.pairs().select(pair_key().alias("record_key"))
    if index.parts:
        pairs = pairs.repartition(index.parts, "record_key")
    unwanted = pairs.distinct().join(_wanted_pairs(truth), "record_key", "left_anti")
    return unwanted.select(F.lit(fixed.NEAR_DUPLICATES).alias("category"), "record_key")


def scorecard_of(counts: DataFrame, unrounded: bool = False) -> DataFrame:
    """Rates per category and for ``_overall``, from a table of category counts.

    The overall rates come from the summed counts. Without any category the
    overall row is still there, with rates of 1.0.
    """
    # Every row also counts towards the total, so the counts are computed once. The
    # row of zeros keeps the total when no category was run.
    nothing = counts.sparkSession.range(1).select(
        F.lit(fixed.OVERALL).alias("category"), *[F.lit(0).cast("bigint").alias(c) for c in COUNTS]
    )
    twice = counts.withColumn("category", F.explode(F.array("category", F.lit(fixed.OVERALL))))
    rows = twice.unionByName(nothing).groupBy("category").agg(*[F.sum(c).alias(c) for c in COUNTS])
    recall = rates.share(F.col("matched"), F.col("expected"))
    precision = rates.share(F.col("matched"), F.col("detected"))
    shown: dict[str, Column] = {
        "detection_rate": recall,
        "recall": recall,
        "precision": precision,
        "f1": rates.f1(precision, recall),
    }
    return rows.select(
        "category",
        *COUNTS,
        *[(rate if unrounded else rates.rounded(rate)).alias(name) for name, rate in shown.items()],
        F.lit(fixed.VALIDATION_MODE).alias("validation_mode"),
    )


def scorecard(
    detected: DataFrame, truth: DataFrame, categories: list[str], unrounded: bool = False
) -> DataFrame:
    """One row per category that was run, plus ``_overall``."""
    counts = category_counts(outcomes(detected, truth, categories), categories)
    return scorecard_of(counts, unrounded)


def with_health(scores: DataFrame) -> DataFrame:
    """Add the health band and the rates as percentages, for display."""
    return scores.withColumns(
        {
            "health": rates.health(F.col("recall")),
            "recall_percent": rates.percent(F.col("recall")),
            "precision_percent": rates.percent(F.col("precision")),
            "f1_percent": rates.percent(F.col("f1")),
        }
    )
