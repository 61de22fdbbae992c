"""Mixing sources to target weights along a training curriculum.

Each source gets a target of words by water-filling. Its documents, in an order fixed by a hash, are
laid end to end as often as the target needs (three passes at most), and the weight schedule of the
source, integrated over training time, says when its cumulative demand reaches each document. That
time is the document's training position, and the mix is sorted by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.llm.ordering import running_totals
from scrubline.llm.tables import broadcast_if_small, is_empty, spare_name
from scrubline.workspace import written

# Sources in code point order take these weights in turn.
WEIGHTS = (5.0, 2.0, 1.0)
# A source is repeated this many times at most.
MOST_PASSES = 3
# Relative weight over training time of the sources of each weight, as (time, weight) knots with
# straight lines between: heavy sources fade out, light ones come in.
SCHEDULES = (
    ((0.0, 1.4), (0.5, 1.0), (1.0, 0.6)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.4), (0.6, 1.0), (1.0, 1.9)),
)

WORD = r"[^\x20\x09-\x0D]+"

Schedule = Sequence[tuple[float, float]]


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size`` in words, the source in two columns without nulls, and a fixed hash."""
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.col("source").isNull().alias("no_source"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.xxhash64(F.col("doc_id").cast("long"), text).alias("dice"),
    )


def targets(rows: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """``no_source``, ``source``, ``turn``, ``source_size``, ``target``: one row per source.

    Targets are ``min(MOST_PASSES * size, level * weight)``, where the level makes them add up to
    all sizes; it is raised until no target is above its cap. Each step is one aggregate.
    """
    sums = rows.groupBy("no_source", "source").agg(F.sum("size").alias("source_size"))
    ranked = running_totals(sums.withColumn("one", F.lit(1)), ["no_source", "source"], ["one"])
    turn = (F.col("before_one") % len(weights)).cast("int")
    weight = F.element_at(F.array(*map(F.lit, weights)), turn + 1)
    sources = written(
        ranked.select("no_source", "source", "source_size", turn.alias("turn"), weight.alias("weight")),
        "sources",
    )
    cap = F.col("source_size") * float(MOST_PASSES)
    whole = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level = 0.0 if not whole[0] else whole[0] / whole[1]
    while True:
        capped = cap <= F.col("weight") * level
        held, open_weight = sources.agg(
            F.sum(F.when(capped, cap).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))
        ).first()
        if not open_weight:
            break
        raised = (whole[0] - held) / open_weight
        if raised <= level:
            break
        level = raised
    return sources.withColumn("target", F.least(cap, F.col("weight") * level)).drop("weight")


def _time_of(share: Column, schedule: Schedule) -> Column:
    """The time at which the integral of ``schedule`` reaches ``share`` of its whole."""
    if any(w < 0 for _, w in schedule) or schedule[0][0] != 0.0 or schedule[-1][0] != 1.0:
        raise ValueError("a schedule goes from time 0 to 1 with weights of at least 0")
    reached = [0.0]
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
        reached.append(reached[-1] + (t1 - t0) * (w0 + w1) / 2)
    demand = share * reached[-1]
    time = F.lit(1.0)
    steps = list(zip(schedule, schedule[1:], reached, reached[1:], strict=False))
    for (t0, w0), (t1, w1), low, high in reversed(steps):
        area = F.least(F.greatest(demand - low, F.lit(0.0)), F.lit(high - low))
        bend = (w1 - w0) / (t1 - t0)
        # The root of w0 * t + bend * t * t / 2 = area, in the form that also holds for bend = 0.
        root = F.sqrt(F.greatest(w0 * w0 + 2 * bend * area, F.lit(0.0)))
        inside = t0 + 2 * area / F.greatest(w0 + root, F.lit(1e-12))
        time = F.when(demand <= high, inside).otherwise(time)
    return time


def plan(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, schedules: Sequence[Schedule] = SCHEDULES
) -> DataFrame:
    """What the mix takes of each row: ``words_<pass>`` and ``position_<pass>`` for each pass.

    The passes of a source stop at its target to the word: the document at which the last pass ends
    counts with the words up to there. Positions are null for a pass that takes nothing.
    """
    rows = written(sized(docs), "sized")
    sources = broadcast_if_small(written(targets(rows, weights), "targets"))
    laid = running_totals(rows, ["dice", "doc_id", "size"], ["size"], ["no_source", "source"])
    found = laid.join(sources, ["no_source", "source"])
    whole = F.round("target").cast("long")
    taken, positions = [], []
    for turn in range(MOST_PASSES):
        start = F.col("before_size") + turn * F.col("source_size")
        words = F.greatest(F.least(whole - start, F.col("size")), F.lit(0))
        share = start / F.greatest(whole, F.lit(1))
        time = F.lit(None).cast("double")
        for at, schedule in enumerate(schedules):
            time = F.when(F.col("turn") == at, _time_of(share, schedule)).otherwise(time)
        taken.append(words.alias(f"words_{turn}"))
        positions.append(F.when(words > 0, time).alias(f"position_{turn}"))
    return found.select("doc_id", "dice", "size", "source_size", "target", *taken, *positions)


def mix(docs: DataFrame) -> DataFrame:
    """One row per document, sorted by its first training position: what the mix takes of it.

    Null texts have size 0 and are never taken; a null source is a source of its own, the last one.
    Repeated rows and null ids count like others, other columns are ignored, an empty table gives no
    rows. The order of documents in a source is fixed by their contents, so reruns agree.
    """
    found = plan(docs)
    words = [F.col(f"words_{turn}") for turn in range(MOST_PASSES)]
    result = found.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        sum(words[1:], words[0]).alias("taken"),
        F.col("position_0").alias("position"),
    )
    return result.orderBy(F.col("position").asc_nulls_last(), "doc_id")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix with their columns, repeated as often as taken, by position.

    The document at which a source's last pass ends is taken whole if at least half of it is.
    """
    found = plan(docs)
    takes = F.array(
        *[
            F.when(2 * F.col(f"words_{turn}") >= F.col("size"), F.col(f"position_{turn}"))
            for turn in range(MOST_PASSES)
        ]
    )
    taken = found.select("doc_id", "dice", F.explode(F.array_compact(takes)).alias("position"))
    key, at = spare_name(docs, "mixing_key"), spare_name(docs, "mixing_position")
    number, again = spare_name(docs, "mixing_id"), spare_name(docs, "mixing_again")
    # Texts move once, to their positions, unless the plan is too large to broadcast.
    ours = broadcast_if_small(written(taken.toDF(number, again, at), "taken"))
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    repeated = keyed.groupBy("doc_id", key).agg(F.count("*").alias("rows")).where("rows > 1")
    if not is_empty(repeated):
        # Equal rows have plans of their own; one of them stands for all.
        keyed = keyed.dropDuplicates(["doc_id", key])
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(number)) & (F.col(key) == F.col(again))
    spread = keyed.join(ours, same).repartitionByRange(at).sortWithinPartitions(at, number)
    return spread.select(*[F.col(f"`{c}`") for c in docs.columns])
