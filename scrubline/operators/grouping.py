"""Groups of near-duplicate names around first-seen leaders.

Names are visited in first-seen order. A name nobody has claimed becomes a
leader and claims every name similar to it; its group holds all of them, also
those an earlier leader claimed. The leaders are thus the first independent
set of the similarity graph in that order, and groups are stars, not connected
components.

Names with equal keys always share their neighbours, so the graph is built on
keys, and a key takes the place of its first-seen name. Leaders are settled in
rounds over all edges: keys without smaller open neighbours lead, with every second
one of the chains behind them, and claim everywhere with one join. What few edges
are left, as many as one task can hold, are resolved in order.

Where signatures repeat so often that the whole graph could be too large (a
third of all names being copies of one another, say), keys are handled in
batches of their order: each batch first looks for similar keys within itself,
then its leaders claim among the keys that are left. No step then lists all
pairs of a crowd of copies.

What one task can hold of such a batch is visited in order there, each leader
beside the keys still open, so its similar keys are not listed either. That ends
after a number of comparisons: where few keys are alike, batches go on by joins.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from scrubline.fixed import SIMILARITY_THRESHOLD
from scrubline.operators.similarity import (
    Blocking,
    DuplicateIndex,
    coded_keys,
    common_lengths,
    extent,
    index_members,
    key_features,
    meetings,
    similar_between,
    similar_keys,
    similar_to_few,
    with_token_key,
)
from scrubline.workspace import scratch_path, written

# Edges among the first open keys that one task resolves in order.
ROUND_EDGES = 2_000_000
# Ranges of ids whose edges are counted to find out which keys these are.
ID_RANGES = 4096
# A round that settles a smaller share of the edges than this goes on in order.
LEAST_SETTLED = 0.1

# Rows that may meet in signatures of a batch: a fixed part, and one per key overall.
REPEATS_FLOOR = 50_000_000
REPEATS_PER_KEY = 500
SMALLEST_BATCH = 1000

# Characters of the open keys of a crowded batch that one task visits in order, and the
# steps it takes: one per key and leader, and one per word and character of pairs compared.
IN_ORDER_CHARACTERS = 500_000
IN_ORDER_STEPS = 100_000_000
# Pairs of a leader and a key that one task compares.
PAIRS_PER_TASK = 2_000_000


def distinct_names(df: DataFrame, col: str, order_col: str) -> DataFrame:
    """(name, first_seen): every non-null name with its earliest order value."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(F.col(col).alias("name"))
        .agg(F.min(order_col).alias("first_seen"))
    )


def ranked_keys(names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keys numbered from 0 in first-seen order with their first name, and all names.

    The numbers come from a range-partitioned sort: rank within the partition
    plus the sizes of the partitions before it. No step sorts everything in
    one task.
    """
    seen = F.struct("first_seen", "name")
    named = written(with_token_key(names, "name"), "names")
    heads = named.groupBy("key").agg(F.min(seen).alias("head"))
    spread = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = heads.repartitionByRange(spread, "head").withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "ranged")
    # One row per partition, so the running total is tiny whatever the data.
    sizes = ranged.groupBy("part").agg(F.count("*").alias("size"))
    before = sizes.select(
        "part",
        (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"),
    )
    within = F.row_number().over(Window.partitionBy("part").orderBy("head")) - 1
    numbered = ranged.withColumn("within", within).join(F.broadcast(before), "part")
    numbered = numbered.select(
        "key", (F.col("before") + F.col("within")).alias("kid"), F.col("head.name").alias("leader")
    )
    return written(key_features(numbered, "leader"), "vertices"), named


def claimed_within(edges: DataFrame, round_edges: int = ROUND_EDGES) -> DataFrame:
    """Ids that a smaller leader claims, for stored edges (lo, hi) with lo < hi.

    While many edges are left, a round settles all ids at once that have no smaller open neighbour, and
    the chains behind them of ids with one each. Where that settles few, as on long bands of names each
    like several before it, the first ``round_edges`` edges are resolved in order in one task instead;
    so are the last ones. No step brings all edges of an id together.
    """
    path = scratch_path(edges.sparkSession, "claimed")
    pending, left = edges, edges.count()
    # After a round that settles few, the next ones go in order at once, twice as many each time.
    in_order = patience = 0
    while True:
        before = left
        if left > round_edges and not in_order:
            pending, left = _after(pending, _free_leaders(pending), path)
            if left > (1 - LEAST_SETTLED) * before:
                in_order = patience = 2 * patience + 1
        if left <= round_edges or in_order:
            pending, left = _first_in_order(pending, left, round_edges, path)
            in_order = max(in_order - 1, 0) if left < before else 0
        if not left:
            return edges.sparkSession.read.schema("id bigint").parquet(path).distinct()


def _first_in_order(pending: DataFrame, left: int, round_edges: int, path: str) -> tuple[DataFrame, int]:
    """Settle all ids up to a bound below which there are ``round_edges`` edges, visited in order in one task.

    Nothing is settled if the first id alone has more smaller neighbours than that.
    """
    bound = _settled_bound(pending, round_edges) if left else None
    first = pending.where(F.col("hi") <= (-1 if bound is None else bound))
    if left > round_edges and first.count() > round_edges:
        return pending, left
    together = first.withColumn("round", F.lit(0)).groupBy("round")
    inside = written(together.applyInPandas(_claimed_in_order, "id bigint"), "claimed")
    open_ids = pending.where(F.col("lo") <= (-1 if bound is None else bound)).select(F.col("lo").alias("id"))
    return _after(pending, open_ids.distinct().join(inside, "id", "left_anti"), path)


def _after(pending: DataFrame, leaders: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Append what ``leaders`` claim to ``path``; the edges between ids that stay open, and their number."""
    leaders = written(leaders, "leading")
    newly = pending.join(leaders.withColumnRenamed("id", "lo"), "lo", "left_semi").select(F.col("hi").alias("id"))
    newly = written(newly.distinct(), "taken")
    newly.write.mode("append").parquet(path)
    settled = newly.union(leaders)
    rest = pending.join(settled.withColumnRenamed("id", "lo"), "lo", "left_anti")
    rest = written(rest.join(newly.withColumnRenamed("id", "hi"), "hi", "left_anti").select("lo", "hi"), "pending")
    return rest, rest.count()


def _free_leaders(pending: DataFrame) -> DataFrame:
    """Ids that lead for certain: those without smaller neighbours, and every second one of the chains behind.

    An id with one smaller neighbour leads if that one does not. Such pointers are followed by doubling,
    so a path of any length takes as many joins as its length has binary digits.
    """
    below = pending.groupBy("hi").agg(F.count("*").alias("n"), F.min("lo").alias("lo"))
    below = written(below.select(F.col("hi").alias("id"), "n", "lo"), "below")
    free = pending.select(F.col("lo").alias("id")).distinct().join(below, "id", "left_anti")
    pointers = written(
        below.where("n = 1").select("id", F.col("lo").alias("target"), F.lit(True).alias("differs")), "pointers"
    )
    while True:
        onward = pointers.select(F.col("id").alias("target"), F.col("target").alias("next"), F.col("differs").alias("more"))
        step = pointers.join(onward, "target", "left").select(
            "id",
            F.coalesce("next", "target").alias("target"),
            (F.col("differs") != F.coalesce("more", F.lit(False))).alias("differs"),
            F.col("next").isNotNull().alias("moved"),
        )
        step = written(step, "pointers")
        pointers = step.drop("moved")
        if step.where("moved").isEmpty():
            break
    # The end of a chain is free, or has several smaller neighbours and stays open.
    ends = pointers.where("not differs").join(free.withColumnRenamed("id", "target"), "target", "left_semi")
    return free.union(ends.select("id"))


def _settled_bound(pending: DataFrame, round_edges: int) -> int | None:
    """The id up to which this round settles keys, or None without any edge.

    Edges are counted by ranges of their larger id. If the first range holds too
    many, it is cut into ranges again; one id alone is always settled.
    """
    low, high = pending.agg(F.min("hi"), F.max("hi")).first()
    if low is None:
        return None
    while True:
        width = (high - low) // ID_RANGES + 1
        within = pending.where(F.col("hi").between(low, high))
        counted = within.groupBy(F.floor((F.col("hi") - low) / width).alias("range")).count()
        bound, total = low - 1, 0
        # At most ID_RANGES rows.
        for row in counted.orderBy("range").collect():
            total += row["count"]
            if total > round_edges:
                break
            bound = low + (row["range"] + 1) * width - 1
        if bound >= low or width == 1:
            return max(bound, low)
        high = low + width - 1


def _claimed_in_order(edges: pd.DataFrame) -> pd.DataFrame:
    """Ids that a leader among the same edges claims, visited in order."""
    edges = edges.sort_values("lo")
    los, his = edges["lo"].to_numpy(), edges["hi"].to_numpy()
    begins = np.flatnonzero(np.r_[True, los[1:] != los[:-1]])
    claimed: set[int] = set()
    for start, end in zip(begins, np.r_[begins[1:], len(los)], strict=True):
        if los[start] not in claimed:
            claimed.update(his[start:end].tolist())
    return pd.DataFrame({"id": sorted(claimed)}, dtype="int64")


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.select(
        F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"), "score"
    )


def _characters(keys: DataFrame) -> int:
    return keys.agg(F.sum("len")).first()[0] or 0


def leaders_in_order(keys: DataFrame, threshold: int, steps: int | None = None) -> tuple[DataFrame, int | None]:
    """Leader ids among ``keys``, visited in order in one task, and the first id not visited or None.

    That many keys are visited as the ``steps`` suffice for, one at least.
    """
    most = IN_ORDER_STEPS if steps is None else steps

    def visit(batch: pd.DataFrame) -> pd.DataFrame:
        return _visited(batch, threshold, most)

    together = keys.select("kid", "key", "len", "bits_lo", "bits_hi").withColumn("round", F.lit(0)).groupBy("round")
    visited = written(together.applyInPandas(visit, "kid bigint, leads boolean"), "visited")
    return visited.where("leads").select("kid"), visited.where("not leads").agg(F.min("kid")).first()[0]


def _visited(keys: pd.DataFrame, threshold: int, steps: int) -> pd.DataFrame:
    """(kid, leads): the leaders, and the first key that was not visited, if steps ran out."""
    keys = keys.sort_values("kid")
    texts, sizes = keys["key"].to_numpy(dtype=object), keys["len"].to_numpy(dtype=np.int64)
    bits = keys[["bits_lo", "bits_hi"]].to_numpy(dtype=np.int64).view(np.uint64)
    leading, rest = [], np.arange(len(keys))
    while len(rest) and steps > 0:
        first, rest = rest[0], rest[1:]
        leading.append(first)
        totals = sizes[first] + sizes[rest]
        differing = np.bitwise_count(bits[rest] ^ bits[first]).sum(axis=1, dtype=np.int64)
        near = np.flatnonzero(100 * differing <= (100 - threshold) * totals)
        common = common_lengths([texts[first]] * len(near), texts[rest[near]].tolist())
        # Keys near to one another are about as long.
        steps -= len(rest) + int(totals[near].sum()) // 2 * -(-int(sizes[first]) // 64)
        rest = np.delete(rest, near[200 * common.astype(np.int64) >= threshold * totals[near]])
    found = np.r_[np.array(leading, dtype=np.int64), rest[:1]]
    return pd.DataFrame({"kid": keys["kid"].to_numpy()[found], "leads": np.arange(len(found)) < len(leading)})


def claimed_by(leading: DataFrame, keys: DataFrame, total: int, threshold: int, allowed: int) -> DataFrame:
    """(a, b, score): the ``leading`` keys with all keys similar to them, of ``total`` ones.

    They are compared one by one if these are no more pairs than rows may meet in signatures.
    """
    pairs = leading.count() * total
    if pairs > allowed:
        return similar_between(leading, keys, threshold)
    spread = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return similar_to_few(leading, keys, threshold, max(spread, math.ceil(pairs / PAIRS_PER_TASK)))


def leaders_and_stars(
    keys: DataFrame,
    threshold: int = SIMILARITY_THRESHOLD,
    repeats: int | None = None,
    smallest_batch: int = SMALLEST_BATCH,
) -> tuple[DataFrame, DataFrame]:
    """Leader ids, and (leader, kid, score) for every key similar to a leader."""
    blocking = Blocking(threshold)
    longest, total = extent(keys)
    allowed = repeats if repeats is not None else REPEATS_FLOOR + REPEATS_PER_KEY * total
    open_keys, start, size = keys, 0, max(total, 1)
    spark = keys.sparkSession
    leaders, stars = (scratch_path(spark, name) for name in ("leaders", "stars"))
    crowded, patient = False, True
    while start < total:
        size = min(size, total - start)
        while True:
            batch = open_keys.where(F.col("kid").between(start, start + size - 1))
            characters = _characters(batch) if crowded and patient else None
            visited = characters is not None and characters <= IN_ORDER_CHARACTERS
            if visited or size <= smallest_batch:
                break
            if characters:
                size = max(min(size // 2, size * IN_ORDER_CHARACTERS // characters), smallest_batch)
                continue
            met = meetings(batch, blocking, longest)
            if met <= allowed:
                break
            # Rows that meet grow with the square of a crowd.
            crowded, size = True, max(min(size // 4, int(size * math.sqrt(allowed / met))), smallest_batch)
        if visited:
            leading, stopped = leaders_in_order(batch, threshold)
            patient = stopped is None
            size = size if patient else stopped - start
        else:
            leading, star = stars_of(batch, similar_keys(batch, threshold))
        if size < total:
            leading = written(batch.join(leading, "kid", "left_semi"), "leading")
            star = claimed_by(leading, keys, total, threshold, allowed).select(
                F.col("a").alias("leader"), F.col("b").alias("kid"), "score"
            )
            star = written(star, "stars")
            taken = star.select(F.col("kid").alias("id")).distinct()
            rest = open_keys.where(F.col("kid") >= start + size)
            open_keys = written(rest.join(taken, rest.kid == taken.id, "left_anti"), "open")
        leading.select("kid").write.mode("append").parquet(leaders)
        star.select("leader", "kid", "score").write.mode("append").parquet(stars)
        start, size = start + size, size * 4
    schemas = "kid bigint", "leader bigint, kid bigint, score double"
    if not total:
        return tuple(spark.createDataFrame([], schema) for schema in schemas)
    return tuple(spark.read.schema(s).parquet(p) for s, p in zip(schemas, (leaders, stars), strict=True))


def name_groups(
    df: DataFrame,
    col: str = "name",
    order_col: str = "supplier_code",
    threshold: int = SIMILARITY_THRESHOLD,
    repeats: int | None = None,
    smallest_batch: int = SMALLEST_BATCH,
) -> DataFrame:
    """(canonical, variant, score, canonical_rank, variant_seen), one row per variant.

    Sort by ``canonical_rank``, descending ``score``, ``variant_seen`` and
    ``variant`` to list groups and their variants in visiting order.
    """
    keys, names = ranked_keys(distinct_names(df, col, order_col))
    leaders, stars = leaders_and_stars(keys, threshold, repeats, smallest_batch)
    return _groups(keys, names, leaders, stars)


def index_and_groups(
    df: DataFrame,
    code: str = "supplier_code",
    col: str = "name",
    order_col: str | None = None,
    threshold: int = SIMILARITY_THRESHOLD,
) -> tuple[DuplicateIndex, DataFrame]:
    """The duplicate index and the groups of the same names, from one similarity join."""
    keys, names = ranked_keys(distinct_names(df, col, order_col or code))
    edges = written(similar_keys(keys, threshold), "edges")
    leaders, stars = stars_of(keys, edges)
    index = DuplicateIndex(index_members(coded_keys(df, code, col), keys), edges)
    return index, _groups(keys, names, leaders, stars)


def stars_of(keys: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leader ids, and (leader, kid, score), from all the edges (a, b, score) of ``keys``."""
    inside = written(_ordered(edges), "edges")
    claimed = claimed_within(inside.select("lo", "hi"))
    leading = written(keys.join(claimed, keys.kid == claimed.id, "left_anti").select("kid"), "leaders")
    leader = leading.select(F.col("kid").alias("leader"))
    above = inside.join(leader, F.col("lo") == F.col("leader"))
    below = inside.join(leader, F.col("hi") == F.col("leader"))
    stars = above.select("leader", F.col("hi").alias("kid"), "score").unionByName(
        below.select("leader", F.col("lo").alias("kid"), "score")
    )
    return leading, stars


def _groups(keys: DataFrame, names: DataFrame, leaders: DataFrame, stars: DataFrame) -> DataFrame:
    own = leaders.select(
        F.col("kid").alias("leader_kid"), "kid", F.lit(100.0).alias("score")
    )
    links = own.unionByName(
        stars.select(F.col("leader").alias("leader_kid"), "kid", "score")
    )
    canonical = keys.select(F.col("kid").alias("leader_kid"), F.col("leader").alias("canonical"))
    members = names.join(keys.select("key", "kid"), "key").select("kid", "name", "first_seen")
    return (
        links.join(canonical, "leader_kid")
        .join(members, "kid")
        .where(F.col("name") != F.col("canonical"))
        .select(
            "canonical",
            F.col("name").alias("variant"),
            "score",
            F.col("leader_kid").alias("canonical_rank"),
            F.col("first_seen").alias("variant_seen"),
        )
    )


def listed(groups: DataFrame) -> DataFrame:
    """``groups`` with ``position``: where a variant stands in its group, from 1, by falling score.

    Rows are dealt to ranges of the listing order and numbered within, after the rows of the group in
    earlier ranges, so a group of any size spreads over tasks.
    """
    spread = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("score").desc(), F.col("variant_seen").asc_nulls_first(), F.col("variant").asc()]
    ranged = groups.repartitionByRange(spread, F.col("canonical_rank"), *order)
    ranged = written(ranged.withColumn("part", F.spark_partition_id()), "listed")
    sizes = ranged.groupBy("part", "canonical_rank").agg(F.count("*").alias("size"))
    earlier = Window.partitionBy("canonical_rank").orderBy("part")
    before = sizes.select("part", "canonical_rank", (F.sum("size").over(earlier) - F.col("size")).alias("before"))
    within = F.row_number().over(Window.partitionBy("part", "canonical_rank").orderBy(*order))
    numbered = ranged.withColumn("within", within).join(written(before, "before"), ["part", "canonical_rank"])
    return numbered.select(*groups.columns, (F.col("before") + F.col("within")).alias("position"))


def group_count(groups: DataFrame) -> DataFrame:
    return groups.agg(F.count_distinct("canonical").alias("n_groups"))


def canonical_map(groups: DataFrame) -> DataFrame:
    """(variant, canonical): of several leaders the last one wins."""
    return groups.groupBy("variant").agg(
        F.max_by("canonical", "canonical_rank").alias("canonical")
    )


def canonical_name_map(
    df: DataFrame, col: str = "name", order_col: str = "supplier_code", **limits
) -> DataFrame:
    return canonical_map(name_groups(df, col, order_col, **limits))
