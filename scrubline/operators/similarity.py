"""Near-duplicate text: a lossless blocked similarity join.

Two keys ``a`` and ``b`` of lengths m >= n match when the indel similarity
``200 * LCS / (m + n)`` reaches the threshold, which means that at most
``D = (100 - threshold) * (m + n) / 100`` characters are deleted or inserted
between them, with ``D`` of the same parity as ``m + n``.

Blocking cuts the longer key into at least ``D + 2`` disjoint segments. Walk over
the segments from the left and count the edits so far less the segments so far:
the count falls by one at intact segments only, starts at 0 and ends below. So
there is a first intact segment number ``i`` with exactly ``i`` edits on its left.
The shorter key holds it at a distance ``s`` from its own position, ``|s| <= i``
and of the same parity. The same walk from the right finds an intact segment
number ``j`` with exactly as many edits on its right as there are segments. With
``D + 2`` segments ``i < j``: were they the same, its two sides would hold
``D + 1`` edits, and were ``j`` on the left of ``i``, more.

So every matching pair shares the signature (length, i, text of segment i). Where
more than a few keys share that, it is extended by (j, text of segment j), the two
outermost segments that any pair must share. Signatures get longer where names
crowd, so the keys that meet in one grow slowly with the table, unless names share
a long ending: both segments may lie in that.

Beyond a length, keys are cut by the shortest length of a class ten percent wide;
what is left over at their end counts as right of the last segment.

Candidates then pass a character-count filter inside the join and only the
survivors go to the LCS check; no pair that matches is lost.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from scrubline.fixed import SIMILARITY_THRESHOLD
from scrubline.functions.text import token_key
from scrubline.operators.skew import grid_join, hot_cells, hot_keys
from scrubline.workspace import written

# Keys longer than this are probed without positions: the number of allowed
# positions grows with the square of the length.
POSITIONAL_LENGTH = 128
# Keys up to this length are cut by their own length, longer ones by that of the
# shortest key of a class of lengths ten percent wide.
EXACT_LENGTH = 48

# Keys that may share a signature before it is extended.
CROWDED = 2

# Pairs whose common subsequences are found together.
PAIRS_AT_A_TIME = 4096

# Index rows one join cell may hold before its signature is cut into a grid.
HOT_SIGNATURE_ROWS = 4096

# Listed pairs per task, where there are more than that.
PAIRS_PER_TASK = 500_000


# --- keys -------------------------------------------------------------------------


def with_token_key(df: DataFrame, col: str) -> DataFrame:
    """Add ``key``; rows without a name or with a blank one are left out."""
    return df.withColumn("key", token_key(F.col(col))).where(F.length("key") > 0)


def key_features(df: DataFrame, *kept: str) -> DataFrame:
    """``kid``, ``key``, ``len`` and a sketch, and ``kept`` columns of a table of keys.

    The sketch has one bit of 128 per (character, occurrence number). One edit
    changes one character count by one, so the bits in which the sketches of two
    keys differ never exceed the number of edits between them.
    """
    # Characters are a column of their own, or each lambda step would sort them again.
    split = df.select(*kept, "kid", "key", F.array_sort(F.split("key", "", -1)).alias("chars"))
    bits = F.transform(
        "chars",
        lambda char, at: F.pmod(F.xxhash64(char, at - F.array_position("chars", char)), F.lit(128)),
    )
    marked = split.select(*kept, "kid", "key", F.length("key").alias("len"), bits.alias("bits"))
    return marked.select(
        *kept,
        "kid",
        "key",
        "len",
        _bit_set("bits", 0).alias("bits_lo"),
        _bit_set("bits", 64).alias("bits_hi"),
    )


def _bit_set(bits: str, low: int) -> Column:
    return F.aggregate(
        F.filter(bits, lambda bit: (bit >= low) & (bit < low + 64)),
        F.lit(0).cast("bigint"),
        lambda seen, bit: seen.bitwiseOR(
            F.call_function("shiftleft", F.lit(1).cast("bigint"), (bit - low).cast("int"))
        ),
    )


# --- blocking ---------------------------------------------------------------------


class Blocking:
    """Signatures for one similarity threshold (percent, above 50 and up to 100)."""

    def __init__(
        self,
        threshold: int = SIMILARITY_THRESHOLD,
        positional: int = POSITIONAL_LENGTH,
        exact: int = EXACT_LENGTH,
    ):
        if not 50 < threshold <= 100:
            raise ValueError("the similarity threshold must be above 50 and at most 100")
        self.threshold = threshold
        self.positional = positional
        slack = 100 - threshold
        # Longest segments of which a key of any length holds one more than its budget.
        self.segment = positional if slack == 0 else (99 // (2 * slack))
        # The class of each length up to the positional one, as its bounds.
        self.lows, self.highs = [], []
        low = 1
        while low <= positional:
            high = low if low <= exact else min(positional, max(low, int(low * 1.1)))
            self.lows += [low] * (high - low + 1)
            self.highs += [high] * (high - low + 1)
            low = high + 1

    def budget(self, m: Column, n: Column) -> Column:
        """Most edits between matching keys of these lengths; below zero for none."""
        most = F.floor((100 - self.threshold) * (m + n) / 100).cast("int")
        return most - F.pmod(most + m + n, F.lit(2))

    def widest_budget(self, m: Column) -> Column:
        """Most edits between a key of length ``m`` and any key not longer."""
        return F.greatest(self.budget(m, m), self.budget(m, m - 1))

    def longest_partner(self, n: Column) -> Column:
        return F.floor(n * (200 - self.threshold) / self.threshold).cast("int")

    def _class(self, m: Column) -> Column:
        bounds = [F.get(F.array(*map(F.lit, side)), m - 1) for side in (self.lows, self.highs)]
        return F.struct(bounds[0].alias("low"), bounds[1].alias("high"))

    # The two tables below depend on the threshold and the longest key only: a
    # hundred thousand rows of small numbers at most, which are broadcast.

    def segment_table(self, spark: SparkSession, longest: int) -> DataFrame:
        """(len, low, widest, i, at, size): the segments of a key, by key length.

        ``widest`` is the most edits in the key's class of lengths, of which ``low`` is the shortest.
        """
        return (
            spark.range(1, min(longest, self.positional) + 1)
            .select(F.col("id").cast("int").alias("len"))
            .select("len", self._class(F.col("len")).alias("class"))
            .select("len", "class.low", self.widest_budget(F.col("class.high")).alias("widest"))
            .where(F.col("widest") > 0)
            .withColumn("i", F.explode(F.sequence(F.lit(0), "widest")))
            .select("*", *_span(F.col("i"), F.lit(0)))
        )

    def probe_table(self, spark: SparkSession, longest: int) -> DataFrame:
        """(len, low, widest, step, near, far, d, i, s, at, size): where a key may hold a longer key's segment.

        ``near`` and ``far`` are the least and the greatest length that the longer key may have, ``d``
        the most edits; ``s`` is how far the segment is shifted. ``step`` is 2 where the length is one.
        """
        n, i, s = F.col("len"), F.col("i"), F.col("s")
        near, far = F.greatest("class.low", n), F.least("class.high", self.longest_partner(n))
        lengths = F.sequence(n, F.least(F.lit(self.positional), self.longest_partner(n)))
        left = F.col("d") - i
        return (
            spark.range(1, min(longest, self.positional) + 1)
            .select(F.col("id").cast("int").alias("len"))
            .select("len", F.explode(F.array_distinct(F.transform(lengths, self._class))).alias("class"))
            .select(
                "len",
                "class.low",
                self.widest_budget(F.col("class.high")).alias("widest"),
                F.when(F.col("class.low") == F.col("class.high"), 2).otherwise(1).alias("step"),
                near.alias("near"),
                far.alias("far"),
            )
            .withColumn("d", F.greatest(self.budget(F.col("far"), n), self.budget(F.greatest("near", F.col("far") - 1), n)))
            .where(F.col("d") > 0)
            .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("d"))))
            .withColumn("s", F.explode(F.sequence(-i, i, F.when(i > 0, 2).otherwise(1))))
            .where((s <= left + n - F.col("near")) & (s >= n - F.col("far") - left))
            .select("*", *_span(i, s))
            .where((F.col("at") >= 0) & (F.col("at") + F.col("size") <= n))
        )

    @staticmethod
    def _signed(keys: DataFrame, table: DataFrame) -> DataFrame:
        text = F.substr("key", F.col("at") + 1, F.col("size"))
        rows = keys.join(F.broadcast(table), "len").withColumn("sig", F.xxhash64("low", "i", text))
        return rows.drop("at", "size")

    def index_rows(self, keys: DataFrame, longest: int) -> DataFrame:
        """Signature rows of ``keys`` in the role of the longer key."""
        return self._signed(keys, self.segment_table(keys.sparkSession, longest))

    def probe_rows(self, keys: DataFrame, longest: int) -> DataFrame:
        """Signature rows of ``keys`` in the role of the shorter key."""
        return self._signed(keys, self.probe_table(keys.sparkSession, longest))

    # Keys beyond the positional length share segments of a wide class of lengths at any place.

    def long_index(self, keys: DataFrame) -> DataFrame:
        m = F.col("len")
        size = lambda i: F.least(F.lit(self.segment), m - i * self.segment)
        segments = F.transform(
            F.sequence(F.lit(0), self.widest_budget(m)),
            lambda i: F.substr("key", i * self.segment + 1, size(i)),
        )
        # A segment repeated within one key needs one row only.
        return (
            keys.where((m > self.positional) & (self.widest_budget(m) > 0))
            .withColumn("text", F.explode(F.array_distinct(segments)))
            .withColumn("sig", F.xxhash64(_length_class(m), F.lit(-1), "text"))
        )

    def long_probe(self, keys: DataFrame) -> DataFrame:
        n, size = F.col("len"), F.col("shape.size")
        # Segments of a longer key are full ones, and possibly one shorter at the end.
        shapes = F.transform(
            F.sequence(F.greatest(n, F.lit(self.positional + 1)), self.longest_partner(n)),
            lambda m: F.array(
                F.struct(_length_class(m).alias("class"), F.lit(self.segment).alias("size")),
                F.struct(
                    _length_class(m).alias("class"),
                    F.least(
                        F.lit(self.segment), m - self.widest_budget(m) * self.segment
                    ).alias("size"),
                ),
            ),
        )
        texts = F.transform(F.sequence(F.lit(1), n - size + 1), lambda at: F.substr("key", at, size))
        return (
            keys.where(self.longest_partner(n) > self.positional)
            .withColumn("shape", F.explode(F.array_distinct(F.flatten(shapes))))
            .where(size.between(1, n))
            .withColumn("text", F.explode(F.array_distinct(texts)))
            .withColumn("sig", F.xxhash64("shape.class", F.lit(-1), "text"))
        )

    def may_match(self, equal_lengths: bool) -> Column:
        """Cheap exact-safe test on a pair of signature rows."""
        m, n = F.col("a_len"), F.col("b_len")
        return ((m > n) | ((m == n) & equal_lengths)) & self.alike()

    def alike(self) -> Column:
        """Whether no more characters differ than edits are allowed, whatever their order."""
        differing = F.bit_count(F.col("a_lo").bitwiseXOR(F.col("b_lo"))) + F.bit_count(
            F.col("a_hi").bitwiseXOR(F.col("b_hi"))
        )
        return differing <= F.floor((100 - self.threshold) * (F.col("a_len") + F.col("b_len")) / 100)


def _cut(i: Column) -> Column:
    """Where segment ``i`` begins in a key of the class of lengths from ``low`` on."""
    return F.call_function("div", i * F.col("low"), F.col("widest") + 2).cast("int")


def _span(i: Column, shift: Column) -> list[Column]:
    return [(_cut(i) + shift).alias("at"), (_cut(i + 1) - _cut(i)).alias("size")]


def add_last_segment(rows: DataFrame, probe: bool) -> DataFrame:
    """Extend the signatures of ``dense`` rows by segment ``j``, which has as many edits on its right as segments.

    A probe row may hold it at several shifts ``t``. Other rows stay as they are.
    """
    dense, i, j, s, t, n = (F.col(c) for c in ("dense", "i", "j", "s", "t", "len"))
    last = F.col("widest") + 1
    rows = rows.withColumn("j", F.explode(F.when(dense, F.sequence(i + 1, last)).otherwise(F.array(last))))
    if probe:
        between = j - i - 1 - (F.col("widest") - F.col("d"))
        shifts = F.when(dense, F.sequence(s - between, s + between, F.col("step"))).otherwise(F.array(s))
        rows = rows.where(~dense | (between >= 0)).withColumn("t", F.explode(shifts))
        rows = rows.where(
            ~dense
            | (t >= n - F.col("far") - (last - j))
            & (t <= n - F.col("near") + (last - j))
            & (_cut(j) + t >= _cut(i + 1) + s)
            & (_cut(j + 1) + t <= n)
        )
    at, size = _span(j, t if probe else F.lit(0))
    longer = F.xxhash64("sig", "j", F.substr("key", at + 1, size))
    return rows.withColumn("sig", F.when(dense, longer).otherwise(F.col("sig")))


def _length_class(m: Column) -> Column:
    """Classes about ten percent wide."""
    return F.floor(F.log(m.cast("double")) / math.log(1.1)).cast("int")


def _sides(rows: DataFrame, side: str) -> DataFrame:
    return rows.select(
        "sig",
        F.col("kid").alias(side),
        F.col("len").alias(f"{side}_len"),
        F.col("bits_lo").alias(f"{side}_lo"),
        F.col("bits_hi").alias(f"{side}_hi"),
    )


def meeting_rows(
    longer: DataFrame, shorter: DataFrame, blocking: Blocking, longest: int
) -> tuple[DataFrame, DataFrame]:
    """The signature rows of both sides, extended where a signature is crowded."""
    index, probe = blocking.index_rows(longer, longest), blocking.probe_rows(shorter, longest)
    counts = index.groupBy("sig").agg(F.count("*").alias("keys"))
    # Stored, so that Spark knows its size and broadcasts it only while it is small.
    crowded = written(counts.where(F.col("keys") > CROWDED).select("sig", F.lit(True).alias("dense")), "crowded")
    sides = []
    for rows, side in ((index, "a"), (probe, "b")):
        marked = rows.join(crowded, "sig", "left").withColumn("dense", F.coalesce("dense", F.lit(False)))
        sides.append(_sides(add_last_segment(marked, probe=side == "b"), side))
    if longest > blocking.positional:
        sides[0] = sides[0].unionByName(_sides(blocking.long_index(longer), "a"))
        sides[1] = sides[1].unionByName(_sides(blocking.long_probe(shorter), "b"))
    return sides[0], sides[1]


def candidate_pairs(
    longer: DataFrame,
    shorter: DataFrame,
    blocking: Blocking,
    equal_lengths: Column,
    longest: int,
    total: int,
    hot_rows: int = HOT_SIGNATURE_ROWS,
) -> DataFrame:
    """Distinct (a, b) key ids that share a signature and pass the cheap test."""
    index, probe = meeting_rows(longer, shorter, blocking, longest)
    # A key has a signature once, so few keys cannot make one hot.
    hot = hot_cells(index, probe, "sig", hot_rows) if total > hot_rows else None
    met = grid_join(index, probe, "sig", hot, "a", "b", blocking.may_match(equal_lengths))
    return met.select("a", "b").distinct()


def extent(keys: DataFrame) -> tuple[int, int]:
    """Length of the longest key, and the number of keys."""
    longest, total = keys.agg(F.max("len"), F.count("*")).first()
    return longest or 0, total


def meetings(keys: DataFrame, blocking: Blocking, longest: int) -> int:
    """How many rows of ``keys`` with ``keys`` meet in a signature; a check before joining."""
    index, probe = meeting_rows(keys, keys, blocking, longest)
    counts = [side.groupBy("sig").agg(F.count("*").alias(name)) for side, name in ((index, "m"), (probe, "n"))]
    return counts[0].join(counts[1], "sig").agg(F.sum(F.col("m") * F.col("n"))).first()[0] or 0


# --- verification -----------------------------------------------------------------


@F.pandas_udf(IntegerType())
def common_length(a: pd.Series, b: pd.Series) -> pd.Series:
    """Length of the longest common subsequence of each pair."""
    return pd.Series(common_lengths(a.tolist(), b.tolist()))


def common_lengths(a: list[str], b: list[str]) -> np.ndarray:
    pairs = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b, strict=True)]
    out = np.zeros(len(pairs), dtype=np.int32)
    sizes = np.fromiter((len(x) for x, _ in pairs), dtype=np.int64, count=len(pairs))
    # Half a word for short keys, else as many whole ones as the shorter key takes.
    words = np.where(sizes <= 32, 0, (sizes + 63) // 64)
    for count in np.unique(words):
        at = np.flatnonzero(words == count)
        # Pairs of similar length go together, so few steps are spent on filler.
        at = at[np.argsort([len(pairs[i][1]) for i in at], kind="stable")]
        for part in np.array_split(at, -(-len(at) // PAIRS_AT_A_TIME)):
            out[part] = _lcs_words([pairs[i] for i in part], np.uint64 if count else np.uint32, max(count, 1))
    return out


def _lcs_words(pairs: list[tuple[str, str]], word: type, count: int) -> np.ndarray:
    # One row of the dynamic program per pair, kept in the bits of ``count`` words; all
    # pairs take each step together, and what a word carries over goes into the next.
    short = _code_points([x for x, _ in pairs], 0xFFFFFFFE, 8 * np.dtype(word).itemsize * count)
    long = _code_points([y for _, y in pairs], 0xFFFFFFFF)
    row = np.full((len(pairs), count), ~word(0))
    for j in range(long.shape[1]):
        equal = np.packbits(short == long[:, j : j + 1], axis=1, bitorder="little")
        hit = row & equal.view(word)
        added = row + hit
        carry = added[:, 0] < row[:, 0]
        for at in range(1, count):
            added[:, at] += carry
            # A word overflows by its own sum, or by the one that was carried into it.
            carry = (added[:, at] < row[:, at]) | (carry & (added[:, at] == 0))
        row = added | (row - hit)
    return np.bitwise_count(~row).sum(axis=1).astype(np.int32)


def _code_points(texts: list[str], filler: int, width: int = 0) -> np.ndarray:
    width = width or max(map(len, texts))
    codes = np.array(texts, dtype=f"U{width}").view(np.uint32).reshape(len(texts), width)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    return np.where(np.arange(width) < sizes[:, None], codes, np.uint32(filler))


def verified(pairs: DataFrame, keys: DataFrame, threshold: int) -> DataFrame:
    """(a, b, score) of the candidate pairs that reach the threshold."""
    a = keys.select(F.col("kid").alias("a"), F.col("key").alias("a_key"), F.col("len").alias("a_len"))
    b = keys.select(F.col("kid").alias("b"), F.col("key").alias("b_key"), F.col("len").alias("b_len"))
    return _scored(pairs.join(a, "a").join(b, "b"), threshold)


def _scored(pairs: DataFrame, threshold: int) -> DataFrame:
    # Marked as nondeterministic only so that the planner evaluates it once.
    lcs = common_length.asNondeterministic()
    common, total = F.col("common"), F.col("a_len") + F.col("b_len")
    return (
        pairs.withColumn("common", lcs("a_key", "b_key"))
        .where(200 * common >= threshold * total)
        .select("a", "b", (F.lit(200.0) * common / total).alias("score"))
    )


# --- joins of key tables -------------------------------------------------------------


def similar_keys(
    keys: DataFrame,
    threshold: int = SIMILARITY_THRESHOLD,
    positional: int = POSITIONAL_LENGTH,
    hot_rows: int = HOT_SIGNATURE_ROWS,
) -> DataFrame:
    """Every unordered pair of different keys that match, once, as (a, b, score)."""
    blocking = Blocking(threshold, positional)
    larger = F.col("a") > F.col("b")
    pairs = candidate_pairs(keys, keys, blocking, larger, *extent(keys), hot_rows)
    return verified(pairs, keys, threshold)


def similar_between(
    some: DataFrame,
    keys: DataFrame,
    threshold: int = SIMILARITY_THRESHOLD,
    positional: int = POSITIONAL_LENGTH,
    hot_rows: int = HOT_SIGNATURE_ROWS,
) -> DataFrame:
    """Matches of ``some`` of the keys with all ``keys`` but themselves, as (a, b, score)."""
    blocking = Blocking(threshold, positional)
    other, size = F.col("a") != F.col("b"), extent(keys)
    above = candidate_pairs(keys, some, blocking, other, *size, hot_rows).select(
        F.col("b").alias("a"), F.col("a").alias("b")
    )
    below = candidate_pairs(some, keys, blocking, F.lit(False), *size, hot_rows)
    return verified(above.unionByName(below), keys, threshold)


def similar_to_few(some: DataFrame, keys: DataFrame, threshold: int, parts: int) -> DataFrame:
    """What ``similar_between`` finds, with each of ``some`` compared with each of ``keys`` in ``parts`` tasks.

    Where most keys share signatures, few against all are fewer pairs than the rows that would meet.
    """
    sides = [
        rows.select(
            *[F.col(c).alias(f"{side}_{c}") for c in ("key", "len")],
            *[F.col(f"bits_{c}").alias(f"{side}_{c}") for c in ("lo", "hi")],
            F.col("kid").alias(side),
        )
        for side, rows in (("a", some), ("b", keys))
    ]
    near = (F.col("a") != F.col("b")) & Blocking(threshold).alike()
    met = sides[1].repartition(parts, "b").join(F.broadcast(sides[0]), near)
    return _scored(met, threshold)


# --- joins of rows -------------------------------------------------------------------


def stored_keys(df: DataFrame) -> DataFrame:
    """Distinct ``key`` values with ids and features, written to shared storage.

    The ids are positions within partitions; being written is what fixes them.
    """
    ids = df.select("key").distinct().withColumn("kid", F.monotonically_increasing_id())
    return written(key_features(ids), "keys")


def member_pairs(edges: DataFrame, members: DataFrame, hot_rows: int, parts: int | None = None) -> DataFrame:
    """(x, y, score): unordered pairs of different members with equal or similar keys.

    ``members`` is (kid, member), and further columns, which come back for either side as ``x_`` and
    ``y_`` ones. A key with many members, or many similar keys, is cut into a grid, so no task holds
    all members of one key. ``parts`` tells how many tasks share the pairs, if not Spark.
    """
    more = [c for c in members.columns if c not in ("kid", "member")]
    hot = hot_keys(members, "kid", hot_rows) if members.count() > hot_rows else None
    x, y = (
        members.select("kid", F.col("member").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in more])
        for side in ("x", "y")
    )
    same = grid_join(x, y, "kid", hot, "x", "y", F.col("x") > F.col("y"), parts)
    first = grid_join(edges.withColumnRenamed("a", "kid"), x, "kid", hot, "b", "x").drop("kid")
    across = grid_join(first.withColumnRenamed("b", "kid"), y, "kid", hot, "x", "y", parts=parts)
    pairs = same.withColumn("score", F.lit(100.0)).unionByName(across)
    return pairs.select("x", "y", "score", *[f"{side}_{c}" for side in ("x", "y") for c in more])


def name_matches(
    df: DataFrame,
    col: str = "name",
    threshold: int = SIMILARITY_THRESHOLD,
    hot_rows: int = HOT_SIGNATURE_ROWS,
) -> DataFrame:
    """(name, match, score): each distinct name with every other one it matches."""
    names = df.select(F.col(col).cast("string").alias("name")).distinct()
    keyed = written(with_token_key(names, "name"), "names")
    keys = stored_keys(keyed)
    members = keyed.join(keys.select("key", "kid"), "key")
    members = written(members.select("kid", F.col("name").alias("member")), "members")
    pairs = member_pairs(similar_keys(keys, threshold, hot_rows=hot_rows), members, hot_rows)
    # Both directions from one pass over the pairs.
    return pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("x").alias("name"), F.col("y").alias("match"), "score"),
                F.struct(F.col("y").alias("name"), F.col("x").alias("match"), "score"),
            )
        ).alias("found")
    ).select("found.*")


@dataclass
class DuplicateIndex:
    """The matches of coded rows, not yet written out pair by pair.

    ``members`` is (kid, member, n): the row codes of each key and how often each
    occurs. ``edges`` is (a, b, score): the keys that are similar. A name shared
    by a third of all rows is one key here, where its pairs would be quadratic.
    """

    members: DataFrame
    edges: DataFrame
    hot_rows: int = HOT_SIGNATURE_ROWS

    @cached_property
    def parts(self) -> int | None:
        """How many tasks should share the listed pairs; None, if Spark may settle it, as they are few.

        Pairs are quadratic in copies, so the number of tasks has to grow with them, or what one holds would.
        """
        sizes = self.members.groupBy("kid").agg(F.count("*").alias("n"))
        within = sizes.select((F.col("n") * (F.col("n") - 1) / 2).alias("n"))
        across = self.edges.join(sizes.toDF("a", "a_n"), "a").join(sizes.toDF("b", "b_n"), "b")
        across = across.select((F.col("a_n") * F.col("b_n")).cast("double").alias("n"))
        listed = within.unionByName(across).agg(F.sum("n")).first()[0] or 0
        if listed <= PAIRS_PER_TASK:
            return None
        spread = int(self.members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return max(spread, math.ceil(listed / PAIRS_PER_TASK))

    def pairs(self) -> DataFrame:
        """(later, earlier, score): each pair of matching codes once.

        Two codes with one key each meet once, by that; only pairs with a code of several keys are
        made distinct.
        """
        # A code that occurs twice with one key is a pair of its own.
        repeated = self.members.where(F.col("n") > 1).select(
            F.col("member").alias("x"), F.col("member").alias("y"), F.lit(100.0).alias("score")
        )
        keys = self.members.groupBy("member").agg(F.count("*").alias("keys"))
        several = written(keys.where(F.col("keys") > 1).select("member", F.lit(True).alias("several")), "several")
        members, single = self.members.select("kid", "member"), several.isEmpty()
        if single:
            found = member_pairs(self.edges, members, self.hot_rows, self.parts).unionByName(repeated)
        else:
            members = members.join(several, "member", "left").withColumn("several", F.coalesce("several", F.lit(False)))
            listed = member_pairs(self.edges, written(members, "members"), self.hot_rows, self.parts)
            found = listed.where("not (x_several or y_several)").select("x", "y", "score")
            again = listed.where("x_several or y_several").select("x", "y", "score").unionByName(repeated)
        shown = F.greatest("x", "y").alias("later"), F.least("x", "y").alias("earlier"), "score"
        found = found.select(*shown)
        if single:
            return found
        again = again.select(*shown)
        if self.parts:
            again = again.repartition(self.parts, "later", "earlier")
        return found.unionByName(again.groupBy("later", "earlier").agg(F.max("score").alias("score")))


def duplicate_index(
    df: DataFrame,
    code: str = "supplier_code",
    col: str = "name",
    threshold: int = SIMILARITY_THRESHOLD,
    hot_rows: int = HOT_SIGNATURE_ROWS,
) -> DuplicateIndex:
    """Match rows by name. Rows are first reduced to (key, code) counts."""
    if code not in df.columns or col not in df.columns:
        spark = df.sparkSession
        return DuplicateIndex(
            spark.createDataFrame([], "kid bigint, member string, n bigint"),
            spark.createDataFrame([], "a bigint, b bigint, score double"),
        )
    keyed = written(coded_keys(df, code, col), "rows")
    keys = stored_keys(keyed)
    edges = written(similar_keys(keys, threshold, hot_rows=hot_rows), "edges")
    return DuplicateIndex(index_members(keyed, keys), edges, hot_rows)


def coded_keys(df: DataFrame, code: str, col: str) -> DataFrame:
    """(key, code, n): how often each code has each key."""
    rows = df.select(F.col(code).cast("string").alias("code"), F.col(col).cast("string").alias("name"))
    # Copies are merged before keys are built: once per distinct pair, not per row.
    counted = rows.dropna().groupBy("name", "code").agg(F.count("*").alias("n"))
    return with_token_key(counted, "name").groupBy("key", "code").agg(F.sum("n").alias("n"))


def index_members(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    members = keyed.join(keys.select("key", "kid"), "key")
    return written(members.select("kid", F.col("code").alias("member"), "n"), "members")


def duplicate_pairs(
    df: DataFrame,
    code: str = "supplier_code",
    col: str = "name",
    threshold: int = SIMILARITY_THRESHOLD,
    hot_rows: int = HOT_SIGNATURE_ROWS,
) -> DataFrame:
    """(later, earlier, score): every two rows whose names match, by row code.

    Rows with equal keys match without any scoring; rows with different keys
    match when their keys do. The result holds each pair of codes once.
    """
    return duplicate_index(df, code, col, threshold, hot_rows).pairs()


# Between the two codes of a pair key.
ARROW = "->"


def pair_key(later: str = "later", earlier: str = "earlier") -> Column:
    return F.concat_ws(ARROW, later, earlier)
