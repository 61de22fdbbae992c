"""SimHash near-duplicates with deletion-variant signatures.

Fingerprints of 64 bits link at three or fewer differing bits. Cut into two halves, one half of any
such pair differs by at most one bit. So each distinct fingerprint is indexed under every half with
one bit wiped out (2 x 32 keys); a pair meets where the wiped bit is the differing one, or, if the
halves are equal, under wiped bit 0. Every meeting checks the whole distance. Groups need links that
connect them, not all links, so crowds of near copies are first linked to a few picks of their key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.llm.components import components
from scrubline.llm.tables import SLICE_ROWS, broadcast_if_small, is_empty, map_slices, shuffle_partitions, spare_name
from scrubline.operators.skew import grid_join, hot_cells
from scrubline.workspace import written

BITS = 64
HALF = 32
SHINGLE_WORDS = 3
MOST_BITS = 3

# Rows of a join cell on either side beyond which it is cut into a grid.
HOT_CELL_ROWS = 4096
# Shingles whose hashes are unpacked into bits at a time.
HASH_BLOCK = 1 << 16

# A to Z become lower case; the six white space characters become a blank.
_FOLD = bytes.maketrans(
    b"\t\n\x0b\x0c\r" + bytes(range(65, 91)), b"     " + bytes(range(97, 123))
)


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one text as a signed 64-bit number; 0 without words."""
    words = [w for w in (text or "").encode("utf-8", "replace").translate(_FOLD).split(b" ") if w]
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = min(shingle_words, len(words)) - 1
    firsts, lasts = starts[: len(words) - last].tolist(), ends[last:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(firsts), HASH_BLOCK):
        spans = zip(firsts[at : at + HASH_BLOCK], lasts[at : at + HASH_BLOCK], strict=True)
        hashes = np.array([digest(joined[i:j], 42) for i, j in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > len(firsts), bitorder="little")
    return int(packed.view("<i8")[0])


def with_fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``fp`` (signed long) of every row; null and blank texts have 0."""

    def rule(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = [fingerprint(text, shingle_words) for text in batch.column(1).to_pylist()]
        columns = [batch.column(0), pa.array(prints, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_slices(rows, rule, "doc_id long, fp long")


def _half(value: Column, half: int) -> Column:
    return F.shiftrightunsigned(value, half * HALF).bitwiseAND(F.lit((1 << HALF) - 1))


def _variants(prints: DataFrame) -> DataFrame:
    """``key``, ``half``, ``wiped`` (the bit left out), ``fp``: 64 rows per fingerprint.

    Fingerprints are dealt out before they multiply: as stored, they may be a file or two.
    """
    prints = prints.select("fp").repartition(shuffle_partitions(prints.sparkSession), "fp")
    wiped = F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("bit")
    every = prints.select("fp", wiped).select(
        "fp",
        F.floor(F.col("bit") / HALF).cast("int").alias("half"),
        F.expr(f"shiftleft(1L, bit % {HALF})").alias("wiped"),
        "bit",
    )
    kept = _own_half().bitwiseAND(F.bitwise_not("wiped"))
    return every.select(
        kept.bitwiseOR(F.shiftleft(F.col("bit").cast("long"), HALF)).alias("key"),
        "half",
        "wiped",
        "fp",
    )


def _meets(left: DataFrame, right: DataFrame, most_bits: int) -> DataFrame:
    """Pairs ``a < b`` of two sides with ``key``, ``half``, ``wiped``, each link once."""
    differs = F.col("a").bitwiseXOR(F.col("b"))
    low, high = _half(differs, 0), _half(differs, 1)
    here = F.when(F.col("half") == 0, low).otherwise(high)
    # One meeting counts: at the differing bit, or at bit 0 if this half is equal; the lower half
    # goes first where both would do.
    counts = (here == F.col("wiped")) | ((here == 0) & (F.col("wiped") == 1))
    first = (F.col("half") == 0) | (F.bit_count(low) > 1)
    near = (F.bit_count(differs) <= most_bits) & (F.col("a") < F.col("b"))
    return left.hint("merge").join(right.hint("merge"), "key").where(near & counts & first).select("a", "b")


def _checked_bits(most_bits: int) -> None:
    if not 0 <= most_bits <= 3:
        raise ValueError("two halves find pairs of at most three differing bits")


def links(prints: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints ``fp`` that differ in 1 to ``most_bits`` bits.

    Two halves guarantee a half with at most one differing bit up to three bits in all. This lists
    every link, which within a crowd of near copies are as many as its pairs.
    """
    _checked_bits(most_bits)
    variants = _variants(prints)
    left = variants.select("key", "half", "wiped", F.col("fp").alias("a"))
    return _meets(left, variants.select("key", F.col("fp").alias("b")), most_bits)


def connecting_links(prints: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """Links ``(a, b)`` of distinct fingerprints ``fp`` that connect all that ``links`` connects.

    Keys that a single fingerprint has end after one aggregate. In the others, each fingerprint is
    first compared with three of its key's (the smallest, the largest and one by a hash). Only keys
    whose fingerprints these links leave in different groups are looked at again, by parts of the other
    half, and only pairs from different groups leave that join. So a crowd of near copies costs a few
    links each.
    """
    _checked_bits(most_bits)
    variants = _variants(prints)
    # Nearly every key is single, so rows are dealt by key and not combined in maps before.
    picks = variants.select("key", "fp").repartition("key").groupBy("key").agg(
        F.min("fp").alias("p0"), F.max("fp").alias("p1"), F.min_by("fp", F.xxhash64("fp")).alias("p2")
    )
    shared = broadcast_if_small(written(picks.where("p0 < p1"), "shared"))
    crowded = written(variants.join(shared, "key"), "crowded")
    pairs = crowded.select("fp", F.explode(F.array_distinct(F.array("p0", "p1", "p2"))).alias("pick"))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("pick"))).between(1, most_bits)
    to_picks = pairs.where(near).select(F.least("fp", "pick").alias("a"), F.greatest("fp", "pick").alias("b"))
    to_picks = written(to_picks.distinct(), "to-picks")
    known = components(to_picks).toDF("fp", "known")
    grouped = crowded.select("key", "half", "wiped", "fp").join(known, "fp", "left")
    grouped = written(grouped.withColumn("group", F.coalesce("known", "fp")).drop("known"), "grouped")
    side = F.when(_own_half().bitwiseAND(F.col("wiped")) != 0, F.col("group")).alias("one")
    sides = grouped.select("key", "group", side).withColumn("zero", F.when(F.col("one").isNull(), F.col("group")))
    split = sides.groupBy("key").agg(
        *[extreme(c).alias(f"{c}_{at}") for c in ("group", "one", "zero") for at, extreme in enumerate((F.min, F.max))]
    )
    split = split.where("group_0 < group_1").select(
        "key",
        # Rows that differ in the wiped bit need both sides; rows with equal halves are on one side.
        F.expr("one_0 is not null and zero_0 is not null").alias("apart"),
        F.expr("coalesce(one_0 < one_1, false) or coalesce(zero_0 < zero_1, false)").alias("equal"),
    )
    open_keys = grouped.join(split, "key").where("apart or (equal and wiped = 1)")
    return to_picks.union(_across_groups(written(open_keys, "open"), most_bits))


def _own_half() -> Column:
    return F.when(F.col("half") == 0, _half(F.col("fp"), 0)).otherwise(_half(F.col("fp"), 1))


def _parts(value: Column, cuts: list[int]) -> Column:
    """(number, bits) of the parts of a half that is cut at the bit numbers ``cuts``."""
    parts = [
        F.struct(
            F.lit(at).alias("part"),
            F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << (high - low)) - 1)).alias("bits"),
        )
        for at, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False))
    ]
    return F.explode(F.array(*parts)).alias("cell")


def _across_groups(rows: DataFrame, most_bits: int) -> DataFrame:
    """Near pairs of different ``group`` among stored rows that share a ``key``.

    Rows whose half is equal differ in at most three bits of the other half, so one of its four parts
    is equal; rows that differ in the wiped bit differ in at most two more, so one of three parts is.
    They meet in such a part only, the second kind with the wiped bit on one side. So fingerprints
    that share a half without being near hardly meet, and cells that are still crowded become a grid.
    """
    own = _own_half()
    other = F.when(F.col("half") == 0, _half(F.col("fp"), 1)).otherwise(_half(F.col("fp"), 0))
    has_bit = own.bitwiseAND(F.col("wiped")) != 0
    equal = rows.where("equal and wiped = 1").select("half", own.alias("own"), "fp", "group", _parts(other, [0, 8, 16, 24, 32]))
    equal = equal.select(F.xxhash64(F.lit(0), "half", "own", "cell").alias("cell"), "fp", "group")
    apart = rows.where("apart").select("key", has_bit.alias("has_bit"), "fp", "group", _parts(other, [0, 11, 22, 32]))
    apart = apart.select(F.xxhash64(F.lit(1), "key", "cell").alias("cell"), "has_bit", "fp", "group")
    sides = [(equal, equal, F.col("a") < F.col("b")), (apart.where("not has_bit"), apart.where("has_bit"), F.lit(True))]
    found = []
    for left, right, once in sides:
        left = left.select("cell", F.col("fp").alias("a"), F.col("group").alias("a_group"))
        right = right.select("cell", F.col("fp").alias("b"), F.col("group").alias("b_group"))
        near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most_bits
        wanted = once & near & (F.col("a_group") != F.col("b_group"))
        hot = hot_cells(left, right, "cell", HOT_CELL_ROWS)
        met = grid_join(left, right, "cell", hot, "a", "b", wanted)
        found.append(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    return found[0].union(found[1])


def _grouped(
    docs: DataFrame, shingle_words: int, most_bits: int
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row, and (fp, component_id, lead) of every fingerprint.

    ``lead`` is the smallest fingerprint that the group's smallest ``doc_id`` has in it.
    """
    prints = written(with_fingerprints(docs, shingle_words), "prints")
    groups = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "prints")
    found = components(connecting_links(groups.select("fp"), most_bits)).withColumnRenamed("node", "fp")
    top = F.coalesce("component", "fp").alias("top")
    grouped = groups.join(found, "fp", "left").select("fp", "first_doc", top)
    first = F.when(F.col("first_doc").isNotNull(), F.struct("first_doc", "fp"))
    smallest = grouped.groupBy("top").agg(F.min(first).alias("first"))
    smallest = smallest.select("top", F.col("first.first_doc").alias("component_id"), F.col("first.fp").alias("lead"))
    return prints, written(grouped.join(smallest, "top").select("fp", "component_id", "lead"), "named")


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (hex), ``component_id`` for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable over links. Equal fingerprints always link,
    also those of texts without words (null, empty, white space), whose fingerprint is zero. Repeated
    rows stay repeated. A null ``doc_id`` takes part but is never a smallest one: its component is
    null if nothing else is reachable. Other columns are ignored; an empty table gives no rows.
    """
    prints, named = _grouped(docs, shingle_words, most_bits)
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """One row of ``docs`` for each group: that of its smallest ``doc_id``.

    Rows that repeat a ``doc_id`` with other texts are told apart by their fingerprints, so an id may
    stay for several groups, once for each. Rows without ``doc_id`` stay where their
    group has no id at all, one for each fingerprint. Texts only move if the ids of the rows that go
    are too many to broadcast. Only rows that repeat an id or have none go to Python again.
    """

    @F.arrow_udf("long")
    def print_of(texts: pa.Array) -> pa.Array:
        slices = (texts.slice(at, SLICE_ROWS).to_pylist() for at in range(0, len(texts), SLICE_ROWS))
        return pa.array([fingerprint(text, shingle_words) for some in slices for text in some], pa.int64())

    # Else the joins' own test for nulls is moved below and calls it again: two workers for each task.
    print_of = print_of.asNondeterministic()

    own = spare_name(docs, "fingerprint_of_row")
    prints, named = _grouped(docs, shingle_words, most_bits)
    leads = F.max((F.col("doc_id") == F.col("component_id")) & (F.col("fp") == F.col("lead")))
    gone = prints.where("doc_id is not null").join(named, "fp").groupBy("doc_id").agg(leads.alias("leads"))
    gone = broadcast_if_small(written(gone.where("not leads").select("doc_id"), "gone"))
    stays = docs.where("doc_id is not null").join(gone, docs["doc_id"].cast("long") == gone["doc_id"], "left_anti")
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 and doc_id is not null")
    repeated = broadcast_if_small(written(repeated.select("doc_id"), "repeated"))
    if not is_empty(repeated):
        again = stays["doc_id"] == repeated["doc_id"]
        single = stays.join(repeated, again, "left_anti")
        several = stays.join(repeated, again, "left_semi").withColumn(own, print_of(F.col("text").cast("string")))
        heads = named.where("fp = lead").select("component_id", F.col("lead").alias(own))
        same = (several[own] == heads[own]) & (several["doc_id"].cast("long") == heads["component_id"])
        several = several.join(heads, same, "left_semi").dropDuplicates(["doc_id", own]).drop(own)
        stays = single.union(several)

    nameless = docs.where("doc_id is null")
    if is_empty(nameless):
        return stays
    nameless = nameless.withColumn(own, print_of(F.col("text").cast("string")))
    alone = named.where("component_id is null").select(F.col("fp").alias(own))
    nameless = nameless.join(alone, own, "left_semi").dropDuplicates([own]).drop(own)
    return stays.union(nameless)
