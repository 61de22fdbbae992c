"""Importance resampling towards a target text: array-scored weights, and a cutoff found in a bracket.

Hashed one- and two-word features are counted in the corpus and in the target; the log-ratio of both
makes an array of gains, one per bucket, and a document weighs the mean of its features' gains. With
Gumbel noise added to the weights, the highest scores are a sample without replacement. Their cutoff
is bracketed by a quantile sketch; exact counts outside the bracket say whether it lies within, or
widen it, and only the rows of the bracket are sorted to find it.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.ordering import running_totals
from scrubline.llm.tables import map_slices
from scrubline.workspace import written

BUCKETS = 10_000
LEAST_WORDS = 20
SHARE_PERCENT = 25
SEED = 7
# The sketch is exact to one in so many ranks; the bracket begins at so many times that on either side.
SKETCH_ACCURACY = 10_000
FIRST_WIDTH = 2

# Letters and digits and all beyond ASCII stay, A to Z in lower case; the rest becomes a blank.
_WORD_BYTES = set(range(48, 58)) | set(range(65, 91)) | set(range(97, 123)) | set(range(128, 256))
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if b in _WORD_BYTES else 32 for b in range(256))
# Bytes of a text whose words are listed at a time.
_BLOCK = 1 << 20


def _word_lists(text: str) -> Iterator[list[bytes]]:
    """The words of a text in order, a list for each block of it."""
    folded = text.encode("utf-8", "replace").translate(_FOLD)
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + _BLOCK)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def feature_buckets(text: str | None) -> Iterator[tuple[int, np.ndarray]]:
    """For each block of a whole text, how many words it has and the buckets of its one- and two-word features."""
    last: list[bytes] = []
    for words in _word_lists(text or ""):
        if not words:
            continue
        ones = list(map(zlib.crc32, words))
        # The checksum of two words goes on from that of the first one and a blank.
        firsts = map(zlib.crc32, repeat(b" "), map(zlib.crc32, last + words[:-1]))
        pairs = list(map(zlib.crc32, words if last else words[1:], firsts))
        yield len(words), np.array(ones + pairs, np.int64) % BUCKETS
        last = words[-1:]


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many features of all ``text`` values fall into each bucket. A task sends its sums only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for _, buckets in feature_buckets(text.as_py()):
                    sums += np.bincount(buckets, minlength=BUCKETS)
            pa.default_memory_pool().release_unused()
        seen = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(sums[seen])], ["bucket", "n"])

    counts = texts.select(F.col("text").cast("string")).mapInArrow(run, "bucket long, n long")
    found = np.zeros(BUCKETS, np.int64)
    # BUCKETS rows at most.
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        found[row["bucket"]] = row["n"]
    return found


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The floored, thousandfold log-ratio of each bucket's shares, with one feature more in every bucket."""
    s_all, t_all = int(corpus.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    ratio = [(t + 1) * s_all / ((s + 1) * t_all) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` of every row, by looking up its buckets in ``gain``."""

    def described(text: str | None) -> tuple[int, int, int]:
        words = features = total = 0
        for n, buckets in feature_buckets(text):
            words += n
            features += len(buckets)
            total += int(gain[buckets].sum())
        return words, features, total // features if features else 0

    def rule(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([described(text) for text in batch.column(1).to_pylist()], np.int64).reshape(-1, 3)
        columns = [batch.column(0), *map(pa.array, found.T)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_slices(rows, rule, "doc_id long, n_words long, n_features long, weight long")


def scored(docs: DataFrame, target: DataFrame, seed: int = SEED) -> DataFrame:
    """``weighted`` rows with ``score``: the weight with Gumbel noise from a hash of seed and doc_id."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weighted(docs, gain).withColumn("score", F.col("weight") + noise)


def cutoff(rows: DataFrame, wanted: int, total: int, width: int = FIRST_WIDTH) -> tuple[int, int | None] | None:
    """Score and doc_id of the ``wanted``-th of ``total`` stored ``rows`` by falling score, then doc_id.

    ``width`` is the bracket's first half-width in steps of the sketch. Null ids come last.
    """
    if wanted <= 0:
        return None
    while True:
        spread = width / SKETCH_ACCURACY
        at = 1 - wanted / total
        marks = [max(0.0, at - spread), min(1.0, at + spread)]
        low, high = rows.agg(F.percentile_approx("score", marks, SKETCH_ACCURACY)).first()[0]
        # The ends of the table bound every rank, whatever the sketch says.
        above = F.lit(False) if marks[1] == 1.0 else F.col("score") > high
        within = ~above & (F.lit(True) if marks[0] == 0.0 else F.col("score") >= low)
        n_above, n_within = rows.agg(F.count_if(above), F.count_if(within)).first()
        if n_above < wanted <= n_above + n_within:
            break
        width = max(8 * width, 1)
    bracket = rows.where(within).select((-F.col("score")).alias("falling"), *_id_order(), F.lit(1).alias("one"))
    placed = running_totals(bracket, ["falling", "no_id", "id"], ["one"])
    row = placed.where(F.col("before_one") == wanted - n_above - 1).first()
    return -row["falling"], None if row["no_id"] else row["id"]


def _id_order():
    return F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("id")


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = SHARE_PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score``, ``rank`` of every row of ``docs``.

    Of the rows with enough words, ``percent`` of a hundred (floored) are drawn and ranked from 1 by
    falling score, ties by doc_id; ``rank`` is null for all others. Null and empty texts have no features
    and weigh 0; a null doc_id counts as no digits and comes last among ties; repeated rows are drawn
    each for itself. Without target texts all gains follow from the corpus alone. An empty table gives
    no rows; other columns are ignored.
    """
    rows = written(scored(docs, target, seed), "scored")
    eligible = rows.where(F.col("n_words") >= least_words)
    total = eligible.count()
    wanted = percent * total // 100
    end = cutoff(eligible, wanted, total)
    shown = ["doc_id", "n_features", "weight", "score"]
    if end is None:
        return rows.select(*shown, F.lit(None).cast("long").alias("rank"))
    score, last = end
    before = F.lit(True) if last is None else F.coalesce(F.col("doc_id") <= last, F.lit(False))
    inside = (F.col("n_words") >= least_words) & ((F.col("score") > score) | ((F.col("score") == score) & before))
    drawn = rows.where(inside).select(*shown, (-F.col("score")).alias("falling"), *_id_order(), F.lit(1).alias("one"))
    order = ["falling", "no_id", "id", "n_features", "weight"]
    ranked = running_totals(drawn, order, ["one"]).withColumn("rank", F.col("before_one") + 1)
    # Rows that tie in all of the order may reach beyond the share.
    rank = F.when(F.col("rank") <= wanted, F.col("rank")).cast("long").alias("rank")
    return ranked.select(*shown, rank).unionByName(rows.where(~inside).select(*shown, F.lit(None).cast("long").alias("rank")))


def draw(docs: DataFrame, target: DataFrame, **limits) -> DataFrame:
    """The drawn rows of ``docs``: those whose doc_id is drawn with any of its rows."""
    ids = resampled(docs, target, **limits).where("rank is not null").select(F.col("doc_id").alias("_drawn_id")).distinct()
    return docs.join(ids, docs["doc_id"].cast("long").eqNullSafe(F.col("_drawn_id")), "left_semi")
