"""Quality scores by Bradley-Terry ranking of labelled documents.

A pair of a good and a poor document says that the first is preferred. The score of a document is
linear in features of its text, and the chance of a preference is the logistic function of the
difference of two scores; the weights minimise the logistic loss over pairs. Rejection starts at a
quantile of the training scores: the share of poor documents among the labels.

Every labelled document outside the held-out fold is learned from. The hash of its doc_id deals it to
a block, where it meets all documents of the other class, so the pairs grow in proportion to the
documents; a class too small to fill the blocks is dealt to several of them. Each Newton step sums over
all blocks in tasks, and a row of sums per block comes back. The quantile is that of all their scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scrubline.llm.tables import SLICE_ROWS, map_slices, shuffle_partitions
from scrubline.workspace import written

# Labelled documents that meet in a block, about.
BLOCK_ROWS = 4096
# Documents of the smaller class that a block gets at least, on average, if need be by dealing each to several.
LEAST_OPPONENTS = 64
# Winners whose pairs are held at a time.
WINNERS = 256
# Weight decay of the fit, per pair.
DECAY = 1e-3
# Documents with a score below are rejected.
ACCEPT = 0.3
# Label rows whose crc32(doc_id) has this remainder are never learned from.
FOLDS, HELD_OUT = 5, 0

FEATURES = [
    "empty",
    "log_bytes",
    "upper_share",
    "digit_share",
    "symbol_share",
    "pipe_share",
    "exclamation_share",
    "sentence_share",
    "comma_share",
    "blank_share",
    "line_share",
    "non_ascii_share",
    "mean_word",
    "long_word_share",
    "short_word_share",
    "single_share",
    "symbol_end_share",
    "repeated_line_share",
    "distinct_word_share",
    "same_as_last_share",
]

_UPPER = slice(65, 91)
_DIGIT = slice(48, 58)
_SYMBOLS = [ord(c) for c in "#$%&*+/<=>@\\^_`{}~"]
_PLAIN_END = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789.,;:?'\")")


def features(text: str | None) -> list[float]:
    """The values of FEATURES for one whole text; all zero but ``empty`` if it has no words."""
    data = (text or "").encode("utf-8", "replace")
    words = data.split()
    if not words:
        return [1.0] + [0.0] * (len(FEATURES) - 1)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n, n_words = len(data), len(words)
    lengths = np.fromiter(map(len, words), np.int64, n_words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    letters = max(1, int(counts[65:91].sum() + counts[97:123].sum()))
    odd_ends = sum(1 for w in words if w[-1] < 128 and w[-1] not in _PLAIN_END)
    return [
        0.0,
        float(np.log1p(n)),
        float(counts[_UPPER].sum()) / letters,
        float(counts[_DIGIT].sum()) / n,
        float(counts[_SYMBOLS].sum()) / n,
        float(counts[ord("|")]) / n_words,
        float(counts[ord("!")]) / n_words,
        float(counts[ord(".")]) / n_words,
        float(counts[ord(",")]) / n_words,
        float(counts[32]) / n,
        len(lines) / n_words,
        float(counts[128:].sum()) / n,
        float(lengths.mean()) / 10,
        float((lengths > 12).mean()),
        float((lengths <= 3).mean()),
        float((lengths == 1).mean()),
        odd_ends / n_words,
        1 - len(set(lines)) / len(lines),
        len(set(words)) / n_words,
        sum(map(eq, words, islice(words, 1, None))) / n_words,
    ]


@dataclass(frozen=True)
class Ranker:
    """Scores are ``weights . (features - mean) / scale``; ``cut`` is the quantile they are cut at."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def raw(self, values: np.ndarray) -> np.ndarray:
        return ((values - self.mean) / self.scale) @ self.weights

    def score(self, values: np.ndarray) -> np.ndarray:
        """Between 0 and 1, and ACCEPT at the cut."""
        shifted = self.raw(values) - self.cut + np.log(ACCEPT / (1 - ACCEPT))
        return 1 / (1 + np.exp(-np.clip(shifted, -500, 500)))


def _pair_sums(winners: np.ndarray, losers: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slope and bend of the log likelihood, summed over each winner with each loser."""
    width = len(weights)
    slope, bend = np.zeros(width), np.zeros((width, width))
    behind = losers @ weights
    for start in range(0, len(winners), WINNERS):
        some = winners[start : start + WINNERS]
        chance = 1 / (1 + np.exp(-np.clip((some @ weights)[:, None] - behind, -500, 500)))
        wrong, spread = 1 - chance, chance * (1 - chance)
        slope += wrong.sum(axis=1) @ some - wrong.sum(axis=0) @ losers
        across = some.T @ (spread @ losers)
        bend += (some.T * spread.sum(axis=1)) @ some + (losers.T * spread.sum(axis=0)) @ losers - across - across.T
    return slope, bend


def _weights(pairs: int, width: int, sums: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Newton steps to the weights, from the ``sums`` over all pairs at any weights."""
    weights = np.zeros(width)
    for _ in range(30):
        slope, bend = sums(weights)
        step = np.linalg.solve(bend / pairs + DECAY * np.eye(width), slope / pairs - DECAY * weights)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _scale(spread: np.ndarray) -> np.ndarray:
    return np.where(spread > 1e-12, spread, 1.0)


def _undecided(width: int) -> Ranker:
    """Every score is 0.5."""
    return Ranker(np.zeros(width), np.ones(width), np.zeros(width), float(np.log(ACCEPT / (1 - ACCEPT))))


def fit(values: np.ndarray, good: np.ndarray) -> Ranker:
    """The ranker of one block of documents; without both classes every score is 0.5."""
    width, poor = len(FEATURES), int((~good).sum())
    if not poor or poor == len(good):
        return _undecided(width)
    mean, scale = values.mean(axis=0), _scale(values.std(axis=0))
    x = (values - mean) / scale
    winners, losers = x[good], x[~good]
    weights = _weights(len(winners) * poor, width, lambda at: _pair_sums(winners, losers, at))
    ordered = np.sort(x @ weights)
    return Ranker(mean, scale, weights, float((ordered[poor - 1] + ordered[poor]) / 2))


def fold(df: DataFrame) -> DataFrame:
    """Add ``held_out``: whether crc32 of the doc_id as text has the held-out remainder.

    A null doc_id is not held out.
    """
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    return df.withColumn("held_out", F.coalesce(remainder == HELD_OUT, F.lit(False)))


def described(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``features`` of the whole text of every row, stored."""

    def rule(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [features(text) for text in batch.column(1).to_pylist()]
        columns = [batch.column(0), pa.array(found, pa.list_(pa.float64()))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "features"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(map_slices(rows, rule, "doc_id long, features array<double>"), "described")


def learned(found: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``quality`` and ``features`` of every labelled document outside the held-out fold, stored.

    Null labels and ids are left out; a doc_id with several labels counts with the largest. One row per
    id, also where documents repeat it.
    """
    known = fold(labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int")))
    known = known.where("not held_out and quality in (0, 1) and doc_id is not null")
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    each = found.join(known, "doc_id").groupBy("doc_id", "quality").agg(F.min("features").alias("features"))
    return written(each, "learned")


def _matrix(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.float64).reshape(-1, len(FEATURES))


def dealt(rows: DataFrame, total: int, poor: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``block``, ``good`` and ``poor``: the features of a block's documents by class, in the order of their ids.

    Documents of the smaller class may be in several blocks; ``own`` holds the features of those of
    either class that are in their first.
    """
    blocks = -(-total // block_rows)
    smaller = min(poor, total - poor)
    copies = min(blocks, -(-LEAST_OPPONENTS * blocks // smaller))
    is_smaller = F.col("quality") == (0 if poor == smaller else 1)
    turns = F.sequence(F.lit(0), F.when(is_smaller, copies - 1).otherwise(0))
    home = F.pmod(F.xxhash64("doc_id"), F.lit(blocks))
    placed = rows.withColumn("turn", F.explode(turns)).withColumn("block", F.pmod(home + F.col("turn"), F.lit(blocks)))

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by("doc_id")
        values = group["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        values = values.reshape(-1, len(FEATURES))
        is_good, first = group["quality"].to_numpy() == 1, group["turn"].to_numpy() == 0
        cells = [values[is_good].tobytes(), values[~is_good].tobytes(), values[first].tobytes()]
        return pa.table([group["block"][:1], *([cell] for cell in cells)], ["block", "good", "poor", "own"])

    packed = placed.groupBy("block").applyInArrow(pack, "block long, good binary, poor binary, own binary")
    return written(packed, "blocks")


def _block_sums(blocks: DataFrame, rule: Callable[[dict], np.ndarray]) -> np.ndarray:
    """``rule`` of every block, added up in the order of the blocks, so that reruns agree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                columns = [pa.array([row["block"]], pa.int64()), pa.array([rule(row).tolist()], pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, ["block", "sums"])

    rows = blocks.mapInArrow(run, "block long, sums array<double>").collect()
    return np.sum([row["sums"] for row in sorted(rows, key=lambda row: row["block"])], axis=0)


def _ranked(scores: DataFrame, ranks: list[int]) -> list[float]:
    """The values of ``raw`` at some ranks, from 0, by a range-partitioned sort of the distinct ones."""
    counts = scores.groupBy("raw").agg(F.count("*").alias("n"))
    ranged = counts.repartitionByRange(shuffle_partitions(scores.sparkSession), "raw")
    ranged = written(ranged.withColumn("part", F.spark_partition_id()), "ranged")
    # One row per partition, so the running total is tiny whatever the data.
    sizes = ranged.groupBy("part").agg(F.sum("n").alias("size"))
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    within = F.sum("n").over(Window.partitionBy("part").orderBy("raw"))
    upto = ranged.withColumn("within", within).join(F.broadcast(before), "part")
    upto = upto.select("raw", (F.col("before") + F.col("within")).alias("upto"))
    beyond = lambda rank: F.min(F.when(F.col("upto") > rank, F.col("raw")))
    return list(upto.agg(*map(beyond, ranks)).first())


def ranker_of(found: DataFrame, labels: DataFrame, block_rows: int = BLOCK_ROWS) -> Ranker:
    """Fit on all labelled documents of ``found``, a table of ``described`` ones."""
    width = len(FEATURES)
    rows = learned(found, labels)
    total, poor = rows.agg(F.count("*"), F.count_if(F.col("quality") == 0)).first()
    if not poor or poor == total:
        return _undecided(width)
    blocks = dealt(rows, total, poor, block_rows)
    mean = _block_sums(blocks, lambda row: _matrix(row["own"]).sum(axis=0)) / total
    scale = _scale(np.sqrt(_block_sums(blocks, lambda row: ((_matrix(row["own"]) - mean) ** 2).sum(axis=0)) / total))

    def sums(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def of_block(row: dict) -> np.ndarray:
            winners, losers = ((_matrix(row[side]) - mean) / scale for side in ("good", "poor"))
            slope, bend = _pair_sums(winners, losers, weights)
            return np.concatenate([slope, bend.ravel()])

        found = _block_sums(blocks, of_block)
        return found[:width], found[width:].reshape(width, width)

    pairs = _block_sums(blocks, lambda row: np.array([len(_matrix(row["good"])) * len(_matrix(row["poor"]))], float))
    ranker = Ranker(mean, scale, _weights(int(pairs[0]), width, sums), 0.0)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(ranker.raw(_matrix(own.as_py())))], ["raw"])

    low, high = _ranked(blocks.select("own").mapInArrow(raw, "raw double"), [poor - 1, poor])
    return Ranker(mean, scale, ranker.weights, (low + high) / 2)


def train(docs: DataFrame, labels: DataFrame) -> Ranker:
    """Fit on every labelled document outside the held-out fold."""
    return ranker_of(described(docs), labels)


def score(found: DataFrame, ranker: Ranker) -> DataFrame:
    """``doc_id`` and ``score`` of every row of a table of ``described`` documents."""

    def rule(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
        columns = [batch.column(0), pa.array(ranker.score(values), pa.float64())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "score"])

    return map_slices(found.select("doc_id", "features"), rule, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` (1 from ACCEPT on) for every row.

    Null and empty texts have features of their own and are scored like others; repeated rows stay
    repeated; other columns are not looked at. An empty table gives no rows, and without labels of
    both classes every score is 0.5.
    """
    found = described(docs)
    return fold(score(found, ranker_of(found, labels))).select(
        "doc_id",
        "held_out",
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their columns.

    A text goes to Python once to fit, and once more for a number that comes back; no other column
    leaves the JVM.
    """
    ranker = train(docs, labels)

    @F.arrow_udf("double")
    def score_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = []
            for at in range(0, len(batch), SLICE_ROWS):
                values = np.array([features(text) for text in batch.slice(at, SLICE_ROWS).to_pylist()])
                parts.append(ranker.score(values.reshape(-1, len(FEATURES))))
            yield pa.array(np.concatenate([*parts, np.zeros(0)]), pa.float64())
            pa.default_memory_pool().release_unused()

    return docs.where(score_of(F.col("text").cast("string")) >= ACCEPT)
