"""Exact top-k by inner product over a pivot-distance index.

The largest inner products are the smallest distances once every stored vector gets one more
component that gives all of them the same length. Vectors are keyed by their nearest pivot and the
distance to it, sorted, and cut into rings (blocks of consecutive distances). A query first looks
into the ring at its own distance, which bounds the distance of its k-th neighbour; the annulus of
every pivot that this bound leaves, by the triangle inequality, is then searched ring by ring.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scrubline.llm.sampling import smallest_hashes
from scrubline.llm.tables import map_slices
from scrubline.llm.vectors import centres, matrix, packed, rows_of, squared_distances, usable
from scrubline.workspace import written

# Pivots are centres of a sample: the vectors with the smallest hash.
PIVOTS = 32
SAMPLE_ROWS = 2048
RING_ROWS = 2048
QUERY_ROWS = 256
SCALE = 256
# Bounds are widened by this share of the longest vector against rounding.
SLACK = 1e-7


def scaled(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``v`` (floor(SCALE * component) as doubles) of the usable vectors."""
    known = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    components = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    return known.select(F.col("vec_id").cast("long"), components.alias("v"))


def _keyed(rows: DataFrame, pivots: np.ndarray, width: int, longest: float, stored: bool) -> DataFrame:
    """``pivot`` (the nearest), ``far`` (the distance to it) and the vector as bytes.

    Stored vectors are lengthened to ``longest`` by a last component; queries have zero there.
    """

    def rule(batch: pa.RecordBatch) -> pa.RecordBatch:
        plain = matrix(rows_of(batch.column(1)), width)
        last = np.sqrt(np.maximum(longest - (plain * plain).sum(axis=1), 0)) * stored
        far = np.sqrt(squared_distances(np.column_stack([plain, last]), pivots))
        nearest = far.argmin(axis=1)
        columns = [
            batch.column(0),
            pa.array(nearest.astype(np.int32)),
            pa.array(far[np.arange(len(far)), nearest]),
            pa.array([row.astype("<f8").tobytes() for row in plain], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["vec_id", "pivot", "far", "v"])

    return map_slices(rows, rule, "vec_id long, pivot int, far double, v binary")


def _unpacked(column: pa.Array, i: int, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column[i].as_py()), "<f8").reshape(-1, width)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        found = np.flatnonzero(scores >= least)
    else:
        found = np.arange(len(scores))
    return found[np.lexsort((ids[found], -scores[found]))][:k]


def _searched(meetings: DataFrame, width: int, longest: float, k: int) -> DataFrame:
    """Best rows of each meeting of a query block and a ring: ``query_id``, ``vec_id``, ``score``.

    ``least`` of a query is the score of its k-th neighbour so far; a ring all of whose distances
    the triangle inequality puts beyond that is not scored for the query.
    """

    def rule(batch: pa.RecordBatch) -> pa.RecordBatch:
        named = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
        out = [[], [], []]
        for i in range(batch.num_rows):
            q_ids = np.array(named["q_ids"][i].as_py(), np.int64)
            ids = np.array(named["ids"][i].as_py(), np.int64)
            least = np.array(named["least"][i].as_py(), float)
            queries = _unpacked(named["q_v"], i, width)
            reach = np.sqrt(np.maximum((queries * queries).sum(axis=1) + longest - 2 * least, 0))
            pivot = np.array(named["pivot_v"][i].as_py(), float)
            lengthened = np.column_stack([queries, np.zeros(len(queries))])
            far = np.sqrt(squared_distances(lengthened, pivot[None, :]))[:, 0]
            slack = SLACK * (1 + np.sqrt(longest))
            low, high = named["low"][i].as_py(), named["high"][i].as_py()
            open_to = np.flatnonzero((far - reach - slack <= high) & (far + reach + slack >= low))
            scores = queries[open_to] @ _unpacked(named["v"], i, width).T
            for row, at in enumerate(open_to.tolist()):
                good = np.flatnonzero((scores[row] >= least[at]) & (ids != q_ids[at]))
                good = good[_best(scores[row][good], ids[good], k)]
                out[0].append(np.full(len(good), q_ids[at]))
                out[1].append(ids[good])
                out[2].append(scores[row][good].astype(np.int64))
        columns = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in out]
        return pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    rows = meetings.select("q_ids", "q_v", "least", "ids", "v", "low", "high", "pivot_v")
    return map_slices(rows, rule, "query_id long, vec_id long, score long", 8)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id``, ``rank`` (int, from 1), ``vec_id``, ``score``: the ``k`` best of every query.

    ``vectors`` and ``queries`` have ``vec_id`` and ``embedding``. The score is the inner product of
    the vectors scaled to whole numbers, exact while sums stay below 2**53; ties go to the smaller
    ``vec_id``. Rows with the query's own id do not count. A query with fewer candidates has all of
    them; one without has no rows. Null vectors, vectors with null or non-finite components and null
    ids take no part. Shorter vectors count as filled up with zeros. A repeated stored row stays a
    candidate each time; a repeated query id is asked once, with its smallest vector.
    """
    spark = vectors.sparkSession
    stored = written(scaled(vectors), "stored")
    asked = scaled(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    facts = stored.agg(F.max(squares), F.max(F.size("v")), F.count("*")).first()
    longest, width = float(facts[0] or 0.0), max(1, facts[1] or 1)
    sample = smallest_hashes(stored, ["vec_id", "v"], SAMPLE_ROWS, facts[2]).collect()
    plain = matrix([np.array(r["v"]) for r in sample], width)
    last = np.sqrt(np.maximum(longest - (plain * plain).sum(axis=1), 0))
    pivots = centres(np.column_stack([plain, last]), PIVOTS)
    if not len(pivots):
        pivots = np.zeros((1, width + 1))
    pivot_rows = spark.createDataFrame(
        [(i, p.tolist()) for i, p in enumerate(pivots)], "pivot int, pivot_v array<double>"
    )

    rings = packed(_keyed(stored, pivots, width, longest, True), ["pivot"], ["far", "vec_id"], RING_ROWS)
    rings = written(
        rings.select(
            F.col("block").alias("ring"),
            "pivot",
            F.col("vec_id").alias("ids"),
            "v",
            F.array_min("far").alias("low"),
            F.array_max("far").alias("high"),
        ),
        "rings",
    )
    wide = asked.select("vec_id", F.slice("v", 1, width).alias("v"))
    blocks = packed(_keyed(wide, pivots, width, longest, False), ["pivot"], ["far", "vec_id"], QUERY_ROWS)
    blocks = written(
        blocks.select(
            "block",
            "pivot",
            F.col("vec_id").alias("q_ids"),
            F.col("v").alias("q_v"),
            F.array_min("far").alias("q_low"),
            F.array_max("far").alias("q_high"),
        ),
        "blocks",
    )

    # The ring nearest to a block's own distances gives each of its queries a first k-th score.
    gap = F.greatest(F.col("low") - F.col("q_high"), F.col("q_low") - F.col("high"), F.lit(0.0))
    nearby = blocks.select("block", "pivot", "q_low", "q_high").join(
        rings.select("ring", "pivot", "low", "high"), "pivot"
    )
    nearest = F.struct(gap, F.col("high") - F.col("low"), "ring")
    home = nearby.groupBy("block").agg(F.min_by("ring", nearest).alias("ring"))
    open_blocks = blocks.drop("pivot").withColumn(
        "least", F.transform("q_ids", lambda _: F.lit(float("-inf")))
    )
    with_pivots = rings.join(F.broadcast(pivot_rows), "pivot")
    first = _searched(
        home.join(open_blocks, "block").join(with_pivots, "ring"), width, longest, k
    )
    kth = first.groupBy("query_id").agg(
        F.when(F.count("*") >= k, F.min("score").cast("double")).alias("least")
    )
    none_yet = F.coalesce("least", F.lit(float("-inf"))).alias("least")
    known = (
        blocks.select("block", F.posexplode("q_ids").alias("at", "query_id"))
        .join(kth, "query_id", "left")
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("at", none_yet))).alias("each"))
        .select("block", F.col("each.least").alias("least"))
    )
    bounded = written(blocks.drop("pivot").join(known, "block"), "bounded")
    reaches = _reaches(bounded, pivots, width, longest)
    meets = (F.col("near") <= F.col("high")) & (F.col("beyond") >= F.col("low"))
    spans = rings.select("ring", "pivot", "low", "high")
    pairs = reaches.join(spans, "pivot").where(meets).select("block", "ring")
    found = _searched(pairs.join(bounded, "block").join(with_pivots, "ring"), width, longest, k)
    return _ranked(found, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _reaches(bounded: DataFrame, pivots: np.ndarray, width: int, longest: float) -> DataFrame:
    """For each query block and pivot, the distances between which its neighbours can lie."""

    def rule(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [[], [], [], []]
        for i in range(batch.num_rows):
            queries = _unpacked(batch.column(1), i, width)
            least = np.array(batch.column(2)[i].as_py(), float)
            reach = np.sqrt(np.maximum((queries * queries).sum(axis=1) + longest - 2 * least, 0))
            far = np.sqrt(squared_distances(np.column_stack([queries, np.zeros(len(queries))]), pivots))
            slack = SLACK * (1 + np.sqrt(longest))
            out[0].append(np.full(len(pivots), batch.column(0)[i].as_py()))
            out[1].append(np.arange(len(pivots)))
            out[2].append((far - reach[:, None]).min(axis=0) - slack)
            out[3].append((far + reach[:, None]).max(axis=0) + slack)
        kinds = [pa.int64(), pa.int32(), pa.float64(), pa.float64()]
        columns = [
            pa.array(np.concatenate(c) if c else [], kind) for c, kind in zip(out, kinds, strict=True)
        ]
        return pa.RecordBatch.from_arrays(columns, ["block", "pivot", "near", "beyond"])

    rows = bounded.select("block", "q_v", "least")
    return map_slices(rows, rule, "block long, pivot int, near double, beyond double")
