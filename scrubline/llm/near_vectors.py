"""Near-duplicate vectors by product quantisation over coarse inverted lists.

Vectors are turned to unit length, so a cosine of at least ``c`` is a distance of at most
``sqrt(2 - 2c)``. Each vector is stored in the list of its nearest coarse centre with a code of its
residual (one codeword per subspace) and the length of what the code misses. Two partners in the
lists a and b lie on either side of the plane between the centres, so at least one of them is within
half the distance of it. As a query, each vector probes the lists whose plane is that near, and finds
for both what only it finds, so no partner is left out. In a list, distances to the codes come from
a table of query-to-codeword distances; a stored vector whose table distance
exceeds the limit by more than its own code error cannot be a partner, and the others are checked
by exact cosine. Copies of a vector are one class throughout.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from scrubline.llm.components import components
from scrubline.llm.sampling import smallest_hashes
from scrubline.llm.tables import map_slices
from scrubline.llm.vectors import centres, matrix, packed, rows_of, squared_distances, usable
from scrubline.workspace import written

COSINE = 0.98
# Centres and codewords are fitted on the vectors with the smallest hash, this many at most.
SAMPLE_ROWS = 4096
# One list per so many classes of the largest label, within these bounds.
ROWS_PER_LIST, FEWEST_LISTS, MOST_LISTS = 1000, 4, 512
SUBSPACES = 8
CODEWORDS = 64
STORED_ROWS = 1024
QUERY_ROWS = 512
# Pairs whose exact cosine is computed at a time.
PAIR_BLOCK = 1 << 15
# Bounds are widened by this much against rounding.
SLACK = 1e-6


@dataclass(frozen=True)
class Quantiser:
    """Coarse centres and, for each subspace, its columns and codewords."""

    width: int
    lists: np.ndarray
    apart: np.ndarray
    columns: list[np.ndarray]
    codewords: list[np.ndarray]

    def near(self, unit: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray]:
        """The own list of each vector, and which lists it probes: those at most half the limit
        behind the plane to its own, which is one of them.
        """
        squares = squared_distances(unit, self.lists)
        own = squares.argmin(axis=1)
        past = squares - squares[np.arange(len(own)), own][:, None]
        probed = past <= self.apart[own] * (limit + SLACK) + SLACK
        probed[np.arange(len(own)), own] = True
        return own, probed

    def codes(self, residuals: np.ndarray) -> np.ndarray:
        parts = zip(self.columns, self.codewords, strict=True)
        found = [squared_distances(residuals[:, cols], words).argmin(axis=1) for cols, words in parts]
        return np.column_stack(found).astype(np.uint8)

    def missed(self, residuals: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Lengths of what the codes leave of the residuals."""
        left = residuals.copy()
        for i, (cols, words) in enumerate(zip(self.columns, self.codewords, strict=True)):
            left[:, cols] -= words[codes[:, i]]
        return np.sqrt((left * left).sum(axis=1))

    def table_distances(self, residuals: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Squared distances of query residuals to coded vectors by table look-up."""
        total = np.zeros((len(residuals), len(codes)))
        for i, (cols, words) in enumerate(zip(self.columns, self.codewords, strict=True)):
            total += squared_distances(residuals[:, cols], words)[:, codes[:, i]]
        return total


def fit(sample: np.ndarray, width: int, lists: int) -> Quantiser:
    coarse = centres(sample, lists) if len(sample) else np.zeros((1, width))
    columns = [c for c in np.array_split(np.arange(width), min(SUBSPACES, width)) if len(c)]
    rest = sample - coarse[squared_distances(sample, coarse).argmin(axis=1)]
    words = [centres(rest[:, c], CODEWORDS) if len(rest) else np.zeros((1, len(c))) for c in columns]
    return Quantiser(width, coarse, np.sqrt(squared_distances(coarse, coarse)), columns, words)


def units(plain: np.ndarray) -> np.ndarray:
    largest = np.abs(plain).max(axis=1, keepdims=True)
    scaled = plain / np.where(largest > 0, largest, 1)
    return scaled / np.maximum(np.sqrt((scaled * scaled).sum(axis=1, keepdims=True)), 1e-300)


def _coded(classes: DataFrame, quantiser: Quantiser, kind: str) -> DataFrame:
    """Each class with its list, code, code error and its vector as bytes of ``kind``."""

    def rule(batch: pa.RecordBatch) -> pa.RecordBatch:
        plain = matrix(rows_of(batch.column(4)), quantiser.width)
        unit = units(plain)
        nearest = squared_distances(unit, quantiser.lists).argmin(axis=1)
        residuals = unit - quantiser.lists[nearest]
        codes = quantiser.codes(residuals)
        columns = [
            *batch.columns[:4],
            pa.array(nearest.astype(np.int32)),
            pa.array([c.tobytes() for c in codes], pa.binary()),
            pa.array(quantiser.missed(residuals, codes)),
            pa.array([row.astype(kind).tobytes() for row in plain], pa.binary()),
        ]
        names = ["label", "dims", "cid", "copies", "list", "code", "missed", "v"]
        return pa.RecordBatch.from_arrays(columns, names)

    schema = "label long, dims int, cid long, copies long, list int, code binary, missed double, v binary"
    return map_slices(classes.select("label", "dims", "cid", "copies", "embedding"), rule, schema, 4096)


def _units_of(cells: list[bytes], quantiser: Quantiser, kind: str) -> np.ndarray:
    return units(np.frombuffer(b"".join(cells), kind).reshape(-1, quantiser.width).astype(float))


def _probes(coded: DataFrame, quantiser: Quantiser, limit: float, kind: str) -> DataFrame:
    """Each class once for every list that it probes, with its copies."""

    def rule(batch: pa.RecordBatch) -> pa.RecordBatch:
        unit = _units_of(batch.column(4).to_pylist(), quantiser, kind)
        row, lists = np.nonzero(quantiser.near(unit, limit)[1])
        take = pa.array(row)
        columns = [batch.column(i).take(take) for i in range(5)] + [pa.array(lists.astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, ["label", "dims", "cid", "copies", "v", "list"])

    schema = "label long, dims int, cid long, copies long, v binary, list int"
    return map_slices(coded.select("label", "dims", "cid", "copies", "v"), rule, schema, 1024)


def _exact(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, cosine: float) -> np.ndarray:
    """Which of the pairs (i, j) have a cosine of at least ``cosine``."""
    good = np.zeros(len(i), bool)
    for at in range(0, len(i), PAIR_BLOCK):
        piece = slice(at, at + PAIR_BLOCK)
        good[piece] = np.einsum("ij,ij->i", a[i[piece]], b[j[piece]]) >= cosine
    return good


def _smallest_linked(i: np.ndarray, j: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple:
    """For the rows that links (i, j) touch, the smallest id within their linked group."""
    one, two = a.copy(), b.copy()
    while True:
        before = one.sum(), two.sum()
        np.minimum.at(one, i, two[j])
        np.minimum.at(two, j, one[i])
        if before == (one.sum(), two.sum()):
            return one, two


def _linked(meetings: DataFrame, quantiser: Quantiser, cosine: float, limit: float, kind: str) -> DataFrame:
    """What each meeting of a query block and a stored block finds.

    ``a``, ``links`` (copies of other classes linked to class ``a``), ``b`` (the smallest class of
    its linked group in this meeting): at most a row per class of the two blocks, however many
    pairs link. A stored class is credited with the queries that it does not find itself, because
    it does not probe their list.
    """

    def rule(batch: pa.RecordBatch) -> pa.RecordBatch:
        named = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
        out = [[], [], []]
        for at in range(batch.num_rows):
            q_ids, ids, q_copies, copies = (
                np.array(named[c][at].as_py(), np.int64) for c in ("q_cid", "cid", "q_copies", "copies")
            )
            missed = np.array(named["missed"][at].as_py(), float)
            asked, kept = (_units_of(named[c][at].as_py(), quantiser, kind) for c in ("q_v", "v"))
            codes = np.frombuffer(b"".join(named["code"][at].as_py()), np.uint8).reshape(len(ids), -1)
            around = quantiser.lists[named["list"][at].as_py()]
            far = np.sqrt(np.maximum(quantiser.table_distances(asked - around, codes), 0))
            i, j = np.nonzero(far <= limit + missed[None, :] + SLACK)
            other = q_ids[i] != ids[j]
            i, j = i[other], j[other]
            good = _exact(asked, kept, i, j, cosine)
            i, j = i[good], j[good]
            if not len(i):
                continue
            own = quantiser.near(asked, limit)[0]
            unseen = ~quantiser.near(kept, limit)[1][j, own[i]]
            links = np.bincount(i, weights=copies[j], minlength=len(q_ids)).astype(np.int64)
            back = np.bincount(j[unseen], weights=q_copies[i[unseen]], minlength=len(ids)).astype(np.int64)
            one, two = _smallest_linked(i, j, q_ids, ids)
            rows, cols = np.unique(i), np.unique(j)
            out[0] += [q_ids[rows], ids[cols]]
            out[1] += [links[rows], back[cols]]
            out[2] += [one[rows], two[cols]]
        columns = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in out]
        return pa.RecordBatch.from_arrays(columns, ["a", "links", "b"])

    rows = meetings.select("q_cid", "q_copies", "q_v", "cid", "copies", "missed", "code", "v", "list")
    return map_slices(rows, rule, "a long, links long, b long", 8)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row of ``vectors``.

    Vectors of the same label link at a cosine of at least ``cosine`` in double precision. Null and
    zero vectors, those with null or non-finite components, a null label or a null id link with
    nothing: no links, their own id as component. Vectors of different lengths never link. Repeated
    rows are vectors of their own that link with each other; ``kept`` is null for a null id. An
    empty table gives no rows, and other columns are ignored.
    """
    limit = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    label, embedding = F.col("label").cast("long"), F.col("embedding")
    nonzero = F.exists(embedding, lambda x: x != 0)
    takes_part = usable(embedding) & F.coalesce(nonzero, F.lit(False)) & label.isNotNull()
    numbered = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), "embedding")
    sound = numbered.where(takes_part & F.col("vec_id").isNotNull())
    groups = sound.groupBy("label", "embedding").agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("copies")
    )
    dims = F.size("embedding").alias("dims")
    # Written once, so the numbers stay what they are.
    classes = written(groups.select("*", dims, F.monotonically_increasing_id().alias("cid")), "classes")
    facts = classes.agg(F.count("*"), F.max("dims")).first()
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    width = facts[1] or 1
    drawn = smallest_hashes(classes, ["first_id", "embedding"], SAMPLE_ROWS, facts[0])
    rows = [np.array(r["embedding"], float) for r in drawn.select("embedding").collect()]
    sample = units(matrix(rows, width)) if rows else np.zeros((0, width))
    quantiser = fit(sample, width, min(MOST_LISTS, max(FEWEST_LISTS, largest // ROWS_PER_LIST)))

    kind = "<f4" if vectors.schema["embedding"].dataType.elementType == FloatType() else "<f8"
    coded = written(_coded(classes, quantiser, kind), "coded")
    keys = ["label", "dims", "list"]
    stored = packed(coded, keys, ["cid"], STORED_ROWS).drop("block")
    asked = packed(_probes(coded, quantiser, limit, kind), keys, ["cid"], QUERY_ROWS).drop("block")
    asked = asked.withColumnsRenamed({"cid": "q_cid", "copies": "q_copies", "v": "q_v"})
    meetings = written(asked, "asked").join(written(stored, "stored"), keys)
    found = written(_linked(meetings, quantiser, cosine, limit, kind), "found")
    linked = found.groupBy("a").agg(F.sum("links").alias("links"))
    groups = components(found.select("a", "b"))

    named = classes.join(linked, classes["cid"] == linked["a"], "left").join(
        groups, classes["cid"] == groups["node"], "left"
    )
    named = named.select(
        "label", "embedding", "first_id",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "cid").alias("top"),
    )
    smallest = named.groupBy("top").agg(F.min("first_id").alias("component_id"))
    known = written(named.join(smallest, "top").select("label", "embedding", "n_links", "component_id"), "known")
    members = sound.join(known, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = numbered.where(~(takes_part & F.col("vec_id").isNotNull())).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return members.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
