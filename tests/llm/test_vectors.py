import itertools

import numpy as np
import pytest

from scrubline.llm import near_vectors, topk
from scrubline.llm.vectors import centres, packed, squared_distances
from tests.llm.test_simhash import plain_components


def clustered(dice, groups, members, width, noise):
    middle = dice.normal(size=(groups, width))
    rows = np.repeat(middle, members, axis=0) + noise * dice.normal(size=(groups * members, width))
    return (rows / np.linalg.norm(rows, axis=1)[:, None]).astype(np.float32)


def frame_of(spark, rows, labels=None):
    labels = labels if labels is not None else [0] * len(rows)
    cells = [(i, [float(x) for x in row], int(l)) for i, (row, l) in enumerate(zip(rows, labels, strict=True))]
    return spark.createDataFrame(cells, "vec_id long, embedding array<float>, label int")


def plain_top_k(rows, ids, queries, k):
    whole = np.floor(256 * rows.astype(float)).astype(np.int64)
    found = set()
    for q in queries:
        scores = sorted((-int(whole[i] @ whole[q]), ids[i]) for i in range(len(ids)) if ids[i] != ids[q])
        found |= {(ids[q], rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)}
    return found


@pytest.mark.parametrize("k", [1, 5])
@pytest.mark.parametrize("noise", [0.02, 0.6])
def test_top_k_is_that_of_brute_force(spark, noise, k, monkeypatch):
    # Small rings and blocks, so that many are met and many are left out.
    monkeypatch.setattr(topk, "RING_ROWS", 32)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    rows = clustered(np.random.default_rng(1), 25, 40, 12, noise)
    rows[500:520] = rows[0]
    rows[700] *= 30
    vectors = frame_of(spark, rows)
    found = topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k).collect()
    want = plain_top_k(rows, list(range(1000)), range(0, 1000, 50), k)
    assert len(found) == len(want)
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in found} == want


def test_triangle_inequality_leaves_rings_out(spark, monkeypatch):
    monkeypatch.setattr(topk, "RING_ROWS", 32)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    met = []
    searched = topk._searched

    def counting(meetings, *args):
        met.append(meetings.count())
        return searched(meetings, *args)

    monkeypatch.setattr(topk, "_searched", counting)
    rows = clustered(np.random.default_rng(1), 25, 40, 12, 0.02)
    vectors = frame_of(spark, rows)
    topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 3).collect()
    rings, blocks = 1000 / 32, 20 / 4
    assert met[1] < rings * blocks / 2


def test_fewer_candidates_than_asked(spark):
    vectors = frame_of(spark, np.eye(3, dtype=np.float32))
    found = topk.top_k(vectors, vectors, 5).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == [
        (0, 1, 1, 0), (0, 2, 2, 0), (1, 1, 0, 0), (1, 2, 2, 0), (2, 1, 0, 0), (2, 2, 1, 0)
    ]


def plain_links(rows, labels, cosine):
    unit = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1)[:, None]
    near = unit @ unit.T >= cosine
    return [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if near[a, b] and labels[a] == labels[b]]


@pytest.mark.parametrize("noise", [0.03, 0.08])
def test_near_vectors_are_those_of_brute_force(spark, noise, monkeypatch):
    monkeypatch.setattr(near_vectors, "ROWS_PER_LIST", 20)
    monkeypatch.setattr(near_vectors, "STORED_ROWS", 16)
    monkeypatch.setattr(near_vectors, "QUERY_ROWS", 8)
    dice = np.random.default_rng(2)
    rows = clustered(dice, 40, 12, 16, noise)
    rows = np.vstack([rows, rows[:30], 3 * rows[30:40], dice.normal(size=(100, 16)).astype(np.float32)])
    labels = dice.integers(0, 2, len(rows))
    linked = plain_links(rows, labels, 0.98)
    assert len(linked) > 100
    top = plain_components(range(len(rows)), linked)
    degree = np.bincount(np.array(linked).ravel(), minlength=len(rows))
    found = near_vectors.near_duplicates(frame_of(spark, rows, labels)).collect()
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in found} == {
        (i, int(degree[i]), top[i], top[i] == i) for i in range(len(rows))
    }


def test_double_vectors(spark):
    rows = [(1, [1.0, 1e-9], 1), (2, [1.0, 2e-9], 1), (3, [0.0, 1.0], 1)]
    found = near_vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert {(r.vec_id, r.n_links, r.component_id) for r in found.collect()} == {(1, 1, 1), (2, 1, 1), (3, 0, 3)}


def test_codes_miss_no_more_than_they_say():
    dice = np.random.default_rng(0)
    rows = near_vectors.units(dice.normal(size=(300, 10)))
    quantiser = near_vectors.fit(rows[:100], 10, 4)
    own, probed = quantiser.near(rows, 0.2)
    assert probed[np.arange(300), own].all()
    residuals = rows - quantiser.lists[own]
    codes = quantiser.codes(residuals)
    coded = rows - residuals + np.column_stack([w[codes[:, i]] for i, w in enumerate(quantiser.codewords)])
    assert np.allclose(np.linalg.norm(rows - coded, axis=1), quantiser.missed(residuals, codes))
    around = quantiser.lists[0]
    table = quantiser.table_distances(rows[:5] - around, codes)
    rebuilt = around + np.column_stack([w[codes[:, i]] for i, w in enumerate(quantiser.codewords)])
    assert np.allclose(table, squared_distances(rows[:5], rebuilt), atol=1e-9)


def test_blocks_hold_every_row_once_in_order(spark):
    rows = [(i % 3, i) for i in range(1000)]
    blocks = packed(spark.createDataFrame(rows, "k int, n long"), ["k"], ["n"], 50).collect()
    assert len({b.block for b in blocks}) == len(blocks)
    assert all(0 < len(b.n) <= 50 and b.n == sorted(b.n) for b in blocks)
    assert sorted((b.k, n) for b in blocks for n in b.n) == sorted(rows)


def test_centres():
    assert len(centres(np.zeros((0, 4)), 3)) == 0
    rows = np.vstack([np.zeros((10, 2)), np.ones((10, 2))])
    assert len(centres(rows, 50)) == 20
