import random
import zlib

import numpy as np
import pytest

from scrubline.llm import quality

SF = "/root/testdata/sf0.01"


def tables(spark, folder=SF):
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def test_held_out_accuracy(spark):
    docs, labels = tables(spark, "/root/testdata/sf0.1")
    found = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    good, poor = found[found.quality == 1].score, found[found.quality == 0].score
    assert len(poor) > 100
    auc = np.mean([(good > s).mean() + (good == s).mean() / 2 for s in poor])
    assert auc > 0.99
    assert (good < 0.3).mean() < 0.01 and (poor >= 0.3).mean() < 0.05
    assert (found.predicted == (found.score >= 0.3)).all()


def test_held_out_labels_are_not_learned(spark):
    docs, labels = tables(spark)
    one = quality.train(docs, labels)
    flipped = quality.fold(labels).selectExpr("doc_id", "if(held_out, 1 - quality, quality) as quality")
    other = quality.train(docs, flipped)
    assert np.array_equal(one.weights, other.weights) and one.cut == other.cut


def test_folds(spark):
    ids = [*range(50), -7, 10**15]
    found = quality.fold(spark.createDataFrame([(i,) for i in ids], "doc_id long")).collect()
    assert {r.doc_id: r.held_out for r in found} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in ids}


def test_every_document_is_scored_by_its_whole_text(spark):
    docs, labels = tables(spark)
    ranker = quality.train(docs, labels)
    found = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert len(found) == docs.count()
    for row in docs.collect():
        want = float(ranker.score(np.array([quality.features(row.text)]))[0])
        assert found[row.doc_id].score == pytest.approx(want, abs=1e-12)


def test_pairs_order_what_the_labels_say():
    dice = random.Random(0)
    good = ["The cat sat on the mat. " * dice.randint(1, 20) for _ in range(40)]
    poor = ["".join(dice.choice("#$%&|!") for _ in range(dice.randint(5, 400))) for _ in range(10)]
    values = np.array([quality.features(t) for t in good + poor])
    ranker = quality.fit(values, np.array([True] * 40 + [False] * 10))
    scores = ranker.score(values)
    assert (scores[:40] >= 0.3).all() and (scores[40:] < 0.3).all()


def test_one_class_accepts_everything():
    values = np.array([quality.features(t) for t in ("a", "b c")])
    for label in (True, False):
        assert (quality.fit(values, np.array([label] * 2)).score(values) == 0.5).all()
    assert len(quality.fit(np.zeros((0, len(quality.FEATURES))), np.zeros(0, bool)).weights) > 0


def test_filter_keeps_columns_and_good_rows(spark):
    docs, labels = tables(spark)
    kept = quality.keep_good(docs, labels)
    wanted = quality.classify(docs, labels).where("predicted = 1")
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in wanted.collect()}


def test_every_labelled_document_is_learned_from(spark):
    # More documents than a bounded sample held, in several blocks; of few poor ones each is in all of them.
    docs = spark.range(25_000).selectExpr(
        "id as doc_id",
        "if(id % 400 = 1, repeat('#$ %& ', cast(id % 7 + 1 as int)), repeat('The cat sat. ', cast(id % 50 + 1 as int))) as text",
    )
    labels = docs.selectExpr("doc_id", "if(doc_id % 400 = 1, 0, 1) as quality", "0 as toxic")
    wanted = quality.fold(labels).where("not held_out")
    total, poor = wanted.count(), wanted.where("quality = 0").count()
    found = quality.described(docs)
    rows = quality.learned(found, labels)
    assert rows.count() == total > 19_000
    blocks = quality.dealt(rows, total, poor).collect()
    cell = 8 * len(quality.FEATURES)
    assert len(blocks) == 5 and sum(len(b.own) for b in blocks) == total * cell
    assert sum(len(b.good) for b in blocks) == (total - poor) * cell
    assert all(len(b.poor) == poor * cell for b in blocks)
    ranker = quality.ranker_of(found, labels)
    values = np.array([r.features for r in rows.collect()])
    assert np.allclose(ranker.mean, values.mean(axis=0))
    # Each block holds all pairs of its good documents, so the weights are those of all pairs.
    whole = quality.fit(values, np.array([r.quality == 1 for r in rows.collect()]))
    assert np.allclose(ranker.weights, whole.weights, atol=1e-6) and ranker.cut == pytest.approx(whole.cut, abs=1e-6)
