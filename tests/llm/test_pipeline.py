"""The whole pipeline against plain versions of its four stages."""

import struct

import numpy as np
import xxhash

import corpus_pipeline
from scrubline.llm import mixing, pieces, quality
from tests.llm.test_mixing import plain_targets, words
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def dice(doc_id, text):
    """Spark's 64-bit hash of an id and a text: the hash of the first seeds that of the second."""
    seed = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), 42)
    hashed = xxhash.xxh64_intdigest(text.encode(), seed)
    return hashed - (1 << 64) if hashed >= 1 << 63 else hashed


def time_of(share, schedule):
    """Bisection on the integral of the schedule."""

    def reached(time):
        done = 0.0
        for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
            end = min(max(time, t0), t1)
            done += (end - t0) * (w0 + w0 + (w1 - w0) * (end - t0) / (t1 - t0)) / 2
        return done

    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if reached(middle) < share * reached(1.0) else (low, middle)
    return low


def plain_mix(docs):
    """(position, doc_id) of every document that the mix takes, as often as it does."""
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + words(text)
    target = plain_targets(sizes)
    taken = []
    for turn, source in enumerate(sorted(sizes)):
        ordered = sorted((dice(i, t), i, words(t)) for i, t, s in docs if s == source)
        # Halves away from zero, as Spark rounds.
        whole = int(target[source] + 0.5)
        before = 0
        for _, doc_id, size in ordered:
            for number in range(3):
                start = before + number * sizes[source]
                part = max(0, min(whole - start, size))
                if part and 2 * part >= size:
                    taken.append((time_of(start / whole, mixing.SCHEDULES[turn % 3]), doc_id))
            before += size
    return sorted(taken)


def test_run_is_what_plain_stages_give(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    ranker = quality.train(
        spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    )
    scores = ranker.score(np.array([quality.features(text) for _, text, _ in docs]))
    docs = [d for d, score in zip(docs, scores, strict=True) if score >= 0.3]
    prints = {i: plain_fingerprint(text) for i, text, _ in docs}
    ids = sorted(prints)
    linked = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    top = plain_components(ids, linked)
    docs = [d for d in docs if top[d[0]] == d[0]]
    mixed = plain_mix(docs)
    text = {i: t for i, t, _ in docs}
    codec = pieces.Codec(pieces.load())
    want = sorted((i, np.frombuffer(codec.encode(text[i]), "<i4").tolist()) for _, i in mixed)

    found = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.ids) for r in found) == want
    assert all(r.round_trip for r in found)


def test_mixing_stage_sorts_by_position(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain_mix([(r.doc_id, r.text, r.source) for r in docs.collect()])
    found = [r.doc_id for r in corpus_pipeline.mixing_stage(spark, docs, SF).select("doc_id").collect()]
    assert found == [i for _, i in want]


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "mixing", "pieces"]
    assert corpus_pipeline.ORACLE_SQL is None
