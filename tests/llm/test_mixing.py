import re

import pytest
from pyspark.sql import functions as F

from scrubline.llm import mixing
from scrubline.llm.ordering import running_totals

SF = "/root/testdata/sf0.01"


def plain_targets(sizes, weights=(5, 2, 1)):
    """Reshare what is above the caps until nothing is."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be"))
    order += [None] if None in sizes else []
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    left, fixed = float(sum(sizes.values())), set()
    while True:
        open_weight = sum(w for s, w in weight.items() if s not in fixed)
        rest = left - sum(target[s] for s in fixed)
        for s in order:
            if s not in fixed:
                target[s] = rest * weight[s] / open_weight
        above = {s for s in order if s not in fixed and target[s] > 3 * sizes[s]}
        if not above:
            return target
        for s in above:
            target[s] = 3.0 * sizes[s]
        fixed |= above


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_and_words_taken(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn(
        "source", F.when(F.col("source") != "src7", F.col("source"))
    )
    texts = {r.doc_id: r for r in docs.collect()}
    sizes = {}
    for r in texts.values():
        sizes[r.source] = sizes.get(r.source, 0) + words(r.text)
    want = plain_targets(sizes)
    found = mixing.mix(docs).collect()
    assert len(found) == len(texts)
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        source = texts[r.doc_id].source
        assert r["size"] == words(texts[r.doc_id].text) and r.source_size == sizes[source]
        assert r.target == pytest.approx(want[source]) and 0 <= r.taken <= 3 * r["size"]
        taken[source] += r.taken
    assert all(taken[s] == pytest.approx(want[s], abs=0.51) for s in sizes)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    assert found == mixing.mix(docs.repartition(5)).collect()
    positions = [r.position for r in found if r.position is not None]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1


def test_caps_are_reshared(spark):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate([(1, "a"), (50, "b"), (60, "c"), (2, "d"), (100, None)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = plain_targets({"a": 1, "b": 50, "c": 60, "d": 2, None: 100})
    found = {r.doc_id: r.target for r in mixing.mix(docs).collect()}
    assert [found[i] for i in range(5)] == pytest.approx([want[s] for s in ("a", "b", "c", "d", None)])
    assert found[0] == 3.0 and found[3] == 6.0


@pytest.mark.parametrize("schedule", mixing.SCHEDULES)
def test_positions_invert_the_integrated_schedule(spark, schedule):
    def reached(time):
        done = 0.0
        for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
            end = min(time, t1)
            if end > t0:
                here = w0 + (w1 - w0) * (end - t0) / (t1 - t0)
                done += (end - t0) * (w0 + here) / 2
        return done

    shares = spark.range(101).select((F.col("id") / 100).alias("share"))
    found = shares.select("share", mixing._time_of(F.col("share"), schedule).alias("time")).collect()
    for r in found:
        assert reached(r.time) == pytest.approx(r.share * reached(1.0), abs=1e-9)


def test_mixed_documents_repeat_what_is_taken(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = mixing.plan(docs).collect()
    times = {
        r.doc_id: sum(r[f"words_{t}"] > 0 and 2 * r[f"words_{t}"] >= r["size"] for t in range(3)) for r in plan
    }
    found = mixing.mixed_documents(docs)
    assert found.columns == docs.columns
    got = {r.doc_id: r["count"] for r in found.groupBy("doc_id").count().collect()}
    assert got == {i: n for i, n in times.items() if n}
    text = {r.doc_id: r.text for r in docs.collect()}
    assert all(text[r.doc_id] == r.text for r in found.collect())


def test_running_totals(spark):
    rows = [(i * 37 % 100, i % 3, i) for i in range(100)]
    df = spark.createDataFrame(rows, "at long, g int, n long")
    want = {}
    for at, g, _ in rows:
        want[at] = (sum(m for a, h, m in rows if h == g and a < at), sum(m for a, _, m in rows if a < at))
    grouped = {r.at: r.before_n for r in running_totals(df, ["at"], ["n"], ["g"]).collect()}
    whole = {r.at: r.before_n for r in running_totals(df, ["at"], ["n"]).collect()}
    assert {a: (grouped[a], whole[a]) for a in grouped} == want
