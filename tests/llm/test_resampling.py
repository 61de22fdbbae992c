import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from scrubline.llm import resampling

DOCS = "doc_id long, text string"


def features(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def plain(docs, target):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    s_all, t_all = s.total() + 10000, t.total() + 10000
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all)))
    rows = []
    for doc_id, text in docs:
        words, found = features(text)
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, len(words)])
    eligible = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for at, row in enumerate(eligible[: 25 * len(eligible) // 100]):
        row[4] = at + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def same(spark, rows, target):
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    other = spark.createDataFrame([(t,) for t in target], "text string")
    found = sorted((tuple(r) for r in resampling.resampled(docs, other).collect()), key=str)
    assert found == plain(rows, target)
    return found


def texts(dice, n, longest):
    words = ["alpha", "Beta", "gamma9", "日本", "é", "x_y", "\U0001f600"] + [f"w{i}" for i in range(60)]
    return [dice.choice([" ", ", ", "\n", "\x00"]).join(dice.choices(words, k=dice.randint(0, longest))) for _ in range(n)]


def test_equals_brute_force(spark):
    dice = random.Random(2)
    rows = list(enumerate(texts(dice, 300, 60))) + [(400, None), (401, ""), (None, "a b " * 30), (None, None)]
    found = same(spark, rows, texts(dice, 20, 40) + [None, ""])
    assert sum(r[4] is not None for r in found) > 40


def test_repeated_rows_are_drawn_each_for_itself(spark):
    text = " ".join(f"w{i}" for i in range(25))
    found = same(spark, [(1, text)] * 30 + [(2, "v " * 25)] * 10 + [(None, text)] * 3, ["w1 w2 w3"])
    assert sorted(r[4] for r in found if r[4]) == list(range(1, 11))


def test_without_target_or_documents(spark):
    same(spark, list(enumerate(texts(random.Random(4), 50, 60))), [])
    same(spark, [], ["a b c"])
    same(spark, [(1, "too few words")], ["a b c"])


@pytest.mark.parametrize("width", [0, 1, 100, 20_000])
def test_the_cutoff_is_exact_whatever_the_bracket(spark, width):
    dice = random.Random(width)
    rows = [(dice.randint(0, 50) or None, int(dice.gauss(0, 3))) for _ in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, score long").repartition(4)
    order = sorted(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0))
    for wanted in (1, 2, 500, 1999, 2000):
        doc_id, score = order[wanted - 1]
        assert resampling.cutoff(df, wanted, 2000, width) == (score, doc_id)
    assert resampling.cutoff(df, 0, 2000) is None


def test_a_bad_sketch_is_found_out(spark, monkeypatch):
    """With a sketch of two ranks the first bracket misses, and exact counts widen it."""
    monkeypatch.setattr(resampling, "SKETCH_ACCURACY", 2)
    rows = [(i, (i * 7919) % 5003) for i in range(5000)]
    df = spark.createDataFrame(rows, "doc_id long, score long").repartition(4)
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    for wanted in (10, 1250, 4000):
        assert resampling.cutoff(df, wanted, 5000, 0.01) == order[wanted - 1][::-1]


def test_long_texts_are_read_in_blocks(monkeypatch):
    text = "The quick-brown fox; jumps over 9 Lazy dogs. " * 500
    whole = sorted(features(text)[1])
    for block in (1, 7, 1000):
        monkeypatch.setattr(resampling, "_BLOCK", block)
        parts = list(resampling.feature_buckets(text))
        assert sorted(int(b) for _, buckets in parts for b in buckets) == whole and len(parts) > 1
        assert sum(n for n, _ in parts) == 9 * 500


def test_draw_returns_whole_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    ids = {r.doc_id for r in resampling.resampled(docs, target).where("rank is not null").collect()}
    found = resampling.draw(docs, target)
    assert found.columns == docs.columns and {r.doc_id for r in found.collect()} == ids and ids
