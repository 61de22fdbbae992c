import random

import pytest
from pyspark.sql import functions as F

from scrubline.operators import similarity as s
from scrubline.workspace import written
from tests import brute


def near_names(seed, alphabet, shortest, longest, threshold, bases=30, copies=7):
    """Random texts and edited copies of them, around the threshold."""
    rnd = random.Random(seed)
    names = set()
    for _ in range(bases):
        base = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(shortest, longest)))
        names.add(base)
        for _ in range(copies):
            chars = list(base)
            for _ in range(rnd.randint(0, 2 * len(base) * (100 - threshold) // 100 + 2)):
                at = rnd.randint(0, len(chars))
                if rnd.random() < 0.5 and at < len(chars):
                    chars.pop(at)
                else:
                    chars.insert(at, rnd.choice(alphabet))
            names.add("".join(chars))
    return sorted(names - {""})


def stored(frame, names):
    return written(s.key_features(frame(list(enumerate(names)), "kid long, key string")), "test")


@pytest.mark.parametrize(
    "seed, alphabet, shortest, longest, threshold, positional, hot_rows",
    [
        (1, "ab", 1, 14, 85, 64, 4096),
        (2, "abc ", 4, 40, 85, 64, 5),
        (3, "abcdé", 10, 45, 85, 20, 4096),  # longer keys are probed without positions
        (4, "ab", 30, 90, 85, 64, 9),
        (6, "abcd", 1, 30, 70, 64, 7),
    ],
)
def test_blocked_join_equals_all_pairs(
    frame, seed, alphabet, shortest, longest, threshold, positional, hot_rows
):
    names = near_names(seed, alphabet, shortest, longest, threshold)
    keys = stored(frame, names)
    wanted = {
        (i, j)
        for i in range(len(names))
        for j in range(i + 1, len(names))
        if brute.matches(names[i], names[j], threshold)
    }
    assert len(wanted) > 20
    found = s.similar_keys(keys, threshold, positional, hot_rows).collect()
    assert len(found) == len(wanted)
    assert {(min(r.a, r.b), max(r.a, r.b)) for r in found} == wanted
    for row in found[:50]:
        a, b = names[row.a], names[row.b]
        assert row.score == 200.0 * brute.lcs(a, b) / (len(a) + len(b))

    some = keys.where(F.col("kid") < len(names) // 5)
    between = s.similar_between(some, keys, threshold, positional, hot_rows).collect()
    assert sorted((r.a, r.b) for r in between) == sorted(
        (a, b) for p in wanted for a, b in (p, p[::-1]) if a < len(names) // 5
    )


@pytest.mark.parametrize("threshold", [85, 70, 100])
def test_comparing_few_with_all_equals_the_join(frame, threshold):
    rnd = random.Random(threshold)
    word = lambda: "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 12)))
    names = sorted({f"supplier {word()}" for _ in range(60)} | {word() * 20 for _ in range(20)})
    keys = s.key_features(frame(list(enumerate(names)), "kid bigint, key string"))
    some = keys.where("kid % 3 = 0")
    found = s.similar_to_few(some, keys, threshold, 3).collect()
    assert sorted(found) == sorted(s.similar_between(some, keys, threshold).collect())
    assert {(r.a, r.b) for r in found} == {
        (a, b) for a in range(0, len(names), 3) for b in range(len(names))
        if a != b and brute.matches(names[a], names[b], threshold)
    }


def test_lcs_udf_equals_textbook():
    rnd = random.Random(9)
    text = lambda n: "".join(rnd.choice("abcé𝒳 ") for _ in range(rnd.randint(0, n)))
    import pandas as pd

    a = [text(n) for n in (20, 40, 100) for _ in range(150)] + ["", "a\0", "\0"]
    b = [text(n) for n in (30, 70, 100) for _ in range(150)] + ["x", "a", "\0a"]
    # Several words a pair, also where every word carries over.
    a += [text(1000) for _ in range(12)] + ["a" * n for n in (64, 65, 128, 200, 1000)]
    b += [text(1000) for _ in range(12)] + ["a" * n for n in (64, 70, 129, 190, 999)]
    got = s.common_length.func(pd.Series(a), pd.Series(b)).tolist()
    assert got == [brute.lcs(x, y) for x, y in zip(a, b)]


def test_threshold_bounds():
    for wrong in (50, 101):
        with pytest.raises(ValueError):
            s.Blocking(wrong)


@pytest.mark.parametrize(
    "a, b, similar",
    [
        ("Vortex Metals", "Vortex Metals Inc.", False),
        ("Apex Composites", "Apex Composites Corp", True),
        ("Metals Vortex", "VORTEX  METALS", True),
        ("Apex Composites", "Harbour Castings", False),
    ],
)
def test_known_names(frame, a, b, similar):
    rows = frame([("S1", a), ("S2", b)], "supplier_code string, name string")
    assert [(r.later, r.earlier) for r in s.duplicate_pairs(rows).collect()] == (
        [("S2", "S1")] if similar else []
    )


def random_rows(seed, n=70):
    rnd = random.Random(seed)
    words = ["Quarry", "Stones", "Mill", "Timberworks", "Harbour", "Castings", "Ltd.", "Bros", "Copper"]
    rows = []
    for _ in range(n):
        name = " ".join(rnd.sample(words, rnd.randint(1, 4)))
        name = name.upper() if rnd.random() < 0.3 else name
        name = name.replace("e", "", 1) if rnd.random() < 0.3 else name
        rows.append((f"S{rnd.randint(0, n):03d}", name))
    return rows + [(None, "Solo"), ("S900", None), ("S901", "  "), ("S902", "Quarry Stones")]


@pytest.mark.parametrize("seed, hot_rows", [(1, 4096), (2, 3)])
def test_pairs_and_matches_equal_all_pairs(frame, seed, hot_rows):
    rows = random_rows(seed) + [(f"H{i:03d}", "Quarry Stones") for i in range(25)]
    df = frame(rows, "supplier_code string, name string")
    wanted = brute.pairs(rows)
    found = s.duplicate_pairs(df, hot_rows=hot_rows).collect()
    assert len(found) == len(wanted)
    assert {(r.later, r.earlier): r.score for r in found} == wanted

    names = sorted({n for _, n in rows if n is not None and n.strip()})
    found = s.name_matches(df, hot_rows=hot_rows).collect()
    assert {(r.name, r.match, r.score) for r in found} == {
        (x, y, brute.score(x, y)) for x in names for y in names if x != y and brute.score(x, y) >= 85
    }


def test_row_order_does_not_matter(frame):
    rows = random_rows(5, 30)
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    schema = "supplier_code string, name string"
    pairs = lambda r, n: sorted(s.duplicate_pairs(frame(r, schema).repartition(n)).collect())
    assert pairs(rows, 1) == pairs(shuffled, 5)


def test_missing_columns(frame):
    assert s.duplicate_pairs(frame([("x",)], "name string")).count() == 0
    assert s.duplicate_pairs(frame([("x",)], "supplier_code string")).count() == 0


def test_no_nested_loops(frame):
    keys = stored(frame, near_names(1, "abc", 5, 20, 85, bases=5))
    plan = s.similar_keys(keys)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert plan.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("repeats", [False, True])
def test_tasks_for_listed_pairs_grow_with_them(frame, monkeypatch, repeats):
    monkeypatch.setattr(s, "PAIRS_PER_TASK", 3)
    rows = [r for r in random_rows(5) if r[0] is not None]
    if not repeats:
        rows = [(f"U{i:03d}", name) for i, (_, name) in enumerate(rows)]
    index = s.duplicate_index(frame(rows, "supplier_code string, name string"), hot_rows=6)
    wanted, pairs = brute.pairs(rows), index.pairs()
    assert {(r.later, r.earlier): r.score for r in pairs.collect()} == pytest.approx(wanted)
    assert pairs.count() == len(wanted) > 24
    assert index.parts >= -(-len(wanted) // 3)
    # Every join has that many tasks, and pairs of codes with one key each are not made distinct.
    assert pairs.rdd.getNumPartitions() >= index.parts
    assert repeats or "Aggregate" not in pairs._jdf.queryExecution().optimizedPlan().toString()
