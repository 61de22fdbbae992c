import random

import pytest

from scrubline.operators import grouping as g
from scrubline.operators import normalize as n
from tests import brute
from tests.test_similarity import random_rows

SCHEMA = "supplier_code string, name string"


def visiting_order(rows):
    first = {}
    for code, name in rows:
        if name is None or not name.strip():
            continue
        known = first.get(name)
        first[name] = code if known is None else min(known, code) if code is not None else known
    return sorted(first, key=lambda x: (first[x] is not None, first[x] or "", x))


def wanted_map(groups):
    return {variant: canonical for canonical, variants in groups for variant in variants}


@pytest.mark.parametrize(
    "seed, limits",
    [
        (1, {}),
        (2, {"repeats": 20, "smallest_batch": 5}),  # many small batches
    ],
)
def test_groups_equal_the_sequential_rule(frame, seed, limits):
    rows = random_rows(seed)
    found = g.name_groups(frame(rows, SCHEMA), **limits)
    groups = brute.groups(visiting_order(rows))
    assert {(r.canonical, r.variant, r.score) for r in found.collect()} == {
        (c, v, brute.score(c, v)) for c, vs in groups for v in vs
    }
    assert g.group_count(found).first()[0] == len(groups)
    mapping = {r.variant: r.canonical for r in g.canonical_map(found).collect()}
    assert mapping == wanted_map(groups)


@pytest.mark.parametrize("round_edges", [3, 40, 2_000_000])
def test_claims_do_not_depend_on_the_size_of_a_round(spark, round_edges):
    rnd = random.Random(round_edges)
    edges = {tuple(sorted(rnd.sample(range(80), 2))) for _ in range(150)}
    claimed = set()
    for lo in range(80):
        if lo not in claimed:
            claimed |= {hi for x, hi in edges if x == lo}
    found = g.claimed_within(spark.createDataFrame(sorted(edges), "lo bigint, hi bigint"), round_edges)
    assert sorted(r.id for r in found.collect()) == sorted(claimed)
    assert g.claimed_within(spark.createDataFrame([], "lo bigint, hi bigint")).count() == 0


def in_order(edges):
    beside, claimed = {}, set()
    for lo, hi in edges:
        beside.setdefault(lo, []).append(hi)
    for lo in sorted(beside):
        if lo not in claimed:
            claimed.update(beside[lo])
    return sorted(claimed)


@pytest.mark.parametrize(
    "shape, most_rounds",
    [("path", 1), ("star", 1), ("hub last", 1), ("band", 5), ("crowds", 2)],
)
def test_rounds_do_not_follow_the_number_of_edges(spark, monkeypatch, shape, most_rounds):
    n = 300
    edges = {
        "path": [(i, i + 1) for i in range(n)],
        "star": [(0, i) for i in range(1, n)],
        "hub last": [(i, n) for i in range(n)],
        "band": [(i, i + k) for i in range(n) for k in (1, 2, 3)],
        "crowds": [(c * 50 + i, c * 50 + j) for c in range(4) for j in range(30) for i in range(j)],
    }[shape]
    rounds = []
    real = g._free_leaders
    monkeypatch.setattr(g, "_free_leaders", lambda *a: rounds.append(1) or real(*a))
    found = g.claimed_within(spark.createDataFrame(edges, "lo bigint, hi bigint"), 150)
    assert sorted(r.id for r in found.collect()) == in_order(edges)
    assert len(rounds) <= most_rounds


def test_pairs_and_groups_from_one_join(frame):
    rows = random_rows(6)
    index, groups = g.index_and_groups(frame(rows, SCHEMA))
    assert {(r.later, r.earlier) for r in index.pairs().collect()} == set(brute.pairs(rows))
    assert {(r.canonical, r.variant) for r in groups.collect()} == {
        (c, v) for c, vs in brute.groups(visiting_order(rows)) for v in vs
    }


def test_many_numbered_names_take_a_handful_of_rounds(spark, monkeypatch):
    df = spark.range(1200).selectExpr(
        "lpad(id, 5, '0') as supplier_code", "concat('Supplier#', lpad(id, 9, '0')) as name"
    )
    rounds = []
    bound = g._settled_bound
    monkeypatch.setattr(g, "_settled_bound", lambda *a: rounds.append(1) or bound(*a))
    leaders = {r.canonical for r in g.name_groups(df).select("canonical").distinct().collect()}
    names = [f"Supplier#{i:09d}" for i in range(1200)]
    claimed, wanted = set(), set()
    for name in names:
        if name not in claimed:
            wanted.add(name)
            # Equal tokens of one length: 4 edits at most are 2 other digits at most.
            claimed |= {n for n in names if brute.score(name, n) >= 85}
    assert leaders == wanted and len(rounds) <= 4


# a ~ b ~ c, but not a ~ c
A, B, C = "abcdefghijklmnopqrst", "abcdefghijklmnopqrXY", "abcdefghijklmnopVWXY"


def test_path_of_names_is_not_one_component(frame):
    assert brute.score(A, B) >= 85 and brute.score(B, C) >= 85 and brute.score(A, C) < 85
    lead = lambda rows: {
        (r.canonical, r.variant) for r in g.name_groups(frame(rows, SCHEMA)).collect()
    }
    assert lead([("1", A), ("2", B), ("3", C)]) == {(A, B), (C, B)}
    assert lead([("1", B), ("2", A), ("3", C)]) == {(B, A), (B, C)}


def test_last_leader_wins_in_the_map(frame):
    df = frame([("1", A), ("2", B), ("3", C), ("4", None), ("5", "other")], SCHEMA)
    cleaned, mapping = n.normalize_suppliers(df)
    assert {(r.variant, r.canonical) for r in mapping.collect()} == {(B, C)}
    assert {(r.supplier_code, r.name) for r in cleaned.collect()} == {
        ("1", A), ("2", C), ("3", C), ("4", None), ("5", "other"),
    }
    assert cleaned.columns == df.columns


def test_normalizing_suppliers_twice_changes_nothing(frame):
    df = frame(random_rows(8), SCHEMA)
    once, _ = n.normalize_suppliers(df)
    twice, _ = n.normalize_suppliers(once)
    order = lambda x: sorted(x.collect(), key=str)
    assert order(once) == order(twice)


def test_crowd_of_copies_is_grouped_in_batches(frame):
    rnd = random.Random(4)
    names = {"northern bearing works"}
    while len(names) < 120:
        chars = list("northern bearing works")
        for _ in range(2):
            chars[rnd.randrange(len(chars))] = rnd.choice("abcdefghij")
        names.add("".join(chars))
    rows = [(f"S{i:03d}", name) for i, name in enumerate(sorted(names))]
    rnd.shuffle(rows)
    found = g.name_groups(frame(rows, SCHEMA), repeats=200, smallest_batch=10).collect()
    wanted = brute.groups([name for _, name in sorted(rows)])
    assert {(r.canonical, r.variant) for r in found} == {(c, v) for c, vs in wanted for v in vs}


def numbered(count):
    return [(f"SUP-{i:04d}", f"Supplier#{i:09d}") for i in range(count)]


def test_crowded_batches_list_no_pairs_of_their_keys(frame, monkeypatch):
    rows = numbered(400)
    joined = []
    for name in ("similar_keys", "similar_between"):
        monkeypatch.setattr(g, name, lambda *a, name=name, **b: joined.append(name))
    found = g.name_groups(frame(rows, SCHEMA), repeats=40_000, smallest_batch=20).collect()
    assert {(r.canonical, r.variant, r.score) for r in found} == {
        (c, v, brute.score(c, v)) for c, vs in brute.groups([name for _, name in rows]) for v in vs
    }
    assert not joined


@pytest.mark.parametrize("characters, steps", [(0, 10**8), (1500, 10**8), (10**6, 1), (10**6, 3000)])
def test_groups_do_not_depend_on_what_one_task_visits(frame, monkeypatch, characters, steps):
    rows = numbered(120) + [(f"T{code}", name) for code, name in random_rows(12, 60)]
    random.Random(3).shuffle(rows)
    monkeypatch.setattr(g, "IN_ORDER_CHARACTERS", characters)
    monkeypatch.setattr(g, "IN_ORDER_STEPS", steps)
    found = g.name_groups(frame(rows, SCHEMA), repeats=2000, smallest_batch=40).collect()
    assert {(r.canonical, r.variant) for r in found} == {
        (c, v) for c, vs in brute.groups(visiting_order(rows)) for v in vs
    }


@pytest.mark.parametrize("steps", [1, 500, 10**8])
def test_leaders_in_order_stop_when_steps_run_out(spark, frame, steps):
    names = frame(numbered(200) + [("a", "x" * 150), ("b", "y")], "first_seen string, name string")
    keys, _ = g.ranked_keys(names)
    texts = {r.kid: r.key for r in keys.collect()}
    leaders, stopped = g.leaders_in_order(keys, 85, steps)
    wanted = []
    for kid in sorted(texts):
        if kid < (len(texts) if stopped is None else stopped):
            if not any(brute.matches(texts[kid], texts[at]) for at in wanted):
                wanted.append(kid)
    assert sorted(r.kid for r in leaders.collect()) == wanted
    assert (stopped is None) == (steps == 10**8) and wanted


def test_no_names(frame):
    df = frame([("1", None), ("2", " ")], SCHEMA)
    assert g.name_groups(df).count() == 0
    assert n.normalize_suppliers(df)[0].count() == 2


def test_variants_in_order_of_score(frame):
    rows = random_rows(9, 90)
    groups = g.name_groups(frame(rows, SCHEMA))
    found = g.listed(groups).collect()
    assert len(found) == groups.count()
    by_group = {}
    for r in found:
        by_group.setdefault(r.canonical_rank, []).append(r)
    for members in by_group.values():
        order = sorted(members, key=lambda r: (-r.score, r.variant_seen is not None, r.variant_seen or "", r.variant))
        assert [r.position for r in order] == list(range(1, len(members) + 1))


@pytest.mark.parametrize("hot", [0, 3, 10**6])
def test_name_map_with_hot_names(frame, hot):
    names = ["a"] * 9 + [None] * 8 + ["b"] * 2 + ["c", "hot and unmapped", "hot and unmapped", "hot and unmapped", "hot and unmapped"]
    df = frame([(n, i, "x") for i, n in enumerate(names)], "name string, variant int, hot_name string")
    mapping = frame([("a", "A"), ("c", "C")], "variant string, canonical string")
    mapped = n.apply_name_map(df, mapping, "name", hot)
    assert mapped.columns == df.columns
    wanted = [{"a": "A", "c": "C"}.get(name, name) for name in names]
    assert [r.name for r in sorted(mapped.collect(), key=lambda r: r.variant)] == wanted
