import itertools
import random
import re

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from scrubline.llm import simhash
from scrubline.llm.components import components


def plain_fingerprint(text, shingle=3):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if not words:
        return 0
    runs = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    """Smallest reachable node by repeated passes."""
    top = {n: n for n in nodes}
    while True:
        before = dict(top)
        for a, b in linked:
            top[a] = top[b] = min(top[a], top[b])
        if top == before:
            return top


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB é\n\tÀ\x0b\xa0z ", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def test_fingerprint_is_that_of_spark(spark):
    text = "one two three"
    found = spark.sql(f"select xxhash64('{text}')").first()[0]
    assert simhash.fingerprint(text) == found


def signed(n):
    return n - (1 << 64) if n >= 1 << 63 else n


def test_links_of_planted_distances(spark):
    dice = random.Random(3)
    bases = [dice.getrandbits(64) for _ in range(60)]
    values = set(bases)
    for base in bases:
        for bits in range(1, 6):
            for _ in range(4):
                values.add(base ^ sum(1 << b for b in dice.sample(range(64), bits)))
    # Some with all differing bits in one half.
    values |= {bases[0] ^ 0b111, bases[0] ^ (0b111 << 60), bases[0] ^ 0b1011, 0, (1 << 64) - 1, 1 << 63}
    values = sorted(signed(v) for v in values)
    for most in (0, 1, 2, 3):
        want = {(a, b) for a, b in itertools.combinations(values, 2) if ((a ^ b) % (1 << 64)).bit_count() <= most}
        found = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), most).collect()
        assert len(found) == len(want) and {(r.a, r.b) for r in found} == want


@pytest.mark.parametrize("most", [0, 1, 3])
def test_connecting_links_connect_what_links_connect(spark, most):
    dice = random.Random(most)
    values = set()
    for _ in range(6):
        # A crowd around one value, with members up to six bits from it.
        base = dice.getrandbits(64)
        values |= {base ^ sum(1 << b for b in dice.sample(range(64), dice.randint(0, 3))) for _ in range(150)}
        values |= {base ^ sum(1 << b for b in dice.sample(range(64), dice.randint(3, 6))) for _ in range(150)}
        low = [base ^ i for i in range(256)]
        values |= set(low[:: dice.choice([1, 3, 5])])
    values = sorted(signed(v) for v in values)
    linked = [(a, b) for a, b in itertools.combinations(values, 2) if ((a ^ b) % (1 << 64)).bit_count() <= most]
    found = [(r.a, r.b) for r in simhash.connecting_links(spark.createDataFrame([(v,) for v in values], "fp long"), most).collect()]
    assert set(found) <= set(linked)
    assert plain_components(values, found) == plain_components(values, linked)
    assert len(found) < max(1, len(linked) / 3) or most < 3


def test_more_bits_than_the_halves_can_find(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 4)
    with pytest.raises(ValueError):
        simhash.connecting_links(spark.createDataFrame([(1,)], "fp long"), 4)


def test_near_duplicates_are_those_of_brute_force(spark):
    dice = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(40):
        text = [dice.choice(words) for _ in range(dice.choice([1, 2, 3, 40, 600, 2000]))]
        texts.append(" ".join(text))
        for _ in range(dice.choice([0, 1, 8])):
            other = list(text)
            other[dice.randrange(len(other))] = dice.choice(words)
            texts.append(" ".join(other))
    texts += [None, "", " \n"]
    rows = [(i * 7 % 1000, t) for i, t in enumerate(texts)]
    prints = {i: plain_fingerprint(t) for i, t in rows}
    linked = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 3]
    want = plain_components(prints, linked)
    assert len(set(want.values())) < len(want) - 30
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == {
        (i, f"{prints[i]:016x}", want[i]) for i in prints
    }


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    dice = random.Random(1)
    edges = {
        "path": [(i, i + 1) for i in range(400)] + [(900, 901), (901, 900), (5, 5)],
        "star": [(500, i) for i in range(400)],
        "random": [(dice.randrange(300), dice.randrange(300)) for _ in range(200)],
        "none": [],
    }[shape]
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(found) == len(nodes)
    assert {r.node: r.component for r in found} == plain_components(nodes, edges)


def test_an_id_with_several_texts_keeps_one_row_of_each_group(spark):
    a, b, c = ("alpha beta gamma delta", "one two three four five", "red green blue black white")
    rows = [(1, a), (1, a), (1, b), (2, a), (3, b), (5, c), (5, a), (4, c), (4, c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = sorted((r.doc_id, r.text) for r in simhash.keep_one(docs).collect())
    assert kept == [(1, a), (1, b), (4, c)]


def test_keeping_one_row_calls_python_once_for_rows_that_need_it(spark):
    a, b, c = ("alpha beta gamma delta", "one two three four five", "red green blue black white")
    plain, repeated, nameless = [(1, a), (2, a), (3, b)], [(3, a), (4, c), (4, c)], [(None, a), (None, c), (None, c)]
    calls = []
    for rows in (plain, plain + repeated, plain + nameless, plain + repeated + nameless):
        kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
        calls.append(kept._jdf.queryExecution().executedPlan().toString().count("EvalPython"))
        texts = [(r.doc_id, r.text) for r in kept.collect()]
        own = [(4, c)] if repeated[1] in rows else [(None, c)] if nameless[1] in rows else []
        assert sorted(texts, key=str) == sorted([(1, a), (3, b), *own], key=str)
    # Each call takes a worker of its own beside that of the others in a task.
    assert calls == [0, 1, 1, 2]


def test_fingerprints_that_share_a_half_hardly_meet(spark, monkeypatch):
    dice = random.Random(1)
    base = dice.getrandbits(32)
    values = {(base << 32) | dice.getrandbits(32) for _ in range(2000)}
    # Two pairs that do link, by a differing bit in either half.
    some = sorted(values)[0]
    values |= {some ^ (1 << 40), some ^ 0b111}
    met = []
    real = simhash.grid_join

    def counting(left, right, key, *rest):
        sizes = [side.groupBy(key).count().withColumnRenamed("count", name) for side, name in ((left, "m"), (right, "n"))]
        met.append(sizes[0].join(sizes[1], key).selectExpr("sum(m * n)").first()[0] or 0)
        return real(left, right, key, *rest)

    monkeypatch.setattr(simhash, "grid_join", counting)
    prints = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    found = {frozenset((r.a, r.b)) for r in simhash.connecting_links(prints).collect()}
    linked = {frozenset((signed(some), signed(v))) for v in (some ^ (1 << 40), some ^ 0b111)}
    assert linked <= found and sum(met) < 500_000
