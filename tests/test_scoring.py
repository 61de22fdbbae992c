import random

import pytest
from pyspark.sql import functions as F

from scrubline import fixed
from scrubline.operators import scoring, similarity
from tests import brute
from tests.test_similarity import random_rows

KEYS = "category string, record_key string"


def table(df):
    return {r.category: r for r in df.collect()}


def test_matches_are_counted_by_key(frame):
    truth = frame([(fixed.INVALID_EMAILS, k) for k in ("S1", "S2")], KEYS)
    found = frame([(fixed.INVALID_EMAILS, k) for k in ("S1", "S9", "S9", None)], KEYS)
    scores = table(scoring.scorecard(found, truth, [fixed.INVALID_EMAILS]))
    row = scores[fixed.INVALID_EMAILS]
    assert (row.expected, row.detected, row.matched) == (2, 2, 1)
    assert (row.false_positives, row.false_negatives) == (1, 1)
    assert (row.detection_rate, row.recall, row.precision, row.f1) == (0.5, 0.5, 0.5, 0.5)
    assert row.validation_mode == "row_keys"
    assert scores["_overall"].recall == 0.5
    outcomes = scoring.outcomes(found, truth, [fixed.INVALID_EMAILS])
    assert [r.record_key for r in scoring.false_positives(outcomes).collect()] == ["S9"]
    assert [r.record_key for r in scoring.false_negatives(outcomes).collect()] == ["S2"]


def test_categories_that_ran_decide_what_is_scored(frame):
    truth = frame([(fixed.PART_NUMBERS, "P1"), (fixed.STATE_VARIANTS, "C1")], KEYS)
    found = frame([("unheard_of", "x")], KEYS)
    run = [fixed.PART_NUMBERS, fixed.INVALID_EMAILS, "unheard_of"]
    scores = table(scoring.scorecard(found, truth, run))
    assert set(scores) == {fixed.PART_NUMBERS, fixed.INVALID_EMAILS, "_overall"}
    assert (scores[fixed.PART_NUMBERS].recall, scores[fixed.PART_NUMBERS].precision) == (0.0, 1.0)
    assert scores[fixed.PART_NUMBERS].f1 == 0.0
    assert (scores[fixed.INVALID_EMAILS].recall, scores[fixed.INVALID_EMAILS].precision) == (1.0, 1.0)


def test_nothing_scored(frame):
    empty = frame([], KEYS)
    scores = table(scoring.scorecard(empty, empty, []))
    assert (scores["_overall"].expected, scores["_overall"].recall, scores["_overall"].f1) == (0, 1.0, 1.0)


def test_published_totals(frame):
    rows = [("a", 88, 121, 88, 33, 0)]
    schema = "category string, " + ", ".join(f"{c} long" for c in scoring.COUNTS)
    overall = table(scoring.with_health(scoring.scorecard_of(frame(rows, schema))))["_overall"]
    assert (overall.recall, overall.precision, overall.f1) == (1.0, 0.7273, 0.8421)
    assert (overall.health, overall.precision_percent, overall.f1_percent) == ("green", "72.7%", "84.2%")


@pytest.mark.parametrize("seed", [1, 2])
def test_counts_agree_with_sets(frame, seed):
    rnd = random.Random(seed)
    run = [fixed.PART_NUMBERS, fixed.INVALID_EMAILS, fixed.STATE_VARIANTS]
    keys = lambda n: [(rnd.choice(run), rnd.choice([None, *map(str, range(30))])) for _ in range(n)]
    found, truth = keys(80), keys(60)
    group = lambda rows: {c: [k for x, k in rows if x == c] for c in run}
    wanted = brute.scorecard(group(found), group(truth))
    scores = table(scoring.scorecard(frame(found, KEYS), frame(truth, KEYS), run))
    for category, row in scores.items():
        assert (row.expected, row.detected, row.matched) == wanted[category]
        assert row.matched + row.false_positives == row.detected
        assert row.matched + row.false_negatives == row.expected


@pytest.mark.parametrize("repeats", [False, True])
def test_pair_counts_equal_listed_pairs(frame, repeats):
    rows = [r for r in random_rows(11) if r[0] is not None]
    if not repeats:
        rows = [(f"U{i:03d}", name) for i, (_, name) in enumerate(rows)]
    index = similarity.duplicate_index(frame(rows, "supplier_code string, name string"), hot_rows=6)
    pairs = sorted(brute.pairs(rows))
    truth = [f"{a}->{b}" for a, b in pairs[::2]] + [f"{b}->{a}" for a, b in pairs[:3]]
    truth += ["S001->S000", "nonsense", "a->b->c", truth[0], None]
    truth_df = frame([(fixed.NEAR_DUPLICATES, k) for k in truth], KEYS)
    row = scoring.pair_counts(index, truth_df).first()
    listed = index.pairs().select(
        F.lit(fixed.NEAR_DUPLICATES).alias("category"), similarity.pair_key().alias("record_key")
    )
    run = [fixed.NEAR_DUPLICATES]
    assert row == scoring.category_counts(scoring.outcomes(listed, truth_df, run), run).first()
    assert row.detected == len(pairs)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pair_counts_of_codes_that_read_alike(frame, seed):
    rnd = random.Random(seed)
    codes = ["a", "b", "c", "a->b", "b->c", "a->b->c", "b->b", "->", "a->"]
    names = ["Mill Road", "MILL ROAD", "Mill Roads", "Quarry Lane", "Quarry Lanes", "Harbour"]
    rows = [(rnd.choice(codes), rnd.choice(names)) for _ in range(14)]
    index = similarity.duplicate_index(frame(rows, "supplier_code string, name string"))
    texts = {f"{a}->{b}" for a, b in brute.pairs(rows)}
    truth = [*sorted(texts)[::2], "a->b->c", "c->a->b", "x->y"]
    truth_df = frame([(fixed.NEAR_DUPLICATES, k) for k in truth], KEYS)
    row = scoring.pair_counts(index, truth_df).first()
    assert (row.expected, row.detected, row.matched) == (len(set(truth)), len(texts), len(texts & set(truth)))
    missed = {r.record_key for r in scoring.missed_pairs(index, truth_df).collect()}
    unwanted = {r.record_key for r in scoring.unwanted_pairs(index, truth_df).collect()}
    assert (missed, unwanted) == (set(truth) - texts, texts - set(truth))


def test_pair_counts_with_arrows_in_codes(frame):
    rows = frame([("a->b", "Mill"), ("c", "MILL")], "supplier_code string, name string")
    truth = frame([(fixed.NEAR_DUPLICATES, "c->a->b")], KEYS)
    row = scoring.pair_counts(similarity.duplicate_index(rows), truth).first()
    assert (row.expected, row.detected, row.matched) == (1, 1, 1)


@pytest.mark.parametrize("seed, hot", [(1, 0), (2, 2), (3, 3), (4, 1)])
def test_pair_counts_with_names_that_many_codes_share(frame, seed, hot, monkeypatch):
    """Several common names, also similar ones, beside own names; counted, listed or partly both."""
    monkeypatch.setattr(scoring, "HOT_GROUPS", hot)
    rnd = random.Random(seed)
    common = ["Unknown Vendor", "Unknown Vendors", "Vendor UNKNOWN", "Cash Sale", "Cash Sales Account"]
    own = ["Quarry Stones", "Quarry Stone", "Mill Road", "Harbour Castings", "Harbor Castings", "Timberworks"]
    rows = []
    for code in range(40):
        names = rnd.sample(common, rnd.randint(0, 3)) + rnd.sample(own, rnd.randint(0, 2))
        rows += [(f"S{code:02d}", name) for name in names for _ in range(rnd.choice([1, 1, 2]))]
    index = similarity.duplicate_index(frame(rows, "supplier_code string, name string"))
    pairs = {f"{a}->{b}" for a, b in brute.pairs(rows)}
    truth = rnd.sample(sorted(pairs), 30) + [f"S{rnd.randint(0, 39):02d}->S{rnd.randint(0, 39):02d}" for _ in range(40)]
    row = scoring.pair_counts(index, frame([(fixed.NEAR_DUPLICATES, k) for k in truth], KEYS)).first()
    assert (row.expected, row.detected, row.matched) == (len(set(truth)), len(pairs), len(pairs & set(truth)))


def test_codes_that_share_a_name_store_few_rows(frame, monkeypatch):
    stored = {}
    real = scoring.written

    def counting(df, label):
        table = real(df, label)
        stored[label] = max(stored.get(label, 0), table.count())
        return table

    monkeypatch.setattr(scoring, "written", counting)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rnd = random.Random(1)
    name = lambda: "".join(rnd.choice(letters) for _ in range(20))
    rows = [(f"S{i}", n) for i in range(600) for n in ("Unknown Vendor", name())]
    # Two codes with many names each, of which one pair is looked up.
    shared = [name() for _ in range(300)]
    rows += [(code, n) for code in ("X", "Y") for n in [*shared, *(name() for _ in range(200))]]
    index = similarity.duplicate_index(frame(rows, "supplier_code string, name string"))
    truth = frame([(fixed.NEAR_DUPLICATES, "Y->X"), (fixed.NEAR_DUPLICATES, "X->S1")], KEYS)
    row = scoring.pair_counts(index, truth).first()
    assert (row.detected, row.matched) == (600 * 599 // 2 + 1, 1)
    assert max(stored.values()) < 3000


def test_outcomes_of_listed_pairs_spread_by_their_number(frame, monkeypatch):
    monkeypatch.setattr(similarity, "PAIRS_PER_TASK", 2)
    rows = [r for r in random_rows(7) if r[0] is not None]
    index = similarity.duplicate_index(frame(rows, "supplier_code string, name string"))
    texts = {f"{a}->{b}" for a, b in brute.pairs(rows)}
    truth = [*sorted(texts)[::2], "x->y", "x->y"]
    truth_df = frame([(fixed.NEAR_DUPLICATES, k) for k in truth] + [(fixed.INVALID_EMAILS, "S1")], KEYS)
    run = [fixed.NEAR_DUPLICATES, fixed.INVALID_EMAILS]
    listed = index.pairs().select(F.lit(run[0]).alias("category"), similarity.pair_key().alias("record_key"))
    found = listed.unionByName(frame([(run[1], "S1"), (run[1], "S1"), (run[1], "S2")], KEYS))
    outcomes = scoring.outcomes(found, truth_df, run, index.parts)
    assert outcomes.rdd.getNumPartitions() == index.parts > 8
    assert sorted(map(tuple, outcomes.collect())) == sorted(map(tuple, scoring.outcomes(found, truth_df, run).collect()))
    unwanted = [r.record_key for r in scoring.unwanted_pairs(index, truth_df).collect()]
    assert sorted(unwanted) == sorted(texts - set(truth))
