import random

import pytest
from pyspark.sql import functions as F

from scrubline.llm import hosts

DOCS = "doc_id long, text string, source string"
GOOD = " ".join(f"word{i} of{i} a plain{i} story," for i in range(20))
ODD = " ".join(f"word{i} ###" for i in range(60))


def plain_repeated(words, window=3):
    spans = [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]
    covered = {j for i, span in enumerate(spans) if spans.count(span) > 1 for j in range(i, i + window)}
    return len(covered)


def test_words_in_repeated_windows():
    dice = random.Random(3)
    for _ in range(300):
        words = [dice.choice("abcd") * dice.randint(1, 2) for _ in range(dice.randint(0, 40))]
        assert hosts.repeated_words(words) == plain_repeated(words)


def test_counts_of_one_text():
    line = "one x\u00a0y two\n"
    text = line + "\n \t\n" + line + "### $ é\U0001f600\r\none\x0bb\n \n"
    # The blank lines repeat as well, but hold no word; the no-break space is part of a word.
    assert hosts.measured(text) == (11, 9 + 9 + 3 + 1 + 2 + 3 + 1, 4, 4, 1, 6)
    assert hosts.measured(None) == hosts.measured("") == (0, 0, 0, 0, 0, 0)


def judged(spark, rows):
    return {r.doc_id: r for r in hosts.judged(spark.createDataFrame(rows, DOCS).repartition(3)).collect()}


def test_a_rule_binds_where_failures_are_no_accident(spark):
    rows, at = [], 0
    # One odd document among many on each tidy host; a third of an untidy host; nearly all of a broken one.
    for host, good, odd in [*((f"tidy{i}", 400, 1) for i in range(4)), ("untidy", 40, 20), ("broken", 3, 60)]:
        for text in [GOOD] * good + [ODD] * odd:
            rows.append((at, text, host))
            at += 1
    rows += [(at, GOOD, None), (at + 1, ODD, None), (at + 2, "too short", "tidy0"), (at + 3, "a b c " * 40, "tidy1")]
    found = judged(spark, rows)
    by_host = {}
    for r in found.values():
        by_host.setdefault((r.host, r.failed_rules), set()).add((r.kept, r.host_verdict))
    assert all(by_host[f"tidy{i}", ""] == {(True, "open")} for i in range(4))
    assert all(by_host[f"tidy{i}", "symbols"] == {(True, "open")} for i in range(4))
    assert by_host["untidy", ""] == {(True, "binding")} and by_host["untidy", "symbols"] == {(False, "binding")}
    assert by_host["broken", ""] == {(False, "closed")} and by_host["broken", "symbols"] == {(False, "closed")}
    # Without a host the prior decides: here failures are common enough for the rule to bind.
    assert found[at].kept and not found[at + 1].kept
    assert found[at + 2].base_failed and found[at + 3].base_failed and not found[at + 2].kept


def test_small_hosts_are_shrunk_to_the_rest(spark):
    rows = [(i, GOOD, f"h{i % 50}") for i in range(2000)] + [(5000 + i, ODD, "h0") for i in range(2)]
    rows += [(9000, ODD, "new"), (9001, ODD, "new")]
    found = judged(spark, rows)
    # Two failures of two would close a host by their rate alone; the prior of fifty clean hosts says otherwise.
    assert found[9000].host_verdict != "closed" and found[0].kept


def test_prior():
    assert hosts.beta_prior(0, 0, 0, 0, 0) == (0.0, 0.0)
    # Equal rates everywhere: as strong as can be; all or nothing: as weak as can be.
    alpha, beta = hosts.beta_prior(10, 1000, 10 * 100**2, 100, 10 * 10**2 / 100)
    assert alpha + beta == pytest.approx(1 / hosts.LEAST_BETWEEN - 1) and alpha / (alpha + beta) == pytest.approx(0.1)
    alpha, beta = hosts.beta_prior(10, 1000, 10 * 100**2, 500, 5 * 100**2 / 100)
    assert (alpha, beta) == pytest.approx((4.5, 4.5))
    # Rates drawn from a known distribution are found again.
    dice = random.Random(1)
    rates = [dice.betavariate(2, 18) for _ in range(4000)]
    failed = [sum(dice.random() < p for _ in range(50)) for p in rates]
    found = hosts.beta_prior(4000, 200_000, 4000 * 50**2, sum(failed), sum(f * f / 50 for f in failed))
    assert found == pytest.approx((2, 18), rel=0.15)


def test_a_heavy_host_gets_the_same_verdicts(spark, monkeypatch):
    rows = [(i, ODD if i % 9 == 0 else GOOD, ["a", "b", "c", None][i % 4 if i % 3 else 0]) for i in range(300)]
    before = judged(spark, rows)
    monkeypatch.setattr(hosts, "HEAVY_HOST", 80)
    assert judged(spark, rows) == before and len(before) == 300


def test_domain(spark):
    urls = ["https://www.Example.org:80/a?b", "http://user@b.example/x", "src0", "", None, "ftp://c.example", "mailto:x"]
    found = spark.createDataFrame([(u,) for u in urls], "url string").select(hosts.domain("url")).collect()
    assert [r[0] for r in found] == ["example.org", "b.example", "src0", None, None, "c.example", "mailto:x"]


def test_keep_returns_whole_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("judged_id", F.lit(1))
    kept = {r.doc_id for r in hosts.judged(docs).collect() if r.kept}
    found = hosts.keep(docs)
    assert found.columns == docs.columns and {r.doc_id for r in found.collect()} == kept
    assert 0 < len(kept) < docs.count()
