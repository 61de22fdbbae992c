"""Quality rules judged by host: failures per host, shrunk by a fitted beta prior, decide about its documents.

Every document is held against a few rules. Failures are summed per host and rule; the rates of all
hosts give a beta prior per rule by the method of moments, and each host's rate is shrunk towards it.
A rule binds on hosts whose shrunk rate says that failures are no accident there, and a host where
most documents fail is closed. These verdicts are joined back to the documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.llm.tables import broadcast_if_small, map_slices, spare_name, union_all
from scrubline.workspace import written

# The rules, in the order of their bits in ``failed`` and ``binding``. The first two reject by themselves.
RULES = ("short", "repeats", "symbols", "long_words", "repeated_lines")
BASE = 0b11
# A rule binds on a host from this shrunk rate on; a host is closed from this shrunk rate of failing documents on.
BINDING_RATE = 0.01
CLOSED_RATE = 0.5
# Bounds of the share of the variance that lies between hosts: a prior worth 9,999 documents, or nine.
LEAST_BETWEEN, MOST_BETWEEN = 1e-4, 0.1
# Hosts with more documents are joined by broadcast, which at most a hundred-thousandth of the rows can be.
HEAVY_HOST = 100_000

_SPACES = " \t\n\x0b\x0c\r"
_BLANKS = str.maketrans(_SPACES, "      ")
_SYMBOLS = "#*$%&|<>"
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[str], window: int = 3) -> int:
    """Words that lie in a window of ``window`` words which the text holds twice or more."""
    if len(words) <= window:
        return 0
    number = {word: at for at, word in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    spans = ids
    for width in range(1, window):
        # Two numbers below the count of words, so their pair always fits.
        spans = np.unique(spans[:-1] * len(words) + ids[width:], return_inverse=True)[1]
    twice = np.bincount(spans)[spans] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(window):
        covered[shift : shift + len(twice)] |= twice
    return int(covered.sum())


def measured(text: str | None) -> tuple[int, ...]:
    """The counts of ``_COUNTS`` for one whole text; zeros for a null one."""
    text = text or ""
    words = [w for w in text.translate(_BLANKS).split(" ") if w]
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, _SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def failures() -> dict[str, Column]:
    """Whether a row of counts fails each rule of RULES."""
    n = F.col("n_words")
    return {
        "short": n < 50,
        "repeats": 100 * F.col("n_repeat_words") > 50 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "long_words": F.col("word_chars") > 12 * n,
        "repeated_lines": 2 * F.col("n_dup_lines") > F.col("n_lines"),
    }


def counted(docs: DataFrame, host: Column) -> DataFrame:
    """``doc_id``, ``host``, the counts, and ``failed``: one bit per rule that the row fails."""

    def rule(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([measured(text) for text in batch.column(2).to_pylist()], np.int64)
        counts = [pa.array(column) for column in found.reshape(-1, len(_COUNTS)).T]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *counts], ["doc_id", "host", *_COUNTS])

    rows = docs.select(F.col("doc_id").cast("long"), host.alias("host"), F.col("text").cast("string"))
    schema = "doc_id long, host string, " + ", ".join(f"{name} long" for name in _COUNTS)
    bits = [F.when(fails, 1 << at).otherwise(0) for at, fails in enumerate(failures().values())]
    return map_slices(rows, rule, schema).withColumn("failed", sum(bits[1:], bits[0]))


def beta_prior(hosts: int, rows: int, squared_rows: int, failed: int, squared_rates: float) -> tuple[float, float]:
    """Both parameters of the beta distribution of a rule's rates, by moments weighted with rows.

    ``squared_rates`` is the sum of failed² / rows over hosts. Without hosts that differ, or with one
    host, the prior is as strong as it can be.
    """
    if not rows:
        return 0.0, 0.0
    mean = failed / rows
    within = mean * (1 - mean)
    # Expected spread of the rates if no host differs, and what it gains if hosts are all that differs.
    chance = (hosts - 1) / rows
    gain = 1 - squared_rows / rows**2 - chance
    between = LEAST_BETWEEN
    if within > 0 and gain > 0:
        spread = squared_rates / rows - mean**2
        between = min(max((spread - within * chance) / (within * gain), LEAST_BETWEEN), MOST_BETWEEN)
    strength = (1 - between) / between
    return mean * strength, (1 - mean) * strength


def verdicts(rows: DataFrame) -> tuple[DataFrame, dict[str, int | bool]]:
    """``host``, ``n_host_rows``, ``binding`` (bits of rules), ``closed`` per host; and a verdict by the prior alone.

    The sums per host are combined before they are shuffled, and one row of moments is read from them.
    """
    names = [*RULES, "any"]
    fails = [F.col("failed").bitwiseAND(1 << at) > 0 for at in range(len(RULES))] + [F.col("failed") > 0]
    sums = [F.count_if(is_so).alias(name) for name, is_so in zip(names, fails, strict=True)]
    hosts = written(rows.where("host is not null").groupBy("host").agg(F.count("*").alias("n_host_rows"), *sums), "hosts")
    n = F.col("n_host_rows")
    moments = hosts.agg(
        F.count("*").alias("hosts"),
        F.coalesce(F.sum(n), F.lit(0)).alias("rows"),
        F.sum(n.cast("double") * n).alias("squared_rows"),
        *[F.sum(name).alias(name) for name in names],
        *[F.sum(F.col(name).cast("double") * F.col(name) / n).alias(f"{name}_squared") for name in names],
    ).first()
    rates, alone = {}, {}
    for name in names:
        known = (moments["rows"], moments["squared_rows"], moments[name], moments[f"{name}_squared"])
        alpha, beta = beta_prior(moments["hosts"], *known)
        rates[name] = (F.col(name) + alpha) / (n + (alpha + beta))
        alone[name] = alpha / (alpha + beta) if alpha else 0.0
    binding = [F.when(rates[name] >= BINDING_RATE, 1 << at).otherwise(0) for at, name in enumerate(RULES)]
    found = hosts.select(
        "host", "n_host_rows", sum(binding[1:], binding[0]).alias("binding"), (rates["any"] >= CLOSED_RATE).alias("closed")
    )
    nameless = {
        "binding": sum(1 << at for at, name in enumerate(RULES) if alone[name] >= BINDING_RATE),
        "closed": alone["any"] >= CLOSED_RATE,
    }
    return written(found, "verdicts"), nameless


def with_verdicts(rows: DataFrame, found: DataFrame, nameless: dict[str, int | bool]) -> DataFrame:
    """``rows`` with the verdict of their host; rows of a host of any size stay where they are."""
    heavy = found.where(F.col("n_host_rows") > HEAVY_HOST)
    light = found.where(F.col("n_host_rows") <= HEAVY_HOST)
    none = {"n_host_rows": F.lit(0).cast("long")} | {name: F.lit(value) for name, value in nameless.items()}
    named = rows.where("host is not null")
    return union_all(
        [
            rows.where("host is null").withColumns(none),
            named.join(F.broadcast(heavy), "host"),
            named.join(F.broadcast(heavy.select("host")), "host", "left_anti").join(broadcast_if_small(light), "host"),
        ]
    )


def domain(col: str) -> Column:
    """The lower-cased host of a URL without ``www.`` and port; other values, such as names of sources, as they are.

    An empty value is no host.
    """
    value = F.col(col).cast("string")
    part = F.regexp_replace(F.lower(F.regexp_extract(value, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), r"^www\.", "")
    return F.nullif(F.when(value.contains("://"), part).otherwise(value), F.lit(""))


def judged(docs: DataFrame, host: str = "source") -> DataFrame:
    """One row per row of ``docs``: its counts, what it fails, and whether it stays.

    ``base_failed``: below 50 words, or more than half of them in repeated windows. ``kept`` is false for
    these, for all documents of a closed host, and for documents that fail a rule which binds on their
    host; where failures are rare a single odd document stays. Null and empty texts have no words.
    Documents without a host are judged by the prior alone. Repeated rows stay repeated and count as
    rows of their host; ties play no part; other columns are ignored; an empty table gives no rows.
    """
    rows = written(counted(docs, domain(host)), "counted")
    every = with_verdicts(rows, *verdicts(rows))
    bound = F.col("failed").bitwiseAND(F.col("binding")) > 0
    base = F.col("failed").bitwiseAND(BASE) > 0
    names = F.array(*[F.when(F.col("failed").bitwiseAND(1 << at) > 0, F.lit(name)) for at, name in enumerate(RULES)])
    verdict = F.when(F.col("closed"), "closed").when(F.col("binding") > 0, "binding").otherwise("open")
    return every.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        (~base & ~bound & ~F.col("closed")).alias("kept"),
        "host",
        F.array_join(names, ",").alias("failed_rules"),
        verdict.alias("host_verdict"),
    )


def keep(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` has no row that goes; rows without a ``doc_id`` all stay."""
    key = spare_name(docs, "judged_id")
    gone = judged(docs, host).where("not kept and doc_id is not null").select(F.col("doc_id").alias(key)).distinct()
    gone = broadcast_if_small(written(gone, "gone"))
    return docs.join(gone, docs["doc_id"].cast("long") == gone[key], "left_anti")
