"""Spelling variants: words one edit apart, found through a reduced alphabet.

Letters are hashed to a few symbols, so two words one edit apart are equal or one edit apart in their
reduced forms too. The full one-edit neighbourhood of every reduced word is generated, joined on
equality with the reduced vocabulary, and the survivors are verified on the words themselves. Reduced
forms that many words share are told apart by a finer alphabet in the same way, so what meets does not
grow with the square of a crowd.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.llm.tables import broadcast_if_small, is_empty, map_slices
from scrubline.workspace import written

LEAST_LETTERS = 5
LEAST_COUNT = 3
# A form is so many times as frequent as the words that take it.
DOMINANCE = 2
# One run of so many loses a letter.
TYPO_EVERY = 97
# Symbols of the reduced alphabet, and of the finer one for reduced forms of more words than CROWDED.
SYMBOLS, FINE_SYMBOLS = 8, 64
CROWDED = 256

_LETTERS = "".join(map(chr, [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]))
_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LETTERS)
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def counted_words(doc_id: int | None, text: str | None) -> Counter[str]:
    """The words of one text as often as they occur; of some runs a letter goes, by a checksum."""
    lowered = (text or "").encode("utf-8", "replace").translate(_LOWER).decode("utf-8")
    found = Counter(run[0] for run in _RUN.finditer(lowered))
    start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    typos = []
    for run in found:
        h = zlib.crc32(run.encode("utf-8"), start)
        if h % TYPO_EVERY == 0:
            typos.append((run, h % len(run)))
    shortened = Counter()
    for run, at in typos:
        if len(run) > LEAST_LETTERS:
            shortened[run[:at] + run[at + 1 :]] += found[run]
        del found[run]
    found.update(shortened)
    return found


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word``, ``n`` of all words with enough letters and occurrences, over whole texts.

    Counts are summed in tasks before they are shuffled.
    """

    def rule(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = Counter()
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found.update(counted_words(doc_id, text))
        columns = [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counts = map_slices(rows, rule, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


def _alphabet(symbols: int) -> tuple[str, list[str]]:
    """The symbol of each letter, by a hash of the letter, and all symbols."""
    signs = [chr(ord("0") + at) for at in range(symbols)]
    return "".join(signs[zlib.crc32(letter.encode("utf-8")) % symbols] for letter in _LETTERS), signs


def reduced(word: str, symbols: int) -> Column:
    return F.translate(word, _LETTERS, _alphabet(symbols)[0])


def neighbourhood(form: str, symbols: int) -> Column:
    """Hashes of all strings of symbols at most one edit from the reduced word in ``form``, each once."""
    signs = F.array(*map(F.lit, _alphabet(symbols)[1]))
    length = F.length(form)
    left = lambda at: F.substring(form, F.lit(1), at)
    right = lambda at: F.substring(form, at + 1, length)
    shorter = F.transform(F.sequence(F.lit(1), length), lambda at: F.xxhash64(F.concat(left(at - 1), right(at))))
    same = F.transform(
        F.sequence(F.lit(1), length),
        lambda at: F.transform(signs, lambda sign: F.xxhash64(F.concat(left(at - 1), sign, right(at)))),
    )
    longer = F.transform(
        F.sequence(F.lit(0), length),
        lambda at: F.transform(signs, lambda sign: F.xxhash64(F.concat(left(at), sign, right(at)))),
    )
    return F.array_distinct(F.concat(shorter, F.flatten(same), F.flatten(longer)))


def _form(symbols: int) -> Column:
    return F.xxhash64(reduced("word", symbols))


def _meeting_forms(words: DataFrame, symbols: int) -> DataFrame:
    """``form``, ``key``: hashes of reduced words of ``words`` at most one edit apart, each two once.

    The neighbourhood of every different reduced word is joined with all of them. As each of two finds
    the other, the half of a neighbourhood with hashes from its own on is enough.
    """
    forms = words.select(reduced("word", symbols).alias("reduced")).distinct()
    forms = forms.withColumn("form", F.xxhash64("reduced"))
    upper = F.filter(neighbourhood("reduced", symbols), lambda key: key >= F.col("form"))
    probes = forms.select("form", F.explode(upper).alias("key"))
    return probes.join(forms.select(F.col("form").alias("key")), "key", "left_semi")


def _verified(words: DataFrame, met: DataFrame, symbols: int) -> DataFrame:
    """Pairs of ``words`` in forms that meet, with one edit between the words themselves."""
    sides = []
    for side, key in (("a", "form"), ("b", "key")):
        names = [F.col(c).alias(side if c == "word" else f"{side}_{c}") for c in words.columns]
        sides.append(words.select(_form(symbols).alias(key), *names))
    once = (F.col("form") < F.col("key")) | (F.col("a") < F.col("b"))
    return met.join(sides[0], "form").join(sides[1], "key").where(once & (F.levenshtein("a", "b", 1) == 1))


def near_words(words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """``a``, ``a_n``, ``b``, ``b_n``: all pairs of stored ``words`` one edit apart, once, in either order.

    Forms of more than ``crowded`` words take no part at first. Their words, and those of the forms that
    meet them, are then compared by the finer alphabet.
    """
    words = words.select("word", "n")
    met = written(_meeting_forms(words, SYMBOLS), "met")
    sizes = words.groupBy(_form(SYMBOLS).alias("form")).agg(F.count("*").alias("words"))
    dense = written(sizes.where(F.col("words") > crowded).select("form"), "dense")
    shown = ["a", "a_n", "b", "b_n"]
    if is_empty(dense):
        return _verified(words, met, SYMBOLS).select(*shown)
    dense = broadcast_if_small(dense)
    dense_key = dense.withColumnRenamed("form", "key")
    plain = met.join(dense, "form", "left_anti").join(dense_key, "key", "left_anti")
    beside = met.join(dense, "form", "left_semi").select(F.col("key").alias("form"))
    beside = beside.union(met.join(dense_key, "key", "left_semi").select("form")).union(dense).distinct()
    formed = words.withColumn("form", _form(SYMBOLS)).join(beside, "form", "left_semi")
    marked = formed.join(dense.withColumn("dense", F.lit(True)), "form", "left")
    marked = written(marked.select("word", "n", F.coalesce("dense", F.lit(False)).alias("dense")), "marked")
    fine = _verified(marked, _meeting_forms(marked, FINE_SYMBOLS), FINE_SYMBOLS).where("a_dense or b_dense")
    return _verified(words, plain, SYMBOLS).select(*shown).unionByName(fine.select(*shown))


def _roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: the last of the forms that follow from ``word``, ``form``.

    Counts at least double with every step, so chains are short and end; they are followed by doubling.
    """
    pointers = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = pointers.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        step = pointers.join(broadcast_if_small(onward), "root", "left")
        step = step.select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved"))
        step = written(step, "roots")
        pointers = step.select("word", "root")
        if is_empty(step.where("moved")):
            return pointers


def variants(docs: DataFrame) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of the vocabulary of ``docs``.

    The form of a word is its most frequent near word (of several the first in code-point order) if
    that is at least twice as frequent, else null; the root is the last of its forms, or the word.
    Null and empty texts have no words; repeated rows count again; a null doc_id counts as no digits in
    the checksum; other columns are ignored; without words of enough occurrences there are no rows.
    """
    words = written(vocabulary(docs), "words")
    pairs = near_words(words)
    both = F.explode(
        F.array(
            F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
            F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
        )
    )
    sides = pairs.select(both.alias("side")).select("side.*")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    nearest = sides.groupBy("word", "n").agg(F.count("*").alias("n_near"), best)
    best_n = -F.col("best.less")
    dominated = best_n >= DOMINANCE * F.col("n")
    nearest = written(
        nearest.select(
            "word",
            "n_near",
            F.when(dominated, F.col("best.near")).alias("form"),
            F.when(dominated, best_n).alias("form_n"),
        ),
        "nearest",
    )
    roots = broadcast_if_small(_roots(nearest.where("form is not null").select("word", "form")))
    return (
        words.join(broadcast_if_small(nearest), "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form_n",
        )
    )
