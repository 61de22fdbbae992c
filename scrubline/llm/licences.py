"""Licence notices in whole texts, exact and with small errors.

Exact phrases are found as runs of words. Notices that may hold errors are found by the pigeonhole
principle: a notice with at most ``k`` errors holds at least one of its ``k + 1`` pieces unharmed, so
one automaton over all pieces marks the places worth a look, and bounded-error matching verifies
the edits there and gives the span.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.tables import SLICE_ROWS

# Exact phrases (words, then label).
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

# Notices that are also found with up to so many edits (words, label, edits).
NOTICES = [
    ("gnu general public license", "gpl", 4),
    ("gnu lesser general public license", "lgpl", 4),
    ("gnu affero general public license", "agpl", 4),
    ("apache license", "apache", 2),
    ("mit license", "mit", 1),
    ("bsd license", "bsd", 1),
    ("mozilla public license", "mpl", 3),
    ("eclipse public license", "epl", 3),
    ("creative commons attribution", "cc-by", 4),
    ("cc by nc", "cc-by-nc", 0),
    ("cc by sa", "cc-by-sa", 0),
    ("permission is hereby granted free of charge", "mit", 6),
    ("redistribution and use in source and binary forms", "bsd", 7),
    ("all rights reserved", "reserved", 2),
]

# A to Z become lower case; every other byte below 128 that is no letter or digit ends a word.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


@dataclass(frozen=True)
class Span:
    label: str
    first_word: int
    last_word: int
    edits: int
    exact: bool
    text: str
    score: float


class Notices:
    """The automaton of seeds and the patterns that verify them."""

    def __init__(self, notices: list[tuple[str, str, int]] = NOTICES):
        self.notices = notices
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, (words, _, edits) in enumerate(notices):
            pieces = edits + 1
            if len(words) < 3 * pieces:
                raise ValueError(f"too many errors for a notice as short as {words!r}")
            cuts = [len(words) * i // pieces for i in range(pieces + 1)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                seeds.setdefault(words[low:high], []).append((number, low))
        self.seeds = ahocorasick.Automaton()
        for seed, places in seeds.items():
            self.seeds.add_word(seed, (len(seed), places))
        self.seeds.make_automaton()
        # Whole words only; of the matches in a window, one with the fewest edits.
        self.patterns = [
            regex.compile(rf"(?b)(?<= )(?:{regex.escape(words)}){{e<={edits}}}(?= )")
            for words, _, edits in notices
        ]

    def find(self, line: str) -> list[Span]:
        """Spans in ``line``: words with one blank between and around them.

        Each seed is verified in a window of its own, which has room for one match. Matches of a
        notice that overlap are readings of one place, of which that with the fewest edits counts.
        """
        starts: dict[int, set[int]] = {}
        for end, (length, places) in self.seeds.iter(line):
            for number, offset in places:
                starts.setdefault(number, set()).add(end + 1 - length - offset)
        spans = []
        for number, places in starts.items():
            words, label, most = self.notices[number]
            found = {}
            for start in places:
                low, high = max(0, start - most - 1), min(start + len(words) + most + 1, len(line))
                if match := self.patterns[number].search(line, low, high):
                    found[match.span()] = sum(match.fuzzy_counts)
            counted = before = 0
            for low, high in _apart(found):
                before += line.count(" ", counted, low)
                counted = low
                text, edits, first = line[low:high], found[low, high], before - 1
                score = max(0.0, 1 - edits / len(words))
                spans.append(Span(label, first, first + text.count(" "), edits, False, text, score))
        return spans


def _apart(found: dict[tuple[int, int], int]) -> list[tuple[int, int]]:
    """Spans that do not overlap, in order; those with fewer edits go first, then earlier ones."""
    kept: list[tuple[int, int]] = []
    for span in sorted(found, key=lambda s: (found[s], s)):
        at = bisect.bisect(kept, span)
        if (at == 0 or kept[at - 1][1] <= span[0]) and (at == len(kept) or span[1] <= kept[at][0]):
            kept.insert(at, span)
    return kept


def exact_spans(line: str, phrases: list[tuple[str, str]] = PHRASES) -> list[Span]:
    """Every place where the words of a phrase stand one after another."""
    spans = []
    for words, label in phrases:
        wanted, at, counted, before = f" {words} ", line.find(f" {words} "), 0, 0
        while at >= 0:
            before += line.count(" ", counted, at)
            counted = at
            spans.append(Span(label, before, before + words.count(" "), 0, True, words, 1.0))
            at = line.find(wanted, at + 1)
    return spans


def scan_text(text: str | None, notices: Notices) -> tuple[int, list[Span]]:
    """The number of words of a text and its spans; bytes of other scripts are letters."""
    words = (text or "").encode("utf-8", "replace").translate(_WORDS).split()
    line = f" {b' '.join(words).decode('latin-1')} "
    return len(words), exact_spans(line) + notices.find(line)


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``,
    ``labels``, ``score`` and ``spans`` for every row.

    Base columns tell of exact phrases; ``labels`` also holds those of notices with errors, ``score``
    is the best of all spans (1 for an exact one, less its share of edits otherwise, 0 without any),
    and ``spans`` lists label, first and last word, edits and words of each. Null and empty texts
    have no words, empty label strings and null places. Repeated rows stay repeated, other columns
    are ignored, an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        notices = Notices()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                yield described(batch.slice(at, SLICE_ROWS), notices)

    names = "doc_id n_words n_base first_word last_word base_labels labels score spans".split()
    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string,"
        " labels string, score double, spans array<struct<label: string, first_word: long,"
        " last_word: long, edits: int, words: string>>"
    )
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    span = pa.struct(
        [
            ("label", pa.string()),
            ("first_word", pa.int64()),
            ("last_word", pa.int64()),
            ("edits", pa.int32()),
            ("words", pa.string()),
        ]
    )

    def described(batch: pa.RecordBatch, notices: Notices) -> pa.RecordBatch:
        rows, listed = [], []
        for text in batch.column(1).to_pylist():
            n_words, spans = scan_text(text, notices)
            base = [s for s in spans if s.exact]
            rows.append(
                (
                    n_words,
                    len(base),
                    min((s.first_word for s in base), default=None),
                    max((s.first_word for s in base), default=None),
                    ",".join(sorted({s.label for s in base})),
                    ",".join(sorted({s.label for s in spans})),
                    max((s.score for s in spans), default=0.0),
                )
            )
            each = sorted({(s.first_word, s.last_word, s.label, s.edits, s.text) for s in spans})
            listed.append(
                [
                    {
                        "label": label,
                        "first_word": first,
                        "last_word": last,
                        "edits": edits,
                        "words": words.encode("latin-1").decode("utf-8", "replace"),
                    }
                    for first, last, label, edits, words in each
                ]
            )
        cells = list(zip(*rows, strict=True)) if rows else [()] * 7
        columns = [batch.column(0)]
        columns += [pa.array(c, kind) for c, kind in zip(cells, kinds, strict=True)]
        columns.append(pa.array(listed, pa.list_(span)))
        return pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, schema)
