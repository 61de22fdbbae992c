import random
import re

import pytest

from scrubline.llm import licences

NOTICES = licences.Notices()


def plain_base(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places = [
        (i, label)
        for phrase, label in licences.PHRASES
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    return len(words), sorted(places)


def test_exact_phrases_are_those_of_brute_force(spark):
    dice = random.Random(0)
    parts = "GNU General Public License MIT license CC by BY-NC apache License, é日 \x00 x9 the. gnu".split()
    rows = [(i, " ".join(dice.choice(parts) for _ in range(dice.randint(0, 60)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.union(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr("doc_id + 1000", "text"))
    text = {r.doc_id: r.text for r in docs.collect()}
    found = licences.scan(docs).collect()
    assert len(found) == len(text)
    for r in found:
        n_words, places = plain_base(text[r.doc_id])
        starts = [i for i, _ in places]
        assert (r.n_words, r.n_base) == (n_words, len(places))
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))
        base = {label for _, label in places}
        assert r.base_labels == ",".join(sorted(base))
        labels = r.labels.split(",") if r.labels else []
        assert labels == sorted(set(labels)) and base <= set(labels)
        assert 0 <= r.score <= 1 and (r.score == 1 if base else True) and (r.score > 0) == bool(labels)
    assert sum(1 for r in found if r.n_base) > 50


def edited(words, edits, dice):
    text = list(words)
    for _ in range(edits):
        at = dice.randrange(1, len(text) - 1)
        kind = dice.randrange(3)
        if kind == 0 and text[at] != " ":
            text[at] = dice.choice("abcdefghijklmnopqrstuvwxyz")
        elif kind == 1 and text[at] != " ":
            del text[at]
        else:
            text.insert(at, dice.choice("abcdefghijklmnopqrstuvwxyz"))
    return "".join(text)


@pytest.mark.parametrize("words, label, edits", licences.NOTICES)
def test_notices_with_errors_are_found(words, label, edits):
    dice = random.Random(words)
    for _ in range(60):
        made = edited(words, dice.randint(0, edits), dice)
        text = f"Some words before. {made.title()}, and some after!"
        spans = [s for s in licences.scan_text(text, NOTICES)[1] if s.label == label]
        assert spans and min(s.edits for s in spans) <= edits
        best = min(spans, key=lambda s: s.edits)
        words_of = re.findall("[a-z]+", text.lower())
        assert " ".join(words_of[best.first_word : best.last_word + 1]) == best.text


@pytest.mark.parametrize(
    "text, found",
    [
        ("gnu genral public license and gnu general public license", [1, 0]),
        ("all right reserved all rights reserved", [1, 0]),
        ("mit licence mit license", [1, 0]),
        ("in gnu general public license gnu gneral public licens gnu genral public license", [0, 2, 1]),
        ("a all rights reserved", [0]),
    ],
)
def test_notices_side_by_side_are_all_found(text, found):
    spans = sorted(NOTICES.find(f" {text} "), key=lambda s: s.first_word)
    assert [s.edits for s in spans] == found
    words = text.split()
    assert all(" ".join(words[s.first_word : s.last_word + 1]) == s.text for s in spans)


def test_many_notices_with_errors_side_by_side():
    dice = random.Random(5)
    for words, label, edits in licences.NOTICES:
        made = [edited(words, dice.randint(0, min(edits, 1)), dice) for _ in range(30)]
        spans = [s for s in NOTICES.find(f" {' '.join(made)} ") if s.label == label]
        assert len(spans) >= len(made)


def test_clean_texts_are_left_alone(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").limit(3000).collect()]
    clean = [t for t in texts if not re.search("licen|rights|cc by", t, re.I)]
    assert len(clean) > 2000
    assert all(not licences.scan_text(t, NOTICES)[1] for t in clean)


def test_too_short_a_notice_for_its_errors():
    with pytest.raises(ValueError):
        licences.Notices([("mit", "mit", 3)])


def test_bytes_of_other_scripts_come_back(spark):
    docs = spark.createDataFrame([(1, "Apáche License")], "doc_id long, text string")
    found = licences.scan(docs).first()
    assert found.spans[0].words == "apáche license" and found.labels == "apache" and found.n_base == 0
