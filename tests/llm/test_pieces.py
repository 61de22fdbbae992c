import functools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scrubline.llm import pieces

SMALL = [("<unk>", 0), ("a", -3), ("b", -3), ("ab", -4), ("abc", -9), ("c", -2), ("▁", -1), ("▁a", -2), ("bc", -5), ("ca", -5)]


def small():
    words = [p for p, _ in SMALL] + [f"<0x{b:02X}>" for b in range(256)]
    plain = [i not in (0,) and i < len(SMALL) for i in range(len(words))]
    return pieces.Vocabulary(
        words, [float(s) for _, s in SMALL] + [0.0] * 256, list(range(len(SMALL), len(SMALL) + 256)), plain
    )


def plain_best(text, vocabulary):
    """All segmentations: the highest score, then the longer last piece."""
    score = {p: vocabulary.scores[i] for i, p in enumerate(vocabulary.pieces) if vocabulary.plain[i]}
    number = {p: i for i, p in enumerate(vocabulary.pieces) if vocabulary.plain[i]}
    unknown = min(score.values()) - pieces.UNKNOWN_PENALTY

    @functools.cache
    def best(end):
        if end == 0:
            return 0.0, ()
        ways = []
        for start in range(end):
            piece = text[start:end]
            if piece in score:
                ways.append((best(start)[0] + score[piece], end - start, best(start)[1] + (number[piece],)))
            elif end - start == 1:
                ids = tuple(vocabulary.bytes_at[b] for b in piece.encode("utf-8", "replace"))
                ways.append((best(start)[0] + unknown, 0, best(start)[1] + ids))
        top = max(ways, key=lambda w: (w[0], w[1]))
        return top[0], top[2]

    return list(best(len(text))[1])


@pytest.fixture(scope="module")
def real():
    return pieces.Codec(pieces.load())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abc▁xé", max_size=14))
def test_viterbi_on_a_small_vocabulary(text):
    vocabulary = small()
    assert pieces.Codec(vocabulary).viterbi(text) == plain_best(text, vocabulary)


@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet="thean ingüß.,\n日!?0", max_size=40))
def test_words_give_what_the_whole_text_gives(real, text):
    blanked = (" " + text).replace(" ", pieces.BLANK) if text else ""
    whole = plain_best(blanked, real.vocabulary)
    assert np.frombuffer(real.encode(text), "<i4").tolist() == whole


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60))
def test_round_trip(real, text):
    assert real.decode(np.frombuffer(real.encode(text), "<i4").tolist()) == text


@pytest.mark.parametrize("text", ["", " ", "  lead", "tail  ", "▁", "a ▁▁ b", "\x00\n\t\r", "\U0001f600" * 3])
def test_round_trip_of_odd_texts(real, text):
    assert real.decode(np.frombuffer(real.encode(text), "<i4").tolist()) == text


def test_cache_is_bounded(real, monkeypatch):
    monkeypatch.setattr(pieces, "MOST_WORDS", 3)
    real.encode("one two three four five")
    real.tidy()
    assert len(real._words) == 0
    assert real.decode(np.frombuffer(real.encode("one two"), "<i4").tolist()) == "one two"


def test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = pieces.encoded(docs)
    assert found.where("not round_trip or n_ids != size(ids)").count() == 0
    back = pieces.decoded(found)
    assert back.exceptAll(docs.select("doc_id", "text")).count() == 0 and back.count() == docs.count()
    null = pieces.decoded(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).first()
    assert null.text is None
