"""Nulls, blanks, very long texts, ties, repeated rows, empty tables, extra columns: every query."""

import pytest

from scrubline.llm.queries import QUERIES
from tests.llm.conftest import HARD, LONG


def run(spark, folder, start):
    name = next(n for n in QUERIES if n.startswith(start + "_"))
    return [r.asDict(True) for r in QUERIES[name](spark, folder).collect()]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, no_rows, name):
    result = QUERIES[name](spark, no_rows)
    assert result.collect() == []
    assert len(result.columns) == len(set(result.columns)) > 2


def test_pages(spark, hard_rows):
    found = run(spark, hard_rows, "op1")
    assert sorted((r["page_id"] or 0, r["text"][:10], r["n_chars"]) for r in found) == [
        (0, "word word ", 249_999),
        (1, "one & two\n", 15),
        (1, "one & two\n", 15),
        (2, "one & two\n", 14),
        (3, "one & two\n", 15),
        (4, "", 0),
        (5, "", 0),
        (6, "unclosed", 8),
    ]


def test_top_k(spark, hard_rows):
    found = run(spark, hard_rows, "op2")
    # 0 repeats and is asked once; 4, 8, 9, 10, 50, 100 and 150 are candidates.
    assert sorted({r["query_id"] for r in found}) == [0, 50, 100, 150]
    best = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == 50)
    one = 256 * 256
    assert best == [(1, 0, 10 * one), (2, 0, 10 * one), (3, 9, 10 * one), (4, 10, 10 * one), (5, 100, 10 * one)]
    worst = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == 150)
    assert worst[:3] == [(1, 4, 0), (2, 8, 0), (3, 0, -5 * one)]


def test_vectors(spark, hard_rows):
    found = sorted(
        ((r["vec_id"] is None, r["vec_id"]), r["n_links"], r["component_id"], r["kept"])
        for r in run(spark, hard_rows, "op5")
    )
    assert len(found) == len(HARD["embeddings"])
    by_id = {r[0][1]: r[1:] for r in found}
    assert by_id[0] == (2, 0, True) and by_id[50] == (2, 0, False)
    assert by_id[None] == (0, None, None)
    assert all(by_id[i] == (0, i, True) for i in (100, 3, 4, 5, 6, 7, 8, 9, 150, 10))


def test_mixing(spark, hard_rows):
    found = run(spark, hard_rows, "op6")
    assert len(found) == len(HARD["documents"])
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in found)
    assert {r["size"] for r in found if r["doc_id"] in (3, 4, 5)} == {0}
    # x: 5 + 5 + 5 + 5 + 2 words; "": none; y: the long text; z: 6 words; no source: 4 words.
    assert {r["source_size"] for r in found} == {22, 0, len(LONG.split()), 6, 4}
    # Without a source, the two texts without words and the one of four words.
    assert sum(r["taken"] for r in found if r["source_size"] == 4) == round(
        next(r["target"] for r in found if r["source_size"] == 4)
    )


def test_shards(spark, hard_rows):
    found = run(spark, hard_rows, "op8")
    assert len(found) == len(HARD["documents"])
    for shard in {r["shard"] for r in found}:
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert {(r["size"], r["text_crc32"]) for r in found if r["doc_id"] in (3, 4)} == {(1, 0)}


def test_quality(spark, hard_rows):
    found = run(spark, hard_rows, "op9")
    assert len(found) == len(HARD["documents"])
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)


def test_simhash(spark, hard_rows):
    found = sorted((r["doc_id"] or 0, r["fingerprint"], r["component_id"]) for r in run(spark, hard_rows, "op10"))
    assert len(found) == len(HARD["documents"])
    by_id = {r[0]: r for r in found}
    assert by_id[2][2] == 1 and by_id[4][1:] == ("0" * 16, 3) and by_id[5][2] == 3
    # Without an id: one text of its own, whose component has no name, and one without words.
    assert {r[2] for r in found if r[0] == 0} == {None, 3} and by_id[-5][2] == -5


def test_host_rules(spark, hard_rows):
    found = run(spark, hard_rows, "op11")
    assert len(found) == len(HARD["documents"])
    by_id = {r["doc_id"]: r for r in found}
    # The long text is one sentence over and over; all others are too short.
    assert all(r["base_failed"] and not r["kept"] for r in found)
    assert by_id[6]["n_words"] == by_id[6]["n_repeat_words"] == len(LONG.split()) and by_id[6]["failed_rules"] == "repeats"
    assert (by_id[3]["n_words"], by_id[3]["word_chars"], by_id[3]["host"]) == (0, 0, None)


def test_spelling(spark, hard_rows):
    found = {r["word"]: r for r in run(spark, hard_rows, "op12")}
    assert found["quick"] == {"word": "quick", "form": None, "root": "quick", "n": 20_000, "n_near": 0, "form_n": None}
    assert set(found) == {"quick", "brown"}


def test_resampling(spark, hard_rows):
    found = run(spark, hard_rows, "op13")
    assert len(found) == len(HARD["documents"])
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[6]["n_features"] == 2 * len(LONG.split()) - 1
    # A quarter of one text with enough words is none.
    assert all(r["rank"] is None for r in found) and by_id[3]["weight"] == 0


def test_licences(spark, hard_rows):
    found = {r["doc_id"]: r for r in run(spark, hard_rows, "op4") if r["doc_id"] is not None}
    assert found[-5]["labels"] == found[-5]["base_labels"] == "mit" and found[-5]["score"] == 1.0
    assert (found[3]["n_words"], found[3]["labels"], found[3]["first_word"]) == (0, "", None)
    assert found[6]["n_words"] == len(LONG.split())


def test_pieces(spark, hard_rows):
    found = run(spark, hard_rows, "op7")
    assert len(found) == len(HARD["documents"])
    assert all(r["round_trip"] and r["n_ids"] == len(r["ids"]) for r in found)


def test_chat(spark, hard_rows):
    found = run(spark, hard_rows, "op3")
    lost = [r for r in found if r["action"] != "insert"]
    assert len(lost) == len(HARD["conversations"])
    chat = "".join(r["rendered"] for r in sorted((r for r in found if r["conv_id"] == 3), key=lambda r: r["seq"]))
    assert chat == "<|system|>\n< |user|> be good<|end|>\n<|user|>\n<|end|>\n<|assistant|>\n<|end|>\n"


def test_pipeline_stages(spark, hard_rows, no_rows):
    import corpus_pipeline

    for folder in (hard_rows, no_rows):
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        names = docs.columns
        for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, folder)
            if at < len(corpus_pipeline.STAGES) - 1:
                assert docs.columns == names
        assert docs.count() > 0 or folder == no_rows


def test_one_of_each_group_stays(spark, hard_rows):
    from scrubline.llm import simhash

    kept = simhash.keep_one(spark.read.parquet(f"{hard_rows}/documents.parquet"))
    assert sorted((r.doc_id for r in kept.collect() if r.doc_id is not None)) == [-5, 1, 3, 6, 7, 20]
