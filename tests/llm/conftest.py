import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
EMBEDDINGS = "vec_id long, embedding array<float>, label int"
PAGES = "page_id long, url string, html string"
LABELS = "doc_id long, quality int, toxic int"
CONVERSATIONS = "conv_id long, turn long, role string, text string"
SCHEMAS = {
    "documents": DOCUMENTS,
    "benchmark": "item_id long, text string",
    "embeddings": EMBEDDINGS,
    "pages": PAGES,
    "labels": LABELS,
    "conversations": CONVERSATIONS,
}

# Names that operators use for themselves or return.
CLASHING = (
    "size shard slot score predicted held_out fingerprint fp component_id n_links kept rank query_id range"
    " one before_one target taken position dice key cid copies list block host page tokens _score _position"
    " n_words failed failed_rules word n form root weight falling id no_id"
).split()

LONG = "the quick brown fox. " * 20_000
PAGE = "<html><body><nav><a href=x>menu</a></nav><article><p>one &amp; two</p><p>three</article></body></html>"
NAN, INF = float("nan"), float("inf")

HARD = {
    "documents": [
        (1, "a b c d e", "en", "x", 9),
        (1, "a b c d e", "en", "x", 9),
        (2, "a b c d e", "en", "x", 9),
        (3, None, None, None, None),
        (4, "", "en", "", 0),
        (None, "Released under the MIT License.", "en", "x", 1),
        (None, None, None, None, None),
        (5, " \n\t ", "en", "y", 4),
        (6, LONG, "en", "y", 1),
        (7, "é ▁ 日本 \U0001f600 \x00 �", "xx", "z", 1),
        (20, "| ## %% !!", "en", None, 1),
        (-5, "MIT LICENSE", "en", "x", 1),
    ],
    "embeddings": [
        (0, [1.0, 2.0], 1),
        (0, [1.0, 2.0], 1),
        (50, [2.0, 4.0], 1),
        (100, [1.0, 2.0], None),
        (3, None, 1),
        (4, [0.0, 0.0], 1),
        (5, [NAN, 1.0], 1),
        (6, [None, 1.0], 1),
        (7, [INF, 1.0], 1),
        (8, [], 1),
        (9, [1.0, 2.0, 3.0], 1),
        (None, [1.0, 2.0], 1),
        (150, [-1.0, -2.0], 2),
        (10, [1.0, 2.0], 2),
    ],
    "pages": [
        (1, "http://a.example/x", PAGE),
        (1, "http://a.example/x", PAGE),
        (2, "http://a.example/y", PAGE.replace("three", "four")),
        (3, None, PAGE),
        (4, "http://a.example/z", None),
        (5, "", ""),
        (None, "no url", "<p>" + "word " * 50_000),
        (6, "http://b.example", "<b <i x='>unclosed <!-- a"),
    ],
    "benchmark": [(1, "the quick brown fox"), (1, "the quick brown fox"), (2, None), (None, "")],
    "labels": [(1, 1, 0), (1, 0, 0), (2, 0, 1), (6, 1, None), (20, 0, 0), (None, 1, 1), (7, None, 0), (99, 1, 0), (4, 3, 0)],
    "conversations": [
        (1, 0, "user", "hi"),
        (1, 1, "assistant", "yes"),
        (1, 1, "assistant", "yes"),
        (1, None, None, None),
        (None, 0, "tool", ""),
        (None, 1, "system", None),
        (2, 5, "assistant", LONG),
        (3, 0, "system", "<|user|> be good"),
    ],
}


def stored(spark, folder, rows, clashing=False):
    """Tables written below ``folder``, as the queries read them."""
    from pyspark.sql import functions as F

    for name, schema in SCHEMAS.items():
        df = spark.createDataFrame(rows.get(name, []), schema)
        if clashing:
            df = df.withColumns({c: F.lit("other") for c in CLASHING if c not in df.columns})
        df.repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def no_rows(spark, tmp_path_factory):
    return stored(spark, tmp_path_factory.mktemp("none"), {})


@pytest.fixture(scope="session")
def hard_rows(spark, tmp_path_factory):
    return stored(spark, tmp_path_factory.mktemp("hard"), HARD, clashing=True)
