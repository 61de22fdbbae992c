import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from scrubline.llm import spelling


def plain_words(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    head = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[head:] == b[head + 1 :] or (len(a) == len(b) and a[head + 1 :] == b[head + 1 :])


def plain_variants(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 2 * words[w]:
            form[w] = best
    result = set()
    for w in words:
        root = w
        while root in form:
            root = form[root]
        result.add((w, form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None))
    return result


def test_vocabulary(spark):
    dice = random.Random(5)
    letters = "abcXYZéÀ×"
    runs = ["".join(dice.choice(letters) for _ in range(dice.randint(3, 9))) for _ in range(400)]
    # Digits, marks and letters beyond the range end a run.
    texts = [dice.choice(" 1_-日ß\n").join(dice.choices(runs, k=dice.randint(0, 200))) for _ in range(200)]
    rows = [(i if i % 50 else None, text) for i, text in enumerate(texts)] + [(7, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {r.word: r.n for r in spelling.vocabulary(docs).collect()} == plain_words(rows)


def vocabulary(seed, size, letters):
    dice = random.Random(seed)
    words = {"".join(dice.choice(letters) for _ in range(dice.randint(5, 7))): dice.randint(3, 99) for _ in range(size)}
    for w in list(words)[: size // 2]:
        at = dice.randrange(len(w))
        words[w[:at] + dice.choice(letters) + w[at + dice.randint(0, 1) :]] = dice.randint(3, 99)
    return {w: n for w, n in words.items() if len(w) >= 5}


def test_near_words_equal_all_pairs(spark):
    for seed, letters in enumerate(["ab", "abcdefghijkl", "aeiouàéîö÷ÿ", "abcdefghijklmnopqrstuvwxyz"]):
        words = vocabulary(seed, 400, letters)
        wanted = {(a, b) for a in words for b in words if a < b and one_edit(a, b)}
        df = spark.createDataFrame(list(words.items()), "word string, n long")
        # Every reduced form is crowded, some are, none is.
        for crowded in (0, 3, 10**6):
            found = spelling.near_words(df, crowded).collect()
            pairs = {(min(r.a, r.b), max(r.a, r.b)) for r in found}
            assert len(found) == len(wanted) and pairs == wanted
            assert all(r.a_n == words[r.a] and r.b_n == words[r.b] for r in found)


def test_variants_equal_brute_force(spark):
    dice = random.Random(9)
    words = list(vocabulary(11, 300, "abcdeé"))
    rows = [(i, " ".join(dice.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=300))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {tuple(r) for r in spelling.variants(docs).collect()}
    assert found == plain_variants(plain_words(rows))
    assert any(r[1] and r[2] != r[1] for r in found)


def test_chains_of_forms(spark):
    names = [f"chain{'abcdefghijklmnopqrst'[i]}" for i in range(20)]
    forms = spark.createDataFrame([(a, b) for a, b in zip(names, names[1:])], "word string, form string")
    assert {r.root for r in spelling._roots(forms).collect()} == {names[-1]}


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    wanted = plain_variants(plain_words(rows))
    # Repeated rows count again, and other columns do not matter.
    more = docs.withColumns({c: F.lit("x") for c in ("word", "n", "key")})
    assert {tuple(r) for r in spelling.variants(more).collect()} == wanted
    doubled = plain_words(rows + rows)
    assert {r.word: r.n for r in spelling.vocabulary(docs.union(docs)).collect()} == doubled
