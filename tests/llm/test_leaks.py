import hashlib
import random

from pyspark.sql import functions as F

from emberline.llm import leaks
from emberline.llm.queries import op2_decontamination
from tests.llm.conftest import plain_words, rows_of, texts


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = plain_words(text)
        for s in range(max(1 if w else 0, len(w) - 9)):
            windows.setdefault(tuple(w[s : s + 10]), set()).add("null" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for size in {len(k) for k in windows}:
            for s in range(len(w) - size + 1):
                if (key := tuple(w[s : s + size])) in windows:
                    hit |= set(range(s, s + size))
                    found |= windows[key]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, len(hit) > 0))
    return sorted(out, key=str)


DOCS = [
    (1, "A b c"), (2, None), (3, ""), (4, "x a B C d a b c a b"), (4, "x a B C d a b c a b"), (None, "b c"),
    (5, "one two three four five six seven eight nine ten eleven é twelve"), (6, "é"), (7, "z " * 50_000 + "a b c"),
]
ITEMS = [
    (1, "a b c"), (2, "One, two three four five six seven eight nine ten eleven é"), (2, "b"), (2, "b"), (None, "a b"),
    (3, ""), (4, None), (5, "é"),
]


def test_small_cases(spark):
    docs, items = texts(spark, DOCS), texts(spark, ITEMS, "item_id long, text string")
    assert rows_of(leaks.contamination_report(docs, items)) == brute(DOCS, ITEMS)


def test_blocks_give_the_same(spark):
    docs, items = texts(spark, DOCS), texts(spark, ITEMS, "item_id long, text string")
    one = leaks.contamination(docs, items)
    many = leaks.contamination(docs, items, block=3)
    assert rows_of(one) == rows_of(many)


def test_random_texts(spark):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60)))) for i in range(60)]
    items = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 14)))) for i in range(15)]
    got = leaks.contamination_report(texts(spark, docs), texts(spark, items, "item_id long, text string"))
    assert rows_of(got) == brute(docs, items)


def test_empty_tables_and_clashing_columns(spark):
    docs = texts(spark, [(1, "a b c", "x", 7)], "doc_id long, text string, hits string, n_words int")
    none = texts(spark, [], "item_id long, text string")
    row = leaks.contamination(docs, none).first()
    assert (row["n_words"], row["hits"], row["items"]) == (3, [], [])
    assert leaks.contamination(docs.limit(0), none).count() == 0
    assert leaks.contamination(docs, texts(spark, ITEMS, "item_id long, text string")).first()["items"] == ["1", "2", "null"]


def test_registered_query(spark, documents):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()
    docs = documents.select("doc_id", "text").collect()
    got = op2_decontamination(spark, "/root/testdata/sf0.001")
    assert rows_of(got) == brute([tuple(r) for r in docs], [tuple(r) for r in items])
    assert got.filter(F.col("contaminated")).count() > 0
