import public_tokenizers as files
import pytest
from tokenizers import Tokenizer

from emberline.llm import tokencounts
from emberline.llm.queries import op10_token_counts
from emberline.session import scratch_path
from tests.llm.conftest import texts

JSON, RANKS = files.path("byte_bpe_50k.json"), files.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(JSON)
    return lambda t: len(tokenizer.encode(t or "", add_special_tokens=False).ids)


def test_quick_counts_equal_the_library(library):
    count = tokencounts._counter(JSON, RANKS, files.PATTERN)
    for code in [*range(0x600), *range(0x2000, 0x2070), 0x3000, 0x4E00, 0xAC00, 0x1F642, 0x10FFFF]:
        if not 0xD800 <= code < 0xE000:
            text = f"a{chr(code)}b {chr(code)} 1{chr(code)}2{chr(code)}{chr(code)}\n{chr(code)} 's"
            assert count(text) == library(text), hex(code)
    for text in ("", " ", "a  b\t\n\n c", "x<|endoftext|>y <|endoftext|><|endoftext|>", "<|endoftext|", "don't I'LL we've", "日本語 mixed été"):
        assert count(text) == library(text)


ROWS = [(1, None), (2, ""), (3, "the same"), (4, "the same"), (3, "the same"), (5, "é<|endoftext|>"), (None, "w " * 60_000)]


def test_counts_and_limits(spark, library):
    cache = scratch_path(spark, "cache")
    got = tokencounts.token_counts(texts(spark, [(*r, 9) for r in ROWS], "doc_id long, text string, n_tokens int"), cache, JSON, RANKS, files.PATTERN)
    wanted = [(d, len((t or "").encode()), library(t), library(t) > 512) for d, t in ROWS]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(wanted, key=str)


def test_only_misses_are_encoded(spark):
    cache = scratch_path(spark, "cache")
    tokencounts.fill_cache(texts(spark, ROWS[:4]), cache, JSON)
    first = tokencounts.read_cache(spark, cache)
    assert first.count() == 2  # null is counted as the empty text
    tokencounts.fill_cache(texts(spark, ROWS), cache, JSON)
    assert tokencounts.read_cache(spark, cache).count() == 4
    tokencounts.fill_cache(texts(spark, ROWS), cache, JSON)
    assert tokencounts.read_cache(spark, cache).count() == 4
    tokencounts.fill_cache(texts(spark, ROWS[:3]), cache, files.path("word_bpe_49k.json"))
    assert tokencounts.read_cache(spark, cache).groupBy("tokenizer").count().count() == 2


def test_a_stored_count_is_used(spark):
    cache = scratch_path(spark, "cache")
    docs = texts(spark, [(1, "abc def")])
    row = docs.select(tokencounts.digest().alias("digest")).first()
    spark.createDataFrame([(row["digest"], tokencounts.version(JSON), 77)], tokencounts.CACHE).write.parquet(cache)
    assert tokencounts.token_counts(docs, cache, JSON).first()["n_tokens"] == 77


def test_empty_table(spark):
    assert tokencounts.token_counts(texts(spark, []), scratch_path(spark, "cache"), JSON).count() == 0


def test_registered_query(spark, documents, library):
    rows = {r["doc_id"]: r for r in op10_token_counts(spark, "/root/testdata/sf0.001").collect()}
    assert all(rows[r["doc_id"]]["n_tokens"] == library(r["text"]) for r in documents.collect())
