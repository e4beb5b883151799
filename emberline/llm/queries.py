"""Registered queries of this subpackage; their SQL is in `oracle.py`."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.llm import htmltext, langid, leaks, lexical, mixing, neardup, packing, personal, prefixes, repeats
from emberline.llm import quality as rules
from emberline.llm import secrets, tokencounts
from emberline.llm.encoding import Definition
from emberline.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _third(docs: DataFrame) -> DataFrame:
    """`docs` with held_out: documents that the language model may not learn from. One without an id is not held out."""
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    return docs.withColumn("held_out", F.coalesce(held, F.lit(False)))


def language_model(docs: DataFrame) -> langid.Model:
    return langid.train(_third(docs).filter(~F.col("held_out")))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(_third(docs).drop("lang"), language_model(docs))
    return found.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats_report(table(spark, sf_dir, "documents"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.personal_report(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.quality(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run fills a cache of its own: nothing of an earlier run is used."""
    import public_tokenizers as files

    return tokencounts.token_counts(
        table(spark, sf_dir, "documents"),
        scratch_path(spark, "token-cache"),
        files.path("byte_bpe_50k.json"),
        files.path("byte_bpe_50k.tiktoken"),
        files.PATTERN,
    )


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as files

    tokenizer = Definition.read(files.path("byte_bpe_50k.json"), files.path("byte_bpe_50k.tiktoken"), files.PATTERN)
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_trie(prefixes.branched(table(spark, sf_dir, "conversations")))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_decontamination,
        op3_substring_dedup,
        op4_source_mix,
        op5_main_text,
        op6_personal_data,
        op7_secret_scan,
        op8_quality_rules,
        op9_ngram_jaccard,
        op10_token_counts,
        op11_packing,
        op12_prefix_trie,
        op13_lexical_search,
    )
}
