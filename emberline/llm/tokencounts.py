"""Token counts by a digest cache: texts are encoded once per content and tokenizer version, ever.

The cache is a table of (content digest, tokenizer version, counts). A run joins the digests of its texts to it,
encodes the distinct misses alone, appends them, and reads every count from the cache.
"""

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from emberline.llm.texts import chunks, reach_package

CACHE = "digest binary, tokenizer string, n_tokens long"
SPECIAL = "<|endoftext|>"
#: Texts of these characters are split alike by both libraries: their classes are older than either's tables.
_SETTLED = re.compile("[\u0000-ɏͰ-ͷ΄-ϿЀ-ҁҊ-ԓ‐-‧‰-⁞€一-龥]*")


def digest(text: str = "text"):
    """SHA-256 of the content as it is counted: null as the empty text, nothing else changed."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def version(path: str) -> str:
    """Digest of the tokenizer's file: another file is another version."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


@lru_cache(maxsize=4)
def _counter(json_path: str, ranks_path: str | None, pattern: str | None):
    """A function from a text to its number of tokens.

    The rank file holds the same merges; its encoder is several times faster. Characters whose class may differ
    between the libraries' Unicode tables go to the library that the counts are defined by.
    """
    from tokenizers import Tokenizer

    defined = Tokenizer.from_file(json_path)

    def slow(text: str) -> int:
        return len(defined.encode(text, add_special_tokens=False).ids)

    if ranks_path is None:
        return slow
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks_path, "rb"))}
    quick = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def fast(text: str) -> int:
        if not text.isascii() and not _SETTLED.fullmatch(text):
            return slow(text)
        parts = text.split(SPECIAL)
        return len(parts) - 1 + sum(len(quick.encode_ordinary(p)) for p in parts)

    return fast


def _first_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose digest this task has not seen lately; repeats that slip through are folded later.

    Copies of one text shrink to about one row per task before the shuffle. The memory of seen digests is
    renewed when full, so that it stays bounded.
    """
    seen: set[bytes] = set()
    for batch in batches:
        keep = []
        for key in batch.column(0).to_pylist():
            keep.append(key not in seen)
            if len(seen) > 1_000_000:
                seen.clear()
            seen.add(key)
        yield batch.filter(pa.array(keep, pa.bool_()))


def _encoder(json_path: str, ranks_path: str | None, pattern: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(json_path, ranks_path, pattern)
        last = None
        for batch in batches:
            for at, texts in chunks(batch.column(1)):
                keys, sums = [], []
                for key, text in zip(batch.column(0).slice(at, len(texts)).to_pylist(), texts.to_pylist(), strict=True):
                    if key != last:  # sorted by digest: copies are neighbours
                        keys.append(key)
                        sums.append(count(text or ""))
                    last = key
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sums, pa.int64())], names=["digest", "n_tokens"])

    return run


def read_cache(spark, cache: str) -> DataFrame | None:
    """The cache, or None if nothing was stored yet."""
    try:
        return spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def fill_cache(docs: DataFrame, cache: str, json_path: str, ranks_path: str | None = None, pattern: str | None = None) -> None:
    """Encode each distinct text that the cache lacks for this tokenizer, and append it."""
    spark, mark = docs.sparkSession, version(json_path)
    reach_package(spark)
    texts = docs.select(digest().alias("digest"), "text")
    stored = read_cache(spark, cache)
    misses = texts.mapInArrow(_first_in_task, "digest binary, text string")
    if stored is not None:
        misses = misses.join(stored.filter(F.col("tokenizer") == mark).select("digest"), "digest", "left_anti")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A task holds one batch: sorting brings the copies of a text together without a table of digests.
    counted = misses.repartition(width, "digest").sortWithinPartitions("digest").mapInArrow(
        _encoder(json_path, ranks_path, pattern), "digest binary, n_tokens long"
    )
    counted.select("digest", F.lit(mark).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)


def token_counts(
    docs: DataFrame, cache: str, json_path: str, ranks_path: str | None = None, pattern: str | None = None, limit: int = 512
) -> DataFrame:
    """Per row of `docs`: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Null and empty texts have no byte and no token. Repeated rows each come back. A digest may be stored twice if
    two runs append at once: both counts are equal and one is read. An empty table gives an empty result. Other
    columns are not looked at.
    """
    fill_cache(docs, cache, json_path, ranks_path, pattern)
    spark = docs.sparkSession
    stored = spark.read.schema(CACHE).parquet(cache).filter(F.col("tokenizer") == version(json_path))
    counts = stored.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text").cast("long"), F.lit(0)).cast("long").alias("n_bytes"), digest().alias("digest"))
    return rows.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
