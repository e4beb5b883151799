"""Text columns of a post."""

from string import ascii_letters, digits

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: every character but ASCII letters, digits and space becomes one space; runs are kept.
# Single characters make one table lookup; a named class or ranges beside the space are several tests a character.
NOT_PLAIN = f"[^{ascii_letters}{digits} ]"


def clean_text(title: Column, body: Column) -> Column:
    joined = F.concat_ws(" ", title, F.coalesce(body, F.lit("")))
    return F.trim(F.lower(F.regexp_replace(joined, NOT_PLAIN, " ")))


def clip(text: Column, limit: int | None) -> Column:
    """The first `limit` characters; the whole text if there is no limit."""
    return text if limit is None else F.substring(text, 1, limit)


def text_features(df: DataFrame) -> DataFrame:
    return df.withColumn("text_combined", clean_text(F.col("title"), F.col("selftext"))).withColumns(
        {"text_length": F.length("text_combined"), "title_length": F.length("title")}
    )


def embedding_text(title: str = "title", body: str = "selftext") -> Column:
    return F.concat_ws(" | ", title, body)


def tokens(text: Column) -> Column:
    """Lower-case words split at each single white space: runs yield empty words, trailing ones are dropped."""
    words = F.split(F.lower(text), r"\s")
    filled = F.transform(words, lambda word, at: F.when(word != "", at + 1).otherwise(0))
    return F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(F.slice(words, 1, F.array_max(filled)))
