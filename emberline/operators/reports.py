"""Grouped reports and top lists. Groups are counted on the map side first, so a hot group costs one row per task."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.config import LABELS
from emberline.functions.moments import AsOf, age_bucket, hours_ago
from emberline.functions.scoring import content_type, label_order
from emberline.operators.dedup import ordering
from emberline.operators.selection import with_label


def _count(name: str) -> Column:
    return F.count("*").alias(name)


def top_by(df: DataFrame, keys: Sequence[str], n: int, columns: Sequence[str] | None = None) -> DataFrame:
    """First `n` rows by `keys`; `id` breaks the last ties."""
    ranked = df.orderBy(*ordering([*keys, "id asc"])).limit(n)
    return ranked.select(*columns) if columns else ranked


def subreddit_summary(bronze: DataFrame) -> DataFrame:
    return (
        bronze.groupBy("subreddit")
        .agg(
            _count("posts"),
            F.avg("score").alias("avg_score"),
            F.max("score").alias("max_score"),
            F.avg("num_comments").alias("avg_comments"),
            F.avg("upvote_ratio").alias("avg_ratio"),
        )
        .orderBy(F.desc("posts"), "subreddit")
    )


def content_type_summary(bronze: DataFrame) -> DataFrame:
    return (
        bronze.groupBy(content_type().alias("content_type"))
        .agg(_count("count"), F.avg("score").alias("avg_score"))
        .orderBy(F.desc("count"), "content_type")
    )


def top_posts(bronze: DataFrame, n: int = 10) -> DataFrame:
    return top_by(
        bronze, ["score desc"], n, ["title", "subreddit", "score", "num_comments", "upvote_ratio", "created_ts"]
    )


def sample_posts(bronze: DataFrame, n: int = 10) -> DataFrame:
    return top_by(bronze, ["score desc"], n, ["id", "title", "subreddit", "score", "num_comments", "upvote_ratio"])


def archetype_preview(archetypes: DataFrame, n: int = 10) -> DataFrame:
    return top_by(
        archetypes,
        ["archetype_rank asc"],
        n,
        ["id", "title", "subreddit", "score", "num_comments", "viral_score", "content_type", "data_source"],
    )


def archetype_leaders(archetypes: DataFrame, n: int = 5) -> DataFrame:
    return top_by(
        archetypes, ["archetype_rank asc"], n, ["archetype_rank", "title", "subreddit", "viral_score", "content_type"]
    )


def archetypes_by(archetypes: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """Archetypes per value of `col`, most first; all values, or the `n` largest."""
    groups = (
        archetypes.groupBy(col)
        .agg(_count("count"), F.avg("score").alias("avg_score"), F.avg("viral_score").alias("avg_viral_score"))
        .orderBy(F.desc("count"), col)
    )
    return groups if n is None else groups.limit(n)


def archetypes_by_age(archetypes: DataFrame, as_of: AsOf) -> DataFrame:
    return (
        archetypes.groupBy(age_bucket(hours_ago(as_of)).alias("time_bucket"))
        .agg(_count("count"))
        .orderBy("time_bucket")
    )


def label_distribution(predicted: DataFrame) -> DataFrame:
    return order_labels(
        predicted.groupBy("viral_potential_label").agg(
            _count("count"),
            F.avg("score").alias("avg_score"),
            F.avg("viral_similarity_score").alias("avg_similarity"),
        )
    )


def order_labels(df: DataFrame) -> DataFrame:
    return df.orderBy(label_order())


def type_by_label(predicted: DataFrame) -> DataFrame:
    keys = ["content_type", "viral_potential_label"]
    return predicted.groupBy(*keys).agg(_count("count")).orderBy(*keys)


def high_by_subreddit(predicted: DataFrame, n: int = 15) -> DataFrame:
    return (
        with_label(predicted, "HIGH")
        .groupBy("subreddit")
        .agg(_count("high_potential_posts"), F.avg("viral_similarity_score").alias("avg_similarity"))
        .orderBy(F.desc("high_potential_posts"), "subreddit")
        .limit(n)
    )


def top_high_posts(predicted: DataFrame, n: int = 10) -> DataFrame:
    return top_by(
        with_label(predicted, "HIGH"),
        ["viral_similarity_score desc", "engagement_score desc"],
        n,
        [
            "id", "title", "subreddit", "score", "num_comments",
            "viral_similarity_score", "content_type", "processed_ts",
        ],
    )


def total_columns() -> list[Column]:
    """Posts per label, mean and maximum similarity. Counts are 0 on empty input."""
    label = F.col("viral_potential_label")
    names = dict(zip(LABELS, ("already_viral", "high_potential", "medium_potential", "low_potential")))
    return [
        _count("total_posts"),
        *[F.count_if(label == value).alias(name) for value, name in names.items()],
        F.avg("viral_similarity_score").alias("avg_similarity"),
        F.max("viral_similarity_score").alias("max_similarity"),
    ]


def prediction_totals(predicted: DataFrame) -> DataFrame:
    return predicted.agg(*total_columns())
