"""Likeness of a post to the archetype profile."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.config import Settings
from emberline.functions.scoring import already_viral, label_columns
from emberline.functions.moments import AsOf
from emberline.operators.ranking import attach_scalars, stamp
from emberline.operators.selection import exclude_ids, recent
from emberline.schemas import PREDICTION


def archetype_profile(archetypes: DataFrame) -> DataFrame:
    """One row of averages."""
    averaged = {
        "avg_score": "score",
        "avg_comments": "num_comments",
        "avg_engagement": "engagement_score",
        "avg_text_length": "text_length",
        "avg_title_length": "title_length",
        "avg_ratio": "ratio",
    }
    return archetypes.agg(*[F.avg(column).alias(name) for name, column in averaged.items()])


def archetype_frequencies(archetypes: DataFrame, col: str, top_n: int = Settings.top_n) -> DataFrame:
    """Count and share per value. The share is of `top_n`, however many archetypes there are."""
    return (
        archetypes.groupBy(col)
        .agg(F.count("*").alias("n"))
        .withColumn("share", F.col("n") / F.lit(float(top_n)))
    )


def attach_frequency(df: DataFrame, frequencies: DataFrame, col: str) -> DataFrame:
    """`<col>_share` on every row: 0 for a value the archetypes lack; null matches null."""
    side = frequencies.select(F.col(col).alias("_value"), F.col("share").alias("_share"))
    return (
        df.join(side, F.col(col).eqNullSafe(F.col("_value")), "left")
        .withColumn(f"{col}_share", F.coalesce("_share", F.lit(0.0)))
        .drop("_value", "_share")
    )


def _known(term: Column) -> Column:
    """A term that cannot be computed (null feature, average not above 0) counts nothing."""
    return F.coalesce(term, F.lit(0.0))


def _against(value: str, mean: Column, closeness) -> Column:
    """`closeness(value, mean)` where both are known and the mean is above 0.

    The null test is explicit because `least` and `greatest` skip nulls.
    """
    return F.when(F.col(value).isNotNull() & (mean > 0), closeness(F.col(value), mean))


def similarity(
    df: DataFrame,
    profile: DataFrame,
    subreddits: DataFrame,
    content_types: DataFrame,
    cfg: Settings = Settings(),
) -> DataFrame:
    """Add `viral_similarity_score`: a weighted sum of five likenesses, at most 1, not bounded below."""

    def up_to_mean(value: Column, mean: Column) -> Column:
        return F.least(value / mean, F.lit(1.0))

    def near_mean(value: Column, mean: Column) -> Column:
        return F.greatest(F.lit(0.0), F.lit(1.0) - F.abs(value - mean) / mean)

    means = profile.select("avg_engagement", "avg_text_length", "avg_ratio")
    wide = attach_scalars(df, means)
    wide = attach_frequency(attach_frequency(wide, subreddits, "subreddit"), content_types, "content_type")
    likeness = [
        F.col("subreddit_share"),
        F.col("content_type_share"),
        _known(_against("engagement_score", F.col("avg_engagement"), up_to_mean)),
        _known(_against("text_length", F.col("avg_text_length"), near_mean)),
        _known(_against("ratio", F.col("avg_ratio"), up_to_mean)),
    ]
    total = reduce(Column.__add__, [part * weight for part, weight in zip(likeness, cfg.similarity_weights)])
    return wide.withColumn("viral_similarity_score", F.least(total, F.lit(1.0))).drop(
        *means.columns, "subreddit_share", "content_type_share"
    )


def candidates(silver: DataFrame, archetypes: DataFrame, as_of: AsOf, cfg: Settings = Settings()) -> DataFrame:
    """Recent stream posts that are no archetypes. Every stored row is scored: the intake stores an id once."""
    return exclude_ids(recent(silver, as_of, cfg.lookback_hours, by_day=True), archetypes)


def viral_flag(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    return df.withColumn("is_already_viral", already_viral(cfg))


def score_posts(posts: DataFrame, archetypes: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Similarity and labels of `posts`. `archetypes` is used three times: pass a stored table."""
    scored = similarity(
        viral_flag(posts, cfg),
        archetype_profile(archetypes),
        archetype_frequencies(archetypes, "subreddit", cfg.top_n),
        archetype_frequencies(archetypes, "content_type", cfg.top_n),
        cfg,
    )
    return label_columns(scored, cfg)


def prediction_rows(scored: DataFrame, as_of: AsOf) -> DataFrame:
    return stamp(scored, as_of, "prediction").select(*PREDICTION.names)
