"""Viral score and the top archetypes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from emberline.config import Settings
from emberline.functions.moments import AsOf, instant
from emberline.functions.scoring import share_of_max
from emberline.operators.dedup import ordering

BEST_VIRAL = ("viral_score desc", "engagement_score desc", "score desc", "processed_ts desc", "data_source asc", "id asc")


def viral_maxima(df: DataFrame) -> DataFrame:
    return df.agg(
        F.max("score").alias("max_score"),
        F.max("num_comments").alias("max_comments"),
        F.max("num_awards").alias("max_awards"),
    )


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """The columns of a one-row frame on every row, as scalar subqueries: no join, nothing collected."""
    return df.withColumns({name: one_row.select(name).scalar() for name in one_row.columns})


def viral_scores(df: DataFrame, maxima: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    by_score, by_comments, by_awards, by_ratio = cfg.viral_weights
    return (
        attach_scalars(df, maxima)
        .withColumns(
            {
                "score_norm": share_of_max("score", F.col("max_score")),
                "comments_norm": share_of_max("num_comments", F.col("max_comments")),
                "awards_norm": share_of_max("num_awards", F.col("max_awards")),
            }
        )
        .withColumn(
            "viral_score",
            F.col("score_norm") * by_score
            + F.col("comments_norm") * by_comments
            + F.col("awards_norm") * by_awards
            + F.col("ratio") * by_ratio,
        )
        .drop(*maxima.columns)
    )


def top_archetypes(scored: DataFrame, n: int = Settings.top_n) -> DataFrame:
    """The `n` best posts with a dense rank. The unpartitioned window sees at most `n` rows."""
    order = ordering(BEST_VIRAL)
    return scored.orderBy(*order).limit(n).withColumn("archetype_rank", F.row_number().over(W.orderBy(*order)))


def stamp(df: DataFrame, as_of: AsOf, prefix: str) -> DataFrame:
    at = instant(as_of)
    return df.withColumns({f"{prefix}_date": F.to_date(at), f"{prefix}_timestamp": at})
