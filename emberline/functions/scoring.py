"""Engagement, virality, similarity and label expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.config import LABELS, Settings


def content_type(is_video: str = "is_video", is_self: str | Column = "is_self") -> Column:
    own_text = F.col(is_self) if isinstance(is_self, str) else is_self
    return F.when(F.col(is_video), "video").when(own_text, "text").otherwise("link")


def engagement_features(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    by_score, by_comments, by_awards = cfg.engagement_weights
    return df.withColumns(
        {
            "engagement_score": F.col("score") * by_score
            + F.col("num_comments") * by_comments
            + F.col("num_awards") * by_awards,
            "comment_to_score_ratio": F.when(
                F.col("score") > 0, F.col("num_comments") / F.col("score")
            ).otherwise(F.lit(0.0)),
        }
    )


def share_of_max(value: str, maximum: Column) -> Column:
    """value / maximum; 0 where the maximum gives no scale."""
    return F.when(maximum > 0, F.col(value) / maximum).otherwise(F.lit(0.0))


def label_columns(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """`viral_potential_label` and `is_viral` from the similarity and the `is_already_viral` flag."""
    done, high, medium, low = LABELS
    similar = F.col("viral_similarity_score")
    return df.withColumns(
        {
            "viral_potential_label": F.when(F.col("is_already_viral"), done)
            .when(similar >= cfg.high, high)
            .when(similar >= cfg.medium, medium)
            .otherwise(low),
            "is_viral": F.coalesce(F.col("is_already_viral") | (similar >= cfg.high), F.lit(False)),
        }
    )


def already_viral(cfg: Settings = Settings()) -> Column:
    return F.coalesce(F.col("score") >= cfg.viral_cutoff, F.lit(False))


def label_order(label: str = "viral_potential_label") -> Column:
    """Position of a label in reports; unknown labels sort with the last one."""
    place = F.array_position(F.array(*map(F.lit, LABELS)), F.col(label))
    return F.when(place > 0, place).otherwise(len(LABELS))
