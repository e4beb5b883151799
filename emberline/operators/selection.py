"""Recency and quality filters with their data-dependent fallbacks."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.config import Criteria, Settings
from emberline.functions.moments import AsOf, hours_before


def recent(df: DataFrame, as_of: AsOf, hours: int = Settings.lookback_hours, by_day: bool = False) -> DataFrame:
    """Rows of the last `hours`.

    `by_day` is for stream posts, whose `processing_date` is the day of `processed_ts`: a bound on it drops no row, and
    on a table that is partitioned by it the older folders are not read. A hot post has the day of its batch there.
    """
    since = hours_before(as_of, hours)
    rows = df.filter(F.col("processed_ts") >= since)
    return rows.filter(F.col("processing_date") >= F.to_date(since)) if by_day else rows


def lowest_tier(df: DataFrame, tier: Column) -> DataFrame:
    """Rows of the lowest tier that has any; rows without a tier go.

    The lowest tier is a scalar subquery, so the choice is part of the plan. `df` is read twice: pass a
    staged table, of which the first read touches the tier columns alone.
    """
    tiered = df.withColumn("_tier", tier)
    chosen = tiered.agg(F.min("_tier").alias("_tier")).scalar()
    return tiered.filter(F.col("_tier") == chosen).drop("_tier")


def recent_or_widen(
    df: DataFrame,
    as_of: AsOf,
    hours: Sequence[int] = (Settings.lookback_hours, Settings.widened_hours),
) -> DataFrame:
    """The shortest of the windows that is not empty."""
    windows = [F.when(F.col("processed_ts") >= hours_before(as_of, h), at) for at, h in enumerate(hours)]
    return lowest_tier(recent(df, as_of, max(hours)), F.coalesce(*windows))


def meets(bounds: Criteria, gone_authors: Sequence[str] = Settings.gone_authors) -> Column:
    """Null in any tested column fails."""
    tests = [
        F.col("score") >= bounds.min_score,
        F.col("num_comments") >= bounds.min_comments,
        ~F.col("author").isin(*gone_authors),
        F.col("text_length") > bounds.longer_than,
    ]
    return reduce(Column.__and__, tests)


def viral(
    df: DataFrame,
    min_score: int = 50,
    min_comments: int = 5,
    min_len: int = 10,
    gone_authors: Sequence[str] = Settings.gone_authors,
) -> DataFrame:
    return df.filter(meets(Criteria(min_score, min_comments, min_len), gone_authors))


def viral_tiered(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Posts of the strictest criteria that any post meets."""
    tiers = [F.when(meets(bounds, cfg.gone_authors), at) for at, bounds in enumerate(cfg.tiers)]
    return lowest_tier(df, F.coalesce(*tiers))


def with_label(df: DataFrame, label: str) -> DataFrame:
    return df.filter(F.col("viral_potential_label") == label)


def exclude_ids(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is not in `ids`; a null key is dropped.

    No hint: the planner broadcasts `ids` only if its size is below the broadcast limit.
    """
    return df.filter(F.col(key).isNotNull()).join(ids.select(key), key, "left_anti")
