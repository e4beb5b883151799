"""Counts that accompany a run."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def duplicate_audit(df: DataFrame, key: str = "id") -> DataFrame:
    """Rows, distinct keys (null is one key), and their difference."""
    unique = F.countDistinct(key) + F.coalesce(F.max(F.col(key).isNull().cast("long")), F.lit(0))
    return df.agg(F.count("*").alias("total_posts"), unique.alias("unique_posts")).withColumn(
        "duplicates", F.col("total_posts") - F.col("unique_posts")
    )


def source_counts(df: DataFrame, sources: DataFrame, col: str = "listing") -> DataFrame:
    """Posts per requested source, zero for a source that gave none, most first."""
    counts = df.groupBy(col).agg(F.count("*").alias("posts"))
    return (
        sources.select(col)
        .join(counts, col, "left")
        .select(col, F.coalesce("posts", F.lit(0)).alias("posts"))
        .orderBy(F.desc("posts"), F.asc(col))
    )


def date_range(df: DataFrame, col: str = "processing_date") -> DataFrame:
    return df.agg(F.min(col).alias("min_date"), F.max(col).alias("max_date"))


def viral_split(df: DataFrame) -> DataFrame:
    """Posts that are viral already, and posts left to predict."""
    flag = F.col("is_already_viral")
    return df.agg(F.count_if(flag).alias("already_viral"), F.count_if(~flag).alias("to_predict"))


def observed(df: DataFrame, name: str, *extra: Column) -> tuple[DataFrame, Observation]:
    """Count rows while they flow through the next job instead of running one for it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *extra), seen
