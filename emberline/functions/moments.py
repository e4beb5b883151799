"""Time columns. Every clock reading is the explicit `as_of` argument."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = datetime | str | Column


def instant(as_of: AsOf) -> Column:
    """`as_of` as a timestamp column; text and naive datetimes are read in the session time zone."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    if isinstance(as_of, datetime):
        if as_of.tzinfo is not None:
            return F.lit(as_of)
        as_of = as_of.isoformat(sep=" ")
    return F.lit(as_of).cast("timestamp")


def hours_before(as_of: AsOf, hours: int) -> Column:
    return instant(as_of) - F.make_dt_interval(hours=F.lit(hours))


def from_epoch(seconds: Column) -> Column:
    return F.to_timestamp(seconds)


def from_iso(text: Column) -> Column:
    """Null, not an error, for text that is no timestamp."""
    return text.try_cast("timestamp")


def time_features(df: DataFrame, ts: str = "created_ts") -> DataFrame:
    day = F.dayofweek(ts)  # 1 = Sunday ... 7 = Saturday
    return df.withColumns(
        {
            "hour_of_day": F.hour(ts),
            "day_of_week": day,
            "is_weekend": F.coalesce(day.isin(1, 7), F.lit(False)).cast("int"),
        }
    )


def hours_ago(as_of: AsOf, ts: str = "processed_ts") -> Column:
    return (F.unix_timestamp(instant(as_of)) - F.unix_timestamp(ts)) / F.lit(3600)


def age_bucket(hours: Column) -> Column:
    # Bucket bounds and names; an unknown age falls in the last one.
    return (
        F.when(hours < 6, "0-6h").when(hours < 12, "6-12h").when(hours < 24, "12-24h").otherwise(">24h")
    )
