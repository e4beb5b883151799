"""From raw submissions, queue events and Bronze rows to the common post layout."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.config import Settings
from emberline.functions.moments import AsOf, from_epoch, from_iso, instant, time_features
from emberline.functions.scoring import content_type, engagement_features
from emberline.functions.text import clean_text, clip, text_features
from emberline.schemas import COMMON, EVENT, LISTING, SILVER, mismatches, quoted

# --- Fixed values: markers written for absent content -----------------------------------
DELETED_AUTHOR = "[deleted]"
NO_FLAIR = "unknown"
AUTHOR_AS_TEXT = "None"
HOT, STREAM = "hot_api", "stream"


def _filled(name: str, value) -> Column:
    return F.coalesce(F.col(name), F.lit(value))


def event_from_submission(df: DataFrame, ingested_at: AsOf, *also: str) -> DataFrame:
    """Raw submission fields to the 20 event fields, and the columns named in `also`; `media` is JSON text or null."""
    return (
        df.withColumnsRenamed({"upvote_ratio": "ratio", "total_awards_received": "num_awards"})
        .withColumns(
            {
                "has_media": ~_filled("media", "").isin("", "{}"),
                "ingestion_timestamp": F.date_format(instant(ingested_at), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
            }
        )
        .selectExpr(*EVENT.names, *also)
    )


def normalise_event(df: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Bound the texts and fill what an event may lack."""
    return df.withColumns(
        {
            "title": clip(F.col("title"), cfg.title_limit),
            "selftext": clip(_filled("selftext", ""), cfg.body_limit),
            "author": _filled("author", DELETED_AUTHOR),
            "link_flair_text": F.when(F.col("link_flair_text") != "", F.col("link_flair_text")).otherwise(NO_FLAIR),
            "has_media": _filled("has_media", False),
        }
    )


def normalise_listing(df: DataFrame, fetched_at: AsOf) -> DataFrame:
    """Raw submission fields to the 22 listing fields; other columns are kept behind them."""
    rows = df.withColumns(
        {
            "selftext": _filled("selftext", ""),
            "author": _filled("author", AUTHOR_AS_TEXT),
            "total_awards_received": _filled("total_awards_received", 0),
            "is_original_content": _filled("is_original_content", False),
            "fetch_timestamp": F.date_format(instant(fetched_at), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
            "fetch_source": F.lit("hot"),
        }
    )
    return rows.selectExpr(*LISTING.names, *quoted(c for c in df.columns if c not in LISTING.names))


def add_bronze_derived(df: DataFrame, as_of: AsOf) -> DataFrame:
    at = instant(as_of)
    return df.withColumns(
        {
            "created_ts": from_epoch(F.col("created_utc")),
            "fetch_ts": from_iso(F.col("fetch_timestamp")),
            "fetch_date": F.to_date(at),
            "fetch_hour": F.hour(at),
            "has_media": _filled("is_video", False),
        }
    )


def to_common(df: DataFrame, *also: str) -> DataFrame:
    """The common columns in order, and those named in `also`; refuses a column whose type would be coerced by a later union."""
    wrong = mismatches(df.schema, COMMON)
    if wrong:
        raise TypeError("not a common post table: " + "; ".join(wrong))
    return df.selectExpr(*COMMON.names, *also)


def mark_source(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("data_source", F.lit(name))


def harmonise_hot(df: DataFrame, cfg: Settings = Settings(), with_text: bool = True, *also: str) -> DataFrame:
    """Bronze rows in the common layout, and the columns named in `also`. `has_media` follows `is_video`, null included.

    Without text the text features stay null, to be filled by `fill_hot_text` for the rows that are left.
    """
    if cfg.fold_missing_author:
        missing = F.col("author").isNull() | (F.col("author") == AUTHOR_AS_TEXT)
        df = df.withColumn("author", F.when(missing, DELETED_AUTHOR).otherwise(F.col("author")))
    renamed = df.withColumnsRenamed(
        {"total_awards_received": "num_awards", "upvote_ratio": "ratio"}
    ).withColumns(
        {
            "has_media": F.col("is_video"),
            "processing_date": F.col("fetch_date"),
            "processed_ts": F.col("fetch_ts"),
            "eventhub_enqueued_time": F.lit(None).cast("timestamp"),
            "content_type": content_type(),
        }
    )
    texts = text_features(renamed) if with_text else renamed.withColumns(no_text_features())
    features = time_features(engagement_features(texts, cfg))
    return to_common(mark_source(features, HOT), *also)


def no_text_features() -> dict[str, Column]:
    return {
        "text_combined": F.lit(None).cast("string"),
        "text_length": F.lit(None).cast("int"),
        "title_length": F.lit(None).cast("int"),
    }


def fill_hot_text(df: DataFrame) -> DataFrame:
    """Text features of the hot rows in a merged table; stream rows keep the stored ones."""
    hot = F.col("data_source") == HOT
    cleaned = clean_text(F.col("title"), F.col("selftext"))
    return df.withColumn("text_combined", F.when(hot, cleaned).otherwise(F.col("text_combined"))).withColumns(
        {
            "text_length": F.when(hot, F.length("text_combined")).otherwise(F.col("text_length")),
            "title_length": F.when(hot, F.length("title")).otherwise(F.col("title_length")),
        }
    )


def silver_columns(events: DataFrame, cfg: Settings = Settings(), *also: str) -> DataFrame:
    """Normalised events with the stored features of the stream table, and the columns named in `also`.

    An event carries no `is_self`; a post with a non-blank body counts as a text post.
    """
    arrived = from_iso(F.col("ingestion_timestamp"))
    rows = events.withColumns(
        {
            "created_ts": from_epoch(F.col("created_utc")),
            "processed_ts": arrived,
            "processing_date": F.to_date(arrived),
            "content_type": content_type(is_self=F.trim("selftext") != ""),
        }
    )
    return time_features(engagement_features(text_features(rows), cfg)).selectExpr(*SILVER.names, *also)


def mark_stream(silver: DataFrame, *also: str) -> DataFrame:
    return to_common(mark_source(silver, STREAM), *also)
