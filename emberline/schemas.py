"""Column lists and Spark schemas of the tables the pipeline reads and writes."""

from collections.abc import Iterable

from pyspark.ml.linalg import VectorUDT
from pyspark.sql.types import StructField, StructType


def _layout(columns: str) -> StructType:
    """`"name type, ..."` to a schema. Needs no session, unlike a DDL string."""
    schema = StructType()
    for column in columns.split(","):
        schema.add(*column.split())
    return schema


# --- Fixed values: table layouts, columns in stored order -------------------------------
EVENT = _layout(
    """
    id string, title string, selftext string, subreddit string, author string,
    created_utc double, url string, permalink string,
    over_18 boolean, spoiler boolean, link_flair_text string,
    score long, ups long, downs long, ratio double,
    num_comments long, num_awards long,
    is_video boolean, has_media boolean, ingestion_timestamp string
    """
)

LISTING = _layout(
    """
    id string, title string, selftext string, subreddit string, author string,
    created_utc double, url string, permalink string,
    over_18 boolean, spoiler boolean, link_flair_text string,
    score long, ups long, downs long, upvote_ratio double,
    num_comments long, total_awards_received long,
    is_video boolean, is_self boolean, is_original_content boolean,
    fetch_timestamp string, fetch_source string
    """
)

# A landed row: the listing it came in, the places of request and row, and whether it was pinned.
LANDING = StructType(
    LISTING.fields + _layout("listing string, source_pos integer, listing_pos long, stickied boolean").fields
)

BRONZE_DERIVED = _layout(
    "created_ts timestamp, fetch_ts timestamp, fetch_date date, fetch_hour integer, has_media boolean"
)
BRONZE = StructType(LISTING.fields + BRONZE_DERIVED.fields)
BRONZE_PARTITIONS = ("fetch_date", "subreddit")

COMMON = _layout(
    """
    id string, title string, selftext string, subreddit string, author string,
    created_ts timestamp, url string, permalink string,
    over_18 boolean, spoiler boolean, link_flair_text string,
    score long, ups long, downs long, ratio double,
    num_comments long, num_awards long,
    is_video boolean, has_media boolean,
    text_combined string, text_length integer, title_length integer,
    engagement_score double, comment_to_score_ratio double,
    content_type string, hour_of_day integer, day_of_week integer, is_weekend integer,
    processing_date date, processed_ts timestamp, data_source string
    """
)
SILVER = StructType([f for f in COMMON.fields if f.name != "data_source"])

ARCHETYPE_EXTRA = _layout(
    """
    score_norm double, comments_norm double, awards_norm double, viral_score double,
    archetype_rank integer, extraction_date date, extraction_timestamp timestamp
    """
)
ARCHETYPE = StructType(COMMON.fields + ARCHETYPE_EXTRA.fields)

PREDICTION = _layout(
    """
    id string, title string, subreddit string, author string,
    score long, num_comments long, engagement_score double,
    viral_similarity_score double, viral_potential_label string,
    is_viral boolean, is_already_viral boolean,
    content_type string, text_length integer,
    created_ts timestamp, processed_ts timestamp,
    prediction_timestamp timestamp, prediction_date date
    """
)
PREDICTION_PARTITIONS = ("prediction_date", "viral_potential_label")
#: As stored: below the day, each run has a folder of its own.
STORED_PREDICTION = StructType(PREDICTION.fields + _layout("run_id string").fields)

TOTALS = _layout(
    """
    total_posts long, already_viral long, high_potential long, medium_potential long, low_potential long,
    avg_similarity double, max_similarity double
    """
)

EMBEDDING_PREP_COLUMNS = (
    "id", "archetype_rank", "title", "selftext", "text_combined", "subreddit", "viral_score", "content_type",
)
EMBEDDING_COLUMNS = (
    "id", "archetype_rank", "title", "subreddit", "viral_score", "tfidf_features", "extraction_date",
)
EMBEDDING = StructType(
    [StructField("tfidf_features", VectorUDT()) if n == "tfidf_features" else ARCHETYPE[n] for n in EMBEDDING_COLUMNS]
)


def quoted(columns: Iterable[str]) -> list[str]:
    """Column names for `selectExpr`, which builds a wide projection in one call."""
    return [f"`{name}`" for name in columns]


def mismatches(actual: StructType, wanted: StructType) -> list[str]:
    """Columns of `wanted` that `actual` lacks or holds with another type."""
    types = {f.name: f.dataType for f in actual.fields}
    return [
        f"{f.name}: {types[f.name].simpleString() if f.name in types else 'missing'}"
        f" instead of {f.dataType.simpleString()}"
        for f in wanted.fields
        if types.get(f.name) != f.dataType
    ]
