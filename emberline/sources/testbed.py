"""Posts derived from the driver's `events` and `documents` tables: every event is a post about a document.

All rows and whole texts take part. `events` joins `documents` on `event_id modulo number of documents`.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.config import Settings
from emberline.operators.normalise import (
    add_bronze_derived,
    event_from_submission,
    normalise_event,
    normalise_listing,
    silver_columns,
)

AS_OF = "2024-01-31 00:00:00"
# Stored posts keep their whole texts, and a lower bound for HIGH makes that label occur in these tables.
SETTINGS = Settings(title_limit=None, body_limit=None, high=0.65)


# --- Fixed values: layouts of the two driver tables, and post columns derived from them -------
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
DOCUMENTS = "doc_id long, text string, lang string, source string"
SUBMISSION = """
event_id
cast(ts as timestamp) as ts
concat('p', event_id) as id
substring(text, 1, 80) as title
nullif(substring(text, 81), '') as selftext
lang as subreddit
case when user_id % 50 = 1 then '[removed]' when user_id % 50 > 1 then concat('u', user_id) end as author
cast(unix_timestamp(cast(ts as timestamp)) as double) as created_utc
concat('https://example.org/p', event_id) as url
concat('/', lang, '/p', event_id) as permalink
event_id % 10 = 0 as over_18
event_id % 17 = 0 as spoiler
case event_id % 3 when 0 then source when 1 then '' end as link_flair_text
floor(value) as score
floor(value) + event_id % 5 as ups
event_id % 5 as downs
case when event_id % 97 <> 0 then 0.5d + (event_id % 50) / 100.0d end as upvote_ratio
cast(get_json_object(props, '$.k') as bigint) as num_comments
case when event_id % 41 <> 0 then event_id % 4 end as total_awards_received
event_type = 'view' as is_video
event_type in ('signup', 'error', 'click') as is_self
case when event_id % 7 <> 0 then event_id % 2 = 0 end as is_original_content
case when event_type = 'view' then '{"kind": "video"}' when event_id % 11 = 0 then '{}' end as media
case when event_id % 23 = 0 then true when event_id % 5 <> 0 then false end as stickied
""".strip().splitlines()


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def documents_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(DOCUMENTS).parquet(f"{sf_dir}/documents.parquet")


def with_document(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Join on the document number.

    The file may be one split, and each text comes out ten times: spread the texts over all shuffle partitions
    first. The number is explicit, because adaptive execution would merge partitions by their size before the join.
    """
    documents = documents_table(spark, sf_dir)
    number = documents.select(F.count("*")).scalar()
    spread = documents.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id")
    return rows.withColumn("doc_id", F.col("event_id") % number).join(spread, "doc_id")


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw submission fields from event and document columns; `event_id` and `ts` stay."""
    return with_document(spark, sf_dir, events_table(spark, sf_dir)).selectExpr(*SUBMISSION)


def events(posts: DataFrame) -> DataFrame:
    """Queue events of submissions before any bound on the texts."""
    return event_from_submission(posts, F.col("ts"))


def silver_of(posts: DataFrame) -> DataFrame:
    return silver_columns(normalise_event(events(posts), SETTINGS), SETTINGS)


def hot_copies(posts: DataFrame) -> DataFrame:
    """Every post as fetched an hour after its event, half of them again six hours later, scores moved."""
    return posts.selectExpr("*", "explode(sequence(0, event_id % 2)) as copy").withColumns(
        {
            "fetched_at": F.expr("ts + make_dt_interval(0, cast(1 + 6 * copy as int))"),
            "score": F.expr("greatest(score + event_id % 100 - 50 - copy * 5, 0)"),
        }
    )


def bronze_of(posts: DataFrame) -> DataFrame:
    fetched = normalise_listing(hot_copies(posts), F.col("fetched_at"))
    helpers = ("event_id", "ts", "media", "stickied", "copy", "fetched_at")
    return add_bronze_derived(fetched, F.col("fetched_at")).drop(*helpers)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_of(submissions(spark, sf_dir))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_of(submissions(spark, sf_dir))


def both(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    posts = submissions(spark, sf_dir)
    return silver_of(posts), bronze_of(posts)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing rows by requested source: each post under its own subreddit, one of score 100 also under `all`.

    `source_pos` is the place of the request, `listing_pos` the place in its answer.
    """
    rows = submissions(spark, sf_dir).selectExpr(
        "*",
        "explode(if(score >= 100, array('all', subreddit), array(subreddit))) as listing",
        "event_id as listing_pos",
    ).withColumn("source_pos", F.expr("if(listing = 'all', 0, 1)"))
    return normalise_listing(rows, AS_OF)


def requested_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested sources: every subreddit there is, `all`, and one that never answers."""
    langs = documents_table(spark, sf_dir).select(F.col("lang").alias("listing")).distinct()
    return langs.unionByName(spark.range(1).selectExpr("explode(array('all', 'nowhere')) as listing"))


def damaged_copies(spark: SparkSession, folder: str, target: str) -> None:
    """Copy the Parquet files of a folder with the head of their first page overwritten: footers stay sound.

    The bytes pass through the file system's own streams, whatever store the folder lies in.
    """
    hadoop = spark._jvm.org.apache.hadoop
    source = hadoop.fs.Path(folder)
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.listStatus(source):
        name = found.getPath().getName()
        if name.endswith(".parquet"):
            head = b"PAR1" + b"\xff" * 60
            bytes_in, out = files.open(found.getPath()), files.create(hadoop.fs.Path(f"{target}/{name}"))
            bytes_in.seek(len(head))
            out.write(bytearray(head))
            hadoop.io.IOUtils.copyBytes(bytes_in, out, 1 << 16, True)


def no_parquet(spark: SparkSession, path: str) -> None:
    """A file that has the name of a Parquet file and is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place)
    out.write(bytearray(b"cut off while it was written"))
    out.close()
