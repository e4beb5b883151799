"""Registered queries over the driver's tables. Each reads whole tables and returns one DataFrame.

`comparable` gives doubles nine places and writes times as text, so results compare across engines.
"""

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, TimestampType

from emberline.config import Criteria, Settings
from emberline.operators import audits, dedup, normalise, reports, selection, similarity, textfeatures
from emberline.operators.ranking import viral_maxima, viral_scores
from emberline.plans import extraction, intake, prediction, summaries, views
from emberline.schemas import EMBEDDING, LANDING, LISTING, SILVER, STORED_PREDICTION
from emberline.session import scratch_path, stage
from emberline.sinks.tables import publish_run, register_views, write_bronze, write_days, write_predictions
from emberline.sources import testbed
from emberline.sources.tables import file_audit, list_batches, read_batches, read_optional, read_table, stored_days
from emberline.streaming import counters, intake as messages_in, posts

AS_OF = testbed.AS_OF
CFG = testbed.SETTINGS
# No post arrived in the 24 hours before this moment, some did in the 48 hours before it.
QUIET_AS_OF = "2024-02-01 12:00:00"
# Nothing meets the first tier, so the relaxed one decides.
OUT_OF_REACH = CFG.but(tiers=(Criteria(1_000_000, 5, 10), Criteria(10, 1, 5)))


def comparable(df: DataFrame) -> DataFrame:
    shown = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, DoubleType):
            column = F.round(column, 9)
        elif isinstance(field.dataType, TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, DateType):
            column = column.cast("string")
        shown.append(column.alias(field.name))
    return df.select(*shown)


def digest(df: DataFrame, *texts: str) -> DataFrame:
    """Replace long texts by their MD5: the whole text is read, the result stays small."""
    return df.withColumns({name: F.md5(name) for name in texts})


# --- shared inputs ---------------------------------------------------------------------


def staged_recent(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    return extraction.stage_recent(*testbed.both(spark, sf_dir), as_of, CFG)[0]


def archetypes(spark: SparkSession, sf_dir: str, cfg: Settings = CFG) -> DataFrame:
    return stage(extraction.archetypes_of(staged_recent(spark, sf_dir), AS_OF, cfg), "archetypes")


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled candidates. The archetypes are stored first, as the Gold table is."""
    return prediction.predict(testbed.silver(spark, sf_dir), archetypes(spark, sf_dir), AS_OF, CFG)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.prediction_rows(predicted(spark, sf_dir), AS_OF)


def hourly_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, one hour apart, against the same archetypes."""
    first, second = (rows for _, rows in hourly_runs(spark, sf_dir))
    return first.unionByName(second)


def hourly_runs(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    silver, stored = testbed.silver(spark, sf_dir), archetypes(spark, sf_dir)
    return [
        (at, similarity.prediction_rows(prediction.predict(silver, stored, at, CFG), at))
        for at in ("2024-01-30 23:00:00", AS_OF)
    ]


# --- intake -----------------------------------------------------------------------------


def normalise_events(spark, sf_dir):
    return normalise.normalise_event(testbed.events(testbed.submissions(spark, sf_dir)), Settings())


def normalise_listing(spark, sf_dir):
    copies = testbed.hot_copies(testbed.submissions(spark, sf_dir))
    return digest(normalise.normalise_listing(copies, F.col("fetched_at")).select(*LISTING.names), "selftext")


def bronze_derived(spark, sf_dir):
    return testbed.bronze(spark, sf_dir).select(
        "id", "created_ts", "fetch_ts", "fetch_date", "fetch_hour", "has_media"
    )


def post_features(spark, sf_dir):
    silver, bronze = testbed.both(spark, sf_dir)
    rows = normalise.mark_stream(silver).unionByName(normalise.harmonise_hot(bronze, CFG))
    return digest(rows, "selftext", "text_combined")


def listing_top_n_per_group(spark, sf_dir):
    fetched = intake.fetched_rows(testbed.listings(spark, sf_dir), CFG)
    return fetched.select("listing", "listing_pos", "id", "score")


def listing_dedup_first(spark, sf_dir):
    return dedup.first_seen(testbed.listings(spark, sf_dir)).select("id", "listing", "score")


def duplicate_audit(spark, sf_dir):
    return audits.duplicate_audit(testbed.listings(spark, sf_dir))


def source_counts(spark, sf_dir):
    fetched = intake.fetched_rows(testbed.listings(spark, sf_dir), CFG)
    return audits.source_counts(fetched, testbed.requested_sources(spark, sf_dir))


def fetch_summary(spark, sf_dir):
    fetched = stage(intake.fetched_rows(testbed.listings(spark, sf_dir), CFG), "fetched")
    counts = audits.source_counts(fetched, testbed.requested_sources(spark, sf_dir))
    summary = summaries.fetch_summary(fetched, counts, AS_OF, "bronze")
    return summary.withColumn("fetch_stats", F.to_json("fetch_stats"))


def subreddit_summary(spark, sf_dir):
    return reports.subreddit_summary(testbed.bronze(spark, sf_dir))


def content_type_summary(spark, sf_dir):
    return reports.content_type_summary(testbed.bronze(spark, sf_dir))


def top_posts(spark, sf_dir):
    return reports.top_posts(dedup.latest_hot(testbed.bronze(spark, sf_dir)))


def sample_posts(spark, sf_dir):
    return reports.sample_posts(dedup.latest_hot(testbed.bronze(spark, sf_dir)))


def bronze_batches(spark: SparkSession, sf_dir: str) -> str:
    """Write the first fetches of all hot posts as one batch, the second ones as another."""
    root = scratch_path(spark, "bronze")
    copies = testbed.hot_copies(testbed.submissions(spark, sf_dir))
    for copy, at in enumerate((datetime(2024, 1, 30, 18), datetime(2024, 1, 31))):
        fetched = normalise.normalise_listing(copies.filter(F.col("copy") == copy), F.col("fetched_at"))
        write_bronze(intake.bronze_rows(fetched.withColumns({"source_pos": F.lit(0), "listing_pos": "event_id"}), at), root, at)
    return root


def bronze_roundtrip(spark, sf_dir):
    rows = read_batches(spark, bronze_batches(spark, sf_dir))
    return digest(rows, "selftext")


def bronze_batch_list(spark, sf_dir):
    return list_batches(spark, bronze_batches(spark, sf_dir))


def bronze_skipped_files(spark, sf_dir):
    """Both fetches and a third batch: damaged copies of all files of one subreddit, and a file that is no Parquet.

    Rows that the footers promise and rows that a tolerant read of all columns delivers.
    """
    root = bronze_batches(spark, sf_dir)
    least = testbed.documents_table(spark, sf_dir).agg(F.min("lang")).first()[0]
    day = "fetch_date=2024-01-31"
    testbed.damaged_copies(spark, f"{root}/2024-01-31_00-00/{day}/subreddit={least}", f"{root}/2024-02-01_00-00/{day}/subreddit={least}")
    testbed.no_parquet(spark, f"{root}/2024-02-01_00-00/{day}/subreddit=none/part-0.parquet")
    sums = [F.sum(c).alias(c) for c in ("promised", "delivered", "lost")]
    return file_audit(spark, root).groupBy("batch", "subreddit").agg(*sums)


# --- merge and selection ------------------------------------------------------------------


def date_range(spark, sf_dir):
    return audits.date_range(testbed.silver(spark, sf_dir))


def hot_dedup_latest(spark, sf_dir):
    latest = dedup.latest_hot(testbed.bronze(spark, sf_dir), body=F.md5("selftext"))
    return latest.select("id", "score", "num_comments", "fetch_timestamp", "subreddit", "body")


def merged_posts(spark, sf_dir):
    digests = {name: F.md5(name) for name in ("selftext", "text_combined")}
    return dedup.merge_sources(*testbed.both(spark, sf_dir), CFG, made=digests)


def recent_posts(spark, sf_dir):
    recent = extraction.recent_window(staged_recent(spark, sf_dir), AS_OF, CFG)
    return digest(recent, "selftext", "text_combined")


def recent_posts_fallback(spark, sf_dir):
    recent = extraction.recent_window(staged_recent(spark, sf_dir, QUIET_AS_OF), QUIET_AS_OF, CFG)
    return recent.select("id", "score", "processed_ts", "data_source")


def viral_posts_tiered(spark, sf_dir):
    window = extraction.recent_window(staged_recent(spark, sf_dir), AS_OF, CFG)
    return selection.viral_tiered(window, CFG).select("id", "score", "num_comments", "author", "text_length")


def viral_posts_relaxed(spark, sf_dir):
    window = extraction.recent_window(staged_recent(spark, sf_dir), AS_OF, CFG)
    return selection.viral_tiered(window, OUT_OF_REACH).select("id", "score", "num_comments", "author", "text_length")


def viral_maxima_row(spark, sf_dir):
    window = extraction.recent_window(staged_recent(spark, sf_dir), AS_OF, CFG)
    return viral_maxima(selection.viral_tiered(window, CFG))


def viral_scores_all(spark, sf_dir):
    """Scores of the posts of the whole history that meet the strict criteria."""
    names = ["id", "score", "num_comments", "num_awards", "ratio"]
    tested = ["author", "text_length"]
    merged = dedup.merge_sources(*testbed.both(spark, sf_dir), CFG, columns=names + tested)
    posts_ = stage(selection.viral(merged).select(*names), "viral")
    return viral_scores(posts_, viral_maxima(posts_), CFG)


# --- archetypes ------------------------------------------------------------------------------


def archetypes_top40(spark, sf_dir):
    return digest(archetypes(spark, sf_dir), "selftext", "text_combined")


def archetype_preview(spark, sf_dir):
    return reports.archetype_preview(archetypes(spark, sf_dir))


def archetype_leaders(spark, sf_dir):
    return reports.archetype_leaders(archetypes(spark, sf_dir))


def archetypes_by_type(spark, sf_dir):
    return reports.archetypes_by(archetypes(spark, sf_dir), "content_type")


def archetypes_by_subreddit(spark, sf_dir):
    return reports.archetypes_by(archetypes(spark, sf_dir), "subreddit", 15)


def archetypes_by_age(spark, sf_dir):
    return reports.archetypes_by_age(archetypes(spark, sf_dir), AS_OF)


def archetype_profile(spark, sf_dir):
    return similarity.archetype_profile(archetypes(spark, sf_dir))


def archetype_frequencies(spark, sf_dir):
    stored = archetypes(spark, sf_dir)
    parts = [
        similarity.archetype_frequencies(stored, col, CFG.top_n).select(
            F.lit(col).alias("feature"), F.col(col).alias("value"), "n", "share"
        )
        for col in ("subreddit", "content_type")
    ]
    return parts[0].unionByName(parts[1])


def embedding_prep(spark, sf_dir):
    return digest(
        textfeatures.embedding_prep(archetypes(spark, sf_dir)), "selftext", "text_combined", "embedding_text"
    )


def tfidf_vectors(spark, sf_dir):
    return unfolded(textfeatures.embedding_rows(textfeatures.tfidf_vectors(archetypes(spark, sf_dir), CFG.tfidf_dims)))


def tfidf_terms(spark, sf_dir):
    return textfeatures.tfidf_terms(archetypes(spark, sf_dir))


def stored_gold(spark: SparkSession, sf_dir: str) -> str:
    """An extraction run on stored Silver and Bronze: the folder of its embeddings."""
    silver, gold = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    write_days(testbed.silver(spark, sf_dir), silver)
    extraction.run_extraction(spark, silver, bronze_batches(spark, sf_dir), f"{gold}/archetypes", f"{gold}/embeddings", AS_OF, CFG)
    return f"{gold}/embeddings"


def stored_embedding_prep(spark, sf_dir):
    """The embedding input as the extraction stores it."""
    rows = spark.read.parquet(stored_gold(spark, sf_dir) + "_prep")
    return digest(rows, "selftext", "text_combined", "embedding_text")


def unfolded(rows: DataFrame) -> DataFrame:
    """Embedding rows, their vectors unfolded to the entries that are not 0."""
    entries = F.posexplode(vector_to_array("tfidf_features")).alias("bucket", "weight")
    others = [c for c in rows.columns if c != "tfidf_features"]
    return rows.select(*others, entries).filter(F.col("weight") != 0)


def stored_embeddings(spark, sf_dir):
    """The embeddings as the extraction stores them, and as the prediction reads them."""
    return unfolded(read_optional(spark, stored_gold(spark, sf_dir), EMBEDDING))


def extraction_summary(spark, sf_dir):
    staged, merged = extraction.stage_recent(*testbed.both(spark, sf_dir), AS_OF, CFG)
    stored = stage(extraction.archetypes_of(staged, AS_OF, CFG), "archetypes")
    window = extraction.recent_window(staged, AS_OF, CFG)
    viral = selection.viral_tiered(window, CFG)
    summary = summaries.extraction_summary(merged.get["rows"], window, viral, stored, AS_OF, CFG)
    return summary.withColumns(
        {"top_subreddits": F.concat_ws(",", "top_subreddits"), "content_types": F.to_json("content_types")}
    )


# --- prediction ---------------------------------------------------------------------------------


def candidates_anti_join(spark, sf_dir):
    found = similarity.candidates(testbed.silver(spark, sf_dir), archetypes(spark, sf_dir), AS_OF, CFG)
    return found.select("id", "score", "processed_ts")


def viral_split(spark, sf_dir):
    return audits.viral_split(similarity.viral_flag(testbed.silver(spark, sf_dir), CFG))


def similarity_scores(spark, sf_dir):
    """Every post of the whole stream table against the archetypes."""
    scored = similarity.score_posts(testbed.silver(spark, sf_dir), archetypes(spark, sf_dir), CFG)
    return scored.select("id", "viral_similarity_score", "viral_potential_label", "is_viral")


def label_distribution(spark, sf_dir):
    return reports.label_distribution(predicted(spark, sf_dir))


def type_by_label(spark, sf_dir):
    return reports.type_by_label(predicted(spark, sf_dir))


def high_by_subreddit(spark, sf_dir):
    return reports.high_by_subreddit(predicted(spark, sf_dir))


def top_high_posts(spark, sf_dir):
    return reports.top_high_posts(predicted(spark, sf_dir))


def prediction_totals(spark, sf_dir):
    return reports.prediction_totals(predicted(spark, sf_dir))


def prediction_summary(spark, sf_dir):
    stored = archetypes(spark, sf_dir)
    rows = prediction.predict(testbed.silver(spark, sf_dir), stored, AS_OF, CFG)
    summary = summaries.predicted_summary(rows, stored, AS_OF, "predictions", CFG)
    return summary.select(
        "prediction_timestamp", "lookback_hours", "archetypes_used", "posts_scored", "predictions.*",
        "similarity_stats.*", "thresholds.*", "output_path",
    )


def latest_predictions(spark, sf_dir):
    return prediction.latest_predictions(hourly_predictions(spark, sf_dir))


def latest_snapshot(spark, sf_dir):
    """Both runs, each merged into the snapshot that the one before left."""
    path, root, before = scratch_path(spark, "predictions"), scratch_path(spark, "latest"), None
    for run, (at, rows) in enumerate(hourly_runs(spark, sf_dir)):
        write_predictions(rows, path, at, f"r{run}")
        place = prediction.update_latest(spark, path, root, at, f"r{run}", before)
        before = f"r{run}"
    return read_table(spark, place, STORED_PREDICTION).drop("run_id")


def predictions_roundtrip(spark, sf_dir):
    """Both runs appended, read back."""
    path = scratch_path(spark, "predictions")
    for at, rows in hourly_runs(spark, sf_dir):
        write_predictions(rows, path, at)
    return read_table(spark, path, STORED_PREDICTION).drop("run_id")


def predictions_rerun(spark, sf_dir):
    """One run written twice under its id, the first time with other thresholds: only the second's labels stay."""
    path = scratch_path(spark, "predictions")
    silver, stored = testbed.silver(spark, sf_dir), archetypes(spark, sf_dir)
    for cfg in (CFG.but(high=0.5, medium=0.2, viral_cutoff=10**9), CFG):
        rows = similarity.prediction_rows(prediction.predict(silver, stored, AS_OF, cfg), AS_OF)
        write_predictions(rows, path, AS_OF, "2024-01-31_00")
    return read_table(spark, path, STORED_PREDICTION).select("id", "run_id", "viral_potential_label", "prediction_date")


# --- SQL on the published view ------------------------------------------------------------------


def _on_view(sql: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf_dir):
        path = scratch_path(spark, "predictions")
        write_predictions(predictions(spark, sf_dir), path, AS_OF)
        register_views(spark, path)
        return spark.sql(sql.format(view="viral_predictions", day="2024-01-31")).drop("run_id")

    return run


def sql_published_runs(spark, sf_dir):
    """The external table made after the first run, the second one published into it: rows by run's day and hour."""
    path, database = scratch_path(spark, "predictions"), f"emberline_{uuid.uuid4().hex}"
    for run, (at, rows) in enumerate(hourly_runs(spark, sf_dir)):
        write_predictions(rows, path, at, f"r{run}")
        if run == 0:
            register_views(spark, path, database=database)
        else:
            publish_run(spark, path, at, f"r{run}", database)
    return spark.table(f"`{database}`.viral_predictions").drop("run_id")


def silver_days(spark, sf_dir):
    """Posts of each arrival day of the stored stream table, from its footers."""
    path = scratch_path(spark, "silver")
    write_days(testbed.silver(spark, sf_dir), path)
    return stored_days(spark, path, SILVER)


def sql_external_table(spark, sf_dir):
    """Labels counted in the external table that lies over the stored predictions."""
    path, database = scratch_path(spark, "predictions"), f"emberline_{uuid.uuid4().hex}"
    write_predictions(predictions(spark, sf_dir), path, AS_OF)
    register_views(spark, path, database=database)
    return spark.sql(views.LABEL_COUNTS.format(view=f"`{database}`.viral_predictions"))


# --- the whole chain --------------------------------------------------------------------------------


def landed(spark: SparkSession, sf_dir: str, copy: int) -> DataFrame:
    """Landing rows of one fetch of all hot posts, every post in the listing of its subreddit."""
    copies = testbed.hot_copies(testbed.submissions(spark, sf_dir)).filter(F.col("copy") == copy)
    rows = normalise.normalise_listing(copies, F.col("fetched_at"))
    places = {"listing": F.col("subreddit"), "source_pos": F.lit(0), "listing_pos": F.col("event_id"), "stickied": F.lit(False)}
    return rows.withColumns(places).select(*LANDING.names)


FETCHES = (datetime(2024, 1, 30, 18), datetime(2024, 1, 31))


def landing_to_bronze(spark, sf_dir):
    """Both fetches landed as JSON lines, one of them with lines that are no row, and fetched into batches."""
    root = scratch_path(spark, "bronze")
    for copy, at in enumerate(FETCHES):
        folder = scratch_path(spark, "landing")
        landed(spark, sf_dir, copy).write.json(folder, compression="gzip")
        testbed.events_table(spark, sf_dir).filter("event_id < 3").selectExpr("concat('{\"id\": ', event_id)").write.mode("append").text(folder)
        wide = CFG.but(listing_limit=10**9)
        intake.run_hot_fetch(folder, testbed.requested_sources(spark, sf_dir), root, at, wide)
    return digest(read_batches(spark, root), "selftext")


def pipeline_predictions(spark, sf_dir):
    """Messages to the stream table, two hot fetches, extraction, prediction, and the published view."""
    silver = intake_of(messages(spark, sf_dir), CFG)["silver"]
    root, wide = scratch_path(spark, "bronze"), CFG.but(listing_limit=10**9)
    for copy, at in enumerate(FETCHES):
        intake.run_hot_fetch(landed(spark, sf_dir, copy), testbed.requested_sources(spark, sf_dir), root, at, wide)
    gold = scratch_path(spark, "gold")
    extraction.run_extraction(spark, silver, root, f"{gold}/archetypes", f"{gold}/embeddings", AS_OF, CFG)
    prediction.run_prediction(
        spark, silver, f"{gold}/archetypes", f"{gold}/predictions", AS_OF, CFG, embeddings_path=f"{gold}/embeddings"
    )
    register_views(spark, f"{gold}/predictions", "pipeline_predictions")
    return spark.table("pipeline_predictions").drop("run_id")


# --- streaming ------------------------------------------------------------------------------------


def messages_of(spark: SparkSession, sf_dir: str, rows: DataFrame, edited: bool = False) -> DataFrame:
    """Queue messages of event rows: purchases arrive twice, errors are cut off in the middle.

    If `edited`, the copies of a purchase differ: the post's score was moved in between.
    """
    posted = testbed.with_document(spark, sf_dir, rows).selectExpr(*testbed.SUBMISSION, "event_type")
    event = normalise.event_from_submission(posted, F.col("ts"), "event_type", "event_id")
    event = event.selectExpr("*", "explode(sequence(0, if(event_type = 'purchase', 1, 0))) as delivery")
    if edited:
        event = event.withColumn("score", F.expr("score + delivery * (event_id % 9 - 4)"))
    fields = F.struct(*[c for c in event.columns if c not in ("event_type", "event_id", "delivery")])
    return (
        event.withColumn("value", F.to_json(fields))
        .withColumn("value", F.expr("if(event_type = 'error', substring(value, 1, length(value) div 2), value)"))
        .selectExpr("value", "cast(ingestion_timestamp as timestamp) as timestamp")
    )


def messages(spark: SparkSession, sf_dir: str, edited: bool = False) -> DataFrame:
    """A stream of the messages of the events file."""
    arriving = spark.readStream.schema(testbed.EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return messages_of(spark, sf_dir, arriving, edited)


def intake_of(stream: DataFrame, cfg: Settings = Settings()) -> dict[str, str]:
    """Take all messages in; the folders of both sinks and of the checkpoint."""
    places = {name: scratch_path(stream.sparkSession, name) for name in ("silver", "quarantine", "checkpoint")}
    messages_in.write_intake(stream, **places, cfg=cfg).awaitTermination()
    return places


def stream_silver(spark, sf_dir):
    places = intake_of(messages(spark, sf_dir))
    return digest(messages_in.read_silver(spark, places["silver"]), "selftext", "text_combined")


def stream_survivors(spark, sf_dir):
    """Of copies that differ the best one is stored."""
    places = intake_of(messages(spark, sf_dir, edited=True))
    return messages_in.read_silver(spark, places["silver"]).select("id", "score", "ups", "engagement_score")


def stream_from_files(spark, sf_dir):
    """The messages landed as lines in one folder, and followed from there."""
    folder = scratch_path(spark, "messages")
    messages_of(spark, sf_dir, testbed.events_table(spark, sf_dir)).select("value").write.text(folder, compression="gzip")
    places = intake_of(posts.read_post_stream(spark, folder))
    return digest(messages_in.read_silver(spark, places["silver"]), "selftext", "text_combined")


def stream_quarantine(spark, sf_dir):
    places = intake_of(messages(spark, sf_dir))
    id_in_text = F.regexp_extract("value", '"id":"([^"]*)"', 1).alias("id")
    return messages_in.read_quarantine(spark, places["quarantine"]).select("timestamp", id_in_text)


def stream_ledger(spark, sf_dir):
    """What the intake took, sent and failed, and the rows it stored, over all batches."""
    places = intake_of(messages(spark, sf_dir))
    ledger = messages_in.read_ledger(spark, places["checkpoint"])
    return ledger.agg(*[F.sum(c).alias(c) for c in ("processed", "sent", "failed", "stored")])


def stream_counters(spark, sf_dir):
    path, checkpoint = scratch_path(spark, "counters"), scratch_path(spark, "counters-checkpoint")
    counted = counters.stream_counters(messages(spark, sf_dir))
    counters.write_counters(counted, path, checkpoint).awaitTermination()
    return counters.read_counters(spark, path)


def stream_progress(spark, sf_dir):
    """The counts that rode on the stream, and the messages that came too late for their window."""
    path, log, checkpoint = (scratch_path(spark, n) for n in ("counters", "progress", "counters-checkpoint"))
    listener = counters.ProgressLog(spark, log)
    spark.streams.addListener(listener)
    try:
        counted = counters.stream_counters(counters.counted(messages(spark, sf_dir)))
        counters.write_counters(counted, path, checkpoint).awaitTermination()
        listener.wait()
    finally:
        spark.streams.removeListener(listener)
    progress = counters.read_progress(spark, log)
    sums = progress.agg(*[F.sum(c).alias(c) for c in ("processed", "sent", "failed")])
    late = counters.late_messages(progress, counters.read_counters(spark, path)).select("late").scalar()
    return sums.withColumn("late", late)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "normalise_events": normalise_events,
    "normalise_listing": normalise_listing,
    "bronze_derived": bronze_derived,
    "post_features": post_features,
    "listing_top_n_per_group": listing_top_n_per_group,
    "listing_dedup_first": listing_dedup_first,
    "duplicate_audit": duplicate_audit,
    "source_counts": source_counts,
    "fetch_summary": fetch_summary,
    "subreddit_summary": subreddit_summary,
    "content_type_summary": content_type_summary,
    "top_posts": top_posts,
    "sample_posts": sample_posts,
    "bronze_roundtrip": bronze_roundtrip,
    "bronze_batch_list": bronze_batch_list,
    "bronze_skipped_files": bronze_skipped_files,
    "date_range": date_range,
    "hot_dedup_latest": hot_dedup_latest,
    "merged_posts": merged_posts,
    "recent_posts": recent_posts,
    "recent_posts_fallback": recent_posts_fallback,
    "viral_posts_tiered": viral_posts_tiered,
    "viral_posts_relaxed": viral_posts_relaxed,
    "viral_maxima": viral_maxima_row,
    "viral_scores": viral_scores_all,
    "archetypes_top40": archetypes_top40,
    "archetype_preview": archetype_preview,
    "archetype_leaders": archetype_leaders,
    "archetypes_by_type": archetypes_by_type,
    "archetypes_by_subreddit": archetypes_by_subreddit,
    "archetypes_by_age": archetypes_by_age,
    "archetype_profile": archetype_profile,
    "archetype_frequencies": archetype_frequencies,
    "embedding_prep": embedding_prep,
    "tfidf_vectors": tfidf_vectors,
    "tfidf_terms": tfidf_terms,
    "stored_embedding_prep": stored_embedding_prep,
    "stored_embeddings": stored_embeddings,
    "extraction_summary": extraction_summary,
    "candidates_anti_join": candidates_anti_join,
    "viral_split": viral_split,
    "similarity_scores": similarity_scores,
    "predictions": predictions,
    "label_distribution": label_distribution,
    "type_by_label": type_by_label,
    "high_by_subreddit": high_by_subreddit,
    "top_high_posts": top_high_posts,
    "prediction_totals": prediction_totals,
    "prediction_summary": prediction_summary,
    "latest_predictions": latest_predictions,
    "predictions_roundtrip": predictions_roundtrip,
    "predictions_rerun": predictions_rerun,
    "latest_snapshot": latest_snapshot,
    "silver_days": silver_days,
    "sql_label_counts": _on_view(views.LABEL_COUNTS),
    "sql_top_similarity": _on_view(views.TOP_SIMILARITY),
    "sql_high_posts": _on_view(views.HIGH_POSTS),
    "sql_summary_of_day": _on_view(views.SUMMARY_OF_DAY),
    "sql_external_table": sql_external_table,
    "sql_published_runs": sql_published_runs,
    "landing_to_bronze": landing_to_bronze,
    "pipeline_predictions": pipeline_predictions,
    "stream_silver": stream_silver,
    "stream_survivors": stream_survivors,
    "stream_from_files": stream_from_files,
    "stream_ledger": stream_ledger,
    "stream_progress": stream_progress,
    "stream_quarantine": stream_quarantine,
    "stream_counters": stream_counters,
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries in comparable form. They read times in UTC and set the session so."""

    def shown(query):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return comparable(query(spark, sf_dir))

        return run

    return {name: shown(query) for name, query in QUERIES.items()}
