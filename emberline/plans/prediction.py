"""Silver against the Gold archetypes to labelled predictions."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from emberline.config import Settings
from emberline.functions.moments import AsOf
from emberline.operators.dedup import dedup
from emberline.operators.reports import total_columns
from emberline.operators.similarity import candidates, prediction_rows, score_posts
from emberline.plans.summaries import prediction_summary
from emberline.schemas import ARCHETYPE, EMBEDDING, SILVER, STORED_PREDICTION, TOTALS
from emberline.sinks.tables import read_run, write_latest, write_predictions, write_summary
from emberline.sources.tables import FORMAT, read_optional, read_table, require_rows


def predict(silver: DataFrame, archetypes: DataFrame, as_of: AsOf, cfg: Settings = Settings()) -> DataFrame:
    """Every recent stream post that is no archetype, with similarity and label; all columns kept."""
    return score_posts(candidates(silver, archetypes, as_of, cfg), archetypes, cfg)


def latest_predictions(predictions: DataFrame) -> DataFrame:
    """The last prediction of each id: hourly runs score the posts of a day again and again."""
    return dedup(
        predictions,
        "id",
        ["prediction_timestamp desc", "processed_ts desc", "score desc", "viral_similarity_score desc"],
    )


def latest_after(snapshot: DataFrame | None, run: DataFrame) -> DataFrame:
    """`latest_predictions` after one run more: the snapshot of the runs before it, and that run alone, are read."""
    return latest_predictions(run if snapshot is None else snapshot.unionByName(run))


def update_latest(
    spark: SparkSession, predictions_path: str, latest_root: str, as_of: datetime | str, run_id: str, before: str | None, fmt: str = FORMAT
) -> str:
    """Write the snapshot after the run `run_id` from the one after the run `before`; return its folder.

    Each run has a snapshot of its own, so a repeated run replaces its own and no other.
    """
    known = read_table(spark, f"{latest_root}/run={before}", STORED_PREDICTION, fmt) if before else None
    return write_latest(latest_after(known, read_run(spark, predictions_path, as_of, run_id, fmt)), latest_root, run_id, fmt)


def run_prediction(
    spark: SparkSession,
    silver_path: str,
    archetypes_path: str,
    predictions_path: str,
    as_of: datetime | str,
    cfg: Settings = Settings(),
    fmt: str = FORMAT,
    run_id: str | None = None,
    embeddings_path: str | None = None,
) -> DataFrame:
    """Write the predictions and the run summary; return the summary. No candidate is a valid outcome.

    The embeddings are optional and take no part in the score; a missing table is no error.
    """
    archetypes = require_rows(read_table(spark, archetypes_path, ARCHETYPE, fmt), "no archetypes")
    if embeddings_path:
        read_optional(spark, embeddings_path, EMBEDDING, fmt)
    silver = read_table(spark, silver_path, SILVER, fmt)
    rows = prediction_rows(predict(silver, archetypes, as_of, cfg), as_of)
    totals = write_predictions(rows, predictions_path, as_of, run_id, fmt, total_columns())
    one_row = spark.createDataFrame([tuple(totals[name] for name in TOTALS.names)], TOTALS)
    summary = prediction_summary(one_row, archetypes, as_of, predictions_path, cfg)
    at = as_of if isinstance(as_of, datetime) else datetime.fromisoformat(as_of)
    write_summary(summary, f"{predictions_path}/_summary_{at:%Y%m%d_%H%M}")
    return summary
