"""Silver and Bronze to the Gold archetypes and their text features."""

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from emberline.config import Settings
from emberline.functions.moments import AsOf
from emberline.operators.audits import observed
from emberline.operators.dedup import PLACE, history_places, mark_places, merge_history, merged_at, placed
from emberline.operators.ranking import stamp, top_archetypes, viral_maxima, viral_scores
from emberline.operators.selection import recent, recent_or_widen, viral_tiered
from emberline.operators.textfeatures import embedding_prep, embedding_rows, tfidf_vectors
from emberline.plans.summaries import extraction_summary
from emberline.schemas import ARCHETYPE, SILVER
from emberline.session import stage
from emberline.sinks.tables import write_gold, write_summary
from emberline.sources.tables import FORMAT, read_batches, read_table, require_rows, skipped_files


def stage_recent(
    silver: DataFrame, bronze: DataFrame, as_of: AsOf, cfg: Settings = Settings()
) -> tuple[DataFrame, Observation]:
    """Merged posts of the widest window, written once, and the count of all merged posts.

    The history is scanned here and nowhere else; the steps behind it read the small staged table.
    """
    history, merged = observed(merge_history(silver, bronze, as_of, cfg.widened_hours, cfg), "merged")
    return stage(recent(history, as_of, cfg.widened_hours), "recent"), merged


# What selection and ranking never read: a staged window does without, where its rows can be read again.
LONG = ("title", "selftext", "text_combined", "url", "permalink")


def stage_recent_in_place(
    silver: DataFrame, bronze: DataFrame, as_of: AsOf, cfg: Settings = Settings()
) -> tuple[DataFrame, Observation, Callable[[DataFrame], DataFrame]]:
    """`stage_recent` for `placed` tables: the staged posts hold the place of their row and none of the `LONG` columns.

    Winners are found by narrow columns and read where they lie. The third result gives rows of the staged table, or
    of what is made of it, their `LONG` columns back; it is meant for a few rows, whose places it sends to every task.
    """
    window = cfg.widened_hours
    history, merged = observed(history_places(silver, bronze, as_of, window, cfg), "merged")
    chosen = mark_places(recent(history, as_of, window).filter(F.col("_file").isNotNull()))

    def completed(rows: DataFrame) -> DataFrame:
        texts = merged_at(silver, bronze, mark_places(rows), as_of, window, cfg).select(*PLACE, *LONG)
        return rows.join(texts, list(PLACE)).drop(*PLACE)

    return stage(merged_at(silver, bronze, chosen, as_of, window, cfg).drop(*LONG), "recent"), merged, completed


def recent_window(staged: DataFrame, as_of: AsOf, cfg: Settings = Settings()) -> DataFrame:
    return recent_or_widen(staged, as_of, (cfg.lookback_hours, cfg.widened_hours))


def scored_posts(staged: DataFrame, as_of: AsOf, cfg: Settings = Settings()) -> DataFrame:
    chosen = viral_tiered(recent_window(staged, as_of, cfg), cfg)
    return viral_scores(chosen, viral_maxima(chosen), cfg)


def archetypes_of(staged: DataFrame, as_of: AsOf, cfg: Settings = Settings()) -> DataFrame:
    return stamp(top_archetypes(scored_posts(staged, as_of, cfg), cfg.top_n), as_of, "extraction")


def run_extraction(
    spark: SparkSession,
    silver_path: str,
    bronze_root: str,
    archetypes_path: str,
    embeddings_path: str,
    as_of: AsOf,
    cfg: Settings = Settings(),
    fmt: str = FORMAT,
    tolerant: bool = False,
) -> DataFrame:
    """Write archetypes, embedding input, embeddings and the run summary; return the summary.

    A damaged Bronze file fails the run. A `tolerant` run goes on without what cannot be read; its summary counts the
    files that are damaged, and the rows that their footers promise and no read delivers.
    """
    # A tolerant read gives other rows of a damaged file with other columns: places hold for whole files alone.
    in_place = fmt == FORMAT and not tolerant
    silver = read_table(spark, silver_path, SILVER, fmt)
    batches = read_batches(spark, bronze_root, tolerant=tolerant, places=in_place)
    bronze = require_rows(batches, "no hot posts batch can be read")
    skipped, lost = 0, 0
    if tolerant:
        damage = skipped_files(spark, bronze_root).agg(F.count("*"), F.coalesce(F.sum("lost"), F.lit(0))).first()
        skipped, lost = damage
    if in_place:
        staged, merged, completed = stage_recent_in_place(placed(silver), bronze, as_of, cfg)
    else:
        staged, merged = stage_recent(silver, bronze, as_of, cfg)
    # Checked before the write: an empty run must not replace the last archetypes.
    found = require_rows(stage(archetypes_of(staged, as_of, cfg), "archetypes"), "no post meets the viral criteria")
    if in_place:
        found = completed(found).select(*ARCHETYPE.names).orderBy("archetype_rank")
    write_gold(found, archetypes_path, fmt)
    archetypes = read_table(spark, archetypes_path, ARCHETYPE, fmt)
    write_gold(embedding_prep(archetypes), f"{embeddings_path}_prep")
    write_gold(embedding_rows(tfidf_vectors(archetypes, cfg.tfidf_dims)), embeddings_path, fmt)
    window = recent_window(staged, as_of, cfg)
    summary = extraction_summary(merged.get["rows"], window, viral_tiered(window, cfg), archetypes, as_of, cfg)
    summary = summary.withColumns({"skipped_files": F.lit(skipped).cast("long"), "lost_rows": F.lit(lost).cast("long")})
    write_summary(summary, f"{archetypes_path}/_summary")
    return summary
