"""Writers. Partitioned ones rebalance first: one file or a few per folder, and a hot folder is split by size."""

import re
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from emberline.config import LABELS
from emberline.schemas import BRONZE_PARTITIONS, PREDICTION_PARTITIONS, STORED_PREDICTION
from emberline.sources.tables import FORMAT, read_table


# So many rows of one folder in one write make files of a fair size in every task that holds some of them.
LARGE_FOLDER = 200_000
# So many rows in a file are enough.
FAIR_FILE = 2_000
# A task keeps the files of so many folders open; rows of more folders are sorted by folder first.
OPEN_FILES = 8
# So many where a task reads a bounded split of a written table: its rows are buffered in all files together, unsorted.
OPEN_AS_READ = 64


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _spread(df: DataFrame, partitions: Sequence[str], large: int) -> DataFrame:
    """`df` for a partitioned write: the rows of folders with `large` rows stay in their tasks, the others are rebalanced.

    Rows are counted by folder first, which reads the columns that make the folders (and those that choose the rows).
    """
    counts = df.groupBy(*partitions).agg(F.count(F.lit(1)).alias("_n"))
    found = counts.filter(F.col("_n") >= large).orderBy(F.desc("_n"), *partitions).limit(OPEN_FILES).collect()
    if not found:
        return df.hint("rebalance", *partitions)
    folders = [reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(r[c])) for c in partitions]) for r in found]
    stays = reduce(Column.__or__, folders)
    return df.filter(stays).unionByName(df.filter(~stays).hint("rebalance", *partitions))


def _as_read(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """`df`, read from a written table, for a partitioned write: the rows of folders whose files come out fair if they stay
    in the tasks that read them do so, the others are rebalanced.

    Rows are counted by folder and task first, which reads the columns that make the folders (and choose the rows).
    """
    parts = df.groupBy(*partitions, F.spark_partition_id().alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    fair = F.sum("_n") >= FAIR_FILE * F.count(F.lit(1))
    found = parts.groupBy(*partitions).agg(fair.alias("_fair")).collect()  # one a folder
    stays = [r for r in found if r["_fair"]]
    if not stays:
        return df.hint("rebalance", *partitions)
    if len(stays) == len(found):
        return df
    stay = reduce(Column.__or__, [reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(r[c])) for c in partitions]) for r in stays])
    return df.filter(stay).unionByName(df.filter(~stay).hint("rebalance", *partitions))


def write_partitioned(
    df: DataFrame,
    path: str,
    partitions: Sequence[str],
    mode: str,
    fmt: str = FORMAT,
    metrics: Sequence[Column] = (),
    large: int | None = None,
    as_read: bool = False,
    made: Callable[[DataFrame], DataFrame] | None = None,
    **options: str,
) -> dict[str, Any]:
    """Write and return the `metrics` of the written rows.

    They are taken behind the shuffle, in the tasks that write, so a repeated map task is not counted twice. With
    `large`, folders of so many rows are written without a shuffle; `df` is then read twice. `as_read` is for rows of a
    written table, which come out in the same tasks again: folders whose files come out fair are written without a
    shuffle. `made` gives the rows to write from those behind the shuffle: columns that follow from others need not
    cross it. Parquet is compressed by Zstandard.
    """
    spark, seen = df.sparkSession, Observation()
    if as_read:
        rows = _as_read(df, partitions)
    else:
        rows = _spread(df, partitions, large) if large else df.hint("rebalance", *partitions)
    if made:
        rows = made(rows)
    if metrics:
        rows = rows.observe(seen, *metrics)
    if fmt == "parquet":
        options = {"compression": "zstd", **options}
    with _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_AS_READ if as_read else OPEN_FILES)):
        (
            rows.write.format(fmt)
            .options(**options)
            .mode(mode)
            .partitionBy(*partitions)
            .save(path)
        )
    return seen.get if metrics else {}


# A task buffers a row group, and a dictionary where one is tried, of each file that it has open: none for long texts.
MANY_OPEN = {
    "parquet.block.size": str(8 << 20),
    **{f"parquet.enable.dictionary#{c}": "false" for c in ("title", "selftext", "text_combined")},
}


def write_days(df: DataFrame, path: str, day: str = "processing_date") -> None:
    """Write a history by day as Parquet, each row in the task that holds it.

    A sort by day would spill whole rows where a task holds more than its memory. So files of up to `OPEN_AS_READ` days
    are open in a task together, with small row groups; rows of further days alone are sorted.
    """
    with _setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_AS_READ)):
        df.write.options(**MANY_OPEN).partitionBy(day).parquet(path, compression="zstd")


def batch_path(root: str, fetched_at: datetime) -> str:
    return f"{root}/{fetched_at:%Y-%m-%d_%H-%M}"


def write_bronze(df: DataFrame, root: str, fetched_at: datetime) -> str:
    """Write one fetch batch to its own folder and return the path."""
    path = batch_path(root, fetched_at)
    write_partitioned(df, path, BRONZE_PARTITIONS, "overwrite", large=LARGE_FOLDER)
    return path


def write_gold(df: DataFrame, path: str, fmt: str = FORMAT) -> None:
    df.write.format(fmt).mode("overwrite").save(path)


def write_predictions(
    df: DataFrame,
    path: str,
    as_of: datetime | str,
    run_id: str | None = None,
    fmt: str = FORMAT,
    metrics: Sequence[Column] = (),
) -> dict[str, Any]:
    """Write the predictions of the run at `as_of`, split by label; return the `metrics` of the written rows.

    A run has a folder of its own below its day, and writing it again replaces all of that folder: labels that no
    longer occur go, and a repeated run without rows leaves none. Other runs stay. Without a `run_id` the run is named
    after its time, so every write has the same layout.
    """
    day, label = PREDICTION_PARTITIONS
    folder = _run_folder(path, as_of, run_id)[2]
    return write_partitioned(df.drop(day), folder, (label,), "overwrite", fmt, metrics)


def write_summary(summary: DataFrame, path: str) -> None:
    """A one-row run summary as JSON.

    A leading `_` in the folder name keeps it out of table reads, but for names that start with `_metadata`:
    Spark takes those for files of the table.
    """
    summary.coalesce(1).write.mode("overwrite").json(path)


def _run_folder(path: str, as_of: datetime | str, run_id: str | None) -> tuple[datetime, str, str]:
    """Time, name and folder of the run at `as_of`. Without a `run_id` it is named after its time."""
    at = as_of if isinstance(as_of, datetime) else datetime.fromisoformat(as_of)
    run = run_id or f"{at:%Y%m%d_%H%M%S}"
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run):
        raise ValueError(f"a run id of letters, digits, '_', '.' and '-' is asked for, not {run!r}")
    return at, run, f"{path}/{PREDICTION_PARTITIONS[0]}={at:%Y-%m-%d}/run_id={run}"


def read_run(spark: SparkSession, path: str, as_of: datetime | str, run_id: str | None = None, fmt: str = FORMAT) -> DataFrame:
    """The stored predictions of one run; no other folder is listed."""
    at, run, folder = _run_folder(path, as_of, run_id)
    stored = StructType([f for f in STORED_PREDICTION.fields if f.name not in (PREDICTION_PARTITIONS[0], "run_id")])
    rows = read_table(spark, folder, stored, fmt)
    rows = rows.withColumns({PREDICTION_PARTITIONS[0]: F.lit(at.date()), "run_id": F.lit(run)})
    return rows.select(*STORED_PREDICTION.names)


def register_views(
    spark: SparkSession,
    path: str,
    view: str = "viral_predictions",
    database: str | None = None,
    fmt: str = FORMAT,
) -> DataFrame:
    """Name the stored predictions: a temporary view, and an external table if a database is given.

    A new table takes in the runs that are there, which lists all of them once. Later runs come in by `publish_run`.
    """
    predictions = read_table(spark, path, STORED_PREDICTION, fmt)
    predictions.createOrReplaceTempView(view)
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        known = spark.catalog.tableExists(f"`{database}`.`{view}`")
        columns, parts = "", ""
        if fmt != "delta":
            declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in STORED_PREDICTION.fields)
            day, label = PREDICTION_PARTITIONS
            columns = f"({declared})"
            parts = f"PARTITIONED BY (`{day}`, run_id, `{label}`)"
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{view}` {columns} USING {fmt} {parts} LOCATION '{path}'")
        if fmt != "delta" and not known:
            spark.sql(f"MSCK REPAIR TABLE `{database}`.`{view}`")
        spark.sql(f"REFRESH TABLE `{database}`.`{view}`")
    return predictions


def publish_run(
    spark: SparkSession, path: str, as_of: datetime | str, run_id: str | None, database: str, view: str = "viral_predictions"
) -> None:
    """Take the run just written into the external table: its partitions by name, without a listing of the table."""
    at, run, folder = _run_folder(path, as_of, run_id)
    day, label = PREDICTION_PARTITIONS
    named = " ".join(
        f"PARTITION (`{day}` = '{at:%Y-%m-%d}', run_id = '{run}', `{label}` = '{name}') LOCATION '{folder}/{label}={name}'"
        for name in LABELS
    )
    spark.sql(f"ALTER TABLE `{database}`.`{view}` ADD IF NOT EXISTS {named}")
    spark.sql(f"REFRESH TABLE `{database}`.`{view}`")


def write_latest(rows: DataFrame, root: str, run: str, fmt: str = FORMAT) -> str:
    """Write the snapshot that the run `run` leaves behind, to a folder of its own; return it."""
    path = f"{root}/run={run}"
    rows.write.format(fmt).mode("overwrite").save(path)
    return path
