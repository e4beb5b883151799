"""Processed, sent and failed messages per time window, and what each micro-batch did."""

import threading
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from emberline.session import stage
from emberline.sources.tables import read_optional
from emberline.streaming.posts import post_id

COLUMNS = ("window_start", "processed", "sent", "failed", "rate_per_second")
STORED = "window_start timestamp, processed long, sent long, failed long, rate_per_second double"
PROGRESS = "batch_id long, processed long, sent long, failed long, state_rows long"
#: Name of the counts that ride on a stream.
SEEN = "messages"


def stream_counters(messages: DataFrame, window: str = "1 minute", delay: str = "10 minutes") -> DataFrame:
    """One row per window. Works on a stream and on a stored table.

    On a stream the state holds the windows of the last `delay` of message time. A message that is later than that is
    not counted in its window; `late_messages` tells how many there were.
    """
    flags = messages.select("timestamp", post_id().isNotNull().alias("ok")).withWatermark("timestamp", delay)
    slot = F.window("timestamp", window).alias("slot")
    seconds = F.unix_timestamp("slot.end") - F.unix_timestamp("slot.start")
    return (
        flags.groupBy(slot)
        .agg(
            F.count("*").alias("processed"),
            F.count_if("ok").alias("sent"),
            F.count_if(~F.col("ok")).alias("failed"),
        )
        .select(
            F.col("slot.start").alias("window_start"),
            "processed",
            "sent",
            "failed",
            (F.col("sent") / seconds).alias("rate_per_second"),
        )
    )


def write_counters(counters: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Write the windows that changed in each micro-batch, in place of their last state.

    The table has one folder a day, however many batches there were: a batch rewrites the days that it touches. A
    repeated batch brings the same windows and changes nothing.
    """

    def save(changed: DataFrame, batch_id: int) -> None:
        spark = changed.sparkSession
        new = stage(changed.select(*COLUMNS, F.to_date("window_start").alias("day")), "counted")
        days = [r["day"] for r in new.select("day").distinct().collect()]
        if not days:
            return
        stored = _stored(spark, path)
        if stored is not None:
            kept = stored.filter(F.col("day").isin(*days)).join(new.select("window_start"), "window_start", "left_anti")
            new = new.unionByName(kept)  # read before the commit swaps the folders
        rows = new.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        rows.partitionBy("day").parquet(path)

    writer = counters.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(save)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    return read_optional(spark, path, spark.createDataFrame([], STORED + ", day date").schema)


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """The last written state of each window."""
    found = _stored(spark, path)
    return spark.createDataFrame([], STORED) if found is None else found.select(*COLUMNS)


def counted(messages: DataFrame) -> DataFrame:
    """`messages`, with their counts riding along: `ProgressLog` stores them, and no job or shuffle is run for them."""
    ok = post_id().isNotNull()
    return messages.observe(
        SEEN, F.count(F.lit(1)).alias("processed"), F.count_if(ok).alias("sent"), F.count_if(~ok).alias("failed")
    )


class ProgressLog(StreamingQueryListener):
    """Stores the counts of `counted` for each micro-batch of the session's streams, and the rows of their state.

    Add it with `spark.streams.addListener` before the stream starts. A batch has a folder of its own: one that is
    repeated replaces it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended = threading.Event()

    def onQueryStarted(self, event: Any) -> None:
        self.ended.clear()

    def onQueryProgress(self, event: Any) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(SEEN)
        if seen is None or not progress.numInputRows:
            return
        state = sum(s.numRowsTotal for s in progress.stateOperators)
        row = (seen["processed"], seen["sent"], seen["failed"], state)
        log = self.spark.createDataFrame([row], PROGRESS.replace("batch_id long, ", "")).coalesce(1)
        log.write.mode("overwrite").parquet(f"{self.path}/batch_id={progress.batchId}")

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        self.ended.set()

    def wait(self, seconds: float = 60) -> None:
        """Until the last stream's end has reached the log: its progress arrives before."""
        if not self.ended.wait(seconds):
            raise TimeoutError("the stream's progress has not arrived")


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    found = read_optional(spark, path, spark.createDataFrame([], PROGRESS).schema)
    return spark.createDataFrame([], PROGRESS) if found is None else found


def late_messages(progress: DataFrame, counters: DataFrame) -> DataFrame:
    """One row: messages that were processed, counted in a window, and too late for theirs."""
    total = lambda df: F.coalesce(df.agg(F.sum("processed")).scalar(), F.lit(0))
    row = progress.sparkSession.range(1).select(total(progress).alias("processed"), total(counters).alias("counted"))
    return row.withColumn("late", F.col("processed") - F.col("counted"))
