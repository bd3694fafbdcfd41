"""Live throughput over event streams, and a lasting record of what streams did."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS_SCHEMA = "query string, run string, batch bigint, at string, input_rows bigint, seconds double, late_rows bigint"


def throughput(events: DataFrame, time: str, window: str, late_by: str, by: list[str]) -> DataFrame:
    """Events per ``window`` and ``by``; works on streams and on tables.

    ``time`` may be a zone-less timestamp; watermarks need an instant, so it is cast.
    """
    stamped = events.withColumn("event_time", F.col(time).cast("timestamp")).withWatermark("event_time", late_by)
    counted = stamped.groupBy(F.window("event_time", window), *by).agg(F.count(F.lit(1)).alias("images"))
    length = F.unix_timestamp("window.end") - F.unix_timestamp("window.start")
    return counted.select(
        F.col("window.start").alias("window_start"), *by, "images", (F.col("images") / length).alias("rate")
    )


class ProgressLog(StreamingQueryListener):
    """Appends one row per micro-batch to a Parquet table.

    A query itself remembers only its latest batches; this keeps all of them, also
    those of earlier runs.
    """

    def __init__(self, spark: SparkSession, location: str) -> None:
        self.spark, self.location = spark, location
        self.ended: dict[str, threading.Event] = {}
        self.problem: Exception | None = None

    def end_of(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        row = (str(p.id), str(p.runId), p.batchId, p.timestamp, p.numInputRows, p.durationMs.get("triggerExecution", 0) / 1000, late)
        try:
            self.spark.createDataFrame([row], PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.location)
        except Exception as problem:  # raised again where the stream is waited for
            self.problem = problem

    def onQueryTerminated(self, event) -> None:
        self.end_of(str(event.runId)).set()

    def wait_for(self, query, timeout: float = 120.0) -> None:
        """Until the query has ended and all its batches are in the table."""
        query.awaitTermination()
        if not self.end_of(str(query.runId)).wait(timeout):
            raise TimeoutError(f"no word of the end of run {query.runId}")
        if self.problem is not None:
            raise self.problem


@contextmanager
def progress_log(spark: SparkSession, location: str) -> Iterator[ProgressLog]:
    """Streams that run inside are recorded at ``location``."""
    log = ProgressLog(spark, location)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)


def read_progress(spark: SparkSession, location: str) -> DataFrame:
    """One row per query and batch; of a batch that was reported twice the latest."""
    rows = spark.read.schema(PROGRESS_SCHEMA).parquet(location)
    latest = F.max_by(F.struct("run", "at", "input_rows", "seconds", "late_rows"), "at")
    return rows.groupBy("query", "batch").agg(latest.alias("latest")).select("query", "batch", "latest.*")


def write_throughput(stream: DataFrame, output: str, checkpoint: str) -> int:
    """Write every window, open ones too, until all available input is read; returns the rows that came too late.

    A micro-batch writes the windows it changed under its own number, so repeating
    it after a failure replaces its rows; ``read_throughput`` takes each window's latest.
    What each batch did stays in the table ``{checkpoint}-progress``.
    """

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch={number}")

    spark, location = stream.sparkSession, f"{checkpoint}-progress"
    with progress_log(spark, location) as log:
        query = stream.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        log.wait_for(query)
    own = spark.read.schema(PROGRESS_SCHEMA).parquet(location).where(F.col("run") == str(query.runId))
    return own.agg(F.coalesce(F.sum("late_rows"), F.lit(0))).first()[0]


def read_throughput(spark: SparkSession, output: str, by: list[str]) -> DataFrame:
    """The latest counts of every window."""
    latest = F.max_by(F.struct("images", "rate"), "batch")
    return spark.read.parquet(output).groupBy("window_start", *by).agg(latest.alias("latest")).select("window_start", *by, "latest.*")
