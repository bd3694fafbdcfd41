"""Incremental intake of input files with Structured Streaming.

The checkpoint remembers which files were taken, so a file is processed once even
after a restart. ``maxFilesPerTrigger`` bounds how much is in flight, and each
micro-batch writes under its own ``run`` folder, so a replayed batch overwrites
its earlier attempt instead of adding to it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shapeloom.operators.ledger import FINISHED, append_log
from shapeloom.sources.tar import relative_path, stream_shards


def stream_files(spark: SparkSession, root: str, schema: T.StructType | str, max_files: int, pattern: str = "*.parquet") -> DataFrame:
    """Parquet files under ``root`` as a stream, at most ``max_files`` per micro-batch."""
    rows = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .parquet(root)
    )
    return rows.withColumn("source_file", relative_path(spark, F.col("_metadata.file_path"), root))


def run_intake(stream: DataFrame, process: Callable[[DataFrame], DataFrame], output: str, log: str, checkpoint: str) -> int:
    """Process all files that arrived since the last call; returns the micro-batches run.

    ``stream`` has a ``source_file`` column. Output lands in ``output/run=batch-N``.
    """
    ran = 0

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal ran
        run = f"batch-{batch_id:08d}"
        process(batch).write.mode("overwrite").parquet(f"{output}/run={run}")
        files = batch.select(F.col("source_file").alias("path")).distinct()
        append_log(files.select("path", F.lit(FINISHED).alias("status"), F.lit(run).alias("run")), log)
        ran += 1

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return ran


def take_shards(spark: SparkSession, folder: str, process: Callable[[DataFrame], DataFrame], output: str, checkpoint: str, max_shards: int = 1000) -> None:
    """Process the members of all tar shards that arrived since the last call, each once.

    A micro-batch takes at most ``max_shards``; ``output`` is a Parquet table that only
    whole micro-batches enter.
    """
    members = process(stream_shards(spark, folder, f"{checkpoint}-shards", max_shards))
    query = members.writeStream.format("parquet").outputMode("append").option("path", output).option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
