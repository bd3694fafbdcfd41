"""Run log: which inputs are done, failed, empty or were left unfinished.

The log is an append-only table ``(path, status, attempt, run, error, logged_at)``.
Inputs are keyed by their full relative path: base names repeat across folders.

A job logs the inputs of a round as started, writes its output under ``run=<id>``
and then appends the inputs it finished with that id. The second append is the
commit: output of a round that died before it is never read, and its inputs are
still pending. Ids are never used twice.
"""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shapeloom.session import empty_table, few_listing_tasks

LOG_SCHEMA = "path string, status string, attempt int, run string, error string, logged_at timestamp"
STARTED, FINISHED, FAILED, EMPTY = "started", "finished", "failed", "empty"
#: A round that stopped for a fault of the setup gives its inputs back: they are pending, and not suspects.
RELEASED = "released"
SETTLED = [FINISHED, FAILED, EMPTY, RELEASED]


def pending_inputs(listing: DataFrame, *settled: DataFrame, path: str = "path") -> DataFrame:
    """Inputs in ``listing`` that appear in none of the ``settled`` tables."""
    if not settled:
        return listing
    done = reduce(lambda a, b: a.unionByName(b), [s.select(path) for s in settled]).distinct()
    return listing.join(done, path, "left_anti")


def crashed_inputs(log: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``keys`` (default path and attempt) that were ``started`` and never settled.

    One aggregation instead of a self anti-join.
    """
    keys = keys or ["path", "attempt"]
    per_attempt = log.groupBy(*keys).agg(
        F.bool_or(F.col("status") == STARTED).alias("began"),
        F.bool_or(F.col("status").isin(SETTLED)).alias("settled"),
    )
    return per_attempt.filter("began and not settled").select(*keys)


def quarantine(log: DataFrame) -> DataFrame:
    """Inputs to leave out of later runs: failed, or crashed while being worked on alone."""
    return _failed(log).unionByName(crashed_inputs(log).select("path")).distinct()


def suspects(log: DataFrame) -> DataFrame:
    """``(path, round_size)``: inputs of rounds that never finished, with the smallest such round.

    A lost round says little about any one of its inputs, so they are tried again in
    smaller rounds until the one that breaks its task stands alone.
    """
    sizes = log.filter(F.col("status") == STARTED).groupBy("run").agg(F.count_distinct("path").alias("round_size"))
    crashed = crashed_inputs(log, ["path", "run"])
    return crashed.join(sizes, "run").groupBy("path").agg(F.min("round_size").alias("round_size"))


def quarantine_isolated(log: DataFrame) -> DataFrame:
    """Like ``quarantine`` for rounds of many inputs: only an input that crashed alone is left out."""
    return _failed(log).unionByName(suspects(log).filter("round_size = 1").select("path")).distinct()


def _failed(log: DataFrame) -> DataFrame:
    return log.filter(F.col("status") == FAILED).select("path")


def split_rejects(df: DataFrame, problem: str = "error") -> tuple[DataFrame, DataFrame]:
    """(good rows without the problem column, rejected rows with it)."""
    return df.filter(F.col(problem).isNull()).drop(problem), df.filter(F.col(problem).isNotNull())


def shard_status(rows: DataFrame, shard: str = "shard", error: str = "error") -> DataFrame:
    """One row per shard from row-level outcomes: its counts, status and first error."""
    bad = F.col(error).isNotNull()
    counted = rows.groupBy(shard).agg(
        F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"), F.min(F.when(bad, F.col(error))).alias("error")
    )
    status = F.when(F.col("bad") > 0, F.lit(FAILED)).otherwise(F.lit(FINISHED))
    return counted.withColumn("status", status)


def read_log(spark: SparkSession, location: str) -> DataFrame:
    """The log, or an empty table where none was written yet."""
    empty = empty_table(spark, LOG_SCHEMA)
    if not path_exists(spark, location):
        return empty
    return spark.read.schema(LOG_SCHEMA).parquet(location)


def append_log(entries: DataFrame, location: str) -> None:
    """Append log rows in one file, so that they appear together or not at all.

    A call carries one entry per input of a round, which bounds its size. Missing
    columns are filled in.
    """
    have = set(entries.columns)
    fill = {
        "attempt": F.lit(1),
        "run": F.lit(None).cast("string"),
        "error": F.lit(None).cast("string"),
        "logged_at": F.current_timestamp(),
    }
    full = entries.withColumns({c: v for c, v in fill.items() if c not in have})
    rows = full.select("path", "status", F.col("attempt").cast("int").alias("attempt"), "run", "error", "logged_at")
    rows.repartition(1).write.mode("append").parquet(location)


def path_exists(spark: SparkSession, location: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def child_folders(spark: SparkSession, location: str) -> list[str]:
    """Names of what lies directly in a folder."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return [f.getPath().getName() for f in hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop_path)]


def read_committed(spark: SparkSession, output: str, log: DataFrame, within: str | None = None) -> DataFrame:
    """Output rows of the runs that reached the log (a few run ids, so partitions prune).

    With ``within``, a folder such as ``outcome=ok`` below each run's, nothing else is
    listed; where no run has it all of ``output`` is read, so filter on its column too.
    """
    runs = log.filter(F.col("status") == FINISHED).select("run").distinct()
    folders = _folders_within(spark, output, {r.run for r in runs.collect()}, within) if within else []
    with few_listing_tasks(spark):
        if folders:
            rows = spark.read.option("basePath", output).parquet(*folders)
        else:
            rows = spark.read.parquet(output)
    return rows.join(runs, "run", "left_semi")


def _folders_within(spark: SparkSession, output: str, runs: set[str], within: str) -> list[str]:
    named = [n for n in child_folders(spark, output) if n.startswith("run=") and unquote(n[4:]) in runs]
    if any(re.search(r"[\[\]{}*?\\\\]", n) for n in named):  # a reader takes these for patterns
        return []
    return [f"{output}/{n}/{within}" for n in named if path_exists(spark, f"{output}/{n}/{within}")]
