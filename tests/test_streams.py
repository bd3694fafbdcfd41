"""Rates with state, and the record of a stream's batches."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from shapeloom.operators import intervals, metrics
from shapeloom.streaming import progress, rates

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def poll_rows(seed, n=120):
    draw = np.random.default_rng(seed)
    out = []
    for run in ("a", "b", None):
        at = np.cumsum(draw.exponential(0.4, n)).round(3)
        out += [(run, START + dt.timedelta(seconds=float(t)), int(k)) for t, k in zip(at, draw.integers(0, 5, n))]
    return out


SCHEMA = "run string, ts timestamp, n bigint"


def take(spark, root, late_by="5 seconds"):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    rates.write_rates(rates.stream_rates(stream, ["run"], "ts", "n", late_by, 1.0), f"{root}/out", f"{root}/mark")


def test_polls_on_a_stream_with_a_restart(spark, tmp_path):
    rows = sorted(poll_rows(3), key=lambda r: r[1])
    end = [(run, START + dt.timedelta(days=1), 0) for run in ("a", "b", None)]
    draw = np.random.default_rng(1)
    for part in range(6):
        own = rows[part * 60 : (part + 1) * 60] + (end if part == 5 else [])
        shuffled = [own[i] for i in draw.permutation(len(own))]
        spark.createDataFrame([*shuffled, ("a", None, 3)], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        if part in (1, 3):
            take(spark, tmp_path)
    take(spark, tmp_path)
    take(spark, tmp_path)
    polls = spark.createDataFrame(rows, SCHEMA).withColumn("at", F.unix_micros("ts") / F.lit(1e6))
    merged = intervals.merge_polls(polls, ["run"], "at", "n", 1.0)
    wanted = metrics.smoothed_rate(merged, ["run"], ["at"], "n", "seconds", F.lit(0)).collect()
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert len(got) == len(wanted) > 50
    have = {(r.run, r.at): (r.images, r.smoothed_rate) for r in got}
    for r in wanted:
        images, mean = have[r.run, r.at]
        assert images == r.n and mean == pytest.approx(r.smoothed_rate, rel=1e-12)


def test_the_listener_keeps_every_batch(spark, tmp_path, settings):
    settings({"spark.sql.streaming.numRecentProgressUpdates": "5"})
    rows = [(i, START + dt.timedelta(minutes=i)) for i in range(30)]
    spark.createDataFrame(rows, "id bigint, ts timestamp").repartition(30, "id").sortWithinPartitions("id").write.option("maxRecordsPerFile", 1).parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id bigint, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    counted = progress.throughput(stream, "ts", "1 hour", "0 seconds", [])
    late = progress.write_throughput(counted, f"{tmp_path}/rows", f"{tmp_path}/mark")
    seen = progress.read_progress(spark, f"{tmp_path}/mark-progress").collect()
    assert sum(r.input_rows for r in seen) == 30 and sum(r.input_rows > 0 for r in seen) == 30 and all(r.seconds > 0 for r in seen)
    kept = progress.read_throughput(spark, f"{tmp_path}/rows", []).agg(F.sum("images")).first()[0]
    assert kept + late == 30 and late == sum(r.late_rows for r in seen)
    again = progress.write_throughput(counted, f"{tmp_path}/rows", f"{tmp_path}/mark")
    assert again == 0
