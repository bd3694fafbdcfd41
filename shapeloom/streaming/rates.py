"""The smoothed rate of running jobs, kept up to date on a stream.

Each run has its own state: polls that may still be overtaken by older ones, the
interval that is open, and the last five rates. A timer fires when the watermark has
passed the earliest poll that waits; until then all of them do. So results do not depend on how the input was cut
into micro-batches, and a restart goes on where the state was left.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shapeloom.operators.intervals import LEAST_SECONDS
from shapeloom.operators.metrics import SMOOTHING_INTERVALS

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _by_time(at: np.ndarray, images: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Polls in order of time, those of one time as one."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    return at[first], np.add.reduceat(images[order], first)


def _packed(at: np.ndarray, images: np.ndarray) -> tuple[bytes, bytes]:
    return at.astype("<f8").tobytes(), images.astype("<i8").tobytes()


def _unpacked(at: bytes, images: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(at, "<f8"), np.frombuffer(images, "<i8")


class SmoothedRate(StatefulProcessor):
    """Merges a run's polls into intervals and averages the rates of the last ones that had images.

    With ``seconds`` every row is an interval of that length; without, polls are merged
    until ``least`` seconds have passed since the last interval, and a run's first poll
    starts its clock.
    """

    def __init__(self, least: float, seconds: float | None, keep: int, names: list[str]) -> None:
        self.least, self.seconds, self.keep, self.names = least, seconds, keep, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "at binary, images binary")  # packed columns, a pair for every frame
        self.open = handle.getValueState("open", "since double, waiting bigint")
        self.rates = handle.getListState("rates", "rate double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        earliest = math.inf
        for frame in rows:
            if len(frame):
                self.pending.appendList([_packed(*_by_time(frame["poll_at"].to_numpy(np.float64), frame["poll_images"].to_numpy(np.int64)))])
                earliest = min(earliest, float(frame["poll_at"].min()))
        if earliest < math.inf:
            self.handle.registerTimer(math.ceil(earliest * 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Works off what the watermark has passed; the earliest poll that goes on waiting gets the next timer."""
        upto = timerValues.getCurrentWatermarkInMs() / 1000
        held = [_unpacked(*x) for x in self.pending.get()] if self.pending.exists() else []
        if not held:
            return
        at, images = _by_time(*map(np.concatenate, zip(*held)))
        due = int(np.searchsorted(at, upto, "right"))
        if not due:
            return
        if due < len(at):
            self.pending.put([_packed(at[due:], images[due:])])
            self.handle.registerTimer(math.ceil(float(at[due]) * 1000))
        else:
            self.pending.clear()
        out = [(*key, *row) for row in self._closed(at[:due], images[:due])]
        if out:
            yield pd.DataFrame(out, columns=self.names)

    def _intervals(self, at: np.ndarray, images: np.ndarray, since: float | None, held: int) -> Iterator[tuple[float, int, float, float, int]]:
        """``(at, images, seconds, since, held)`` of the intervals that end at these polls; the last one, without images, stays open."""
        begin = 0
        if since is None:
            since, begin = float(at[0]), 1
        before = np.concatenate(([0], np.cumsum(images)))
        while (end := max(begin, int(np.searchsorted(at, since + self.least)))) < len(at):
            ended = float(at[end])
            yield ended, held + int(before[end + 1] - before[begin]), ended - since, ended, 0
            since, held, begin = ended, 0, end + 1
        yield since, 0, 0.0, since, held + int(before[-1] - before[begin])

    def _closed(self, at: np.ndarray, images: np.ndarray) -> Iterator[tuple[float, int, float]]:
        """Intervals that end at these polls, with the mean of the last rates; idle ones give none."""
        rates = [r for (r,) in self.rates.get()] if self.rates.exists() else []
        since, held = self.open.get() if self.open.exists() else (None, 0)
        if self.seconds is None:
            ended = self._intervals(at, images, since, held)
        else:
            ended = ((a, n, self.seconds, since, held) for a, n in zip(at.tolist(), images.tolist()))
        for end, count, length, since, held in ended:
            if count > 0 and length > 0:
                rates = [*rates, count / length][-self.keep :]
                yield end, count, sum(rates) / len(rates)
        if since is not None:
            self.open.update((since, held))
        if rates:
            self.rates.put([(r,) for r in rates])

    def close(self) -> None:
        pass


def stream_rates(polls: DataFrame, by: list[str], time: str, images: str, late_by: str | None = "10 seconds", least_seconds: float = LEAST_SECONDS, seconds: float | None = None) -> DataFrame:
    """``(*by, at, images, smoothed_rate)``: one row per closed interval, appended as the watermark passes it.

    ``time`` is a timestamp; ``late_by`` sets its watermark (None: it has one). Polls
    that come later than that are lost, as in any watermarked query; null times and
    images count as no poll and 0.
    """
    marked = polls if late_by is None else polls.withWatermark(time, late_by)
    slim = marked.where(F.col(time).isNotNull()).select(
        *by, time, (F.unix_micros(time) / F.lit(1e6)).alias("poll_at"), F.coalesce(F.col(images).cast("bigint"), F.lit(0)).alias("poll_images")
    )
    fields = [polls.schema[c] for c in by]
    schema = T.StructType([*fields, T.StructField("at", T.DoubleType()), T.StructField("images", T.LongType()), T.StructField("smoothed_rate", T.DoubleType())])
    processor = SmoothedRate(least_seconds, seconds, SMOOTHING_INTERVALS, schema.names)
    return slim.groupBy(*by).transformWithStateInPandas(processor, schema, "Append", "EventTime")


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which processors with timers need."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def write_rates(rates: DataFrame, output: str, checkpoint: str) -> None:
    """Append all intervals that the available input closes to the Parquet table ``output``; call again to go on."""
    with keyed_state(rates.sparkSession):
        query = rates.writeStream.format("parquet").outputMode("append").option("path", output).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
