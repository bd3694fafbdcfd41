"""Batches of rows that share a shape, for functions that need stacked input."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shapeloom.functions.arithmetic import int_div
from shapeloom.functions.buckets import BucketGrid, assign_bucket
from shapeloom.operators.ordered import number_rows

BatchFn = Callable[[pd.DataFrame], pd.DataFrame]


#: Rows that wait for their batch to fill may hold so much in a task.
HELD_BYTES = 512 << 20


def chunk_rows(df: DataFrame, shape: list[str], order: list[str], batch_size: int, block: Column | None = None) -> DataFrame:
    """Add ``chunk`` and ``chunk_pos``: full chunks of ``batch_size`` per shape, then the rest.

    Positions come from ``number_rows``, so a shape holding a third of all rows is
    numbered by many tasks.
    """
    numbered = number_rows(df, shape, order, block, "shape_position")
    zero_based = F.col("shape_position") - 1
    return numbered.withColumns(
        {
            "chunk": int_div(zero_based, batch_size),
            "chunk_pos": (zero_based % batch_size).cast("bigint"),
        }
    ).drop("shape_position")


def split_on_keys(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Re-cut sorted Arrow batches so that each yielded frame is one whole key run."""
    held: list[pd.DataFrame] = []
    held_key: tuple | None = None
    for pdf in batches:
        if pdf.empty:
            continue
        columns = pdf[keys]
        starts = (columns != columns.shift()).any(axis=1).to_numpy().nonzero()[0].tolist()
        if not starts or starts[0] != 0:
            starts.insert(0, 0)
        for begin, end in zip(starts, starts[1:] + [len(pdf)]):
            run = pdf.iloc[begin:end]
            key = tuple(run[keys].iloc[0])
            if held and key != held_key:
                yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True)
                held = []
            held_key = key
            held.append(run)
    if held:
        yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True)


def apply_batches(chunked: DataFrame, shape: list[str], fn: BatchFn, schema: T.StructType | str, order: list[str] | None = None, tasks: int | None = None) -> DataFrame:
    """Run ``fn`` once per ``(shape, chunk)`` on a frame of at most one batch.

    Rows are exchanged by (shape, chunk), not by shape: a hot shape spreads as
    evenly as its chunks do. A task holds one batch at a time. The task count is
    explicit (default ``spark.sql.shuffle.partitions``): adaptive execution would
    size tasks by the rows' bytes, which say little about the cost of ``fn``.
    """
    keys = [*shape, "chunk"]
    tasks = tasks or int(chunked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = chunked.repartition(tasks, *[F.col(k) for k in keys]).sortWithinPartitions(*keys, *(order or ["chunk_pos"]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in split_on_keys(batches, keys):
            yield fn(frame)

    return placed.mapInPandas(run, schema)


def apply_local_batches(df: DataFrame, shape: list[str], fn: BatchFn, schema: T.StructType | str, batch_size: int, held_bytes: int = HELD_BYTES) -> DataFrame:
    """Like ``apply_batches`` without any exchange: batches form inside each input partition.

    Use it when rows carry pixels and ``shape`` has few values (bucket sizes): a
    task holds at most ``batch_size`` rows per shape, and what waits is worked off early
    once it exceeds ``held_bytes``. Rows keep their own results whatever batch they
    fall into.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[tuple, list[pd.DataFrame]] = {}
        for pdf in batches:
            for key, rows in pdf.groupby(shape, sort=False, dropna=False):
                held = waiting.setdefault(key, [])
                held.append(rows)
                if sum(map(len, held)) >= batch_size:
                    ready = pd.concat(held, ignore_index=True)
                    whole = len(ready) // batch_size * batch_size
                    for begin in range(0, whole, batch_size):
                        yield fn(ready.iloc[begin : begin + batch_size].reset_index(drop=True))
                    waiting[key] = [ready.iloc[whole:].copy()] if whole < len(ready) else []
            if sum(int(rows.memory_usage(deep=True).sum()) for held in waiting.values() for rows in held) > held_bytes:
                for key, held in waiting.items():
                    if held:
                        yield fn(pd.concat(held, ignore_index=True))
                        waiting[key] = []
        for held in waiting.values():
            if held:
                yield fn(pd.concat(held, ignore_index=True))

    return df.mapInPandas(run, schema)


def map_frames(df: DataFrame, fn: Callable[[pd.DataFrame, int, object], pd.DataFrame], schema: T.StructType | str, make_state: Callable[[], object] | None = None) -> DataFrame:
    """``fn(frame, worker, state)`` on every Arrow batch, for work columns cannot express.

    ``worker`` is the partition index (to pick a device) and ``state`` whatever
    ``make_state`` loaded, once per task. Filter with column expressions beforehand:
    the optimizer cannot move a filter across this call.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker = TaskContext.get().partitionId()
        state = make_state() if make_state else None
        for frame in batches:
            yield fn(frame, worker, state)

    return df.mapInPandas(run, schema)


def first_in_file(images: DataFrame, file: str, order: str, grid: BucketGrid) -> DataFrame:
    """One row per file: the bucket of its first image (map-side-combined ``min_by``)."""
    first = images.groupBy(file).agg(F.min_by(F.struct("width", "height"), order).alias("first"))
    return assign_bucket(first.select(file, "first.width", "first.height"), grid)


def spread_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Give rows that feed costly per-row work at least one task per core.

    Call it on a scan. One with fewer partitions than the cluster has slots is
    exchanged; large inputs already split well and pass through untouched.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= slots:
        return df
    return df.repartition(slots, *[F.col(k) for k in keys])


def shape_histogram(df: DataFrame, shape: list[str]) -> DataFrame:
    return df.groupBy(*shape).agg(F.count(F.lit(1)).alias("images"))
