"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shapeloom.session import shared_dir


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Write ``frame`` into the cluster's shared folder and read it back.

    Cuts the lineage: what follows reads files, so neither a lost executor nor a
    second use repeats the work before this point.
    """
    path = shared_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def set_aside(frame: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``frame`` without names that begin with two underscores, which operators use for themselves, and what to rename them back from."""
    back: dict[str, str] = {}
    for name in frame.columns:
        if name.startswith("__"):
            new = f"kept{name}"
            while new in frame.columns or new in back:
                new = f"kept_{new}"
            back[new] = name
    return frame.withColumnsRenamed({old: new for new, old in back.items()}), back


def ship(frame: DataFrame) -> None:
    """Make this package importable in the Python tasks that ``frame`` will run."""
    from shapeloom.session import ship_package

    ship_package(frame.sparkSession)


def share(*parts: Column | str, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the values of ``parts`` and the seed alone."""
    high = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts), 11)
    return high.cast("double") / F.lit(float(1 << 53))


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column (null: empty) and the n + 1 offsets into them, without copying texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    values = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return values[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows that hold at most ``limit`` bytes together; a longer row stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Regroup sorted batches so that no run of equal ``keys`` is cut; a table may hold several runs."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = 0
        for row in range(batch.num_rows - 1, 0, -1):
            if any(batch[k][row].as_py() != batch[k][row - 1].as_py() for k in keys):
                cut = row
                break
        if held and not cut and any(held[-1][k][-1].as_py() != batch[k][0].as_py() for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of sorted key values begins, and the length at the end."""
    n = len(keys[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = False
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
    return np.append(np.flatnonzero(new), n)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
