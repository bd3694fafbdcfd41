"""Cutting one large tar shard into ranges that several tasks can walk.

A tar has no index, but headers stand at multiples of 512 bytes and carry a mark and a
checksum. Each range's task looks for the first header from which the chain of
headers goes on to the range's end; a header that lies inside a payload, in a tar within
the tar, soon breaks that chain or is found out below. Then the ranges are linked
from the shard's first header: where a range's guess is the place that the range before
it leads to, it stands; where it is not, that range alone is walked again from there.
So the ranges that come out are those of the sequential walk.
"""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from shapeloom.sources.files import resolve

BLOCK = tarfile.BLOCKSIZE
# The mark of a header and where it stands.
MARK, MARK_AT = b"ustar", 257
_SCAN, _WINDOW = 1 << 20, 1 << 16
#: How often a shard's guesses may be wrong before the rest of it is walked by one task.
_MISSES = 16
_GUESS = "shard string, begin bigint, end bigint, size bigint, entry bigint, onto bigint"


def is_header(block: bytes) -> bool:
    """Whether a block has the mark and a right checksum."""
    if len(block) < BLOCK or block[MARK_AT : MARK_AT + len(MARK)] != MARK:
        return False
    try:
        tarfile.TarInfo.frombuf(block, tarfile.ENCODING, "surrogateescape")
    except tarfile.HeaderError:
        return False
    return True


def headers_from(stream, begin: int, end: int) -> Iterator[int]:
    """Places of headers at or behind ``begin`` and before ``end``, by mark and checksum alone."""
    at = -(-begin // BLOCK) * BLOCK
    while at < end:
        stream.seek(at)
        data = stream.read(min(_SCAN, -(-(end - at) // BLOCK) * BLOCK))
        whole = len(data) // BLOCK
        if not whole:
            return
        blocks = np.frombuffer(data, np.uint8, whole * BLOCK).reshape(whole, BLOCK)
        marked = (blocks[:, MARK_AT : MARK_AT + len(MARK)] == np.frombuffer(MARK, np.uint8)).all(1)
        for i in np.flatnonzero(marked).tolist():
            if is_header(blocks[i].tobytes()):
                yield at + i * BLOCK
        at += whole * BLOCK


def chain_end(stream, begin: int, end: int, size: int) -> tuple[int | None, int]:
    """Where the chain of members from ``begin`` leads: the first at or behind ``end``, or ``size`` if the archive ends before.

    None where the chain breaks (what follows is neither a header nor zeros to the
    end); with the place where it stopped.
    """
    stream.seek(begin)
    try:
        with tarfile.open(fileobj=stream, mode="r:") as tar:
            for info in tar:
                tar.members = []  # the walk keeps no list
                if info.offset >= end:
                    return info.offset, info.offset
            at = tar.offset
    except (tarfile.TarError, ValueError, EOFError):
        return None, begin
    stream.seek(at)
    ended = False
    while data := stream.read(_SCAN):
        if data.strip(b"\0"):
            return None, at
        ended = True
    return (size if ended else None), at


def guess(stream, begin: int, end: int, size: int) -> tuple[int | None, int | None]:
    """The first header of a range from which a chain leads out of it, and where that leads.

    Headers that a broken chain has passed are not tried again; a right one among them
    costs a second walk, not a wrong result.
    """
    at = begin
    while (entry := 0 if begin == 0 and at == 0 else next(headers_from(stream, at, end), None)) is not None:
        onto, stopped = chain_end(stream, entry, end, size)
        if onto is not None:
            return entry, onto
        at = max(stopped, entry + BLOCK)
    return None, None


def _walked(spark: SparkSession, folder: str, rows: list[tuple]) -> list:
    """``(shard, begin, end, size, entry, None)``: where each range begins (a guess where ``entry`` is None) and leads."""
    base = folder.rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, inner = resolve(f"{base}/{row['shard']}")
                with io.BufferedReader(system.open_input_file(inner), _WINDOW) as stream:
                    if row["entry"] is None:
                        row["entry"], row["onto"] = guess(stream, row["begin"], row["end"], row["size"])
                    else:
                        row["onto"] = chain_end(stream, row["entry"], row["end"], row["size"])[0]
                yield pa.RecordBatch.from_pylist([row], batch.schema)

    frame: DataFrame = spark.createDataFrame(rows, _GUESS)
    return frame.repartition(len(rows)).mapInArrow(run, _GUESS).collect()


def plan_ranges(spark: SparkSession, folder: str, shards: list[tuple[str, int]], range_bytes: int) -> dict[str, list[list[int | None]]]:
    """Per shard the ranges ``[first member, end]`` that together are its sequential walk.

    The driver holds one entry per range, as it does for the splits of any file.
    """
    rows = [(s, a, min(a + range_bytes, size), size, None, None) for s, size in shards for a in range(0, size, range_bytes)]
    guesses = {(r.shard, r.begin): (r.entry, r.onto) for r in _walked(spark, folder, rows)}
    out: dict[str, list[list[int | None]]] = {s: [] for s, _ in shards}
    at, misses = {s: 0 for s, _ in shards}, {s: 0 for s, _ in shards}
    sizes, going = dict(shards), [s for s, _ in shards]
    while going:
        stuck = []
        for shard in going:
            size = sizes[shard]
            while at[shard] < size:
                begin = at[shard] // range_bytes * range_bytes
                entry, onto = guesses[shard, begin]
                if entry != at[shard]:
                    stuck.append((shard, begin, min(begin + range_bytes, size), size, at[shard], None))
                    break
                if onto is None:  # the true chain breaks here: the walk reports it
                    out[shard].append([entry, None])
                    break
                out[shard].append([entry, min(begin + range_bytes, size) if onto < size else None])
                at[shard] = onto
        for row in stuck:
            misses[row[0]] += 1
        given_up = [r for r in stuck if misses[r[0]] > _MISSES]
        for shard, _, _, _, entry, _ in given_up:
            out[shard].append([entry, None])
        again = [r for r in stuck if misses[r[0]] <= _MISSES]
        for r in _walked(spark, folder, again) if again else []:
            guesses[r.shard, r.begin] = (r.entry, r.onto)
        going = [r[0] for r in again]
    return out
