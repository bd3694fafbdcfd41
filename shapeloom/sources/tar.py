"""Tar shards as a Spark data source.

``spark.read.format("tarmembers").load(folder)`` walks member headers only, seeking
over payloads. A row says where a member lies, carries the text of JSON sidecars, and
for images the dimensions read from the image header. Pixel bytes stay in the shard
until ``fetch_members`` reads the byte ranges that survived all joins and filters.

Filters on the shard decide which shards are opened, filters on the member's name
which payloads are looked into. ``scan_tar`` cuts a large shard into ranges that
several tasks walk (see ``tar_ranges``). The same source reads shards as a stream.
"""

from __future__ import annotations

import bz2
import gzip
import io
import json
import lzma
import tarfile
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringEndsWith, StringStartsWith

from shapeloom.functions.image_header import HEADER_BYTES, Truncated, read_header
from shapeloom.sources import tar_ranges
from shapeloom.sources.files import file_sizes, list_files, resolve

MEMBER_SCHEMA = (
    "shard string, member string, offset bigint, size bigint, content string, "
    "width bigint, height bigint, mode string, error string"
)
ROWS_PER_BATCH = 4096
TASK_BYTES = 256 << 20
TASKS_PER_SLOT = 4
RANGE_BYTES = 1 << 30
WALK_WINDOW = 8 << 20
FETCH_WINDOW = 1 << 20
SHARD_SUFFIXES = (".tar", ".tar.gz", ".tgz", ".tar.bz2", ".tar.xz")
#: The first bytes of gzip, bzip2 and xz.
COMPRESSED = ((b"\x1f\x8b", gzip.open), (b"BZh", bz2.open), (b"\xfd7zXZ\0", lzma.open))


PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


class ShardPartition(InputPartition):
    """Stretches ``(path, shard, begin, end)``: members of a shard that begin at ``begin`` or behind it, before ``end`` (None: the shard's end)."""

    def __init__(self, stretches: list[tuple[str, str, int, int | None]]):
        self.stretches = stretches

    def rows(self, names: MemberNames | None = None) -> Iterator[tuple]:
        for path, shard, begin, end in self.stretches:
            yield from walk_members(path, shard, begin, end, names)


class MemberNames:
    """What pushed filters ask of a member's name."""

    def __init__(self) -> None:
        self.asked = False
        self.names: set[str] | None = None
        self.starts: list[str] = []
        self.ends: list[str] = []

    def take(self, test: Filter) -> bool:
        if isinstance(test, EqualTo | In):
            values = {test.value} if isinstance(test, EqualTo) else set(test.value)
            self.names = values if self.names is None else self.names & values
        elif isinstance(test, StringStartsWith):
            self.starts.append(test.value)
        elif isinstance(test, StringEndsWith):
            self.ends.append(test.value)
        elif not isinstance(test, IsNotNull):
            return False
        self.asked = True
        return True

    def wants(self, name: str) -> bool:
        return (self.names is None or name in self.names) and all(map(name.startswith, self.starts)) and all(map(name.endswith, self.ends))


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS_PER_BATCH:
            yield _record_batch(held)
            held = []
    if held:
        yield _record_batch(held)


class TarMemberReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.folder = options["path"].rstrip("/")
        self.groups = json.loads(options["groups"]) if "groups" in options else None
        self.only: set[str] | None = None
        self.names = MemberNames()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes equality and lists on the shard, and those and prefixes and suffixes on the member."""
        for test in filters:
            column = getattr(test, "attribute", None)
            if column == ("shard",) and isinstance(test, EqualTo | In):
                values = {test.value} if isinstance(test, EqualTo) else set(test.value)
                self.only = values if self.only is None else self.only & values
            elif column == ("shard",) and isinstance(test, IsNotNull):
                continue
            elif column != ("member",) or not self.names.take(test):
                yield test

    def partitions(self) -> list[ShardPartition]:
        groups = self.groups
        if groups is None:
            groups = [[[p[len(self.folder) :].lstrip("/"), 0, None]] for p in list_files(self.folder, SHARD_SUFFIXES)]
        taken = [[(f"{self.folder}/{s}", s, a, b) for s, a, b in group if self.only is None or s in self.only] for group in groups]
        return [ShardPartition(stretches) for stretches in taken if stretches]

    def read(self, partition: ShardPartition) -> Iterator[pa.RecordBatch]:
        return _batches(partition.rows(self.names))


class ShardStreamReader(DataSourceStreamReader):
    """Shards of a folder as they arrive, each once, at most ``maxshards`` per micro-batch.

    Which shards an offset stands for is written down, in one small file per offset in
    the folder ``seen``, before the offset is handed out; so a restart reads the same
    shards again, and names that sort before older ones are not lost.
    """

    def __init__(self, schema: T.StructType, options: dict):
        self.folder = options["path"].rstrip("/")
        self.seen, self.most = options["seen"].rstrip("/"), int(options.get("maxshards", "1000"))
        self.known: dict[int, list[str]] | None = None

    def initialOffset(self) -> dict:
        return {"number": 0}

    def _log(self) -> dict[int, list[str]]:
        if self.known is None:
            self.known = {}
            system, inner = resolve(self.seen)
            system.create_dir(inner, recursive=True)
            for path in list_files(self.seen, ".json"):
                own, place = resolve(path)
                with own.open_input_stream(place) as stream:
                    self.known[int(path.rsplit("/", 1)[1][:-5])] = json.loads(stream.read())
        return self.known

    def latestOffset(self) -> dict:
        log = self._log()
        listed = [p[len(self.folder) :].lstrip("/") for p in list_files(self.folder, SHARD_SUFFIXES)]
        old = {s for batch in log.values() for s in batch}
        fresh = sorted(s for s in listed if s not in old)[: self.most]
        last = max(log, default=0)
        if fresh:
            last += 1
            system, inner = resolve(f"{self.seen}/{last:012d}")
            with system.open_output_stream(inner) as stream:
                stream.write(json.dumps(fresh).encode())
            system.move(inner, f"{inner}.json")
            log[last] = fresh
        return {"number": last}

    def partitions(self, start: dict, end: dict) -> list[ShardPartition]:
        log = self._log()
        return [ShardPartition([(f"{self.folder}/{s}", s, 0, None)]) for n in range(start["number"] + 1, end["number"] + 1) for s in log[n]]

    def read(self, partition: ShardPartition) -> Iterator[pa.RecordBatch]:
        return _batches(partition.rows())


class TarMemberSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tarmembers"

    def schema(self) -> str:
        return MEMBER_SCHEMA

    def reader(self, schema: T.StructType) -> TarMemberReader:
        return TarMemberReader(schema, self.options)

    def streamReader(self, schema: T.StructType) -> ShardStreamReader:
        return ShardStreamReader(schema, self.options)


_ARROW_TYPES = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
_ARROW_NAMES = [part.split()[0] for part in MEMBER_SCHEMA.split(", ")]


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), _ARROW_TYPES)]
    return pa.RecordBatch.from_arrays(columns, _ARROW_NAMES)


def walk_members(path: str, shard: str, begin: int = 0, end: int | None = None, names: MemberNames | None = None) -> Iterator[tuple]:
    """Rows of ``MEMBER_SCHEMA``; a shard that cannot be read to its end mark ends in an error row.

    A damaged header and a cut at a member's border both look like the end to the
    archive reader, so what stands where it stopped decides: zeros, or an error. With
    ``begin``, a member's place, and ``end`` only members that begin between them come
    back. Filters on names leave error rows out, as they have no name.
    """
    names = names or MemberNames()
    try:
        with open_shard(path) as stream:
            stream.seek(begin)
            with tarfile.open(fileobj=stream, mode="r:") as tar:
                for info in tar:
                    if end is not None and info.offset >= end:
                        return
                    if info.isfile() and names.wants(info.name):
                        yield _member_row(stream, shard, info)
                stream.seek(tar.offset)
                block = stream.read(tarfile.BLOCKSIZE)
                if names.asked:
                    return
                if len(block) < tarfile.BLOCKSIZE:
                    yield _error_row(shard, "shard ends without an end mark")
                elif block.strip(b"\0"):
                    yield _error_row(shard, f"damaged header at byte {tar.offset}")
    except (tarfile.TarError, OSError, EOFError, ValueError, zlib.error, lzma.LZMAError) as problem:
        if not names.asked:
            yield _error_row(shard, f"{type(problem).__name__}: {problem}")


def open_shard(path: str, window: int = WALK_WINDOW) -> io.BufferedReader:
    """A shard as seekable bytes, unpacked where it is compressed (gzip, bzip2, xz).

    Reads go through a window, so walking small members costs one request per
    window. Positions in a compressed shard are those of the unpacked bytes; reading
    them in order unpacks it once, going back starts over.
    """
    system, inner = resolve(path)
    raw = system.open_input_file(inner)
    magic = raw.read(6)
    raw.seek(0)
    for start, unpack in COMPRESSED:
        if magic.startswith(start):
            return io.BufferedReader(unpack(io.BufferedReader(raw, window)), window)
    return io.BufferedReader(raw, window)


def _error_row(shard: str, message: str) -> tuple:
    return (shard, None, None, None, None, None, None, None, message)


def _member_row(stream, shard: str, info: tarfile.TarInfo) -> tuple:
    name = info.name
    place = (shard, name, info.offset_data, info.size)
    if name.endswith(".json"):
        try:
            return (*place, _read(stream, info.offset_data, info.size).decode("utf-8"), None, None, None, None)
        except UnicodeDecodeError:
            return (*place, None, None, None, None, None)  # no text: its image is rejected as malformed
    if name.endswith(".jpg"):
        try:
            def fetch(at: int, size: int) -> bytes:
                return _read(stream, info.offset_data + at, max(0, min(size, info.size - at)))

            try:
                header = read_header(fetch(0, HEADER_BYTES), fetch)
            except Truncated:
                header = read_header(fetch(0, info.size))
            return (*place, None, *header, None)
        except (Truncated, ValueError):
            pass  # dimensions stay null: the row is rejected later, the shard goes on
    return (*place, None, None, None, None, None)


def _read(stream: io.BufferedReader, offset: int, size: int) -> bytes:
    back = stream.tell()
    stream.seek(offset)
    data = stream.read(size)
    stream.seek(back)
    return data


def scan_tar(spark: SparkSession, folder: str, shards: list[str] | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Every regular member of every shard under ``folder``, or of the named shards only.

    An unpacked shard above ``range_bytes`` is walked by several tasks.
    """
    spark.dataSource.register(TarMemberSource)
    if spark.conf.get(PUSHDOWN, None) in (None, "false"):
        spark.conf.set(PUSHDOWN, "true")  # else Spark refuses a source that takes filters
    base = folder.rstrip("/")
    names = shards if shards is not None else [p[len(base) :].lstrip("/") for p in list_files(base, SHARD_SUFFIXES)]
    sizes = {p[len(base) :].lstrip("/"): size for p, size in file_sizes([f"{base}/{s}" for s in names])}
    large = [(s, size) for s, size in sizes.items() if size > range_bytes and s.endswith(".tar")]
    ranges = tar_ranges.plan_ranges(spark, folder, large, range_bytes) if large else {}
    groups = group_shards(names, sizes, ranges, TASKS_PER_SLOT * spark.sparkContext.defaultParallelism)
    return spark.read.format("tarmembers").option("groups", json.dumps(groups)).load(folder)


def group_shards(names: list[str], sizes: dict[str, int], ranges: dict[str, list], tasks: int) -> list[list[list]]:
    """``[shard, begin, end]`` of every task: ranges of large shards stand alone, small shards share one up to a ``tasks``-th of all bytes."""
    most = min(TASK_BYTES, sum(sizes.values()) // tasks)
    groups, own, held = [], [], 0
    for name in names:
        if name in ranges:
            groups += [[[name, a, b]] for a, b in ranges[name]]
            continue
        size = sizes.get(name, 0)
        if own and held + size > most:
            groups.append(own)
            own, held = [], 0
        own.append([name, 0, None])
        held += size
    return [*groups, own] if own else groups


def stream_shards(spark: SparkSession, folder: str, seen: str, max_shards: int = 1000) -> DataFrame:
    """Members of the shards under ``folder`` as a stream; ``seen`` keeps which shards were taken, beside the checkpoint."""
    spark.dataSource.register(TarMemberSource)
    return spark.readStream.format("tarmembers").option("seen", seen).option("maxshards", str(max_shards)).load(folder)


def list_shards(spark: SparkSession, folder: str) -> DataFrame:
    """``(shard)``: relative names, listed by Spark without opening the files."""
    return list_inputs(spark, folder, "*{" + ",".join(SHARD_SUFFIXES) + "}").withColumnRenamed("path", "shard")


def list_inputs(spark: SparkSession, folder: str, pattern: str, with_length: bool = False) -> DataFrame:
    """``(path)``, or ``(path, length)``: files under ``folder`` relative to it; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    path = relative_path(spark, F.col("_metadata.file_path"), folder).alias("path")
    return files.select(path, "length") if with_length else files.select(path)


def relative_path(spark: SparkSession, path: Column, folder: str) -> Column:
    """``_metadata.file_path`` (a percent-encoded URI) as a plain path below ``folder``."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toUri()
    start = len(root.getPath().rstrip("/")) + 2
    plain = F.regexp_replace(path, r"^[a-zA-Z0-9]+:(//[^/]*)?", "")
    return F.substring(F.url_decode(F.replace(plain, F.lit("+"), F.lit("%2B"))), F.lit(start), F.length(path))


class ShardFiles:
    """Keeps the most recent shard open while reading member payloads in order."""

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")
        self.shard: str | None = None
        self.stream = None

    def read(self, shard: str, offset: int, size: int) -> bytes:
        if shard != self.shard:
            self.close()
            self.stream = open_shard(f"{self.folder}/{shard}", FETCH_WINDOW)
            self.shard = shard
        self.stream.seek(offset)
        return self.stream.read(size)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
        self.stream = None
        self.shard = None


def fetch_tasks(members: DataFrame) -> int:
    """How many tasks should read the payloads of ``members``: one per 256 MB, at least one per core."""
    total = members.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    return max(members.sparkSession.sparkContext.defaultParallelism, -(-int(total) // TASK_BYTES))


def place_by_range(members: DataFrame, tasks: int | None = None) -> DataFrame:
    """Give each task one contiguous stretch of members, in file order.

    Only (shard, offset, ...) rows move, and a large shard is read by several
    tasks. The task count is explicit because adaptive execution would size tasks
    by these slim rows instead of by the bytes they stand for.
    """
    tasks = tasks or int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return members.repartitionByRange(tasks, "shard", "offset").sortWithinPartitions("shard", "offset")


def fetch_members(members: DataFrame, folder: str, into: str = "bytes", tasks: int | None = None) -> DataFrame:
    """Read the payload of each ``(shard, offset, size)`` row.

    Placing the rows samples them first, so store a listing before fetching from it.
    """
    schema = T.StructType([*members.schema.fields, T.StructField(into, T.BinaryType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files = ShardFiles(folder)
        try:
            for pdf in batches:
                yield pdf.assign(**{into: [files.read(s, int(o), int(n)) for s, o, n in zip(pdf["shard"], pdf["offset"], pdf["size"])]})
        finally:
            files.close()

    return place_by_range(members, tasks).mapInPandas(run, schema)
