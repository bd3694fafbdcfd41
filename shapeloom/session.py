"""Session helpers: a tuned local session and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Arrow batches between Spark and Python, unless the session says otherwise: several workers of every core hold some at a time.
BATCH_BYTES = 2 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_LISTING_SETTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS_PER_SLOT = 4

_local_base: str | None = None
_shipped_to: dict[str, str] = {}


def build_session(app: str = "shapeloom", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the library expects (AQE on, UTC, Arrow)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder path every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only where
    that is unset and the master is local (tests, a laptop) does a temporary folder
    stand in; executors on other machines would not see it.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if _local_base is None:
            _local_base = tempfile.mkdtemp(prefix="shapeloom-")
        base = _local_base
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame``, written into the shared folder and read back, so that nothing before it is done twice."""
    path = shared_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def text_table(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """Strings at hand as a table; one made by ``createDataFrame`` from a list starts Python workers whenever it is read."""
    return spark.createDataFrame(pa.table([pa.array(c, pa.string()) for c in (zip(*rows) if rows else [[]] * len(names))], names=names))


def empty_table(spark: SparkSession, schema: str) -> DataFrame:
    """No rows, and no Python worker either."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema)])


def bound_batches(spark: SparkSession) -> None:
    """Hold Arrow batches to ``BATCH_BYTES``, for rows that carry images; a setting of the session stays."""
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders listed in here share a few tasks per core, instead of a task for each of up to 10,000."""
    before = spark.conf.get(_LISTING_SETTING)
    spark.conf.set(_LISTING_SETTING, str(min(int(before), LISTING_TASKS_PER_SLOT * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(_LISTING_SETTING, before)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Needed where the executors do not have it installed: functions that run in
    Python tasks, and the tar data source, import it there.
    """
    context = spark.sparkContext
    if _shipped_to.get("app") == context.applicationId:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="shapeloom-pkg-")) / "shapeloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, Path("shapeloom") / source.relative_to(root))
    context.addPyFile(str(archive))
    _shipped_to["app"] = context.applicationId


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
