"""Looking at the footers of catalogue files before a round reads them.

Spark takes the schema of one file for all and stops at the first that is damaged. A
probe opens each file's footer in a task (two small reads) and tells, per file, what
is wrong with it, so that only that file is left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

from shapeloom.session import text_table
from shapeloom.sources.files import resolve

PROBED = "path string, rows bigint, kinds string, error string"


@dataclass(frozen=True)
class Probed:
    """Files fit to be read together, and the others with the reason."""

    good: list[str]
    failed: list[tuple[str, str]]


def probe_footers(spark: SparkSession, root: str, paths: list[str], columns: list[str]) -> DataFrame:
    """``path, rows, kinds, error``: what the footer of each file says of ``columns`` (a nested one by its full name)."""
    base = root.rstrip("/")

    def look(path: str) -> tuple[int | None, str | None, str | None]:
        system, inner = resolve(f"{base}/{path}")
        try:
            with system.open_input_file(inner) as file, pq.ParquetFile(file) as opened:
                kinds = [_kind(opened.schema_arrow, c) for c in columns]
                rows = opened.metadata.num_rows
        except (pa.ArrowException, OSError, ValueError) as problem:
            return None, None, f"unreadable footer: {str(problem)[:300]}"
        absent = [c for c, k in zip(columns, kinds) if k is None and f"/{c}=" not in f"/{path}"]
        return rows, None if absent else ", ".join(map(str, kinds)), f"no column {', '.join(absent)}" if absent else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = batch.column(0).to_pylist()
            found = list(zip(*map(look, named)))
            columns_of = [pa.array(v, t) for v, t in zip([named, *found], (pa.string(), pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays(columns_of, ["path", "rows", "kinds", "error"])

    tasks = min(len(paths), 4 * spark.sparkContext.defaultParallelism)
    return text_table(spark, ["path"], [(p,) for p in paths]).repartition(max(1, tasks)).mapInArrow(run, PROBED)


def _kind(schema: pa.Schema, column: str) -> pa.DataType | None:
    kind: pa.DataType = pa.struct(list(schema))
    for name in column.split("."):
        if not pa.types.is_struct(kind) or kind.get_field_index(name) < 0:
            return None
        kind = kind.field(name).type
    return kind


def sort_out(probed: DataFrame) -> Probed:
    """Files whose columns are of the kinds that most rows have; ``probed`` holds one round's inputs.

    Files without rows fit to any, so one that is empty never decides.
    """
    files = sorted(probed.collect(), key=lambda r: r.path)
    weight: Counter[str] = Counter()
    for r in files:
        if r.error is None:
            weight[r.kinds] += r.rows
    usual = min(weight, key=lambda k: (-weight[k], k)) if weight else None
    good, failed = [], []
    for r in files:
        if r.error is not None:
            failed.append((r.path, r.error))
        elif r.kinds != usual:
            failed.append((r.path, f"columns are {r.kinds}, not {usual}"))
        else:
            good.append(r.path)
    return Probed(good, failed)
