"""Near-duplicate vectors by sorted passes of random hashes.

1. Equal vectors of a label are counted once.
2. Every pass orders the vectors of a label by the concatenated signs of random
   hyperplanes and compares neighbours: a vector with the window before it in the order,
   and with the whole run that agrees with it on the first ``depth`` signs. A run
   longer than the window is worked off in pairs of bounded blocks, not cut. A pair
   at the wanted cosine shares a run with a chance that depends on ``depth`` alone,
   however the other vectors lie, so the passes follow from depth and target recall;
   the depth of a label is the one of least cost by its measured runs. A label that
   fits into one window needs one pass.
3. Verified pairs, directly or through others, form a cluster (union across passes).
   Inside a cluster all pairs are checked, block against block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shapeloom.llm import blocks
from shapeloom.llm.common import run_starts, share, ship, stored, whole_groups
from shapeloom.llm.components import connected_components

_BLOCK = 1024
_BITS = 62
#: Neighbours in the order that a vector is compared with at least; rows of a run that are compared in one piece.
_WINDOW, _CELL = 512, 2048
#: Comparisons that cost as much as one row's way through a pass.
_ROW_COST = 1024
#: Rows of a label (in expectation) and passes that its runs are measured on, and the depths tried.
_TRIAL_ROWS, _TRIALS, _DEPTHS = 2048, 1, range(6, 46, 3)
_BUCKET = ["pass", "label", "size", "key"]


def passes_at(bits: int, similarity: float, recall: float) -> int:
    """Passes after which a pair at this cosine agreed on ``bits`` signs once, with chance ``recall``."""
    agree = 1 - math.acos(min(similarity, 1.0)) / math.pi
    met = agree**bits
    return 1 if met >= recall else math.ceil(math.log(1 - recall) / math.log(1 - met))


def _matrix(column: pa.Array) -> np.ndarray:
    """Equally long vectors as unit rows in double precision."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    scaled = values / np.abs(values).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def _keys(rows: np.ndarray, number: int, depth: int, seed: int) -> np.ndarray:
    """The first ``depth`` signs of every vector in pass ``number``, concatenated to one number."""
    planes = np.random.default_rng([seed, number, rows.shape[1]]).standard_normal((rows.shape[1], _BITS))[:, :depth]
    return (rows @ planes > 0) @ np.left_shift(np.int64(1), np.arange(depth - 1, -1, -1, dtype=np.int64))


def _bucket_rows(seed: int, with_vectors: bool):
    """Every vector once a pass, with its bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = np.stack([batch[c].to_numpy() for c in ("size", "depth", "passes")])
            for size, depth, passes in np.unique(kinds, axis=1).T.tolist():
                part = batch.filter(pa.array((kinds.T == [size, depth, passes]).all(1)))
                rows = _matrix(part["v"])
                for p in range(passes):
                    whole = _keys(rows, p, _BITS, seed)
                    columns = [pa.array(np.full(len(rows), p, np.int32)), part["label"], part["size"], pa.array(whole >> (_BITS - depth))]
                    more, names = ([pa.array(whole), part["rep"], part["v"]], ["order", "rep", "v"]) if with_vectors else ([], [])
                    yield pa.RecordBatch.from_arrays([*columns, *more], [*_BUCKET, *names])

    return run


def _trial_rows(seed: int):
    """Prefixes of every depth for the vectors whose label is measured."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["size"].to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                rows = _matrix(part["v"])
                for t in range(_TRIALS):
                    keys = _keys(rows, t, _BITS, seed + 1)
                    for depth in _DEPTHS:
                        columns = [part["label"], part["size"], part["n"], *(pa.array(np.full(len(rows), x, np.int32)) for x in (t, depth)), pa.array(keys >> (_BITS - depth))]
                        yield pa.RecordBatch.from_arrays(columns, ["label", "size", "n", "trial", "depth", "key"])

    return run


def _plan(distinct: DataFrame, similarity: float, recall: float, seed: int) -> DataFrame:
    """``label, size, depth, passes`` of the labels that do not fit into one window, at the least cost by measured runs.

    Runs are measured on a hashed share of a label; they decide the cost, never the recall.
    """
    large = stored(distinct.groupBy("label", "size").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > _WINDOW), "large")
    trial = distinct.join(large, ["label", "size"]).where(share("rep", seed=seed) < F.lit(float(_TRIAL_ROWS)) / F.col("n"))
    prefixes = trial.select("label", "size", "n", "v").mapInArrow(_trial_rows(seed), "label string, size int, n long, trial int, depth int, key long")
    buckets = prefixes.groupBy("label", "size", "n", "trial", "depth", "key").agg(F.count(F.lit(1)).cast("double").alias("c"))
    measured = buckets.groupBy("label", "size", "n", "depth").agg(F.sum("c").alias("rows"), F.sum(F.col("c") * (F.col("c") - 1)).alias("pairs"))
    drawn = F.col("rows") / _TRIALS
    pairs = F.col("pairs") / _TRIALS / 2 * F.pow(F.col("n") / drawn, F.lit(2))
    passes = F.element_at(F.array(*[F.lit(passes_at(d, similarity, recall)) for d in _DEPTHS]), ((F.col("depth") - _DEPTHS.start) / _DEPTHS.step).cast("int") + 1)
    cost = passes * (F.col("n") * (_ROW_COST + _WINDOW) + pairs)
    return stored(measured.groupBy("label", "size").agg(F.min_by(F.struct("depth", passes.alias("passes")), cost).alias("best")).select("label", "size", "best.*"), "depths")


def _roots_of_pairs(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _roots_of_rows(rows: np.ndarray, split: int, similarity: float, among: bool = False) -> np.ndarray:
    """Smallest position reachable over links of the first ``split`` rows with the others (or with each other; with both if ``among``).

    Pairs that are already connected are left out, so a dense group costs little.
    """
    n = len(rows)
    root = np.arange(n)

    def join(a: np.ndarray, b: np.ndarray) -> None:
        nonlocal root
        if (root[a].min() == root[a].max()) and (root[b] == root[a[0]]).all():
            return
        near = (rows[a] @ rows[b].T >= similarity) & (root[a][:, None] != root[b][None, :])
        x, y = np.nonzero(near)
        if len(x):
            root = _roots_of_pairs(n, np.append(np.arange(n), a[x]), np.append(root, b[y]))

    left, right = np.arange(split), np.arange(split if split < n and not among else 0, n)
    join(left[:32], right)
    left, right = left[np.argsort(root[left], kind="stable")], right[np.argsort(root[right], kind="stable")]
    for i in range(0, len(left), 512):
        for j in range(0 if split < n else i, len(right), 512):
            join(left[i : i + 512], right[j : j + 512])
    return root


def _compare_buckets(similarity: float):
    """One link for each vector that is linked within its bucket, by which those it reaches come together."""
    keys = [*_BUCKET, "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            table = table.combine_chunks()
            rep, block, lo, hi = (table[c].to_numpy() for c in ("rep", "block", "lo", "hi"))
            label = table["label"].combine_chunks().dictionary_encode().indices.to_numpy() if len(table) else rep
            bounds = run_starts(*(table[c].to_numpy() for c in ("pass", "size", "key")), label, lo, hi)
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                split = int((block[a:b] == lo[a]).sum())
                if b - a < 2 or split == 0 or (lo[a] != hi[a] and split == b - a):
                    continue
                root = _roots_of_rows(_matrix(table["v"].slice(a, b - a).combine_chunks()), split, similarity)
                some = np.flatnonzero(root != np.arange(b - a))
                if len(some):
                    yield pa.RecordBatch.from_arrays([pa.array(rep[a + some]), pa.array(rep[a + root[some]])], ["a", "b"])

    return run


def _compare_windows(similarity: float):
    """Links of every vector with its window: the rows before it in the order, as far as its run goes and ``_WINDOW`` at least.

    Holds one window and one piece of a batch. Of a run above ``_CELL`` rows only the
    window is compared here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, reps, units, keys = None, np.zeros(0, np.int64), None, np.zeros(0, np.int64)
        for batch in batches:
            label = pc.fill_null(batch["label"], "").dictionary_encode()
            names = label.dictionary.to_pylist()
            bounds = run_starts(batch["pass"].to_numpy(), label.indices.to_numpy(), batch["size"].to_numpy())
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                group = (batch["pass"][int(a)].as_py(), names[label.indices[int(a)].as_py()], batch["size"][int(a)].as_py())
                if group != own:
                    own, reps, units, keys = group, np.zeros(0, np.int64), np.zeros((0, group[2])), np.zeros(0, np.int64)
                for first in range(int(a), int(b), _CELL // 4):
                    part = batch.slice(first, min(_CELL // 4, int(b) - first))
                    units = np.concatenate([_matrix(part["v"]), units])
                    reps = np.concatenate([part["rep"].to_numpy(), reps])
                    keys = np.concatenate([part["key"].to_numpy(), keys])
                    root = _roots_of_rows(units, part.num_rows, similarity, among=True)
                    some = np.flatnonzero(root != np.arange(len(root)))
                    if len(some):
                        yield pa.RecordBatch.from_arrays([pa.array(reps[some]), pa.array(reps[root[some]])], ["a", "b"])
                    kept = part.num_rows + np.arange(len(reps) - part.num_rows)
                    kept = np.concatenate([np.arange(part.num_rows)[::-1], kept])  # the latest row first
                    run_length = int((keys == keys[kept[0]]).sum())
                    kept = kept[: max(_WINDOW, run_length if run_length <= _CELL else 0)]
                    reps, units, keys = reps[kept], units[kept], keys[kept]

    return run


def _candidates(distinct: DataFrame, similarity: float, recall: float, seed: int) -> DataFrame:
    """Links ``a, b`` that connect, with chance ``recall`` at least, any two vectors that are near."""
    planned = distinct.join(_plan(distinct, similarity, recall, seed), ["label", "size"], "left")
    planned = planned.select("label", "size", "rep", "v", F.coalesce("depth", F.lit(0)).alias("depth"), F.coalesce("passes", F.lit(1)).alias("passes"))
    bucket = "pass int, label string, size int, key long"
    counted = planned.mapInArrow(_bucket_rows(seed, False), bucket).groupBy(*_BUCKET).count().where(F.col("count") > _CELL)
    cut = stored(counted.select(*_BUCKET, F.ceil(F.col("count") / _CELL).cast("int").alias("blocks")), "cut")
    rows = planned.mapInArrow(_bucket_rows(seed, True), f"{bucket}, order long, rep long, v {distinct.schema['v'].dataType.simpleString()}")
    tasks = max(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), distinct.sparkSession.sparkContext.defaultParallelism)
    # Whole runs stay together (a label of one window is one run); the order goes on inside a task from run to run.
    ordered = rows.repartitionByRange(tasks, *_BUCKET).sortWithinPartitions(*_BUCKET, "order", "rep")
    near = ordered.mapInArrow(_compare_windows(similarity - 1e-9), "a long, b long")
    if cut.isEmpty():
        return near
    long_runs = rows.drop("order").join(cut, _BUCKET).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    long_runs = long_runs.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    long_runs = long_runs.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).drop("other", "blocks")
    keys = [*_BUCKET, "lo", "hi"]
    dealt = long_runs.repartition(*keys).sortWithinPartitions(*keys, "block", "rep")
    return near.unionByName(dealt.mapInArrow(_compare_buckets(similarity - 1e-9), "a long, b long"))


def _linked(similarity: float):
    def linked(packed: list[bytes], split: int) -> np.ndarray:
        rows = np.stack([np.frombuffer(p, np.float64) for p in packed])
        rest = rows[split:] if split < len(rows) else rows
        return rows[:split] @ rest.T >= similarity

    return linked


def _unit_payload(members: DataFrame) -> DataFrame:
    """Adds the unit vector as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [_matrix(pa.array([v], batch["v"].type))[0].tobytes() for v in batch["v"]]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in blocks.MEMBER], pa.array(packed, pa.binary())], [*blocks.MEMBER, "payload"])

    return members.select(*blocks.MEMBER, "v").mapInArrow(run, "cluster long, blocks int, block int, rep long, mult long, payload binary")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", similarity: float = 0.98, recall: float = 0.99999, seed: int = 23) -> DataFrame:
    """``id, n_links, component_id, kept`` for every row of ``vectors``.

    Only vectors with equal labels that are not null, and of equal length, are
    compared, by cosine in double precision. Null or zero vectors, those with null or
    non-finite components, and rows with a null label or id link with nothing
    (``kept`` is null where the id is). Repeated rows of one id and vector are one
    vector; ids are whole numbers, one vector each (if an id has several, the
    smallest counts). An empty table gives none.
    """
    ship(vectors)
    kind = vectors.schema[vector_col].dataType.simpleString()  # floats are sent as such: half as many bytes, the same numbers
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>" if "float" in kind else "array<double>").alias("v"), F.col(label_col).cast("string").alias("label"))
    broken = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~broken & F.exists("v", lambda x: x != 0))
    single = sound.groupBy("id").agg(F.min(F.struct("label", "v")).alias("x")).select("id", "x.label", "x.v")
    distinct = single.groupBy("label", "v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("mult"))
    distinct = stored(distinct.withColumn("size", F.size("v")), "vectors")

    edges = _candidates(distinct, similarity, recall, seed)
    clusters = connected_components(edges).withColumnsRenamed({"id": "rep", "component": "cluster"})

    members = stored(clusters.join(distinct, "rep"), "members")
    members = blocks.assign(members, {_BLOCK: F.count(F.lit(1)), (1 << 20): F.sum("size")})
    links = blocks.links_within(_unit_payload(members), _linked(similarity))

    found = distinct.join(links, "rep", "left").select("label", "v", F.coalesce("root", "rep").alias("root"), (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    by_id = single.join(stored(found, "found"), ["label", "v"]).select(F.col("id").alias("own"), "root", "links")
    out = rows.select("id").join(by_id, F.col("id") == F.col("own"), "left")
    component = F.coalesce("root", "id")
    return out.select("id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("id") == component).alias("kept"))
