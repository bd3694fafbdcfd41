"""Hard negatives by a vertical scan with branch and bound over whole-number vectors.

Vectors are floored to whole numbers and laid down in blocks of columns: one column
per dimension, with the column's least and largest value. A task reads the columns of
a block for one anchor after the other, in the order of the anchor's largest
components. What the columns still unread can add to a score at least and at most
follows from their bounds, so that a candidate leaves the bitmap as soon as it cannot
matter any more. Scores that are left at the end are exact.

Two passes of blocks of anchors against all blocks: the first finds every anchor's
nearest rows of its own label (its positives), whose scores set the windows in which
the second looks for the best rows of other labels (its negatives).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shapeloom.llm.common import run_starts, ship, stored, whole_groups

#: Bytes of a block's columns and anchors of an anchor block, on average; columns read between two looks at the bounds.
_BLOCK_BYTES, _ANCHORS, _COLUMNS = 1 << 20, 64, 8
_KEYS = ["dims", "block", "part", "kind", "turn"]
_COLUMN_BLOCK = "dims int, block int, ids binary, names array<string>, codes binary, columns binary, near binary"
_MOST, _EXACT = 2**63 - 1, 2.0**62
_NEAR = np.dtype([("id", np.int64), ("score", np.int64)])


def _floored(factor: float):
    """``id, label, packed`` of the rows whose vector is whole; ``packed`` takes 2, 4 or 8 bytes a component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["v"].value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            values = batch["v"].flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            at = np.append(0, np.cumsum(sizes))
            broken = np.append(0, np.cumsum(~np.isfinite(values)))
            good = np.flatnonzero(broken[at[1:]] == broken[at[:-1]])
            with np.errstate(all="ignore"):
                whole = np.clip(np.floor(factor * values), -(2.0**63), 2.0**63 - 1024)
            whole = np.where(np.isfinite(whole), whole, 0).astype(np.int64)
            packed = []
            for i in good.tolist():
                v = whole[at[i] : at[i + 1]]
                low, high = (int(v.min()), int(v.max())) if len(v) else (0, 0)
                kind = next(k for k in (np.int16, np.int32, np.int64) if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
                packed.append(v.astype(kind).tobytes())
            kept = pa.array(good)
            yield pa.RecordBatch.from_arrays([batch["id"].take(kept), batch["label"].take(kept), pa.array(sizes[good].astype(np.int32)), pa.array(packed, pa.binary())], ["id", "label", "dims", "packed"])

    return run


def _unpacked(packed: pa.Array, dims: int) -> np.ndarray:
    """Rows of components, in the narrowest type that holds all of them."""
    rows = [x.as_buffer() for x in packed]
    if not dims:
        return np.zeros((len(rows), 0), np.int16)
    kinds = [np.dtype(f"<i{x.size // dims}") for x in rows]
    out = np.empty((len(rows), dims), max(kinds, key=lambda k: k.itemsize))
    for i, (x, kind) in enumerate(zip(rows, kinds, strict=True)):
        out[i] = np.frombuffer(x, kind)
    return out


def _laid_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: its vectors by column, its labels as numbers and their names."""
    for table in whole_groups(batches, ["dims", "block"]):
        table = table.combine_chunks()
        dims, block = table["dims"].to_numpy(), table["block"].to_numpy()
        bounds = run_starts(dims, block)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            part = table.slice(a, b - a)
            rows = _unpacked(part["packed"].combine_chunks(), int(dims[a]))
            labels = part["label"].combine_chunks().dictionary_encode()
            near = [np.array([(x["id"], x["score"]) for x in own], _NEAR).tobytes() for own in part["near"].to_pylist() if own]
            taken = np.array([len(own or ()) for own in part["near"].to_pylist()], np.int64)
            columns = [
                pa.array(dims[a : a + 1]), pa.array(block[a : a + 1]), pa.array([part["id"].to_numpy().tobytes()]), pa.array([labels.dictionary.to_pylist()], pa.list_(pa.string())),
                pa.array([labels.indices.to_numpy().astype(np.int64).tobytes()]), pa.array([np.ascontiguousarray(rows.T).tobytes()]), pa.array([taken.tobytes() + b"".join(near)]),
            ]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _COLUMN_BLOCK.split(", ")])


class _Block:
    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.names = {x: i for i, x in enumerate(row["names"])}
        self.codes = np.frombuffer(row["codes"], np.int64)
        n, dims, data = len(self.ids), row["dims"], row["columns"]
        kind = np.dtype(f"<i{len(data) // (n * dims)}") if dims else np.dtype(np.int16)
        self.columns = np.frombuffer(data, kind).reshape(dims, n)
        self.low, self.high = (f(1).astype(np.int64) for f in (self.columns.min, self.columns.max))
        taken = np.frombuffer(row["near"], np.int64, n)
        self.near = np.split(np.frombuffer(row["near"], _NEAR, offset=8 * n), np.cumsum(taken)[:-1])

    def scan(self, anchor: np.ndarray, alive: np.ndarray, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the bitmap ``alive`` that stay wanted to the end, and their exact scores.

        ``wanted(least, most)`` tells which rows can matter by the bounds of their scores.
        """
        reach = np.maximum(np.abs(self.low.astype(np.float64)), np.abs(self.high.astype(np.float64)))
        kind = np.int64 if float((np.abs(anchor.astype(np.float64)) * reach).sum()) < _EXACT else object
        order = np.argsort(-np.abs(anchor.astype(np.float64)), kind="stable")
        weight = anchor.astype(kind)[order]
        ends = weight * self.low.astype(kind)[order], weight * self.high.astype(kind)[order]
        rest = [np.append(np.cumsum(f(*ends)[::-1])[::-1], np.zeros(1, kind)) for f in (np.minimum, np.maximum)]
        at, score = np.flatnonzero(alive), np.zeros(int(alive.sum()), kind)
        for k, (w, column) in enumerate(zip(weight, order.tolist(), strict=True), 1):
            if not len(at):
                break
            read = self.columns[column]
            score += (read if len(at) == len(read) else read[at]).astype(kind) * w
            if k % _COLUMNS == 0 or k == len(order):
                keep = wanted(_long(score + rest[0][k]), _long(score + rest[1][k]))
                at, score = at[keep], score[keep]
        return at, _long(score)


def _kth(values: np.ndarray, k: int):
    """The k-th largest value, or None where there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else None


def _first(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, smaller ids first among equals."""
    return np.lexsort((ids, ~score))[:k]


def _long(score: np.ndarray) -> np.ndarray:
    return score if score.dtype != object else np.array([max(-_MOST - 1, min(_MOST, x)) for x in score], np.int64)


def _nearest(k: int):
    """The block's ``k`` best rows of the anchor's label: ``anchor, id, score``."""

    def of(block: _Block, anchors: _Block) -> Iterator[tuple[np.ndarray, ...]]:
        names = list(anchors.names)

        def wanted(least: np.ndarray, most: np.ndarray) -> np.ndarray:
            bar = _kth(least, k)
            return np.ones(len(least), bool) if bar is None else most >= bar

        for i, own in enumerate(anchors.ids):
            code = block.names.get(names[anchors.codes[i]])
            if code is None:
                continue
            at, score = block.scan(anchors.columns[:, i], (block.codes == code) & (block.ids != own), wanted)
            best = _first(block.ids[at], score, k)
            yield np.full(len(best), own), block.ids[at[best]], score[best]

    return of


def _windows(k: int, low: int, high: int, unit: int):
    """The block's ``k`` best rows of other labels in the window of each positive: ``anchor, positive, positive_score, id, score``."""

    def of(block: _Block, anchors: _Block) -> Iterator[tuple[np.ndarray, ...]]:
        names = list(anchors.names)
        for i, own in enumerate(anchors.ids):
            near = anchors.near[i]
            spans = [(-(-low * s // unit), high * s // unit) for s in map(int, near["score"])]
            spans = [(max(a, -_MOST - 1), min(b, _MOST)) for a, b in spans]

            def wanted(least: np.ndarray, most: np.ndarray, spans: list = spans) -> np.ndarray:
                keep = np.zeros(len(least), bool)
                for a, b in dict.fromkeys(spans):
                    if a > b:
                        continue
                    sure = _kth(least[(least >= a) & (most <= b)], k)
                    keep |= (most >= (a if sure is None else max(a, sure))) & (least <= b)
                return keep

            others = block.codes != block.names.get(names[anchors.codes[i]], -1)
            at, score = block.scan(anchors.columns[:, i], others, wanted)
            for (a, b), positive in zip(spans, near, strict=True):
                inside = np.flatnonzero((score >= a) & (score <= b))
                best = inside[_first(block.ids[at[inside]], score[inside], k)]
                n = len(best)
                yield np.full(n, own), np.full(n, positive["id"]), np.full(n, positive["score"]), block.ids[at[best]], score[best]

    return of


def _against(of: Callable, names: list[str]):
    """Hold each block in turn and search it for the anchor blocks that follow it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                line = batch.slice(row, 1).to_pylist()[0]
                own = (line["dims"], line["block"], line["part"])
                if line["kind"] == 0:
                    key, block = own, _Block(line)
                elif key == own and (found := list(of(block, _Block(line)))):
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*found, strict=True)], names)

    return run


def _blocks(rows: DataFrame, blocks: int) -> DataFrame:
    placed = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    if "near" not in rows.columns:
        placed = placed.withColumn("near", F.lit(None).cast("array<struct<id:bigint,score:bigint>>"))
    dealt = placed.select("dims", "block", "id", "label", "packed", "near").repartition("dims", "block").sortWithinPartitions("dims", "block", "id")
    return dealt.mapInArrow(_laid_down, _COLUMN_BLOCK)


def _search(columns: DataFrame, blocks: int, anchors: DataFrame, anchor_blocks: int, of: Callable, names: list[str]) -> DataFrame:
    """Every anchor block against every block of its width; a block goes to as many tasks as there are hands for."""
    context = columns.sparkSession.sparkContext
    hands = 4 * context.defaultParallelism
    parts = min(anchor_blocks, max(1, -(-hands // blocks)))
    held = columns.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumns({"kind": F.lit(0), "turn": F.lit(0)})
    asked = anchors.withColumns({"turn": F.col("block"), "part": F.col("block") % parts, "kind": F.lit(1)})
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    tasks = max(int(columns.sparkSession.conf.get("spark.sql.shuffle.partitions")), hands)
    dealt = held.unionByName(asked).repartition(tasks, "dims", "block", "part").sortWithinPartitions(*_KEYS)
    return dealt.mapInArrow(_against(of, names), ", ".join(f"{n} long" for n in names))


def mine_negatives(vectors: DataFrame, anchors: Column | str, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, unit: int = 100, factor: float = 256.0) -> DataFrame:
    """``anchor, positive, rank, negative, positive_score, negative_score``.

    A component x counts as floor(factor * x); a score is the inner product of two
    rows. ``anchors`` is a condition on the columns of ``vectors``. An anchor's
    positives are its ``positives`` best other rows of its label; for each, the best
    ``negatives`` rows of another label with ``low * positive_score <= unit *
    negative_score <= high * positive_score`` come back, smaller ids first among
    equals. Ids are whole numbers. Rows without an id, a label or a vector, or with a
    null or non-finite component, take no part. Rows that share an id are one row (the
    smallest by label and vector; anchor if one of them is). Vectors of different
    length are never compared; two empty ones score 0. Components and scores beyond
    64 bits count as the nearest number of 64 bits. An empty table, and one without
    anchors, gives none.
    """
    ship(vectors)
    named = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("v"),
        F.coalesce(F.expr(anchors) if isinstance(anchors, str) else anchors, F.lit(False)).alias("asks"),
    )
    sound = named.where("id is not null and label is not null and v is not null")
    asking = sound.select("id", "asks").where("asks").select("id").distinct()
    whole = sound.select("id", "label", "v").mapInArrow(_floored(factor), "id long, label string, dims int, packed binary")
    rows = whole.groupBy("id").agg(F.min(F.struct("label", "dims", "packed")).alias("x")).select("id", "x.*")
    rows = stored(rows.join(asking.withColumn("asks", F.lit(True)), "id", "left"), "vectors")
    size = rows.agg(F.sum(F.octet_length("packed") + 16).alias("bytes"), F.count("asks").alias("anchors")).first()
    blocks, anchor_blocks = (max(1, math.ceil((n or 0) / most)) for n, most in ((size.bytes, _BLOCK_BYTES), (size.anchors, _ANCHORS)))
    columns, asked = stored(_blocks(rows, blocks), "columns"), rows.where("asks").drop("asks")

    def ranked(frame: DataFrame, keys: list[str], k: int) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id"))
        return frame.withColumn("rank", place).where(F.col("rank") <= k)

    near = _search(columns, blocks, _blocks(asked, anchor_blocks), anchor_blocks, _nearest(positives), ["anchor", "id", "score"])
    near = ranked(near, ["anchor"], positives).groupBy(F.col("anchor").alias("id")).agg(F.collect_list(F.struct("id", "score")).alias("near"))
    windowed = stored(_blocks(asked.join(near, "id"), anchor_blocks), "anchors")
    names = ["anchor", "positive", "positive_score", "id", "score"]
    found = stored(_search(columns, blocks, windowed, anchor_blocks, _windows(negatives, low, high, unit), names), "windows")
    best = ranked(found, ["anchor", "positive"], negatives)
    return best.select("anchor", "positive", "rank", F.col("id").alias("negative"), "positive_score", F.col("score").alias("negative_score"))


#: The query's rows, for vectors of one length and ids without repeats.
NEGATIVES_SQL = """
WITH whole AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
               FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (SELECT a.vec_id AS anchor, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
           FROM whole a JOIN whole b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
near AS (SELECT anchor, id, score FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5)
SELECT anchor AS anchor_id, near.id AS positive_id, (row_number() OVER (PARTITION BY anchor, near.id ORDER BY far.score DESC, far.id))::INTEGER AS rank,
       far.id AS negative_id, near.score AS positive_score, far.score AS negative_score
FROM near JOIN scores far USING (anchor)
WHERE NOT far.same AND 50 * near.score <= 100 * far.score AND 100 * far.score <= 95 * near.score QUALIFY rank <= 3
"""
