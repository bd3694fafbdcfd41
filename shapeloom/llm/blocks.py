"""Compare all members of a cluster with each other, in pairs of blocks of bounded size.

A cluster's members are dealt into as many blocks as its size asks for. Each pair
of blocks is one unit of work: its task compares the two blocks all at once and
returns one row per member, its number of links and the smallest member it reaches.
A member is sent as often as its cluster has blocks; pairs are never written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shapeloom.llm.common import run_starts, stored, whole_groups
from shapeloom.llm.components import connected_components

#: Columns of a member besides its payload.
MEMBER = ("cluster", "blocks", "block", "rep", "mult")


def assign(members: DataFrame, limits: dict[int, Column]) -> DataFrame:
    """Adds ``blocks`` and ``block``: as many blocks as keep every measure of a cluster under its limit, on average."""
    needed = [F.ceil(measure / limit) for limit, measure in limits.items()]
    sizes = members.groupBy("cluster").agg(F.greatest(*needed, F.lit(1)).cast("int").alias("blocks"))
    members = members.join(stored(sizes, "sizes"), "cluster")
    return members.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))


def local_roots(linked: np.ndarray) -> np.ndarray:
    """Smallest position reachable over a symmetric matrix of links."""
    root = np.arange(len(linked))
    while True:
        near = np.where(linked, root[None, :], len(root)).min(1, initial=len(root))
        new = np.minimum(root, near)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _count(ids: np.ndarray, mult: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    split = len(linked)
    if split == len(ids):
        np.fill_diagonal(linked, False)
        links, whole = linked @ mult, linked
    else:
        links = np.append(linked @ mult[split:], linked.T @ mult[:split])
        whole = np.zeros((len(ids), len(ids)), bool)
        whole[:split, split:] = linked
        whole[split:, :split] = linked.T
    order = np.argsort(ids, kind="stable")
    roots = np.empty(len(ids), np.int64)
    roots[order] = ids[order][local_roots(whole[np.ix_(order, order)])]
    return links, roots


def links_within(members: DataFrame, linked: Callable[[list[bytes], int], np.ndarray]) -> DataFrame:
    """``rep, links, root`` for the members that are linked.

    ``members`` has the columns MEMBER and ``payload`` (bytes). ``linked(payloads,
    split)`` gives the links of the first ``split`` payloads with the others, or with
    each other when there are no others. ``links`` counts a linked member ``mult``
    times; ``root`` is the smallest ``rep`` reachable in the whole cluster.
    """
    pairs = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).drop("other")
    keys = ["cluster", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            cluster, lo, hi, block, rep, mult, blocks = (table[c].to_numpy() for c in (*keys, "block", "rep", "mult", "blocks"))
            payload = table["payload"].combine_chunks()
            bounds = run_starts(cluster, lo, hi)
            out = []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                rows = np.arange(a, b)
                rows = rows[np.append(True, rep[rows[1:]] != rep[rows[:-1]])]  # repeated rows of one member
                split = int((block[rows] == lo[a]).sum())
                if split == 0 or (lo[a] != hi[a] and split == len(rows)):
                    continue
                packed = [payload[int(i)].as_buffer() for i in rows]
                links, roots = _count(rep[rows], mult[rows], linked(packed, split))
                found = np.flatnonzero(links > 0)
                out.append((rep[rows][found], links[found], roots[found], np.full(len(found), blocks[a])))
            if out:
                columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["rep", "links", "root", "blocks"])

    dealt = pairs.repartition(*keys).sortWithinPartitions(*keys, "block", "rep")
    found = stored(dealt.mapInArrow(run, "rep long, links long, root long, blocks long"), "found")
    total = found.groupBy("rep").agg(F.sum("links").alias("links"), F.min("root").alias("root"))
    several = found.where("blocks > 1").select(F.col("rep").alias("a"), F.col("root").alias("b"))
    if not several.isEmpty():
        joined = connected_components(several).withColumnRenamed("id", "rep")
        total = total.join(joined, "rep", "left").withColumn("root", F.coalesce("component", "root"))
    return stored(total.select("rep", "links", "root"), "links")
