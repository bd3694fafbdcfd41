"""Join documents whose sets of word n-grams are alike: MinHash bands, then full sets.

1. One scan turns each text into a digest of its n-gram set and one hash per band
   of a MinHash signature. Texts with equal sets form a class, and only the
   representative (smallest id) of a class goes on.
2. Shuffling on band hashes ties every representative to the smallest one in each
   of its buckets. Representatives that reach each other through buckets form a
   candidate cluster; no pairs are written.
3. Clusters are dealt out in blocks of bounded size; a task gets two blocks and
   compares their full sets, all pairs at once as matrix products. It returns one
   row per member (number of links, smallest linked member), never the pairs.

Recall is that of the banding (``choose_bands``); what is linked is decided on the
full sets. Any two similar sets that share a band meet in some task, whatever the
size of their bucket or cluster.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shapeloom.llm import blocks
from shapeloom.llm.common import mix, ship, slices, stored, text_buffers
from shapeloom.llm.components import connected_components
from shapeloom.llm.words import distinct_sorted, word_ngrams

_CHUNK = 1 << 18
_BLOCK_SETS = 1024
_BLOCK_GRAMS = 1 << 20
_COLUMNS = 4096


def choose_bands(similarity: float = 0.8, recall: float = 0.99999, max_hashes: int = 256) -> tuple[int, int]:
    """(bands, rows): the most rows, so the fewest chance meetings, that reach the recall at this similarity."""
    best = None
    for rows in range(1, 65):
        chance = similarity**rows
        if chance < 1e-12:
            break
        bands = 1 if chance >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-chance))
        if bands * rows <= max_hashes:
            best = bands, rows
    if best is None:
        raise ValueError("no number of bands reaches this recall with so few hashes")
    return best


def _sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    return distinct_sorted(*word_ngrams(data, offsets, n))


def _digests(grams: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set, whatever its order."""
    out = []
    for salt in (0x5BD1E995, 0xC2B2AE3D):
        total = np.append(np.uint64(0), np.cumsum(mix(grams ^ np.uint64(salt * 0x100000001)), dtype=np.uint64))
        out.append((total[at[1:]] - total[at[:-1]]).view(np.int64))
    return out[0], out[1]


def _bands(grams: np.ndarray, at: np.ndarray, bands: int, rows: int, seed: int) -> np.ndarray:
    """One 64-bit hash per nonempty set and band, from the smallest values of ``rows`` hash functions."""
    full = np.flatnonzero(np.diff(at))
    out = np.zeros((len(at) - 1, bands), np.uint64)
    if not len(full):
        return out
    low = (grams >> np.uint64(32)).astype(np.uint32)
    draw = mix(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64) + np.uint64(seed << 32))
    factors, shifts = (draw[::2] | np.uint64(1)).astype(np.uint32), draw[1::2].astype(np.uint32)
    first = at[full]
    for band in range(bands):
        key = np.full(len(full), band + 1, np.uint64)
        for j in range(band * rows, (band + 1) * rows):
            values = low * factors[j]
            values ^= shifts[j]
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(values, first))
        out[full, band] = key
    return out


def signatures(docs: DataFrame, n: int, bands: int, rows: int, seed: int) -> DataFrame:
    """``id, n_grams, d1, d2, bands`` of every row of ``docs(id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for a, b in slices(offsets, _CHUNK):
                grams, at = _sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], n)
                d1, d2 = _digests(grams, at)
                keys = _bands(grams, at, bands, rows, seed).view(np.int64)
                listed = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, bands, dtype=np.int32), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([batch["id"].slice(a, b - a), pa.array(np.diff(at)), pa.array(d1), pa.array(d2), listed], ["id", "n_grams", "d1", "d2", "bands"])

    return docs.mapInArrow(run, "id long, n_grams long, d1 long, d2 long, bands array<long>")


def _full_sets(rows: DataFrame, n: int) -> DataFrame:
    """Adds the sorted n-gram set of ``text`` as ``payload``; drops rows whose set is not the one of the class."""
    carried = [f for f in rows.schema.fields if f.name not in ("text", "d1", "d2")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for a, b in slices(offsets, _CHUNK):
                grams, at = _sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], n)
                d1, d2 = _digests(grams, at)
                part = batch.slice(a, b - a)
                same = (d1 == part["d1"].to_numpy()) & (d2 == part["d2"].to_numpy())
                packed = pa.array([grams[at[i] : at[i + 1]].tobytes() for i in range(b - a)], pa.binary())
                out = pa.RecordBatch.from_arrays([*[part[f.name] for f in carried], packed], [*[f.name for f in carried], "payload"])
                yield out.filter(pa.array(same))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in carried)
    return rows.mapInArrow(run, f"{schema}, payload binary")


def _shared(grams: list[np.ndarray], split: int) -> np.ndarray:
    """Sizes of the intersections of the first ``split`` sets with the others (with each other if there are no others)."""
    sizes = [len(g) for g in grams]
    owner = np.repeat(np.arange(len(grams)), sizes)
    values, column, seen = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    place = np.cumsum(seen > 1) - 1
    use = seen[column] > 1
    owner, column = owner[use], place[column[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    rest = len(grams) - split
    out = np.zeros((split, rest or split), np.float32)
    for start in range(0, int(place[-1]) + 1 if len(place) else 0, _COLUMNS):
        a, b = np.searchsorted(column, [start, start + _COLUMNS])
        dense = np.zeros((len(grams), _COLUMNS), np.float32)
        dense[owner[a:b], column[a:b] - start] = 1
        out += dense[:split] @ (dense[split:] if rest else dense).T
    return out


def _alike(similarity: float) -> Callable[[list[bytes], int], np.ndarray]:
    def linked(packed: list[bytes], split: int) -> np.ndarray:
        grams = [np.frombuffer(g, np.uint64) for g in packed]
        sizes = np.array([len(g) for g in grams], np.float64)
        shared = _shared(grams, split).astype(np.float64)
        union = sizes[:split, None] + (sizes[split:] if split < len(grams) else sizes)[None, :] - shared
        return shared >= similarity * union - 1e-9

    return linked


def ngram_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, similarity: float = 0.8, recall: float = 0.99999, max_hashes: int = 256, seed: int = 17) -> DataFrame:
    """``id, copy_of, class_id, n_links`` for every row of ``docs``.

    ``copy_of``: smallest id with the same n-gram set. ``class_id``: smallest id
    reachable over links of at least ``similarity``. ``n_links``: other documents,
    copies included, that are linked directly.

    Words are lower-case runs between ASCII white space; a text of fewer than ``n``
    words has one n-gram of them all. Null and empty texts, and rows with a null id,
    link with nothing (class: own id). Rows that share an id are one document (if
    their texts differ, the one with the smallest digest speaks for it). Very long
    texts are compared whole. Ids must be whole numbers. An empty table gives none.
    """
    ship(docs)
    bands, rows = choose_bands(similarity, recall, max_hashes)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.lower(F.col(text_col)).alias("text"))
    marked = stored(signatures(texts, n, bands, rows, seed), "signatures")
    usable = marked.where("id IS NOT NULL AND n_grams > 0")
    single = usable.groupBy("id").agg(F.min(F.struct("d1", "d2", "n_grams", "bands")).alias("s")).select("id", "s.*")
    classes = stored(single.groupBy("d1", "d2", "n_grams").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("mult"), F.min("bands").alias("bands")), "classes")

    keyed = classes.select("rep", F.posexplode("bands").alias("band", "h"))
    hubs = stored(keyed.groupBy("band", "h").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).where("hub < last").select("band", "h", "hub"), "hubs")
    edges = keyed.join(hubs, ["band", "h"]).where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    clusters = connected_components(edges).withColumnsRenamed({"id": "rep", "component": "cluster"})
    members = stored(clusters.join(classes.drop("bands"), "rep"), "members")
    members = blocks.assign(members, {_BLOCK_SETS: F.count(F.lit(1)), _BLOCK_GRAMS: F.sum("n_grams")})
    sets = _full_sets(members.join(texts.withColumnRenamed("id", "rep"), "rep").select(*blocks.MEMBER, "d1", "d2", "text"), n)
    links = blocks.links_within(sets, _alike(similarity))

    by_class = classes.select("d1", "d2", "n_grams", "rep", "mult").join(links, "rep", "left")
    by_class = stored(by_class.select("d1", "d2", "n_grams", "rep", F.coalesce("root", "rep").alias("root"), (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("links")), "by_class")
    by_id = single.select("id", "d1", "d2", "n_grams").join(by_class, ["d1", "d2", "n_grams"]).select(F.col("id").alias("own"), "rep", "root", "links")
    out = marked.select("id").join(by_id, F.col("id") == F.col("own"), "left")
    return out.select("id", F.coalesce("rep", "id").alias("copy_of"), F.coalesce("root", "id").alias("class_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: float) -> DataFrame:
    """One row of each near-duplicate class: its smallest id. Same columns; rows with a null id stay."""
    classes = ngram_classes(docs, id_col, text_col, **options)
    leaders = classes.where("id IS NOT NULL AND id = class_id").select(F.col("id").alias("__lead")).distinct()
    kept = docs.join(leaders, F.col(id_col).cast("long") == F.col("__lead"), "left").where(F.col("__lead").isNotNull() | F.col(id_col).isNull())
    nth = F.row_number().over(Window.partitionBy("__lead").orderBy(F.col(text_col)))
    named = kept.where("__lead IS NOT NULL").withColumn("__nth", nth).where("__nth = 1")
    return named.select(*docs.columns).union(docs.where(F.col(id_col).isNull()).select(*docs.columns))
