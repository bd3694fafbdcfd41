"""Ranked lexical search: one automaton of all items' terms reads the documents, no index is built.

1. The items' terms are counted in Spark and cut into groups of items whose terms
   stay under ``group_bytes`` together; a group's terms become one Aho-Corasick
   automaton in every task.
2. A first scan of the documents counts documents, terms and, by the automaton's
   hits, in how many documents each term stands.
3. A second scan counts each term in each document, adds its weight to the items
   that the term stands for and keeps the best documents of every item per task.

Every pattern and every text is guarded: bytes outside terms become one space, and
a pattern is its term between two spaces, so only whole terms hit. Both scans read
the documents where they lie; what is exchanged is one number per term and task,
then k rows per item and task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shapeloom.llm.common import ship, slices, stored, text_buffers

#: Bytes that are part of a term: ASCII letters and digits, and all of any other character.
TERM_BYTES = np.isin(np.arange(256), [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])
_LOWER = bytes((c + 32 if 65 <= c < 91 else c) if TERM_BYTES[c] else 32 for c in range(256))
_UPPER_LETTERS, _LOWER_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What a term costs a group besides its own bytes.
_TERM_COST = 64
_CELLS = 1 << 20
_CHUNK = 1 << 24
_LAST = np.iinfo(np.int64).max
_SALTS = 64


def terms_of(text_col: str) -> F.Column:
    """The terms of a text (null: none), only A-Z lower-cased."""
    lowered = F.translate(F.coalesce(F.col(text_col), F.lit("")), _UPPER_LETTERS, _LOWER_LETTERS)
    return F.regexp_extract_all(lowered, F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"), F.lit(1))


@dataclass
class _Group:
    """Terms by number, and for each the items (by number) that hold it and how often."""

    items: list
    terms: list[str]
    first: np.ndarray
    holder: np.ndarray
    times: np.ndarray

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for number, term in enumerate(self.terms):
            found.add_word(f" {term.encode().decode('latin-1')} ", number)
        found.make_automaton()
        return found


def _group(rows: list) -> _Group:
    items = sorted({r.item for r in rows}, key=lambda x: (x is None, x))
    number = {x: i for i, x in enumerate(items)}
    rows = sorted(rows, key=lambda r: r.term)
    terms = sorted({r.term for r in rows})
    sizes = Counter(r.term for r in rows)
    first = np.append(0, np.cumsum([sizes[t] for t in terms])).astype(np.int64)
    return _Group(items, terms, first, np.array([number[r.item] for r in rows], np.int64), np.array([r.times for r in rows], np.int64))


def _groups(items: DataFrame, item_col: str, text_col: str, group_bytes: int) -> Iterator[_Group]:
    """Groups of items whose terms weigh at most ``group_bytes``; an item that weighs more stands alone."""
    named = items.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).distinct()
    counted = named.select("item", F.explode(terms_of("text")).alias("term")).groupBy("item", "term").agg(F.count(F.lit(1)).alias("times"))
    counted = stored(counted, "terms")
    weight = F.octet_length("term") + _TERM_COST
    total = counted.agg(F.sum(weight)).first()[0] or 0
    buckets = 1 if total <= group_bytes else math.ceil(16 * total / group_bytes)
    bucketed = counted.withColumn("bucket", F.pmod(F.xxhash64("item"), F.lit(buckets)))
    weights = bucketed.groupBy("bucket").agg(F.sum(weight).alias("weight")).orderBy("bucket").collect()
    held, taken = 0, []
    for i, row in enumerate(weights):
        taken.append(row.bucket)
        held += row.weight
        if i + 1 == len(weights) or held + weights[i + 1].weight > group_bytes:
            yield _group(bucketed.where(F.col("bucket").between(taken[0], taken[-1])).select("item", "term", "times").collect())
            held, taken = 0, []


def _counted(automaton, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of every text: how many terms it has, which terms of the automaton, and how often each."""
    data, offsets = text_buffers(texts)
    for a, b in slices(offsets, _CHUNK):
        part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        begins = TERM_BYTES[part]
        inside = begins.copy()
        inside[at[:-1][at[:-1] < len(part)]] = False
        begins[1:] &= ~(inside[1:] & TERM_BYTES[part[:-1]])
        sizes = np.diff(np.searchsorted(np.flatnonzero(begins), at))
        plain = part.tobytes().translate(_LOWER).decode("latin-1")
        for i, n in enumerate(sizes.tolist()):
            hits = Counter(map(itemgetter(1), automaton.iter(f" {plain[at[i] : at[i + 1]]} "))) if n else {}
            yield n, np.fromiter(hits.keys(), np.int64, len(hits)), np.fromiter(hits.values(), np.int64, len(hits))


def _frequencies(group: _Group):
    """One row per term that a task met (in how many documents), then its documents (-1) and terms (-2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = group.automaton()
        holding, documents, length = np.zeros(len(group.terms), np.int64), 0, 0
        for batch in batches:
            for n, terms, _ in _counted(automaton, batch[0]):
                holding[terms] += 1
                documents += n > 0
                length += n
        met = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(met, [-1, -2])), pa.array(np.append(holding[met], [documents, length]))], ["term", "n"])

    return run


def _best(pool: list[np.ndarray], k: int) -> np.ndarray:
    """The k best columns (item, score, id, whether there is an id) of every item."""
    rows = np.concatenate(pool, axis=1)
    order = np.lexsort((rows[2], rows[3], -rows[1], rows[0]))
    rows = rows[:, order]
    place = np.arange(rows.shape[1])
    return rows[:, place - np.searchsorted(rows[0], rows[0]) < k]


def _scores(group: _Group, weights: np.ndarray, documents: int, length: int, k: int):
    """Each task's k best documents of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, width = group.automaton(), len(group.items)
        least, kept = np.ones(width, np.int64), np.zeros((4, 0), np.int64)
        sizes, step = np.diff(group.first), max(1, _CELLS // width)

        def settle(ids: list, found: list) -> None:
            nonlocal least, kept
            if not found:
                return
            table = np.zeros((len(ids), width), np.int64)
            for row, (terms, gain) in enumerate(found):
                count = sizes[terms]
                place = np.repeat(group.first[terms] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
                np.add.at(table[row], group.holder[place], np.repeat(gain, count) * group.times[place])
            row, item = np.nonzero(table >= least)
            own = np.array([_LAST if x is None else x for x in ids], np.int64)[row]
            none = np.array([x is None for x in ids], np.int64)[row]
            kept = _best([kept, np.stack([item, table[row, item], own, none])], k)
            full = np.flatnonzero(np.bincount(kept[0], minlength=width) == k)
            worst = np.searchsorted(kept[0], full, "right") - 1
            least[full] = kept[1, worst]

        for batch in batches:
            ids, found = [], []
            for key, (n, terms, tf) in zip(batch[1].to_pylist(), _counted(automaton, batch[0]), strict=True):
                if len(terms):
                    m = 25 + 75 * n * documents // length
                    ids.append(key)
                    found.append((terms, weights[terms] * (1_000_000_000 * tf // (1000 * tf + 8 * m))))
                if len(found) == step:
                    settle(ids, found)
                    ids, found = [], []
            settle(ids, found)
        if kept.shape[1]:
            columns = [pa.array(kept[0].astype(np.int32)), pa.array(kept[1]), pa.array(kept[2], mask=kept[3] > 0)]
            yield pa.RecordBatch.from_arrays(columns, ["at", "score", "id"])

    return run


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", group_bytes: int = 8 << 20) -> DataFrame:
    """``item, rank, id, score``: the ``k`` documents of the highest score above 0 for every item.

    ``id_col`` holds whole numbers; equal scores go by the smaller one, rows without
    an id come last among equals. Every row of ``docs`` is a document, repeated ones
    too. Null and empty texts have no terms. Equal rows of ``items`` count once,
    several texts of one item (null is one too) together. An item without terms, or
    of which no document holds a term of weight above 0, has no rows; empty tables
    give none. What a task holds of the items is bounded by ``group_bytes`` (or one
    item); more items take more scans of the documents.
    """
    ship(docs)
    spark = docs.sparkSession
    slim = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("id"))
    kind = items.schema[item_col].dataType
    empty = spark.createDataFrame([], f"at int, score long, id long, item {kind.simpleString()}")
    found = empty
    for group in _groups(items, item_col, item_text_col, group_bytes):
        counts = slim.select("text").mapInArrow(_frequencies(group), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        held = {r.term: r.n for r in counts.collect()}
        documents, length = held.pop(-1, 0), held.pop(-2, 0)
        weights = np.zeros(len(group.terms), np.int64)
        for term, df in held.items():
            weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
        names = spark.createDataFrame(list(enumerate(group.items)), empty.select("at", "item").schema)
        best = slim.mapInArrow(_scores(group, weights, documents, length, k), "at int, score long, id long")
        found = found.unionByName(best.join(F.broadcast(names), "at"))
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(_SALTS)))
    for keys in (["item", "salt"], ["item"]):
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return stored(salted.select("item", "rank", "id", "score"), "ranked")


#: For whole-number ids without repeats; tables ``documents`` and ``benchmark``.
RANKED_SQL = f"""
WITH words AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER_LETTERS}', '{_LOWER_LETTERS}'), '[0-9A-Za-z\\x{{80}}-\\x{{10FFFF}}]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
totals AS (SELECT count(*) AS N, sum(n)::BIGINT AS L FROM sizes),
asked AS (SELECT item_id, term, count(*) AS times FROM
          (SELECT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER_LETTERS}', '{_LOWER_LETTERS}'), '[0-9A-Za-z\\x{{80}}-\\x{{10FFFF}}]+')) AS term FROM benchmark) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(totals.N) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, totals WHERE term IN (SELECT term FROM asked) GROUP BY term),
gains AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * sizes.n * totals.N) // totals.L))) AS gain
          FROM tf JOIN weights USING (term) JOIN sizes USING (doc_id), totals),
scored AS (SELECT item_id, doc_id, sum(gain * times)::BIGINT AS score FROM gains JOIN asked USING (term) GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""
