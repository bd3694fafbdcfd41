"""Bloom filters as tables: built by an aggregate, asked by joins of a bounded table.

A filter is the table ``(word, mask)`` of its 64-bit words that are not empty. Several
filters become one by an aggregate over their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of every filter (at most 262,144 words, so the table can be broadcast) and places per id.
BITS, PLACES = 1 << 24, 4


def _place(id_col: str, number: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(number), F.col(id_col)), F.lit(BITS))


def bloom_of(ids: DataFrame, id_col: str) -> DataFrame:
    """``word, mask`` of the ids; null ids too."""
    places = F.explode(F.array(*[_place(id_col, k) for k in range(PLACES)])).alias("place")
    words = ids.select(places).select((F.shiftright("place", 6)).alias("word"), F.expr("shiftleft(1L, cast(place & 63 as int))").alias("mask"))
    return words.groupBy("word").agg(F.bit_or("mask").alias("mask"))


def merged(filters: DataFrame) -> DataFrame:
    """The filter of all ids of several filters."""
    return filters.groupBy("word").agg(F.bit_or("mask").alias("mask"))


def perhaps_in(rows: DataFrame, id_col: str, words: DataFrame, out: str) -> DataFrame:
    """``rows`` with the column ``out``: false for ids that are certainly in no filter. Nothing is exchanged."""
    asked = rows.withColumn(out, F.lit(True))
    for k in range(PLACES):
        own = F.broadcast(words.select(F.col("word").alias("bloom_word"), F.col("mask").alias("bloom_mask")))
        place = _place(id_col, k)
        joined = asked.join(own, F.shiftright(place, 6) == F.col("bloom_word"), "left")
        bit = F.coalesce(F.col("bloom_mask"), F.lit(0).cast("bigint")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), (place.bitwiseAND(F.lit(63).cast("bigint"))).cast("int")))
        asked = joined.withColumn(out, F.col(out) & (bit != 0)).drop("bloom_word", "bloom_mask")
    return asked
