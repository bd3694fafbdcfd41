"""Connected components of links between documents or vectors, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shapeloom.llm.common import stored


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` for every id that occurs in ``links``; component: the smallest id reachable.

    Alternates two star steps until nothing changes: each node hands its larger
    neighbours, then its smaller ones, to the smallest id it knows. The number of
    rounds grows with the logarithm of the longest chain. Every round is a minimum
    (combined before the shuffle) and a join; its links are written to the shared
    folder, so a round survives lost executors. Links with a null end are ignored.
    """
    links = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    links = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = None
    while True:
        both = links.where("u <> v").union(links.where("u <> v").select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = large.union(links.where("u = v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(down.select("u", F.col("m").alias("v"))).distinct()
        links = stored(small, "links")
        found = links.agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum(F.xxhash64("u", "v") % F.lit(1_000_000_007)), F.lit(0)).alias("h"),
        ).first()
        if state == (found.n, found.h):
            break
        state = (found.n, found.h)
    return links.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
