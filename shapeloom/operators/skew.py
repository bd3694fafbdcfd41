"""Joins that stay balanced when one key holds a large share of the rows.

``lookup_join`` attaches a keyed table to a fact table. It has three shapes:

* the lookup's estimated size is under Spark's own broadcast threshold: a plain
  join, which Spark broadcasts (the size is checked, not assumed);
* otherwise a shuffle join in which only the *hot* keys are salted. A key is hot
  when it holds more than ``share`` of the fact rows, so there can be at most
  ``1/share`` of them, and that bounded list is all that is broadcast;
* null fact keys never match, so they are spread over all salts.

Salts are hashes of row content, never random, so a recomputed task agrees with
the one it replaces. No row is dropped or capped in any shape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_SHARE = 1.0 / 512
SALTS = 64
COUNTED_ONE_IN = 16


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan, or None where unavailable."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:  # no JVM behind this session
        return None


def broadcast_limit(df: DataFrame) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (negative: disabled)."""
    text = str(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")).strip().lower()
    for suffix, factor in (("kb", 1 << 10), ("mb", 1 << 20), ("gb", 1 << 30), ("k", 1 << 10), ("m", 1 << 20), ("g", 1 << 30), ("b", 1)):
        if text.endswith(suffix):
            return int(float(text[: -len(suffix)]) * factor)
    return int(text)


def fits_broadcast(df: DataFrame) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= broadcast_limit(df)


def hot_keys(df: DataFrame, keys: list[str], share: float = HOT_SHARE, spread_by: list[str] | None = None) -> DataFrame:
    """Distinct key tuples holding more than ``share`` of the rows: fewer than ``1/share`` of them.

    Reads only the columns named; the counts combine map-side before the shuffle.
    With ``spread_by`` they are taken on one row in ``COUNTED_ONE_IN`` by content
    hash, which is plenty for keys this frequent. That only decides where rows are
    placed, never which rows come out.
    """
    counted = df
    if spread_by and set(spread_by) <= set(df.columns) and not set(spread_by) <= set(keys):
        counted = df.filter(row_salt(spread_by, COUNTED_ONE_IN) == 0)
    counts = counted.filter(_all_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows"))
    total = counted.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.filter(F.col("key_rows") > total * F.lit(share)).select(*keys)


def _all_present(keys: list[str]) -> Column:
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return present


def row_salt(columns: list[str], salts: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def spread_columns(df: DataFrame, keys: list[str]) -> list[str]:
    """Columns that can tell rows of one key apart: plain values other than the keys."""
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.BinaryType)]
    return [c for c in plain if c not in keys] or keys


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    spread_by: list[str] | None = None,
    how: str = "left",
    count_from: DataFrame | None = None,
    share: float = HOT_SHARE,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``lookup`` to ``fact`` on ``keys``; see the module text for how it balances.

    ``spread_by`` names fact columns that tell rows of one key apart (an id);
    without it all plain columns are used.
    ``how`` is 'left' or 'inner'. Hot keys are counted on ``count_from`` (default the
    facts): name a table with the same keys where the facts are costly to compute.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"lookup_join supports left and inner, not {how}")
    if fits_broadcast(lookup):
        return fact.join(lookup, keys, how)
    return salted_join(fact, lookup, keys, spread_by or spread_columns(fact, keys), how, count_from, share, salts)


def salted_join(
    fact: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    spread_by: list[str],
    how: str = "left",
    count_from: DataFrame | None = None,
    share: float = HOT_SHARE,
    salts: int = SALTS,
) -> DataFrame:
    hot = F.broadcast(hot_keys(fact if count_from is None else count_from, keys, share, spread_by).withColumn("is_hot", F.lit(True)))
    spread = F.col("is_hot").isNotNull() | ~_all_present(keys)
    salted_fact = (
        fact.join(hot, keys, "left")
        .withColumn("join_salt", F.when(spread, row_salt(spread_by, salts)).otherwise(F.lit(0)))
        .drop("is_hot")
    )
    copies = F.when(F.col("is_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_lookup = lookup.join(hot, keys, "left").withColumn("join_salt", F.explode(copies)).drop("is_hot")
    return salted_fact.join(salted_lookup, [*keys, "join_salt"], how).drop("join_salt")
