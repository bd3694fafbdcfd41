"""Unions and last-wins consolidation of keyed tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_tables(tables: list[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b), tables)


def last_wins(df: DataFrame, keys: list[str], sequence: list[str], values: list[str]) -> DataFrame:
    """One row per key: the values of its row with the greatest ``sequence``.

    The values travel as one struct, so fields of different rows never mix. The
    maximum combines map-side, so a hot key sends one row per task.
    """
    latest = F.max_by(F.struct(*values), F.struct(*sequence))
    return df.groupBy(*keys).agg(latest.alias("latest")).select(*keys, *[F.col("latest")[v].alias(v) for v in values])


def merge_ranked(maps: list[DataFrame], keys: list[str], values: list[str]) -> DataFrame:
    """Merge keyed tables in list order; later tables override earlier ones."""
    ranked = [m.select(*keys, *values).withColumn("map_rank", F.lit(i)) for i, m in enumerate(maps)]
    return last_wins(union_tables(ranked), keys, ["map_rank"], values)


def caption_map(table: DataFrame, url: str, sequence: list[str], fields: dict[str, str]) -> DataFrame:
    """``(url, caps MAP)`` from a caption table; ``fields`` maps column -> map field."""
    latest = last_wins(table, [url], sequence, list(fields))
    pairs = [p for column, field in fields.items() for p in (F.lit(field), F.col(column))]
    return latest.select(F.col(url).alias("url"), F.create_map(*pairs).alias("caps"))
