"""Ordered computations over groups of any size.

A window partitioned by the group alone sorts the whole group in one task. Here
a group is cut into blocks: windows run inside ``(group, block)``, and one small
row per block carries counts or sums forward. The order of a group is
``(block, order columns)``; with a block that never decreases along the order
column it is simply that order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shapeloom.functions.arithmetic import int_div

BLOCK_ROWS = 1 << 20


def range_block(order: str, rows: int = BLOCK_ROWS) -> Column:
    """Blocks of consecutive values; for unique integer ids at most ``rows`` rows each."""
    return int_div(F.col(order), rows)


def hash_block(columns: list[str], blocks: int) -> Column:
    """``blocks`` even blocks by content hash, for ids that are sparse or not numeric."""
    return F.pmod(F.xxhash64(*columns), F.lit(blocks)).cast("bigint")


def _cut(df: DataFrame, group: list[str], block: Column) -> DataFrame:
    """Add ``block_key = struct(group..., block)``.

    One struct serves the windows and the join, so rows are exchanged once; struct
    equality also treats null group values as equal.
    """
    return df.withColumn("block_key", F.struct(*[F.col(g).alias(f"g{i}") for i, g in enumerate(group)], block.alias("block")))


def _carry(rows: DataFrame, groups: int, value: Column, name: str) -> DataFrame:
    """Per block: the total of ``value`` over all earlier blocks of its group."""
    per_block = rows.groupBy("block_key").agg(value.alias("block_total"))
    group = [F.col("block_key")[f"g{i}"] for i in range(groups)]
    earlier = Window.partitionBy(*group).orderBy(F.col("block_key")["block"]).rowsBetween(Window.unboundedPreceding, -1)
    return per_block.select("block_key", F.coalesce(F.sum("block_total").over(earlier), F.lit(0)).alias(name))


def number_rows(df: DataFrame, group: list[str], order: list[str], block: Column | None = None, name: str = "row_number") -> DataFrame:
    """1-based position of each row within its group, as ``row_number()`` would give.

    Without ``block`` the single order column must be a dense integer key.
    """
    rows = _cut(df, group, range_block(order[0]) if block is None else block)
    carried = _carry(rows, len(group), F.count(F.lit(1)), "rows_before")
    local = rows.withColumn("row_in_block", F.row_number().over(Window.partitionBy("block_key").orderBy(*order)))
    position = (F.col("rows_before") + F.col("row_in_block")).cast("bigint")
    return local.join(carried, "block_key").withColumn(name, position).drop("block_key", "row_in_block", "rows_before")


def running_sum(df: DataFrame, group: list[str], order: list[str], value: str, block: Column, name: str) -> DataFrame:
    """Sum of ``value`` from the start of the group up to and including the row."""
    rows = _cut(df, group, block)
    carried = _carry(rows, len(group), F.sum(value), "sum_before")
    inside = Window.partitionBy("block_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("sum_in_block", F.sum(value).over(inside))
    total = F.col("sum_before") + F.col("sum_in_block")
    return local.join(carried, "block_key").withColumn(name, total).drop("block_key", "sum_before", "sum_in_block")


def rolling_mean(df: DataFrame, group: list[str], order: list[str], value: str, rows: int, name: str, block: Column | None = None, piece: int = 1 << 16) -> DataFrame:
    """Mean of ``value`` over the row and the ``rows - 1`` before it in its group.

    Rows are numbered, then cut into pieces of ``piece`` rows. The last
    ``rows - 1`` rows of a piece are also sent to the next one, where they only
    fill the frame, so every frame is complete and no task holds a whole group.
    """
    reach = rows - 1
    if piece < reach:
        raise ValueError("piece must be at least rows - 1")
    numbered = number_rows(df, group, order, block, "position")
    home = int_div(F.col("position") - 1, piece)
    fills_next = (F.col("position") - 1) % piece >= piece - reach if reach else F.lit(False)
    targets = F.when(fills_next, F.array(home, home + 1)).otherwise(F.array(home))
    spread = numbered.withColumn("home_piece", home).withColumn("piece", F.explode(targets))
    frame = Window.partitionBy(*group, "piece").orderBy("position").rowsBetween(-reach, 0)
    averaged = spread.withColumn(name, F.avg(value).over(frame))
    return averaged.filter(F.col("piece") == F.col("home_piece")).drop("home_piece", "piece", "position")
