"""Aspect-ratio buckets: the grid of target sizes and the nearest-size rule.

A bucket grid holds, for every width on the grid, the tallest size whose pixel
count still fits the budget, and for every height the widest one. An image goes
to the bucket whose aspect ratio is nearest in log space.

The grid is configuration (a few dozen sizes), so it is folded into the plan as
a decision tree of ``CASE WHEN`` comparisons: the midpoint in log space between two
aspects a and b is sqrt(a*b). No image of sane size lies within rounding distance
of such a midpoint, so comparing doubles picks the same bucket as comparing
logarithms. The assignment stays in generated code, with no join, shuffle or
per-row array.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shapeloom.functions.arithmetic import int_div


@dataclass(frozen=True)
class BucketGrid:
    """``side`` squared pixels, sizes on multiples of ``step`` in [smallest, largest]."""

    side: int = 256
    step: int = 16
    smallest: int = 128
    largest: int = 512

    @property
    def area(self) -> int:
        return self.side * self.side

    def sizes(self) -> list[tuple[int, int]]:
        """(width, height) in ascending aspect order."""
        reach = min(self.largest, self.area // self.smallest)
        axis = range(self.smallest, reach + 1, self.step)

        def partner(x: int) -> int:
            room = min(self.largest, self.area // x) - self.smallest
            return self.smallest + room // self.step * self.step

        both = {(x, partner(x)) for x in axis} | {(partner(x), x) for x in axis}
        return sorted(both, key=lambda wh: wh[0] * 4096 - wh[1])


# The four grids in use (pixel side, step, smallest, largest).
GRID_256 = BucketGrid(256, 16, 128, 512)
GRID_256_COARSE = BucketGrid(256, 64, 128, 512)
GRID_512 = BucketGrid(512, 16, 256, 1024)
GRID_1024 = BucketGrid(1024, 64, 512, 2048)


def bucket_table(spark: SparkSession, grid: BucketGrid) -> DataFrame:
    """The grid as a DataFrame ``(bucket, width, height, resolution, aspect)``."""
    axis = spark.range(grid.smallest, min(grid.largest, grid.area // grid.smallest) + 1, grid.step)
    room = F.least(F.lit(grid.largest), int_div(F.lit(grid.area), F.col("id"))) - grid.smallest
    partner = grid.smallest + int_div(room, F.lit(grid.step)) * grid.step
    pairs = axis.select(F.col("id").alias("x"), partner.alias("y"))
    sizes = (
        pairs.select(F.col("x").alias("width"), F.col("y").alias("height"))
        .union(pairs.select(F.col("y"), F.col("x")))
        .distinct()
    )
    # A grid holds a few dozen sizes whatever the data, so one sorted array is bounded.
    ordered = sizes.agg(
        F.array_sort(F.collect_list(F.struct((F.col("width") * 4096 - F.col("height")).alias("k"), "width", "height"))).alias("s")
    )
    return ordered.select(F.posexplode("s").alias("bucket", "e")).select(
        F.col("bucket").cast("bigint").alias("bucket"),
        "e.width",
        "e.height",
        resolution_label(F.col("e.width"), F.col("e.height")).alias("resolution"),
        (F.col("e.width") / F.col("e.height")).alias("aspect"),
    )


def resolution_label(width: Column, height: Column) -> Column:
    """Folder label: height first, e.g. ``512x128`` for a 128-wide, 512-high size."""
    return F.concat_ws("x", height.cast("string"), width.cast("string"))


def aspect_ratio(width: Column, height: Column) -> Column:
    """Width over height; 0 stands for sizes that are missing or not positive."""
    ratio = width / F.nullif(height, F.lit(0))
    return F.coalesce(F.greatest(ratio, F.lit(0.0)), F.lit(0.0))


def bucket_index(aspect: Column, grid: BucketGrid) -> Column:
    """Index into ``grid.sizes()`` of the bucket nearest to an aspect column, null for aspect 0.

    Pass a plain column: every comparison mentions it, and an expression would be
    repeated in each. Comparing one non-null double keeps the generated method small
    enough for the JVM to compile it (a method over 8,000 bytes stays interpreted).
    """
    aspects = [Fraction(w, h) for w, h in grid.sizes()]
    if any(a >= b for a, b in zip(aspects, aspects[1:])):
        raise ValueError("bucket aspects must ascend strictly")
    cuts = [math.sqrt(a * b) for a, b in zip(aspects, aspects[1:])]

    def pick(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(aspect > F.lit(cuts[mid]), pick(mid + 1, hi)).otherwise(pick(lo, mid))

    return F.when(aspect > F.lit(0.0), pick(0, len(aspects) - 1))


def bucket_size(index: Column, grid: BucketGrid) -> tuple[Column, Column]:
    """(width, height) of a bucket index, read from a constant array."""
    sizes = grid.sizes()
    widths = F.array(*[F.lit(w) for w, _ in sizes])
    heights = F.array(*[F.lit(h) for _, h in sizes])
    return F.get(widths, index).cast("bigint"), F.get(heights, index).cast("bigint")


def assign_bucket(df: DataFrame, grid: BucketGrid, width: str = "width", height: str = "height") -> DataFrame:
    """Add ``bucket, bucket_w, bucket_h, resolution``. Narrow: no exchange."""
    with_aspect = df.withColumn("bucket_aspect", aspect_ratio(F.col(width), F.col(height)))
    indexed = with_aspect.withColumn("bucket", bucket_index(F.col("bucket_aspect"), grid)).drop("bucket_aspect")
    bw, bh = bucket_size(F.col("bucket"), grid)
    labels = F.array(*[F.lit(f"{h}x{w}") for w, h in grid.sizes()])
    return indexed.withColumns({"bucket_w": bw, "bucket_h": bh, "resolution": F.get(labels, "bucket")})
