"""Counters, throughput and remaining-time estimates computed from run tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shapeloom.operators.ordered import rolling_mean, running_sum

# Fixed value: the smoothed rate averages the last five intervals.
SMOOTHING_INTERVALS = 5


def filter_counts(df: DataFrame, keep: Column, by: list[str] | None = None) -> DataFrame:
    """``total, kept, skipped`` of a filter, overall or per ``by``."""
    kept = F.coalesce(keep, F.lit(False))
    return df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(kept).alias("kept"), F.count_if(~kept).alias("skipped")
    )


def observe_filter(df: DataFrame, keep: Column, observation: Observation) -> DataFrame:
    """Filter while counting in the same pass; read ``observation.get`` after the action."""
    kept = F.coalesce(keep, F.lit(False))
    counted = df.observe(
        observation, F.count(F.lit(1)).alias("total"), F.count_if(kept).alias("kept"), F.count_if(~kept).alias("skipped")
    )
    return counted.filter(kept)


def smoothed_rate(intervals: DataFrame, by: list[str], order: list[str], images: str, seconds: str, block: Column) -> DataFrame:
    """Mean rate of the last five intervals that had images; idle intervals give no row, nor do those of no length.

    Polls closer than half a second belong together: see ``intervals.merge_polls``.
    """
    rated = intervals.filter((F.col(images) > 0) & (F.col(seconds) > 0)).withColumn("rate", F.col(images) / F.col(seconds))
    return rolling_mean(rated, by, order, "rate", SMOOTHING_INTERVALS, "smoothed_rate", block)


def blended_rate(intervals: DataFrame, by: list[str], order: list[str], images: str, elapsed: str, poll_seconds: float, block: Column) -> DataFrame:
    """Mean of the overall rate and the latest interval's; the overall rate when idle."""
    summed = running_sum(intervals, by, order, images, block, "images_so_far")
    overall = F.when(F.col(elapsed) > 0, F.col("images_so_far") / F.col(elapsed)).otherwise(0.0)
    recent = F.col(images) / F.lit(poll_seconds)
    return summed.withColumn("blended_rate", F.when(F.col(images) > 0, (overall + recent) / 2).otherwise(overall))


def remaining_seconds(images: Column, files_done: Column, files_total: Column, rate: Column) -> Column:
    """Images per finished file, times files left, over the rate (0 when there is no rate)."""
    left = images / files_done * (files_total - files_done)
    return F.when((files_done > 0) & (files_total > 0), F.when(rate > 0, left / rate).otherwise(F.lit(0.0)))


def _one_decimal(x: Column) -> Column:
    tenths = F.floor(x * 10 + 0.5).cast("bigint")
    return F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def eta_text(seconds: Column) -> Column:
    """``42s``, ``3.5m`` or ``1.2h``."""
    return (
        F.when(seconds < 60, F.concat(F.floor(seconds + 0.5).cast("string"), F.lit("s")))
        .when(seconds < 3600, F.concat(_one_decimal(seconds / 60), F.lit("m")))
        .otherwise(F.concat(_one_decimal(seconds / 3600), F.lit("h")))
    )
