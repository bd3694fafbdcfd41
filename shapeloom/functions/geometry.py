"""Resize and crop planning as plain column arithmetic (no pixels involved)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shapeloom.functions.arithmetic import int_div

# Fixed values.
ASPECT_TOLERANCE = 1e-6
OVERSIZE_PIXELS = 16_000_000
LATENT_FACTOR = 8


def pixels(width: Column, height: Column) -> Column:
    return width.cast("bigint") * height.cast("bigint")


def has_min_pixels(width: Column, height: Column, side: int) -> Column:
    """Inclusive: an image with exactly ``side * side`` pixels is kept."""
    return pixels(width, height) >= F.lit(side * side)


def resize_plan(df: DataFrame, width: str = "width", height: str = "height", target_w: str = "bucket_w", target_h: str = "bucket_h") -> DataFrame:
    """Add ``resize_w, resize_h``: the aspect-preserving size that covers the target.

    Fractional sizes are truncated, as both engines' integer cast on doubles does here.
    """
    aspect = F.col(width) / F.col(height)
    target = F.col(target_w) / F.col(target_h)
    exact = F.abs(aspect - target) < F.lit(ASPECT_TOLERANCE)
    wider = aspect > target
    new_w = F.when(~exact & wider, (aspect * F.col(target_h)).cast("bigint")).otherwise(F.col(target_w).cast("bigint"))
    new_h = F.when(~exact & ~wider, (F.col(target_w) / aspect).cast("bigint")).otherwise(F.col(target_h).cast("bigint"))
    return df.withColumns({"resize_w": new_w, "resize_h": new_h})


def center_offset(resized: Column, target: Column) -> Column:
    spare = (resized - target).cast("bigint")
    return F.when(spare > 0, int_div(spare, 2)).otherwise(F.lit(0).cast("bigint"))


def crop_digest(key: Column, seed: int = 42) -> Column:
    """MD5 of seed and key: the fixed stand-in for random draws, so that a retried or
    speculative task picks the same window."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))


def random_offset(resized: Column, target: Column, digest: Column, axis: int) -> Column:
    """Uniform offset in [0, resized - target] from 32 bits of the digest, other bits per axis."""
    draw = F.conv(F.substring(digest, 1 + 8 * axis, 8), 16, 10).cast("bigint")
    return draw % (F.greatest(resized - target, F.lit(0)).cast("bigint") + 1)


def crop_plan(df: DataFrame, mode: str = "center", key: str | None = None, seed: int = 42) -> DataFrame:
    """Add ``crop_x, crop_y`` for ``mode`` 'center' or 'random' (needs ``key``)."""
    rw, rh, tw, th = (F.col(c) for c in ("resize_w", "resize_h", "bucket_w", "bucket_h"))
    if mode == "center":
        return df.withColumns({"crop_x": center_offset(rw, tw), "crop_y": center_offset(rh, th)})
    if mode == "random":
        if key is None:
            raise ValueError("random crops need a key column, so that retries agree")
        drawn = df.withColumn("crop_digest", crop_digest(F.col(key), seed))
        offsets = {"crop_x": random_offset(rw, tw, F.col("crop_digest"), 0), "crop_y": random_offset(rh, th, F.col("crop_digest"), 1)}
        return drawn.withColumns(offsets).drop("crop_digest")
    raise ValueError(f"unknown crop mode: {mode}")


def oversize_guard(df: DataFrame, to_bucket: bool = True, limit: int = OVERSIZE_PIXELS, width: str = "width", height: str = "height") -> DataFrame:
    """Add ``load_w, load_h``: the size to decode to before anything else.

    Above ``limit`` pixels the image is loaded at its bucket size (``to_bucket``,
    which does not keep the aspect) or scaled down evenly to fit the limit.
    """
    w, h = F.col(width).cast("bigint"), F.col(height).cast("bigint")
    big = pixels(w, h) > F.lit(limit)
    if to_bucket:
        small_w, small_h = F.col("bucket_w").cast("bigint"), F.col("bucket_h").cast("bigint")
    else:
        scale = F.sqrt(F.lit(float(limit)) / pixels(w, h))
        small_w, small_h = (w * scale).cast("bigint"), (h * scale).cast("bigint")
    return df.withColumns({"load_w": F.when(big, small_w).otherwise(w), "load_h": F.when(big, small_h).otherwise(h)})


def latent_shape(channels: int, factor: int = LATENT_FACTOR, target_w: str = "bucket_w", target_h: str = "bucket_h") -> Column:
    """``[channels, h, w]`` of the latent of a bucket-sized image."""
    spatial = [int_div(F.col(c), factor) for c in (target_h, target_w)]
    return F.array(F.lit(channels).cast("bigint"), *spatial)


def shape_size(shape: Column) -> Column:
    """Number of elements a shape describes."""
    return F.aggregate(shape, F.lit(1).cast("bigint"), lambda n, d: n * d)
