"""Pairing images with sidecars and captions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shapeloom.functions import paths
from shapeloom.functions.captions import SHORT_CAPTION_FIELDS, caption_list, truthy
from shapeloom.operators.skew import lookup_join


def pair_members(members: DataFrame, shard: str = "shard", member: str = "member", content: str = "content", carry: list[str] | None = None, how: str = "inner") -> DataFrame:
    """``(shard, member, stem, json_member, json_text, *carry)``: images with their sidecar.

    Equi-join on the stem inside a shard; images without a sidecar fall out unless ``how`` is 'left'. Where
    several sidecars share a stem the first by member name wins, chosen with a
    map-side-combined ``min_by``. ``carry`` names image columns to keep; leave
    pixel bytes out of it and fetch them after the join, so they are never shuffled.
    """
    named = members.withColumn("stem", paths.stem(F.col(member)))
    keep = [c for c in (carry or []) if c not in (shard, member)]
    images = named.filter(paths.is_image_member(F.col(member))).select(shard, member, "stem", *keep)
    sidecars = (
        named.filter(paths.is_sidecar_member(F.col(member)))
        .groupBy(shard, "stem")
        .agg(
            F.min(member).alias("json_member"),
            F.min_by(F.col(content).cast("string"), F.col(member)).alias("json_text"),
        )
    )
    return lookup_join(images, sidecars, [shard, "stem"], spread_by=[member], how=how)


def valid_metadata(df: DataFrame, fields: list[str]) -> DataFrame:
    """Rows whose metadata fields are all present and non-empty."""
    keep: Column = F.lit(True)
    for field in fields:
        keep = keep & truthy(F.col(field))
    return df.filter(F.coalesce(keep, F.lit(False)))


def optional_captions(images: DataFrame, captions: DataFrame, url: str = "url", caps: str = "caps", fields: list[str] | None = None, spread_by: list[str] | None = None, into: str = "caption", count_from: DataFrame | None = None) -> DataFrame:
    """Attach one caption per field by url; images without an entry get ''.

    ``captions`` is ``(url, caps MAP<STRING,STRING>)``, one row per url.
    """
    joined = lookup_join(images, captions.select(url, caps), [url], spread_by, "left", count_from)
    return joined.withColumn(into, caption_list(F.col(caps), fields or SHORT_CAPTION_FIELDS)).drop(caps)


def one_caption(captions: DataFrame, key: str, caption: str) -> DataFrame:
    """One row per key; a key with different captions raises, repeated rows do not."""
    some = F.count(caption)
    different = (F.min(caption) != F.max(caption)) | ((some > 0) & (some < F.count(F.lit(1))))
    message = F.concat(F.lit("several captions for key "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    return captions.groupBy(key).agg(F.when(F.coalesce(different, F.lit(False)), F.raise_error(message).cast("string")).otherwise(F.min(caption)).alias(caption))


def required_captions(images: DataFrame, captions: DataFrame, key: str = "image_id", caption: str = "caption", on_missing: str = "fail", spread_by: list[str] | None = None, count_from: DataFrame | None = None) -> DataFrame:
    """Attach the caption of each key. ``on_missing``: 'fail' the job, 'drop' the row, or 'null'.

    A key that is listed with a null caption counts as found; one that is listed
    with several captions stops the job (``last_wins`` settles such lists). Where
    computing ``images`` is costly, pass a cheap table with the same keys as ``count_from``.
    """
    if on_missing not in ("fail", "drop", "null"):
        raise ValueError(f"on_missing must be fail, drop or null, not {on_missing}")
    lookup = one_caption(captions, key, caption)
    if on_missing == "drop":
        return lookup_join(images, lookup, [key], spread_by, "inner", count_from)
    if on_missing == "null":
        return lookup_join(images, lookup, [key], spread_by, "left", count_from)
    joined = lookup_join(images, lookup.withColumn("caption_found", F.lit(True)), [key], spread_by, "left", count_from)
    message = F.concat(F.lit("no caption for key "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    found = F.when(F.col("caption_found").isNull(), F.raise_error(message).cast("string")).otherwise(F.col(caption))
    return joined.withColumn(caption, found).drop("caption_found")
