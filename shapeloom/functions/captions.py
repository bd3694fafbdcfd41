"""Caption columns: lists, defaults and sidecar JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Caption sources by their short field in a url-keyed caption map.
SHORT_CAPTION_FIELDS = ["cap_internlm_short", "cap_florence_short", "cap_sharecap_short"]
LONG_CAPTION_FIELDS = ["cap_internlm", "cap_florence", "cap_sharecap"]


def truthy(value: Column) -> Column:
    """Present and not empty."""
    return value.isNotNull() & (value != F.lit(""))


def map_field(captions: Column, field: str, default: str = "") -> Column:
    """A map entry; the default stands for an absent map or key, not for a null value."""
    absent = captions.isNull() | ~F.coalesce(F.map_contains_key(captions, F.lit(field)), F.lit(False))
    return F.when(absent, F.lit(default)).otherwise(captions[field])


def caption_list(captions: Column, fields: list[str] | None = None) -> Column:
    """One caption per field, in field order."""
    return F.array(*[map_field(captions, f) for f in (fields or SHORT_CAPTION_FIELDS)])


def sidecar_fields(doc: Column, json_text: Column) -> Column:
    """``struct(valid, key, url, caption)`` of a sidecar text and its parsed VARIANT.

    ``caption`` is '' only when the field is absent; an explicit null stays null.
    Values that are not strings keep their JSON text. What is no JSON object has
    ``valid = false`` instead of failing the job.
    """
    is_object = F.ltrim(json_text, F.lit(" \t\r\n")).startswith("{")
    valid = F.coalesce(doc.isNotNull() & is_object, F.lit(False))
    entry = F.try_variant_get(doc, "$.caption", "variant")
    return F.struct(
        valid.alias("valid"),
        F.when(valid, F.try_variant_get(doc, "$.key", "string")).alias("key"),
        F.when(valid, F.try_variant_get(doc, "$.url", "string")).alias("url"),
        F.when(valid, F.when(entry.isNull(), F.lit("")).otherwise(entry.cast("string"))).alias("caption"),
    )


def with_sidecar(df: DataFrame, json_text: str) -> DataFrame:
    """Add ``valid, key, url, caption``, parsing each document once.

    The document is its own projection, and the generator keeps later filters from
    being pushed below it and parsing again.
    """
    parsed = df.withColumn("sidecar_doc", F.try_parse_json(F.col(json_text)))
    return parsed.select("*", F.inline(F.array(sidecar_fields(F.col("sidecar_doc"), F.col(json_text))))).drop("sidecar_doc")
