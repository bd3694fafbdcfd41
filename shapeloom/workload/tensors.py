"""Array functions, codecs and encoders on the embedding and document tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shapeloom.functions import tensors
from shapeloom.functions.buckets import BucketGrid, assign_bucket
from shapeloom.functions.geometry import crop_plan, resize_plan
from shapeloom.operators import encoders, pixels
from shapeloom.operators.batching import spread_rows
from shapeloom.session import table
from shapeloom.workload import query
from shapeloom.workload.standins import PICTURES_SQL, bucketed_sql, picture_size, raw_pictures

VALUES = """vals AS (
  SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding)::DOUBLE AS v FROM embeddings)"""
PIXELS = "pix AS (SELECT vec_id, pos, trunc(abs(v) * 255)::BIGINT % 256 AS p FROM vals)"

# Scaled so that the reduced formats meet both normal and subnormal values.
WIDE = "wide AS (SELECT vec_id, label, pos, v * pow(2.0e0, (pos % 40) - 24) AS v FROM vals)"
FP16 = """CASE WHEN abs(v) >= 65520.0e0 THEN sign(v) * 'Infinity'::DOUBLE
  WHEN abs(v) < pow(2.0e0, -14) THEN sign(v) * round_even(abs(v) * pow(2.0e0, 24), 0) * pow(2.0e0, -24)
  ELSE sign(v) * round_even(abs(v) / pow(2.0e0, floor(log2(abs(v))) - 10), 0) * pow(2.0e0, floor(log2(abs(v))) - 10) END"""
FP8 = """(CASE WHEN v < 0 THEN 128 ELSE 0 END) + (CASE WHEN abs(v) >= 61440.0e0 THEN 124
  WHEN abs(v) < pow(2.0e0, -14) THEN round_even(abs(v) * 65536.0e0, 0)::BIGINT
  ELSE ((floor(log2(abs(v))) + 15) * 4 + round_even((abs(v) / pow(2.0e0, floor(log2(abs(v)))) - 1) * 4, 0))::BIGINT END)"""
FP8_BACK = """(CASE WHEN code >= 128 THEN -1.0e0 ELSE 1.0e0 END) * (CASE WHEN code & 127 = 124 THEN 'Infinity'::DOUBLE
  WHEN code & 127 < 4 THEN (code & 127) * pow(2.0e0, -16)
  ELSE (1 + (code & 3) / 4.0e0) * pow(2.0e0, ((code & 127) >> 2) - 15) END)"""


def vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings")


def pixel_array(column="embedding"):
    return F.transform(column, lambda x: (F.abs(x.cast("double")) * 255).cast("int") % 256)


def wide_array(column="embedding"):
    return F.transform(column, lambda x, i: x.cast("double") * F.pow(F.lit(2.0), (i % 40) - 24))


def elements(df, array, *keep, name="value"):
    """One row per array element, so results compare value by value."""
    return df.select(*keep, F.posexplode(array).alias("pos", name)).withColumn("pos", F.col("pos").cast("bigint"))


@query("normalize_pixels", f"WITH {VALUES}, {PIXELS} SELECT vec_id, pos, round(p / 255.0e0 * 2.0e0 - 1.0e0, 9) AS value FROM pix")
def normalize_pixels(spark, sf_dir):
    out = elements(vectors(spark, sf_dir), tensors.normalize_pixels(pixel_array()), "vec_id")
    return out.withColumn("value", F.round("value", 9))


@query(
    "denormalize_pixels",
    f"WITH {VALUES} SELECT vec_id, pos, trunc((greatest(-1.0e0, least(1.0e0, v * 3)) * 0.5e0 + 0.5e0) * 255.0e0)::BIGINT AS value FROM vals",
)
def denormalize_pixels(spark, sf_dir):
    tripled = F.transform("embedding", lambda x: x.cast("double") * 3)
    out = elements(vectors(spark, sf_dir), tensors.denormalize_pixels(tripled), "vec_id")
    return out.withColumn("value", F.col("value").cast("bigint"))


@query(
    "tensor_flatten",
    f"WITH {VALUES} SELECT vec_id, pos // 16 AS c, (pos // 4) % 4 AS y, pos % 4 AS x, round(v, 9) AS value, pos AS flat_pos FROM vals",
)
def tensor_flatten(spark, sf_dir):
    """Flat -> nested [4,4,4] -> one row per element, beside its place in the flattened form."""
    four = F.lit(4)
    nested = vectors(spark, sf_dir).withColumn("nested", tensors.unflatten_tensor(F.col("embedding"), [four, four, four]))
    flat = nested.select("vec_id", "nested", F.posexplode(tensors.flatten_tensor(F.col("nested"))).alias("flat_pos", "v"))
    c, y, x = (F.floor(F.col("flat_pos") / 16), F.floor(F.col("flat_pos") / 4) % 4, F.col("flat_pos") % 4)
    placed = flat.select("vec_id", "nested", "v", F.col("flat_pos").cast("bigint").alias("flat_pos"), *[
        d.cast("bigint").alias(n) for n, d in (("c", c), ("y", y), ("x", x))
    ])
    at = F.get(F.get(F.get("nested", F.col("c").cast("int")), F.col("y").cast("int")), F.col("x").cast("int"))
    return placed.select("vec_id", "c", "y", "x", F.round(at.cast("double"), 9).alias("value"), "flat_pos")


@query("to_float16", f"WITH {VALUES}, {WIDE} SELECT vec_id, pos, {FP16} AS value FROM wide")
def to_float16(spark, sf_dir):
    return elements(vectors(spark, sf_dir), tensors.to_float16(wide_array()), "vec_id")


@query("fp8_quantize", f"WITH {VALUES}, {WIDE} SELECT vec_id, pos, {FP8} AS value FROM wide")
def fp8_quantize(spark, sf_dir):
    out = elements(vectors(spark, sf_dir), tensors.fp8_quantize(wide_array()), "vec_id")
    return out.withColumn("value", F.col("value").cast("bigint"))


@query("fp8_dequantize", f"WITH {VALUES}, {WIDE}, q AS (SELECT vec_id, pos, {FP8} AS code FROM wide) SELECT vec_id, pos, {FP8_BACK} AS value FROM q")
def fp8_dequantize(spark, sf_dir):
    packed = vectors(spark, sf_dir).withColumn("packed", tensors.pack_fp8(wide_array()))
    out = elements(packed, tensors.unpack_fp8("packed"), "vec_id")
    return out.withColumn("value", F.col("value").cast("double"))


@query(
    "fp8_error",
    f"""WITH {VALUES}, q AS (SELECT label, v, {FP8} AS code FROM vals)
SELECT label, count(*) AS n, round(avg(abs(v - {FP8_BACK})), 9) AS mean_error, round(max(abs(v - {FP8_BACK})), 9) AS max_error
FROM q GROUP BY label""",
)
def fp8_error(spark, sf_dir):
    coded = vectors(spark, sf_dir).select("label", "embedding", tensors.unpack_fp8(tensors.pack_fp8("embedding")).alias("back"))
    pairs = coded.select("label", F.explode(F.arrays_zip("embedding", "back")).alias("p"))
    gap = F.abs(F.col("p.embedding").cast("double") - F.col("p.back").cast("double"))
    return pairs.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(gap), 9).alias("mean_error"), F.round(F.max(gap), 9).alias("max_error")
    )


@query("chw_to_hwc", f"WITH {VALUES} SELECT vec_id, (pos % 16) * 4 + pos // 16 AS pos, round(v, 9) AS value FROM vals")
def chw_to_hwc(spark, sf_dir):
    out = elements(vectors(spark, sf_dir), tensors.chw_to_hwc(F.col("embedding"), F.lit(4), F.lit(4), F.lit(4)), "vec_id")
    return out.withColumn("value", F.round(F.col("value").cast("double"), 9))


@query(
    "pad_tokens",
    """WITH tokens AS (SELECT item_id, string_split(text, ' ') AS t FROM benchmark),
sized AS (SELECT item_id, list_transform(t, lambda x: length(x)) AS n FROM tokens),
padded AS (SELECT item_id, CASE WHEN len(n) >= 32 THEN n ELSE list_resize(n, 32, 0) END AS n FROM sized)
SELECT item_id, generate_subscripts(n, 1) - 1 AS pos, unnest(n)::BIGINT AS value FROM padded""",
)
def pad_tokens(spark, sf_dir):
    lengths = F.transform(F.split("text", " "), lambda t: F.length(t))
    out = elements(table(spark, sf_dir, "benchmark"), tensors.pad_array(lengths, 32, F.lit(0)), "item_id")
    return out.withColumn("value", F.col("value").cast("bigint"))


# ---- encoders --------------------------------------------------------------------

WEIGHT = "(((7 * {i} + 13 * {j}) % 11 - 5) / 10.0e0)"
ENCODED = f"""outs AS (SELECT unnest(generate_series(0, 15)) AS j),
latents AS (SELECT vec_id, j, sum(v * {WEIGHT.format(i='pos', j='j')}) AS z FROM vals, outs GROUP BY vec_id, j)"""


@query("encode_latents", f"WITH {VALUES}, {ENCODED} SELECT vec_id, j AS pos, round(z, 6) AS value FROM latents")
def encode_latents(spark, sf_dir):
    latent = encoders.encode_tensors(F.col("embedding"), encoders.projection_encoder(64, 16), 64)
    out = elements(vectors(spark, sf_dir).select("vec_id", latent.alias("latent")), "latent", "vec_id")
    return out.withColumn("value", F.round("value", 6))


@query(
    "decode_latents",
    f"""WITH {VALUES}, {ENCODED}, ins AS (SELECT unnest(generate_series(0, 63)) AS i),
back AS (SELECT vec_id, i, round(sum(round(z, 6) * {WEIGHT.format(i='i', j='j')} / 64), 6) AS x FROM latents, ins GROUP BY vec_id, i)
SELECT vec_id, i AS pos, trunc(round((greatest(-1.0e0, least(1.0e0, x)) * 0.5e0 + 0.5e0) * 255.0e0, 3))::BIGINT AS value FROM back""",
)
def decode_latents(spark, sf_dir):
    """Latents back to 0..255; values are rounded first so that truncation cannot differ in the last bit."""
    latent = encoders.encode_tensors(F.col("embedding"), encoders.projection_encoder(64, 16), 64)
    rounded = vectors(spark, sf_dir).select("vec_id", F.transform(latent, lambda z: F.round(z, 6)).alias("latent"))
    image = encoders.encode_tensors(F.col("latent"), encoders.projection_decoder(16, 64), 16)
    out = elements(rounded.select("vec_id", image.alias("image")), "image", "vec_id", name="x")
    level = (F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.round("x", 6))) * 0.5 + 0.5) * 255.0
    return out.select("vec_id", "pos", F.round(level, 3).cast("bigint").alias("value"))


@query(
    "embed_text",
    """WITH words AS (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents),
slots AS (SELECT doc_id, ('0x' || substr(md5(w), 1, 8))::BIGINT % 1152 AS pos, count(*) AS n FROM words WHERE w <> '' GROUP BY ALL),
norms AS (SELECT doc_id, sqrt(sum(n * n)) AS norm FROM slots GROUP BY doc_id)
SELECT doc_id, pos, round(n / norm, 6) AS value FROM slots JOIN norms USING (doc_id)""",
)
def embed_text(spark, sf_dir):
    docs = spread_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    vector = encoders.encode_texts(F.col("text"), encoders.hashing_text_encoder())
    out = elements(docs.select("doc_id", vector.alias("embedding")), "embedding", "doc_id")
    return out.filter(F.col("value") != 0).withColumn("value", F.round("value", 6))


@query(
    "caption_rows",
    f"WITH {PICTURES_SQL} SELECT doc_id, 'a ' || width || 'x' || height || ' image of ' || lang AS caption FROM pictures",
)
def caption_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    width, height, _ = picture_size(F.col("doc_id"))
    sized = docs.select("doc_id", width.alias("width"), height.alias("height"), "lang")
    captioner = encoders.template_captioner("width", "height", "lang")
    caption = encoders.caption_images([F.col("width"), F.col("height"), F.col("lang")], captioner)
    return sized.select("doc_id", caption.alias("caption"))


# ---- pixels ----------------------------------------------------------------------


@query(
    "to_rgb",
    f"""WITH {PICTURES_SQL},
cells AS (SELECT doc_id, channels, x, unnest(generate_series(0, height - 1)) AS y
  FROM (SELECT *, unnest(generate_series(0, width - 1)) AS x FROM pictures)),
sums AS (SELECT doc_id, sum((doc_id + 3 * x + 5 * y) % 256) AS red,
  sum((doc_id + 3 * x + 5 * y + CASE WHEN channels = 1 THEN 0 ELSE 7 END) % 256) AS green,
  sum((doc_id + 3 * x + 5 * y + CASE WHEN channels = 1 THEN 0 ELSE 14 END) % 256) AS blue FROM cells GROUP BY doc_id)
SELECT doc_id, p.width::BIGINT AS width, p.height::BIGINT AS height, red::BIGINT AS red, green::BIGINT AS green, blue::BIGINT AS blue
FROM sums JOIN pictures p USING (doc_id)""",
)
def to_rgb(spark, sf_dir):
    rgb = pixels.to_rgb(raw_pictures(spark, sf_dir), ["doc_id"])

    @F.pandas_udf("red bigint, green bigint, blue bigint")
    def channel_sums(data: pd.Series) -> pd.DataFrame:
        rows = [np.frombuffer(d, np.uint8).reshape(-1, 3).sum(axis=0, dtype=np.int64) for d in data]
        return pd.DataFrame(np.array(rows).reshape(-1, 3), columns=["red", "green", "blue"])

    summed = rgb.select("doc_id", F.col("width").cast("bigint"), F.col("height").cast("bigint"), channel_sums("data").alias("s"))
    return summed.select("doc_id", "width", "height", "s.red", "s.green", "s.blue")


SMALL_GRID = BucketGrid(32, 8, 16, 64)


@query(
    "resize_pixels",
    f"""WITH {PICTURES_SQL}, {bucketed_sql('pictures', SMALL_GRID)}
SELECT doc_id, resolution, 3::BIGINT AS channels, bucket_h AS height, bucket_w AS width, 3 * bucket_w * bucket_h AS n_values FROM bucketed""",
)
def resize_pixels(spark, sf_dir):
    raw = raw_pictures(spark, sf_dir)
    rgb = pixels.to_rgb(raw, ["doc_id"])
    loaded = rgb.withColumns({"load_w": F.col("width"), "load_h": F.col("height")})
    planned = crop_plan(resize_plan(assign_bucket(loaded, SMALL_GRID)), "center")
    out = pixels.resize_pixels(planned, ["doc_id", "resolution"])
    shape = F.col("pixel_shape")
    return out.select(
        "doc_id",
        "resolution",
        shape[0].alias("channels"),
        shape[1].alias("height"),
        shape[2].alias("width"),
        F.size("pixels").cast("bigint").alias("n_values"),
    )
