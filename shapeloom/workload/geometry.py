"""Buckets, resize and crop planning."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from shapeloom.functions import buckets, geometry
from shapeloom.functions.buckets import GRID_1024, assign_bucket
from shapeloom.operators import batching, skew
from shapeloom.workload import query
from shapeloom.workload.standins import DOC_IMAGES_SQL, LINE_IMAGES_SQL, bucket_sql, bucketed_sql, doc_images, line_images

LINE_BUCKETED = f"WITH {LINE_IMAGES_SQL}, {bucketed_sql('line_images')}"
DOC_BUCKETED = f"WITH {DOC_IMAGES_SQL}, {bucketed_sql('doc_images')}"
LINE_KEY = ["l_orderkey", "l_partkey", "l_linenumber"]

ASPECTS = "width / height::DOUBLE AS ar, bucket_w / bucket_h::DOUBLE AS tar"
PLANNED = f"""planned AS (
  SELECT *, CASE WHEN abs(ar - tar) >= 1e-6 AND ar > tar THEN trunc(ar * bucket_h)::BIGINT ELSE bucket_w END AS resize_w,
            CASE WHEN abs(ar - tar) >= 1e-6 AND ar <= tar THEN trunc(bucket_w / ar)::BIGINT ELSE bucket_h END AS resize_h
  FROM (SELECT *, {ASPECTS} FROM bucketed))"""


@query(
    "bucket_table",
    f"""WITH {LINE_IMAGES_SQL}, {bucketed_sql('line_images')},
used AS (SELECT bucket, count(*) AS images FROM bucketed GROUP BY bucket)
SELECT b.bucket, b.bw AS width, b.bh AS height, b.bh || 'x' || b.bw AS resolution, coalesce(u.images, 0) AS images
FROM buckets b LEFT JOIN used u ON b.bucket = u.bucket""",
)
def bucket_table(spark, sf_dir):
    used = assign_bucket(line_images(spark, sf_dir), GRID_1024).groupBy("bucket").agg(F.count(F.lit(1)).alias("images"))
    grid = buckets.bucket_table(spark, GRID_1024).drop("aspect")
    return grid.join(used, "bucket", "left").withColumn("images", F.coalesce("images", F.lit(0)))


@query(
    "nearest_bucket",
    f"""{LINE_BUCKETED}
SELECT l_orderkey, l_partkey, l_linenumber, width, height, bucket_w, bucket_h, resolution FROM bucketed""",
)
def nearest_bucket(spark, sf_dir):
    images = assign_bucket(line_images(spark, sf_dir), GRID_1024)
    return images.select(*LINE_KEY, "width", "height", "bucket_w", "bucket_h", "resolution")


@query(
    "resolution_histogram",
    f"{LINE_BUCKETED} SELECT resolution, count(*) AS images FROM bucketed WHERE width * height >= 1048576 GROUP BY resolution",
)
def resolution_histogram(spark, sf_dir):
    images = line_images(spark, sf_dir).select("width", "height")
    kept = images.filter(geometry.has_min_pixels(F.col("width"), F.col("height"), 1024))
    return batching.shape_histogram(assign_bucket(kept, GRID_1024), ["resolution"])


@query(
    "file_bucket",
    f"""WITH {DOC_IMAGES_SQL}, first_rows AS (
  SELECT source, arg_min(width, doc_id) AS width, arg_min(height, doc_id) AS height FROM doc_images GROUP BY source),
{bucketed_sql('first_rows')}
SELECT d.doc_id, d.source, b.resolution FROM doc_images d JOIN bucketed b USING (source)""",
)
def file_bucket(spark, sf_dir):
    images = doc_images(spark, sf_dir)
    of_file = batching.first_in_file(images, "source", "doc_id", GRID_1024).select("source", "resolution")
    return skew.lookup_join(images.select("doc_id", "source"), of_file, ["source"], ["doc_id"], "inner")


@query(
    "min_pixels",
    f"WITH {LINE_IMAGES_SQL} SELECT l_orderkey, l_partkey, l_linenumber, width, height FROM line_images WHERE width * height >= 1048576",
)
def min_pixels(spark, sf_dir):
    images = line_images(spark, sf_dir)
    return images.filter(geometry.has_min_pixels(F.col("width"), F.col("height"), 1024)).drop("l_returnflag")


@query(
    "oversize_guard",
    f"""{DOC_BUCKETED}
SELECT doc_id, CASE WHEN width * height > 16000000 THEN bucket_w ELSE width END AS load_w,
       CASE WHEN width * height > 16000000 THEN bucket_h ELSE height END AS load_h,
       CASE WHEN width * height > 16000000 THEN trunc(width * sqrt(16000000.0e0 / (width * height)))::BIGINT ELSE width END AS scaled_w,
       CASE WHEN width * height > 16000000 THEN trunc(height * sqrt(16000000.0e0 / (width * height)))::BIGINT ELSE height END AS scaled_h
FROM bucketed""",
)
def oversize_guard(spark, sf_dir):
    images = assign_bucket(doc_images(spark, sf_dir), GRID_1024)
    direct = geometry.oversize_guard(images)
    scaled = geometry.oversize_guard(
        direct.withColumnsRenamed({"load_w": "to_bucket_w", "load_h": "to_bucket_h"}), to_bucket=False
    )
    return scaled.select(
        "doc_id",
        F.col("to_bucket_w").alias("load_w"),
        F.col("to_bucket_h").alias("load_h"),
        F.col("load_w").alias("scaled_w"),
        F.col("load_h").alias("scaled_h"),
    )


@query("resize_plan", f"{LINE_BUCKETED}, {PLANNED} SELECT l_orderkey, l_partkey, l_linenumber, resize_w, resize_h FROM planned")
def resize_plan(spark, sf_dir):
    planned = geometry.resize_plan(assign_bucket(line_images(spark, sf_dir), GRID_1024))
    return planned.select(*LINE_KEY, "resize_w", "resize_h")


@query(
    "center_crop",
    f"""{LINE_BUCKETED}, {PLANNED}
SELECT l_orderkey, l_partkey, l_linenumber, greatest(resize_w - bucket_w, 0) // 2 AS crop_x, greatest(resize_h - bucket_h, 0) // 2 AS crop_y
FROM planned""",
)
def center_crop(spark, sf_dir):
    planned = geometry.resize_plan(assign_bucket(line_images(spark, sf_dir), GRID_1024))
    return geometry.crop_plan(planned, "center").select(*LINE_KEY, "crop_x", "crop_y")


def _draw_sql(axis: int) -> str:
    return f"('0x' || substr(md5('42:' || doc_id), {1 + 8 * axis}, 8))::BIGINT"


@query(
    "random_crop",
    f"""{DOC_BUCKETED}, {PLANNED}
SELECT doc_id, {_draw_sql(0)} % (greatest(resize_w - bucket_w, 0) + 1) AS crop_x,
       {_draw_sql(1)} % (greatest(resize_h - bucket_h, 0) + 1) AS crop_y
FROM planned""",
)
def random_crop(spark, sf_dir):
    planned = geometry.resize_plan(assign_bucket(doc_images(spark, sf_dir), GRID_1024))
    return geometry.crop_plan(planned, "random", key="doc_id").select("doc_id", "crop_x", "crop_y")


@query(
    "latent_shape",
    f"""{LINE_BUCKETED}
SELECT l_orderkey, l_partkey, l_linenumber, 4::BIGINT AS channels, bucket_h // 8 AS latent_h, bucket_w // 8 AS latent_w,
       4 * (bucket_h // 8) * (bucket_w // 8) AS latent_size FROM bucketed""",
)
def latent_shape(spark, sf_dir):
    shaped = assign_bucket(line_images(spark, sf_dir), GRID_1024).withColumn("shape", geometry.latent_shape(4))
    return shaped.select(
        *LINE_KEY,
        F.col("shape")[0].alias("channels"),
        F.col("shape")[1].alias("latent_h"),
        F.col("shape")[2].alias("latent_w"),
        geometry.shape_size(F.col("shape")).alias("latent_size"),
    )


@query("shape_histogram", f"WITH {LINE_IMAGES_SQL} SELECT width, height, count(*) AS images FROM line_images GROUP BY width, height")
def shape_histogram(spark, sf_dir):
    return batching.shape_histogram(line_images(spark, sf_dir), ["width", "height"])


@query(
    "chunk_batches",
    f"""{DOC_BUCKETED}, numbered AS (
  SELECT doc_id, resolution, row_number() OVER (PARTITION BY resolution ORDER BY doc_id) - 1 AS n FROM bucketed)
SELECT doc_id, resolution, n // 32 AS chunk, n % 32 AS chunk_pos FROM numbered""",
)
def chunk_batches(spark, sf_dir):
    images = assign_bucket(doc_images(spark, sf_dir), GRID_1024).select("doc_id", "resolution")
    return batching.chunk_rows(images, ["resolution"], ["doc_id"], 32)


@query(
    "batch_apply",
    f"""{DOC_BUCKETED}, numbered AS (
  SELECT doc_id, resolution, row_number() OVER (PARTITION BY resolution ORDER BY doc_id) - 1 AS n FROM bucketed)
SELECT resolution, n // 32 AS chunk, count(*) AS images, min(doc_id) AS first_id, max(doc_id) AS last_id, sum(doc_id)::BIGINT AS id_sum
FROM numbered GROUP BY resolution, n // 32""",
)
def batch_apply(spark, sf_dir):
    images = assign_bucket(doc_images(spark, sf_dir), GRID_1024).select("doc_id", "resolution")
    chunked = batching.chunk_rows(images, ["resolution"], ["doc_id"], 32)

    def describe(batch):
        ids = batch["doc_id"]
        return pd.DataFrame(
            {
                "resolution": [batch["resolution"].iloc[0]],
                "chunk": [batch["chunk"].iloc[0]],
                "images": [len(batch)],
                "first_id": [ids.iloc[0]],
                "last_id": [ids.iloc[-1]],
                "id_sum": [ids.sum()],
            }
        )

    schema = "resolution string, chunk bigint, images bigint, first_id bigint, last_id bigint, id_sum bigint"
    return batching.apply_batches(chunked, ["resolution"], describe, schema)
