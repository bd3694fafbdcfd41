import random

import pytest
from pyspark.sql import functions as F

from shapeloom.functions import geometry as g
from shapeloom.functions.buckets import GRID_256, GRID_1024, assign_bucket
from shapeloom.plans.jobs import ImageSettings, plan_images


@pytest.fixture(scope="module")
def images(spark):
    rng = random.Random(3)
    rows = [(f"i{n}", rng.randint(64, 6000), rng.randint(64, 6000)) for n in range(2000)]
    return spark.createDataFrame(rows, "image_id string, width bigint, height bigint")


@pytest.mark.parametrize("mode", ["center", "random"])
@pytest.mark.parametrize("grid", [GRID_256, GRID_1024])
def test_crop_window_lies_inside_the_resized_image(images, mode, grid):
    planned = g.crop_plan(g.resize_plan(assign_bucket(images, grid)), mode, "image_id")
    outside = planned.filter(
        "crop_x < 0 or crop_y < 0 or crop_x + bucket_w > resize_w or crop_y + bucket_h > resize_h"
        " or (resize_w > bucket_w and resize_h > bucket_h)"
    )
    assert outside.count() == 0


def test_random_crop_repeats_and_varies(images):
    def offsets(seed):
        planned = g.crop_plan(g.resize_plan(assign_bucket(images, GRID_256)), "random", "image_id", seed)
        return {r.image_id: (r.crop_x, r.crop_y) for r in planned.repartition(7).collect()}

    assert offsets(1) == offsets(1)
    assert offsets(1) != offsets(2)


def test_random_crop_needs_a_key(images):
    with pytest.raises(ValueError):
        g.crop_plan(g.resize_plan(assign_bucket(images, GRID_256)), "random")


def test_min_pixels_is_inclusive(spark):
    df = spark.createDataFrame([(1024, 1024), (1023, 1024), (50000, 50000)], "w int, h int")
    assert df.filter(g.has_min_pixels(F.col("w"), F.col("h"), 1024)).count() == 2


def test_shrink_first_keeps_only_full_area_buckets(spark):
    rows = [("a", 5000, 4000), ("b", 5000, 5000), ("c", 9000, 2250), ("d", 3000, 2000)]
    images = spark.createDataFrame(rows, "image_id string, width bigint, height bigint")

    def kept(**options):
        planned = plan_images(images, ImageSettings(None, GRID_1024, min_side=1024, **options))
        return {r.image_id for r in planned.collect()}

    assert kept() == {"a", "b", "c", "d"}
    assert kept(shrink_first=True) == {"b", "c", "d"}


def test_planning_is_narrow(images, plan):
    assert "Exchange" not in plan(plan_images(images, ImageSettings(None, GRID_1024, min_side=1024)))


def test_latent_shape_product(images):
    shaped = assign_bucket(images, GRID_256).select("bucket_w", "bucket_h", g.latent_shape(4).alias("s"))
    row = shaped.withColumn("n", g.shape_size(F.col("s"))).first()
    assert list(row.s) == [4, row.bucket_h // 8, row.bucket_w // 8]
    assert row.n == row.s[0] * row.s[1] * row.s[2]
