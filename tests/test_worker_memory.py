"""What bounds the memory of a Python worker: how much crosses to it at a time."""

from pyspark.sql import functions as F

from shapeloom.functions.geometry import crop_plan, resize_plan
from shapeloom.functions.image_header import add_dimensions
from shapeloom.operators import pixels
from test_frames import largest, raw_images

MB = 1 << 20


def test_rgb_crosses_by_the_megabyte(spark):
    rows, held = largest(pixels.to_rgb(raw_images(spark, 1500, 64), ["id"]), "data", 1)
    assert rows == 1500 and held <= 2 * MB + 3 * 64 * 64


def test_resized_pixels_cross_by_the_megabyte(spark):
    rgb = pixels.to_rgb(raw_images(spark, 200, 64), ["id"]).withColumns({"load_w": F.col("width"), "load_h": F.col("height")})
    sized = rgb.withColumns({n: F.lit(96).cast("bigint") for n in ("bucket_w", "bucket_h")})
    rows, held = largest(pixels.resize_pixels(crop_plan(resize_plan(sized), "center"), ["id"]), "pixels", 4)
    assert rows == 200 and held <= 2 * MB + 12 * 96 * 96


def test_encoded_images_cross_by_the_megabyte(spark):
    """The jobs' rows too: those of small pictures that come by the ten thousand, and large ones one by one."""
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    small = spark.range(0, 5000, 1, 1).withColumn("content", F.expr("cast(repeat('x', 1024) as binary)"))
    large = spark.range(0, 6, 1, 1).withColumn("content", F.expr("cast(repeat('x', 3145728) as binary)"))
    for images, count, one in ((small, 5000, 1024), (large, 6, 3 * MB)):
        rows, held = largest(add_dimensions(images), "content", 1)
        assert rows == count and held <= 2 * MB + one
