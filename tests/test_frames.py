"""What Python workers hold of rows with pixels."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shapeloom.functions.geometry import crop_plan, resize_plan
from shapeloom.operators import pixels
from shapeloom.session import BATCH_BYTES


def raw_images(spark, count, side):
    """``count`` gray squares in one partition."""
    data = F.expr(f"cast(repeat(char(65 + id % 7), {side * side}) as binary)")
    sized = {n: F.lit(v).cast("int") for n, v in (("height", side), ("width", side), ("nChannels", 1))}
    return spark.range(0, count, 1, 1).withColumn("data", data).withColumns(sized)


def largest(rows, column, item):
    """(rows, bytes of ``column`` in the largest Arrow batch)."""

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"rows": [len(pdf)], "held": [sum(len(v) * item for v in pdf[column])]})

    return tuple(rows.select(column).mapInPandas(run, "rows long, held long").agg(F.sum("rows"), F.max("held")).first())


def test_rgb_comes_in_small_batches(spark):
    rgb = pixels.to_rgb(raw_images(spark, 3000, 64), ["id"])
    rows, held = largest(rgb, "data", 1)
    assert rows == 3000 and held <= BATCH_BYTES + 3 * 64 * 64


def test_resized_pixels_come_in_small_batches(spark):
    rgb = pixels.to_rgb(raw_images(spark, 400, 64), ["id"]).withColumns({"load_w": F.col("width"), "load_h": F.col("height")})
    sized = rgb.withColumns({n: F.lit(96).cast("bigint") for n in ("bucket_w", "bucket_h")})
    out = pixels.resize_pixels(crop_plan(resize_plan(sized), "center"), ["id"])
    rows, held = largest(out, "pixels", 4)
    assert rows == 400 and held <= BATCH_BYTES + 12 * 96 * 96


def test_frames_keep_every_row_once():
    pdf = pd.DataFrame({"n": range(7)})
    cut = list(pixels.frames_of_bytes(pdf, np.array([1, 9, 2, 3, 50, 1, 1]), limit=10))
    assert [f["n"].tolist() for f in cut] == [[0, 1], [2, 3], [4], [5, 6]]
    assert list(pixels.frames_of_bytes(pdf.iloc[:0], np.array([], int))) == []


def test_rows_that_carry_images_cross_in_small_batches(spark):
    """Also for the jobs: sizing the images bounds the batches, unless the session has a bound of its own."""
    from shapeloom.functions.image_header import add_dimensions

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    images = spark.range(0, 20, 1, 1).withColumn("content", F.expr("cast(repeat('x', 1048576 + cast(id as int)) as binary)"))
    sized = add_dimensions(images)
    rows, held = largest(sized, "content", 1)
    assert rows == 20 and held <= BATCH_BYTES + (2 << 20)
    spark.conf.set(key, "3000000")
    add_dimensions(images)
    assert spark.conf.get(key) in ("3000000", "3000000b")
    spark.conf.unset(key)
