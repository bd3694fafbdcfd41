import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shapeloom.functions import buckets as b

GRIDS = [b.GRID_256, b.GRID_256_COARSE, b.GRID_512, b.GRID_1024]


def brute_force(grid):
    axis = range(grid.smallest, grid.largest + 1, grid.step)
    fits = [(w, h) for w in axis for h in axis if w * h <= grid.area]
    tallest = {(w, max(h for x, h in fits if x == w)) for w, _ in fits}
    widest = {(max(w for w, y in fits if y == h), h) for _, h in fits}
    return sorted(tallest | widest, key=lambda s: s[0] * 4096 - s[1])


@pytest.mark.parametrize(("grid", "count"), list(zip(GRIDS, [33, 9, 65, 33])))
def test_sizes_match_brute_force(spark, grid, count):
    assert grid.sizes() == brute_force(grid)
    assert len(grid.sizes()) == count
    rows = b.bucket_table(spark, grid).orderBy("bucket").collect()
    assert [(r.width, r.height) for r in rows] == grid.sizes()
    assert [r.bucket for r in rows] == list(range(count))
    assert all(r.resolution == f"{r.height}x{r.width}" for r in rows)


@pytest.mark.parametrize("grid", GRIDS)
def test_sizes_fit_and_cannot_grow(grid):
    for w, h in grid.sizes():
        assert w * h <= grid.area
        can_widen = w + grid.step <= grid.largest and (w + grid.step) * h <= grid.area
        can_heighten = h + grid.step <= grid.largest and w * (h + grid.step) <= grid.area
        assert not (can_widen and can_heighten)


@pytest.mark.parametrize("grid", GRIDS)
def test_assignment_is_log_argmin(spark, grid):
    rng = random.Random(7)
    dims = [(rng.randint(1, 9000), rng.randint(1, 9000)) for _ in range(3000)]
    dims += grid.sizes() + [(1, 60000), (60000, 1), (65535, 65534), (65534, 65535), (1, 1)]
    aspects = np.log([w / h for w, h in grid.sizes()])
    got = b.assign_bucket(spark.createDataFrame(dims, "width bigint, height bigint"), grid).collect()
    for row in got:
        best = int(np.abs(aspects - math.log(row.width / row.height)).argmin())
        assert row.bucket == best, (row.width, row.height)
        assert (row.bucket_w, row.bucket_h) == grid.sizes()[best]


def test_unusable_sizes_get_no_bucket(spark):
    rows = spark.createDataFrame([(0, 5), (5, 0), (None, 5), (-3, 4)], "width bigint, height bigint")
    assert all(r.bucket is None and r.resolution is None for r in b.assign_bucket(rows, b.GRID_256).collect())


def test_assignment_is_narrow_and_compiles(spark, plan):
    df = b.assign_bucket(spark.range(1000).select(F.col("id").alias("width"), (F.col("id") + 1).alias("height")), b.GRID_512)
    assert "Exchange" not in plan(df)
    text = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000, "a larger method would not be compiled by the JVM"
