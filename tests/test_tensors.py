import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shapeloom.functions import tensors as t
from shapeloom.sources.catalog import read_byte_tensors, read_half_tensors

EDGES = [0.0, -0.0, 1.0, -1.0, 2.0**-14, 2.0**-15, 2.0**-16, 2.0**-17, 3 * 2.0**-17, 57344.0, 61439.0, 61440.0, 1e30, -1e30]
EDGES += [float("inf"), float("-inf"), 65504.0, 65519.0, 65520.0, 1.125, 1.375, 1.625, 1.875, 2.0**-24, 2.0**-25, 3e-8]


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(5)
    spread = rng.standard_normal(2000) * 2.0 ** rng.integers(-30, 18, 2000)
    return [float(v) for v in np.concatenate([EDGES, spread])]


def grid_nearest(value: float) -> int:
    """Nearest E5M2 code by search over all finite codes and the first value beyond them."""
    magnitudes = [float(np.array([c << 8], np.uint16).view(np.float16)[0]) for c in range(124)] + [65536.0]
    a = abs(value)
    best = min(range(125), key=lambda c: (abs(magnitudes[c] - min(a, 65536.0)), c % 2))
    return best + (128 if value < 0 else 0)


def test_fp8_matches_exhaustive_search(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    codes = [r.c for r in df.select(t.fp8_code(F.col("v")).alias("c")).collect()]
    assert codes == [grid_nearest(v) for v in values]
    assert t.e5m2_encode(np.array(values)).tolist() == codes
    assert t.e5m2_encode(np.array([np.nan])).tolist() == [127]


def test_fp8_decodes_every_code(spark):
    df = spark.range(256).select(F.col("id").cast("int").alias("c"))
    back = [r.v for r in df.select("c", t.fp8_value(F.col("c")).alias("v")).orderBy("c").collect()]
    expected = (np.arange(256, dtype=np.uint16) << 8).view(np.float16).astype(np.float64)
    np.testing.assert_array_equal(np.array(back, float), expected)
    np.testing.assert_array_equal(t.e5m2_decode(np.arange(256)), expected.astype(np.float32))


def test_float16_matches_numpy(spark, values):
    df = spark.createDataFrame([(values,)], "v array<double>")
    with np.errstate(over="ignore"):
        expected = np.array(values).astype(np.float16).astype(np.float64)
    row = df.select(t.to_float16("v").alias("sql"), t.unpack_float16(t.pack_float16("v")).alias("arrow")).first()
    np.testing.assert_array_equal(row["sql"], expected)
    np.testing.assert_array_equal(row["arrow"], expected)


def test_packing_keeps_nulls_empties_and_order(spark):
    rows = [(i, None if i % 5 == 0 else [float(i + k) for k in range(i % 4)]) for i in range(200)]
    df = spark.createDataFrame(rows, "i int, v array<float>").repartition(3, "i")
    out = df.select("i", "v", t.pack_float16("v").alias("h"), t.pack_fp8("v").alias("q"))
    back = out.select("i", "v", "h", "q", t.unpack_float16("h").alias("hv"), t.unpack_fp8("q").alias("qv")).collect()
    assert len(back) == 200
    for r in back:
        if r.v is None:
            assert r.h is None and r.q is None and r.hv is None and r.qv is None
        else:
            assert len(r.h) == 2 * len(r.v) and len(r.q) == len(r.v)
            assert r.hv == r.v
            assert r.qv == t.e5m2_decode(t.e5m2_encode(np.array(r.v))).tolist()


def test_reads_float16_parquet(spark, tmp_path):
    data = [[1.5, -2.25, 65504.0], [], None, [0.1]]
    half = pa.array([None if v is None else np.array(v, np.float16) for v in data], pa.list_(pa.float16()))
    pq.write_table(pa.table({"image_id": ["a", "b", "c", "d"], "latent": half}), tmp_path / "half.parquet")
    rows = {r.image_id: r.latent for r in read_half_tensors(spark, str(tmp_path), "latent", "image_id string").collect()}
    assert rows["a"] == [1.5, -2.25, 65504.0] and rows["b"] == [] and rows["c"] is None
    assert rows["d"] == [float(np.float16(0.1))]


def test_reads_nested_uint8_parquet(spark, tmp_path):
    cube = [[[0, 255], [3, 4]], [[5, 128], [7, 8]]]
    kind = pa.list_(pa.list_(pa.list_(pa.uint8())))
    pq.write_table(pa.table({"image_id": ["a"], "latent": pa.array([cube], kind)}), tmp_path / "bytes.parquet")
    row = read_byte_tensors(spark, str(tmp_path), "latent").first()
    assert row.latent == [0, 255, 3, 4, 5, 128, 7, 8]


def test_layout_round_trips(spark):
    cube = np.arange(2 * 3 * 5)
    df = spark.createDataFrame([(cube.tolist(),)], "v array<bigint>")
    dims = [F.lit(n) for n in (2, 3, 5)]
    row = df.select(
        t.unflatten_tensor(F.col("v"), dims).alias("nested"),
        t.flatten_tensor(t.unflatten_tensor(F.col("v"), dims)).alias("flat"),
        t.chw_to_hwc(F.col("v"), *dims).alias("hwc"),
        t.hwc_to_chw(t.chw_to_hwc(F.col("v"), *dims), *dims).alias("chw"),
    ).first()
    assert row.nested == cube.reshape(2, 3, 5).tolist()
    assert row.flat == cube.tolist() == row.chw
    assert row.hwc == cube.reshape(2, 3, 5).transpose(1, 2, 0).ravel().tolist()


def test_padding_never_truncates(spark):
    df = spark.createDataFrame([([1, 2],), ([],), (list(range(40)),)], "v array<int>")
    sizes = [r.n for r in df.select(F.size(t.pad_array(F.col("v"), 32, F.lit(0))).alias("n")).collect()]
    assert sizes == [32, 32, 40]


def test_scaling_inverts(spark):
    df = spark.createDataFrame([(list(range(256)),)], "v array<int>")
    row = df.select(t.denormalize_pixels(t.normalize_pixels(F.col("v"))).alias("back")).first()
    assert max(abs(a - b) for a, b in zip(row.back, range(256))) <= 1
