import pytest
from pyspark.sql import functions as F

from shapeloom.__main__ import main
from shapeloom.operators.encoders import block_mean_encoder
from shapeloom.plans.presets import PRESETS, preset
from shapeloom.workload.standins import draw, png_bytes


def small_encoder():
    return block_mean_encoder(8)()


def test_presets_build_settings():
    for name in PRESETS:
        assert preset(name, small_encoder).batch_size > 0
    assert preset("tar_1024", small_encoder, batch_size=5).batch_size == 5
    with pytest.raises(ValueError):
        preset("nothing", small_encoder)


def test_catalog_from_the_command_line(spark, tmp_path):
    rows = [(str(i), (bytearray(png_bytes(draw(i, 70 + i, 60, 3))),), f"c{i}") for i in range(6)]
    df = spark.createDataFrame(rows, "key string, image struct<bytes:binary>, blip string")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    done = main([
        "catalog", "--root", str(tmp_path / "in"), "--work", str(tmp_path / "work"), "--run", "x", "--image", "image.bytes",
        "--caption", "blip", "--encoder", "test_cli:small_encoder", "--decode", "shapeloom.workload.standins:open_png",
    ])
    assert done == 0
    out = spark.read.parquet(str(tmp_path / "work" / "data"))
    assert {r.image_id: r.caption for r in out.collect()} == {str(i): f"c{i}" for i in range(6)}
    assert out.filter(F.size("latent") != F.aggregate("latent_shape", F.lit(1).cast("bigint"), lambda a, b: a * b)).count() == 0


def test_captions_from_the_command_line(spark, tmp_path):
    rows = [("u", 1, "old"), ("u", 2, "new"), ("v", 1, "only")]
    spark.createDataFrame(rows, "url_highres string, seq int, caption_florence2 string").write.parquet(str(tmp_path / "in"))
    main(["captions", "--table", str(tmp_path / "in"), "--sequence", "seq", "--fields", "caption_florence2=cap_florence", "--out", str(tmp_path / "out")])
    got = {r.url: r.caps for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"u": {"cap_florence": "new"}, "v": {"cap_florence": "only"}}
