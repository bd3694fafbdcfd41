"""Nothing is lost silently: damaged, compressed and lone shards, setup faults, rejects, file buckets."""

import gzip
import json
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from shapeloom.functions.image_header import add_dimensions
from shapeloom.operators import intervals, ledger, metrics, pixels
from shapeloom.operators.encoders import block_mean_encoder
from shapeloom.operators.joins import required_captions
from shapeloom.plans.jobs import ImageSettings, prepare_catalog, prepare_table, prepare_tar, read_rejects, read_table_rejects
from shapeloom.session import shared_dir
from shapeloom.sources.tar import scan_tar
from shapeloom.workload.standins import draw, open_png, png_bytes
from test_jobs import GRID, SETTINGS, pack, sizes


def members(numbers):
    for i in numbers:
        yield f"img/{i}.jpg", png_bytes(draw(i, *sizes(i), 3))
        yield f"img/{i}.json", json.dumps({"key": f"k{i}", "caption": f"cap {i}"}).encode()


def offset_of(path, name):
    with tarfile.open(path) as archive:
        return archive.getmember(name).offset


def errors(spark, folder):
    return {r.shard: r.error for r in scan_tar(spark, str(folder)).filter("error is not null").collect()}


def test_every_kind_of_damage_is_an_error_row(spark, tmp_path):
    pack(tmp_path / "whole.tar", members(range(6)))
    data = (tmp_path / "whole.tar").read_bytes()
    at = offset_of(tmp_path / "whole.tar", "img/3.jpg")
    (tmp_path / "header.tar").write_bytes(data[:at] + b"x" * 512 + data[at + 512 :])
    (tmp_path / "border.tar").write_bytes(data[:at])
    (tmp_path / "payload.tar").write_bytes(data[: at + 700])
    (tmp_path / "in_header.tar").write_bytes(data[: at + 100])
    (tmp_path / "packed.tar.gz").write_bytes(gzip.compress(data))
    (tmp_path / "packed_cut.tar.gz").write_bytes(gzip.compress(data)[:-3000])
    found = errors(spark, tmp_path)
    assert set(found) == {"header.tar", "border.tar", "payload.tar", "in_header.tar", "packed_cut.tar.gz"}
    assert "damaged header" in found["header.tar"] and "end mark" in found["border.tar"]


def test_compressed_shards_give_the_same_latents(spark, tmp_path):
    for name in ("plain", "packed"):
        (tmp_path / name).mkdir()
    pack(tmp_path / "plain" / "a.tar", members(range(8)))
    (tmp_path / "packed" / "a.tar.gz").write_bytes(gzip.compress((tmp_path / "plain" / "a.tar").read_bytes()))
    got = []
    for name in ("plain", "packed"):
        rows = prepare_tar(spark, str(tmp_path / name), str(tmp_path / f"work-{name}"), "r", SETTINGS)
        got.append({r.image_id: list(r.latent) for r in rows.collect()})
    assert len(got[0]) == 8 and got[0] == got[1]


def test_sidecar_bytes_that_are_not_text_reject_the_image(spark, tmp_path):
    (tmp_path / "in").mkdir()
    one = dict(members([1]))
    pack(tmp_path / "in" / "a.tar", [*members(range(2, 5)), ("img/1.jpg", one["img/1.jpg"]), ("img/1.json", b'{"key": "k1", "caption": "\xff"}')])
    prepare_tar(spark, str(tmp_path / "in"), str(tmp_path / "work"), "r", SETTINGS)
    assert [r.member for r in read_rejects(spark, str(tmp_path / "work")).collect()] == ["img/1.jpg"]


@pytest.mark.parametrize("content, status", [("bad", "failed"), ("unpaired", "empty"), ("none", None)])
def test_rounds_without_a_usable_shard(spark, tmp_path, content, status):
    (tmp_path / "in").mkdir()
    if content == "bad":
        (tmp_path / "in" / "a.tar").write_bytes(b"no archive at all" * 100)
    if content == "unpaired":
        pack(tmp_path / "in" / "a.tar", [next(iter(members([1])))])
    rows = prepare_tar(spark, str(tmp_path / "in"), str(tmp_path / "work"), "r", SETTINGS)
    assert rows.count() == 0
    log = ledger.read_log(spark, str(tmp_path / "work/log")).filter("status <> 'started'").collect()
    assert [r.status for r in log] == ([status] if status else [])


def test_a_missing_decoder_stops_the_run(spark, tmp_path):
    def no_decoder(data):
        raise ImportError("no decoder here")

    (tmp_path / "in").mkdir()
    pack(tmp_path / "in" / "a.tar", members(range(6)))
    folder, work = str(tmp_path / "in"), str(tmp_path / "work")
    with pytest.raises(Exception, match="no decoder here"):
        prepare_tar(spark, folder, work, "r", ImageSettings(block_mean_encoder(8), GRID, no_decoder, 32))
    assert ledger.read_log(spark, f"{work}/log").filter("status = 'finished'").count() == 0
    assert prepare_tar(spark, folder, work, "s", SETTINGS).count() == 6


def frame(n):
    import pandas as pd

    plan = dict.fromkeys(pixels.PLAN_COLUMNS, 16) | {"crop_x": 0, "crop_y": 0}
    return pd.DataFrame([{"payload": i} | plan for i in range(n)])


def test_an_encoder_error_costs_only_its_image():
    def encode(batch):
        if (batch[:, 0, 0, 0] > 0.9).any():
            raise ValueError("too bright")
        return batch.mean((2, 3))

    decode = lambda i: np.full((16, 16, 3), 255 if i == 5 else i, np.uint8)
    latents, problems = pixels.encode_batch(decode, encode, frame(9), "payload", "cubic")
    assert [i for i, p in enumerate(problems) if p] == [5] and sum(x is None for x in latents) == 1


def test_an_encoder_that_never_works_fails_the_task():
    def encode(batch):
        raise ValueError("no device")

    with pytest.raises(pixels.SetupFault, match="no device"):
        pixels.encode_batch(lambda i: np.zeros((16, 16, 3), np.uint8), encode, frame(3), "payload", "cubic")


def test_table_rejects_are_kept(spark, tmp_path):
    rows = [(str(i), bytearray(png_bytes(draw(i, *sizes(i), 3))[: 40 if i == 2 else None])) for i in range(6)]
    images = spark.createDataFrame(rows, "image_id string, image binary")
    captions = spark.createDataFrame([(str(i), "c") for i in range(6)], "image_id string, caption string")
    good = prepare_table(images, captions, SETTINGS, work=str(tmp_path / "t"))
    assert good.count() == 5
    assert [r.image_id for r in read_table_rejects(spark, str(tmp_path / "t")).collect()] == ["2"]


def test_images_without_a_caption_are_never_encoded(spark, tmp_path):
    folder = tmp_path / "seen"
    folder.mkdir()

    def counting():
        encode = block_mean_encoder(8)()

        def run(batch):
            with open(folder / "calls", "a") as out:
                out.write("x" * len(batch))
            return encode(batch)

        return run

    rows = [(str(i), bytearray(png_bytes(draw(i, *sizes(i), 3)))) for i in range(8)]
    images = spark.createDataFrame(rows, "image_id string, image binary")
    captions = spark.createDataFrame([("1", "a"), ("4", "b")], "image_id string, caption string")
    settings = ImageSettings(counting, GRID, open_png, 32)
    assert prepare_table(images, captions, settings, on_missing="drop").count() == 2
    assert (folder / "calls").read_text() == "xx"


def test_a_key_with_several_captions_stops_the_job(spark):
    images = spark.createDataFrame([("a",), ("b",)], "image_id string")
    same = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", None)], "image_id string, caption string")
    assert required_captions(images, same).count() == 2
    other = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "image_id string, caption string")
    with pytest.raises(Exception, match="several captions for key a"):
        required_captions(images, other).collect()


def catalogue(spark, tmp_path, contents):
    rows = [(str(i), bytearray(c), f"cap {i}") for i, c in enumerate(contents)]
    spark.createDataFrame(rows, "key string, jpg binary, caption string").coalesce(1).write.parquet(str(tmp_path / "cat/0"))
    return str(tmp_path / "cat"), str(tmp_path / "work")


def test_an_unreadable_first_row_does_not_lose_its_file(spark, tmp_path):
    contents = [b"no image", *[png_bytes(draw(i, *sizes(i), 3)) for i in range(1, 8)]]
    root, work = catalogue(spark, tmp_path, contents)
    rows = prepare_catalog(spark, root, work, "r", SETTINGS, bucket_per_file=True).collect()
    assert len(rows) == 7 and len({r.resolution for r in rows}) == 1
    assert [r.image_id for r in read_rejects(spark, work).collect()] == ["0"]


@pytest.mark.parametrize("sees", ["original", "resized"])
def test_the_captioner_gets_the_pixels(spark, tmp_path, sees):
    def make():
        return lambda given: ["x".join(map(str, i.shape[:2])) for i in given["image"]]

    root, work = catalogue(spark, tmp_path, [png_bytes(draw(i, *sizes(i), 3)) for i in range(5)])
    rows = prepare_catalog(spark, root, work, "r", SETTINGS, make_captioner=make, captioner_sees=sees).collect()
    for r in rows:
        w, h = sizes(int(r.image_id))
        assert r.caption == (f"{h}x{w}" if sees == "original" else r.resolution)


def test_one_model_for_all_rounds_of_a_job(spark, tmp_path):
    folder = tmp_path / "loads"
    folder.mkdir()

    def counting():
        import os

        with open(folder / str(os.getpid()), "a") as out:
            out.write("x")
        return block_mean_encoder(8)()

    for part in range(4):
        rows = [(f"{part}-{i}", bytearray(png_bytes(draw(i, *sizes(i), 3))), "c") for i in range(3)]
        spark.createDataFrame(rows, "key string, jpg binary, caption string").coalesce(1).write.parquet(str(tmp_path / f"cat/{part}"))
    settings = ImageSettings(counting, GRID, open_png, 32)
    assert prepare_catalog(spark, str(tmp_path / "cat"), str(tmp_path / "work"), "r", settings, max_files=1).count() == 12
    assert all(f.read_text() == "x" for f in folder.iterdir()), "once per worker process"


def test_formats_the_header_parser_does_not_know_are_sized_by_the_decoder(spark):
    rows = spark.createDataFrame([(bytearray(b"odd format 12x34"),), (bytearray(b"nonsense bytes"),)], "content binary")

    def decode(data):
        w, h = map(int, data.decode().rsplit(" ", 1)[1].split("x"))
        return np.zeros((h, w, 3), np.uint8)

    assert [(r.width, r.height) for r in add_dimensions(rows, "content", decode).collect()] == [(12, 34), (None, None)]


def test_short_polls_are_merged(spark):
    polls = [("a", 0.0, 5), ("a", 0.2, 3), ("a", 0.4, 2), ("a", 0.6, 1), ("a", 1.6, 4), ("a", 1.7, 9), ("b", 0.0, 1), ("b", 9.0, 7)]
    merged = intervals.merge_polls(spark.createDataFrame(polls, "run string, at double, images long"), ["run"], "at", "images").collect()
    assert sorted((r.run, r.images, round(r.seconds, 6)) for r in merged) == [("a", 4, 1.0), ("a", 6, 0.6), ("b", 7, 9.0)]
    blank = spark.createDataFrame([("a", 1, 3, 0.0)], "run string, n long, images long, seconds double")
    assert metrics.smoothed_rate(blank, ["run"], ["n"], "images", "seconds", F.lit(0)).count() == 0
    assert metrics.blended_rate(blank, ["run"], ["n"], "images", "seconds", 1.0, F.lit(0)).first()["blended_rate"] == 1.5


def test_no_local_scratch_folder_on_a_cluster(spark):
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session(), "x")
