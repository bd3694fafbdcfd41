import io
import json
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from shapeloom.functions.buckets import BucketGrid
from shapeloom.functions.tensors import unpack_float16, unpack_fp8
from shapeloom.operators import ledger, pixels
from shapeloom.operators.encoders import block_mean_encoder, sampling_encoder, template_captioner
from shapeloom.plans.jobs import ImageSettings, prepare_catalog, prepare_table, prepare_tar, read_rejects
from shapeloom.workload.standins import draw, open_png, png_bytes

GRID = BucketGrid(32, 8, 16, 64)
SETTINGS = ImageSettings(block_mean_encoder(8), GRID, open_png, min_side=32, crop="center", batch_size=4)


def expected_latent(i, width, height, channels=3, kernel="cubic"):
    """The whole path for one image, step by step."""
    image = open_png(png_bytes(draw(i, width, height, channels)))
    sizes = GRID.sizes()
    best = int(np.abs(np.log([w / h for w, h in sizes]) - np.log(width / height)).argmin())
    tw, th = sizes[best]
    ar, tar_ = width / height, tw / th
    if abs(ar - tar_) < 1e-6:
        rw, rh = tw, th
    elif ar > tar_:
        rw, rh = int(ar * th), th
    else:
        rw, rh = tw, int(tw / ar)
    plan = {"resize_w": rw, "resize_h": rh, "crop_x": max(rw - tw, 0) // 2, "crop_y": max(rh - th, 0) // 2, "bucket_w": tw, "bucket_h": th}
    tensor = pixels.normalized_chw(pixels.resize_crop(image, plan, kernel))
    return f"{th}x{tw}", block_mean_encoder(8)()(tensor[None])[0]


def sizes(i):
    return 32 + (i * 7) % 40, 33 + (i * 11) % 30


@pytest.fixture
def catalogue(spark, tmp_path):
    """Two folders with the same base name; one image is damaged, one too small."""
    for top in (0, 1):
        rows = []
        for n in range(20):
            i = top * 100 + n
            content = png_bytes(draw(i, *sizes(i), 3))
            if i == 3:
                content = content[:40]
            if i == 4:
                content = png_bytes(draw(i, 20, 20, 3))
            if i == 5:
                content = b"no image"
            rows.append((str(i), bytearray(content), f"cap {i}"))
        df = spark.createDataFrame(rows, "key string, jpg binary, caption string").coalesce(1)
        df.write.parquet(str(tmp_path / f"write{top}"))
        part = next((tmp_path / f"write{top}").glob("*.parquet"))
        target = tmp_path / "cat" / str(top) / "least_dim_range=0-64" / "aspect_ratio_bucket=1-1"
        target.mkdir(parents=True)
        (target / "00001.parquet").write_bytes(part.read_bytes())
    return tmp_path


def test_catalogue_job(spark, catalogue):
    root, work = str(catalogue / "cat"), str(catalogue / "work")
    rows = prepare_catalog(spark, root, work, "r", SETTINGS, ["0", "1"], max_files=1)
    got = {r.image_id: r for r in rows.collect()}
    assert set(got) == {str(t * 100 + n) for t in (0, 1) for n in range(20)} - {"3", "4", "5"}
    for image_id, row in got.items():
        resolution, latent = expected_latent(int(image_id), *sizes(int(image_id)))
        assert row.resolution == resolution and row.caption == f"cap {image_id}"
        assert list(row.latent_shape) == list(latent.shape)
        np.testing.assert_allclose(np.array(row.latent), latent.ravel(), atol=1e-4)
    log = ledger.read_log(spark, f"{work}/log").filter("status = 'finished'").collect()
    assert len(log) == 2 and len({r.run for r in log}) == 2, "one round per file"
    rejects = {r.image_id: r.error for r in read_rejects(spark, work).collect()}
    assert set(rejects) == {"3", "5"} and rejects["5"] == "unreadable image header"
    counts = spark.read.parquet(f"{work}/metrics").agg(*[F.sum(c).alias(c) for c in ("inputs", "images", "too_small", "encoded", "rejected")])
    assert tuple(counts.first()) == (2, 40, 1, 37, 2), "every image is kept, skipped or rejected"

    again = prepare_catalog(spark, root, work, "s", SETTINGS, ["0", "1"])
    assert again.count() == len(got), "nothing is pending, nothing is added"


def lose_driver_before_commit(monkeypatch):
    real = ledger.append_log

    def append(entries, location):
        if entries.first()["status"] == ledger.STARTED:
            return real(entries, location)
        raise RuntimeError("lost driver")

    monkeypatch.setattr(ledger, "append_log", append)


def test_run_that_died_before_its_log_entry_is_repeated(spark, catalogue, monkeypatch):
    root, work = str(catalogue / "cat"), str(catalogue / "work")
    with monkeypatch.context() as patch:
        lose_driver_before_commit(patch)
        with pytest.raises(RuntimeError, match="lost driver"):
            prepare_catalog(spark, root, work, "r", SETTINGS)
    for run in ("r", "t"):
        rows = prepare_catalog(spark, root, work, run, SETTINGS)
        assert rows.count() == rows.select("image_id").distinct().count() == 37


def test_an_input_that_always_breaks_its_round_is_isolated(spark, catalogue, monkeypatch):
    root, work = str(catalogue / "cat"), str(catalogue / "work")
    with monkeypatch.context() as patch:
        lose_driver_before_commit(patch)
        for _ in range(3):  # both together, then each alone
            with pytest.raises(RuntimeError):
                prepare_catalog(spark, root, work, "r", SETTINGS)
    log = ledger.read_log(spark, f"{work}/log")
    assert log.groupBy("run").count().agg({"count": "max"}).first()[0] == 2
    assert ledger.quarantine_isolated(log).count() == 2
    assert ledger.pending_inputs(log.select("path").distinct(), ledger.quarantine_isolated(log)).count() == 0


def test_same_run_name_adds_later_inputs(spark, catalogue):
    root, work = catalogue / "cat", str(catalogue / "work")
    assert prepare_catalog(spark, str(root), work, "daily", SETTINGS, ["0"]).count() == 17
    assert prepare_catalog(spark, str(root), work, "daily", SETTINGS).count() == 37


def test_catalogue_options(spark, catalogue):
    second = spark.createDataFrame([(str(i), f"second {i}") for i in range(200)], "image_id string, caption string")
    rows = prepare_catalog(
        spark, str(catalogue / "cat"), str(catalogue / "w"), "r", SETTINGS, ["1"],
        make_captioner=template_captioner("width", "height", "caption"), second_captions=second, bucket_per_file=True,
    ).collect()
    assert len(rows) == 20
    first = expected_latent(100, *sizes(100))[0]
    assert {r.resolution for r in rows} == {first}
    for r in rows:
        w, h = sizes(int(r.image_id))
        assert list(r.caption) == [f"a {w}x{h} image of cap {r.image_id}", f"second {r.image_id}"]


def test_missing_second_caption_fails_the_job(spark, catalogue):
    second = spark.createDataFrame([("100", "only one")], "image_id string, caption string")
    with pytest.raises(Exception, match="no caption for key"):
        prepare_catalog(spark, str(catalogue / "cat"), str(catalogue / "w"), "r", SETTINGS, ["1"], second_captions=second)


def pack(path, members):
    with tarfile.open(path, "w") as archive:
        for name, payload in members:
            info = tarfile.TarInfo(name)
            info.size = len(payload)
            archive.addfile(info, io.BytesIO(payload))


@pytest.fixture
def shards(tmp_path):
    def image(i):
        return (f"img/{i}.jpg", png_bytes(draw(i, *sizes(i), 3)))

    def sidecar(i, **extra):
        return (f"img/{i}.json", json.dumps({"key": f"k{i}", "url": f"u{i}", "caption": f"cap {i}"} | extra).encode())

    folder = tmp_path / "tars"
    folder.mkdir()
    broken = ("img/2.json", b'{"key": ')
    keyless = sidecar(3, key="")
    bad_pixels = ("img/6.jpg", image(6)[1][:45])
    members = [image(0), sidecar(0), image(1), image(2), broken, image(3), keyless, sidecar(4), ("img/.5.json", b"{}"), bad_pixels, sidecar(6)]
    pack(folder / "good.tar", members)
    pack(folder / "more.tar", [m for i in range(10, 30) for m in (image(i), sidecar(i))])
    pack(folder / "empty.tar", [])
    pack(folder / "unpaired.tar", [image(50), sidecar(51)])
    (folder / "cut.tar").write_bytes((folder / "more.tar").read_bytes()[:7000])
    return tmp_path


def test_tar_job(spark, shards):
    settings = ImageSettings(block_mean_encoder(8), GRID, open_png, 32, "center", kernel="interpolate", batch_size=3, precision="float16")
    folder, work = str(shards / "tars"), str(shards / "work")
    rows = prepare_tar(spark, folder, work, "r", settings)
    got = {r.image_id: r for r in rows.withColumn("values", unpack_float16("latent")).collect()}
    assert set(got) == {"k0"} | {f"k{i}" for i in range(10, 30)}
    for image_id, row in got.items():
        i = int(image_id[1:])
        resolution, latent = expected_latent(i, *sizes(i), kernel="interpolate")
        assert row.shard == ("good.tar" if i == 0 else "more.tar")
        assert row.resolution == resolution and list(row.caption) == [f"cap {i}"]
        np.testing.assert_allclose(np.array(row["values"]), latent.ravel().astype(np.float16), atol=2e-3)
    status = {r.path: r.status for r in ledger.read_log(spark, f"{work}/log").filter("status <> 'started'").collect()}
    assert status == {"good.tar": "finished", "more.tar": "finished", "empty.tar": "empty", "unpaired.tar": "empty", "cut.tar": "failed"}
    rejects = {r.member: r.error for r in read_rejects(spark, work).collect()}
    assert {m: e for m, e in rejects.items() if m != "img/6.jpg"} == {
        "img/1.jpg": "image without a sidecar", "img/2.jpg": "malformed sidecar", "img/3.jpg": "sidecar without a key",
        "img/50.jpg": "image without a sidecar",
    }
    assert "img/6.jpg" in rejects
    counts = spark.read.parquet(f"{work}/metrics").first()
    assert (counts["images"], counts["encoded"], counts["rejected"], counts["too_small"]) == (26, 21, 5, 0)
    assert counts["image_without_a_sidecar"] == 2 and counts["malformed_sidecar"] == counts["sidecar_without_a_key"] == 1
    assert prepare_tar(spark, folder, work, "s", settings).count() == 21, "quarantined and finished shards are left alone"


def test_tar_job_with_captions_by_url(spark, shards):
    maps = [("u10", {"cap_internlm_short": "i", "cap_florence_short": None}), ("u11", {"cap_sharecap_short": "s"})]
    caps = spark.createDataFrame(maps, "url string, caps map<string,string>")
    rows = prepare_tar(spark, str(shards / "tars"), str(shards / "work"), "r", SETTINGS, url_captions=caps)
    got = {r.image_id: list(r.caption) for r in rows.collect()}
    assert len(got) == 21
    assert got["k10"] == ["i", None, ""] and got["k11"] == ["", "", "s"] and got["k12"] == ["", "", ""]


def test_table_job(spark):
    rows = [(str(i), bytearray(png_bytes(draw(i, *sizes(i), 4))), "x", "y") for i in range(15)]
    images = spark.createDataFrame(rows, "image_id string, image binary, caption_enriched string, issues string")
    captions = spark.createDataFrame([(str(i), f"c{i}") for i in range(15)], "image_id string, caption string")
    settings = ImageSettings(block_mean_encoder(8), GRID, open_png, 32, "center", kernel="interpolate", precision="fp8")
    out = prepare_table(images, captions, settings, drop=["caption_enriched", "issues"])
    assert sorted(out.columns) == ["caption", "image_id", "latent", "latent_shape"]
    got = out.withColumn("values", unpack_fp8("latent")).collect()
    assert len(got) == 15
    for row in got:
        latent = expected_latent(int(row.image_id), *sizes(int(row.image_id)), 4, "interpolate")[1].ravel()
        assert row.caption == f"c{row.image_id}"
        assert np.abs(np.array(row["values"]) - latent).max() <= np.abs(latent).max() / 8 + 1e-6
    with pytest.raises(Exception, match="no caption for key"):
        prepare_table(images, captions.filter(F.col("image_id") != "3"), settings).collect()


def test_sampled_latents_repeat_whatever_the_batches(spark):
    rows = [(str(i), bytearray(png_bytes(draw(i, *sizes(i), 3)))) for i in range(24)]
    captions = spark.createDataFrame([(str(i), "c") for i in range(24)], "image_id string, caption string")

    def latents(parts, batch, seed):
        images = spark.createDataFrame(rows, "image_id string, image binary").repartition(parts)
        settings = ImageSettings(sampling_encoder(8), GRID, open_png, crop="random", seed=seed, batch_size=batch, sampling=True)
        return {r.image_id: r.latent for r in prepare_table(images, captions, settings).collect()}

    assert latents(1, 5, 1) == latents(4, 3, 1)
    assert latents(1, 5, 1) != latents(1, 5, 2)
