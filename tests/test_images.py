import io
import struct
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from shapeloom.functions import image_header as ih
from shapeloom.operators import pixels
from shapeloom.sources import catalog, tar
from shapeloom.workload.standins import draw, open_png, png_bytes

# ---- headers -------------------------------------------------------------------------


def jvm_image(spark, width, height, kind, grey=False):
    """An image encoded by the JVM's own writers."""
    jvm = spark._jvm
    form = 10 if grey else 1
    picture = jvm.java.awt.image.BufferedImage(width, height, form)
    out = jvm.java.io.ByteArrayOutputStream()
    assert jvm.javax.imageio.ImageIO.write(picture, kind, out)
    return bytes(out.toByteArray())


def webp(kind, body):
    chunk = kind + struct.pack("<I", len(body)) + body
    return b"RIFF" + struct.pack("<I", 4 + len(chunk)) + b"WEBP" + chunk


def tiff(width, height, samples=3, meaning=2, order="<", large=False, gap=0):
    """A directory ``gap`` bytes behind the start."""
    tags = [(254, 4, 0), (256, 4, width), (257, 3, height), (258, 3, 8), (262, 3, meaning), (277, 3, samples), (305, 2, 0)]
    sizes = {2: "B", 3: "H", 4: "I"}
    pad = 8 if large else 4
    values = [struct.pack(order + sizes[k], v).ljust(pad, b"\0") for _, k, v in tags]
    entries = b"".join(struct.pack(order + ("HHQ" if large else "HHI"), t, k, 1) + v for (t, k, _), v in zip(tags, values))
    head = (b"II" if order == "<" else b"MM") + struct.pack(order + "H", 43 if large else 42)
    if large:
        return head + struct.pack(order + "HHQ", 8, 0, 16 + gap) + b"\x07" * gap + struct.pack(order + "Q", len(tags)) + entries + b"\0" * 8
    return head + struct.pack(order + "I", 8 + gap) + b"\x07" * gap + struct.pack(order + "H", len(tags)) + entries + b"\0" * 4


LATE = 3 * ih.HEADER_BYTES
HEADERS = {
    "webp": (webp(b"VP8 ", b"\x30\x01\x00\x9d\x01\x2a" + struct.pack("<HH", 640 | 1 << 14, 480)), (640, 480, "RGB")),
    "lossless webp": (webp(b"VP8L", b"\x2f" + struct.pack("<I", 299 | 199 << 14)), (300, 200, "RGB")),
    "lossless webp with alpha": (webp(b"VP8L", b"\x2f" + struct.pack("<I", 16382 | 0 << 14 | 1 << 28)), (16383, 1, "RGBA")),
    "extended webp": (webp(b"VP8X", struct.pack("<BxxxHBHB", 0x10, 4999, 1, 2999, 0)), (70536, 3000, "RGBA")),
    "extended webp without alpha": (webp(b"VP8X", struct.pack("<BxxxHBHB", 0, 9, 0, 8, 0)), (10, 9, "RGB")),
    "cut webp": (webp(b"VP8 ", b"")[:18], None),
    "broken webp": (webp(b"VP8 ", b"x" * 20), None),
    "tiff": (tiff(321, 123), (321, 123, "RGB")),
    "grey tiff, other order": (tiff(70000, 9, 1, 1, ">"), (70000, 9, "L")),
    "tiff with a late directory": (tiff(50, 60, 4, 2, "<", gap=LATE), (50, 60, "RGBA")),
    "large tiff": (tiff(50, 61, 4, 5, ">", True), (50, 61, "CMYK")),
    "large tiff with a late directory": (tiff(50, 62, 1, 3, "<", True, LATE), (50, 62, "P")),
    "directory across the border": (tiff(50, 63, gap=ih.HEADER_BYTES - 30), (50, 63, "RGB")),
    "cut tiff": (tiff(50, 60, gap=LATE)[:-40], None),
    "tiff without a directory": (b"II*\0\xff\xff\xff\x7f" + b"x" * 100, None),
}


def test_webp_and_tiff_are_sized_without_decoding(spark):
    df = spark.createDataFrame([(k, v[0]) for k, v in HEADERS.items()], "name string, content binary")

    def decode(data):
        raise RuntimeError("decoded")

    got = {r.name: (r.width, r.height, r.mode) for r in ih.add_dimensions(df, decode=decode).collect()}
    assert got == {name: expected or (None, None, None) for name, (_, expected) in HEADERS.items()}


def test_a_late_directory_is_fetched_alone():
    fetched = []

    def fetch(at, size):
        fetched.append((at, size))
        return HEADERS["tiff with a late directory"][0][at : at + size]

    data = HEADERS["tiff with a late directory"][0]
    assert ih.read_header(data[: ih.HEADER_BYTES], fetch) == (50, 60, "RGBA") and fetched == [(LATE + 8, ih.HEADER_BYTES)]
    with pytest.raises(ih.Truncated):
        ih.read_header(data[: ih.HEADER_BYTES])


@pytest.fixture(scope="module")
def samples(spark):
    jpeg = jvm_image(spark, 321, 123, "jpg")
    padding = b"\xff\xe1\xff\xff" + b"\0" * 65533
    return {
        "jpg": (jpeg, (321, 123, "RGB")),
        "grey jpg": (jvm_image(spark, 32, 17, "jpg", grey=True), (32, 17, "L")),
        "late jpg": (jpeg[:2] + padding * 3 + jpeg[2:], (321, 123, "RGB")),
        "png": (jvm_image(spark, 77, 99, "png"), (77, 99, "RGB")),
        "gif": (jvm_image(spark, 30, 20, "gif"), (30, 20, "P")),
        "bmp": (jvm_image(spark, 31, 21, "bmp"), (31, 21, "RGB")),
        "tiff": (jvm_image(spark, 41, 29, "tiff"), (41, 29, "RGB")),
        "cut jpg": (jpeg[:20], None),
        "text": (b"not an image at all", None),
        "empty": (b"", None),
        "null": (None, None),
    }


def test_dimensions_of_a_column(spark, samples):
    df = spark.createDataFrame([(k, v[0]) for k, v in samples.items()], "name string, content binary")
    got = {r.name: (r.width, r.height, r.mode) for r in ih.add_dimensions(df).collect()}
    for name, (_, expected) in samples.items():
        assert got[name] == (expected or (None, None, None)), name


def test_dimensions_are_computed_once(spark, samples, plan):
    df = spark.createDataFrame([(samples["jpg"][0],)], "content binary")
    filtered = ih.add_dimensions(df).filter("width > 10 and height > 10").select("width", "height", "mode")
    assert plan(filtered).count("ArrowEvalPython") <= 2


# ---- pixels --------------------------------------------------------------------------


def slow_resize(image, new_h, new_w, kernel):
    """Per-pixel reference: weights straight from the kernel definitions."""

    def cubic(x, a):
        x = abs(x)
        if x < 1:
            return (a + 2) * x**3 - (a + 3) * x**2 + 1
        return a * x**3 - 5 * a * x**2 + 8 * a * x - 4 * a if x < 2 else 0.0

    def lanczos(x):
        return float(np.sinc(x) * np.sinc(x / 3)) if abs(x) < 3 else 0.0

    def line(values, size):
        n = len(values)
        scale = n / size
        stretch = max(scale, 1.0) if kernel != "interpolate" else 1.0
        out = []
        for i in range(size):
            centre = (i + 0.5) * scale - 0.5
            total, weight = 0.0, 0.0
            for j in range(int(centre - 3 * stretch) - 2, int(centre + 3 * stretch) + 3):
                x = (j - centre) / stretch
                k = lanczos(x) if kernel == "lanczos" else cubic(x, -0.5 if kernel == "cubic" else -0.75)
                if kernel != "interpolate" and not 0 <= j < n:
                    continue
                total = total + k * values[min(max(j, 0), n - 1)]
                weight += k
            out.append(total / weight)
        out = np.array(out)
        return out if kernel == "interpolate" else np.clip(np.floor(out + 0.5), 0, 255)

    wide = np.stack([line(row, new_w) for row in image.astype(np.float64)])
    return np.stack([line(wide[:, x], new_h) for x in range(new_w)], axis=1)


@pytest.mark.parametrize("kernel", ["cubic", "interpolate", "lanczos"])
@pytest.mark.parametrize(("source", "target"), [((20, 31), (9, 14)), ((9, 8), (17, 21)), ((12, 12), (12, 12))])
def test_resize_matches_per_pixel_arithmetic(kernel, source, target):
    image = np.random.default_rng(1).integers(0, 256, (*source, 3), dtype=np.uint8)
    new_h, new_w = target
    x, y, w, h = 2, 1, new_w - 3, new_h - 2
    plan = {"resize_w": new_w, "resize_h": new_h, "crop_x": x, "crop_y": y, "bucket_w": w, "bucket_h": h}
    expected = slow_resize(image, new_h, new_w, kernel)[y : y + h, x : x + w]
    tolerance = 1e-2 if kernel == "interpolate" else 1.0
    got = pixels.resize_crop(image, plan, kernel)
    assert np.abs(got - expected).max() <= tolerance
    assert np.mean(np.abs(got - expected) > 1e-2) < 0.01, "8-bit rounding may differ on rare ties only"
    if source == target:
        np.testing.assert_allclose(got, image[y : y + h, x : x + w], atol=1e-3)


def test_spark_image_source_to_normalised_pixels(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"{i}.png").write_bytes(png_bytes(draw(i, 24 + i, 20, [1, 3, 4][i % 3])))
    (tmp_path / "bad.png").write_bytes(b"\x89PNG\r\n\x1a\nbroken")
    images = catalog.scan_images(spark, str(tmp_path))
    assert images.count() == 6
    rgb = pixels.to_rgb(images, ["origin"])
    for row in rgb.collect():
        i = int(row.origin.rsplit("/", 1)[-1][0])
        expected = open_png((tmp_path / f"{i}.png").read_bytes())
        if i % 3 != 2:  # the JVM decoder may premultiply alpha
            np.testing.assert_array_equal(np.frombuffer(row.data, np.uint8).reshape(row.height, row.width, 3), expected)
    one = {"load_w": "width", "load_h": "height", "resize_w": "width", "resize_h": "height"}
    planned = rgb.withColumns({k: F.col(v) for k, v in one.items()} | {k: F.lit(v) for k, v in {"crop_x": 1, "crop_y": 2, "bucket_w": 16, "bucket_h": 8}.items()})
    row = pixels.resize_pixels(planned, ["origin"]).filter("origin like '%1.png'").first()
    assert list(row.pixel_shape) == [3, 8, 16]
    expected = open_png((tmp_path / "1.png").read_bytes())[2:10, 1:17].transpose(2, 0, 1) / 255.0 * 2 - 1
    np.testing.assert_allclose(np.array(row.pixels).reshape(3, 8, 16), expected, atol=1e-5)


# ---- tar shards ------------------------------------------------------------------------


def write_tar(path, members):
    with tarfile.open(path, "w") as archive:
        for name, payload in members:
            info = tarfile.TarInfo(name)
            info.size = len(payload)
            archive.addfile(info, io.BytesIO(payload))


@pytest.fixture
def shards(tmp_path):
    picture = png_bytes(draw(5, 40, 30, 3))
    (tmp_path / "sub").mkdir()
    write_tar(tmp_path / "a.tar", [("d/1.jpg", picture), ("d/1.json", b'{"key": "1"}'), ("x/2.jpg", b"bad"), ("notes.txt", b"hi")])
    write_tar(tmp_path / "sub" / "b.tar", [(f"{'long' * 40}/{i}.jpg", bytes([i]) * (100 + i)) for i in range(50)])
    write_tar(tmp_path / "empty.tar", [])
    whole = tmp_path / "whole.tar"
    write_tar(whole, [("1.jpg", b"x" * 5000), ("2.jpg", b"y" * 5000)])
    (tmp_path / "cut.tar").write_bytes(whole.read_bytes()[:9000])
    whole.rename(tmp_path / "c.tar")
    return tmp_path


def test_members_are_listed_without_payloads(spark, shards):
    rows = tar.scan_tar(spark, str(shards)).collect()
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r)
    assert set(by_shard) == {"a.tar", "sub/b.tar", "c.tar", "cut.tar"}
    first = {r.member: r for r in by_shard["a.tar"]}
    assert (first["d/1.jpg"].width, first["d/1.jpg"].height, first["d/1.jpg"].mode) == (40, 30, "RGB")
    assert first["d/1.json"].content == '{"key": "1"}' and first["d/1.jpg"].content is None
    assert first["x/2.jpg"].width is None and first["x/2.jpg"].error is None
    assert len(by_shard["sub/b.tar"]) == 50
    assert any(r.error for r in by_shard["cut.tar"])
    assert not any(r.error for s in ("a.tar", "sub/b.tar", "c.tar") for r in by_shard[s])


def test_one_partition_per_shard(spark, shards):
    assert tar.scan_tar(spark, str(shards)).rdd.getNumPartitions() == 5
    assert tar.scan_tar(spark, str(shards), ["a.tar"]).rdd.getNumPartitions() == 1


def test_payloads_come_back_by_range(spark, shards):
    members = tar.scan_tar(spark, str(shards), ["sub/b.tar"]).select("shard", "member", "offset", "size")
    fetched = tar.fetch_members(members, str(shards), tasks=4)
    rows = fetched.withColumn("task", F.spark_partition_id()).collect()
    assert len(rows) == 50 and len({r.task for r in rows}) > 1, "one shard is read by several tasks"
    for r in rows:
        i = int(r.member.rsplit("/", 1)[-1].split(".")[0])
        assert bytes(r["bytes"]) == bytes([i]) * (100 + i)


def test_shards_are_listed_by_relative_path(spark, shards):
    listed = sorted(r.shard for r in tar.list_shards(spark, str(shards)).collect())
    assert listed == ["a.tar", "c.tar", "cut.tar", "empty.tar", "sub/b.tar"]


def _shrink(width: int, target: int) -> np.ndarray:
    plan = {"resize_w": target, "resize_h": 4, "crop_x": 0, "crop_y": 0, "bucket_w": target, "bucket_h": 4}
    return pixels.resize_crop(np.full((4, width, 3), 7, np.uint8), plan, "interpolate")


def test_weights_of_many_small_sizes_are_made_once(monkeypatch):
    made = []
    plain = pixels._cubic
    monkeypatch.setattr(pixels, "_cubic", lambda x, a: made.append(x.shape) or plain(x, a))
    for _ in range(2):
        for width in range(1000, 1400):
            assert (_shrink(width, 8) == 7).all()
    assert len(made) <= 401  # 400 widths and one height


def test_weights_of_large_sizes_are_not_all_kept():
    for width in range(20_000, 20_030):
        _shrink(width, 9000)
    assert sum(t.nbytes + w.nbytes for t, w in pixels._known_weights.values()) <= pixels.WEIGHTS_BYTES
