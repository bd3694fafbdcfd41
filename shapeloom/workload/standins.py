"""Image-like inputs derived from the shared tables, as Spark expressions and as SQL."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shapeloom.functions.buckets import GRID_1024, BucketGrid
from shapeloom.operators.batching import spread_rows
from shapeloom.session import bound_batches, table

# Image sizes of the lineitem rows (no unique key) and of the documents (unique id).
LINE_IMAGES_SQL = """line_images AS (
  SELECT l_orderkey, l_partkey, l_linenumber, l_returnflag,
         512 + (l_partkey * 7) % 3500 AS width, 512 + (l_orderkey * 13) % 3500 AS height
  FROM lineitem)"""

DOC_IMAGES_SQL = """doc_images AS (
  SELECT doc_id, source, lang, text,
         256 + (doc_id * 7919) % 6000 AS width, 256 + (doc_id * 104729) % 6000 AS height
  FROM documents)"""


def line_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_returnflag",
        (512 + (F.col("l_partkey") * 7) % 3500).alias("width"),
        (512 + (F.col("l_orderkey") * 13) % 3500).alias("height"),
    )


def doc_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        "source",
        "lang",
        "text",
        (256 + (F.col("doc_id") * 7919) % 6000).alias("width"),
        (256 + (F.col("doc_id") * 104729) % 6000).alias("height"),
    )


def bucket_sql(grid: BucketGrid = GRID_1024) -> str:
    """Brute force over all grid sizes: ``buckets(bucket, bw, bh)``."""
    return f"""axis AS (SELECT unnest(generate_series({grid.smallest}, {grid.largest}, {grid.step})) AS v),
fitting AS (SELECT a.v AS bw, b.v AS bh FROM axis a, axis b WHERE a.v * b.v <= {grid.area}),
sizes AS (SELECT bw, max(bh) AS bh FROM fitting GROUP BY bw UNION SELECT max(bw), bh FROM fitting GROUP BY bh),
buckets AS (SELECT row_number() OVER (ORDER BY bw * 4096 - bh) - 1 AS bucket, bw, bh FROM sizes)"""


def bucketed_sql(images: str, grid: BucketGrid = GRID_1024) -> str:
    """``bucketed``: ``images`` with bucket, bucket_w, bucket_h by log distance, first index on ties."""
    return f"""{bucket_sql(grid)},
nearest AS (
  SELECT width, height, bucket, bw, bh FROM (SELECT DISTINCT width, height FROM {images}), buckets
  QUALIFY row_number() OVER (PARTITION BY width, height
    ORDER BY abs(ln(bw / bh::DOUBLE) - ln(width / height::DOUBLE)), bucket) = 1),
bucketed AS (
  SELECT i.*, n.bucket, n.bw AS bucket_w, n.bh AS bucket_h, n.bh || 'x' || n.bw AS resolution
  FROM {images} i JOIN nearest n USING (width, height))"""


# ---- small real pictures, drawn inside Spark tasks -------------------------------

# width 24..64, height 24..60, channels 1, 3 or 4; value (id + 3x + 5y + 7c) mod 256.
PICTURES_SQL = """pictures AS (
  SELECT doc_id, lang, 24 + doc_id % 41 AS width, 24 + (doc_id * 7) % 37 AS height,
         [1, 3, 4][1 + doc_id % 3] AS channels FROM documents)"""


def picture_size(doc_id: Column) -> tuple[Column, Column, Column]:
    channels = F.get(F.array(F.lit(1), F.lit(3), F.lit(4)), (doc_id % 3).cast("int"))
    return 24 + doc_id % 41, 24 + (doc_id * 7) % 37, channels


def draw(doc_id: int, width: int, height: int, channels: int) -> np.ndarray:
    y, x, c = np.ogrid[:height, :width, :channels]
    return (doc_id + 3 * x + 5 * y + 7 * c).astype(np.uint8)  # the lowest byte is the rest by 256


def png_bytes(pixels: np.ndarray) -> bytes:
    height, width, channels = pixels.shape

    def chunk(tag: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body))

    colour = {1: 0, 3: 2, 4: 6}[channels]
    lines = np.concatenate([np.zeros((height, 1), np.uint8), pixels.reshape(height, -1)], axis=1)
    head = struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 1)) + chunk(b"IEND", b"")


def open_png(content: bytes) -> np.ndarray:
    """Reads back what ``png_bytes`` writes (8 bits, unfiltered lines), as RGB."""
    width, height, _, colour = struct.unpack(">IIBB", content[16:26])
    channels = {0: 1, 2: 3, 6: 4}[colour]
    at, body = 8, b""
    while at < len(content):
        size = struct.unpack(">I", content[at : at + 4])[0]
        if content[at + 4 : at + 8] == b"IDAT":
            body += content[at + 8 : at + 8 + size]
        at += size + 12
    lines = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, 1 + width * channels)
    pixels = lines[:, 1:].reshape(height, width, channels)
    return np.repeat(pixels, 3, axis=2) if channels == 1 else pixels[:, :, :3]


PAINTED_ROWS = 512


def _painter(paint_one: Callable[[int, int, int, int], bytes]) -> Callable[..., Column]:
    """``paint_one`` on every row; the pictures of few rows are held at a time."""

    @F.pandas_udf(T.BinaryType())
    def paint(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for plans in batches:
            for begin in range(0, len(plans[0]), PAINTED_ROWS):
                rows = zip(*(p.iloc[begin : begin + PAINTED_ROWS] for p in plans))
                yield pd.Series([paint_one(*map(int, p)) for p in rows], dtype=object)

    return paint


def pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, lang, key, jpg, text)``: one encoded picture per document."""
    docs = spread_rows(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), ["doc_id"])
    width, height, channels = picture_size(F.col("doc_id"))
    bound_batches(spark)
    paint = _painter(lambda *plan: png_bytes(draw(*plan)))
    return docs.select(
        "doc_id", "lang", F.col("doc_id").cast("string").alias("key"), paint("doc_id", width, height, channels).alias("jpg"), "text"
    )


def raw_pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded pictures in the layout of Spark's image source: interleaved, colour order BGR(A)."""
    docs = spread_rows(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), ["doc_id"])
    width, height, channels = picture_size(F.col("doc_id"))

    def data(doc_id: int, w: int, h: int, c: int) -> bytes:
        pixels = draw(doc_id, w, h, c)
        order = [2, 1, 0, 3][:c] if c > 1 else [0]
        return np.ascontiguousarray(pixels[:, :, order]).tobytes()

    bound_batches(spark)
    paint = _painter(data)
    return docs.select(
        "doc_id",
        width.cast("int").alias("width"),
        height.cast("int").alias("height"),
        channels.alias("nChannels"),
        paint("doc_id", width, height, channels).alias("data"),
    )
