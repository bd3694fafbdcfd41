"""Image dimensions from the leading bytes of a file, without decoding pixels."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shapeloom.session import bound_batches

# Most headers sit in the first 64 KiB; when one does not, the whole value is read.
HEADER_BYTES = 1 << 16

# JPEG start-of-frame markers, markers without a length, and the
# channel modes by JPEG component count and PNG colour type.
JPEG_FRAME_MARKERS = {0xC0, 0xC1, 0xC2, 0xC3, 0xC5, 0xC6, 0xC7, 0xC9, 0xCA, 0xCB, 0xCD, 0xCE, 0xCF}
JPEG_BARE_MARKERS = {0x01, *range(0xD0, 0xD9)}
JPEG_MODES = {1: "L", 3: "RGB", 4: "CMYK"}
PNG_MODES = {0: "L", 2: "RGB", 3: "P", 4: "LA", 6: "RGBA"}

# TIFF byte orders, tags and the sizes of their whole-number types; WebP's alpha flag.
TIFF_ORDERS = {b"II": "<", b"MM": ">"}
TIFF_WIDTH, TIFF_HEIGHT, TIFF_PHOTOMETRIC, TIFF_SAMPLES = 256, 257, 262, 277
TIFF_TYPES = {1: "B", 3: "H", 4: "I", 16: "Q"}
TIFF_PALETTE, TIFF_CMYK = 3, 5
WEBP_ALPHA = 0x10

Header = tuple[int, int, str]
Fetch = Callable[[int, int], bytes]


class Truncated(Exception):
    """The bytes end before the header does.

    ``at`` is where the rest lies, if the format says so, and ``form`` how to read it there.
    """

    def __init__(self, message: str = "", at: int | None = None, form: str | None = None):
        super().__init__(message)
        self.at, self.form = at, form


def read_header(data: bytes, fetch: Fetch | None = None) -> Header:
    """(width, height, mode); raises ``Truncated`` or ``ValueError``.

    ``fetch`` (offset, size) reads on where the header lies behind ``data``.
    """
    try:
        return _read_start(data)
    except Truncated as short:
        if fetch is None or short.at is None:
            raise
        return read_directory(fetch(short.at, HEADER_BYTES), short.form)


def _read_start(data: bytes) -> Header:
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            width, height, _, kind = struct.unpack(">IIBB", data[16:26])
            return width, height, PNG_MODES.get(kind, "?")
        if data[:2] == b"\xff\xd8":
            return _jpeg(data)
        if data[:4] == b"GIF8":
            width, height = struct.unpack("<HH", data[6:10])
            return width, height, "P"
        if data[:2] == b"BM":
            width, height, _, bits = struct.unpack("<iiHH", data[18:30])
            return width, abs(height), "RGBA" if bits == 32 else "RGB" if bits > 8 else "P"
        if data[:4] == b"RIFF" and data[8:12] in (b"WEBP", b""):
            return _webp(data)
        if data[:2] in TIFF_ORDERS and data[2:4] in (b"*\0", b"\0*", b"+\0", b"\0+"):
            return _tiff(data)
    except (struct.error, IndexError) as short:
        raise Truncated(str(short)) from short
    if len(data) < 8:
        raise Truncated("fewer than 8 bytes")
    raise ValueError("not a known image format")


def _jpeg(data: bytes) -> Header:
    at = 2
    while True:
        if data[at] != 0xFF:
            raise ValueError("broken JPEG marker")
        while data[at] == 0xFF:
            at += 1
        marker = data[at]
        at += 1
        if marker in JPEG_FRAME_MARKERS:
            height, width, parts = struct.unpack(">HHB", data[at + 3 : at + 8])
            return width, height, JPEG_MODES.get(parts, "?")
        if marker in (0xD9, 0xDA):
            raise ValueError("JPEG without a frame header")
        if marker not in JPEG_BARE_MARKERS:
            at += struct.unpack(">H", data[at : at + 2])[0]


def _webp(data: bytes) -> Header:
    """The three kinds of first chunk: lossy, lossless, extended."""
    kind = data[12:16]
    if kind == b"VP8 ":
        mark, width, height = struct.unpack("<3sHH", data[23:30])
        if mark != b"\x9d\x01\x2a":
            raise ValueError("broken WebP frame")
        return width & 0x3FFF, height & 0x3FFF, "RGB"
    if kind == b"VP8L":
        mark, bits = struct.unpack("<BI", data[20:25])
        if mark != 0x2F:
            raise ValueError("broken WebP frame")
        return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF), "RGBA" if bits >> 28 & 1 else "RGB"
    if kind == b"VP8X":
        flags, *sizes = struct.unpack("<B3xHBHB", data[20:30])
        width, height = (1 + low + (high << 16) for low, high in (sizes[:2], sizes[2:]))
        return width, height, "RGBA" if flags & WEBP_ALPHA else "RGB"
    if len(kind) < 4:
        raise Truncated("no chunk")
    raise ValueError("not a known WebP chunk")


def _tiff(data: bytes) -> Header:
    """The first directory, which may lie anywhere in the file."""
    order = TIFF_ORDERS[data[:2]]
    large = struct.unpack(order + "H", data[2:4])[0] == 43
    (at,) = struct.unpack(order + ("Q" if large else "I"), data[8:16] if large else data[4:8])
    form = order + ("Q" if large else "I")
    try:
        return read_directory(data[at:], form)
    except Truncated as short:
        raise Truncated("the directory lies behind", at, form) from short


def read_directory(data: bytes, form: str) -> Header:
    """Size and mode from the bytes of a TIFF directory; ``form`` is the byte order and the kind of its offsets."""
    order, large = form[0], form[1] == "Q"
    entry, value_at = (20, 12) if large else (12, 8)
    try:
        (count,) = struct.unpack(order + ("Q" if large else "H"), data[: 8 if large else 2])
        first, found = (8 if large else 2), {}
        for i in range(count):
            own = data[first + i * entry : first + (i + 1) * entry]
            tag, kind = struct.unpack(order + "HH", own[:4])
            if kind in TIFF_TYPES:
                size = struct.calcsize(TIFF_TYPES[kind])
                (found[tag],) = struct.unpack(order + TIFF_TYPES[kind], own[value_at : value_at + size])
    except struct.error as short:
        raise Truncated(str(short)) from short
    if TIFF_WIDTH not in found or TIFF_HEIGHT not in found:
        raise ValueError("TIFF without a size")
    samples, meaning = found.get(TIFF_SAMPLES, 1), found.get(TIFF_PHOTOMETRIC)
    modes = {1: "P" if meaning == TIFF_PALETTE else "L", 2: "LA", 3: "RGB", 4: "CMYK" if meaning == TIFF_CMYK else "RGBA"}
    return found[TIFF_WIDTH], found[TIFF_HEIGHT], modes.get(samples, "?")


HEADER_TYPE = "width bigint, height bigint, mode string, at bigint"
TIFF_FORMS = ("<I", ">I", "<Q", ">Q")


def _decoded_size(content: bytes, decode: Callable[[bytes], np.ndarray] | None) -> tuple[int | None, int | None, str | None]:
    """Size of an image of a format that the header parser does not know, if ``decode`` can read it."""
    if decode is None:
        return None, None, None
    try:
        height, width = decode(content).shape[:2]
    except (ImportError, MemoryError):
        raise
    except Exception:  # no image for the decoder either: the row is rejected later
        return None, None, None
    return width, height, "RGB"


def _parse_all(contents: pd.Series, decode: Callable[[bytes], np.ndarray] | None = None, whole: bool = True, forms: pd.Series | None = None) -> pd.DataFrame:
    """Headers of all values; ``at`` says where the rest of one lies, ``forms`` that a value is such a rest."""
    rows = []
    for content, form in zip(contents, forms if forms is not None else [None] * len(contents)):
        nothing = (None, None, None, None)
        try:
            if content is None:
                rows.append(nothing)
            else:
                rows.append((*(read_directory(content, form) if form in TIFF_FORMS else read_header(content)), None))
        except Truncated as short:
            rows.append((None, None, short.form or "short", short.at))
        except ValueError:
            if decode is None:
                rows.append(nothing)
            elif whole or len(content) < HEADER_BYTES:
                rows.append((*_decoded_size(content, decode), None))
            else:
                rows.append((None, None, "short", None))
    frame = pd.DataFrame(rows, columns=["width", "height", "mode", "at"])
    return frame.astype({"width": "Int64", "height": "Int64", "at": "Int64"})


def add_dimensions(df: DataFrame, content: str = "content", decode: Callable[[bytes], np.ndarray] | None = None) -> DataFrame:
    """Add ``width, height, mode``; all null where the bytes are no readable image.

    ``decode`` (bytes to ``[h, w, ...]``) sizes formats that the header parser does not know.

    Only the first 64 KiB of each value crosses to Python. A header that reaches
    further is retried, in a second function that every other row passes through with
    a null: on the 64 KiB at the place that the start names, or on the whole value.
    """

    @F.pandas_udf(HEADER_TYPE)
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            yield _parse_all(series, decode, False)

    @F.pandas_udf(HEADER_TYPE)
    def parse_rest(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for series, forms in batches:
            yield _parse_all(series, decode, True, forms)

    bound_batches(df.sparkSession)
    # Filters on the result must not repeat the calls.
    parse, parse_rest = parse.asNondeterministic(), parse_rest.asNondeterministic()
    first = df.withColumn("header", parse(F.substring(F.col(content), 1, HEADER_BYTES)))
    unfinished = F.col("header.mode").isin("short", *TIFF_FORMS) & F.col("header.width").isNull() & (F.length(content) > HEADER_BYTES)
    there = F.substring(F.col(content), (F.col("header.at") + 1).cast("int"), F.lit(HEADER_BYTES))
    rest = F.when(unfinished, F.when(F.col("header.at").isNotNull(), there).otherwise(F.col(content)))
    retried = first.withColumn("header_long", parse_rest(rest, F.col("header.mode")))
    best = F.when(unfinished, F.col("header_long")).otherwise(F.col("header"))

    def field(name: str) -> Column:
        return F.when(best["width"].isNotNull(), best[name])

    return retried.withColumns({n: field(n) for n in ("width", "height", "mode")}).drop("header", "header_long")
