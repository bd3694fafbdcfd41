"""Pixel work inside tasks: RGB conversion, cubic resize, crop, normalisation.

Planning (sizes, offsets) is column arithmetic in ``functions.geometry``; these
numpy helpers only carry a plan out on one image at a time.
"""

from __future__ import annotations

import io
import zlib
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shapeloom.session import BATCH_BYTES, bound_batches

# Cubic coefficients of the 8-bit and of the float resampler.
CUBIC_ANTIALIASED = -0.5
CUBIC_INTERPOLATED = -0.75


class SetupFault(RuntimeError):
    """Nothing can work here; no fault of the row at hand."""


SETUP_FAULTS = (SetupFault, ImportError, MemoryError)


def rgb_from_bytes(data: bytes, height: int, width: int, channels: int, order: str = "BGR") -> np.ndarray:
    """``[h, w, 3]`` uint8 RGB from interleaved bytes (Spark's image source is BGR/BGRA)."""
    raw = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    if channels == 1:
        return np.repeat(raw, 3, axis=2)
    if channels not in (3, 4):
        raise ValueError(f"unsupported channel count: {channels}")
    colour = raw[:, :, :3]
    return colour[:, :, ::-1] if order == "BGR" else colour


def decode_with_pillow(content: bytes) -> np.ndarray:
    """Decode encoded bytes with Pillow where it is installed."""
    try:
        from PIL import Image
    except ImportError as missing:
        raise SetupFault("decoding encoded bytes needs Pillow or your own decode function") from missing
    return np.asarray(Image.open(io.BytesIO(content)).convert("RGB"))


def _cubic(x: np.ndarray, a: float) -> np.ndarray:
    x = np.abs(x)
    near = ((a + 2) * x - (a + 3)) * x * x + 1
    far = ((x - 5) * x + 8) * x * a - 4 * a
    return np.where(x < 1, near, np.where(x < 2, far, 0.0))


def _lanczos(x: np.ndarray) -> np.ndarray:
    return np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)


#: Weights of resizes met before, the latest last, in every worker process.
WEIGHTS_BYTES = 4 << 20
_known_weights: OrderedDict[tuple[int, int, str], tuple[np.ndarray, np.ndarray]] = OrderedDict()
_held_weights = [0]


def _weights_of(source: int, target: int, kernel: str) -> tuple[np.ndarray, np.ndarray]:
    """``resample_weights``, kept for later images: as many as ``WEIGHTS_BYTES`` hold, so many of small images and few of large ones."""
    key = (source, target, kernel)
    found = _known_weights.get(key)
    if found is None:
        found = _known_weights[key] = resample_weights(*key)
        _held_weights[0] += found[0].nbytes + found[1].nbytes
        while _held_weights[0] > WEIGHTS_BYTES and len(_known_weights) > 1:
            taps, weights = _known_weights.popitem(last=False)[1]
            _held_weights[0] -= taps.nbytes + weights.nbytes
    else:
        _known_weights.move_to_end(key)
    return found


def resample_weights(source: int, target: int, kernel: str) -> tuple[np.ndarray, np.ndarray]:
    """(tap indices, tap weights), each ``[target, taps]``, of a 1-D resize.

    Pixel centres align at half-integers. 'cubic' and 'lanczos' widen the kernel
    when shrinking and drop taps beyond the edge; 'interpolate' is a fixed-width
    cubic that repeats edge pixels.
    """
    scale = source / target
    widen = kernel != "interpolate"
    stretch = max(scale, 1.0) if widen else 1.0
    centre = (np.arange(target) + 0.5) * scale - 0.5
    reach = int(np.ceil((3 if kernel == "lanczos" else 2) * stretch)) + 1
    taps = np.floor(centre).astype(int)[:, None] + np.arange(-reach, reach + 1)[None, :]
    distance = (taps - centre[:, None]) / stretch
    if kernel == "lanczos":
        weights = _lanczos(distance)
    else:
        weights = _cubic(distance, CUBIC_ANTIALIASED if widen else CUBIC_INTERPOLATED)
    if widen:
        weights = np.where((taps >= 0) & (taps < source), weights, 0.0)
    used = np.flatnonzero((weights != 0).any(axis=0))
    taps, weights = taps[:, used], weights[:, used]
    return np.clip(taps, 0, source - 1), weights / weights.sum(axis=1, keepdims=True)


def _apply_taps(lines: np.ndarray, taps: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted sums of whole lines (the first axis): work grows with the number of taps, not with the source size."""
    factors = weights.astype(np.float32).T.reshape(*taps.T.shape, *[1] * (lines.ndim - 1))
    total = lines.take(taps[:, 0], axis=0)
    total *= factors[0]
    for k in range(1, taps.shape[1]):
        part = lines.take(taps[:, k], axis=0)
        part *= factors[k]
        total += part
    return total


def resize_crop(image: np.ndarray, plan: dict[str, int], kernel: str) -> np.ndarray:
    """Apply a resize-and-crop plan to ``[h, w, c]``; only the crop window is computed.

    8-bit resampling ('cubic', 'lanczos') rounds after each axis, width first;
    'interpolate' keeps fractions.
    """
    x, y = plan["crop_x"], plan["crop_y"]
    tx, wx = _weights_of(image.shape[1], plan["resize_w"], kernel)
    ty, wy = _weights_of(image.shape[0], plan["resize_h"], kernel)
    tx, wx = tx[x : x + plan["bucket_w"]], wx[x : x + plan["bucket_w"]]
    ty, wy = ty[y : y + plan["bucket_h"]], wy[y : y + plan["bucket_h"]]
    top, bottom = int(ty[0, 0]), int(ty[-1, -1]) + 1  # taps ascend
    out = image[top:bottom]
    for taps, weights in ((tx, wx), (ty - top, wy)):  # columns are lines of the image on its side
        out = _apply_taps(np.ascontiguousarray(out.swapaxes(0, 1), np.float32), taps, weights)
        if kernel != "interpolate":
            out = np.clip(np.floor(out + 0.5), 0, 255)
    return out


def carry_out(image: np.ndarray, plan: dict[str, int], kernel: str) -> np.ndarray:
    """Bring an image to its planned load size if that differs, then resize and crop it."""
    if image.shape[:2] != (plan["load_h"], plan["load_w"]):
        whole = {"resize_w": plan["load_w"], "resize_h": plan["load_h"], "crop_x": 0, "crop_y": 0}
        image = resize_crop(image, whole | {"bucket_w": plan["load_w"], "bucket_h": plan["load_h"]}, "lanczos")
    return resize_crop(image, plan, kernel)


def normalized_chw(image: np.ndarray) -> np.ndarray:
    """``[h, w, 3]`` 0..255 -> float32 ``[3, h, w]`` in about [-1, 1]."""
    return (image.transpose(2, 0, 1) / 255.0 * 2.0 - 1.0).astype(np.float32, copy=False)


PLAN_COLUMNS = ["load_w", "load_h", "resize_w", "resize_h", "crop_x", "crop_y", "bucket_w", "bucket_h"]


def frames_of_bytes(pdf: pd.DataFrame, sizes: np.ndarray, limit: int = BATCH_BYTES // 2) -> Iterator[pd.DataFrame]:
    """``pdf`` in stretches of rows whose results, of ``sizes`` bytes, take at most ``limit`` together, or of one row."""
    begin, held = 0, 0
    for end, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield pdf.iloc[begin:end]
            begin, held = end, 0
        held += size
    if begin < len(pdf):
        yield pdf.iloc[begin:]


def to_rgb(images: DataFrame, keep: list[str], order: str = "BGR") -> DataFrame:
    """Replace interleaved ``data`` of 1, 3 or 4 channels by RGB bytes.

    Input columns ``height, width, nChannels, data`` are those of Spark's image source.
    """
    fields = [images.schema[c] for c in keep] + [
        T.StructField("height", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("data", T.BinaryType()),
    ]

    def run(batches):
        for pdf in batches:
            sizes = pdf["height"].to_numpy(np.int64) * pdf["width"].to_numpy(np.int64) * 3
            for part in frames_of_bytes(pdf, sizes):
                rgb = [
                    np.ascontiguousarray(rgb_from_bytes(d, h, w, c, order)).tobytes()
                    for d, h, w, c in zip(part["data"], part["height"], part["width"], part["nChannels"])
                ]
                yield part[[*keep, "height", "width"]].assign(data=rgb)

    bound_batches(images.sparkSession)
    return images.select(*keep, "height", "width", "nChannels", "data").mapInPandas(run, T.StructType(fields))


def resize_pixels(images: DataFrame, keep: list[str], kernel: str = "cubic") -> DataFrame:
    """Carry out each row's plan: RGB ``data`` -> normalised flat ``pixels`` with ``pixel_shape``.

    Narrow: every image is resized where it already is.
    """
    fields = [images.schema[c] for c in keep] + [
        T.StructField("pixels", T.ArrayType(T.FloatType())),
        T.StructField("pixel_shape", T.ArrayType(T.LongType())),
    ]

    def run(batches):
        for pdf in batches:
            sizes = pdf["bucket_h"].to_numpy(np.int64) * pdf["bucket_w"].to_numpy(np.int64) * 12
            for part in frames_of_bytes(pdf, sizes):
                tensors = [
                    normalized_chw(carry_out(rgb_from_bytes(d, h, w, 3, "RGB"), plan, kernel))
                    for d, h, w, plan in zip(part["data"], part["height"], part["width"], part[PLAN_COLUMNS].to_dict("records"))
                ]
                yield part[keep].assign(pixels=[t.ravel() for t in tensors], pixel_shape=[list(t.shape) for t in tensors])

    bound_batches(images.sparkSession)
    return images.select(*dict.fromkeys([*keep, "height", "width", "data", *PLAN_COLUMNS])).mapInPandas(run, T.StructType(fields))


def image_seeds(keys: pd.Series, seed: int) -> np.ndarray:
    """One 32-bit seed per image key, for encoders that sample."""
    return np.array([zlib.crc32(f"{seed}:{key}".encode()) for key in keys], dtype=np.uint32)


def encode_batch(
    decode: Callable[[bytes], np.ndarray],
    encode: Callable[..., np.ndarray],
    frame: pd.DataFrame,
    content: str,
    kernel: str,
    seeds: np.ndarray | None = None,
) -> tuple[list[np.ndarray | None], list[str | None]]:
    """(latents, errors) for rows of one bucket size; a bad image only loses its own row.

    With ``seeds`` the encoder is called as ``encode(images, seeds)``. An encoder that
    fails on a batch is tried on its halves, down to single images. Faults of the
    setup (a missing decoder or package, no memory) and an encoder that fails on
    every image of a batch of several fail the task instead of the rows.
    """
    stacked, places = [], []
    latents: list[np.ndarray | None] = [None] * len(frame)
    errors: list[str | None] = [None] * len(frame)
    plans = zip(*(frame[c].astype("int64").tolist() for c in PLAN_COLUMNS))
    for place, (data, plan) in enumerate(zip(frame[content], plans)):
        try:
            stacked.append(normalized_chw(carry_out(decode(data), dict(zip(PLAN_COLUMNS, plan)), kernel)))
            places.append(place)
        except SETUP_FAULTS:
            raise
        except Exception as problem:  # any other decoder failure is that row's reject
            errors[place] = f"{type(problem).__name__}: {problem}"

    def attempt(first: int, last: int) -> None:
        try:
            extra = () if seeds is None else (seeds[places[first:last]],)
            made = encode(np.stack(stacked[first:last]), *extra)
            for place, latent in zip(places[first:last], made, strict=True):
                latents[place] = latent
        except Exception as problem:
            if last - first == 1:
                errors[places[first]] = f"{type(problem).__name__}: {problem}"
                return
            attempt(first, (first + last) // 2)
            attempt((first + last) // 2, last)

    if stacked:
        attempt(0, len(stacked))
        if len(stacked) > 1 and all(latents[p] is None for p in places):
            raise SetupFault(f"the encoder failed on every image of a batch: {errors[places[0]]}")
    return latents, errors
