"""Array and tensor columns: scaling, layout, padding, reduced precision.

Tensors are a flat ``ARRAY`` plus a ``shape ARRAY<BIGINT>`` (channels first).
Short arrays use JVM higher-order functions. The reduced-precision codecs also
exist as Arrow functions (``pack_*`` / ``unpack_*``) that work on a whole batch's
value buffer at once, which is the form to use on latents of thousands of values.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from shapeloom.functions.arithmetic import int_div

# binary16 and FP8 E5M2 limits (IEEE 754; Micikevicius et al. 2022).
HALF_OVERFLOW = 65520.0
HALF_MIN_NORMAL = 2.0**-14
E5M2_OVERFLOW = 61440.0
E5M2_NAN = 127
E5M2_INF = 124

# Values encoded at a time: some ten temporary arrays of eight bytes a value lie beside them.
STRETCH_VALUES = 1 << 16


# ---- scaling -----------------------------------------------------------------


def normalize_pixels(values: Column) -> Column:
    """0..255 -> [-1, 1]."""
    return F.transform(values, lambda x: x / F.lit(255.0) * 2.0 - 1.0)


def denormalize_pixels(values: Column) -> Column:
    """[-1, 1] (clamped) -> 0..255, truncated."""
    return F.transform(
        values,
        lambda x: ((F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x.cast("double"))) * 0.5 + 0.5) * 255.0).cast("int"),
    )


# ---- layout ------------------------------------------------------------------


def flatten_tensor(nested: Column, rank: int = 3) -> Column:
    """Row-major flattening of a nested array of the given rank."""
    for _ in range(rank - 1):
        nested = F.flatten(nested)
    return nested


def unflatten_tensor(flat: Column, shape: list[Column]) -> Column:
    """Nested array of ``shape`` from a flat one; the inverse of ``flatten_tensor``."""
    if len(shape) == 1:
        return flat
    outer, inner = shape[0].cast("int"), shape[1:]
    stride = inner[0].cast("int")
    for dim in inner[1:]:
        stride = stride * dim.cast("int")
    return F.transform(
        F.sequence(F.lit(0), outer - 1),
        lambda i: unflatten_tensor(F.slice(flat, i * stride + 1, stride), inner),
    )


def chw_to_hwc(flat: Column, channels: Column, height: Column, width: Column) -> Column:
    plane = height * width
    return F.transform(
        F.sequence(F.lit(0), (channels * plane).cast("int") - 1),
        lambda i: F.get(flat, ((i % channels) * plane + int_div(i, channels)).cast("int")),
    )


def hwc_to_chw(flat: Column, channels: Column, height: Column, width: Column) -> Column:
    plane = height * width
    return F.transform(
        F.sequence(F.lit(0), (channels * plane).cast("int") - 1),
        lambda i: F.get(flat, ((i % plane) * channels + int_div(i, plane)).cast("int")),
    )


def pad_array(values: Column, length: int, fill: Column) -> Column:
    """Pad at the end up to ``length``; longer arrays stay whole."""
    return F.concat(values, F.array_repeat(fill, F.greatest(F.lit(0), F.lit(length) - F.size(values))))


# ---- reduced precision, element-wise in the JVM -------------------------------


def _exponent(magnitude: Column) -> Column:
    return F.floor(F.log2(magnitude))


def round_half(value: Column) -> Column:
    """Nearest IEEE binary16 value (ties to even), as a double."""
    v = value.cast("double")
    a = F.abs(v)
    sign = F.when(v < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    unit = F.pow(F.lit(2.0), _exponent(a) - 10)
    return (
        F.when(F.isnan(v), F.lit(float("nan")))
        .when(a >= HALF_OVERFLOW, sign * F.lit(float("inf")))
        .when(a < HALF_MIN_NORMAL, sign * F.rint(a * 2.0**24) * 2.0**-24)
        .otherwise(sign * F.rint(a / unit) * unit)
    )


def to_float16(values: Column) -> Column:
    return F.transform(values, round_half)


def fp8_code(value: Column) -> Column:
    """FP8 E5M2 code 0..255 of a number, nearest with ties to even."""
    v = value.cast("double")
    a = F.abs(v)
    sign = F.when(v < 0, F.lit(128)).otherwise(F.lit(0))
    exponent = _exponent(a)
    fraction = F.rint((a / F.pow(F.lit(2.0), exponent) - 1.0) * 4.0)
    return (
        F.when(F.isnan(v), F.lit(E5M2_NAN))
        .when(a >= E5M2_OVERFLOW, sign + E5M2_INF)
        .when(a < HALF_MIN_NORMAL, sign + F.rint(a * 2.0**16).cast("int"))
        .otherwise(sign + ((exponent + 15) * 4 + fraction).cast("int"))
    )


def fp8_quantize(values: Column) -> Column:
    return F.transform(values, fp8_code)


def fp8_value(code: Column) -> Column:
    """Number an FP8 E5M2 code stands for."""
    c = code.cast("int")
    b = c.bitwiseAND(127)
    sign = F.when(c >= 128, F.lit(-1.0)).otherwise(F.lit(1.0))
    normal = (b.bitwiseAND(3) / 4.0 + 1.0) * F.pow(F.lit(2.0), F.shiftright(b, 2) - 15)
    return (
        F.when(b > E5M2_INF, F.lit(float("nan")))
        .when(b == E5M2_INF, sign * F.lit(float("inf")))
        .when(b < 4, sign * b * 2.0**-16)
        .otherwise(sign * normal)
    )


def fp8_dequantize(codes: Column) -> Column:
    return F.transform(codes, fp8_value)


# ---- reduced precision, a whole Arrow batch at a time -------------------------


def e5m2_encode(values: np.ndarray) -> np.ndarray:
    """uint8 E5M2 codes of an array, rounded once from the original value.

    Working on the float64 bit pattern: scale the magnitude so that one unit in
    the last place of the target becomes 1, and round that to even.
    """
    v = np.asarray(values, dtype=np.float64)
    a = np.abs(v)
    finite = np.where(np.isfinite(a), np.minimum(a, E5M2_OVERFLOW), 0.0)
    exponent = np.where(finite > 0, np.maximum(np.frexp(finite)[1] - 1, -14), -14)
    steps = np.rint(np.ldexp(finite, 2 - exponent)).astype(np.int64)
    code = (exponent + 14) * 4 + steps
    code = np.where(a >= E5M2_OVERFLOW, E5M2_INF, code)
    code = code + np.where(v < 0, 128, 0)
    return np.where(np.isnan(v), E5M2_NAN, code).astype(np.uint8)


def e5m2_decode(codes: np.ndarray) -> np.ndarray:
    """An E5M2 code is the upper byte of a binary16 pattern."""
    return (np.asarray(codes, dtype=np.uint8).astype(np.uint16) << 8).view(np.float16).astype(np.float32)


def _rows_of(array) -> tuple[pa.Array, np.ndarray, int]:
    """(array, row boundaries, first boundary) of a list or binary array."""
    kind = np.int64 if pa.types.is_large_list(array.type) or pa.types.is_large_binary(array.type) else np.int32
    bounds = np.frombuffer(array.buffers()[1], dtype=kind)[array.offset : array.offset + len(array) + 1]
    return array, bounds.astype(np.int64), int(bounds[0]) if len(bounds) else 0


def _validity(array) -> pa.Buffer | None:
    if array.null_count == 0:
        return None
    return pa.array(array.is_valid().to_numpy(zero_copy_only=False), pa.bool_()).buffers()[1]


def _by_stretches(encode, values: np.ndarray) -> np.ndarray:
    """``encode`` of every value; what it needs beside the result is that of one stretch."""
    cuts = range(0, max(1, len(values)), STRETCH_VALUES)
    return np.concatenate([encode(values[at : at + STRETCH_VALUES]) for at in cuts])


def _lists_to_binary(lists, encode, width: int):
    """Encode every list's values, stretch by stretch; ``width`` bytes per element."""
    if len(lists) == 0:
        return pa.array([], pa.binary())
    lists, bounds, first = _rows_of(lists)
    values = lists.values.slice(first, int(bounds[-1]) - first)
    if values.null_count:
        raise ValueError("tensor values must not be null")
    data = _by_stretches(encode, values.to_numpy(zero_copy_only=False))
    offsets = (bounds - first) * width
    if offsets[-1] > np.iinfo(np.int32).max:
        raise ValueError("Arrow batch too large to pack; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    buffers = [_validity(lists), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.binary(), len(lists), buffers, lists.null_count)


def _binary_to_lists(packed, decode, width: int):
    if len(packed) == 0:
        return pa.array([], pa.list_(pa.float32()))
    packed, bounds, first = _rows_of(packed)
    raw = np.frombuffer(packed.buffers()[2] or b"", dtype=np.uint8)[first : int(bounds[-1])]
    values = pa.array(decode(raw), pa.float32())
    offsets = pa.py_buffer(((bounds - first) // width).astype(np.int32))
    return pa.Array.from_buffers(
        pa.list_(pa.float32()), len(packed), [_validity(packed), offsets], packed.null_count, children=[values]
    )


def half_bytes(values: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.asarray(values).astype("<f2")


@arrow_udf(T.BinaryType())
def pack_float16(values: pa.Array) -> pa.Array:
    """``ARRAY<FLOAT|DOUBLE>`` -> two little-endian bytes per value."""
    return _lists_to_binary(values, half_bytes, 2)


@arrow_udf(T.ArrayType(T.FloatType()))
def unpack_float16(packed: pa.Array) -> pa.Array:
    return _binary_to_lists(packed, lambda raw: raw.view("<f2").astype(np.float32), 2)


@arrow_udf(T.BinaryType())
def pack_fp8(values: pa.Array) -> pa.Array:
    """``ARRAY<FLOAT|DOUBLE>`` -> one E5M2 byte per value."""
    return _lists_to_binary(values, e5m2_encode, 1)


@arrow_udf(T.ArrayType(T.FloatType()))
def unpack_fp8(packed: pa.Array) -> pa.Array:
    return _binary_to_lists(packed, e5m2_decode, 1)


@arrow_udf(T.ArrayType(T.FloatType()))
def half_from_words(words: pa.Array) -> pa.Array:
    """``ARRAY<BINARY>`` of 2-byte halves (how Spark reads FLOAT16 Parquet lists) -> ``ARRAY<FLOAT>``."""
    if len(words) == 0:
        return pa.array([], pa.list_(pa.float32()))
    words, bounds, first = _rows_of(words)
    items = words.values.slice(first, int(bounds[-1]) - first)
    start = _rows_of(items)[2]
    raw = np.frombuffer(items.buffers()[2] or b"", dtype=np.uint8)[start : start + 2 * len(items)]
    values = pa.array(raw.view("<f2").astype(np.float32), pa.float32())
    offsets = pa.py_buffer((bounds - first).astype(np.int32))
    return pa.Array.from_buffers(
        pa.list_(pa.float32()), len(words), [_validity(words), offsets], words.null_count, children=[values]
    )
