"""Pluggable model functions run on Arrow batches, and deterministic stand-ins.

A model is given as ``make_fn``: a function without arguments that loads the
model and returns ``batch -> result``. It is called once per Python worker process,
which Spark reuses for many tasks, and is fed batches of fixed size. The stand-ins
below have the same shape as real encoders and let every job run without weights.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: width of the text embedding.
TEXT_WIDTH = 1152


_loaded: dict[str, object] = {}


def model_token(job: str | None = None, role: str = "model") -> str:
    """Names one use of a model; taken on the driver and sent along with the task.

    Uses that name the same ``job`` and ``role`` share one loaded model, round after
    round; a worker drops the models of other jobs when it loads one.
    """
    return f"{job or uuid.uuid4().hex}/{role}"


def once_per_worker(token: str, make_fn: Callable):
    """The model of ``token``, loaded at its first use in this worker process."""
    if token not in _loaded:
        job = token.partition("/")[0]
        for other in [t for t in _loaded if t.partition("/")[0] != job]:
            del _loaded[other]
        _loaded[token] = make_fn()
    return _loaded[token]


def run_once(model):
    """Keep the optimizer from copying a costly call into filters it infers or pushes down."""
    return model.asNondeterministic()


def encode_tensors(values: Column, make_fn: Callable, input_width: int, batch_size: int = 32) -> Column:
    """Flat tensors -> ``ARRAY<DOUBLE>`` latents through a batch model."""
    model = predict_batch_udf(
        make_fn, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size, input_tensor_shapes=[[input_width]]
    )
    return run_once(model)(values)


def encode_texts(texts: Column, make_fn: Callable[[], Callable[[list[str]], np.ndarray]], batch_size: int = 32, token: str | None = None) -> Column:
    """Strings -> ``ARRAY<DOUBLE>`` embeddings; null text counts as empty."""
    token = token or model_token()

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = once_per_worker(token, make_fn)
        for series in batches:
            rows = [t if t is not None else "" for t in series]
            out: list[np.ndarray] = []
            for begin in range(0, len(rows), batch_size):
                out.extend(np.asarray(model(rows[begin : begin + batch_size]), dtype=np.float64))
            yield pd.Series(out, dtype=object)

    return run_once(run)(texts)


def caption_images(columns: list[Column], make_fn: Callable[[], Callable[[pd.DataFrame], list[str]]], token: str | None = None, prepare: Callable[[pd.DataFrame], pd.DataFrame] | None = None) -> Column:
    """Image columns -> caption strings. ``prepare`` may decode or resize a batch before the model sees it."""
    token = token or model_token()

    @F.pandas_udf(T.StringType())
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        model = once_per_worker(token, make_fn)
        for frame in batches:
            yield pd.Series(model(prepare(frame) if prepare else frame), dtype=object)

    return run_once(run)(F.struct(*columns))


# ---- stand-ins -----------------------------------------------------------------


def projection_matrix(inputs: int, outputs: int) -> np.ndarray:
    """Fixed weights ``((7*i + 13*j) mod 11 - 5) / 10``."""
    i, j = np.meshgrid(np.arange(inputs), np.arange(outputs), indexing="ij")
    return ((7 * i + 13 * j) % 11 - 5) / 10.0


def projection_encoder(inputs: int, outputs: int) -> Callable:
    def make_fn():
        weights = projection_matrix(inputs, outputs)
        return lambda batch: np.asarray(batch, dtype=np.float64) @ weights

    return make_fn


def projection_decoder(outputs: int, inputs: int) -> Callable:
    """Transposed projection, scaled to stay within the pixel range."""

    def make_fn():
        weights = projection_matrix(inputs, outputs).T / inputs
        return lambda batch: np.asarray(batch, dtype=np.float64) @ weights

    return make_fn


@lru_cache(maxsize=1 << 16)
def _slot(token: str, width: int) -> int:
    return int(hashlib.md5(token.encode("utf-8")).hexdigest()[:8], 16) % width


def hashing_text_encoder(width: int = TEXT_WIDTH) -> Callable[[], Callable[[list[str]], np.ndarray]]:
    """Unit-length token counts over hashed slots; the whole text is read."""

    def make_fn():
        def encode(texts: list[str]) -> np.ndarray:
            out = np.zeros((len(texts), width))
            for row, text in enumerate(texts):
                for token, n in Counter(text.split(" ")).items():
                    if token:
                        out[row, _slot(token, width)] += n
            norms = np.linalg.norm(out, axis=1, keepdims=True)
            return out / np.where(norms > 0, norms, 1.0)

        return encode

    return make_fn


def template_captioner(width: str, height: str, subject: str) -> Callable:
    """Captions such as ``a 640x480 image of fr text`` from the columns of that name."""

    def make_fn():
        def caption(frame: pd.DataFrame) -> list[str]:
            return [f"a {w}x{h} image of {s}" for w, h, s in zip(frame[width], frame[height], frame[subject])]

        return caption

    return make_fn


def block_mean_encoder(factor: int) -> Callable:
    """Images ``[n, c, h, w]`` -> latents ``[n, c, h/factor, w/factor]`` of block means."""

    def make_fn():
        def encode(images: np.ndarray) -> np.ndarray:
            n, c, h, w = images.shape
            return images.reshape(n, c, h // factor, factor, w // factor, factor).mean(axis=(3, 5))

        return encode

    return make_fn


def sampling_encoder(factor: int, spread: float = 0.01) -> Callable:
    """Like ``block_mean_encoder`` plus noise drawn from each image's own seed."""

    def make_fn():
        encode = block_mean_encoder(factor)()

        def sample(images: np.ndarray, seeds: np.ndarray) -> np.ndarray:
            means = encode(images)
            return np.stack([m + spread * np.random.default_rng(s).standard_normal(m.shape) for m, s in zip(means, seeds)])

        return sample

    return make_fn
