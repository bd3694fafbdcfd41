"""Packing latents holds little beside them."""

import tracemalloc

import numpy as np
import pyarrow as pa

from shapeloom.functions import tensors


def test_packing_needs_little_beside_the_values():
    values = np.random.default_rng(7).normal(0, 300, 1_000_003).astype(np.float32)
    values[[0, 65535, 65536, 999_999]] = [np.nan, np.inf, -np.inf, 1e6]
    lists = pa.ListArray.from_arrays(pa.array([0, 3, 3, 500_000, 1_000_003], pa.int32()), pa.array(values))
    for encode, width in ((tensors.e5m2_encode, 1), (tensors.half_bytes, 2)):
        whole = encode(values).tobytes()
        tracemalloc.start()
        packed = tensors._lists_to_binary(lists, encode, width)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert b"".join(packed.to_pylist()) == whole and [len(p) for p in packed.to_pylist()][:2] == [3 * width, 0]
        assert peak < 16 << 20
    assert tensors._lists_to_binary(lists.slice(1, 1), tensors.e5m2_encode, 1).to_pylist() == [b""]
