"""Ready-made settings for the job variants in use."""

from __future__ import annotations

from collections.abc import Callable

from shapeloom.functions.buckets import GRID_256, GRID_256_COARSE, GRID_512, GRID_1024
from shapeloom.plans.jobs import ImageSettings

# Grid, size filter, crop, resampler, stored precision and batch size per variant.
PRESETS: dict[str, dict] = {
    "catalog_256": dict(grid=GRID_256, crop="random", kernel="cubic", precision="float32", batch_size=32),
    "catalog_512": dict(grid=GRID_512, crop="random", kernel="cubic", precision="float32", batch_size=32),
    "catalog_1024": dict(grid=GRID_1024, min_side=1024, crop="random", kernel="interpolate", precision="float16", batch_size=128),
    "tar_1024": dict(grid=GRID_1024, min_side=1024, crop="center", kernel="interpolate", precision="float16", batch_size=12),
    "tar_1024_by_url": dict(grid=GRID_1024, min_side=1024, crop="center", kernel="interpolate", precision="float16", batch_size=32),
    "table_256": dict(grid=GRID_256_COARSE, min_side=256, crop="random", kernel="interpolate", precision="fp8", batch_size=32),
}


def preset(name: str, make_encoder: Callable, **changes) -> ImageSettings:
    """Settings of a variant with your encoder; keyword arguments override single values."""
    if name not in PRESETS:
        raise ValueError(f"unknown preset {name}; known: {', '.join(PRESETS)}")
    return ImageSettings(make_encoder, **(PRESETS[name] | changes))
