"""Names inside shards: which members count, and how they pair up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """Base name up to its first dot (``a.b.jpg`` -> ``a``)."""
    return F.substring_index(basename(path), ".", 1)


def is_image_member(path: Column) -> Column:
    """Lower-case ``.jpg`` only."""
    return basename(path).endswith(".jpg")


def is_sidecar_member(path: Column) -> Column:
    """``.json`` files, hidden ones excluded."""
    name = basename(path)
    return name.endswith(".json") & ~name.startswith(".")


def swap_extension(path: Column, old: str, new: str) -> Column:
    """``x.tar`` <-> ``x.parquet``; only a trailing extension changes."""
    trunk = F.substring(path, F.lit(1), F.length(path) - len(old))
    return F.when(path.endswith(old), F.concat(trunk, F.lit(new))).otherwise(path)
