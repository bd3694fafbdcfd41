"""Arithmetic shared by the column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(a: Column, b: Column | int) -> Column:
    """Whole-number division (BIGINT), exact beyond 2**53."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))
