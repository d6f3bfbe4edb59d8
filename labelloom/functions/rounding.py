"""Rounding as numpy does it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_scaled(col: Column | str, digits: int = 2) -> Column:
    """Scale, round half to even, unscale.

    Differs from ``F.round`` (half up) and from ``F.bround`` (decimal half
    even) on values such as 12.425 and 9.425.
    """
    scale = float(10**digits)
    column = F.col(col) if isinstance(col, str) else col
    return F.rint(column * scale) / scale
