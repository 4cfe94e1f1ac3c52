"""Circular statistics for direction measures (degrees)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def circular_mean(deg: Column | str) -> Column:
    """Mean direction in [0, 360]: degrees(atan2(avg sin, avg cos)), shifted by +360 when avg sin < 0.

    NULL inputs are ignored (the averages skip them); an all-NULL group gives NULL.
    """
    c = F.col(deg) if isinstance(deg, str) else deg
    s = F.avg(F.sin(F.radians(c)))
    co = F.avg(F.cos(F.radians(c)))
    theta = F.degrees(F.atan2(s, co))
    return F.when(s >= 0, theta).otherwise(theta + F.lit(360.0))
