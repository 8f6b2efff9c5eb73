"""Longitude ranges, which may cross the date line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column


def normalise_longitudes(bounds: Sequence[float]) -> tuple[float, float]:
    """Bounds on the -180..180 scale; a span of 360 degrees or more is the whole circle."""
    lo, hi = bounds
    if hi - lo >= 360:
        return (-180.0, 180.0)
    return (lo - 360 if lo > 180 else lo, hi - 360 if hi > 180 else hi)


def in_longitudes(longitude: Column, bounds: Sequence[float]) -> Column:
    """Whether a longitude lies in the range, both ends included."""
    lo, hi = normalise_longitudes(bounds)
    if lo <= hi:
        return longitude.between(lo, hi)
    return (longitude >= lo) | (longitude <= hi)
