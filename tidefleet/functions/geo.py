"""Distances, grid cells and space-filling keys, all as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance; null if any coordinate is."""
    north, east = F.radians(lat2 - lat1), F.radians(lng2 - lng1)
    a = F.sin(north / 2) * F.sin(north / 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(east / 2) * F.sin(east / 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.when(a > 1, 1.0).otherwise(a)))


def cell(x: Column, size: float) -> Column:
    """Index of the grid cell of a coordinate, rounded down on either side of zero."""
    return F.floor(x / F.lit(size)).cast("long")


def neighbour_cells(ix: Column, iy: Column) -> Column:
    """The 3 x 3 cells around one, as an array of structs to explode."""
    around = [F.struct((ix + dx).alias("cx"), (iy + dy).alias("cy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]
    return F.array(*around)


def _spread_bits(v: Column) -> Column:
    """16 bits with a zero bit before each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return v


def morton(x: Column, y: Column, x_range: tuple[float, float], y_range: tuple[float, float]) -> Column:
    """Z-order key of two coordinates, each scaled to 16 bits over a range; values beyond it count as its ends."""

    def scaled(v: Column, low: float, high: float) -> Column:
        unit = (v - F.lit(low)) / F.lit(max(high - low, 1e-12))
        return F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), unit)) * 65535).cast("long")

    return _spread_bits(scaled(x, *x_range)).bitwiseOR(F.shiftleft(_spread_bits(scaled(y, *y_range)), 1))
