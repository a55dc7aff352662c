"""Distances and boxes as column expressions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0


class Box(NamedTuple):
    south: float
    west: float
    north: float
    east: float


WORLD = Box(-90.0, -180.0, 90.0, 180.0)


def bbox_intersect(a: Box, b: Box) -> Box | None:
    """The overlap; touching edges are none."""
    box = Box(max(a.south, b.south), max(a.west, b.west), min(a.north, b.north), min(a.east, b.east))
    return box if box.south < box.north and box.west < box.east else None


def in_bbox(lat: Column, lon: Column, box: Box) -> Column:
    return lat.between(box.south, box.north) & lon.between(box.west, box.east)


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    h = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(F.radians(lon2 - lon1) / 2), 2
    )
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(h, F.lit(1.0))))
