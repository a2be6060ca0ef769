"""Geometry expressions: haversine distance, even-odd point in polygon."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the Earth radius of the haversine distance the workflow uses, in kilometres.
EARTH_RADIUS_KM = 6378.137


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    rad = math.pi / 180.0
    dlat = (lat2 - lat1) * rad
    dlon = (lon2 - lon1) * rad
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(lat1 * rad) * F.cos(lat2 * rad) * F.pow(F.sin(dlon / 2), 2)
    # least() skips NULL, so a missing coordinate has to be kept missing
    return F.when(a.isNotNull(), F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(a))))


def crossings(edges: Column, lon: Column, lat: Column) -> Column:
    """Number of polygon edges a ray from (lon, lat) towards +x crosses; odd means inside (holes included)."""

    def step(acc, e):
        hit = ((e["y1"] > lat) != (e["y2"] > lat)) & (
            lon < (e["x2"] - e["x1"]) * (lat - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
        )
        return acc + F.when(hit, 1).otherwise(0)

    return F.aggregate(F.filter(edges, lambda e: e.isNotNull()), F.lit(0), step)
