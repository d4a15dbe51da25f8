"""Map geometry: Mercator rows, cell bounds, inverse-distance weights."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Map extent in degrees, cell height, weighting.
SOUTH, NORTH, WEST, EAST = 41.2, 51.4, -5.6, 10.0
CELL_DEGREES = 0.144
COS_MID_LATITUDE = math.cos(math.radians(46.5))
IDW_POWER = 2.5
IDW_OFFSET = 0.05


def mercator(lat: Column) -> Column:
    """Mercator ordinate of a latitude in degrees."""
    return F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2))


def inverse_mercator(y: Column) -> Column:
    return F.degrees(F.atan(F.exp(y))) * 2 - 90


def row_latitude(row: Column, rows: int) -> Column:
    """Latitude of a map row; rows are evenly spaced in Mercator from the north."""
    top, bottom = mercator(F.lit(NORTH)), mercator(F.lit(SOUTH))
    return inverse_mercator(top + row / (rows - 1) * (bottom - top))


def column_longitude(column: Column, columns: int) -> Column:
    return F.lit(WEST) + column / (columns - 1) * (EAST - WEST)


def cell_bounds(lat: Column, lon: Column) -> dict[str, Column]:
    """Edges of the 16 km cell around a centre."""
    width = F.lit(CELL_DEGREES) / F.cos(F.radians(lat))
    return {
        "south": lat - CELL_DEGREES / 2, "north": lat + CELL_DEGREES / 2,
        "west": lon - width / 2, "east": lon + width / 2,
    }


def idw_weight(lat: Column, lon: Column, station_lat: Column, station_lon: Column) -> Column:
    distance = F.hypot(lat - station_lat, (lon - station_lon) * COS_MID_LATITUDE) + IDW_OFFSET
    return 1 / F.pow(distance, F.lit(IDW_POWER))
