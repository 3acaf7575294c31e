"""Closed-form map projections as Column expressions.

Albers equal-area conic (Snyder, "Map Projections: A Working Manual", 1987,
eqs. 3-12, 14-3..14-6, 14-12, 14-13) and spherical Web-Mercator tile addressing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# EPSG:5070 (NAD83 / Conus Albers) parameters and the GRS80 ellipsoid.
ALBERS_LAT1 = 29.5
ALBERS_LAT2 = 45.5
ALBERS_LAT0 = 23.0
ALBERS_LON0 = -96.0
GRS80_A = 6378137.0
GRS80_INV_F = 298.257222101

# Origin and cell size of the 30 m Albers grid the layers live on.
GRID_XMIN = -2493045.0
GRID_YMAX = 3310725.0
CELL_SIZE = 30.0

_E2 = (2.0 - 1.0 / GRS80_INV_F) / GRS80_INV_F
_E = math.sqrt(_E2)


def _q(s: float) -> float:
    return (1 - _E2) * (s / (1 - _E2 * s * s) - (1 / (2 * _E)) * math.log((1 - _E * s) / (1 + _E * s)))


def _m(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - _E2 * math.sin(phi) ** 2)


_P1, _P2, _P0 = (math.radians(v) for v in (ALBERS_LAT1, ALBERS_LAT2, ALBERS_LAT0))
_M1, _M2 = _m(_P1), _m(_P2)
_Q1, _Q2, _Q0 = _q(math.sin(_P1)), _q(math.sin(_P2)), _q(math.sin(_P0))
_N = (_M1 * _M1 - _M2 * _M2) / (_Q2 - _Q1)
_C = _M1 * _M1 + _N * _Q1
_RHO0 = GRS80_A * math.sqrt(_C - _N * _Q0) / _N


def albers_xy(lon: Column, lat: Column) -> tuple[Column, Column]:
    """WGS84/NAD83 degrees -> EPSG:5070 metres (x east, y north)."""
    s = F.sin(F.radians(lat))
    q = F.lit(1 - _E2) * (s / (F.lit(1.0) - F.lit(_E2) * s * s)
                         - F.lit(1 / (2 * _E)) * F.log((F.lit(1.0) - F.lit(_E) * s) / (F.lit(1.0) + F.lit(_E) * s)))
    rho = F.lit(GRS80_A) * F.sqrt(F.lit(_C) - F.lit(_N) * q) / F.lit(_N)
    theta = F.lit(_N) * F.radians(lon - F.lit(ALBERS_LON0))
    return rho * F.sin(theta), F.lit(_RHO0) - rho * F.cos(theta)


def albers_sql(lon: str, lat: str) -> tuple[str, str]:
    """The same formula as DuckDB SQL text (oracle side)."""
    s = f"sin(radians({lat}))"
    q = (f"({1 - _E2!r} * ({s} / (1.0 - {_E2!r} * {s} * {s}) - {1 / (2 * _E)!r} * "
         f"ln((1.0 - {_E!r} * {s}) / (1.0 + {_E!r} * {s}))))")
    rho = f"({GRS80_A!r} * sqrt({_C!r} - {_N!r} * {q}) / {_N!r})"
    theta = f"({_N!r} * radians({lon} - ({ALBERS_LON0!r})))"
    return f"({rho} * sin({theta}))", f"({_RHO0!r} - {rho} * cos({theta}))"


def grid_cell(x: Column, y: Column) -> tuple[Column, Column]:
    """Albers metres -> (col, row) on the 30 m grid (row 0 at the north edge)."""
    return F.floor((x - F.lit(GRID_XMIN)) / F.lit(CELL_SIZE)), F.floor((F.lit(GRID_YMAX) - y) / F.lit(CELL_SIZE))


def to_cell_units(x: Column, y: Column) -> tuple[Column, Column]:
    """Albers metres -> fractional cell coordinates (for polygon rasterisation)."""
    return (x - F.lit(GRID_XMIN)) / F.lit(CELL_SIZE), (F.lit(GRID_YMAX) - y) / F.lit(CELL_SIZE)


def mercator_tile(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """Web-Mercator (EPSG:3857) z/x/y tile address of a lon/lat point."""
    scale = F.lit(float(2 ** zoom))
    r = F.radians(lat)
    x = F.floor((lon + F.lit(180.0)) / F.lit(360.0) * scale)
    y = F.floor((F.lit(1.0) - F.log(F.tan(r) + F.lit(1.0) / F.cos(r)) / F.lit(math.pi)) / F.lit(2.0) * scale)
    return x, y


def mercator_xy(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Spherical Web-Mercator metres."""
    r = F.lit(6378137.0)
    return r * F.radians(lon), r * F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / F.lit(2.0)))
