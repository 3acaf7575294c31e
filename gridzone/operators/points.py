"""Point-table operators: point-in-polygon join, radius filter, extent / max clip."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridzone.operators.cover import inside_boundary_cell, quadtree_cover
from gridzone.operators.joins import sized_broadcast

EARTH_RADIUS_M = 6371008.8  # mean Earth radius (sphere stands in for the geography type)
METERS_PER_MILE = 1609.344


def pip_join(points: DataFrame, vertices: DataFrame, max_rows: int | None = None, cover: tuple | None = None) -> DataFrame:
    """Points inside polygons (even-odd per part): ``(pid, poly_id)``.

    Polygons become a quadtree cover (``cover.quadtree_cover``) and a point looks up its cell at each
    level in use (at most a dozen): a cell inside answers at once, a boundary cell with its own few
    edges. So a join key holds one cell of each polygon there, however many points and
    edges there are; the cover is broadcast behind a size check, beyond it both sides are
    dealt by (level, cell). ``cover`` takes the result of ``quadtree_cover`` where it is at hand.
    """
    square, cells = cover or quadtree_cover(vertices)
    if square is None:
        return points.select("pid", F.lit(None).cast(vertices.schema["poly_id"].dataType).alias("poly_id")).where("false")
    levels = sorted(r["level"] for r in cells.select("level").distinct().collect())
    cells = sized_broadcast(cells, max_rows)[0]
    at = [square.address(F.col("px"), F.col("py"), lvl) for lvl in levels]
    keys = F.array(*(F.struct(F.lit(lvl).alias("level"), x.alias("cx"), y.alias("cy")) for lvl, (x, y) in zip(levels, at)))
    p = points.select("pid", "px", "py", F.inline(keys))
    found = p.join(cells, ["level", "cx", "cy"])
    hit = F.col("edges").isNull() | (inside_boundary_cell(F.col("px"), F.col("py"), square) == 1)
    return found.where(hit).select("pid", "poly_id").distinct()


def haversine_m(lon1: Column, lat1: Column, lon2: float, lat2: float) -> Column:
    p1 = F.radians(lat1)
    s1 = F.sin((F.lit(math.radians(lat2)) - p1) / 2.0)
    s2 = F.sin((F.lit(math.radians(lon2)) - F.radians(lon1)) / 2.0)
    a = s1 * s1 + F.cos(p1) * F.lit(math.cos(math.radians(lat2))) * s2 * s2
    return F.lit(2.0 * EARTH_RADIUS_M) * F.asin(F.sqrt(a))


def radius_filter(points: DataFrame, lon: float, lat: float, miles: float) -> DataFrame:
    """Points within ``miles`` of (lon, lat) on the sphere: ``(pid, dist_m)``.

    A lat/lon box that contains the circle is applied first (cheap, and
    pushable to storage when lon/lat are stored columns). Longitudes are in
    [-180, 180]; a box across the antimeridian is two ranges, and a circle that
    reaches a pole has no bound on longitude.
    """
    r = miles * METERS_PER_MILE
    angle, slack = r / EARTH_RADIUS_M, 1e-9  # slack: rounding must not cut the box below the circle
    dlat = math.degrees(angle) + slack
    inside = F.col("lat").between(max(-90.0, lat - dlat), min(90.0, lat + dlat))
    if abs(lat) + dlat < 90.0:
        dlon = math.degrees(math.asin(min(1.0, math.sin(angle) / math.cos(math.radians(lat))))) + slack
        west, east = lon - dlon, lon + dlon
        near = F.col("lon").between(west, east)
        if west < -180.0:
            near = near | (F.col("lon") >= west + 360.0)
        if east > 180.0:
            near = near | (F.col("lon") <= east - 360.0)
        inside = inside & near
    d = points.filter(inside).select("pid", haversine_m(F.col("lon"), F.col("lat"), lon, lat).alias("dist_m"))
    return d.filter(F.col("dist_m") <= r)


def clip_extent_max(cells: DataFrame, extent: tuple[int, int, int, int] | None = None,
                    max_value: float | None = None) -> DataFrame:
    """Cells inside a half-open cell extent (x0, y0, x1, y1) and, when set, with v <= max_value."""
    out = cells
    if extent is not None:
        x0, y0, x1, y1 = extent
        out = out.filter((F.col("x") >= x0) & (F.col("x") < x1) & (F.col("y") >= y0) & (F.col("y") < y1))
    if max_value is not None:
        out = out.filter(F.col("v") <= max_value)
    return out
