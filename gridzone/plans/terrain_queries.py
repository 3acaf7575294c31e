"""Terrain, gridding and point queries."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridzone.functions import crs
from gridzone.operators import points as P
from gridzone.operators import terrain as T
from gridzone.plans import sqlparts as S
from gridzone.plans.registry import query
from gridzone.plans.zonal_queries import ALL_POLYS
from gridzone.sources import layers as L
from gridzone.sources.polygons import FIXTURE_GRID, test_polygons
from gridzone.sources.tables import grid_size

MAX_PYRAMID = 20  # levels the oracle spells out; levels above the grid size are empty there
IDW_RADIUS = 1.5
FOCAL_TILE = 128  # side of the arrays that focal windows slide over
TILE_ZOOM = 10
RADIUS_CENTER = (-77.5, 41.0)
RADIUS_MILES = 50.0
CLIP_MAX = 30.0


def _n(spark, sf):
    return grid_size(spark, sf)


@query(
    "focal_mean",
    S.with_(S.grid(), S.layers("lv"))
    + "SELECT c.x, c.y, round(avg(nb.v), 6) AS mean, count(*) AS n FROM lv c JOIN lv nb "
      "ON nb.x BETWEEN c.x - 1 AND c.x + 1 AND nb.y BETWEEN c.y - 1 AND c.y + 1 GROUP BY c.x, c.y",
)
def focal_mean_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3 x 3 focal mean of the value layer (running joins over haloed tiles)."""
    r = T.focal_mean(L.layer_v(spark, sf_dir, _n(spark, sf_dir)), FOCAL_TILE)
    return r.withColumn("mean", F.round("mean", 6))


@query(
    "focal_stats",
    S.with_(S.grid(), S.layers("lv"))
    + "SELECT c.x, c.y, round(avg(nb.v), 6) AS mean, min(nb.v) AS min, max(nb.v) AS max, sum(nb.v) AS sum, "
      "count(*) AS n FROM lv c JOIN lv nb ON nb.x BETWEEN c.x - 2 AND c.x + 2 AND nb.y BETWEEN c.y - 2 AND c.y + 2 "
      "GROUP BY c.x, c.y",
)
def focal_stats_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5 x 5 focal mean / min / max / sum of the value layer (radius 2, tile halos of 2 cells)."""
    r = T.focal_stats(L.layer_v(spark, sf_dir, _n(spark, sf_dir)), FOCAL_TILE, 2)
    return r.withColumn("mean", F.round("mean", 6))


def _hillshade_sql() -> str:
    names = "abcdefghi"
    cases = ", ".join(
        f"coalesce(max(CASE WHEN nb.x = c.x + ({dx}) AND nb.y = c.y + ({dy}) THEN nb.v END), any_value(c.v)) AS {names[k]}"
        for k, (dx, dy) in enumerate(T.OFFSETS)
    )
    zen = math.radians(45.0)
    az = math.radians((360.0 - 315.0 + 90.0) % 360.0)
    return S.with_(
        S.grid(), S.layers("lv"),
        f"w AS (SELECT c.x, c.y, {cases} FROM lv c JOIN lv nb "
        "ON nb.x BETWEEN c.x - 1 AND c.x + 1 AND nb.y BETWEEN c.y - 1 AND c.y + 1 GROUP BY c.x, c.y)",
        f"gr AS (SELECT x, y, ((c + 2.0::DOUBLE * f + i) - (a + 2.0::DOUBLE * d + g)) / {8.0 * crs.CELL_SIZE!r}::DOUBLE AS dzdx, "
        f"((g + 2.0::DOUBLE * h + i) - (a + 2.0::DOUBLE * b + c)) / {8.0 * crs.CELL_SIZE!r}::DOUBLE AS dzdy FROM w)",
        "sa AS (SELECT x, y, atan(1.0::DOUBLE * sqrt(dzdx * dzdx + dzdy * dzdy)) AS slope, atan2(dzdy, -dzdx) AS aspect FROM gr)",
    ) + (
        f"SELECT x, y, round(greatest(255.0::DOUBLE * ({math.cos(zen)!r}::DOUBLE * cos(slope) + "
        f"{math.sin(zen)!r}::DOUBLE * sin(slope) * cos({az!r}::DOUBLE - aspect)), 0.0::DOUBLE), 3) AS hs FROM sa"
    )


@query("hillshade", _hillshade_sql())
def hillshade_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Horn hillshade (azimuth 315, altitude 45, 30 m cells) of the value layer as a DSM."""
    r = T.hillshade(L.layer_v(spark, sf_dir, _n(spark, sf_dir)), FOCAL_TILE)
    return r.withColumn("hs", F.round("hs", 3))


def _pyramid_sql() -> str:
    """All levels as a chain; class ties by rank, and one mean per level written out as sum / count."""
    ctes, rows = [], []
    for k in range(1, MAX_PYRAMID + 1):
        below_m, below_c = ("lv", "la") if k == 1 else (f"m{k - 1}", f"c{k - 1}")
        deep = f"(SELECT n FROM g) >= {2 ** k}"
        ctes.append(f"m{k} AS (SELECT x // 2 AS x, y // 2 AS y, sum(CAST(v AS DOUBLE)) / count(*) AS v FROM {below_m} WHERE {deep} GROUP BY ALL)")
        ctes.append(f"c{k} AS (SELECT x, y, v FROM (SELECT x, y, v, row_number() OVER (PARTITION BY x, y ORDER BY n DESC, v) AS nth FROM "
                    f"(SELECT x // 2 AS x, y // 2 AS y, v, count(*) AS n FROM {below_c} WHERE {deep} GROUP BY ALL)) WHERE nth = 1)")
        rows += [f"SELECT 'mean' AS kind, {k} AS level, x, y, round(v, 6) AS v FROM m{k}",
                 f"SELECT 'mode' AS kind, {k} AS level, x, y, CAST(v AS DOUBLE) AS v FROM c{k}"]
    return S.with_(S.grid(), S.layers("lv", "la"), *ctes) + " UNION ALL ".join(rows)


@query("pyramid", _pyramid_sql())
def pyramid_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every level down to one cell: mean of 2 x 2 for the value layer, mode for the class layer."""
    n = _n(spark, sf_dir)
    levels = T.pyramid_levels(n, n)
    m = T.pyramid_mean(L.layer_v(spark, sf_dir, n), levels).select(
        F.lit("mean").alias("kind"), "level", "x", "y", F.round("v", 6).alias("v"))
    c = T.pyramid_mode(L.layer_a(spark, sf_dir, n), levels).select(
        F.lit("mode").alias("kind"), "level", "x", "y", F.col("v").cast("double").alias("v"))
    return m.unionByName(c)


_PC_SQL = ("pc AS (SELECT pid, v, CAST(floor((lon - (-80.0::DOUBLE)) / 5.0::DOUBLE * CAST(g.n AS DOUBLE)) AS BIGINT) AS x, "
           "CAST(floor((42.0::DOUBLE - lat) / 2.0::DOUBLE * CAST(g.n AS DOUBLE)) AS BIGINT) AS y FROM pts, g)")


@query(
    "point_binning",
    S.with_(S.grid(), S.layers("pts"), _PC_SQL)
    + "SELECT x, y, count(*) AS n, round(avg(v), 6) AS mean, max(v) AS max FROM pc GROUP BY ALL",
)
def point_binning_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event points per grid cell: count, mean and max value."""
    n = _n(spark, sf_dir)
    pts = L.points(spark, sf_dir)
    cx, cy = L.lonlat_to_cell(F.col("lon"), F.col("lat"), n)
    return T.point_binning(pts, cx, cy).withColumn("mean", F.round("mean", 6))


@query(
    "idw_grid",
    S.with_(
        S.grid(), S.layers("pts"),
        "pf AS (SELECT v, (lon - (-80.0::DOUBLE)) / 5.0::DOUBLE * CAST(g.n AS DOUBLE) AS px, "
        "(42.0::DOUBLE - lat) / 2.0::DOUBLE * CAST(g.n AS DOUBLE) AS py, g.n AS gn FROM pts, g)",
        f"cand AS (SELECT v, px, py, cx.x, cy.y FROM pf, "
        f"LATERAL generate_series(CAST(greatest(floor(px - {math.ceil(IDW_RADIUS)}), 0) AS BIGINT), CAST(least(floor(px + {math.ceil(IDW_RADIUS)}), gn - 1) AS BIGINT)) cx(x), "
        f"LATERAL generate_series(CAST(greatest(floor(py - {math.ceil(IDW_RADIUS)}), 0) AS BIGINT), CAST(least(floor(py + {math.ceil(IDW_RADIUS)}), gn - 1) AS BIGINT)) cy(y))",
        "dd AS (SELECT x, y, v, (x + 0.5::DOUBLE - px) * (x + 0.5::DOUBLE - px) + (y + 0.5::DOUBLE - py) * (y + 0.5::DOUBLE - py) AS d2 FROM cand)",
        f"agg AS (SELECT x, y, sum(CASE WHEN d2 > 0 THEN 1.0::DOUBLE / pow(d2, 1.0::DOUBLE) END * v) AS swv, "
        "sum(CASE WHEN d2 > 0 THEN 1.0::DOUBLE / pow(d2, 1.0::DOUBLE) END) AS sw, "
        "sum(CASE WHEN d2 = 0 THEN v END) AS hit_v, count(CASE WHEN d2 = 0 THEN 1 END) AS hits, count(*) AS n "
        f"FROM dd WHERE d2 <= {IDW_RADIUS * IDW_RADIUS!r} GROUP BY ALL)",
    )
    + "SELECT x, y, round(CASE WHEN hits > 0 THEN hit_v / hits ELSE swv / sw END, 6) AS value, n FROM agg",
)
def idw_grid_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inverse-distance-weighted grid of event values (radius 1.5 cells, power 2)."""
    n = _n(spark, sf_dir)
    pts = L.points(spark, sf_dir)
    fx = (F.col("lon") - F.lit(-80.0)) / F.lit(5.0) * F.lit(float(n))
    fy = (F.lit(42.0) - F.col("lat")) / F.lit(2.0) * F.lit(float(n))
    return T.idw_grid(pts, fx, fy, IDW_RADIUS, n, n).withColumn("value", F.round("value", 6))


@query(
    "reproject_albers",
    S.with_(S.layers("pts"))
    + "SELECT pid, round({0}, 3) AS ax, round({1}, 3) AS ay FROM pts".format(*crs.albers_sql("lon", "lat")),
)
def reproject_albers_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event points (lon/lat) reprojected to EPSG:5070 metres."""
    pts = L.points(spark, sf_dir)
    ax, ay = crs.albers_xy(F.col("lon"), F.col("lat"))
    return pts.select("pid", F.round(ax, 3).alias("ax"), F.round(ay, 3).alias("ay"))


@query(
    "mercator_tile",
    S.with_(S.layers("pts"))
    + f"SELECT pid, {TILE_ZOOM} AS z, CAST(floor((lon + 180.0::DOUBLE) / 360.0::DOUBLE * {float(2 ** TILE_ZOOM)!r}::DOUBLE) AS BIGINT) AS tx, "
      f"CAST(floor((1.0::DOUBLE - ln(tan(radians(lat)) + 1.0::DOUBLE / cos(radians(lat))) / {math.pi!r}::DOUBLE) / 2.0::DOUBLE "
      f"* {float(2 ** TILE_ZOOM)!r}::DOUBLE) AS BIGINT) AS ty FROM pts",
)
def mercator_tile_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web-Mercator z/x/y tile address of every event point at zoom 10."""
    pts = L.points(spark, sf_dir)
    tx, ty = crs.mercator_tile(F.col("lon"), F.col("lat"), TILE_ZOOM)
    return pts.select("pid", F.lit(TILE_ZOOM).alias("z"), tx.alias("tx"), ty.alias("ty"))


def _lonlat_polys(spark: SparkSession) -> DataFrame:
    """Test polygons placed over the points' extent (lon -80..-75, lat 40..42)."""
    r = test_polygons(spark, FIXTURE_GRID, ALL_POLYS)
    g = float(FIXTURE_GRID)
    return r.select("poly_id", "part", "ring", F.transform("coords", lambda p: F.array(
        F.lit(-80.0) + p[0] / F.lit(g) * F.lit(5.0), F.lit(42.0) - p[1] / F.lit(g) * F.lit(2.0))).alias("coords"))


@query(
    "pip_join",
    S.with_(
        S.layers("pts"),
        f"verts0 AS ({S.polygon_values(ALL_POLYS)})",
        f"verts AS (SELECT poly_id, part, ring, seq, -80.0::DOUBLE + px / {float(FIXTURE_GRID)!r}::DOUBLE * 5.0::DOUBLE AS px, "
        f"42.0::DOUBLE - py / {float(FIXTURE_GRID)!r}::DOUBLE * 2.0::DOUBLE AS py FROM verts0)",
        S.polygon_ctes(ALL_POLYS)[2],
    )
    + "SELECT DISTINCT pid, poly_id FROM (SELECT p.pid, e.poly_id, e.part FROM pts p JOIN edges e "
      "ON (e.gy > p.lat) <> (e.hy > p.lat) WHERE p.lon < e.gx + (p.lat - e.gy) * (e.hx - e.gx) / (e.hy - e.gy) "
      "GROUP BY ALL HAVING count(*) % 2 = 1)",
)
def pip_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events inside each polygon (quadtree cover, edges of boundary cells only)."""
    pts = L.points(spark, sf_dir).select("pid", F.col("lon").alias("px"), F.col("lat").alias("py"))
    return P.pip_join(pts, _lonlat_polys(spark))


_RLON, _RLAT = (math.radians(v) for v in RADIUS_CENTER)


@query(
    "radius_filter",
    S.with_(
        S.layers("pts"),
        f"hv AS (SELECT pid, sin(({_RLAT!r}::DOUBLE - radians(lat)) / 2.0::DOUBLE) AS s1, "
        f"sin(({_RLON!r}::DOUBLE - radians(lon)) / 2.0::DOUBLE) AS s2, cos(radians(lat)) AS c1 FROM pts)",
        f"d AS (SELECT pid, {2.0 * P.EARTH_RADIUS_M!r}::DOUBLE * asin(sqrt(s1 * s1 + c1 * {math.cos(_RLAT)!r}::DOUBLE * s2 * s2)) "
        "AS dist_m FROM hv)",
    )
    + f"SELECT pid, round(dist_m, 3) AS dist_m FROM d WHERE dist_m <= {RADIUS_MILES * P.METERS_PER_MILE!r}",
)
def radius_filter_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events within 50 miles of a centre point (haversine on the sphere, box prefilter)."""
    r = P.radius_filter(L.points(spark, sf_dir), RADIUS_CENTER[0], RADIUS_CENTER[1], RADIUS_MILES)
    return r.withColumn("dist_m", F.round("dist_m", 3))


@query(
    "clip_extent_max",
    S.with_(S.grid(), S.layers("lv"))
    + f"SELECT x, y, v FROM lv, g WHERE x >= g.n // 4 AND x < 3 * g.n // 4 AND y >= g.n // 4 AND y < 3 * g.n // 4 AND v <= {CLIP_MAX}",
)
def clip_extent_max_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value layer clipped to the central quarter extent and to v <= 30."""
    n = _n(spark, sf_dir)
    return P.clip_extent_max(L.layer_v(spark, sf_dir, n), (n // 4, n // 4, 3 * n // 4, 3 * n // 4), CLIP_MAX)
