"""Rasterisation: golden values, brute-force equivalence, edge cases."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gridzone.functions import crs
from gridzone.operators import vector
from gridzone.sources.polygons import (
    EXAMPLE_POLYGON_AREA_M2, EXAMPLE_POLYGON_CELLS, EXAMPLE_POLYGON_LONLAT, HAND_DRAWN_POLYGON_AREA_M2,
    HAND_DRAWN_POLYGON_CELLS, HAND_DRAWN_POLYGON_LONLAT, TEST_POLYGONS, geojson_vertices, to_geojson_polygon_text,
    vertices_df,
)


def _inside(parts, x, y):
    """Even-odd per part at the cell centre, parts unioned (same rule as the oracle)."""
    cx, cy = x + 0.5, y + 0.5
    for rings in parts:
        k = 0
        for ring in rings:
            pts = list(ring) + [ring[0]]
            for (gx, gy), (hx, hy) in zip(pts, pts[1:]):
                if (gx > cx) != (hx > cx):
                    yy = gy + (cx - gx) / (hx - gx) * (hy - gy)
                    if yy <= cy:
                        k += 1
        if k % 2:
            return True
    return False


def _random_polygon(rng, n, cx, cy, r):
    pts = []
    for i in range(n):
        a = 2 * math.pi * i / n + rng.uniform(-0.2, 0.2)
        rr = r * rng.uniform(0.3, 1.0)
        pts.append((round(cx + rr * math.cos(a), 3), round(cy + rr * math.sin(a), 3)))
    return pts


@pytest.mark.parametrize("ring,area_m2,cells", [
    (EXAMPLE_POLYGON_LONLAT, EXAMPLE_POLYGON_AREA_M2, EXAMPLE_POLYGON_CELLS),
    (HAND_DRAWN_POLYGON_LONLAT, HAND_DRAWN_POLYGON_AREA_M2, HAND_DRAWN_POLYGON_CELLS),
])
def test_golden_polygon_area_and_cells(spark, ring, area_m2, cells):
    """Albers area equals the reference's recorded value; the 30 m cell count (sum of
    span lengths, no cell listing) matches an independent scan-line count."""
    v = vertices_df(spark, {"ex": [[ring]]})
    x, y = crs.albers_xy(F.col("px"), F.col("py"))
    va = v.select("poly_id", "part", "ring", "seq", x.alias("px"), y.alias("py"))
    area = vector.polygon_area(va).first()["area"]
    assert abs(area - area_m2) / area_m2 < 1e-9
    cx, cy = crs.to_cell_units(F.col("px"), F.col("py"))
    vc = va.select("poly_id", "part", "ring", "seq", cx.alias("px"), cy.alias("py"))
    spans = vector.polygon_spans(vc, 161280, 104448)
    assert vector.zone_cell_count(spans).first()["n_cells"] == cells
    # cell count x cell area agrees with the planar area to 0.1 %
    assert abs(cells * 900 - area) / area < 1e-3


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_spans_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    W = H = 48
    polys = {
        "p": [[_random_polygon(rng, 9, 24, 24, 26)]],
        "h": [[_random_polygon(rng, 7, 20, 22, 18), _random_polygon(rng, 5, 20, 22, 5)]],
        "m": [[_random_polygon(rng, 5, 10, 10, 8)], [_random_polygon(rng, 6, 36, 36, 9)]],
    }
    spans = vector.polygon_spans(vertices_df(spark, polys), W, H)
    got = {(r.poly_id, r.x, r.y) for r in vector.polygon_cells(spans).collect()}
    want = {(p, x, y) for p, parts in polys.items() for x in range(W) for y in range(H) if _inside(parts, x, y)}
    assert got == want


def test_fixture_polygon_sizes(spark):
    spans = vector.polygon_spans(vertices_df(spark, TEST_POLYGONS), 128, 128)
    sizes = {r.poly_id: r.n_cells for r in vector.zone_cell_count(spans).collect()}
    # cells in zone under the centre rule (FIXTURES.md)
    assert sizes["hole"] == 6715
    assert sizes["two_parts"] == 1182 + 979
    assert sizes["thin"] == 92
    assert sizes["aligned"] == 1024
    assert "outside" not in sizes  # empty zone: no rows


def _seg_hits_open_cell(g, h, x, y):
    """Does segment g-h pass through the open square (x, x+1) x (y, y+1)? (Liang-Barsky)"""
    (x0, y0), (x1, y1) = g, h
    dx, dy = x1 - x0, y1 - y0
    t0, t1 = 0.0, 1.0
    for p, q in ((-dx, x0 - x), (dx, x + 1 - x0), (-dy, y0 - y), (dy, y + 1 - y0)):
        if p == 0:
            if q <= 0:
                return False
        else:
            t = q / p
            if p < 0:
                t0 = max(t0, t)
            else:
                t1 = min(t1, t)
    return t1 - t0 > 1e-9


def test_boundary_cells_cover_every_crossed_cell(spark):
    rng = random.Random(7)
    ring = _random_polygon(rng, 11, 20, 20, 17)
    got = {(r.x, r.y) for r in vector.boundary_cells(vertices_df(spark, {"b": [[ring]]}), 40, 40).collect()}
    pts = ring + [ring[0]]
    for g, h in zip(pts, pts[1:]):
        for x in range(40):
            for y in range(40):
                if _seg_hits_open_cell(g, h, x, y):
                    assert (x, y) in got, (g, h, x, y)


def test_geojson_polygon_multipolygon_feature(spark):
    poly = to_geojson_polygon_text(TEST_POLYGONS["hole"])
    multi = to_geojson_polygon_text(TEST_POLYGONS["two_parts"])
    feat = '{"type":"Feature","properties":{},"geometry":' + poly + "}"
    df = spark.createDataFrame([("a", poly), ("b", multi), ("c", feat)], "poly_id string, geojson string")
    v = geojson_vertices(df)
    counts = {(r.poly_id, r.part, r.ring): r["count"] for r in v.groupBy("poly_id", "part", "ring").count().collect()}
    assert counts == {("a", 0, 0): 7, ("a", 0, 1): 4, ("b", 0, 0): 5, ("b", 1, 0): 4, ("c", 0, 0): 7, ("c", 0, 1): 4}
    a = {r.poly_id: r.area for r in vector.polygon_area(v).collect()}
    assert a["a"] == pytest.approx(a["c"]) and a["a"] > 0


def test_covering_keys_contain_zone_and_boundary_tiles(spark):
    verts = vertices_df(spark, {"hole": TEST_POLYGONS["hole"]})
    keys = {(r.key_col, r.key_row) for r in vector.covering_keys(verts, 128, 128, 16).collect()}
    cells = vector.polygon_cells(vector.polygon_spans(verts, 128, 128))
    need = {(r.x // 16, r.y // 16) for r in cells.collect()}
    need |= {(r.x // 16, r.y // 16) for r in vector.boundary_cells(verts, 128, 128).collect()}
    assert keys == need


@pytest.mark.parametrize("name,parts", [
    ("vertex_on_centre", [[[(2.5, 2.5), (9.5, 2.5), (9.5, 9.5), (5.5, 12.5), (2.5, 9.5)]]]),
    ("hole_touching_vertex", [[[(1.0, 1.0), (15.0, 1.0), (15.0, 15.0), (1.0, 15.0)],
                               [(1.0, 1.0), (8.0, 4.5), (4.5, 8.0)]]]),
    ("vertical_edges", [[[(3.0, 1.2), (3.0, 13.7), (11.0, 13.7), (11.0, 6.5), (7.0, 6.5), (7.0, 1.2)]]]),
    ("bowtie", [[[(1.0, 1.0), (14.0, 14.0), (14.0, 1.0), (1.0, 14.0)]]]),
    ("beyond_grid", [[[(-6.3, 4.1), (21.7, -3.3), (22.4, 19.9)]]]),
])
def test_edge_cases_equal_brute_force(spark, name, parts):
    W = H = 16
    spans = vector.polygon_spans(vertices_df(spark, {name: parts}), W, H)
    got = {(r.x, r.y) for r in vector.polygon_cells(spans).collect()}
    want = {(x, y) for x in range(W) for y in range(H) if _inside(parts, x, y)}
    assert got == want
    assert all(0 <= x < W and 0 <= y < H for x, y in got)


def test_ring_and_vertex_tables_give_the_same_edges(spark):
    from gridzone.sources.polygons import geojson_rings, rings_df

    polys = {k: TEST_POLYGONS[k] for k in ("hole", "two_parts", "thin")}
    norm = lambda df: sorted(tuple(r) for r in vector.polygon_edges(df).collect())
    assert norm(rings_df(spark, polys)) == norm(vertices_df(spark, polys))
    gj = spark.createDataFrame([(k, to_geojson_polygon_text(v)) for k, v in polys.items()], "poly_id string, geojson string")
    assert norm(geojson_rings(gj)) == norm(vertices_df(spark, polys))


def test_transform_coords_on_rings_and_vertices(spark):
    from gridzone.sources.polygons import rings_df, transform_coords

    polys = {"ex": [[EXAMPLE_POLYGON_LONLAT]]}
    for df in (rings_df(spark, polys), vertices_df(spark, polys)):
        cells = transform_coords(transform_coords(df, crs.albers_xy), crs.to_cell_units)
        n = vector.zone_cell_count(vector.polygon_spans(cells, 161280, 104448)).first()["n_cells"]
        assert n == EXAMPLE_POLYGON_CELLS
        area = vector.polygon_area(transform_coords(df, crs.albers_xy)).first()["area"]
        assert abs(area - EXAMPLE_POLYGON_AREA_M2) / EXAMPLE_POLYGON_AREA_M2 < 1e-9


def test_zone_from_lonlat_on_the_albers_grid(spark):
    from gridzone.operators import zonal
    from gridzone.sources.polygons import rings_df

    z = zonal.zone_from_lonlat(rings_df(spark, {"ex": [[EXAMPLE_POLYGON_LONLAT]]}))
    x0, x1, y0, y1 = z.bbox
    assert 0 <= x0 < x1 <= zonal.ALBERS_GRID_COLS and 0 <= y0 < y1 <= zonal.ALBERS_GRID_ROWS
    assert (x1 - x0) * (y1 - y0) >= EXAMPLE_POLYGON_CELLS
    cells = z.pieces.agg(F.sum(F.col("r1") - F.col("r0"))).first()[0]
    assert cells == EXAMPLE_POLYGON_CELLS and z.pieces.count() <= z.rows
