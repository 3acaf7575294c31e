"""Quadtree cover of polygons and the point-in-polygon join built on it."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gridzone.operators import cover
from gridzone.operators import points as P
from gridzone.sources.polygons import vertices_df


def ray_cast(polys, x, y):
    def inside(ring_parts):
        n = 0
        for ring in ring_parts:
            pts = list(ring)
            for (gx, gy), (hx, hy) in zip(pts, pts[1:] + pts[:1], strict=True):
                n += (gy > y) != (hy > y) and x < gx + (y - gy) * (hx - gx) / (hy - gy)
        return n % 2 == 1

    return {name for name, parts in polys.items() if any(inside(part) for part in parts)}


def joined(spark, polys, pts, **kw):
    pdf = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "pid bigint, px double, py double")
    return {(r.pid, r.poly_id) for r in P.pip_join(pdf, vertices_df(spark, polys), **kw).collect()}


def expected(polys, pts):
    return {(i, name) for i, (x, y) in enumerate(pts) for name in ray_cast(polys, float(x), float(y))}


def star(rng, cx, cy, r, n):
    return [(cx + r * rng.uniform(0.3, 1) * math.cos(2 * math.pi * k / n), cy + r * rng.uniform(0.3, 1) * math.sin(2 * math.pi * k / n)) for k in range(n)]


def test_random_polygons_of_all_sizes(spark):
    rng = random.Random(1)
    polys = {f"p{i}": [[star(rng, rng.uniform(0, 1000), rng.uniform(0, 1000), 10 ** rng.uniform(-1, 2.6), rng.choice([3, 5, 17, 60, 400]))]] for i in range(40)}
    polys["two"] = [[star(rng, 200, 200, 150, 30), star(rng, 200, 200, 40, 9)], [star(rng, 280, 260, 150, 12)]]  # a hole, overlapping parts
    pts = [(rng.uniform(-50, 1050), rng.uniform(-50, 1050)) for _ in range(2500)]
    pts += [(x + rng.gauss(0, 1e-7), y + rng.gauss(0, 1e-7)) for p in polys.values() for ring in p[0] for x, y in ring[:5]]  # close to vertices
    assert joined(spark, polys, pts) == expected(polys, pts)


def test_points_on_vertices_and_edges_fall_as_in_ray_casting(spark):
    rng = random.Random(2)
    polys = {
        "square": [[[(16, 16), (48, 16), (48, 48), (16, 48)]]],
        "beside": [[[(48, 16), (80, 16), (80, 48), (48, 48)]]],
        "steps": [[[(0, 0), (8, 0), (8, 8), (16, 8), (16, 16), (0, 16)]]],
        "bow": [[[(100, 0), (120, 20), (120, 0), (100, 20)]]],  # crosses itself
        "diamond": [[[(64, 0), (96, 32), (64, 64), (32, 32)]]],
    }
    pts = [(x, y) for x in range(0, 124, 4) for y in range(0, 68, 4)] + [(rng.randrange(0, 248) / 2, rng.randrange(0, 136) / 2) for _ in range(1500)]
    assert joined(spark, polys, pts) == expected(polys, pts)


def test_crowded_cells_are_split(spark, monkeypatch):
    monkeypatch.setattr(cover, "MAX_EDGES", 8)
    rng = random.Random(3)
    coast = [(1000 + 4 * math.cos(t) + rng.uniform(-0.3, 0.3), 1000 + 4 * math.sin(t) + rng.uniform(-0.3, 0.3)) for t in (math.pi * (k / 300 + 0.25) for k in range(300))]
    polys = {"coast": [[[(0, 0), (2000, 0), (2000, 900), *coast, (0, 900)]]], "small": [[star(rng, 998, 1002, 3, 90)]]}
    pts = [(rng.uniform(990, 1010), rng.uniform(990, 1010)) for _ in range(1500)] + [(rng.uniform(-100, 2100), rng.uniform(-100, 1100)) for _ in range(1000)]
    assert joined(spark, polys, pts) == expected(polys, pts)
    _, cells = cover.quadtree_cover(vertices_df(spark, polys))
    assert cells.select("level").distinct().count() > 2 and cells.agg(F.max(F.size("edges"))).first()[0] <= 8


def test_ten_thousand_polygons_without_broadcast(spark):
    rng = random.Random(4)
    polys = {f"p{i}": [[star(rng, rng.uniform(0, 500), rng.uniform(0, 500), rng.uniform(0.5, 6), rng.choice([4, 9]))]] for i in range(10_000)}
    verts = vertices_df(spark, polys).cache()
    pts = [(rng.uniform(0, 500), rng.uniform(0, 500)) for _ in range(400)]
    pdf = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "pid bigint, px double, py double")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = cover.quadtree_cover(verts)
        out = P.pip_join(pdf, verts, max_rows=0, cover=made)
        assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
        got = {(r.pid, r.poly_id) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    boxes = {n: (min(x for x, _ in p[0][0]), max(x for x, _ in p[0][0]), min(y for _, y in p[0][0]), max(y for _, y in p[0][0])) for n, p in polys.items()}
    want = set()
    for i, (x, y) in enumerate(pts):
        near = {n: polys[n] for n, (a, b, c, d) in boxes.items() if a <= x <= b and c <= y <= d}
        want |= {(i, n) for n in ray_cast(near, x, y)}
    assert got == want
    one = made[1].where("edges IS NOT NULL").groupBy(cover.CELL).agg(F.count("*").alias("n"), F.max(F.size("edges")).alias("e"))
    n, e = one.agg(F.max("n"), F.max("e")).first()
    assert n == 1 and e <= cover.MAX_EDGES


def test_no_polygons_and_no_points(spark):
    none = vertices_df(spark, {"p": [[[(0, 0), (1, 0), (1, 1)]]]}).where("false")
    pts = spark.createDataFrame([(1, 0.5, 0.5)], "pid bigint, px double, py double")
    assert P.pip_join(pts, none).collect() == []
    assert P.pip_join(pts.where("false"), vertices_df(spark, {"p": [[[(0, 0), (1, 0), (1, 1)]]]})).collect() == []


@pytest.mark.parametrize("n", [6, 300])
def test_cover_follows_the_boundary_not_the_area(spark, n):
    ring = [(1e6 + 1e5 * math.cos(2 * math.pi * k / n), 1e6 + 1e5 * math.sin(2 * math.pi * k / n)) for k in range(n)]
    _, cells = cover.quadtree_cover(vertices_df(spark, {"p": [[ring]], "far": [[[(0, 0), (1, 0), (1, 1)]]]}))
    assert cells.where("poly_id = 'p'").count() < 400 + 16 * n


def _z(c, r):
    return sum(((c >> i & 1) << 2 * i) | ((r >> i & 1) << 2 * i + 1) for i in range(20))


def test_z_intervals_hold_the_covering_tiles_and_little_else(spark):
    from gridzone.operators import vector

    rng = random.Random(6)
    w, h, tile = 500, 300, 8
    polys = {f"p{i}": [[star(rng, rng.uniform(-30, 530), rng.uniform(-30, 330), rng.uniform(3, 120), rng.choice([3, 8, 40]))]] for i in range(25)}
    polys["ring"] = [[star(rng, 250, 150, 140, 60), [(220, 120), (280, 120), (280, 180), (220, 180)]], [star(rng, 420, 60, 50, 6)]]
    polys["aligned"] = [[[(64, 64), (128, 64), (128, 128), (64, 128)]]]
    verts = vertices_df(spark, polys)
    keys = {}
    for r in vector.covering_keys(verts, w, h, tile).collect():
        keys.setdefault(r.poly_id, set()).add(_z(r.key_col, r.key_row))
    got = {}
    for r in cover.z_intervals(verts, w, h, tile, 10_000).collect():
        got.setdefault(r.poly_id, set()).update(range(r.z0, r.z1 + 1))
    assert all(k <= got[p] for p, k in keys.items())
    grid = {_z(c, r) for c in range(-(-w // tile)) for r in range(-(-h // tile))}
    assert sum(len((got[p] & grid) - keys[p]) for p in keys) <= 0.02 * sum(map(len, keys.values())) + 40  # tiles touched by a hair
    for most in (1, 5):
        rows = cover.z_intervals(verts, w, h, tile, most).collect()
        by = {}
        for r in rows:
            by.setdefault(r.poly_id, []).append((r.z0, r.z1))
        assert max(map(len, by.values())) <= most
        assert all(any(a <= z <= b for a, b in by[p]) for p, k in keys.items() for z in k)


def test_zones_far_apart_read_their_own_files(spark, monkeypatch):
    import uuid

    from gridzone.operators import zonal
    from gridzone.session import ensure_checkpoint_dir
    from gridzone.sources import catalog

    from .test_complete import _files_read

    monkeypatch.setattr(catalog, "FOLDER_BITS", 4)
    side = 256
    layer = spark.range(side * side).selectExpr(f"id % {side} as x", f"id div {side} as y", "id % 5 as v")
    path = f"{ensure_checkpoint_dir(spark)}/far-{uuid.uuid4().hex}"
    catalog.write_tiled(layer, path, 8)
    stored = catalog.read_tiled(spark, path)
    box = lambda x, y: [[(x, y), (x + 20, y), (x + 20, y + 20), (x, y + 20)]]
    corners = {"nw": [box(3.5, 3.5)], "se": [box(230.5, 230.5)]}
    files = {}
    for name in (["nw"], ["se"], ["nw", "se"]):
        verts = vertices_df(spark, {n: corners[n] for n in name})
        ranges = catalog.zone_ranges(verts, side, side, 8)
        files["+".join(name)] = _files_read(catalog.in_ranges(stored, ranges))
        z = zonal.zone(verts, side, side, 8)
        got = zonal.cells_in_zone_tiled(catalog.in_ranges(stored, ranges).withColumnRenamed("v", "a"), z, 8).count()
        assert got == 400 * len(name)
    assert files["nw+se"] == files["nw"] + files["se"] < _files_read(stored) / 4
    assert len(zonal.zone(vertices_df(spark, corners), side, side).boxes) == 2


def test_zones_of_many_ranges_cost_each_row_few_comparisons(spark, monkeypatch):
    """A ragged zone has dozens of ranges: all of them choose folders, few are compared with each row, and the cross-tab stays exact with
    pieces of several rows of tiles."""
    import uuid

    from gridzone.operators import zonal
    from gridzone.session import ensure_checkpoint_dir
    from gridzone.sources import catalog

    monkeypatch.setattr(catalog, "FOLDER_BITS", 4)
    side, tile = 128, 4
    stored, plain = {}, {}
    for name, mod in (("a", 5), ("b", 3)):
        plain[name] = spark.range(side * side).where(f"id % 7 != {mod}").selectExpr(f"id % {side} as x", f"id div {side} as y", f"id % {mod} as v")
        path = f"{ensure_checkpoint_dir(spark)}/ragged-{uuid.uuid4().hex}"
        catalog.write_tiled(plain[name], path, tile)
        stored[name] = catalog.read_tiled(spark, path)
    comb = [(2.2 + 5 * i + dx, y) for i in range(24) for dx, y in ((0, 9.3 + 4 * (i % 5)), (2.6, 118.7 - 3 * (i % 7)))]
    verts = vertices_df(spark, {"comb": [[[*comb, (122.4, 3.1), (2.2, 3.1)]]], "box": [[[(30.5, 40.5), (90.5, 40.5), (90.5, 80.5), (30.5, 80.5)]]]})
    ranges = catalog.zone_ranges(verts, side, side, tile)
    assert len(ranges) > catalog.LITERALS
    pruned = {k: catalog.in_ranges(d, ranges) for k, d in stored.items()}
    plan = pruned["a"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("z#") < 4 * catalog.LITERALS + 8
    inside = [r.z for r in stored["a"].select("z").distinct().collect() if any(a <= r.z <= b for a, b in ranges)]
    assert set(inside) <= {r.z for r in pruned["a"].select("z").distinct().collect()}

    rows = lambda df: sorted((r.poly_id, r.a, r.b, r.n) for r in df.collect())
    want = rows(zonal.zonal_crosstab(plain["a"], plain["b"], zonal.zone(verts, side, side)))
    pieces = []
    for block in (tile, 2 * tile, 4 * tile, zonal.tiled_blocks(tile)):
        z = zonal.zone(verts, side, side, block)
        pieces.append(z.pieces.count())
        assert rows(zonal.zonal_crosstab_tiled(pruned["a"], pruned["b"], z, tile)) == want
    assert pieces[0] > pieces[1] > pieces[2] == pieces[3]
    assert zonal.zone(verts, side, side, [4, 8, 16], max_rows=10**6).block == 4
    assert zonal.zone(verts, side, side, [4, 8, 16], max_rows=z.rows).block == 16
    by_shuffle = zonal.zone(verts, side, side, [4, 8, 16], max_rows=1)
    assert by_shuffle.block == 4 and rows(zonal.zonal_crosstab_tiled(pruned["a"], pruned["b"], by_shuffle, tile)) == want
    for block in (tile - 1, 3 * tile, 8 * tile):
        with pytest.raises(ValueError):
            zonal.cells_in_zone_tiled(stored["a"], zonal.zone(verts, side, side, block), tile)
