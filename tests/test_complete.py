"""Results stay complete outside the fixtures: antimeridian, poles, large classes and keys, overlapping polygons."""

import math
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from gridzone.operators import accum, layout, terrain, vector, zonal
from gridzone.operators import points as P
from gridzone.session import ensure_checkpoint_dir
from gridzone.sources.polygons import vertices_df

from .test_accum import _as_set, _layers
from .test_vector import _random_polygon


def _angle(lon1, lat1, lon2, lat2):
    """Distance from unit vectors: no haversine."""
    v = [(math.cos(math.radians(b)) * math.cos(math.radians(a)), math.cos(math.radians(b)) * math.sin(math.radians(a)), math.sin(math.radians(b)))
         for a, b in ((lon1, lat1), (lon2, lat2))]
    cross = [v[0][1] * v[1][2] - v[0][2] * v[1][1], v[0][2] * v[1][0] - v[0][0] * v[1][2], v[0][0] * v[1][1] - v[0][1] * v[1][0]]
    return math.atan2(math.sqrt(sum(c * c for c in cross)), sum(a * b for a, b in zip(*v, strict=True)))


@pytest.mark.parametrize("lon,lat,miles", [(179.95, 0, 50), (-179.9, 30, 200), (-77.5, 89.95, 50), (12, -89.5, 80), (0, 0, 13000), (170, 60, 3000), (-77.5, 41, 50)])
def test_radius_filter_loses_no_point(spark, lon, lat, miles):
    rng = random.Random(miles)
    pts = [(i, rng.uniform(-180, 180), math.degrees(math.asin(rng.uniform(-1, 1)))) for i in range(1500)]
    for i in range(1500, 3000):  # near the centre
        pts.append((i, (lon + rng.uniform(-3, 3) + 180) % 360 - 180, max(-90.0, min(90.0, lat + rng.uniform(-1, 1)))))
    pts += [(9000, -179.95, 0.0), (9001, 120.0, 89.9), (9002, 180.0, 0.0), (9003, -180.0, 0.0), (9004, 0.0, 90.0), (9005, 0.0, -90.0)]
    df = spark.createDataFrame(pts, "pid bigint, lon double, lat double")
    got = {r.pid for r in P.radius_filter(df, float(lon), float(lat), miles).collect()}
    r = miles * P.METERS_PER_MILE
    d = {i: _angle(a, b, lon, lat) * P.EARTH_RADIUS_M for i, a, b in pts}
    assert {i for i, x in d.items() if x < r - 0.01} <= got <= {i for i, x in d.items() if x < r + 0.01}


def test_pyramid_mode_of_large_classes(spark):
    cells = [(0, 0, 5_000_000), (1, 0, 5_000_000), (0, 1, 1), (1, 1, 7), (2, 0, -3), (3, 0, 2**40), (2, 2, 9), (3, 3, 9), (2, 3, 2**41), (3, 2, 2**41)]
    m = {(r.x, r.y): r.v for r in terrain.pyramid_mode(spark.createDataFrame(cells, "x bigint, y bigint, v bigint"), 1).collect()}
    assert m == {(0, 0): 5_000_000, (1, 0): -3, (1, 1): 9}


def test_pyramid_goes_down_to_one_cell(spark):
    assert [terrain.pyramid_levels(w, h) for w, h in ((1, 1), (2, 1), (128, 128), (315, 204))] == [0, 1, 7, 9]
    df = spark.createDataFrame([(x, y, float(x * y)) for x in range(9) for y in range(5)], "x bigint, y bigint, v double")
    p = terrain.pyramid_mean(df, terrain.pyramid_levels(9, 5)).groupBy("level").count().collect()
    assert {r.level: r["count"] for r in p} == {1: 15, 2: 6, 3: 2, 4: 1}


def test_zorder_is_one_to_one_and_guarded(spark):
    keys = [(0, 0), (65536, 0), (131072, 65536), (2**31 - 1, 2**31 - 1), (2**31 - 1, 0), (0, 2**31 - 1), (5, 9)]
    df = spark.createDataFrame(keys, "c bigint, r bigint")
    got = [r.z for r in df.select(layout.zorder(F.col("c"), F.col("r")).alias("z")).collect()]
    want = [sum((c >> i & 1) << 2 * i | (r >> i & 1) << 2 * i + 1 for i in range(31)) for c, r in keys]
    assert got == want and len(set(got)) == len(keys)
    for bad in ((-1, 0), (0, -5), (2**31, 0)):
        with pytest.raises(Exception, match="outside"):
            spark.createDataFrame([bad], "c bigint, r bigint").select(layout.zorder(F.col("c"), F.col("r"))).collect()


def test_band_vectors_fail_on_classes_outside_their_layout(spark):
    ok = spark.createDataFrame([(0, 15, 3), (1, 0, 0)], "x bigint, a bigint, b bigint")
    assert {(r.a, r.b): r.n for r in accum.band_vector_sum(accum.band_vectors(ok, 4)).collect() if r.n} == {(15, 3): 1, (0, 0): 1}
    for a, b in ((0, 5), (20, 1), (-1, 0)):
        with pytest.raises(Exception, match="outside"):
            accum.band_vectors(spark.createDataFrame([(0, a, b)], "x bigint, a bigint, b bigint"), 4).collect()


def _stack(n, w, h, seed):
    rng = random.Random(seed)
    return {f"p{i}": [[_random_polygon(rng, 6, w / 2 + rng.uniform(-3, 3), h / 2, min(w, h) / 2 - 1)]] for i in range(n)}


def test_zone_bound_holds_for_overlapping_polygons(spark):
    for seed, (w, h, block) in enumerate([(40, 300, 16), (64, 64, 8), (30, 500, 64)]):
        z = zonal.zone(vertices_df(spark, _stack(50, w, h, seed)), w, h, block)
        assert z.pieces.count() <= z.rows
    tall = {f"t{i}": [[[(0.0, 0.0), (40.0, 0.0), (40.0, 6400.0), (0.0, 6400.0)]]] for i in range(50)}
    z = zonal.zone(vertices_df(spark, tall), 40, 6400, 64, max_rows=20_000)
    assert z.rows >= z.pieces.count() == 50 * 40 * 100 > 20_000
    assert "broadcast" not in z.pieces._jdf.queryExecution().analyzed().toString().lower()


def test_overlapping_parts_count_each_cell_once(spark):
    w = h = 32
    la, lb = _layers(spark, w, h, 8)
    square = [[(4.0, 4.0), (12.0, 4.0), (12.0, 12.0), (4.0, 12.0)]]
    shifted = [[(8.0, 6.0), (20.0, 6.0), (20.0, 15.0), (8.0, 15.0)]]
    verts = vertices_df(spark, {"same": [square, square], "over": [square, shifted, [[(1.0, 20.0), (9.0, 20.0), (5.0, 31.0)]]]})
    a, b = ({(r.x, r.y): r.v for r in df.collect()} for df in (la, lb))
    spans = vector.polygon_spans(verts, w, h)
    cells = {(r.poly_id, r.x, r.y) for r in vector.polygon_cells(spans).collect()}
    assert sum(p == "same" for p, _, _ in cells) == 64
    want = {}
    for p, x, y in cells:
        if (x, y) in a and (x, y) in b:
            want[p, a[x, y], b[x, y]] = want.get((p, a[x, y], b[x, y]), 0) + 1
    want = {(*k, n) for k, n in want.items()}
    z = zonal.zone(verts, w, h, 8)
    assert _as_set(zonal.zonal_crosstab(la, lb, z, 8)) == want
    pairs = accum.overlay_pairs(la, lb)
    assert _as_set(accum.zonal_crosstab_accum(accum.rank_bitmaps(pairs, h, 16), spans, 16)) == want
    from gridzone.plans.ingest import ingest_class_layers, open_ingested

    root = tempfile.mkdtemp(prefix="overlap-", dir=ensure_checkpoint_dir(spark))
    st = open_ingested(spark, ingest_class_layers(la, lb, root, h, 8))
    assert _as_set(zonal.zonal_crosstab_tiled(st["a"], st["b"], z, 8)) == want


def test_hillshade_has_a_value_for_every_cell(spark):
    df = spark.createDataFrame([(x, y, 50.0) for x in range(5) for y in range(4) if (x, y) != (2, 2)], "x bigint, y bigint, v double")
    hs = terrain.hillshade(df, 4).collect()
    assert len(hs) == 19
    flat = 255 * math.cos(math.radians(45))
    assert all(abs(r.hs - flat) < 1e-9 for r in hs)


def _files_read(df):
    """The scan's own count, from a run of exactly this plan."""
    run = df._jdf.queryExecution()
    run.toRdd().count()
    return run.executedPlan().collectLeaves().apply(0).metrics().apply("numFiles").value()


def test_literal_ranges_read_fewer_files(spark, monkeypatch):
    """Folders outside the covering keys' z ranges are not read, with the right cells left, whatever the size of the keys."""
    from gridzone.operators import vector as V
    from gridzone.sources import catalog

    monkeypatch.setattr(catalog, "FOLDER_BITS", 2)
    w = h = 64
    la, _ = _layers(spark, w, h, 5)
    root = f"{ensure_checkpoint_dir(spark)}/ranges-{random.random()}"
    catalog.write_layer(la, root, "a", (w, h), 4, "int64")
    stored = catalog.read_layer(spark, root, "a")
    keys = V.covering_keys(vertices_df(spark, {"p": [[[(2.0, 3.0), (13.0, 3.0), (13.0, 20.0), (2.0, 20.0)]]]}), w, h, 4)
    pruned = catalog.in_ranges(stored, catalog.z_ranges(keys, w, h, 4))
    assert 0 < _files_read(pruned) < _files_read(stored) / 3
    cells = lambda df: sorted((r.x, r.y, r.v) for r in df.collect())
    assert cells(zonal.scan_intersects(pruned, keys, 4)) == cells(zonal.scan_intersects(la, keys, 4))


def test_rank_entries_stay_below_the_cells(spark):
    """With classes in patches, as in land cover, a column and tile has few entries."""
    w, h = 16, 256
    cells = [(x, y, (y // 24 + x // 5) % 6) for x in range(w) for y in range(h)]
    layer = spark.createDataFrame(cells, "x bigint, y bigint, v bigint")
    ranks = accum.rank_bitmaps(accum.overlay_pairs(layer, layer), h, 128)
    assert ranks.count() == w * h // 128
    assert ranks.agg(F.sum(F.size("entries"))).first()[0] < len(cells) / 16
