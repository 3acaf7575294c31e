"""Focal operators, gridding, quantile breaks and point operators against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gridzone.operators import points as P
from gridzone.operators import stats, terrain
from gridzone.sources.polygons import TEST_POLYGONS, vertices_df

from .test_vector import _inside


def _grid(spark, w, h, seed, holes=0.15):
    rng = random.Random(seed)
    rows = [(x, y, float(rng.randrange(50))) for x in range(w) for y in range(h) if rng.random() > holes]
    return spark.createDataFrame(rows, "x bigint, y bigint, v double"), {(x, y): v for x, y, v in rows}


@pytest.mark.parametrize("tile", [3, 4, 16])
def test_focal_mean_matches_brute_force(spark, tile):
    df, cells = _grid(spark, 13, 11, tile)
    got = {(r.x, r.y): (round(r.mean, 9), r.n) for r in terrain.focal_mean(df, tile).collect()}
    want = {}
    for (x, y) in cells:
        vals = [cells[(x + dx, y + dy)] for dx in (-1, 0, 1) for dy in (-1, 0, 1) if (x + dx, y + dy) in cells]
        want[(x, y)] = (round(sum(vals) / len(vals), 9), len(vals))
    assert got == want


def test_hillshade_flat_and_slope(spark):
    flat = spark.createDataFrame([(x, y, 10.0) for x in range(6) for y in range(6)], "x bigint, y bigint, v double")
    hs = {(r.x, r.y): r.hs for r in terrain.hillshade(flat, 4).collect()}
    assert len(hs) == 36  # edge cells too
    assert all(abs(v - 255 * math.cos(math.radians(45))) < 1e-9 for v in hs.values())
    # a surface rising to the east faces west, towards a NW sun: brighter than one rising to the west
    east = spark.createDataFrame([(x, y, 30.0 * x) for x in range(5) for y in range(5)], "x bigint, y bigint, v double")
    west = spark.createDataFrame([(x, y, -30.0 * x) for x in range(5) for y in range(5)], "x bigint, y bigint, v double")
    e = terrain.hillshade(east, 4).agg(F.avg("hs")).first()[0]
    w = terrain.hillshade(west, 4).agg(F.avg("hs")).first()[0]
    assert e > w


def test_pyramid_levels(spark):
    df, cells = _grid(spark, 8, 8, 2, holes=0.0)
    p = {(r.level, r.x, r.y): r.v for r in terrain.pyramid_mean(df, 2).collect()}
    assert p[(1, 0, 0)] == pytest.approx(sum(cells[(x, y)] for x in (0, 1) for y in (0, 1)) / 4)
    assert len([k for k in p if k[0] == 2]) == 4
    cls = spark.createDataFrame([(0, 0, 3), (1, 0, 3), (0, 1, 1), (1, 1, 1), (2, 0, 5)], "x bigint, y bigint, v bigint")
    m = {(r.x, r.y): r.v for r in terrain.pyramid_mode(cls, 1).collect()}
    assert m == {(0, 0): 1, (1, 0): 5}  # tie 3 vs 1 -> smallest class


def test_idw_exact_hit_and_weights(spark):
    pts = spark.createDataFrame([(2.5, 2.5, 10.0), (3.5, 2.5, 20.0)], "fx double, fy double, v double")
    g = {(r.x, r.y): r.value for r in terrain.idw_grid(pts, F.col("fx"), F.col("fy"), 1.0, 6, 6).collect()}
    assert g[(2, 2)] == 10.0 and g[(3, 2)] == 20.0          # exact hits win
    assert g[(2, 1)] == pytest.approx(10.0)                 # only the first point within radius 1


def test_class_breaks_exact(spark):
    rng = random.Random(5)
    vals = [float(rng.randrange(40)) for _ in range(997)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r.brk for r in stats.class_breaks(df, "v", 10).orderBy("i").collect()]
    s = sorted(vals)
    want = [s[math.ceil(i * len(s) / 10) - 1] for i in range(1, 11)]
    assert got == want
    r = {row.v: row.cum for row in stats.value_ranks(df, "v").collect()}
    assert r[max(vals)] == len(vals)


def test_bands_never_fall(spark):
    rng = random.Random(8)
    vals = [0.0, -0.0, 5e-324, -5e-324, 1e308, -1e308, float("inf"), float("-inf"), float("nan")]
    vals += [s * (2.0**k) * (1 + e) for k in range(-1020, 1020, 17) for e in (0, 2**-52, -(2**-53), 0.25) for s in (1, -1)]
    vals += [rng.gauss(0, 10 ** rng.uniform(-20, 20)) for _ in range(2000)] + [float(i) for i in range(-3000, 3000, 7)]
    df = spark.createDataFrame([(v,) for v in vals], "v double").select("v", stats.bands(F.col("v")).alias("b"))
    rows = df.orderBy("v").collect()
    assert all(a.b <= b.b for a, b in zip(rows, rows[1:]))
    want, run = {}, 0
    for r in rows:
        run += 1
        want[str(0.0 if r.v == 0 else r.v)] = run
    got = {str(0.0 if r.v == 0 else r.v): r.cum for r in stats.value_ranks(df, "v").collect()}
    assert got == want


def test_breaks_run_nothing_before_the_query(spark):
    df = spark.range(1000).selectExpr("id % 37 as v")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("breaks", "no jobs while a plan is built")
    try:
        b = stats.class_breaks(df, "v", 10)
        stats.classified(df, "v", b)
        assert list(jobs.getJobIdsForGroup("breaks")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert stats.class_breaks(df.where("false"), "v", 10).collect() == []


def test_pip_join_matches_brute_force(spark):
    rng = random.Random(3)
    pts = [(i, rng.uniform(-5, 130), rng.uniform(-5, 130)) for i in range(3000)]
    pdf = spark.createDataFrame(pts, "pid bigint, px double, py double")
    got = {(r.pid, r.poly_id) for r in P.pip_join(pdf, vertices_df(spark, TEST_POLYGONS)).collect()}
    assert {(r.pid, r.poly_id) for r in P.pip_join(pdf, vertices_df(spark, TEST_POLYGONS), max_rows=0).collect()} == got
    want = set()
    for pid, x, y in pts:
        for name, parts in TEST_POLYGONS.items():
            # point-in-polygon at (x, y) == centre test of the "cell" (x - 0.5, y - 0.5)
            if _inside(parts, x - 0.5, y - 0.5):
                want.add((pid, name))
    assert got == want


def test_radius_filter_matches_haversine(spark):
    rng = random.Random(9)
    pts = [(i, rng.uniform(-80, -75), rng.uniform(40, 42)) for i in range(2000)]
    pdf = spark.createDataFrame(pts, "pid bigint, lon double, lat double")
    got = {r.pid for r in P.radius_filter(pdf, -77.5, 41.0, 50).collect()}

    def hav(lon, lat):
        p1, p2 = math.radians(lat), math.radians(41.0)
        a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(-77.5 - lon) / 2) ** 2
        return 2 * P.EARTH_RADIUS_M * math.asin(math.sqrt(a))

    want = {pid for pid, lon, lat in pts if hav(lon, lat) <= 50 * P.METERS_PER_MILE}
    assert got == want and 0 < len(got) < len(pts)


def test_clip_extent_max(spark):
    df, cells = _grid(spark, 10, 10, 4)
    got = {(r.x, r.y) for r in P.clip_extent_max(df, (2, 3, 6, 8), 20.0).collect()}
    assert got == {(x, y) for (x, y), v in cells.items() if 2 <= x < 6 and 3 <= y < 8 and v <= 20.0}
    assert P.clip_extent_max(df).count() == len(cells)  # nothing set: nothing clipped


def test_deep_pyramid_with_lineage_cuts(spark):
    df, cells = _grid(spark, 16, 16, 8, holes=0.0)
    p = terrain.pyramid_mean(df, 4)  # level 3 is checkpointed
    top = p.filter("level = 4").collect()
    assert len(top) == 1 and top[0].v == pytest.approx(sum(cells.values()) / len(cells))


@pytest.mark.parametrize("radius,tile", [(2, 5), (3, 16)])
def test_focal_stats_any_radius_matches_brute_force(spark, radius, tile):
    df, cells = _grid(spark, 17, 14, radius * 10 + tile)
    got = {(r.x, r.y): (round(r.mean, 9), r.min, r.max, r.sum, r.n)
           for r in terrain.focal_stats(df, tile, radius).collect()}
    want = {}
    for (x, y) in cells:
        vals = [cells[(x + dx, y + dy)] for dx in range(-radius, radius + 1) for dy in range(-radius, radius + 1)
                if (x + dx, y + dy) in cells]
        want[(x, y)] = (round(sum(vals) / len(vals), 9), min(vals), max(vals), sum(vals), len(vals))
    assert got == want
    with pytest.raises(ValueError):
        terrain.focal_stats(df, 4, 4)


def test_weighted_overlay_rejects_out_of_range_weights(spark):
    from gridzone.operators import bands

    df, _ = _grid(spark, 4, 4, 1)
    with pytest.raises(ValueError):
        bands.weighted_overlay({"a": df}, {"a": 6})
    with pytest.raises(ValueError):
        bands.weighted_overlay({"a": df}, {"a": 0})  # nothing left once zero weights are skipped


def test_sliding_joins_equal_brute_force():
    import numpy as np

    rng = np.random.default_rng(7)
    for n, width in ((1, 1), (5, 3), (9, 9), (23, 5), (40, 31), (31, 1)):
        a = rng.integers(-50, 50, (n, 4)).astype(float)
        for join in (np.add, np.minimum, np.maximum):
            want = np.stack([join.reduce(a[i : i + width], axis=0) for i in range(n - width + 1)])
            assert np.array_equal(terrain.slide(a, width, join), want)


def test_focal_keeps_types_and_huge_values_apart(spark):
    big = 2**60 + 1
    cells = [(x, y, big if (x, y) == (0, 0) else x - y) for x in range(12) for y in range(9)] + [(20, 20, None), (-3, -2, 4)]
    df = spark.createDataFrame(cells, "x bigint, y bigint, v bigint")
    out = {(r.x, r.y): r for r in terrain.focal_stats(df, 5, 2).collect()}
    assert len(out) == 12 * 9 + 1 and dict(terrain.focal_stats(df, 5, 2).dtypes)["max"] == "bigint"
    assert out[(1, 1)].max == big and out[(11, 8)].sum == sum(x - y for x in (9, 10, 11) for y in (6, 7, 8)) and out[(-3, -2)].n == 1
    real = spark.createDataFrame([(x, 0, 1e300 if x == 0 else float("nan") if x == 40 else 0.1) for x in range(60)], "x bigint, y bigint, v double")
    sums = {r.x: r.sum for r in terrain.focal_stats(real, 16, 3).collect()}
    assert all(abs(sums[x] - 0.7) < 1e-9 for x in range(4, 37)) and all(math.isnan(sums[x]) for x in range(37, 44)) and abs(sums[59] - 0.4) < 1e-9


def test_time_does_not_grow_with_the_radius(spark):
    import time

    df = spark.range(512 * 512).selectExpr("id % 512 as x", "id div 512 as y", "cast(id * 7919 % 251 as double) as v")
    took = {}
    for radius in (1, 15, 1, 15):
        start = time.time()
        terrain.focal_stats(df, 128, radius).write.format("noop").mode("overwrite").save()
        took[radius] = time.time() - start
    assert took[15] < 3 * took[1] + 1


def test_pyramid_in_passes_equals_level_by_level(spark, monkeypatch):
    """Three levels a pass, negative keys, gaps: each level is the join of the one below."""
    monkeypatch.setattr(terrain, "LEVELS_AT_ONCE", 3)
    rng = random.Random(17)
    cells = {(x, y): rng.randrange(4) for x in range(-9, 40) for y in range(-3, 21) if rng.random() > 0.4}
    df = spark.createDataFrame([(x, y, v) for (x, y), v in cells.items()] + [(100, 100, None)], "x bigint, y bigint, v bigint")
    mean, mode = ({(r.level, r.x, r.y): r.v for r in f(df, 7).collect()} for f in (terrain.pyramid_mean, terrain.pyramid_mode))
    below_mean, below_mode = cells, cells
    for level in range(1, 8):
        groups = {}
        for (x, y), v in below_mean.items():
            groups.setdefault((x // 2, y // 2), []).append(v)
        below_mean = {k: sum(v) / len(v) for k, v in groups.items()}
        groups = {}
        for (x, y), v in below_mode.items():
            groups.setdefault((x // 2, y // 2), []).append(v)
        below_mode = {k: min(set(v), key=lambda c: (-v.count(c), c)) for k, v in groups.items()}
        assert {k[1:]: v for k, v in mode.items() if k[0] == level} == below_mode
        assert {k[1:]: pytest.approx(v) for k, v in mean.items() if k[0] == level} == below_mean
    assert {(r.x, r.y): r.v for r in terrain.pyramid_level(df, 2, "mode").collect()} == {k[1:]: v for k, v in mode.items() if k[0] == 2}
    assert terrain.pyramid_level(df, 0).count() == len(cells) + 1 and terrain.pyramid_mean(df, 0).count() == 0
