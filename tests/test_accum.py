"""Accumulator path must equal the full cross-tab."""

import random

import pytest
from pyspark.sql import functions as F

from gridzone.operators import accum, vector, zonal
from gridzone.sources.polygons import TEST_POLYGONS, vertices_df

from .test_vector import _random_polygon


def _layers(spark, w, h, seed):
    rng = random.Random(seed)
    a, b = [], []
    for x in range(w):
        for y in range(h):
            if rng.random() > 0.1:
                a.append((x, y, rng.randrange(16)))
            if rng.random() > 0.15:
                b.append((x, y, rng.randrange(4)))
    sch = "x bigint, y bigint, v bigint"
    return spark.createDataFrame(a, sch), spark.createDataFrame(b, sch)


def _as_set(df):
    return {(r.poly_id, r.a, r.b, r.n) for r in df.collect()}


@pytest.mark.parametrize("tile", [4, 7, 16, 64, 70, 130])
def test_accum_equals_full_crosstab(spark, tile):
    W, H = 40, 37 if tile < 64 else 150  # no multiple of the tile
    la, lb = _layers(spark, W, H, 11)
    rng = random.Random(tile)
    polys = {
        "r1": [[_random_polygon(rng, 8, 20, 18, 19)]],
        "r2": [[_random_polygon(rng, 6, 12, 12, 10), _random_polygon(rng, 4, 12, 12, 3)]],
        "edge": [[[(-5.0, -3.0), (45.0, -2.0), (44.0, 160.0), (-4.0, 151.0)]]],  # covers the grid and beyond
    }
    verts = vertices_df(spark, polys)
    full = zonal.zonal_crosstab(la, lb, zonal.zone(verts, W, H, 8), 8)
    pairs = accum.overlay_pairs(la, lb)
    ranks = accum.rank_bitmaps(pairs, H, tile)
    fast = accum.zonal_crosstab_accum(ranks, vector.polygon_spans(verts, W, H), tile)
    assert _as_set(fast) == _as_set(full)


def test_pairs_with_one_side_missing(spark):
    """Both methods against a count over every cell; a NULL value is a missing side, two missing sides are no pair."""
    W, H = 20, 150
    la, lb = _layers(spark, W, H, 5)
    la = la.unionByName(spark.createDataFrame([(3, 200, None)], la.schema))
    verts = vertices_df(spark, {"box": [[[(2.0, 3.0), (17.0, 3.0), (17.0, 140.0), (2.0, 140.0)]]]})
    a, b = ({(r.x, r.y): r.v for r in df.collect()} for df in (la, lb))
    want = {}
    for cell in set(a) | set(b):
        if 2 <= cell[0] < 17 and 3 <= cell[1] < 140:
            pair = (a.get(cell), b.get(cell))
            want[pair] = want.get(pair, 0) + 1
    want = {("box", x, y, n) for (x, y), n in want.items()}
    assert any(r[1] is None for r in want) and any(r[2] is None for r in want)
    assert _as_set(zonal.zonal_crosstab(la, lb, zonal.zone(verts, W, H, 8), 8, one_sided=True)) == want
    ranks = accum.rank_bitmaps(accum.overlay_pairs(la, lb, one_sided=True).filter(f"y < {H}"), H, 64)
    assert _as_set(accum.zonal_crosstab_accum(ranks, vector.polygon_spans(verts, W, H), 64)) == want


def test_prefix_table_is_dense_and_monotone(spark):
    la, lb = _layers(spark, 12, 30, 3)
    pairs = accum.overlay_pairs(la, lb)
    p = accum.block_prefix_counts(accum.rank_bitmaps(pairs, 30, 16), 8, 30, 16).collect()
    by = {}
    for r in p:
        by.setdefault((r.x, r.a, r.b), []).append((r.blk, r.cum))
    for key, rows in by.items():
        rows.sort()
        blks = [b for b, _ in rows]
        assert blks == list(range(blks[0], 4))  # dense to the last block (ceil(30 / 8) = 4)
        cums = [c for _, c in rows]
        assert cums == sorted(cums)
    # last block of every (x, pair) holds the column total of that pair
    tot = {(r.x, r.a, r.b): r["count"] for r in pairs.groupBy("x", "a", "b").count().collect()}
    assert {k: v[-1][1] for k, v in ((k, sorted(v)) for k, v in by.items())} == tot


def test_empty_zone_gives_no_rows(spark):
    la, lb = _layers(spark, 10, 10, 5)
    verts = vertices_df(spark, {"outside": TEST_POLYGONS["outside"]})
    pairs = accum.overlay_pairs(la, lb)
    res = accum.zonal_crosstab_accum(accum.rank_bitmaps(pairs, 10, 8), vector.polygon_spans(verts, 10, 10), 8)
    assert res.count() == 0
    assert zonal.zonal_crosstab(la, lb, zonal.zone(verts, 10, 10, 4), 4).count() == 0


def test_telescoping_literal_variant(spark):
    """The literal marching sum is last - first of the visited data values (trap 2)."""
    seq = spark.createDataFrame(
        [(0, 0, 0, 0, 5), (0, 1, 0, 1, None), (0, 2, 0, 2, 9), (0, 3, 0, 3, 2), (1, 0, 16, 0, 7), (1, 1, 16, 1, 1)],
        "key_col bigint, ord bigint, x bigint, y bigint, v bigint",
    )
    r = accum.boundary_last_minus_first(seq).collect()
    assert len(r) == 64 and {row.n for row in r} == {(2 - 5) + (1 - 7)}
    d = {row.key_col: row.sum_diff for row in accum.boundary_diffs(seq).collect()}
    assert d == {0: 2 - 5, 1: 1 - 7}
    filled = {row.ord: row.last_seen for row in accum.last_seen_fill(seq).filter("key_col = 0").collect()}
    assert filled == {0: None, 1: 5, 2: 5, 3: 9}


def test_band_vectors_sum_to_crosstab(spark):
    la, lb = _layers(spark, 20, 20, 9)
    pairs = accum.overlay_pairs(la, lb)
    vec = accum.band_vectors(pairs, 4)
    assert all(len(r.vec) == 64 for r in vec.collect())
    s = {(r.a, r.b): r.n for r in accum.band_vector_sum(vec).collect() if r.n}
    want = {(r.a, r.b): r["count"] for r in pairs.groupBy("a", "b").count().collect()}
    assert s == want
    assert pairs.filter(F.col("a") * 4 + F.col("b") > 63).count() == 0


def test_shuffle_fallback_when_spans_exceed_broadcast_limit(spark):
    """max_rows=0 forces the shuffle join on (x, blk); results must not change."""
    W, H = 30, 30
    la, lb = _layers(spark, W, H, 21)
    verts = vertices_df(spark, {"hole": [[[(x * 30 / 128, y * 30 / 128) for x, y in r] for r in TEST_POLYGONS["hole"][0]]]})
    z_b = zonal.zone(verts, W, H, 8)
    z_s = zonal.zone(verts, W, H, 8, max_rows=0)
    assert z_b.rows == z_s.rows > 0
    plan = z_s.pieces._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in plan.lower()
    assert _as_set(zonal.zonal_crosstab(la, lb, z_s, 8)) == _as_set(zonal.zonal_crosstab(la, lb, z_b, 8))
    pairs = accum.overlay_pairs(la, lb)
    spans = vector.polygon_spans(verts, W, H)
    assert _as_set(accum.zonal_crosstab_accum(accum.rank_bitmaps(pairs, H, 16), spans, 16, max_rows=0)) == \
        _as_set(zonal.zonal_crosstab(la, lb, z_b, 8))


def test_tile_partitioned_stores_prune_and_agree(spark):
    """Stored, z-partitioned layers: both methods read pruned tiles and equal the full count."""
    import tempfile

    from gridzone.session import ensure_checkpoint_dir

    W = H = 32
    T = 8
    la, lb = _layers(spark, W, H, 31)
    from gridzone.plans.ingest import ingest_class_layers, open_ingested

    root = tempfile.mkdtemp(prefix="tiled-", dir=ensure_checkpoint_dir(spark))
    st = open_ingested(spark, ingest_class_layers(la, lb, root, H, T, rank_rows=16))
    a, b = st["a"], st["b"]
    rng = random.Random(4)
    verts = vertices_df(spark, {"p": [[_random_polygon(rng, 7, 12, 14, 9)]], "q": [[_random_polygon(rng, 5, 24, 20, 6)]]})
    want = _as_set(zonal.zonal_crosstab(la, lb, zonal.zone(verts, W, H, T), T))
    z = zonal.zone(verts, W, H, T)
    tiled = zonal.zonal_crosstab_tiled(a, b, z, T)
    assert _as_set(tiled) == want
    fast = accum.zonal_crosstab_accum(st["ranks"], vector.polygon_spans(verts, W, H), 16, stored_tile=T)
    assert _as_set(fast) == want
    for df in (tiled, fast):
        assert "dynamicpruning" in df._jdf.queryExecution().executedPlan().toString().lower()


def test_adaptive_block_keeps_pieces_under_the_limit(spark):
    """A big zone on a big grid gets long blocks instead of millions of pieces; results unchanged."""
    W, H = 40, 37
    la, lb = _layers(spark, W, H, 41)
    verts = vertices_df(spark, {"big": [[[(-1.0, -1.0), (41.0, -1.0), (41.0, 38.0), (-1.0, 38.0)]]]})
    small = zonal.zone(verts, W, H, max_rows=100)  # 40 spans of 37 rows: 1480 cells
    assert small.block > zonal.DEFAULT_BLOCK or small.rows <= 100
    assert small.rows <= 100 and "broadcast" in small.pieces._jdf.queryExecution().analyzed().toString().lower()
    pieces = small.pieces.count()
    assert pieces <= small.rows  # the bound holds
    fixed = zonal.zone(verts, W, H, 4)
    assert _as_set(zonal.zonal_crosstab(la, lb, small)) == _as_set(zonal.zonal_crosstab(la, lb, fixed))


def test_one_entry_per_cell_at_most_and_full_words(spark):
    """Every bit of a word, the sign bit too; no more entries than pairs in a column and tile, nor than cells."""
    cells = [(x, y, (y * 7 + x) % 16, (y // 3) % 4) for x in range(3) for y in range(128)]
    pairs = spark.createDataFrame(cells, "x bigint, y bigint, a bigint, b bigint")
    for tile in (64, 128):
        ranks = accum.rank_bitmaps(pairs, 128, tile)
        assert ranks.agg(F.sum(F.size("entries"))).first()[0] <= len(cells)
    spans = spark.createDataFrame([(f"e{e}", x, 0, e) for e in range(1, 129) for x in range(3)], "poly_id string, x bigint, r0 bigint, r1 bigint")
    got = _as_set(accum.zonal_crosstab_accum(accum.rank_bitmaps(pairs, 128, 128), spans, 128))
    want = {}
    for e in range(1, 129):
        for x, y, a, b in cells:
            if y < e:
                want[(f"e{e}", a, b)] = want.get((f"e{e}", a, b), 0) + 1
    assert got == {(*k, n) for k, n in want.items()}


def test_a_thousand_stacked_polygons_join_each_cell_once(spark):
    """Disjoint pieces of all polygons: join output = distinct cells, counts = those of every polygon alone."""
    W = H = 48
    la, lb = _layers(spark, W, H, 17)
    rng = random.Random(23)
    polys = {f"p{i}": [[[(x0, y0), (x1, y0 + 1.5), (x1 - 2.0, y1), (x0 + 0.5, y1)]]]
             for i in range(1000) for x0, y0, x1, y1 in [(rng.uniform(-2, 20), rng.uniform(-2, 20), rng.uniform(24, 50), rng.uniform(24, 50))]}
    polys["twice"] = [[[(5, 5), (15, 5), (15, 15), (5, 15)]], [[(10, 10), (20, 10), (20, 20), (10, 20)]]]
    spans = vector.polygon_spans(vertices_df(spark, polys), W, H).checkpoint()
    atoms, members = vector.span_atoms(spans)
    held = zonal.cells_in_atoms(zonal.data_cells(la), atoms, 16)
    inside = {}
    for r in spans.collect():
        for y in range(r.r0, r.r1):
            inside.setdefault((r.x, y), set()).add(r.poly_id)
    a = {(r.x, r.y): r.v for r in la.collect()}
    rows = held.collect()
    assert len(rows) == len({(r.x, r.y) for r in rows}) == len(a.keys() & inside.keys())
    sets = {}
    for r in members.collect():
        sets.setdefault((r.s1, r.s2), set()).add(r.poly_id)
    assert all(sets[(r.s1, r.s2)] == inside[(r.x, r.y)] for r in rows)
    few = spans.filter("poly_id IN ('twice', 'p1', 'p2', 'p500')")
    want = _as_set(zonal.zonal_crosstab(la, lb, zonal.zone(vertices_df(spark, {k: polys[k] for k in ("twice", "p1", "p2", "p500")}), W, H, 16), 16))
    assert _as_set(zonal.zonal_crosstab_atoms(la, lb, few, 16)) == want == _as_set(zonal.zonal_crosstab_atoms(la, lb, few, 16, max_rows=0))
