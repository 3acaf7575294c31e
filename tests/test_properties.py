"""Property-based checks (hypothesis): arbitrary polygons, brute force as the reference."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gridzone.operators import accum, vector, zonal
from gridzone.sources.polygons import vertices_df

from .test_accum import _as_set, _layers
from .test_vector import _inside

W, H = 24, 21
# coordinates on a 0.25 grid reach cell borders and cell centres exactly; some lie outside the grid
coord = st.integers(min_value=-12, max_value=4 * 26).map(lambda v: v / 4.0)
ring = st.lists(st.tuples(coord, coord), min_size=3, max_size=9)
polygon = st.lists(ring, min_size=1, max_size=2)  # exterior (+ a "hole"; even-odd handles overlap)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(parts=st.lists(polygon, min_size=1, max_size=2))
def test_spans_match_brute_force_for_arbitrary_polygons(spark, parts):
    spans = vector.polygon_spans(vertices_df(spark, {"p": parts}), W, H)
    got = {(r.x, r.y) for r in vector.polygon_cells(spans).collect()}
    want = {(x, y) for x in range(W) for y in range(H) if _inside(parts, x, y)}
    assert got == want


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(parts=st.lists(polygon, min_size=1, max_size=2), tile=st.sampled_from([3, 8, 16, 64]))
def test_accumulator_equals_full_count_for_arbitrary_polygons(spark, parts, tile):
    la, lb = _layers(spark, W, H, 5)
    verts = vertices_df(spark, {"p": parts})
    ranks = accum.rank_bitmaps(accum.overlay_pairs(la, lb), H, tile)
    fast = accum.zonal_crosstab_accum(ranks, vector.polygon_spans(verts, W, H), tile)
    assert _as_set(fast) == _as_set(zonal.zonal_crosstab(la, lb, zonal.zone(verts, W, H)))
