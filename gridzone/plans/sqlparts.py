"""SQL building blocks for the DuckDB oracle (independent formulations).

The oracle decides zone membership by brute force (even-odd count of crossings
above each cell centre) instead of spans, so it checks the span rasteriser
rather than repeating it.
"""

from __future__ import annotations

from gridzone.sources.polygons import FIXTURE_GRID, TEST_POLYGONS, vertex_rows
from gridzone.sources.tables import GRID_SQL


def grid() -> str:
    return f"g AS ({GRID_SQL})"


LAYERS = {
    "la": "SELECT l_orderkey % g.n AS x, l_partkey % g.n AS y, "
          "max(CAST(floor(l_quantity) AS BIGINT)) % 16 AS v FROM lineitem, g GROUP BY ALL",
    "lb": "SELECT o_orderkey % g.n AS x, o_custkey % g.n AS y, "
          "max(CAST(round(o_totalprice) AS BIGINT)) % 4 AS v FROM orders, g GROUP BY ALL",
    "lv": "SELECT l_orderkey % g.n AS x, l_partkey % g.n AS y, max(l_quantity) AS v FROM lineitem, g GROUP BY ALL",
    "lw": "SELECT o_orderkey % g.n AS x, o_custkey % g.n AS y, round(max(o_totalprice) / 1000) AS v "
          "FROM orders, g GROUP BY ALL",
    "bands": "SELECT l_orderkey % g.n AS x, l_partkey % g.n AS y, max(l_quantity) AS b0, "
             "CAST(max(l_linenumber) AS DOUBLE) AS b1, CAST(max(l_suppkey % 256) AS DOUBLE) AS b2, "
             "CAST(max(l_partkey % 256) AS DOUBLE) AS b3 FROM lineitem, g GROUP BY ALL",
    "tp": "SELECT la.x, la.y, la.v % 6 AS truth, (la.v + lb.v) % 6 AS pred_a, lb.v % 6 AS pred_b "
          "FROM la JOIN lb USING (x, y)",
    "pts": "SELECT event_id AS pid, event_type, -80.0::DOUBLE + (event_id % 997) / 997.0::DOUBLE * 5.0::DOUBLE AS lon, "
           "40.0::DOUBLE + ((user_id * 31 + event_id % 89) % 991) / 991.0::DOUBLE * 2.0::DOUBLE AS lat, value AS v "
           "FROM events",
}

# which CTEs each layer needs first
_DEPS = {"tp": ["la", "lb"]}


def layers(*names: str) -> list[str]:
    out: list[str] = []
    for n in names:
        for d in _DEPS.get(n, []):
            if d not in [o.split(" ")[0] for o in out]:
                out.append(f"{d} AS ({LAYERS[d]})")
        if n not in [o.split(" ")[0] for o in out]:
            out.append(f"{n} AS ({LAYERS[n]})")
    return out


def polygon_values(names: list[str] | None = None) -> str:
    polys = {k: v for k, v in TEST_POLYGONS.items() if names is None or k in names}
    rows = vertex_rows(polys)
    vals = ", ".join(
        f"('{p}', {a}, {b}, {c}, CAST({x!r} AS DOUBLE), CAST({y!r} AS DOUBLE))" for p, a, b, c, x, y in rows
    )
    return f"SELECT * FROM (VALUES {vals}) t(poly_id, part, ring, seq, px, py)"


def polygon_ctes(names: list[str] | None = None) -> list[str]:
    """``verts`` scaled to the grid and ``edges`` (non-degenerate, ring-closing)."""
    return [
        f"verts0 AS ({polygon_values(names)})",
        f"verts AS (SELECT poly_id, part, ring, seq, px * (CAST(g.n AS DOUBLE) / {float(FIXTURE_GRID)}::DOUBLE) AS px, "
        f"py * (CAST(g.n AS DOUBLE) / {float(FIXTURE_GRID)}::DOUBLE) AS py FROM verts0, g)",
        "edges AS (SELECT * FROM (SELECT poly_id, part, ring, px AS gx, py AS gy, "
        "coalesce(lead(px) OVER w, first_value(px) OVER w2) AS hx, "
        "coalesce(lead(py) OVER w, first_value(py) OVER w2) AS hy FROM verts "
        "WINDOW w AS (PARTITION BY poly_id, part, ring ORDER BY seq), "
        "w2 AS (PARTITION BY poly_id, part, ring ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) "
        "WHERE gx <> hx OR gy <> hy)",
    ]


def inzone(cells: str, name: str = "inz") -> str:
    """Brute-force membership: cells of ``cells`` with an odd crossing count per part."""
    return (
        f"{name} AS (SELECT DISTINCT poly_id, x, y FROM ("
        f"SELECT e.poly_id, e.part, c.x, c.y FROM {cells} c JOIN edges e "
        "ON (e.gx > c.x + 0.5::DOUBLE) <> (e.hx > c.x + 0.5::DOUBLE) "
        "WHERE e.gy + (c.x + 0.5::DOUBLE - e.gx) / (e.hx - e.gx) * (e.hy - e.gy) <= c.y + 0.5::DOUBLE "
        "GROUP BY ALL HAVING count(*) % 2 = 1))"
    )


def grid_cells() -> str:
    """Every cell of the N x N grid (oracle only: brute-force zone listing)."""
    return "allc AS (SELECT a.x, b.y FROM g, range(g.n) a(x), range(g.n) b(y))"


def boundary_sql() -> str:
    """All-touched boundary cells ``bnd(poly_id, x, y)``, same rule as the Spark operator."""
    return (
        "bcols AS (SELECT poly_id, gx, gy, hx, hy, x FROM edges, g, LATERAL generate_series("
        "CAST(greatest(floor(least(gx, hx)), 0) AS BIGINT), "
        "CAST(least(greatest(floor(least(gx, hx)), ceil(greatest(gx, hx)) - 1), g.n - 1) AS BIGINT)) t(x)), "
        "bseg AS (SELECT poly_id, x, "
        "CASE WHEN gx = hx THEN least(gy, hy) ELSE gy + (greatest(least(gx, hx), CAST(x AS DOUBLE)) - gx) / (hx - gx) * (hy - gy) END AS ya, "
        "CASE WHEN gx = hx THEN greatest(gy, hy) ELSE gy + (least(greatest(gx, hx), x + 1.0::DOUBLE) - gx) / (hx - gx) * (hy - gy) END AS yb "
        "FROM bcols), "
        "brows AS (SELECT poly_id, x, least(ya, yb) AS ylo, greatest(ya, yb) AS yhi FROM bseg), "
        "bnd AS (SELECT DISTINCT poly_id, x, y FROM brows, g, LATERAL generate_series("
        "CAST(greatest(floor(ylo), 0) AS BIGINT), "
        "CAST(least(greatest(floor(ylo), ceil(yhi) - 1), g.n - 1) AS BIGINT)) t(y))"
    )


def with_(*ctes: str | list[str]) -> str:
    flat: list[str] = []
    for c in ctes:
        flat.extend(c if isinstance(c, list) else [c])
    return "WITH " + ",\n".join(flat) + "\n"
