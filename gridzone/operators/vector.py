"""Polygon operators on ring or vertex tables: edges, rasterisation, covering keys, area.

Coordinates are cell units: x grows east, y grows south, cell (x, y) covers
[x, x+1) x [y, y+1) and its centre is (x + 0.5, y + 0.5).

Interior rule (cell-centre test, even-odd per polygon part): for pixel column x
an edge crosses the column centre line when min(gx, hx) <= x + 0.5 < max(gx, hx);
the crossing ordinate is ``yy = gy + (x + 0.5 - gx) / (hx - gx) * (hy - gy)``.
Sorted crossings are paired (yy0, yy1) into half-open row spans
``[ceil(yy0 - 0.5), ceil(yy1 - 0.5))``: exactly the cells whose centre has an
odd number of crossings above it.

All work is on the polygon side (size bounded by vertex count and zone width),
never on the cell layers; the layers only meet spans in a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def polygon_edges(vertices: DataFrame) -> DataFrame:
    """Rings -> directed edges ``(poly_id, part, ring, gx, gy, hx, hy)``.

    Accepts a ring table ``(poly_id, part, ring, coords ARRAY<ARRAY<DOUBLE>>)``
    — each ring zipped with itself shifted by one, no shuffle — or a vertex
    table ``(poly_id, part, ring, seq, px, py)``, where each vertex meets the
    next one of its ring through a window. Either way a ring that is not
    closed is closed by wrapping to its first vertex; zero-length edges drop.
    """
    if "coords" in vertices.columns:
        c = F.col("coords")
        nxt = F.concat(F.slice(c, 2, F.size(c) - 1), F.array(c[0]))
        pairs = F.zip_with(c, nxt, lambda g, h: F.struct(
            g[0].alias("gx"), g[1].alias("gy"), h[0].alias("hx"), h[1].alias("hy")))
        return (
            vertices.select("poly_id", "part", "ring", F.inline(pairs))
            .filter((F.col("gx") != F.col("hx")) | (F.col("gy") != F.col("hy")))
        )
    w = Window.partitionBy("poly_id", "part", "ring").orderBy("seq")
    wall = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        vertices.select(
            "poly_id",
            "part",
            "ring",
            F.col("px").alias("gx"),
            F.col("py").alias("gy"),
            F.coalesce(F.lead("px").over(w), F.first("px").over(wall)).alias("hx"),
            F.coalesce(F.lead("py").over(w), F.first("py").over(wall)).alias("hy"),
        )
        .filter((F.col("gx") != F.col("hx")) | (F.col("gy") != F.col("hy")))
    )


def edge_crossings(edges: DataFrame, width: int) -> DataFrame:
    """Column-centre crossings ``(poly_id, part, x, yy)`` for columns 0..width-1."""
    lo = F.greatest(F.ceil(F.least("gx", "hx") - 0.5), F.lit(0))
    hi = F.least(F.ceil(F.greatest("gx", "hx") - 0.5) - 1, F.lit(width - 1))
    e = edges.filter(F.col("gx") != F.col("hx")).withColumn("lo", lo).withColumn("hi", hi).filter("lo <= hi")
    c = e.select("poly_id", "part", "gx", "gy", "hx", "hy", F.explode(F.sequence("lo", "hi")).alias("x"))
    yy = F.col("gy") + (F.col("x") + 0.5 - F.col("gx")) / (F.col("hx") - F.col("gx")) * (F.col("hy") - F.col("gy"))
    return c.select("poly_id", "part", "x", yy.alias("yy"))


def polygon_spans(vertices: DataFrame, width: int, height: int) -> DataFrame:
    """Interior row spans ``(poly_id, x, r0, r1)``, half-open, clipped to the grid.

    Spans of one polygon and column are disjoint: where parts overlap or touch they
    are merged, so every cell counts once.
    """
    cr = edge_crossings(polygon_edges(vertices), width)
    w = Window.partitionBy("poly_id", "part", "x").orderBy("yy")
    paired = cr.select(
        "poly_id", "x", "yy", F.row_number().over(w).alias("k"), F.lead("yy").over(w).alias("yy1")
    ).filter((F.col("k") % 2) == 1)
    r0 = F.greatest(F.ceil(F.col("yy") - 0.5), F.lit(0))
    r1 = F.least(F.ceil(F.col("yy1") - 0.5), F.lit(height))
    spans = paired.select("poly_id", "x", r0.alias("r0"), r1.alias("r1")).filter("r1 > r0")
    column = Window.partitionBy("poly_id", "x").orderBy("r0", "r1")
    reach = F.max("r1").over(column.rowsBetween(Window.unboundedPreceding, -1))
    starts = spans.withColumn("new", F.when(F.col("r0") <= reach, 0).otherwise(1))
    runs = starts.withColumn("run", F.sum("new").over(column.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return runs.groupBy("poly_id", "x", "run").agg(F.min("r0").alias("r0"), F.max("r1").alias("r1")).drop("run")


def span_pieces(spans: DataFrame, block: int) -> DataFrame:
    """Split spans at block rows: ``(poly_id, x, blk, r0, r1)`` with every piece inside one block.

    The cell join then keys on (x, blk): no long column becomes one hash bucket,
    and blk equals the tile row when block = tile size.
    """
    b = F.lit(block)
    p = spans.select(
        "poly_id", "x", "r0", "r1",
        F.explode(F.sequence(F.floor(F.col("r0") / b), F.floor((F.col("r1") - 1) / b))).alias("blk"),
    )
    return p.select(
        "poly_id",
        "x",
        "blk",
        F.greatest("r0", F.col("blk") * b).alias("r0"),
        F.least("r1", (F.col("blk") + 1) * b).alias("r1"),
    )


def span_atoms(spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Overlapping spans of any number of polygons -> disjoint pieces, (atoms, members).

    ``atoms`` (s1, s2, x, r0, r1) cover each cell of the union once; (s1, s2) names the set of polygons that hold the piece, and
    ``members`` (s1, s2, poly_id) lists each set once. A sweep down each column toggles a polygon's two hashes in a
    running exclusive-or where its span starts and ends, so a set is named without being listed; its members are read off
    one of its pieces. Spans of one polygon and column must be disjoint, as ``polygon_spans`` makes them.
    """
    ends = F.array(F.struct(F.col("r0").alias("e"), F.lit(1).alias("step")), F.struct(F.col("r1").alias("e"), F.lit(-1).alias("step")))
    events = spans.select("x", F.xxhash64("poly_id").alias("h1"), F.xxhash64(F.lit(1), F.col("poly_id")).alias("h2"), F.inline(ends))
    at = events.groupBy("x", "e").agg(F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"), F.sum("step").alias("step"))
    column = Window.partitionBy("x").orderBy("e")
    upto = column.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = at.select("x", F.col("e").alias("r0"), F.lead("e").over(column).alias("r1"), F.bit_xor("h1").over(upto).alias("s1"), F.bit_xor("h2").over(upto).alias("s2"), F.sum("step").over(upto).alias("depth"))
    atoms = runs.filter("depth > 0").select("s1", "s2", "x", "r0", "r1").checkpoint()
    one = atoms.groupBy("s1", "s2").agg(F.min_by(F.struct("x", "r0"), F.xxhash64("x", "r0")).alias("at")).select("s1", "s2", F.col("at.x").alias("ax"), F.col("at.r0").alias("ar"))
    members = spans.join(one, (F.col("x") == F.col("ax")) & (F.col("r0") <= F.col("ar")) & (F.col("ar") < F.col("r1"))).select("s1", "s2", "poly_id")
    return atoms, members


def polygon_cells(spans: DataFrame) -> DataFrame:
    """Every cell of the zone ``(poly_id, x, y)`` — for checks on small zones only."""
    return spans.select("poly_id", "x", F.explode(F.sequence("r0", F.col("r1") - 1)).alias("y")).distinct()


def zone_cell_count(spans: DataFrame) -> DataFrame:
    """Cells per zone without listing them: ``sum(r1 - r0)`` per polygon."""
    return spans.groupBy("poly_id").agg(F.sum(F.col("r1") - F.col("r0")).cast("bigint").alias("n_cells"))


def boundary_cells(vertices: DataFrame, width: int, height: int) -> DataFrame:
    """All-touched rasterisation of the rings: distinct ``(poly_id, x, y)``.

    Per edge: every pixel column from floor(min x) to ceil(max x) - 1, and in each
    column the rows between the edge's y at the clipped column ends.
    """
    e = polygon_edges(vertices)
    minx, maxx = F.least("gx", "hx"), F.greatest("gx", "hx")
    c0 = F.greatest(F.floor(minx), F.lit(0))
    c1 = F.least(F.greatest(F.floor(minx), F.ceil(maxx) - 1), F.lit(width - 1))
    cols = e.withColumn("c0", c0).withColumn("c1", c1).filter("c0 <= c1").select(
        "poly_id", "gx", "gy", "hx", "hy", F.explode(F.sequence("c0", "c1")).alias("x")
    )
    xa = F.greatest(F.least("gx", "hx"), F.col("x").cast("double"))
    xb = F.least(F.greatest("gx", "hx"), F.col("x") + 1.0)

    def y_at(xc: Column) -> Column:
        return F.col("gy") + (xc - F.col("gx")) / (F.col("hx") - F.col("gx")) * (F.col("hy") - F.col("gy"))

    vertical = F.col("gx") == F.col("hx")
    ya = F.when(vertical, F.least("gy", "hy")).otherwise(y_at(xa))
    yb = F.when(vertical, F.greatest("gy", "hy")).otherwise(y_at(xb))
    t = cols.select("poly_id", "x", F.least(ya, yb).alias("ylo"), F.greatest(ya, yb).alias("yhi"))
    r0 = F.greatest(F.floor("ylo"), F.lit(0))
    r1 = F.least(F.greatest(F.floor("ylo"), F.ceil("yhi") - 1), F.lit(height - 1))
    t = t.withColumn("r0", r0).withColumn("r1", r1).filter("r0 <= r1")
    return t.select("poly_id", "x", F.explode(F.sequence("r0", "r1")).alias("y")).distinct()


def covering_keys(vertices: DataFrame, width: int, height: int, tile: int) -> DataFrame:
    """Tile keys ``(poly_id, key_col, key_row)`` meeting the polygon: interior spans ∪ boundary."""
    pieces = span_pieces(polygon_spans(vertices, width, height), tile)
    inner = pieces.select("poly_id", F.floor(F.col("x") / tile).alias("key_col"), F.col("blk").alias("key_row"))
    edge = boundary_cells(vertices, width, height).select(
        "poly_id", F.floor(F.col("x") / tile).alias("key_col"), F.floor(F.col("y") / tile).alias("key_row")
    )
    return inner.unionByName(edge).distinct()


def boundary_keys(vertices: DataFrame, width: int, height: int, tile: int) -> DataFrame:
    """Tile keys meeting the polygon rings only (the boundary read of the accumulator)."""
    return (
        boundary_cells(vertices, width, height)
        .select("poly_id", F.floor(F.col("x") / tile).alias("key_col"), F.floor(F.col("y") / tile).alias("key_row"))
        .distinct()
    )


def polygon_area(vertices: DataFrame) -> DataFrame:
    """Planar shoelace area per polygon, holes subtracted: ``(poly_id, area)``."""
    e = polygon_edges(vertices)
    rings = e.groupBy("poly_id", "part", "ring").agg(
        (F.abs(F.sum(F.col("gx") * F.col("hy") - F.col("hx") * F.col("gy"))) / 2.0).alias("a")
    )
    signed = F.when(F.col("ring") == 0, F.col("a")).otherwise(-F.col("a"))
    return rings.groupBy("poly_id").agg(F.sum(signed).alias("area"))
