"""Quadtree cover of polygons: whole cells inside, and boundary cells that hold their own few edges.

The plane is a square cut into 2^level x 2^level cells, with a level per polygon part that
makes its cells about as long as its edges. Cells that an edge touches are boundary
cells; of the rest only the largest quadtree cells next to them are kept, so a
cover has about as many rows as the polygon has edges, whatever its area.
Whether such a cell lies inside is read off one corner: the edges that cross
the corner's vertical line above it, counted by a running sum along the line.

A point in an inside cell needs no edge. In a boundary cell it needs the
cell's edges only: walk from the point to the cell's right border and along it to the corner, and
count the edges crossed; the parity of the corner is known. Cells with
more than ``MAX_EDGES`` edges are split again, where the same walk tells the corners of their parts.

All work is on the polygon side; the edge tests are those of ray casting (an edge
meets the row of a point if exactly one of its ends is below), so points that share a coordinate with a
vertex or an edge fall as they do there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridzone.operators.vector import polygon_edges

#: Levels between a cell and its parts, deepest level, edges of a cell.
STEP, MAX_LEVEL, MAX_EDGES = 2, 24, 32
#: Cells within this distance (in cells) of an edge count as touched; grows with the edge's slope.
SLACK, SLACK_BY_SLOPE = 1e-6, 1e-7
#: Distance in cells within which an edge passes "through" the end of a walk along the row.
NEAR = 1e-4


def _power(level: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), level.cast("int"))


@dataclass
class Square:
    """The square that level 0 is: its corner and side."""

    ox: float
    oy: float
    side: float

    def cell(self, level: Column) -> Column:
        return F.lit(self.side) / _power(level)

    def line_x(self, k: Column, level: Column) -> Column:
        return F.lit(self.ox) + k * self.cell(level)

    def line_y(self, k: Column, level: Column) -> Column:
        return F.lit(self.oy) + k * self.cell(level)

    def address(self, x: Column, y: Column, level: int) -> tuple[Column, Column]:
        s = self.side / (1 << level)
        return F.floor((x - self.ox) / s), F.floor((y - self.oy) / s)


def square_around(edges: DataFrame) -> Square | None:
    """A square with room around all edges, placed so that its lines do not pass through round coordinates (one aggregate row)."""
    x0, x1, y0, y1 = edges.agg(
        F.min(F.least("gx", "hx")), F.max(F.greatest("gx", "hx")), F.min(F.least("gy", "hy")), F.max(F.greatest("gy", "hy"))).first()
    if x0 is None:
        return None
    side = max(x1 - x0, y1 - y0)
    return Square(x0 - side * 0.01618033988749895, y0 - side * 0.02718281828459045, side * 1.0523598775598299)


def with_levels(edges: DataFrame, square: Square) -> DataFrame:
    """Adds ``root`` and ``level`` of each part: a root cell is no smaller than the part, a cell is about as long as its
    edges on average, an eighth of the part at most."""
    size = F.greatest(F.max(F.greatest("gx", "hx")) - F.min(F.least("gx", "hx")), F.max(F.greatest("gy", "hy")) - F.min(F.least("gy", "hy")))
    length = F.sqrt(F.pow(F.col("hx") - F.col("gx"), F.lit(2)) + F.pow(F.col("hy") - F.col("gy"), F.lit(2)))
    parts = edges.groupBy("poly_id", "part").agg(size.alias("size"), F.avg(length).alias("edge"))
    cell = F.least(F.col("size") / 8, F.greatest("edge", F.col("size") / 4096))
    even = lambda c: (c / STEP).cast("int") * STEP
    deep = F.least(F.lit(MAX_LEVEL), F.greatest(F.lit(0), F.ceil(F.log2(F.lit(square.side) / cell))))
    root = F.least(F.col("level"), F.greatest(F.lit(0), F.floor(F.log2(F.lit(square.side) / F.col("size")))))
    parts = parts.withColumn("level", even(deep + STEP // 2)).withColumn("root", even(root))
    return edges.join(parts.select("poly_id", "part", "root", "level"), ["poly_id", "part"])


def touched(edges: DataFrame, square: Square) -> DataFrame:
    """One row per edge and cell of its ``level`` that it touches: adds ``cx, cy``. Never misses a cell; may add one that is missed by a hair."""
    s, last = square.cell(F.col("level")), _power(F.col("level")) - 1
    units = {"ux": (F.col("gx") - square.ox) / s, "uy": (F.col("gy") - square.oy) / s, "vx": (F.col("hx") - square.ox) / s, "vy": (F.col("hy") - square.oy) / s}
    e = edges.withColumns(units)
    x0, x1, y0, y1 = F.least("ux", "vx"), F.greatest("ux", "vx"), F.least("uy", "vy"), F.greatest("uy", "vy")
    e = e.withColumns({"c0": F.greatest(F.floor(x0 - SLACK), F.lit(0)), "c1": F.least(F.floor(x1 + SLACK), last)}).where("c0 <= c1")
    e = e.withColumn("cx", F.explode(F.sequence("c0", "c1")))
    slope = (F.col("vy") - F.col("uy")) / (F.col("vx") - F.col("ux"))
    at = lambda x: F.greatest(y0, F.least(y1, F.col("uy") + (x - F.col("ux")) * slope))
    steep = x1 - x0 < 1e-3
    ya, yb = at(F.greatest(x0, F.col("cx") - SLACK)), at(F.least(x1, F.col("cx") + 1 + SLACK))
    slack = SLACK + SLACK_BY_SLOPE * F.abs(slope)
    low, high = F.when(steep, y0 - SLACK).otherwise(F.least(ya, yb) - slack), F.when(steep, y1 + SLACK).otherwise(F.greatest(ya, yb) + slack)
    e = e.withColumns({"r0": F.greatest(F.floor(low), F.lit(0)), "r1": F.least(F.floor(high), last)}).where("r0 <= r1")
    return e.withColumn("cy", F.explode(F.sequence("r0", "r1"))).drop(*units, "c0", "c1", "r0", "r1")


CELL = ["poly_id", "part", "level", "cx", "cy"]


def ancestors(cells: DataFrame) -> DataFrame:
    """``cells`` (CELL, root) and the cells above them down to ``root``, each once, with the ``leaf`` level."""
    up = cells.select(*CELL, "root", F.explode(F.sequence("root", "level", F.lit(STEP))).alias("at"))
    shift = F.col("level") - F.col("at")
    return up.select(
        "poly_id", "part", F.col("at").alias("level"), F.call_function("shiftright", F.col("cx"), shift).alias("cx"), F.call_function("shiftright", F.col("cy"), shift).alias("cy"), F.col("level").alias("leaf")).distinct()


def untouched(touched_cells: DataFrame) -> DataFrame:
    """Largest cells that no edge touches below the touched ones: children of ``ancestors`` that are not among them."""
    side = 1 << STEP
    child = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(side) for j in range(side))))
    c = touched_cells.where("level < leaf").select("poly_id", "part", (F.col("level") + STEP).alias("level"), "cx", "cy", child.alias("c"))
    c = c.select("poly_id", "part", "level", (F.col("cx") * side + F.col("c.i")).alias("cx"), (F.col("cy") * side + F.col("c.j")).alias("cy"))
    return c.join(touched_cells.select(CELL), CELL, "left_anti")


def _height(x: Column, gx="gx", gy="gy", hx="hx", hy="hy") -> Column:
    gx, gy, hx, hy = (F.col(c) if isinstance(c, str) else c for c in (gx, gy, hx, hy))
    return gy + (x - gx) / (hx - gx) * (hy - gy)


def corner_parity(corners: DataFrame, edges: DataFrame, square: Square) -> DataFrame:
    """``corners`` (poly_id, part, level, kx, ky, ...) with ``odd``: 1 if the part's edges cross the vertical line above the corner an odd
    number of times. ``edges`` have root and level; their crossings with the lines of all levels between are sorted
    into each line with its corners, so nothing is compared pair by pair."""
    lines = edges.withColumn("at", F.explode(F.sequence("root", "level", F.lit(STEP))))
    s, last = square.cell(F.col("at")), _power(F.col("at"))
    k0 = F.greatest(F.floor((F.least("gx", "hx") - square.ox) / s), F.lit(0))
    k1 = F.least(F.ceil((F.greatest("gx", "hx") - square.ox) / s), last)
    lines = lines.withColumns({"k0": k0, "k1": k1}).where("k0 <= k1").withColumn("kx", F.explode(F.sequence("k0", "k1")))
    lines = lines.withColumn("x", square.line_x(F.col("kx"), F.col("at"))).where("(gx > x) <> (hx > x)")
    extra = [c for c in corners.columns if c not in ("poly_id", "part", "level", "kx")]
    none = [F.lit(None).cast(corners.schema[c].dataType).alias(c) for c in extra]
    events = lines.select("poly_id", "part", F.col("at").alias("level"), "kx", *none, _height(F.col("x")).alias("y"), F.lit(1).alias("cross"))
    asked = corners.select("poly_id", "part", "level", "kx", *extra, square.line_y(F.col("ky"), F.col("level")).alias("y"), F.lit(0).alias("cross"))
    order = Window.partitionBy("poly_id", "part", "level", "kx").orderBy("y").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return events.unionByName(asked).withColumn("odd", (F.sum("cross").over(order) % 2).cast("int")).where("cross = 0").drop("y", "cross")


def walk(px: Column, py: Column, x: Column, y: Column, edges: Column, tol: Column) -> tuple[Column, Column]:
    """(edges crossed on the way from (px, py) along its row to x and along x to y; whether a slanted edge passes too close to the bend to tell)."""
    def row(e):
        return (e["gy"] > py) != (e["hy"] > py)

    def column(e):
        return (e["gx"] > x) != (e["hx"] > x)

    def xc(e):
        return e["gx"] + (py - e["gy"]) * (e["hx"] - e["gx"]) / (e["hy"] - e["gy"])

    def yc(e):
        return _height(x, e["gx"], e["gy"], e["hx"], e["hy"])

    first = F.size(F.filter(edges, lambda e: row(e) & ((px < xc(e)) != (x < xc(e)))))
    then = F.size(F.filter(edges, lambda e: column(e) & ((py < yc(e)) != (y < yc(e)))))
    slanted = lambda e: (e["gx"] != e["hx"]) & (e["gy"] != e["hy"])
    close = F.exists(edges, lambda e: slanted(e) & ((row(e) & (F.abs(xc(e) - x) <= tol)) | (column(e) & (F.abs(yc(e) - py) <= tol))))
    return first + then, close


def inside_boundary_cell(px: Column, py: Column, square: Square) -> Column:
    """1 if (px, py), in the boundary cell of the row, lies inside the part: walks to the right border, or to the left one where an edge passes the bend.
    An edge that passes both bends runs along the point's row."""
    level, tol = F.col("level"), square.cell(F.col("level")) * NEAR
    y = square.line_y(F.col("cy") + 1, level)
    right, close = walk(px, py, square.line_x(F.col("cx") + 1, level), y, F.col("edges"), tol)
    left, close_left = walk(px, py, square.line_x(F.col("cx"), level), y, F.col("edges"), tol)
    return F.when(close & ~close_left, (left + F.col("odd_left")) % 2).otherwise((right + F.col("odd")) % 2)


def _split(cells: DataFrame, square: Square) -> tuple[DataFrame, DataFrame]:
    """Boundary cells one step down: (boundary cells, inside cells)."""
    side = 1 << STEP
    parts = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(side) for j in range(side))))
    c = cells.withColumn("c", parts).withColumns({"nx": F.col("cx") * side + F.col("c.i"), "ny": F.col("cy") * side + F.col("c.j")})
    deeper = F.col("level") + STEP
    corner = lambda k: inside_boundary_cell(square.line_x(k, deeper), square.line_y(F.col("ny") + 1, deeper), square)
    c = c.withColumns({"right": corner(F.col("nx") + 1), "left": corner(F.col("nx"))})
    c = c.select("poly_id", "part", deeper.alias("level"), F.col("nx").alias("cx"), F.col("ny").alias("cy"), F.col("right").alias("odd"), F.col("left").alias("odd_left"))
    e = cells.select("poly_id", "part", deeper.alias("level"), F.col("cx").alias("px"), F.col("cy").alias("py"), F.inline("edges"))
    own = touched(e, square).where(f"shiftright(cx, {STEP}) = px AND shiftright(cy, {STEP}) = py")
    own = own.groupBy(CELL).agg(F.collect_list(F.struct("gx", "gy", "hx", "hy")).alias("edges"))
    both = c.join(own, CELL, "left")
    return both.where("edges IS NOT NULL"), both.where("edges IS NULL AND odd = 1")


def quadtree_cover(vertices: DataFrame) -> tuple[Square | None, DataFrame | None]:
    """(square, cover) of a ring or vertex table; cover rows are (poly_id, part, level, cx, cy, odd, odd_left, edges): inside cells have no edges,
    boundary cells at most MAX_EDGES unless they meet in a point, and the parity of their upper corners' lines.

    The cover is written to the checkpoint folder: cells are split until none holds too many edges.
    """
    edges = polygon_edges(vertices)
    square = square_around(edges)
    if square is None:
        return None, None
    edges = with_levels(edges.drop("ring"), square)
    by_cell = touched(edges, square)
    boundary = by_cell.groupBy(*CELL, "root").agg(F.collect_list(F.struct("gx", "gy", "hx", "hy")).alias("edges"))
    cells = ancestors(boundary)
    asked = untouched(cells).withColumn("side", F.lit("none")).unionByName(
        boundary.select(*CELL, F.explode(F.array(F.lit("right"), F.lit("left"))).alias("side")))
    corners = asked.withColumns({"kx": F.when(F.col("side") == "left", F.col("cx")).otherwise(F.col("cx") + 1), "ky": F.col("cy") + 1})
    parity = corner_parity(corners, edges, square)
    columns = [*CELL, "odd", "odd_left", "edges"]
    inside = parity.where("side = 'none' AND odd = 1").withColumns({"odd_left": F.lit(None).cast("int"), "edges": F.lit(None).cast(boundary.schema["edges"].dataType)})
    of = lambda side: F.max(F.when(F.col("side") == side, F.col("odd")))
    refs = parity.where("side <> 'none'").groupBy(CELL).agg(of("right").alias("odd"), of("left").alias("odd_left"))
    done = inside.select(columns).unionByName(boundary.join(refs, CELL).select(columns)).checkpoint()
    full = (F.size("edges") > MAX_EDGES) & (F.col("level") + STEP <= MAX_LEVEL)
    while done.where(full).limit(1).count():
        split, more = _split(done.where(full), square)
        done = done.where(~F.coalesce(full, F.lit(False))).unionByName(split.select(columns)).unionByName(more.select(columns)).checkpoint()
    return square, done


def z_intervals(vertices: DataFrame, width: int, height: int, tile: int, most: int = 64) -> DataFrame:
    """Intervals of the tiles' Z-curve key that hold each polygon, ``(poly_id, z0, z1)`` inclusive, at most ``most`` a polygon.

    The grid's tiles are the cells of a quadtree whose touched and inside cells cover the polygon; a cell of
    any level is one interval of keys. Touching intervals are merged, then the smallest gaps between the rest are closed. The work follows the
    polygon's boundary; tiles inside are never listed.
    """
    from gridzone.operators.layout import zorder

    deepest = max(1, -(-max(width, height) // tile) - 1).bit_length()
    deepest += deepest % STEP
    square = Square(0.0, 0.0, float(tile << deepest))
    edges = polygon_edges(vertices).drop("ring").withColumns({"level": F.lit(deepest), "root": F.lit(0)})
    leaves = touched(edges, square).select(*CELL, "root").distinct()
    cells = ancestors(leaves)
    corners = untouched(cells).withColumns({"kx": F.col("cx") + 1, "ky": F.col("cy") + 1})
    inside = corner_parity(corners, edges, square).where("odd = 1")
    both = leaves.select(CELL).unionByName(inside.select(CELL))
    both = both.where((F.col("cx") * _power(deepest - F.col("level")) < -(-width // tile)) & (F.col("cy") * _power(deepest - F.col("level")) < -(-height // tile)))
    shift = (2 * (deepest - F.col("level"))).cast("int")
    z = F.call_function("shiftleft", zorder(F.col("cx"), F.col("cy")), shift)
    own = both.select("poly_id", z.alias("z0"), (z + _power(shift) - 1).alias("z1"))
    order = Window.partitionBy("poly_id").orderBy("z0", "z1")
    reach = F.max("z1").over(order.rowsBetween(Window.unboundedPreceding, -1))
    gaps = own.withColumn("gap", F.col("z0") - reach).withColumn("gap", F.coalesce("gap", F.lit(1 << 62)))
    widest = F.row_number().over(Window.partitionBy("poly_id").orderBy(F.desc("gap"), "z0"))
    starts = gaps.withColumn("start", ((F.col("gap") > 1) & (widest <= most)).cast("int"))
    runs = starts.withColumn("run", F.sum("start").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return runs.groupBy("poly_id", "run").agg(F.min("z0").alias("z0"), F.max("z1").alias("z1")).drop("run")
