"""Zonal operators: overlay of aligned layers and per-polygon aggregation.

Plan shape (per query): polygon -> span pieces (small; broadcast when a proven
bound is under the limit) -> both layers filtered by the zone's bounding box ->
cells of the first layer inside the zone (broadcast range join, no shuffle) ->
equi-join with the second layer on (x, y) -> partial + final aggregation.
Layers coming out of ``groupBy(x, y)`` are already hash-partitioned on (x, y),
so the overlay join adds no exchange for them. Stored layers partitioned by
tile key use the ``*_tiled`` variants, which read only the zone's tiles.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridzone.operators.joins import BROADCAST_MAX_ROWS, sized_broadcast
from gridzone.operators.joins import cells_in_zone as _cells_in_zone
from gridzone.operators.vector import polygon_edges, polygon_spans, span_atoms, span_pieces

DEFAULT_BLOCK = 64
#: Parts whose boxes are told apart when layers are filtered; beyond, one box around all.
MOST_BOXES = 32


@dataclass
class Zone:
    """Span pieces of a set of polygons plus what one small job learnt about them.

    ``rows`` is a proven upper bound on the number of pieces; ``pieces`` is
    broadcast when it is under the limit. ``block`` is the piece height in rows;
    ``bbox`` = (x0, x1, y0, y1), half-open, bounds every zone cell (None: empty), and
    ``boxes`` do so part by part where there are at most ``MOST_BOXES`` parts.
    """

    pieces: DataFrame
    rows: int
    bbox: tuple[int, int, int, int] | None
    block: int = DEFAULT_BLOCK
    boxes: tuple[tuple[int, int, int, int], ...] = ()

    def restrict(self, cells: DataFrame) -> DataFrame:
        """Literal x/y range filter: Catalyst moves it below layer aggregations and
        into parquet row-group pruning for stored layers."""
        if self.bbox is None:
            return cells.filter(F.lit(False))
        def inside(box):
            x0, x1, y0, y1 = box
            return (F.col("x") >= x0) & (F.col("x") < x1) & (F.col("y") >= y0) & (F.col("y") < y1)

        out = cells.filter(inside(self.bbox))
        return out.filter(reduce(or_, map(inside, self.boxes))) if len(self.boxes) > 1 else out


def zone(vertices: DataFrame, width: int, height: int, block: int | list[int] | None = None,
         max_rows: int | None = None) -> Zone:
    """Rasterise polygons into span pieces; size bound and bounding box from one small job.

    The job reads the edges only: per polygon and part, the number of
    column-centre crossings bounds the spans (half of it), and the part's own
    bounding box, in cell centres clipped to the grid, bounds its cells. A span
    [r0, r1) splits into at most (r1 - r0) / block + 2 pieces, so the sum over all
    parts of ``cells / block + crossings`` bounds the piece count without listing
    the pieces, however the polygons overlap.
    With ``block=None`` the block is the smallest multiple of ``DEFAULT_BLOCK``
    that keeps that bound under the broadcast limit (large grids get long
    blocks instead of billions of pieces); when even the spans alone exceed the
    limit the pieces stay at ``DEFAULT_BLOCK`` rows and are joined by shuffle on
    (x, blk), where short blocks bound every join key. Of a list of blocks (``tiled_blocks``)
    the same choice takes the first under the limit, else the first.
    """
    e = polygon_edges(vertices)
    lo = F.greatest(F.ceil(F.least("gx", "hx") - 0.5), F.lit(0))
    hi = F.least(F.ceil(F.greatest("gx", "hx") - 0.5) - 1, F.lit(width - 1))
    ncols = F.when(F.col("gx") != F.col("hx"), F.greatest(hi - lo + 1, F.lit(0))).otherwise(F.lit(0))
    first = lambda c: F.greatest(F.ceil(c - 0.5), F.lit(0))  # noqa: E731  cells whose centre is in [min, max)
    parts = e.groupBy("poly_id", "part").agg(
        F.sum(ncols).alias("crossings"),
        first(F.min(F.least("gx", "hx"))).alias("x0"), F.least(F.ceil(F.max(F.greatest("gx", "hx")) - 0.5), F.lit(width)).alias("x1"),
        first(F.min(F.least("gy", "hy"))).alias("y0"), F.least(F.ceil(F.max(F.greatest("gy", "hy")) - 0.5), F.lit(height)).alias("y1"),
    ).filter("crossings > 0 AND x0 < x1 AND y0 < y1")
    some = parts.limit(MOST_BOXES + 1).collect()
    boxes = tuple(sorted({tuple(int(r[c]) for c in ("x0", "x1", "y0", "y1")) for r in some})) if len(some) <= MOST_BOXES else ()
    if boxes or not some:
        crossings = sum(int(r["crossings"]) for r in some)
        n_cells = sum(int((r["x1"] - r["x0"]) * (r["y1"] - r["y0"])) for r in some)
        bbox = (min(b[0] for b in boxes), max(b[1] for b in boxes), min(b[2] for b in boxes), max(b[3] for b in boxes)) if boxes else None
    else:
        s = parts.agg(
            F.sum("crossings"), F.sum((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))),
            F.min("x0"), F.max("x1"), F.min("y0"), F.max("y1"),
        ).first()
        crossings, n_cells, bbox = int(s[0]), int(s[1]), tuple(int(v) for v in s[2:])
    limit = BROADCAST_MAX_ROWS if max_rows is None else max_rows
    if block is None:
        room = limit - crossings
        block = DEFAULT_BLOCK
        if room > 0:
            need = -(-n_cells // room)  # ceil: smallest block with cells / block <= room
            block = max(DEFAULT_BLOCK, -(-need // DEFAULT_BLOCK) * DEFAULT_BLOCK)
    elif not isinstance(block, int):
        block = next((k for k in block if n_cells // k + crossings <= limit), block[0])
    bound = n_cells // block + crossings  # 2 pieces of slack per span, spans <= crossings / 2
    pieces = span_pieces(polygon_spans(vertices, width, height), block)
    return Zone(F.broadcast(pieces) if bound <= limit else pieces, bound, bbox, block, boxes)


def cells_in_zone(cells: DataFrame, z: Zone | DataFrame, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Cells inside each zone with ``poly_id`` (bbox pre-filter, then the span range join).

    For a :class:`Zone` its own block height is used.
    """
    if isinstance(z, Zone):
        return _cells_in_zone(z.restrict(cells), z.pieces, z.block)
    return _cells_in_zone(cells, z, block)


def _restrict(cells: DataFrame, z: Zone | DataFrame) -> DataFrame:
    return z.restrict(cells) if isinstance(z, Zone) else cells


def data_cells(layer: DataFrame, name: str = "v") -> DataFrame:
    """No-data filter: keep cells whose value is present, rename the value column."""
    return layer.filter(F.col("v").isNotNull()).select("x", "y", F.col("v").alias(name))


def overlay_join(a: DataFrame, b: DataFrame, na: str = "a", nb: str = "b") -> DataFrame:
    """Cell-aligned overlay: same (x, y), both values present."""
    return data_cells(a, na).join(data_cells(b, nb), ["x", "y"])


def key_intersect(a: DataFrame, b: DataFrame, tile: int) -> DataFrame:
    """Tile keys holding data in both layers."""
    def keys(df: DataFrame) -> DataFrame:
        return df.filter(F.col("v").isNotNull()).select(
            F.floor(F.col("x") / tile).alias("key_col"), F.floor(F.col("y") / tile).alias("key_row")
        )
    return keys(a).intersect(keys(b))


def zonal_crosstab(a: DataFrame, b: DataFrame, pieces: Zone | DataFrame, block: int = DEFAULT_BLOCK, one_sided: bool = False) -> DataFrame:
    """Cells per (poly_id, a, b) value pair inside each zone: ``(poly_id, a, b, n)``.

    With ``one_sided`` a cell also counts where one layer alone holds data; the other side of its pair is NULL.
    """
    if one_sided:
        pairs = _restrict(data_cells(a, "a"), pieces).join(_restrict(data_cells(b, "b"), pieces), ["x", "y"], "full")
        return pairs_crosstab(pairs, pieces, block)
    za = cells_in_zone(data_cells(a, "a"), pieces, block)
    j = za.join(_restrict(data_cells(b, "b"), pieces), ["x", "y"])
    return j.groupBy("poly_id", "a", "b").agg(F.count(F.lit(1)).alias("n"))


def cells_in_atoms(cells: DataFrame, atoms: DataFrame, block: int = DEFAULT_BLOCK, max_rows: int | None = None) -> DataFrame:
    """Cells of the atoms' union with the set (s1, s2) that holds them: each cell once, however many polygons that is."""
    pieces = span_pieces(atoms.withColumn("poly_id", F.struct("s1", "s2")), block)
    held = _cells_in_zone(cells, sized_broadcast(pieces, max_rows)[0], block)
    return held.select(*cells.columns, "poly_id.s1", "poly_id.s2")


def zonal_crosstab_atoms(a: DataFrame, b: DataFrame, spans: DataFrame, block: int = DEFAULT_BLOCK, max_rows: int | None = None) -> DataFrame:
    """``zonal_crosstab`` for many overlapping polygons: cells are counted per set of polygons, and the few counts are then
    dealt out to each set's polygons."""
    atoms, members = span_atoms(spans)
    counts = cells_in_atoms(data_cells(a, "a"), atoms, block, max_rows).join(data_cells(b, "b"), ["x", "y"]).groupBy("s1", "s2", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(members, ["s1", "s2"]).groupBy("poly_id", "a", "b").agg(F.sum("n").alias("n"))


def pairs_crosstab(pairs: DataFrame, pieces: Zone | DataFrame, block: int = DEFAULT_BLOCK) -> DataFrame:
    """The same of cells ``(x, y, a, b)`` that are overlaid already."""
    return cells_in_zone(pairs, pieces, block).groupBy("poly_id", "a", "b").agg(F.count(F.lit(1)).alias("n"))


def poly_stats(layer: DataFrame, pieces: DataFrame, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Zonal mean / min / max / count of one layer."""
    z = cells_in_zone(data_cells(layer), pieces, block)
    return z.groupBy("poly_id").agg(
        F.avg("v").alias("mean"), F.min("v").alias("min"), F.max("v").alias("max"),
        F.count(F.lit(1)).alias("n"),
    )


def poly_diff_stats(l1: DataFrame, l2: DataFrame, pieces: DataFrame, cell_area: float = 1.0,
                    block: int = DEFAULT_BLOCK) -> DataFrame:
    """Zonal statistics of ``v1 - v2`` on cells where both layers hold data.

    volume = sum(v1 - v2) * cell area.
    """
    z = cells_in_zone(data_cells(l1, "v1"), pieces, block).join(_restrict(data_cells(l2, "v2"), pieces), ["x", "y"])
    d = F.col("v1") - F.col("v2")
    return z.groupBy("poly_id").agg(
        F.avg(d).alias("mean"), F.min(d).alias("min"), F.max(d).alias("max"),
        (F.sum(d) * F.lit(cell_area)).alias("volume"), F.count(F.lit(1)).alias("n"),
    )


def tiles_touched(layer: DataFrame, keys: DataFrame, tile: int) -> DataFrame:
    """Tiles of a layer read for each zone: ``(poly_id, tiles, cells)``."""
    t = data_cells(layer).select(
        F.floor(F.col("x") / tile).alias("key_col"), F.floor(F.col("y") / tile).alias("key_row")
    ).groupBy("key_col", "key_row").agg(F.count(F.lit(1)).alias("c"))
    j = t.join(sized_broadcast(keys)[0], ["key_col", "key_row"])
    return j.groupBy("poly_id").agg(F.count(F.lit(1)).alias("tiles"), F.sum("c").alias("cells"))


def scan_intersects(layer: DataFrame, keys: DataFrame, tile: int) -> DataFrame:
    """Cells of the tiles in ``keys`` (left-semi on tile key; keys are small)."""
    c = layer.withColumn("key_col", F.floor(F.col("x") / tile)).withColumn("key_row", F.floor(F.col("y") / tile))
    k = sized_broadcast(keys.select("key_col", "key_row").distinct())[0]
    return c.join(k, ["key_col", "key_row"], "left_semi")


# ------------------------------------------------------------------ stored, tile-partitioned layers
def _tile_z(x, row, tile: int):
    from gridzone.operators.layout import zorder

    return zorder(F.floor(x / tile), F.floor(row / tile))


def tiled_blocks(tile: int) -> list[int]:
    """Heights of pieces for layers stored by tile, shortest first: a tile's rows doubled up to a folder's, from ``DEFAULT_BLOCK`` on where
    a folder has as many."""
    from gridzone.sources.catalog import folder_rows

    heights = [tile << k for k in range(folder_rows().bit_length())]
    return [h for h in heights if h >= DEFAULT_BLOCK] or heights[-1:]


def cells_in_zone_tiled(cells: DataFrame, z: Zone, tile: int) -> DataFrame:
    """Zone cells of a layer stored by tile key ``z`` (``catalog.write_tiled``).

    The span pieces, whose blocks of rows lie in one folder each, carry its key, and the
    join on it lets dynamic partition pruning read only the folders that cover
    the zone; inside a folder a cell meets the pieces of its column and block. Independent of the pieces' size,
    ``catalog.in_ranges`` prunes with literals.
    """
    from gridzone.sources.catalog import folder, folder_rows

    if z.block % tile or folder_rows() % (z.block // tile):
        raise ValueError("the zone's block must be whole rows of tiles and part a folder evenly")
    p = z.pieces.select(
        "poly_id", F.col("x").alias("_px"), F.col("blk").alias("_pb"), "r0", "r1",
        folder(_tile_z(F.col("x"), F.col("blk") * z.block, tile)).alias("_pc"),
    )
    j = cells.join(p, (F.col("zc") == F.col("_pc")) & (F.col("x") == F.col("_px")) & (F.floor(F.col("y") / z.block) == F.col("_pb"))
                   & (F.col("y") >= F.col("r0")) & (F.col("y") < F.col("r1")))
    return j.drop("_px", "_pb", "_pc", "r0", "r1")


def zonal_crosstab_tiled(a: DataFrame, b: DataFrame, z: Zone, tile: int) -> DataFrame:
    """Cross-tab over two tile-partitioned layers; both reads are pruned to the zone's tiles."""
    za = cells_in_zone_tiled(data_cells_z(a, "a"), z, tile)
    zb = cells_in_zone_tiled(data_cells_z(b, "b"), z, tile)
    j = za.join(zb, ["poly_id", "x", "y"])
    return j.groupBy("poly_id", "a", "b").agg(F.count(F.lit(1)).alias("n"))


def data_cells_z(layer: DataFrame, name: str) -> DataFrame:
    return layer.filter(F.col("v").isNotNull()).select("zc", "z", "x", "y", F.col("v").alias(name))


# Size of the 30 m EPSG:5070 grid the surveyed layers use (cells).
ALBERS_GRID_COLS = 161280
ALBERS_GRID_ROWS = 104448


def zone_from_lonlat(polys: DataFrame, width: int = ALBERS_GRID_COLS, height: int = ALBERS_GRID_ROWS,
                     block: int | None = None, max_rows: int | None = None) -> Zone:
    """Zone of WGS84 lon/lat polygons (ring or vertex table) on the 30 m Albers grid:
    project to EPSG:5070, move to cell units, rasterise."""
    from gridzone.functions import crs
    from gridzone.sources.polygons import transform_coords

    cells = transform_coords(transform_coords(polys, crs.albers_xy), crs.to_cell_units)
    return zone(cells, width, height, block, max_rows)
