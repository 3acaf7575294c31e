"""Focal operators, pyramids and point gridding.

Focal plan: every cell is copied to the tiles whose halo contains it (1 copy
for interior cells, 2-4 for tile-edge cells: about 1 + 4 r / tile copies per
cell), one exchange by tile key, and each tile with its halo becomes a dense array
in its task. A window of (2r + 1)^2 cells is taken in two passes, along the columns and along the
rows, each by running joins over blocks of 2r + 1 cells (``slide``): the work per
cell does not depend on the radius, and no row is copied per neighbour.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridzone.functions.crs import CELL_SIZE

OFFSETS = [(dx, dy) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]


def halo_copies(cells: DataFrame, tile: int, halo: int = 1) -> DataFrame:
    """Cells copied to every tile whose halo-extended area contains them."""
    key = lambda c: F.explode(F.sequence(F.floor((F.col(c) - halo) / tile), F.floor((F.col(c) + halo) / tile)))
    return cells.select("x", "y", "v", key("x").alias("key_col")).select("*", key("y").alias("key_row"))


def _on_tiles(cells: DataFrame, tile: int, halo: int, kernel, schema: str) -> DataFrame:
    """``kernel(values, there)`` on each tile with its halo, dense: (tile + 2 halo)^2 arrays in [x, y] order, ``there`` marks data.

    It returns one (tile, tile) array per column of ``schema`` after x and y; rows come out for the tile's own data cells. A task holds one
    tile at a time, a bounded number of cells.
    """
    whole = cells.schema["v"].dataType.typeName() in ("byte", "short", "integer", "long")
    kind, side = np.int64 if whole else np.float64, tile + 2 * halo

    def run(table: pa.Table) -> pa.Table:
        x0, y0 = (table.column(k)[0].as_py() * tile - halo for k in ("key_col", "key_row"))
        at = table.column("x").to_numpy() - x0, table.column("y").to_numpy() - y0
        values, there = np.zeros((side, side), dtype=kind), np.zeros((side, side), dtype=bool)
        values[at], there[at] = table.column("v").cast(pa.from_numpy_dtype(kind)).to_numpy(), True
        x, y = np.nonzero(there[halo : side - halo, halo : side - halo])
        columns = [x + x0 + halo, y + y0 + halo, *(out[x, y] for out in kernel(values, there))]
        return pa.table([pa.array(c) for c in columns], names=[f.split()[0] for f in ("x long", "y long", *schema.split(", "))])

    own = cells.filter(F.col("v").isNotNull())
    if not whole:
        own = own.withColumn("v", F.col("v").cast("double"))
    return halo_copies(own, tile, halo).groupBy("key_col", "key_row").applyInArrow(run, f"x long, y long, {schema}")


def slide(a: np.ndarray, width: int, join: np.ufunc) -> np.ndarray:
    """``join`` (add, minimum or maximum) over every ``width`` neighbours of the first axis, in a time that does not depend on ``width``.

    The axis is cut into blocks of ``width``: a window is the end of one block and the start of the next, and running
    joins from both ends of each block hold both. Nothing is subtracted, so a huge or undefined value stays within its windows.
    """
    n = len(a)
    pad = -n % width
    blocks = np.concatenate([a, np.repeat(a[-1:], pad, axis=0)]).reshape(-1, width, *a.shape[1:])
    ahead = join.accumulate(blocks, axis=1).reshape(-1, *a.shape[1:])
    behind = join.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1, *a.shape[1:])
    first = np.arange(n - width + 1)
    out = join(behind[first], ahead[first + width - 1])
    whole = first % width == 0  # a window that is a block: both ends hold all of it
    out[whole] = behind[first[whole]]
    return out


def slide_square(a: np.ndarray, width: int, join: np.ufunc) -> np.ndarray:
    """``slide`` along both axes."""
    return slide(slide(a, width, join).T, width, join).T


FOCAL_STATS = ("mean", "min", "max", "sum")


def focal_stats(cells: DataFrame, tile: int, radius: int = 1, stats: tuple[str, ...] = FOCAL_STATS) -> DataFrame:
    """Statistics of the data cells in each data cell's (2r + 1)^2 window: ``(x, y, <stats>, n)``."""
    if radius >= tile:
        raise ValueError("radius must be smaller than the tile size")
    if unknown := set(stats) - set(FOCAL_STATS):
        raise ValueError(f"no such statistics: {sorted(unknown)}")
    width = 2 * radius + 1
    kind = cells.schema["v"].dataType.simpleString()
    whole = kind in ("tinyint", "smallint", "int", "bigint")
    types = {"mean": "double", "sum": "bigint" if whole else "double", "min": "bigint" if whole else "double", "max": "bigint" if whole else "double"}

    def kernel(values, there):
        n = slide_square(there.astype(np.int64), width, np.add)
        total = slide_square(np.where(there, values, 0), width, np.add) if {"sum", "mean"} & set(stats) else None
        ends = (np.iinfo(np.int64).max, np.iinfo(np.int64).min) if values.dtype == np.int64 else (np.inf, -np.inf)
        of = {
            "sum": lambda: total,
            "mean": lambda: total / np.maximum(n, 1),
            "min": lambda: slide_square(np.where(there, values, ends[0]), width, np.minimum),
            "max": lambda: slide_square(np.where(there, values, ends[1]), width, np.maximum),
        }
        return [*(of[s]() for s in stats), n]

    out = _on_tiles(cells, tile, radius, kernel, ", ".join([*(f"{s} {types[s]}" for s in stats), "n long"]))
    return out.withColumns({s: F.col(s).cast(kind) for s in stats if s in ("min", "max") and kind != types[s]})


def focal_mean(cells: DataFrame, tile: int) -> DataFrame:
    """Mean of the data cells in each data cell's 3 x 3 window: ``(x, y, mean, n)``."""
    return focal_stats(cells, tile, 1, ("mean",))


def hillshade(cells: DataFrame, tile: int, azimuth: float = 315.0, altitude: float = 45.0,
              cell_size: float = CELL_SIZE, z_factor: float = 1.0) -> DataFrame:
    """Horn (1981) 3 x 3 gradient hillshade, 0..255, of every data cell.

    A neighbour without data (layer edge, gap) counts as level with the cell.
    """
    zenith, sun = math.radians(90.0 - altitude), math.radians((360.0 - azimuth + 90.0) % 360.0)

    def kernel(values, there):
        inner = slice(1, -1)
        centre = values[inner, inner]
        n = centre.shape[0]
        at = lambda dx, dy: (slice(1 + dx, 1 + dx + n), slice(1 + dy, 1 + dy + n))
        near = {d: np.where(there[at(*d)], values[at(*d)], centre).astype(np.float64) for d in OFFSETS}
        east, west = (near[s, -1] + 2.0 * near[s, 0] + near[s, 1] for s in (1, -1))
        south, north = (near[-1, s] + 2.0 * near[0, s] + near[1, s] for s in (1, -1))
        dzdx, dzdy = (east - west) / (8.0 * cell_size), (south - north) / (8.0 * cell_size)
        slope, aspect = np.arctan(z_factor * np.sqrt(dzdx * dzdx + dzdy * dzdy)), np.arctan2(dzdy, -dzdx)
        light = math.cos(zenith) * np.cos(slope) + math.sin(zenith) * np.sin(slope) * np.cos(sun - aspect)
        return [np.maximum(255.0 * light, 0.0)]

    return _on_tiles(cells, tile, 1, kernel, "hs double")


def pyramid_levels(width: int, height: int) -> int:
    """Levels above the base until one cell is left."""
    return max(0, math.ceil(math.log2(max(1, width, height))))


#: Levels made in one pass: a tile of 2^LEVELS_AT_ONCE cells a side becomes one cell.
LEVELS_AT_ONCE = 8


def _quarters(a: np.ndarray) -> np.ndarray:
    """(4, side / 2, side / 2): the cells of each 2 x 2 block."""
    return np.stack([a[i::2, j::2] for i in (0, 1) for j in (0, 1)])


def _mean_of_four(values: np.ndarray, there: np.ndarray) -> np.ndarray:
    v, t = _quarters(values), _quarters(there)
    return np.where(t, v, 0).sum(axis=0) / np.maximum(t.sum(axis=0), 1)


def _mode_of_four(values: np.ndarray, there: np.ndarray) -> np.ndarray:
    v, t = _quarters(values), _quarters(there)
    best, most = np.zeros_like(v[0]), np.zeros(v[0].shape, dtype=np.int8)
    for i in range(4):
        n = ((v == v[i]) & t).sum(axis=0) * t[i]
        better = (n > most) | ((n == most) & (n > 0) & (v[i] < best))
        best, most = np.where(better, v[i], best), np.where(better, n, most)
    return best


def _levels_of_a_tile(join, done: int, step: int, dtype):
    side = 1 << step

    def run(table: pa.Table) -> pa.Table:
        x0, y0 = (table.column(k)[0].as_py() * side for k in ("key_col", "key_row"))
        at = table.column("x").to_numpy() - x0, table.column("y").to_numpy() - y0
        values, there = np.zeros((side, side), dtype=dtype), np.zeros((side, side), dtype=bool)
        values[at], there[at] = table.column("v").to_numpy(), True
        parts = []
        for k in range(1, step + 1):
            values, there = join(values, there), _quarters(there).any(axis=0)
            x, y = np.nonzero(there)
            parts.append((np.full(len(x), done + k, dtype=np.int32), x + (x0 >> k), y + (y0 >> k), values[x, y]))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*parts)], names=["level", "x", "y", "v"])

    return run


def _pyramid(cells: DataFrame, levels: int, join, kind: str) -> DataFrame:
    """Levels 1..levels: all levels inside a tile in the task that holds it; the top of each tile is a cell of the next pass, of 2^LEVELS_AT_ONCE
    times fewer cells a side. Between passes the tiles' tops go to the checkpoint folder."""
    own, done, out = cells.filter(F.col("v").isNotNull()).select("x", "y", F.col("v").cast(kind).alias("v")), 0, None
    while done < levels:
        step = min(LEVELS_AT_ONCE, levels - done)
        key = [F.floor(F.col(c) / (1 << step)).alias(k) for c, k in (("x", "key_col"), ("y", "key_row"))]
        run = _levels_of_a_tile(join, done, step, np.int64 if kind == "bigint" else np.float64)
        made = own.select("*", *key).groupBy("key_col", "key_row").applyInArrow(run, f"level int, x long, y long, v {kind}")
        done += step
        if done < levels:
            made = made.checkpoint()
            own = made.where(F.col("level") == done).select("x", "y", "v")
        out = made if out is None else out.unionByName(made)
    return out if out is not None else own.select(F.lit(0).alias("level"), "x", "y", "v").where("false")


def pyramid_mean(cells: DataFrame, levels: int) -> DataFrame:
    """Levels 1..levels above the base: each cell = mean of the 2 x 2 cells below it."""
    return _pyramid(cells, levels, _mean_of_four, "double")


def pyramid_mode(cells: DataFrame, levels: int) -> DataFrame:
    """Class pyramid (whole-number classes): each cell = most frequent class of the 2 x 2 below (ties: smallest class)."""
    return _pyramid(cells, levels, _mode_of_four, "bigint")


def pyramid_level(cells: DataFrame, level: int, how: str = "mean") -> DataFrame:
    """One level alone: 0 is the base, ``how`` is mean or mode."""
    if level == 0:
        return cells.select("x", "y", "v")
    made = {"mean": pyramid_mean, "mode": pyramid_mode}[how](cells, level)
    return made.where(F.col("level") == level).select("x", "y", "v")


def point_binning(points: DataFrame, cx: Column, cy: Column) -> DataFrame:
    """Points floored to grid cells: count, mean and max value per cell."""
    return points.groupBy(cx.cast("bigint").alias("x"), cy.cast("bigint").alias("y")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"), F.max("v").alias("max")
    )


def idw_grid(points: DataFrame, fx: Column, fy: Column, radius: float, width: int, height: int,
             power: float = 2.0) -> DataFrame:
    """Inverse-distance weighting onto cell centres within ``radius`` (cell units).

    value = Σ v / d^p ÷ Σ 1 / d^p over points within the radius; a point exactly
    on the centre wins (mean of such points). Each point fans out to the
    (2r + 1)^2 candidate cells around it; the per-cell sums aggregate map-side
    first, so a cell with very many points stays cheap.
    """
    r = math.ceil(radius)
    p = points.select(fx.alias("px"), fy.alias("py"), "v")
    c = p.select(
        "px", "py", "v",
        F.explode(F.sequence(F.greatest(F.floor(F.col("px") - r), F.lit(0)),
                             F.least(F.floor(F.col("px") + r), F.lit(width - 1)))).alias("x"),
    ).select(
        "px", "py", "v", "x",
        F.explode(F.sequence(F.greatest(F.floor(F.col("py") - r), F.lit(0)),
                             F.least(F.floor(F.col("py") + r), F.lit(height - 1)))).alias("y"),
    )
    dx, dy = F.col("x") + 0.5 - F.col("px"), F.col("y") + 0.5 - F.col("py")
    d2 = c.select("x", "y", "v", (dx * dx + dy * dy).alias("d2")).filter(F.col("d2") <= radius * radius)
    wgt = F.when(F.col("d2") > 0, F.lit(1.0) / F.pow(F.col("d2"), F.lit(power / 2.0)))
    g = d2.groupBy("x", "y").agg(
        F.sum(wgt * F.col("v")).alias("swv"), F.sum(wgt).alias("sw"),
        F.sum(F.when(F.col("d2") == 0, F.col("v"))).alias("hit_v"),
        F.count(F.when(F.col("d2") == 0, 1)).alias("hits"), F.count(F.lit(1)).alias("n"),
    )
    val = F.when(F.col("hits") > 0, F.col("hit_v") / F.col("hits")).otherwise(F.col("swv") / F.col("sw"))
    return g.select("x", "y", val.alias("value"), "n")
