"""Tile layout operators: packed tiles <-> cells, retiling, keys, extents, metadata, bands.

Packed tile form: ``(key_col, key_row, cell_type, constant, valid, data)``. ``data`` holds the
tile's values in row-major order (index = row * tile + col) as little-endian numbers of
``cell_type``, or one value if the tile is ``constant``; ``valid`` is a bitmap of the cells with
data, null if all have. So a tile of one class is a few bytes, no-data needs no value
of its own inside the library, and whole tiles are read, cut and written as numpy slices. Where files
want a no-data value in the cells, ``with_nodata`` writes the cell type's own and
``without_nodata`` reads it.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridzone.functions.crs import CELL_SIZE, GRID_XMIN, GRID_YMAX

# Fixed value: proj4 text of EPSG:5070 as stored in layer metadata.
ALBERS_PROJ4 = "+proj=aea +lat_1=29.5 +lat_2=45.5 +lat_0=23 +lon_0=-96 +x_0=0 +y_0=0 +datum=NAD83 +units=m +no_defs "
INT_NODATA = -2147483648


def with_keys(cells: DataFrame, tile: int) -> DataFrame:
    """Add ``key_col, key_row`` (tile of each cell)."""
    return cells.withColumn("key_col", F.floor(F.col("x") / tile)).withColumn("key_row", F.floor(F.col("y") / tile))


@dataclass(frozen=True)
class CellType:
    """``code``: numpy's little-endian type; ``sql``: Spark's; ``nodata``: the value that stands for no data in files (None: has none)."""

    code: str
    sql: str
    nodata: float | int | None


# Cell types of raster layers and the no-data value each writes by default.
CELL_TYPES = {
    "bit": CellType("?", "boolean", None),
    "int8": CellType("<i1", "tinyint", -128),
    "uint8": CellType("<u1", "smallint", 0),
    "int16": CellType("<i2", "smallint", -32768),
    "uint16": CellType("<u2", "int", 0),
    "int32": CellType("<i4", "int", INT_NODATA),
    "uint32": CellType("<u4", "bigint", 0),
    "int64": CellType("<i8", "bigint", -(1 << 63)),
    "float32": CellType("<f4", "float", math.nan),
    "float64": CellType("<f8", "double", math.nan),
}
PACKED = "key_col long, key_row long, cell_type string, constant boolean, valid binary, data binary"
_SQL_TYPES = {"boolean": "bit", "tinyint": "int8", "smallint": "int16", "int": "int32", "bigint": "int64", "float": "float32", "double": "float64"}


def _encode(values: np.ndarray, there: np.ndarray) -> tuple[bool, bytes | None, bytes]:
    """(constant, valid, data) of a tile; places without data must hold zero."""
    full = bool(there.all())
    constant = full and bool((values == values[0]).all())
    stored = values[:1] if constant else values
    data = np.packbits(stored).tobytes() if values.dtype == bool else stored.tobytes()
    return constant, None if full else np.packbits(there).tobytes(), data


def _decode(kind: CellType, size: int, constant: bool, valid: bytes | None, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(values, there) of a tile of ``size`` cells, read-only views where that is possible."""
    n = 1 if constant else size
    values = np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool) if kind.code == "?" else np.frombuffer(data, kind.code)
    there = np.ones(size, bool) if valid is None else np.unpackbits(np.frombuffer(valid, np.uint8), count=size).astype(bool)
    return np.broadcast_to(values, size) if constant else values, there


def _tiles_of(batch: pa.RecordBatch, size: int):
    """(row, cell type, values, there) of each packed tile of a batch."""
    columns = (batch.column(c).to_pylist() for c in ("cell_type", "constant", "valid", "data"))
    for row, (name, constant, valid, data) in enumerate(zip(*columns)):
        yield row, CELL_TYPES[name], *_decode(CELL_TYPES[name], size, constant, valid, data)


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary(), pa.binary()]
    columns = list(zip(*rows)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[f.split()[0] for f in PACKED.split(", ")])


def to_tiles(cells: DataFrame, tile: int, value: str = "v", cell_type: str | None = None) -> DataFrame:
    """Cells -> packed tiles; ``cell_type`` defaults to the one of the column's type. Each group holds at most ``tile * tile`` cells.

    Values are scattered into the tile's array at once; a value that the cell type cannot hold becomes no data.
    """
    name = cell_type or _SQL_TYPES[dict(cells.dtypes)[value]]
    kind, size = CELL_TYPES[name], tile * tile

    def pack(table: pa.Table) -> pa.Table:
        keys = [table.column(k)[0].as_py() for k in ("key_col", "key_row")]
        own = table.column("v").to_numpy()
        fits = _fits(own, kind)
        at = table.column("p").to_numpy()[fits]
        values, there = np.zeros(size, kind.code), np.zeros(size, bool)
        values[at], there[at] = own[fits].astype(kind.code), True
        return pa.Table.from_batches([_packed([(*keys, name, *_encode(values, there))] if len(at) else [])])

    pos = ((F.col("y") % tile) * tile + (F.col("x") % tile)).cast("int")
    keyed = with_keys(cells.filter(F.col(value).isNotNull()), tile).select("key_col", "key_row", pos.alias("p"), F.col(value).alias("v"))
    return keyed.groupBy("key_col", "key_row").applyInArrow(pack, PACKED)


def _fits(values: np.ndarray, kind: CellType) -> np.ndarray:
    """Which values the cell type can hold (whole numbers within its range, fractions cut off; any number for the others)."""
    if kind.code in ("?", "<f4", "<f8"):
        return np.ones(len(values), bool)
    if values.dtype.kind == "f":
        info = np.iinfo(kind.code)
        with np.errstate(invalid="ignore"):
            cut = np.trunc(values)
            return np.isfinite(values) & (cut >= float(info.min)) & (cut < float(info.max) + 1)
    info, own = np.iinfo(kind.code), values.astype(np.int64)
    return (own >= max(info.min, -(1 << 63))) & (own <= min(info.max, (1 << 63) - 1))


def from_tiles(tiles: DataFrame, tile: int, cell_type: str = "int64") -> DataFrame:
    """Packed tiles of one cell type -> data cells ``(x, y, v)``, v in the cell type's Spark type."""
    kind, size = CELL_TYPES[cell_type], tile * tile
    arrow = {"boolean": pa.bool_(), "tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64(), "float": pa.float32(), "double": pa.float64()}[kind.sql]

    def unpack(batches):
        for batch in batches:
            cols, rows = (batch.column(c).to_numpy() for c in ("key_col", "key_row"))
            for row, own, values, there in _tiles_of(batch, size):
                if own.code != kind.code:
                    raise ValueError(f"a tile of another cell type among those of {cell_type}")
                at = np.flatnonzero(there)
                x, y = cols[row] * tile + at % tile, rows[row] * tile + at // tile
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(values[at]).cast(arrow)], names=["x", "y", "v"])

    return tiles.select("key_col", "key_row", "cell_type", "constant", "valid", "data").mapInArrow(unpack, f"x long, y long, v {kind.sql}")


def _each(tiles: DataFrame, change) -> DataFrame:
    """``change(key_col, key_row, row of the batch)`` -> packed rows, for every tile; no shuffle."""
    def run(batches):
        for batch in batches:
            rows = [out for row in batch.to_pylist() for out in change(row)]
            if rows:
                yield _packed(rows)

    return tiles.select("key_col", "key_row", "cell_type", "constant", "valid", "data").mapInArrow(run, PACKED)


def retile(tiles: DataFrame, tile: int, new_tile: int) -> DataFrame:
    """Split every tile into (tile / new_tile)^2 smaller tiles on the refined layout.

    Each small tile comes from exactly one big tile, so this is a narrow
    transformation (no shuffle): slices of the tile's array. Sub-tiles without data are
    dropped; a constant tile stays so without being unpacked.
    """
    if tile % new_tile:
        raise ValueError(f"tile size {tile} is not a multiple of {new_tile}")
    r = tile // new_tile

    def split(row):
        at = [(row["key_col"] * r + i, row["key_row"] * r + j) for j in range(r) for i in range(r)]
        if row["constant"]:
            return [(*key, row["cell_type"], True, None, row["data"]) for key in at]
        values, there = _decode(CELL_TYPES[row["cell_type"]], tile * tile, False, row["valid"], row["data"])
        cut = lambda a: a.reshape(r, new_tile, r, new_tile).transpose(0, 2, 1, 3).reshape(r * r, new_tile * new_tile)
        return [(*key, row["cell_type"], *_encode(v, t)) for key, v, t in zip(at, cut(values), cut(there)) if t.any()]

    return _each(tiles, split)


def convert_tiles(tiles: DataFrame, tile: int, cell_type: str) -> DataFrame:
    """Packed tiles in another cell type; values that it cannot hold become no data, tiles left without data are dropped."""
    kind, size = CELL_TYPES[cell_type], tile * tile

    def convert(row):
        values, there = _decode(CELL_TYPES[row["cell_type"]], size, row["constant"], row["valid"], row["data"])
        there = there & _fits(values, kind)
        new = np.where(there, values, 0).astype(kind.code)
        return [(row["key_col"], row["key_row"], cell_type, *_encode(new, there))] if there.any() else []

    return _each(tiles, convert)


def with_nodata(tiles: DataFrame, tile: int) -> DataFrame:
    """Tiles as files hold them: no bitmap, the cell type's own no-data value in its place. A cell that already holds that value would be
    lost, so it fails; bit tiles have no such value and need data everywhere."""
    def fill(row):
        kind = CELL_TYPES[row["cell_type"]]
        values, there = _decode(kind, tile * tile, row["constant"], row["valid"], row["data"])
        missing = kind.nodata
        taken = there & (np.isnan(values) if missing is not None and missing != missing else values == missing) if missing is not None else ~there
        if taken.any():
            raise ValueError(f"{row['cell_type']} tile {row['key_col']}, {row['key_row']}: a cell cannot be told from no data")
        filled = values if missing is None else np.where(there, values, missing).astype(kind.code)
        return [(row["key_col"], row["key_row"], row["cell_type"], *_encode(filled, np.ones(len(there), bool)))]

    return _each(tiles, fill)


def without_nodata(tiles: DataFrame, tile: int) -> DataFrame:
    """Tiles of files -> packed tiles: cells with the cell type's no-data value have no data."""
    def read(row):
        kind = CELL_TYPES[row["cell_type"]]
        values, there = _decode(kind, tile * tile, row["constant"], row["valid"], row["data"])
        if kind.nodata is not None:
            there = there & ~(np.isnan(values) if kind.nodata != kind.nodata else values == kind.nodata)
        return [(row["key_col"], row["key_row"], row["cell_type"], *_encode(np.where(there, values, 0).astype(kind.code), there))] if there.any() else []

    return _each(tiles, read)


def _text(values: np.ndarray, there: np.ndarray) -> str:
    """All cells in order, comma-joined, nothing where there is no data."""
    texts = pc.fill_null(pa.array(values, mask=~there).cast(pa.string()), "")
    return pc.binary_join(pa.ListArray.from_arrays([0, len(texts)], texts), ",")[0].as_py()


def tile_summary(tiles: DataFrame, tile: int) -> DataFrame:
    """Per tile: data-cell count, value sum and a digest of all cells in order (no data: empty between commas).

    Takes packed tiles, or stacks of bands (``band_stack``), over all of whose bands it sums; equal bands are unpacked once.
    """
    size, stacked = tile * tile, "bands" in tiles.columns
    schema = "key_col long, key_row long, n_data long, sum_v double, cells_sha256 string"

    def one(band):
        values, there = _decode(CELL_TYPES[band["cell_type"]], size, band["constant"], band["valid"], band["data"])
        return int(there.sum()), float(values[there].astype(np.float64).sum()), _text(values, there)

    def summary(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                bands = row["bands"] if stacked else [row]
                known: dict = {}
                of = [known.get(key) or known.setdefault(key, one(b)) for b in bands for key in [(b["cell_type"], b["constant"], b["valid"], b["data"])]]
                text = ",".join(t for _, _, t in of)
                out.append((row["key_col"], row["key_row"], sum(n for n, _, _ in of), sum(v for _, v, _ in of), hashlib.sha256(text.encode()).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=[f.split()[0] for f in schema.split(", ")])

    return tiles.mapInArrow(summary, schema)


def convert_nodata(v: Column, nodata) -> Column:
    """Cell-type conversion to int32 with the sentinel mapped to NULL."""
    if nodata is None:
        return v.cast("int")
    return F.when(v != F.lit(nodata), v.cast("int"))


def band_stack(tiles: DataFrame, bands: int = 64) -> DataFrame:
    """Literal band stacking: the same packed tile repeated into ``bands`` bands."""
    return tiles.select("key_col", "key_row", F.array_repeat(F.struct("cell_type", "constant", "valid", "data"), bands).alias("bands"))


def _spread(v: Column) -> Column:
    """Moves bit i of a 31-bit number to bit 2i, a byte at a time from a table made by that rule."""
    table = F.array(*(F.lit(sum((byte >> i & 1) << 2 * i for i in range(8))) for byte in range(256)))
    out = F.lit(0).cast("bigint")
    for k in range(4):
        byte = F.shiftright(v, 8 * k).bitwiseAND(F.lit(255)).cast("int")
        out = out.bitwiseOR(F.shiftleft(F.get(table, byte).cast("bigint"), 16 * k))
    return out


def zorder(col: Column, row: Column) -> Column:
    """Z-curve (Morton) key: bit i of col -> bit 2i, bit i of row -> bit 2i + 1.

    Keys are 0 .. 2^31 - 1; anything else fails instead of sharing another key's place.
    """
    c, r = col.cast("bigint"), row.cast("bigint")
    outside = (c < 0) | (r < 0) | (c >= 1 << 31) | (r >= 1 << 31)
    fail = F.raise_error(F.concat(F.lit("tile key outside 0..2^31-1: "), c.cast("string"), F.lit(", "), r.cast("string")))
    return F.when(outside, fail.cast("bigint")).otherwise(_spread(c).bitwiseOR(F.shiftleft(_spread(r), 1)))


def key_extent(keys: DataFrame, tile: int, cell_size: float = CELL_SIZE,
               xmin: float = GRID_XMIN, ymax: float = GRID_YMAX) -> DataFrame:
    """Map extent of each tile key (row 0 at the north edge) with the CRS attached."""
    w = tile * cell_size
    return keys.select(
        "key_col", "key_row",
        (F.lit(xmin) + F.col("key_col") * F.lit(w)).alias("xmin"),
        (F.lit(ymax) - (F.col("key_row") + 1) * F.lit(w)).alias("ymin"),
        (F.lit(xmin) + (F.col("key_col") + 1) * F.lit(w)).alias("xmax"),
        (F.lit(ymax) - F.col("key_row") * F.lit(w)).alias("ymax"),
        F.lit(ALBERS_PROJ4).alias("crs"),
    )


def layout_meta(cells: DataFrame, layer: str, grid: int | tuple[int, int], tile: int, cell_type: str) -> DataFrame:
    """One metadata row for a layer: extent, tile layout, key bounds (half-open), cell type, CRS.

    ``grid`` is the side of a square grid or (width, height) in cells. Bounds
    come from an aggregate over the cells (min/max keys with data).
    """
    width, height = (grid, grid) if isinstance(grid, int) else grid
    if width % tile or height % tile:
        raise ValueError("grid size must be a multiple of the tile size")
    k = with_keys(cells.filter(F.col("v").isNotNull()), tile).agg(
        F.min("key_col").alias("min_col"), F.min("key_row").alias("min_row"),
        F.max("key_col").alias("max_col"), F.max("key_row").alias("max_row"),
        F.count(F.lit(1)).alias("n_cells"),
    )
    return k.select(
        F.lit(layer).alias("layer"),
        F.lit(0).alias("zoom"),
        F.lit(cell_type).alias("cell_type"),
        F.lit(width // tile).alias("layout_cols"),
        F.lit(height // tile).alias("layout_rows"),
        F.lit(tile).alias("tile_cols"),
        F.lit(tile).alias("tile_rows"),
        F.col("min_col").alias("min_key_col"), F.col("min_row").alias("min_key_row"),
        (F.col("max_col") + 1).alias("end_key_col"), (F.col("max_row") + 1).alias("end_key_row"),
        F.lit(GRID_XMIN).alias("xmin"), F.lit(GRID_YMAX - height * CELL_SIZE).alias("ymin"),
        F.lit(GRID_XMIN + width * CELL_SIZE).alias("xmax"), F.lit(GRID_YMAX).alias("ymax"),
        F.lit(ALBERS_PROJ4).alias("crs"),
        "n_cells",
    )


def retile_meta(meta: DataFrame, new_tile: int) -> DataFrame:
    """Layout algebra: same extent, r = tile / new_tile, cols x r, rows x r."""
    r = F.floor(F.col("tile_cols") / new_tile)
    return meta.select(
        "layer", "zoom", "cell_type",
        (F.col("layout_cols") * r).alias("layout_cols"), (F.col("layout_rows") * r).alias("layout_rows"),
        F.lit(new_tile).alias("tile_cols"), F.lit(new_tile).alias("tile_rows"),
        "xmin", "ymin", "xmax", "ymax", "crs",
        ((F.col("tile_cols") % new_tile) == 0).alias("exact"),
    )
