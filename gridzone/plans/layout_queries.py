"""Layout and catalog queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridzone.operators import layout
from gridzone.plans import sqlparts as S
from gridzone.plans.registry import query
from gridzone.plans.zonal_queries import TILE
from gridzone.session import ensure_checkpoint_dir
from gridzone.sources import catalog
from gridzone.sources import layers as L
from gridzone.sources.tables import grid_size

SUB_TILE = 4  # retile target on the derived grids (512 -> 128 / 32 in the reference)


def _tiles(spark: SparkSession, sf_dir: str, tile: int = TILE) -> DataFrame:
    n = grid_size(spark, sf_dir)
    return layout.to_tiles(L.layer_a(spark, sf_dir, n), tile)


def _tile_sum_sql(t: int, layer: str = "la") -> str:
    """Tiles with data, every position of each spelled out in row-major order."""
    return (f"SELECT k.key_col, k.key_row, count(l.v) AS n_data, sum(CAST(l.v AS DOUBLE)) AS sum_v, "
            "sha256(string_agg(coalesce(CAST(l.v AS VARCHAR), ''), ',' ORDER BY p.pos)) AS cells_sha256 "
            f"FROM (SELECT DISTINCT x // {t} AS key_col, y // {t} AS key_row FROM {layer}) k CROSS JOIN range({t * t}) p(pos) "
            f"LEFT JOIN {layer} l ON l.x = k.key_col * {t} + p.pos % {t} AND l.y = k.key_row * {t} + p.pos // {t} GROUP BY ALL")


@query("layer_scan", S.with_(S.grid(), S.layers("la")) + _tile_sum_sql(TILE))
def layer_scan_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full scan of a tiled layer (packed tiles), summarised per tile."""
    return layout.tile_summary(_tiles(spark, sf_dir), TILE)


@query("retile", S.with_(S.grid(), S.layers("la")) + _tile_sum_sql(SUB_TILE))
def retile_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-tile 16 x 16 tiles to 4 x 4 on the refined layout (narrow, no shuffle)."""
    return layout.tile_summary(layout.retile(_tiles(spark, sf_dir), TILE, SUB_TILE), SUB_TILE)


@query("convert_nodata", S.with_(S.grid(), S.layers("la")) + "SELECT x, y, CAST(v AS INTEGER) AS v FROM la")
def convert_nodata_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles stored with the int32 sentinel for no-data, converted back to NULL-based cells."""
    files = layout.with_nodata(layout.convert_tiles(_tiles(spark, sf_dir), TILE, "int32"), TILE)
    return layout.from_tiles(layout.without_nodata(files, TILE), TILE, "int32")


@query(
    "band_stack",
    S.with_(S.grid(), S.layers("la"),
            _tile_sum_sql(TILE).replace("sha256(string_agg(", "string_agg(").replace("p.pos)) AS cells_sha256", "p.pos) AS cells").join(("t AS (", ")")))
    + "SELECT key_col, key_row, 64 AS n_bands, 64 * n_data AS n_data, 64 * sum_v AS sum_v, "
      "sha256(repeat(cells || ',', 63) || cells) AS cells_sha256 FROM t",
)
def band_stack_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64-band stack of each land-cover tile (the ingest's literal band copy), summarised over all bands."""
    st = layout.band_stack(_tiles(spark, sf_dir))
    s = layout.tile_summary(st, TILE)
    return s.select("key_col", "key_row", F.lit(64).alias("n_bands"), "n_data", "sum_v", "cells_sha256")


def _z_sql(c: str, r: str, bits: int = 16) -> str:
    terms = [f"(((({c}) >> {i}) & 1) << {2 * i}) | (((({r}) >> {i}) & 1) << {2 * i + 1})" for i in range(bits)]
    return "(" + " | ".join(terms) + ")"


@query(
    "zorder_key",
    S.with_(S.grid(), S.layers("la"), f"k AS (SELECT DISTINCT x // {TILE} AS key_col, y // {TILE} AS key_row FROM la)")
    + f"SELECT key_col, key_row, CAST({_z_sql('key_col', 'key_row')} AS BIGINT) AS z FROM k",
)
def zorder_key_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Z-curve key of every tile holding data."""
    t = _tiles(spark, sf_dir)
    return t.select("key_col", "key_row", layout.zorder(F.col("key_col"), F.col("key_row")).alias("z"))


@query(
    "key_extent",
    S.with_(S.grid(), S.layers("la"), f"k AS (SELECT DISTINCT x // {TILE} AS key_col, y // {TILE} AS key_row FROM la)")
    + f"SELECT key_col, key_row, -2493045.0::DOUBLE + key_col * {TILE * 30.0}::DOUBLE AS xmin, "
      f"3310725.0::DOUBLE - (key_row + 1) * {TILE * 30.0}::DOUBLE AS ymin, "
      f"-2493045.0::DOUBLE + (key_col + 1) * {TILE * 30.0}::DOUBLE AS xmax, "
      f"3310725.0::DOUBLE - key_row * {TILE * 30.0}::DOUBLE AS ymax, '{layout.ALBERS_PROJ4}' AS crs FROM k",
)
def key_extent_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map extent (EPSG:5070 metres) of every tile key, CRS attached."""
    return layout.key_extent(_tiles(spark, sf_dir).select("key_col", "key_row"), TILE)


_META_LAYERS = [("a", "la", "int64"), ("b", "lb", "int64"), ("v", "lv", "float64"), ("w", "lw", "float64")]


def _meta_sql() -> str:
    parts = []
    for name, cte, ct in _META_LAYERS:
        parts.append(
            f"SELECT '{name}' AS layer, 0 AS zoom, '{ct}' AS cell_type, CAST(g.n // {TILE} AS INTEGER) AS layout_cols, "
            f"CAST(g.n // {TILE} AS INTEGER) AS layout_rows, {TILE} AS tile_cols, {TILE} AS tile_rows, "
            f"min(x // {TILE}) AS min_key_col, min(y // {TILE}) AS min_key_row, "
            f"max(x // {TILE}) + 1 AS end_key_col, max(y // {TILE}) + 1 AS end_key_row, "
            f"-2493045.0::DOUBLE AS xmin, 3310725.0::DOUBLE - g.n * 30.0::DOUBLE AS ymin, "
            f"-2493045.0::DOUBLE + g.n * 30.0::DOUBLE AS xmax, 3310725.0::DOUBLE AS ymax, "
            f"'{layout.ALBERS_PROJ4}' AS crs, count(*) AS n_cells FROM {cte}, g GROUP BY g.n"
        )
    return S.with_(S.grid(), S.layers("la", "lb", "lv", "lw")) + " UNION ALL ".join(parts)


#: Catalogs written by this process: (application, tables) -> root. A catalog is written once and then read by its records.
_CATALOGS: dict[tuple[str, str], str] = {}


def _catalog(spark: SparkSession, sf_dir: str) -> str:
    """Root of a catalog with the derived layers, below the session's shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CATALOGS:
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/catalog-{uuid.uuid4().hex}"
        n = grid_size(spark, sf_dir)
        srcs = {"a": L.layer_a, "b": L.layer_b, "v": L.layer_v, "w": L.layer_w}
        for name, _, ct in _META_LAYERS:
            catalog.write_layer(srcs[name](spark, sf_dir, n), root, name, n, TILE, ct)
        _CATALOGS[key] = root
    return _CATALOGS[key]


def _metas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.read_meta(spark, _catalog(spark, sf_dir))


@query("layer_meta", _meta_sql())
def layer_meta_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata record of each layer in the catalog (extent, layout, key bounds, cell type, CRS)."""
    return _metas(spark, sf_dir)


@query(
    "layer_list",
    S.with_(S.grid(), S.layers("la", "lb", "lv", "lw"))
    + " UNION ALL ".join(f"SELECT DISTINCT '{nm}' AS layer, 0 AS zoom FROM {c}" for nm, c, _ in _META_LAYERS),
)
def layer_list_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers of the catalog that hold data."""
    return _metas(spark, sf_dir).filter(F.col("n_cells") > 0).select("layer", "zoom")


@query(
    "layout_retile_meta",
    S.with_(S.grid(), S.layers("la", "lb", "lv", "lw"))
    + " UNION ALL ".join(
        f"SELECT DISTINCT '{nm}' AS layer, 0 AS zoom, '{ct}' AS cell_type, "
        f"CAST(g.n // {TILE} * {TILE // SUB_TILE} AS INTEGER) AS layout_cols, "
        f"CAST(g.n // {TILE} * {TILE // SUB_TILE} AS INTEGER) AS layout_rows, {SUB_TILE} AS tile_cols, {SUB_TILE} AS tile_rows, "
        f"-2493045.0::DOUBLE AS xmin, 3310725.0::DOUBLE - g.n * 30.0::DOUBLE AS ymin, "
        f"-2493045.0::DOUBLE + g.n * 30.0::DOUBLE AS xmax, 3310725.0::DOUBLE AS ymax, '{layout.ALBERS_PROJ4}' AS crs, "
        f"true AS exact FROM {c}, g"
        for nm, c, ct in _META_LAYERS
    ),
)
def layout_retile_meta_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New layout of each layer after retiling 16 -> 4 (same extent, 4x cols and rows)."""
    return layout.retile_meta(_metas(spark, sf_dir), SUB_TILE)
