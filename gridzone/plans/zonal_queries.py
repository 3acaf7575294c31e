"""Zonal queries over layers derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridzone.operators import vector, zonal
from gridzone.plans import sqlparts as S
from gridzone.plans.registry import query
from gridzone.sources import layers as L
from gridzone.sources.polygons import FLAGSHIP, test_polygons
from gridzone.sources.tables import grid_size

BLOCK = zonal.DEFAULT_BLOCK
TILE = 16  # tile side on the derived grids (the 512/128/32 knob of the reference, scaled down)
ALL_POLYS = ["hole", "two_parts", "thin", "outside", "aligned"]


def _setup(spark: SparkSession, sf_dir: str, names: list[str]):
    n = grid_size(spark, sf_dir)
    return n, test_polygons(spark, n, names)


# ---------------------------------------------------------------- flagship
def zonal_crosstab_q(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> DataFrame:
    """Cells per (land-cover, soil) pair inside each polygon (flagship; full count)."""
    n, verts = _setup(spark, sf_dir, names or [FLAGSHIP])
    pieces = zonal.zone(verts, n, n)
    return zonal.zonal_crosstab(L.layer_a(spark, sf_dir, n), L.layer_b(spark, sf_dir, n), pieces, BLOCK)


def _crosstab_sql(names: list[str], join: str = "JOIN") -> str:
    return S.with_(
        S.grid(), S.layers("la", "lb"), S.polygon_ctes(names),
        f"ov AS (SELECT x, y, la.v AS a, lb.v AS b FROM la {join} lb USING (x, y))",
        S.inzone("ov"),
    ) + (
        "SELECT inz.poly_id, ov.a, ov.b, count(*) AS n FROM inz JOIN ov USING (x, y) GROUP BY ALL"
    )


query("zonal_crosstab", _crosstab_sql([FLAGSHIP]))(lambda spark, sf: zonal_crosstab_q(spark, sf))
query("zonal_crosstab_multi", _crosstab_sql(ALL_POLYS))(lambda spark, sf: zonal_crosstab_q(spark, sf, ALL_POLYS))


@query("zonal_crosstab_one_sided", _crosstab_sql(ALL_POLYS, "FULL JOIN"))
def zonal_crosstab_one_sided_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with one side missing count too."""
    n, verts = _setup(spark, sf_dir, ALL_POLYS)
    return zonal.zonal_crosstab(L.layer_a(spark, sf_dir, n), L.layer_b(spark, sf_dir, n), zonal.zone(verts, n, n), BLOCK, one_sided=True)


@query("zonal_crosstab_atoms", _crosstab_sql(ALL_POLYS))
def zonal_crosstab_atoms_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from disjoint pieces: a cell joins once, whichever polygons hold it."""
    n, verts = _setup(spark, sf_dir, ALL_POLYS)
    spans = vector.polygon_spans(verts, n, n)
    return zonal.zonal_crosstab_atoms(L.layer_a(spark, sf_dir, n), L.layer_b(spark, sf_dir, n), spans, BLOCK)


# ---------------------------------------------------------------- polygon rasterisation
_SPANS_SQL = S.with_(
    S.grid(), S.layers("la"), S.polygon_ctes(ALL_POLYS), S.grid_cells(),
    # membership over the whole grid (odd crossings of any part); a span starts where the cell above is outside
    "pin AS (SELECT DISTINCT poly_id, x, y FROM (SELECT e.poly_id, e.part, c.x, c.y FROM allc c JOIN edges e "
    "ON (e.gx > c.x + 0.5::DOUBLE) <> (e.hx > c.x + 0.5::DOUBLE) "
    "WHERE e.gy + (c.x + 0.5::DOUBLE - e.gx) / (e.hx - e.gx) * (e.hy - e.gy) <= c.y + 0.5::DOUBLE "
    "GROUP BY ALL HAVING count(*) % 2 = 1))",
    "starts AS (SELECT p.poly_id, count(*) AS n_spans FROM pin p LEFT JOIN pin q "
    "ON p.poly_id = q.poly_id AND p.x = q.x AND q.y = p.y - 1 WHERE q.y IS NULL GROUP BY ALL)",
    "sizes AS (SELECT poly_id, count(*) AS n_cells FROM pin GROUP BY ALL)",
    "rings AS (SELECT poly_id, part, ring, abs(sum(gx * hy - hx * gy)) / 2.0 AS a FROM edges GROUP BY ALL)",
    "areas AS (SELECT poly_id, sum(CASE WHEN ring = 0 THEN a ELSE -a END) AS area FROM rings GROUP BY ALL)",
    "dat AS (SELECT poly_id, count(*) AS n_data FROM (SELECT DISTINCT poly_id, x, y FROM pin) JOIN la USING (x, y) GROUP BY ALL)",
) + (
    "SELECT areas.poly_id, round(areas.area, 6) AS area, CAST(coalesce(n_cells, 0) AS BIGINT) AS n_cells, "
    "CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, CAST(coalesce(n_data, 0) AS BIGINT) AS n_data "
    "FROM areas LEFT JOIN sizes USING (poly_id) LEFT JOIN starts USING (poly_id) LEFT JOIN dat USING (poly_id)"
)


@query("polygon_spans", _SPANS_SQL)
def polygon_spans_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per test polygon: planar area (shoelace), cells in zone (sum of span lengths),
    spans, and cells of ``layer_a`` inside (the layer makes the work grow with the tables)."""
    n, verts = _setup(spark, sf_dir, ALL_POLYS)
    spans = vector.polygon_spans(verts, n, n)
    size = spans.groupBy("poly_id").agg(
        F.sum(F.col("r1") - F.col("r0")).cast("bigint").alias("n_cells"), F.count(F.lit(1)).alias("n_spans")
    )
    pieces = zonal.zone(verts, n, n)
    data = zonal.cells_in_zone(zonal.data_cells(L.layer_a(spark, sf_dir, n)), pieces, BLOCK).groupBy("poly_id").agg(
        F.count(F.lit(1)).alias("n_data")
    )
    area = vector.polygon_area(verts)
    return area.join(size, "poly_id", "left").join(data, "poly_id", "left").select(
        "poly_id",
        F.round("area", 6).alias("area"),
        F.coalesce("n_cells", F.lit(0)).cast("bigint").alias("n_cells"),
        F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"),
        F.coalesce("n_data", F.lit(0)).cast("bigint").alias("n_data"),
    )


@query(
    "polygon_cells",
    S.with_(S.grid(), S.layers("la"), S.polygon_ctes(ALL_POLYS), S.inzone("la"))
    + "SELECT inz.poly_id, inz.x, inz.y, la.v FROM inz JOIN la USING (x, y)",
)
def polygon_cells_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of ``layer_a`` inside each test polygon (cell-centre rule)."""
    n, verts = _setup(spark, sf_dir, ALL_POLYS)
    pieces = zonal.zone(verts, n, n)
    return zonal.cells_in_zone(zonal.data_cells(L.layer_a(spark, sf_dir, n)), pieces, BLOCK).select(
        "poly_id", "x", "y", "v"
    )


@query(
    "boundary_cells",
    S.with_(S.grid(), S.layers("la"), S.polygon_ctes(ALL_POLYS), S.boundary_sql())
    + "SELECT bnd.poly_id, bnd.x, bnd.y, la.v FROM bnd JOIN la USING (x, y)",
)
def boundary_cells_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of ``layer_a`` touched by the polygon rings (all-touched rule)."""
    n, verts = _setup(spark, sf_dir, ALL_POLYS)
    b = vector.boundary_cells(verts, n, n)
    from gridzone.operators.joins import sized_broadcast

    return zonal.data_cells(L.layer_a(spark, sf_dir, n)).join(sized_broadcast(b)[0], ["x", "y"]).select(
        "poly_id", "x", "y", "v"
    )


# ---------------------------------------------------------------- keys, scans, overlay
def _zone_sql_parts(names: list[str]) -> list[str]:
    """Brute-force zone cells over the whole grid (``inzall``) and boundary cells (``bnd``)."""
    return [S.grid_cells(), S.inzone("allc", "inzall"), S.boundary_sql()]


_COVER_SQL = (
    "cover AS (SELECT DISTINCT poly_id, x // {t} AS key_col, y // {t} AS key_row FROM "
    "(SELECT poly_id, x, y FROM inzall UNION ALL SELECT poly_id, x, y FROM bnd))"
).format(t=TILE)


@query(
    "covering_keys",
    S.with_(S.grid(), S.layers("la"), S.polygon_ctes(ALL_POLYS), _zone_sql_parts(ALL_POLYS), _COVER_SQL,
            f"ta AS (SELECT x // {TILE} AS key_col, y // {TILE} AS key_row, count(*) AS c FROM la GROUP BY ALL)")
    + "SELECT cover.poly_id, cover.key_col, cover.key_row, CAST(coalesce(ta.c, 0) AS BIGINT) AS n_cells_a "
      "FROM cover LEFT JOIN ta USING (key_col, key_row)",
)
def covering_keys_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tile keys meeting each polygon, with the number of ``layer_a`` cells stored in each."""
    n, verts = _setup(spark, sf_dir, ALL_POLYS)
    keys = vector.covering_keys(verts, n, n, TILE)
    ta = zonal.data_cells(L.layer_a(spark, sf_dir, n)).groupBy(
        F.floor(F.col("x") / TILE).alias("key_col"), F.floor(F.col("y") / TILE).alias("key_row")
    ).agg(F.count(F.lit(1)).alias("c"))
    return keys.join(ta, ["key_col", "key_row"], "left").select(
        "poly_id", "key_col", "key_row", F.coalesce("c", F.lit(0)).cast("bigint").alias("n_cells_a")
    )


@query(
    "scan_intersects_polygon",
    S.with_(S.grid(), S.layers("la", "lb"), S.polygon_ctes([FLAGSHIP]), _zone_sql_parts([FLAGSHIP]), _COVER_SQL)
    + f"SELECT 'a' AS layer, x, y, v FROM la WHERE (x // {TILE}, y // {TILE}) IN (SELECT (key_col, key_row) FROM cover) "
      f"UNION ALL SELECT 'b' AS layer, x, y, v FROM lb WHERE (x // {TILE}, y // {TILE}) IN (SELECT (key_col, key_row) FROM cover)",
)
def scan_intersects_polygon_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both class layers restricted to the tiles meeting the flagship polygon."""
    n, verts = _setup(spark, sf_dir, [FLAGSHIP])
    keys = vector.covering_keys(verts, n, n, TILE)
    a = zonal.scan_intersects(L.layer_a(spark, sf_dir, n), keys, TILE).select(F.lit("a").alias("layer"), "x", "y", "v")
    b = zonal.scan_intersects(L.layer_b(spark, sf_dir, n), keys, TILE).select(F.lit("b").alias("layer"), "x", "y", "v")
    return a.unionByName(b)


@query(
    "scan_intersects_boundary",
    S.with_(S.grid(), S.layers("la"), S.polygon_ctes([FLAGSHIP]), S.boundary_sql(),
            f"bkeys AS (SELECT DISTINCT x // {TILE} AS key_col, y // {TILE} AS key_row FROM bnd)")
    + f"SELECT x, y, v FROM la WHERE (x // {TILE}, y // {TILE}) IN (SELECT (key_col, key_row) FROM bkeys)",
)
def scan_intersects_boundary_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``layer_a`` restricted to the tiles meeting the flagship polygon's rings."""
    n, verts = _setup(spark, sf_dir, [FLAGSHIP])
    keys = vector.boundary_keys(verts, n, n, TILE)
    return zonal.scan_intersects(L.layer_a(spark, sf_dir, n), keys, TILE).select("x", "y", "v")


@query(
    "tiles_touched",
    S.with_(S.grid(), S.layers("la"), S.polygon_ctes(ALL_POLYS), _zone_sql_parts(ALL_POLYS), _COVER_SQL,
            f"ta AS (SELECT x // {TILE} AS key_col, y // {TILE} AS key_row, count(*) AS c FROM la GROUP BY ALL)")
    + "SELECT poly_id, count(*) AS tiles, CAST(sum(c) AS BIGINT) AS cells FROM cover JOIN ta USING (key_col, key_row) GROUP BY ALL",
)
def tiles_touched_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles (and cells) of ``layer_a`` read per polygon."""
    n, verts = _setup(spark, sf_dir, ALL_POLYS)
    return zonal.tiles_touched(L.layer_a(spark, sf_dir, n), vector.covering_keys(verts, n, n, TILE), TILE)


@query(
    "key_intersect",
    S.with_(S.grid(), S.layers("la", "lb"))
    + f"SELECT DISTINCT x // {TILE} AS key_col, y // {TILE} AS key_row FROM la "
      f"INTERSECT SELECT DISTINCT x // {TILE} AS key_col, y // {TILE} AS key_row FROM lb",
)
def key_intersect_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tile keys holding data in both class layers."""
    n = grid_size(spark, sf_dir)
    return zonal.key_intersect(L.layer_a(spark, sf_dir, n), L.layer_b(spark, sf_dir, n), TILE)


@query(
    "overlay_join",
    S.with_(S.grid(), S.layers("la", "lb"))
    + "SELECT x, y, la.v AS a, lb.v AS b FROM la JOIN lb USING (x, y)",
)
def overlay_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell-aligned overlay of the two class layers (both values present)."""
    n = grid_size(spark, sf_dir)
    return zonal.overlay_join(L.layer_a(spark, sf_dir, n), L.layer_b(spark, sf_dir, n))


# ---------------------------------------------------------------- statistics
@query(
    "poly_stats",
    S.with_(S.grid(), S.layers("lv"), S.polygon_ctes(ALL_POLYS), S.inzone("lv"))
    + "SELECT poly_id, round(avg(v), 6) AS mean, min(v) AS min, max(v) AS max, count(*) AS n "
      "FROM inz JOIN lv USING (x, y) GROUP BY ALL",
)
def poly_stats_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zonal mean / min / max of the value layer for each test polygon."""
    n, verts = _setup(spark, sf_dir, ALL_POLYS)
    pieces = zonal.zone(verts, n, n)
    return zonal.poly_stats(L.layer_v(spark, sf_dir, n), pieces, BLOCK).withColumn("mean", F.round("mean", 6))


CELL_AREA = 900.0  # 30 m cells


@query(
    "poly_diff_stats",
    S.with_(S.grid(), S.layers("lv", "lw"), S.polygon_ctes(ALL_POLYS),
            "d AS (SELECT x, y, lv.v - lw.v AS d FROM lv JOIN lw USING (x, y))", S.inzone("d"))
    + f"SELECT poly_id, round(avg(d), 6) AS mean, min(d) AS min, max(d) AS max, "
      f"round(sum(d) * {CELL_AREA}, 6) AS volume, count(*) AS n FROM inz JOIN d USING (x, y) GROUP BY ALL",
)
def poly_diff_stats_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zonal statistics of (value layer - partner layer) and volume = sum * cell area."""
    n, verts = _setup(spark, sf_dir, ALL_POLYS)
    pieces = zonal.zone(verts, n, n)
    r = zonal.poly_diff_stats(L.layer_v(spark, sf_dir, n), L.layer_w(spark, sf_dir, n), pieces, CELL_AREA, BLOCK)
    return r.withColumn("mean", F.round("mean", 6)).withColumn("volume", F.round("volume", 6))


@query(
    "zonal_count",
    S.with_(S.grid(), S.layers("la"), S.polygon_ctes(ALL_POLYS), S.inzone("la"))
    + "SELECT poly_id, count(*) AS n FROM inz GROUP BY ALL",
)
def zonal_count_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range join cell x span on its own: data cells of ``layer_a`` inside each test polygon."""
    n, verts = _setup(spark, sf_dir, ALL_POLYS)
    z = zonal.zone(verts, n, n)
    return zonal.cells_in_zone(zonal.data_cells(L.layer_a(spark, sf_dir, n)), z).groupBy("poly_id").agg(
        F.count(F.lit(1)).alias("n"))


@query(
    "polygon_area",
    S.with_(S.grid(), S.layers("la"), S.polygon_ctes(ALL_POLYS), S.inzone("la"),
            "rings AS (SELECT poly_id, part, ring, abs(sum(gx * hy - hx * gy)) / 2.0 AS a FROM edges GROUP BY ALL)",
            "areas AS (SELECT poly_id, sum(CASE WHEN ring = 0 THEN a ELSE -a END) AS area FROM rings GROUP BY ALL)",
            "dat AS (SELECT poly_id, count(*) AS n_data FROM inz GROUP BY ALL)")
    + "SELECT poly_id, round(area, 6) AS area, CAST(coalesce(n_data, 0) AS BIGINT) AS n_data, "
      "round(coalesce(n_data, 0) / area, 6) AS data_density FROM areas LEFT JOIN dat USING (poly_id)",
)
def polygon_area_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planar area of each test polygon (cell units, holes subtracted) and the density of
    ``layer_a`` data cells in it."""
    n, verts = _setup(spark, sf_dir, ALL_POLYS)
    z = zonal.zone(verts, n, n)
    dat = zonal.cells_in_zone(zonal.data_cells(L.layer_a(spark, sf_dir, n)), z).groupBy("poly_id").agg(
        F.count(F.lit(1)).alias("n_data"))
    a = vector.polygon_area(verts).join(dat, "poly_id", "left")
    nd = F.coalesce("n_data", F.lit(0)).cast("bigint")
    return a.select("poly_id", F.round("area", 6).alias("area"), nd.alias("n_data"),
                    F.round(nd / F.col("area"), 6).alias("data_density"))
