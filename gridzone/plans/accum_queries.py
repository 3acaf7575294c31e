"""Accumulator queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridzone.operators import accum, vector, zonal
from gridzone.plans import sqlparts as S
from gridzone.plans.registry import query
from gridzone.plans.zonal_queries import ALL_POLYS, BLOCK, TILE, _crosstab_sql, _setup
from gridzone.sources import layers as L
from gridzone.sources.polygons import FLAGSHIP
from gridzone.sources.tables import grid_size

K = 16  # rows of a block of ``block_prefix_counts``
RANK_TILE = 64  # tile of the rank bitmaps on the derived grids: one word per pair

_OV = "ov AS (SELECT la.x, la.y, la.v AS a, lb.v AS b FROM la JOIN lb USING (x, y))"


def _pairs(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    return accum.overlay_pairs(L.layer_a(spark, sf_dir, n), L.layer_b(spark, sf_dir, n))


@query("zonal_crosstab_accum", _crosstab_sql(ALL_POLYS))
def zonal_crosstab_accum_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same answer as ``zonal_crosstab_multi``, from the rank bitmaps at the span ends."""
    n, verts = _setup(spark, sf_dir, ALL_POLYS)
    ranks = accum.rank_bitmaps(_pairs(spark, sf_dir, n), n, RANK_TILE)
    return accum.zonal_crosstab_accum(ranks, vector.polygon_spans(verts, n, n), RANK_TILE)


@query("zonal_crosstab_accum_one_sided", _crosstab_sql(ALL_POLYS, "FULL JOIN"))
def zonal_crosstab_accum_one_sided_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same answer as ``zonal_crosstab_one_sided``, from rank bitmaps that hold pairs with one side missing."""
    n, verts = _setup(spark, sf_dir, ALL_POLYS)
    pairs = accum.overlay_pairs(L.layer_a(spark, sf_dir, n), L.layer_b(spark, sf_dir, n), one_sided=True)
    return accum.zonal_crosstab_accum(accum.rank_bitmaps(pairs, n, RANK_TILE), vector.polygon_spans(verts, n, n), RANK_TILE)


@query(
    "zonal_methods",
    S.with_(
        S.grid(), S.layers("la", "lb"), S.polygon_ctes(ALL_POLYS),
        "ov AS (SELECT la.x, la.y, la.v AS a, lb.v AS b FROM la JOIN lb USING (x, y))", S.inzone("ov"),
        "ct AS (SELECT inz.poly_id, ov.a, ov.b, count(*) AS n FROM inz JOIN ov USING (x, y) GROUP BY ALL)",
    )
    + "SELECT 'baseline' AS method, * FROM ct UNION ALL SELECT 'accumulator' AS method, * FROM ct",
)
def zonal_methods_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test polygon answered by both methods (full count and accumulator), one row
    per (method, polygon, pair): the reference's polygons x methods table, with results."""
    n, verts = _setup(spark, sf_dir, ALL_POLYS)
    pairs = _pairs(spark, sf_dir, n).checkpoint()  # the overlay once for both methods
    base = zonal.pairs_crosstab(pairs, zonal.zone(verts, n, n))
    fast = accum.zonal_crosstab_accum(accum.rank_bitmaps(pairs, n, RANK_TILE), vector.polygon_spans(verts, n, n), RANK_TILE)
    return base.select(F.lit("baseline").alias("method"), "*").unionByName(
        fast.select(F.lit("accumulator").alias("method"), "*"))


@query(
    "block_prefix_counts",
    S.with_(
        S.grid(), S.layers("la", "lb"), _OV,
        f"cnt AS (SELECT x, y // {K} AS blk, a, b, count(*) AS n FROM ov GROUP BY ALL)",
        f"run AS (SELECT x, a, b, blk, sum(n) OVER w AS cum, "
        f"coalesce(lead(blk) OVER w - 1, (SELECT (n + {K} - 1) // {K} - 1 FROM g)) AS until FROM cnt "
        "WINDOW w AS (PARTITION BY x, a, b ORDER BY blk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))",
    )
    + "SELECT x, t.blk, a, b, CAST(cum AS BIGINT) AS cum FROM run, LATERAL generate_series(run.blk, run.until) t(blk)",
)
def block_prefix_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pair counts per column up to each 16-row block, read off the rank bitmaps."""
    n = grid_size(spark, sf_dir)
    return accum.block_prefix_counts(accum.rank_bitmaps(_pairs(spark, sf_dir, n), n, RANK_TILE), K, n, RANK_TILE)


@query(
    "column_prefix_counts",
    S.with_(S.grid(), S.layers("la", "lb"), _OV)
    + "SELECT x, y, a, b, count(*) OVER (PARTITION BY x, a, b ORDER BY y "
      "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM ov",
)
def column_prefix_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running count of each cell's own pair down its column (dense per-cell form)."""
    n = grid_size(spark, sf_dir)
    return accum.column_prefix_counts(_pairs(spark, sf_dir, n))


# ---------------------------------------------------------------- literal marching behaviour
_SEQ_SQL = [
    S.grid(), S.layers("la"), S.polygon_ctes([FLAGSHIP]), S.boundary_sql(),
    f"seq AS (SELECT x // {TILE} AS key_col, (y // {TILE}) * {TILE * TILE} + (x % {TILE}) * {TILE} + (y % {TILE}) AS ord, "
    "x, y, la.v FROM (SELECT DISTINCT x, y FROM bnd) LEFT JOIN la USING (x, y))",
]


def _seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, verts = _setup(spark, sf_dir, [FLAGSHIP])
    return accum.boundary_sequence(vector.boundary_cells(verts, n, n), L.layer_a(spark, sf_dir, n), TILE)


@query(
    "last_seen_fill",
    S.with_(*_SEQ_SQL)
    + "SELECT key_col, ord, x, y, v, last_value(v IGNORE NULLS) OVER (PARTITION BY key_col ORDER BY ord "
      "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_seen FROM seq",
)
def last_seen_fill_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship boundary cells in visiting order with the last data value carried forward."""
    return accum.last_seen_fill(_seq(spark, sf_dir))


@query(
    "boundary_diffs",
    S.with_(
        *_SEQ_SQL,
        "ls AS (SELECT key_col, v, last_value(v IGNORE NULLS) OVER (PARTITION BY key_col ORDER BY ord "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_seen FROM seq)",
    )
    + "SELECT key_col, count(*) AS n_diffs, CAST(sum(v - last_seen) AS BIGINT) AS sum_diff FROM ls "
      "WHERE v IS NOT NULL AND last_seen IS NOT NULL GROUP BY ALL",
)
def boundary_diffs_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per tile column: number and sum of differences to the last seen data value."""
    return accum.boundary_diffs(_seq(spark, sf_dir))


@query(
    "boundary_last_minus_first",
    S.with_(
        *_SEQ_SQL,
        "d AS (SELECT key_col, arg_max(v, ord) - arg_min(v, ord) AS d FROM seq WHERE v IS NOT NULL GROUP BY ALL)",
        "tot AS (SELECT CAST(coalesce(sum(d), 0) AS BIGINT) AS n FROM d)",
    )
    + "SELECT band, band // 4 AS a, band % 4 AS b, n FROM tot, range(64) r(band)",
)
def boundary_last_minus_first_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The literal 64-band marching result: last - first per tile column, summed."""
    return accum.boundary_last_minus_first(_seq(spark, sf_dir))


@query(
    "band_vector_sum",
    S.with_(S.grid(), S.layers("la", "lb"), S.polygon_ctes([FLAGSHIP]), _OV, S.inzone("ov"),
            "ct AS (SELECT a * 4 + b AS band, count(*) AS n FROM inz JOIN ov USING (x, y) GROUP BY ALL)")
    + "SELECT r.band, r.band // 4 AS a, r.band % 4 AS b, CAST(coalesce(ct.n, 0) AS BIGINT) AS n "
      "FROM range(64) r(band) LEFT JOIN ct USING (band)",
)
def band_vector_sum_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-tile-column 64-band pair-count vectors of the flagship zone, summed band by band."""
    n, verts = _setup(spark, sf_dir, [FLAGSHIP])
    pieces = zonal.zone(verts, n, n)
    inz = zonal.cells_in_zone(_pairs(spark, sf_dir, n), pieces, BLOCK)
    return accum.band_vector_sum(accum.band_vectors(inz, TILE))


@query(
    "band_labels",
    S.with_(S.grid(), S.layers("la", "lb"), _OV,
            "ct AS (SELECT a * 4 + b AS band, count(*) AS n FROM ov GROUP BY ALL)")
    + "SELECT CAST(band AS BIGINT) AS band, band // 4 AS nlcd, band % 4 AS soil, n FROM ct",
)
def band_labels_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Band position -> (land-cover, soil) label for the overlay's pair counts."""
    n = grid_size(spark, sf_dir)
    ct = _pairs(spark, sf_dir, n).groupBy(accum.pair_band(F.col("a"), F.col("b")).alias("band")).agg(F.count(F.lit(1)).alias("n"))
    return ct.select(
        F.col("band").cast("bigint").alias("band"),
        accum.band_label_a(F.col("band")).alias("nlcd"), accum.band_label_b(F.col("band")).alias("soil"), "n",
    )
