"""Queries over stored forms: layers written to the catalog and read back, ingested stores, text and CSV files.

Each writes below the session's shared ``spark.checkpoint.dir``, under a new
name, and answers from what it reads back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridzone.operators import accum, records, vector, zonal
from gridzone.plans import record_queries as RQ
from gridzone.plans import sqlparts as S
from gridzone.plans.ingest import RANK_ROWS, ingest_class_layers, open_ingested
from gridzone.plans.registry import ORACLE, query
from gridzone.plans.zonal_queries import ALL_POLYS, FLAGSHIP, TILE
from gridzone.plans.zonal_queries import _setup as _polygons
from gridzone.session import ensure_checkpoint_dir
from gridzone.sources import catalog, reports
from gridzone.sources import layers as L
from gridzone.sources import records as RS
from gridzone.sources.polygons import read_geojson_files
from gridzone.sources.tables import grid_size


def _root(spark: SparkSession, what: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def _stored(spark: SparkSession, sf_dir: str, n: int) -> dict[str, DataFrame]:
    root = _root(spark, "layers")
    for name, layer in (("a", L.layer_a), ("b", L.layer_b)):
        catalog.write_layer(layer(spark, sf_dir, n), root, name, n, TILE, "int64")
    return {name: catalog.read_layer(spark, root, name) for name in "ab"}


@query("layer_overwrite", S.with_(S.grid(), S.layers("la")) + "SELECT x // 16 AS key_col, y // 16 AS key_row, x, y, v FROM la".replace("16", str(TILE)))
def layer_overwrite_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer written over an existing one of the same name: only the new cells are there."""
    n, root = grid_size(spark, sf_dir), _root(spark, "overwrite")
    for layer in (L.layer_b, L.layer_a):
        catalog.write_layer(layer(spark, sf_dir, n), root, "classes", n, TILE, "int64")
    return catalog.read_layer(spark, root, "classes").select("key_col", "key_row", "x", "y", "v")


def _scan(spark: SparkSession, sf_dir: str, boundary: bool) -> DataFrame:
    """Stored layers restricted to tile keys: literal z ranges prune files, the keys themselves decide."""
    n, verts = _polygons(spark, sf_dir, [FLAGSHIP])
    keys = (vector.boundary_keys if boundary else vector.covering_keys)(verts, n, n, TILE)
    ranges = catalog.z_ranges(keys, n, n, TILE) if boundary else catalog.zone_ranges(verts, n, n, TILE)
    parts = [
        zonal.scan_intersects(catalog.in_ranges(layer, ranges), keys, TILE).select(F.lit(name).alias("layer"), "x", "y", "v")
        for name, layer in _stored(spark, sf_dir, n).items()
    ]
    return parts[0].unionByName(parts[1])


@query("scan_stored_polygon", ORACLE["scan_intersects_polygon"])
def scan_stored_polygon_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored class layers restricted to the tiles meeting the flagship polygon."""
    return _scan(spark, sf_dir, boundary=False)


@query("scan_stored_boundary", ORACLE["scan_intersects_boundary"])
def scan_stored_boundary_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored first layer restricted to the tiles meeting the flagship polygon's rings."""
    return _scan(spark, sf_dir, boundary=True).filter("layer = 'a'").drop("layer")


@query("zonal_crosstab_stored", ORACLE["zonal_crosstab_multi"])
def zonal_crosstab_stored_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-tab of all test polygons from ingested layers, read by folders and row groups of the covering tiles."""
    n, verts = _polygons(spark, sf_dir, ALL_POLYS)
    st = open_ingested(spark, ingest_class_layers(L.layer_a(spark, sf_dir, n), L.layer_b(spark, sf_dir, n), _root(spark, "ingest"), n, TILE))
    ranges = catalog.zone_ranges(verts, n, n, TILE)
    a, b = (catalog.in_ranges(st[k], ranges) for k in "ab")
    return zonal.zonal_crosstab_tiled(a, b, zonal.zone(verts, n, n, zonal.tiled_blocks(TILE)), TILE)


@query("zonal_crosstab_accum_stored", ORACLE["zonal_crosstab_multi"])
def zonal_crosstab_accum_stored_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the ingested rank bitmaps, read where spans end."""
    n, verts = _polygons(spark, sf_dir, ALL_POLYS)
    st = open_ingested(spark, ingest_class_layers(L.layer_a(spark, sf_dir, n), L.layer_b(spark, sf_dir, n), _root(spark, "ingest"), n, TILE))
    return accum.zonal_crosstab_accum(st["ranks"], vector.polygon_spans(verts, n, n), RANK_ROWS, stored_tile=TILE)


@query(
    "timings_report",
    "SELECT event_type AS polygon, round(max(value), 3) AS area, CASE WHEN user_id % 2 = 0 THEN 'Baseline' ELSE 'Marching' END AS algo, "
    "count(*) AS ms FROM events GROUP BY event_type, user_id % 2",
)
def timings_report_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A timing report written as quoted CSV and read back."""
    events, path = spark.read.parquet(f"{sf_dir}/events.parquet"), _root(spark, "timings")
    algo = F.when(F.col("user_id") % 2 == 0, "Baseline").otherwise("Marching")
    rows = events.groupBy(F.col("event_type").alias("polygon"), algo.alias("algo")).agg(F.round(F.max("value"), 3).alias("area"), F.count("*").alias("ms"))
    reports.write_timings(rows, path)
    return reports.read_timings(spark, path)


@query("address_record", "WITH g AS (" + ORACLE["geocode_clean"] + ") SELECT doc_id, text AS name, lat, lng, zip_code AS zip FROM g WHERE error IS NULL")
def address_record_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address records (name, nested position, zip) of the cleaned geocoder responses."""
    clean = records.geocode_clean(RS.geocode_docs(spark, sf_dir)).filter("error IS NULL")
    r = clean.select("doc_id", records.address_record(F.col("text"), F.col("lat"), F.col("lng"), F.col("zip_code")).alias("r"))
    return r.select("doc_id", F.col("r.text").alias("name"), F.col("r.latlng.lat").alias("lat"), F.col("r.latlng.lng").alias("lng"), F.col("r.zipCode").alias("zip"))


@query("geojson_text", "WITH v AS (" + ORACLE["geojson_vertices"] + ") SELECT part, ring, seq, round(px, 2) AS px, round(py, 2) AS py, count(*) AS n FROM v GROUP BY ALL")
def geojson_text_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GeoJSON text files, one per event type's bounding box, read whole and parsed to vertices."""
    path = _root(spark, "geojson")
    v = RQ._bbox_vertices(spark, sf_dir).withColumns({c: F.round(c, 2) for c in ("px", "py")})
    reports.geojson_feature(v).select("poly_id", "feature").write.partitionBy("poly_id").text(path)
    return read_geojson_files(spark, f"{path}/*/*.txt").groupBy("part", "ring", "seq", "px", "py").agg(F.count("*").alias("n"))
