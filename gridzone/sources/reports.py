"""Timing report CSV (sink + tolerant source) and GeoJSON feature sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TIMING_SCHEMA = "polygon STRING, area DOUBLE, algo STRING, ms BIGINT"
TIMING_HEADER = ["Polygon Name", "Polygon Area", "Algo Name", "Time (ms)"]


def write_timings(df: DataFrame, path: str) -> None:
    """CSV with a header and every field quoted (four columns, one file)."""
    out = df.select(
        F.col("polygon").alias(TIMING_HEADER[0]),
        F.col("area").cast("string").alias(TIMING_HEADER[1]),
        F.col("algo").alias(TIMING_HEADER[2]),
        F.col("ms").cast("string").alias(TIMING_HEADER[3]),
    )
    out.coalesce(1).write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path)


def read_timings(spark: SparkSession, path: str) -> DataFrame:
    """Read a timing CSV, also when its first data row was glued to the header
    by a literal backslash-n (two characters) instead of a line break."""
    lines = spark.read.text(path)
    pieces = lines.select(F.explode(F.split("value", r"\\n")).alias("line"))
    pieces = pieces.filter(F.length(F.trim("line")) > 0)
    parsed = pieces.select(F.from_csv("line", "c0 STRING, c1 STRING, c2 STRING, c3 STRING").alias("r"))
    rows = parsed.select("r.*").filter(F.col("c0") != TIMING_HEADER[0])
    return rows.select(
        F.col("c0").alias("polygon"), F.col("c1").cast("double").alias("area"),
        F.col("c2").alias("algo"), F.col("c3").cast("bigint").alias("ms"),
    )


def geojson_feature(vertices: DataFrame, lon: str = "px", lat: str = "py") -> DataFrame:
    """Vertex table -> one GeoJSON Feature text per polygon.

    Vertices are gathered per ring (bounded by the ring's vertex count), sorted by
    ``seq``; rings per part and parts per polygon are nested the same way.
    """
    ring = vertices.groupBy("poly_id", "part", "ring").agg(
        F.array_sort(F.collect_list(F.struct("seq", F.array(F.col(lon), F.col(lat)).alias("c")))).alias("vs")
    ).select("poly_id", "part", "ring", F.transform("vs", lambda s: s["c"]).alias("coords"))
    part = ring.groupBy("poly_id", "part").agg(
        F.array_sort(F.collect_list(F.struct("ring", "coords"))).alias("rs")
    ).select("poly_id", "part", F.transform("rs", lambda s: s["coords"]).alias("rings"))
    poly = part.groupBy("poly_id").agg(F.array_sort(F.collect_list(F.struct("part", "rings"))).alias("ps")).select(
        "poly_id", F.transform("ps", lambda s: s["rings"]).alias("parts")
    )
    geom = F.when(
        F.size("parts") == 1,
        F.to_json(F.struct(F.lit("Polygon").alias("type"), F.col("parts")[0].alias("coordinates"))),
    ).otherwise(F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.col("parts").alias("coordinates"))))
    props = F.to_json(F.struct(F.col("poly_id").alias("id")))
    return poly.select(
        "poly_id",
        F.concat(F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'), geom, F.lit("}")).alias("feature"),
    )
