"""Polygon inputs: GeoJSON text -> vertex table, and the fixed test polygons.

Vertex table: ``(poly_id STRING, part INT, ring INT, seq INT, px DOUBLE, py DOUBLE)``.
Ring 0 of a part is its exterior, rings > 0 are holes; rings are closed
(last vertex = first vertex) as in GeoJSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERTEX_SCHEMA = T.StructType(
    [
        T.StructField("poly_id", T.StringType(), False),
        T.StructField("part", T.IntegerType(), False),
        T.StructField("ring", T.IntegerType(), False),
        T.StructField("seq", T.IntegerType(), False),
        T.StructField("px", T.DoubleType(), False),
        T.StructField("py", T.DoubleType(), False),
    ]
)

_POLY = "array<array<array<double>>>"
_MULTI = "array<array<array<array<double>>>>"


def geojson_geometry(text: Column) -> Column:
    """Geometry JSON of a GeoJSON text that is a Feature, Polygon or MultiPolygon."""
    kind = F.get_json_object(text, "$.type")
    return F.when(kind == "Feature", F.get_json_object(text, "$.geometry")).otherwise(text)


def geojson_parts(text: Column) -> Column:
    """``array<part<ring<vertex<double>>>>`` of a GeoJSON Polygon / MultiPolygon (Polygon promoted)."""
    geom = geojson_geometry(text)
    kind = F.get_json_object(geom, "$.type")
    coords = F.get_json_object(geom, "$.coordinates")
    return (
        F.when(kind == "Polygon", F.array(F.from_json(coords, _POLY)))
        .when(kind == "MultiPolygon", F.from_json(coords, _MULTI))
    )


def geojson_vertices(df: DataFrame, id_col: str = "poly_id", text_col: str = "geojson") -> DataFrame:
    """Explode GeoJSON polygons into the vertex table (three ``posexplode`` levels).

    Coordinates stay as given (lon, lat for WGS84 input): ``px`` = first ordinate.
    """
    parts = df.select(F.col(id_col).cast("string").alias("poly_id"), geojson_parts(F.col(text_col)).alias("parts"))
    p = parts.select("poly_id", F.posexplode("parts").alias("part", "rings"))
    r = p.select("poly_id", "part", F.posexplode("rings").alias("ring", "verts"))
    v = r.select("poly_id", "part", "ring", F.posexplode("verts").alias("seq", "xy"))
    return v.select(
        "poly_id",
        F.col("part").cast("int").alias("part"),
        F.col("ring").cast("int").alias("ring"),
        F.col("seq").cast("int").alias("seq"),
        F.col("xy")[0].alias("px"),
        F.col("xy")[1].alias("py"),
    )


def vertex_rows(polys: dict[str, list[list[list[tuple[float, float]]]]], scale: float = 1.0) -> list[tuple]:
    """Flatten ``{poly_id: [part[ring[(x, y)]]]}`` into closed-ring vertex rows."""
    rows = []
    for pid, parts in polys.items():
        for pi, rings in enumerate(parts):
            for ri, ring in enumerate(rings):
                pts = list(ring)
                if pts[0] != pts[-1]:
                    pts.append(pts[0])
                for si, (x, y) in enumerate(pts):
                    rows.append((pid, pi, ri, si, float(x) * scale, float(y) * scale))
    return rows


RING_SCHEMA = T.StructType(
    [
        T.StructField("poly_id", T.StringType(), False),
        T.StructField("part", T.IntegerType(), False),
        T.StructField("ring", T.IntegerType(), False),
        T.StructField("coords", T.ArrayType(T.ArrayType(T.DoubleType(), False), False), False),
    ]
)


def rings_df(spark: SparkSession, polys: dict, scale: float = 1.0) -> DataFrame:
    """Ring table of small, fixed polygons: one row per ring with its closed coordinate array."""
    rows: dict[tuple, list] = {}
    for pid, pi, ri, _, x, y in vertex_rows(polys, scale):
        rows.setdefault((pid, pi, ri), []).append([x, y])
    return spark.createDataFrame([(p, a, b, c) for (p, a, b), c in rows.items()], RING_SCHEMA)


def geojson_rings(df: DataFrame, id_col: str = "poly_id", text_col: str = "geojson") -> DataFrame:
    """GeoJSON polygons -> ring table ``(poly_id, part, ring, coords)`` (two ``posexplode`` levels)."""
    parts = df.select(F.col(id_col).cast("string").alias("poly_id"), geojson_parts(F.col(text_col)).alias("parts"))
    p = parts.select("poly_id", F.posexplode("parts").alias("part", "rings"))
    r = p.select("poly_id", "part", F.posexplode("rings").alias("ring", "coords"))
    return r.select("poly_id", F.col("part").cast("int").alias("part"), F.col("ring").cast("int").alias("ring"), "coords")


def vertices_df(spark: SparkSession, polys: dict, scale: float = 1.0) -> DataFrame:
    """Vertex table of small, fixed polygons (a query input; size bounded by the literal)."""
    return spark.createDataFrame(vertex_rows(polys, scale), VERTEX_SCHEMA)


# ---------------------------------------------------------------------------
# Test polygons in cell units of a 128 x 128 grid (y grows south).
# Scaled by N / 128 for an N x N grid (a power-of-two factor: exact in doubles).
# ---------------------------------------------------------------------------
FIXTURE_GRID = 128

TEST_POLYGONS: dict[str, list[list[list[tuple[float, float]]]]] = {
    "hole": [
        [
            [(10.2, 8.7), (110.1, 15.3), (95.6, 70.2), (120.4, 118.9), (30.3, 122.1), (60.8, 66.4)],
            [(70.3, 30.2), (90.7, 33.1), (80.1, 55.6)],
        ]
    ],
    "two_parts": [
        [[(5.1, 5.2), (40.3, 6.4), (38.7, 41.9), (6.6, 39.8)]],
        [[(70.2, 80.1), (120.9, 85.3), (99.4, 121.7)]],
    ],
    "thin": [[[(3.1, 60.2), (125.7, 60.6), (125.3, 60.9), (3.4, 60.7)]]],
    "outside": [[[(-50.5, -40.5), (-10.5, -40.5), (-30.5, -5.5)]]],
    "aligned": [[[(16.0, 16.0), (48.0, 16.0), (48.0, 48.0), (16.0, 48.0)]]],
}

FLAGSHIP = "hole"


def test_polygons(spark: SparkSession, n: int, names: list[str] | None = None) -> DataFrame:
    """Ring table of the chosen test polygons scaled to an N x N grid."""
    chosen = {k: v for k, v in TEST_POLYGONS.items() if names is None or k in names}
    return rings_df(spark, chosen, scale=n / FIXTURE_GRID)


def to_geojson_polygon_text(parts: list[list[list[tuple[float, float]]]]) -> str:
    """GeoJSON text (Polygon for one part, else MultiPolygon) with closed rings."""
    import json

    def close(r):
        r = [list(map(float, p)) for p in r]
        return r if r[0] == r[-1] else r + [r[0]]

    coords = [[close(r) for r in rings] for rings in parts]
    if len(coords) == 1:
        return json.dumps({"type": "Polygon", "coordinates": coords[0]})
    return json.dumps({"type": "MultiPolygon", "coordinates": coords})


# ---------------------------------------------------------------------------
# A published example polygon in WGS84 lon/lat (8 vertices, closed)
# and its planar area in EPSG:5070 square metres as recorded by the reference run.
# ---------------------------------------------------------------------------
EXAMPLE_POLYGON_LONLAT = [
    (-75.220813751220703, 39.932512033740309),
    (-75.150260925292969, 39.929221201562726),
    (-75.120391845703125, 39.924350479594167),
    (-75.124168395996094, 39.894723763816785),
    (-75.192832946777344, 39.89643587838578),
    (-75.229225158691406, 39.903810652180944),
    (-75.224761962890625, 39.928957928153828),
    (-75.220813751220703, 39.932512033740309),
]
EXAMPLE_POLYGON_AREA_M2 = 3.261282488501819e7
EXAMPLE_POLYGON_CELLS = 36249  # cells of the 30 m grid under the cell-centre rule

# A hand-drawn polygon in WGS84 lon/lat (39 vertices, closed) and its
# planar area in EPSG:5070 square metres as recorded by the reference run.
HAND_DRAWN_POLYGON_LONLAT = [
    (-76.783447265625, 38.44068226417387),
    (-76.7010498046875, 38.831149809348744),
    (-77.069091796875, 39.27053717095511),
    (-76.915283203125, 39.48284540453334),
    (-76.6790771484375, 39.53793974517628),
    (-76.79443359375, 39.6437675734185),
    (-77.1624755859375, 39.67337039176558),
    (-77.398681640625, 39.38526381099774),
    (-77.6678466796875, 39.50404070558415),
    (-77.86560058593749, 39.46164364205549),
    (-77.904052734375, 39.33429742980725),
    (-77.95898437499999, 39.18117526158749),
    (-78.1842041015625, 39.11727568585598),
    (-78.1842041015625, 39.33854604847979),
    (-78.37646484375, 39.58452390500424),
    (-78.760986328125, 39.41497702499074),
    (-78.651123046875, 39.10022600175347),
    (-78.3544921875, 38.81403111409755),
    (-78.5302734375, 38.58252615935333),
    (-78.2501220703125, 38.39764411353178),
    (-77.926025390625, 38.29424797320529),
    (-77.794189453125, 38.50948995925553),
    (-78.0084228515625, 38.67264490154078),
    (-77.82714843749999, 38.843986129756615),
    (-77.5799560546875, 38.46219172306828),
    (-77.7117919921875, 37.94419750075404),
    (-77.28881835937499, 37.93986540897977),
    (-77.2613525390625, 38.20797181420939),
    (-77.069091796875, 38.13455657705411),
    (-77.200927734375, 38.363195134453846),
    (-77.398681640625, 38.634036452919226),
    (-77.091064453125, 38.44068226417387),
    (-77.025146484375, 38.591113776147445),
    (-76.9482421875, 38.38472766885085),
    (-76.871337890625, 38.33734763569314),
    (-76.80541992187499, 38.3287297527893),
    (-76.728515625, 38.36750215395045),
    (-76.7010498046875, 38.42777351132902),
    (-76.783447265625, 38.44068226417387),
]
HAND_DRAWN_POLYGON_AREA_M2 = 1.8568230076630947e10
HAND_DRAWN_POLYGON_CELLS = 20631339  # cells of the 30 m grid under the cell-centre rule


def read_geojson_files(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON text resources read whole (line breaks become spaces) -> vertex table.

    ``poly_id`` is the file name without extension.
    """
    t = spark.read.text(path, wholetext=True).select(
        F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.[^./]*)?$", 1).alias("poly_id"),
        F.regexp_replace("value", r"\r?\n", " ").alias("geojson"),
    )
    return geojson_vertices(t)


def transform_coords(polys: DataFrame, fn) -> DataFrame:
    """Apply ``fn(x, y) -> (x', y')`` (Column expressions, e.g. ``crs.albers_xy``) to every
    vertex of a ring table or a vertex table."""
    if "coords" in polys.columns:
        def one(p):
            x, y = fn(p[0], p[1])
            return F.array(x, y)

        return polys.withColumn("coords", F.transform("coords", one))
    x, y = fn(F.col("px"), F.col("py"))
    return polys.withColumns({"px": x, "py": y})  # both from the original coordinates
