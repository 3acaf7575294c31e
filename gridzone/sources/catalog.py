"""Layer catalog on shared storage: z-ordered parquet layers + JSON metadata.

Layout under ``root``::

    root/<layer>/zoom=<z>/version=<n>/zc=<folder>/*.parquet     cells (key_col, key_row, z, x, y, v)
    root/_meta/layer=<layer>/zoom=<z>/version=<n>/*.json        one metadata record per version

A write goes to a new version folder and counts once its metadata record is
there: that one small file publishes cells and metadata together, and readers take the newest version
that has one. A write that fails leaves the layer as it was; versions before the one it replaced are removed
after the next write. Listing and metadata read the records only.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridzone.operators.layout import layout_meta, with_keys, zorder

META_SCHEMA = (
    "zoom INT, cell_type STRING, layout_cols INT, layout_rows INT, tile_cols INT, tile_rows INT, "
    "min_key_col BIGINT, min_key_row BIGINT, end_key_col BIGINT, end_key_row BIGINT, "
    "xmin DOUBLE, ymin DOUBLE, xmax DOUBLE, ymax DOUBLE, crs STRING, n_cells BIGINT"
)


def layer_path(root: str, layer: str, zoom: int = 0) -> str:
    return f"{root.rstrip('/')}/{layer}/zoom={zoom}"


def zordered(cells: DataFrame, tile: int) -> DataFrame:
    """Cells with tile keys and their Z-curve key, range-partitioned and sorted by it.

    Range partitioning on z gives each output file a compact block of tiles,
    so parquet min/max statistics on key_col/key_row/z prune polygon reads.
    """
    k = with_keys(cells, tile).withColumn("z", zorder(F.col("key_col"), F.col("key_row")))
    return k.repartitionByRange("z").sortWithinPartitions("z", "y", "x")


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _records(spark: SparkSession, root: str) -> DataFrame:
    """The metadata record of every published version."""
    fields = META_SCHEMA.replace("zoom INT, ", "")
    return spark.read.schema(f"{fields}, layer STRING, zoom INT, version BIGINT").json(f"{root.rstrip('/')}/_meta")


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def versions(spark: SparkSession, root: str, layer: str, zoom: int = 0) -> list[int]:
    """Published versions of a layer, oldest first."""
    if not _exists(spark, f"{root.rstrip('/')}/_meta"):
        return []
    rows = _records(spark, root).where((F.col("layer") == layer) & (F.col("zoom") == zoom)).select("version").distinct().collect()
    return sorted(r["version"] for r in rows)


def write_layer(cells: DataFrame, root: str, layer: str, grid: int | tuple[int, int], tile: int, cell_type: str,
                zoom: int = 0, keep: int = 2) -> None:
    """Write (replace) a layer and its metadata record; ``grid`` is the side or (width, height) in cells.

    The last ``keep`` versions stay, so queries that read the layer as it was can end.
    """
    spark = cells.sparkSession
    before = versions(spark, root, layer, zoom)
    version = max(time.time_ns(), *(v + 1 for v in before), 0)
    path = f"{layer_path(root, layer, zoom)}/version={version}"
    stored = zordered(cells, tile).select("key_col", "key_row", "z", "x", "y", "v", folder(F.col("z")).alias("zc"))
    stored.write.partitionBy("zc").parquet(path)
    written = spark.read.schema(stored.schema).parquet(path)
    meta = layout_meta(written, layer, grid, tile, cell_type).drop("layer", "zoom")
    meta.coalesce(1).write.json(f"{root.rstrip('/')}/_meta/layer={layer}/zoom={zoom}/version={version}")
    for old in before[: max(0, len(before) + 1 - keep)]:
        _remove(spark, f"{root.rstrip('/')}/_meta/layer={layer}/zoom={zoom}/version={old}")
        _remove(spark, f"{layer_path(root, layer, zoom)}/version={old}")


def read_layer(spark: SparkSession, root: str, layer: str, zoom: int = 0, partitions: int | None = None) -> DataFrame:
    """Read the newest version of a stored layer; ``partitions`` spreads a full scan over that many tasks."""
    known = versions(spark, root, layer, zoom)
    if not known:
        raise FileNotFoundError(f"no layer {layer} at zoom {zoom} in {root}")
    df = spark.read.parquet(f"{layer_path(root, layer, zoom)}/version={known[-1]}").withColumn("zc", F.col("zc").cast("bigint"))
    return df.repartition(partitions) if partitions else df


def list_layers(spark: SparkSession, root: str) -> DataFrame:
    """``(layer, zoom)`` of every layer in the catalog."""
    return _records(spark, root).select("layer", "zoom").distinct()


def read_meta(spark: SparkSession, root: str, layer: str | None = None) -> DataFrame:
    """The newest metadata record of each layer, or of one."""
    m = _records(spark, root)
    m = m if layer is None else m.filter(F.col("layer") == layer)
    row = F.max_by(F.struct(*(c for c in m.columns if c not in ("layer", "zoom", "version"))), "version").alias("r")
    return m.groupBy("layer", "zoom").agg(row).select("layer", "zoom", "r.*")


def meta_json(meta: DataFrame) -> DataFrame:
    """Metadata rows as nested JSON text (extent / layout / bounds / cellType / crs)."""
    return meta.select(
        "layer", "zoom",
        F.to_json(F.struct(
            F.struct("xmin", "ymin", "xmax", "ymax").alias("extent"),
            F.struct(
                F.struct("xmin", "ymin", "xmax", "ymax").alias("extent"),
                F.struct(
                    F.col("layout_cols").alias("layoutCols"), F.col("layout_rows").alias("layoutRows"),
                    F.col("tile_cols").alias("tileCols"), F.col("tile_rows").alias("tileRows"),
                ).alias("tileLayout"),
            ).alias("layoutDefinition"),
            F.struct(
                F.struct(F.col("min_key_col").alias("col"), F.col("min_key_row").alias("row")).alias("minKey"),
                F.struct((F.col("end_key_col") - 1).alias("col"), (F.col("end_key_row") - 1).alias("row")).alias("maxKey"),
            ).alias("bounds"),
            F.col("cell_type").alias("cellType"),
            "crs",
        )).alias("metadata"),
    )


# Layer metadata files as written by tile-layer catalogs: a JSON array of two
# records, the layer id ``{name, zoom}`` and ``{header, metadata, keyIndex, schema}``.
_EXTENT = "struct<xmin: double, ymin: double, xmax: double, ymax: double>"
_KEY = "struct<col: int, row: int>"
CATALOG_META_SCHEMA = (
    "array<struct<name: string, zoom: int, "
    "header: struct<format: string, key: string, keyClass: string, valueClass: string, bucket: string>, "
    f"metadata: struct<extent: {_EXTENT}, layoutDefinition: struct<extent: {_EXTENT}, "
    "tileLayout: struct<layoutCols: int, layoutRows: int, tileCols: int, tileRows: int>>, "
    f"bounds: struct<minKey: {_KEY}, maxKey: {_KEY}>, cellType: string, crs: string>, "
    "keyIndex: struct<type: string>>>"
)


def read_catalog_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Metadata JSON files -> one flat row per layer (``keyIndex.properties`` and the
    Avro ``schema`` are not needed and not parsed). Files are read whole."""
    t = spark.read.text(path, wholetext=True).select(F.from_json("value", CATALOG_META_SCHEMA).alias("a"))
    id_rec = F.filter("a", lambda r: r["name"].isNotNull())[0]
    md_rec = F.filter("a", lambda r: r["metadata"].isNotNull())[0]
    m = t.select(id_rec.alias("i"), md_rec.alias("r"))
    return m.select(
        F.col("i.name").alias("layer"), F.col("i.zoom").alias("zoom"),
        F.col("r.metadata.cellType").alias("cell_type"),
        F.col("r.metadata.layoutDefinition.tileLayout.layoutCols").alias("layout_cols"),
        F.col("r.metadata.layoutDefinition.tileLayout.layoutRows").alias("layout_rows"),
        F.col("r.metadata.layoutDefinition.tileLayout.tileCols").alias("tile_cols"),
        F.col("r.metadata.layoutDefinition.tileLayout.tileRows").alias("tile_rows"),
        F.col("r.metadata.bounds.minKey.col").cast("bigint").alias("min_key_col"), F.col("r.metadata.bounds.minKey.row").cast("bigint").alias("min_key_row"),
        F.col("r.metadata.bounds.maxKey.col").cast("bigint").alias("max_key_col"), F.col("r.metadata.bounds.maxKey.row").cast("bigint").alias("max_key_row"),
        F.col("r.metadata.extent.xmin").alias("xmin"), F.col("r.metadata.extent.ymin").alias("ymin"),
        F.col("r.metadata.extent.xmax").alias("xmax"), F.col("r.metadata.extent.ymax").alias("ymax"),
        F.col("r.metadata.crs").alias("crs"), F.col("r.keyIndex.type").alias("key_index"),
        F.col("r.header.format").alias("format"),
    ).withColumn(
        # inclusive max keys must lie inside the half-open layout [0, cols) x [0, rows)
        "bounds_ok",
        (F.col("min_key_col") >= 0) & (F.col("min_key_row") >= 0)
        & (F.col("max_key_col") < F.col("layout_cols")) & (F.col("max_key_row") < F.col("layout_rows")),
    )


# Bits of the Z-curve key below a folder: 2^10 tiles (32 x 32) share one, so a grid of a million tiles has about
# a thousand folders. Inside a folder files are sorted by z, whose row-group statistics prune further.
FOLDER_BITS = 10


def folder(z: Column) -> Column:
    """Folder key ``zc`` of a tile's Z-curve key."""
    return F.shiftright(z, FOLDER_BITS)


def folder_rows() -> int:
    """Rows of tiles in a folder."""
    return 1 << FOLDER_BITS // 2


def write_tiled(df: DataFrame, path: str, tile: int, row: Column | None = None) -> None:
    """Write a cell-keyed table in the order of the Z-curve key ``z`` of its tiles, in folders of 2^FOLDER_BITS tiles (``zc``).

    ``row`` is the row coordinate used for the tile (default ``y``; the prefix
    table passes ``blk * K``). Range partitioning on z splits a large folder over
    several files; a query's join on ``zc`` prunes folders, on ``z`` row groups.
    """
    r = F.col("y") if row is None else row
    z = zorder(F.floor(F.col("x") / tile), F.floor(r / tile))
    order = [c for c in ("x", "y", "blk") if c in df.columns]
    keyed = df.withColumn("z", z).withColumn("zc", folder(F.col("z")))
    keyed.repartitionByRange("z", "x").sortWithinPartitions("zc", "z", *order).write.mode("overwrite").partitionBy("zc").parquet(path)


def read_tiled(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("zc", F.col("zc").cast("bigint"))


def z_ranges(keys: DataFrame, width: int, height: int, tile: int, most: int = 64) -> list[tuple[int, int]]:
    """Z-curve ranges (first, last) that hold all tile keys ``(key_col, key_row)`` of a grid.

    Keys are grouped by the leading bits of z, as many as give at most ``most``
    groups on this grid; only each group's first and last z reach the driver.
    """
    side = max(1, -(-max(width, height) // tile))
    drop = 0
    while (-(-side >> drop)) ** 2 > most:
        drop += 1
    z = keys.select(zorder(F.col("key_col"), F.col("key_row")).alias("z"))
    g = z.groupBy(F.shiftright("z", 2 * drop).alias("g")).agg(F.min("z").alias("a"), F.max("z").alias("b"))
    return [(r.a, r.b) for r in g.orderBy("a").collect()]


#: Intervals of all polygons that reach the driver at most, however many polygons a zone has.
INTERVALS = 4096


def zone_ranges(vertices: DataFrame, width: int, height: int, tile: int, most: int = 64) -> list[tuple[int, int]]:
    """Z-curve ranges (first, last) of the tiles that polygons meet, each polygon by its own (``cover.z_intervals``), so zones far apart do
    not take in what lies between them.

    With more than INTERVALS polygons the intervals are grouped by the leading bits of z instead, as ``z_ranges`` does.
    """
    from gridzone.operators.cover import z_intervals

    polygons = vertices.select("poly_id").distinct().count()
    if polygons > INTERVALS:
        from gridzone.operators.vector import covering_keys

        return z_ranges(covering_keys(vertices, width, height, tile), width, height, tile, most)
    per = max(1, min(most, INTERVALS // max(1, polygons)))
    found = sorted((r["z0"], r["z1"]) for r in z_intervals(vertices, width, height, tile, per).collect())
    merged: list[tuple[int, int]] = []
    for a, b in found:
        if merged and a <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(merged[-1][1], b))
        else:
            merged.append((a, b))
    return closed(merged, most)


def closed(ranges: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """Ordered ranges with the smallest gaps closed, so that at most ``most`` are left."""
    gaps = sorted((right[0] - left[1] for left, right in zip(ranges, ranges[1:])), reverse=True)
    least = gaps[most - 1] if len(gaps) >= most else 0  # only gaps wider than this stay open
    out: list[tuple[int, int]] = []
    for a, b in ranges:
        if out and a - out[-1][1] <= least:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


#: Ranges that a row is compared with at most: every row read pays for each, while the folders come from all ranges.
LITERALS = 8


def in_ranges(layer: DataFrame, ranges: list[tuple[int, int]]) -> DataFrame:
    """Rows in the folders of the ranges and, with the smallest gaps closed, between the ends of one of them: prunes folders (``zc``) and
    row groups (``z``) at planning time, with no join and so the same for any number of keys. The keys themselves decide
    afterwards; rows between ranges may come along."""
    keep = F.lit(False)
    for a, b in closed(ranges, LITERALS):
        keep = keep | F.col("z").between(a, b)
    return in_folders(layer, ranges).filter(keep)


def in_folders(layer: DataFrame, ranges: list[tuple[int, int]]) -> DataFrame:
    """Rows in the folders and between the ends of the ranges: what a join on the tile key wants pruned beforehand."""
    if not ranges:
        return layer.filter(F.lit(False))
    folders = sorted({zc for a, b in ranges for zc in range(a >> FOLDER_BITS, (b >> FOLDER_BITS) + 1)})
    return layer.filter(F.col("zc").isin(folders) & F.col("z").between(ranges[0][0], ranges[-1][1]))
