"""Tiles, retiling, z-order, catalog writes, timing CSV and text helpers."""

import os
import random
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from gridzone.functions.text import ordinal, sentence_case
from gridzone.operators import layout
from gridzone.session import ensure_checkpoint_dir
from gridzone.sources import catalog, reports
from gridzone.sources.polygons import TEST_POLYGONS, geojson_vertices, vertices_df


def _cells(spark, w, h, seed=1):
    rng = random.Random(seed)
    rows = [(x, y, rng.randrange(100)) for x in range(w) for y in range(h) if rng.random() > 0.2]
    return spark.createDataFrame(rows, "x bigint, y bigint, v bigint"), rows


def test_tiles_round_trip_and_retile_keep_cells(spark):
    cells, rows = _cells(spark, 32, 24)
    tiles = layout.to_tiles(cells, 8)
    assert all(len(r.data) == 64 * 8 for r in tiles.where("not constant").collect())
    back = {(r.x, r.y, r.v) for r in layout.from_tiles(tiles, 8).collect()}
    assert back == set(rows)
    small = layout.retile(tiles, 8, 2)
    assert {(r.x, r.y, r.v) for r in layout.from_tiles(small, 2).collect()} == set(rows)
    assert small.select("key_col").agg(F.max("key_col")).first()[0] == 15
    with pytest.raises(ValueError):
        layout.retile(tiles, 8, 3)


def test_zorder_is_a_bijection_with_known_values(spark):
    keys = spark.range(4096).select((F.col("id") % 64).alias("c"), F.floor(F.col("id") / 64).alias("r"))
    z = keys.select("c", "r", layout.zorder(F.col("c"), F.col("r")).alias("z"))
    assert z.select("z").distinct().count() == 4096
    assert z.agg(F.max("z")).first()[0] == 4095
    known = {(r.c, r.r): r.z for r in z.filter("c < 3 AND r < 2").collect()}
    assert known == {(0, 0): 0, (1, 0): 1, (0, 1): 2, (1, 1): 3, (2, 0): 4, (2, 1): 6}


def test_convert_nodata_and_band_stack(spark):
    df = spark.createDataFrame([(1,), (-128,), (7,)], "v int")
    assert [r.c for r in df.select(layout.convert_nodata(F.col("v"), -128).alias("c")).collect()] == [1, None, 7]
    cells, _ = _cells(spark, 8, 8)
    st = layout.band_stack(layout.to_tiles(cells, 8)).first()
    assert len(st.bands) == 64 and st.bands[0] == st.bands[63] and len(st.bands[0].data) == 64 * 8


def test_key_extent_and_retile_meta(spark):
    k = spark.createDataFrame([(0, 0), (2, 1)], "key_col bigint, key_row bigint")
    e = {(r.key_col, r.key_row): (r.xmin, r.ymin, r.xmax, r.ymax) for r in layout.key_extent(k, 512).collect()}
    assert e[(0, 0)] == (-2493045.0, 3310725.0 - 15360.0, -2493045.0 + 15360.0, 3310725.0)
    cells, _ = _cells(spark, 64, 64)
    meta = layout.layout_meta(cells, "t", 64, 16, "int32")
    r = layout.retile_meta(meta, 4).first()
    assert (r.layout_cols, r.tile_cols, r.exact) == (16, 4, True)


def test_catalog_write_overwrite_list(spark):
    root = tempfile.mkdtemp(prefix="catalog-", dir=ensure_checkpoint_dir(spark))
    cells, rows = _cells(spark, 16, 16)
    catalog.write_layer(cells, root, "lc", 16, 8, "int64")
    catalog.write_layer(cells.filter("v < 50"), root, "lc", 16, 8, "int64")  # replaces the first write
    catalog.write_layer(cells, root, "soil", 16, 8, "int64")
    got = catalog.read_layer(spark, root, "lc")
    assert got.count() == sum(1 for r in rows if r[2] < 50)
    assert {(r.layer, r.zoom) for r in catalog.list_layers(spark, root).collect()} == {("lc", 0), ("soil", 0)}
    m = catalog.read_meta(spark, root, "soil").first()
    assert (m.layout_cols, m.tile_cols, m.n_cells) == (2, 8, len(rows))
    js = catalog.meta_json(catalog.read_meta(spark, root, "soil")).first().metadata
    assert '"tileLayout":{"layoutCols":2' in js
    assert len(catalog.versions(spark, root, "lc")) == 2
    # files of one layer are range-partitioned on the z key: z ranges of files do not overlap much
    assert "z" in got.columns


def test_timings_csv_round_trip_and_merged_first_line(spark):
    root = tempfile.mkdtemp(prefix="timings-", dir=ensure_checkpoint_dir(spark))
    df = spark.createDataFrame([("poly a", 1.5e10, "Baseline", 6858), ("poly a", 1.5e10, "Marching: 32 x 32", 9797)],
                               reports.TIMING_SCHEMA)
    reports.write_timings(df, root + "/ok")
    text = "".join(open(os.path.join(root, "ok", f)).read() for f in sorted(os.listdir(root + "/ok")) if f.endswith(".csv"))
    assert text.startswith('"Polygon Name","Polygon Area","Algo Name","Time (ms)"')
    assert '"poly a","1.5E10","Baseline","6858"' in text
    back = reports.read_timings(spark, root + "/ok").collect()
    assert sorted((r.algo, r.ms) for r in back) == [("Baseline", 6858), ("Marching: 32 x 32", 9797)]
    broken = os.path.join(root, "broken.csv")
    with open(broken, "w") as f:
        f.write('"Polygon Name","Polygon Area","Algo Name","Time (ms)"\\n"p","3.2E7","Baseline","376"\n'
                '"p","3.2E7","Marching: 32 x 32","951"\n')
    rows = reports.read_timings(spark, broken).collect()
    assert sorted((r.polygon, r.area, r.algo, r.ms) for r in rows) == [
        ("p", 3.2e7, "Baseline", 376), ("p", 3.2e7, "Marching: 32 x 32", 951)]


def test_geojson_feature_round_trip(spark):
    v = vertices_df(spark, {k: TEST_POLYGONS[k] for k in ("hole", "two_parts")})
    feats = reports.geojson_feature(v)
    back = geojson_vertices(feats, "poly_id", "feature")
    norm = lambda df: sorted(tuple(r) for r in df.select("poly_id", "part", "ring", "seq", "px", "py").collect())
    assert norm(back) == norm(v)


def _js_sentence_case(s):
    return re.sub(r"[A-Za-z0-9_]\S*", lambda m: m.group(0)[0].upper() + m.group(0)[1:].lower(), s)


def test_sentence_case_matches_regex_rule(spark):
    samples = ["hello world", "HELLO  wORLD", "(abc def", "x-ray vision", "  lead", "tab\tsep", "a", "", "élan vital", "__init__ me"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r.o for r in df.select(sentence_case(F.col("s")).alias("o")).collect()]
    assert got == [_js_sentence_case(s) for s in samples]


def test_ordinal_labels(spark):
    df = spark.range(1, 125).select(F.col("id").alias("n"))
    got = {r.n: r.o for r in df.select("n", ordinal(F.col("n")).alias("o")).collect()}
    assert [got[i] for i in (1, 2, 3, 4, 11, 12, 13, 21, 22, 23, 101, 111, 112, 113, 121)] == [
        "1st", "2nd", "3rd", "4th", "11th", "12th", "13th", "21st", "22nd", "23rd", "101st", "111th", "112th", "113th", "121st"]


def test_catalog_metadata_files_and_geojson_resources(spark):
    import json

    from gridzone.operators import vector
    from gridzone.sources.polygons import read_geojson_files, to_geojson_polygon_text

    root = tempfile.mkdtemp(prefix="meta-", dir=ensure_checkpoint_dir(spark))
    ext = {"xmin": -100.0, "ymin": 0.0, "xmax": 1436.0, "ymax": 1024.0}
    doc = [
        {"name": "landcover-ts128", "zoom": 0},
        {"header": {"format": "file", "key": "k", "keyClass": "SpatialKey", "valueClass": "Tile", "bucket": "b"},
         "metadata": {"extent": ext, "layoutDefinition": {"extent": ext, "tileLayout": {
             "layoutCols": 12, "layoutRows": 8, "tileCols": 128, "tileRows": 128}},
             "bounds": {"minKey": {"col": 0, "row": 0}, "maxKey": {"col": 11, "row": 7}},
             "cellType": "int32", "crs": "+proj=aea"},
         "keyIndex": {"type": "zorder", "properties": {}}, "schema": {"type": "record"}},
    ]
    with open(os.path.join(root, "meta.json"), "w") as f:
        json.dump(doc, f, indent=2)
    m = catalog.read_catalog_metadata(spark, os.path.join(root, "meta.json")).first()
    assert (m.layer, m.zoom, m.layout_cols, m.tile_rows, m.max_key_col, m.key_index, m.cell_type, m.bounds_ok) == (
        "landcover-ts128", 0, 12, 128, 11, "zorder", "int32", True)
    doc[1]["metadata"]["bounds"]["maxKey"]["row"] = 8  # one past the last row of the layout
    with open(os.path.join(root, "meta_bad.json"), "w") as f:
        json.dump(doc, f)
    assert catalog.read_catalog_metadata(spark, os.path.join(root, "meta_bad.json")).first().bounds_ok is False

    gdir = os.path.join(root, "polys")
    os.makedirs(gdir)
    with open(os.path.join(gdir, "hole.json"), "w") as f:
        f.write(json.dumps(json.loads(to_geojson_polygon_text(TEST_POLYGONS["hole"])), indent=2))
    v = read_geojson_files(spark, gdir)
    assert {r.poly_id for r in v.select("poly_id").distinct().collect()} == {"hole"}
    spans = vector.polygon_spans(v, 128, 128)
    assert vector.zone_cell_count(spans).first()["n_cells"] == 6715


def test_address_record_shape(spark):
    from gridzone.operators.records import address_record

    df = spark.createDataFrame([("1 Main St", 39.95, -75.16, "19107"), ("Somewhere", 40.0, -75.1, None)],
                               "text string, lat double, lng double, zip string")
    r = df.select(address_record(F.col("text"), F.col("lat"), F.col("lng"), F.col("zip")).alias("a")).collect()
    assert r[0].a.text == "1 Main St" and r[0].a.latlng.lat == 39.95 and r[0].a.latlng.lng == -75.16
    assert r[0].a.zipCode == "19107" and r[1].a.zipCode is None


def test_a_failed_overwrite_leaves_the_old_layer(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="versions-", dir=ensure_checkpoint_dir(spark))
    cells, rows = _cells(spark, 16, 16)
    few = cells.filter("v < 50")
    catalog.write_layer(few, root, "lc", 16, 8, "int64")
    old = catalog.read_layer(spark, root, "lc")
    n = old.count()

    def fails(*_, **__):
        raise RuntimeError("between cells and metadata")

    with monkeypatch.context() as m:
        m.setattr(catalog, "layout_meta", fails)
        with pytest.raises(RuntimeError):
            catalog.write_layer(cells, root, "lc", 16, 8, "int64")
    bad = cells.withColumn("v", F.raise_error(F.lit("while cells are written")).cast("bigint"))
    with pytest.raises(Exception, match="while cells"):
        catalog.write_layer(bad, root, "lc", 16, 8, "int64")
    assert catalog.read_layer(spark, root, "lc").count() == n == catalog.read_meta(spark, root, "lc").first().n_cells
    catalog.write_layer(cells, root, "lc", 16, 8, "int64")
    assert catalog.read_layer(spark, root, "lc").count() == len(rows) == catalog.read_meta(spark, root, "lc").first().n_cells
    assert old.count() == n  # a reader of the version before can still end
    catalog.write_layer(few, root, "lc", 16, 8, "int64")
    assert len(catalog.versions(spark, root, "lc")) == 2 and catalog.list_layers(spark, root).count() == 1
    with pytest.raises(FileNotFoundError):
        catalog.read_layer(spark, root, "none")


@pytest.mark.parametrize("name", list(layout.CELL_TYPES))
def test_packed_tiles_round_trip_per_cell_type(spark, name):
    """Gaps, a constant tile, the type's extremes; through retiling and through the file form with the type's own no-data."""
    rng = random.Random(name)
    kind = layout.CELL_TYPES[name]
    if name == "bit":
        pool = [True, False]
    elif name.startswith("float"):
        pool = [0.0, -1.5, 2.0**20, -(2.0**-30), float("inf")]
    else:
        import numpy as np

        info = np.iinfo(kind.code)
        pool = [v for v in (info.min, info.max, 1, 2, 77) if v != kind.nodata and v < 2**63]
    rows = [(x, y, rng.choice(pool)) for x in range(16) for y in range(16) if rng.random() > (0 if name == "bit" else 0.3)]
    rows += [(x, y, pool[0]) for x in range(16, 24) for y in range(8)]
    cells = spark.createDataFrame(rows, f"x bigint, y bigint, v {kind.sql}")
    tiles = layout.to_tiles(cells, 8, cell_type=name)
    packed = tiles.collect()
    assert {r.cell_type for r in packed} == {name} and sum(r.constant for r in packed) == 1
    assert len(next(r for r in packed if r.constant).data) == (1 if name == "bit" else int(kind.code[2]))
    read = lambda t, side: sorted((r.x, r.y, r.v) for r in layout.from_tiles(t, side, name).collect())
    assert read(tiles, 8) == sorted(rows)
    assert read(layout.retile(tiles, 8, 2), 2) == sorted(rows)
    files = layout.with_nodata(tiles, 8)
    assert files.where("valid is not null").count() == 0
    assert read(layout.without_nodata(files, 8), 8) == sorted(rows)


def test_cells_that_no_type_can_hold(spark):
    cells = spark.createDataFrame([(0, 0, 300.7), (1, 0, -1.0), (2, 0, float("nan")), (3, 0, 255.9), (9, 9, -5.0)], "x bigint, y bigint, v double")
    tiles = layout.to_tiles(cells, 8)
    got = layout.from_tiles(layout.convert_tiles(tiles, 8, "uint8"), 8, "uint8").collect()
    assert [(r.x, r.y, r.v) for r in got] == [(3, 0, 255)]  # out of range: no data, the tile without any is gone
    assert layout.to_tiles(cells, 8, cell_type="uint16").count() == 1
    zero = layout.to_tiles(spark.createDataFrame([(0, 0, 0), (1, 0, 5)], "x bigint, y bigint, v bigint"), 2, cell_type="uint8")
    with pytest.raises(Exception, match="cannot be told from no data"):
        layout.with_nodata(zero, 2).collect()
    with pytest.raises(Exception, match="another cell type"):
        layout.from_tiles(zero, 2, "int64").collect()
    s = layout.tile_summary(layout.band_stack(zero, 3), 2).first()
    assert (s.n_data, s.sum_v) == (6, 15.0)
