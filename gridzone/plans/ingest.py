"""Ingest job: two class layers -> tile-partitioned stores for zonal queries.

Writes (replacing earlier output) under ``root``:

    a/, b/        the two layers, in the order and folders of the Z-curve key of their tiles
    ranks/        rank bitmaps per column and RANK_ROWS rows (x, tr, entries)

Both zonal methods then read only the tiles they need (dynamic partition
pruning): ``zonal_crosstab_tiled`` the covering tiles, ``zonal_crosstab_accum``
the tiles holding a span end.

    python -m gridzone.plans.ingest --sf-dir /root/testdata/sf0.1 [--root DIR] [--tile 128]

``--root`` defaults to the session's ``spark.checkpoint.dir`` (shared storage).
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridzone.operators import accum
from gridzone.sources import catalog


#: Rows of a row of rank bitmaps: four words a pair, so that counts above it are few beside the cells.
RANK_ROWS = 256


def ingest_class_layers(a: DataFrame, b: DataFrame, root: str, height: int, tile: int = 512, rank_rows: int = RANK_ROWS) -> dict[str, str]:
    """Write both layers and the rank bitmaps of their overlay; return the paths."""
    spark = a.sparkSession
    paths = {k: f"{root.rstrip('/')}/{k}" for k in ("a", "b", "ranks")}
    catalog.write_tiled(a.select("x", "y", "v"), paths["a"], tile)
    catalog.write_tiled(b.select("x", "y", "v"), paths["b"], tile)
    sa = catalog.read_tiled(spark, paths["a"]).drop("z", "zc")
    sb = catalog.read_tiled(spark, paths["b"]).drop("z", "zc")
    catalog.write_tiled(accum.rank_bitmaps(accum.overlay_pairs(sa, sb), height, rank_rows), paths["ranks"], tile, F.col("tr") * rank_rows)
    return paths


def open_ingested(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    return {k: catalog.read_tiled(spark, p) for k, p in paths.items()}


def main(argv: list[str] | None = None) -> None:
    from gridzone.session import ensure_checkpoint_dir, local_session
    from gridzone.sources import layers as L
    from gridzone.sources.tables import grid_size

    ap = argparse.ArgumentParser(description="Ingest the derived class layers into tile-partitioned stores.")
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--root", default=None)
    ap.add_argument("--tile", type=int, default=128)
    args = ap.parse_args(argv)
    spark = SparkSession.getActiveSession() or local_session()
    root = args.root or os.path.join(ensure_checkpoint_dir(spark), "ingest")
    n = grid_size(spark, args.sf_dir)
    paths = ingest_class_layers(L.layer_a(spark, args.sf_dir, n), L.layer_b(spark, args.sf_dir, n), root, n,
                                args.tile)
    for k, p in paths.items():
        print(k, p)


if __name__ == "__main__":
    main()
