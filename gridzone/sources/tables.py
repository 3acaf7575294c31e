"""Driver tables (parquet) and the grid size derived from them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan; selecting ``columns`` right at the scan keeps ReadSchema narrow."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def grid_size_for_rows(rows: int) -> int:
    """Grid side N: a power of two with about four line items per cell.

    The layers derived from the driver tables live on an N x N grid, so the
    raster grows with the tables (N = 32 / 128 / 512 at sf 0.001 / 0.01 / 0.1).
    """
    if rows <= 0:
        return 16
    return max(16, 2 ** int(round(math.log2(math.sqrt(rows / 4.0)))))


def grid_size(spark: SparkSession, sf_dir: str) -> int:
    """Grid side for the tables under ``sf_dir`` (a row count from parquet footers: no data pages are read)."""
    return grid_size_for_rows(spark.read.parquet(table_path(sf_dir, "lineitem")).count())


# Same rule in SQL, for the DuckDB oracle.
GRID_SQL = ("SELECT CASE WHEN count(*) = 0 THEN 16 ELSE greatest(16, CAST(power(2, round(log2(sqrt(greatest(count(*), 1) / 4.0)))) AS BIGINT)) END "
            "AS n FROM lineitem")
