"""Raster layers derived from the driver tables.

A layer is a long-form cell table ``(x BIGINT, y BIGINT, v)`` on an N x N
grid (x grows east, y grows south, row 0 at the north edge). A missing cell is
no-data; no sentinel values exist inside the engine.

Every layer is a ``groupBy(x, y)`` of a fact table, so each layer comes out
hash-partitioned on (x, y): the overlay join of two such layers reuses that
partitioning and adds no exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridzone.sources.tables import read_table

# Probability layer band count: one band per land-cover label class.
N_LABEL_CLASSES = 6


def _li(spark: SparkSession, sf_dir: str, cols: list[str]) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem", cols)


def _orders(spark: SparkSession, sf_dir: str, cols: list[str]) -> DataFrame:
    return read_table(spark, sf_dir, "orders", cols)


def _li_xy(n: int) -> list[Column]:
    return [(F.col("l_orderkey") % n).alias("x"), (F.col("l_partkey") % n).alias("y")]


def _ord_xy(n: int) -> list[Column]:
    return [(F.col("o_orderkey") % n).alias("x"), (F.col("o_custkey") % n).alias("y")]


def layer_a(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """16-class layer (land-cover role)."""
    return (
        _li(spark, sf_dir, ["l_orderkey", "l_partkey", "l_quantity"])
        .groupBy(*_li_xy(n))
        .agg((F.max(F.floor("l_quantity").cast("bigint")) % 16).alias("v"))
    )


def layer_b(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """4-class layer (soil-group role)."""
    return (
        _orders(spark, sf_dir, ["o_orderkey", "o_custkey", "o_totalprice"])
        .groupBy(*_ord_xy(n))
        .agg((F.max(F.round("o_totalprice").cast("bigint")) % 4).alias("v"))
    )


def layer_v(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Continuous value layer on the grid of ``layer_a`` (DSM / statistics role)."""
    return (
        _li(spark, sf_dir, ["l_orderkey", "l_partkey", "l_quantity"])
        .groupBy(*_li_xy(n))
        .agg(F.max("l_quantity").alias("v"))
    )


def layer_w(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Continuous value layer on the grid of ``layer_b`` (difference partner)."""
    return (
        _orders(spark, sf_dir, ["o_orderkey", "o_custkey", "o_totalprice"])
        .groupBy(*_ord_xy(n))
        .agg(F.round(F.max("o_totalprice") / 1000).alias("v"))
    )


def bands(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Four-band image (b0..b3 = red, green, blue, infrared roles)."""
    return (
        _li(spark, sf_dir, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"])
        .groupBy(*_li_xy(n))
        .agg(
            F.max("l_quantity").alias("b0"),
            F.max("l_linenumber").cast("double").alias("b1"),
            F.max(F.col("l_suppkey") % 256).cast("double").alias("b2"),
            F.max(F.col("l_partkey") % 256).cast("double").alias("b3"),
        )
    )


def probabilities(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Six-band class-probability layer: share of the cell's line items per class.

    ``probs[k]`` = share of rows with ``floor(l_quantity) % 6 = k``.
    """
    li = _li(spark, sf_dir, ["l_orderkey", "l_partkey", "l_quantity"])
    k = F.floor("l_quantity").cast("bigint") % N_LABEL_CLASSES
    counts = [F.sum(F.when(k == i, 1).otherwise(0)) for i in range(N_LABEL_CLASSES)]
    total = F.count(F.lit(1))
    return li.groupBy(*_li_xy(n)).agg(F.array(*[c / total for c in counts]).alias("probs"))


def truth_pred(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Per-cell label and two model predictions (classes 0..5).

    truth = layer_a % 6, pred_a = (layer_a + layer_b) % 6, pred_b = layer_b % 6,
    on cells where both layers hold data.
    """
    a = layer_a(spark, sf_dir, n).withColumnRenamed("v", "va")
    b = layer_b(spark, sf_dir, n).withColumnRenamed("v", "vb")
    return a.join(b, ["x", "y"]).select(
        "x",
        "y",
        (F.col("va") % 6).alias("truth"),
        ((F.col("va") + F.col("vb")) % 6).alias("pred_a"),
        (F.col("vb") % 6).alias("pred_b"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point table (lon/lat degrees) from ``events``.

    lon = -80 + (event_id % 997) / 997 * 5, lat = 40 + ((user_id*31 + event_id % 89) % 991) / 991 * 2
    """
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "value"])
    return ev.select(
        F.col("event_id").alias("pid"),
        "event_type",
        (F.lit(-80.0) + (F.col("event_id") % 997) / 997.0 * 5.0).alias("lon"),
        (F.lit(40.0) + ((F.col("user_id") * 31 + F.col("event_id") % 89) % 991) / 991.0 * 2.0).alias("lat"),
        F.col("value").alias("v"),
    )


# Extent of the point table on the N x N grid: lon -80..-75, lat 40..42 (row 0 at lat 42).
POINT_EXTENT = (-80.0, 40.0, -75.0, 42.0)


def lonlat_to_cell(lon: Column, lat: Column, n: int) -> tuple[Column, Column]:
    """Cell of a lon/lat point on the N x N grid that covers ``POINT_EXTENT``."""
    xmin, ymin, xmax, ymax = POINT_EXTENT
    x = F.floor((lon - F.lit(xmin)) / F.lit(xmax - xmin) * F.lit(float(n)))
    y = F.floor((F.lit(ymax) - lat) / F.lit(ymax - ymin) * F.lit(float(n)))
    return x, y
