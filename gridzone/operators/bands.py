"""Band maths, point look-ups and model-versus-label evaluation on cell layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridzone.operators.zonal import data_cells

# Label classes 0..5 of the land-cover labels and model predictions,
# names verbatim as shown to users (including the spelling of class 2).
LABEL_NAMES = ["Impervious Surfaces", "Building", "Low Vegitation", "Trees", "Cars", "Clutter"]


def point_value(points: DataFrame, layer: DataFrame, cx: Column, cy: Column) -> DataFrame:
    """Value of the cell under each point: ``(pid, x, y, value)``; points off data drop out."""
    p = points.select("pid", cx.cast("bigint").alias("x"), cy.cast("bigint").alias("y"))
    return p.join(data_cells(layer, "value"), ["x", "y"])


def point_diff(points: DataFrame, l1: DataFrame, l2: DataFrame, cx: Column, cy: Column) -> DataFrame:
    """Both layers' values under each point: ``(pid, x, y, value1, value2)`` (NULL where absent)."""
    p = points.select("pid", cx.cast("bigint").alias("x"), cy.cast("bigint").alias("y"))
    j = p.join(data_cells(l1, "value1"), ["x", "y"], "left").join(data_cells(l2, "value2"), ["x", "y"], "left")
    return j.filter(F.col("value1").isNotNull() | F.col("value2").isNotNull())


def layer_diff(l1: DataFrame, l2: DataFrame) -> DataFrame:
    """Per-cell ``v1 - v2`` where both hold data."""
    return data_cells(l1, "v1").join(data_cells(l2, "v2"), ["x", "y"]).select(
        "x", "y", (F.col("v1") - F.col("v2")).alias("v")
    )


def layer_diff4(l: DataFrame, l1: DataFrame, l2: DataFrame, l3: DataFrame) -> DataFrame:
    """Per-cell ``(l - l1) - (l2 - l3)``: difference of two differences."""
    j = reduce(lambda a, b: a.join(b, ["x", "y"]),
               [data_cells(d, f"v{i}") for i, d in enumerate([l, l1, l2, l3])])
    return j.select("x", "y", ((F.col("v0") - F.col("v1")) - (F.col("v2") - F.col("v3"))).alias("v"))


def band_select(img: DataFrame, composite: str) -> DataFrame:
    """Pick three bands into a composite: ``rgb`` = (b0, b1, b2), ``irrg`` = (b3, b0, b1)."""
    order = {"rgb": ["b0", "b1", "b2"], "irrg": ["b3", "b0", "b1"]}[composite]
    return img.select("x", "y", F.lit(composite).alias("composite"),
                      *[F.col(b).alias(f"c{i}") for i, b in enumerate(order)])


def grayscale(r: Column, g: Column, b: Column) -> Column:
    """Luma 0.299 R + 0.587 G + 0.114 B, rounded half up."""
    return F.floor(F.lit(0.299) * r + F.lit(0.587) * g + F.lit(0.114) * b + F.lit(0.5))


def ndvi(ir: Column, red: Column) -> Column:
    """(IR - R) / (IR + R); NULL when the sum is 0."""
    s = ir + red
    return F.when(s != 0, (ir - red) / s)


def weighted_overlay(layers: dict[str, DataFrame], weights: dict[str, float]) -> DataFrame:
    """Σ wᵢ·vᵢ per cell over the layers with a non-zero weight.

    One union of the long-form layers and one ``groupBy(x, y)`` (partial
    aggregation map-side) instead of a chain of joins; a cell counts only when
    every weighted layer holds data there.
    """
    bad = {k: w for k, w in weights.items() if not -5 <= w <= 5}
    if bad:
        raise ValueError(f"weights must lie in -5..5: {bad}")
    active = [(k, w) for k, w in weights.items() if w != 0]
    if not active:
        raise ValueError("no layer with a non-zero weight")
    longs = [data_cells(layers[k]).select("x", "y", (F.col("v") * F.lit(float(w))).alias("wv")) for k, w in active]
    u = reduce(DataFrame.unionByName, longs)
    agg = u.groupBy("x", "y").agg(F.sum("wv").alias("value"), F.count(F.lit(1)).alias("k"))
    return agg.filter(F.col("k") == len(active)).select("x", "y", "value")


def label_names(spark) -> DataFrame:
    return spark.createDataFrame([(i, n) for i, n in enumerate(LABEL_NAMES)], "cls BIGINT, name STRING")


def label_lookup(cells: DataFrame, cls_col: str, spark) -> DataFrame:
    """Class id -> class name (six-row table, broadcast)."""
    return cells.join(F.broadcast(label_names(spark)), F.col(cls_col) == F.col("cls"), "left").drop("cls")


def prediction_incorrect(tp: DataFrame, pred: str) -> DataFrame:
    """Cells where the prediction differs from the label: ``(x, y, pred, truth)``."""
    return tp.filter(F.col(pred) != F.col("truth")).select("x", "y", F.col(pred).alias("pred"), "truth")


def confusion_matrix(tp: DataFrame, pred: str) -> DataFrame:
    return tp.groupBy("truth", F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def prediction_ab(tp: DataFrame, a: str = "pred_a", b: str = "pred_b") -> DataFrame:
    """Agreement class per cell and counts: both right / A only / B only / neither."""
    ra, rb = F.col(a) == F.col("truth"), F.col(b) == F.col("truth")
    cat = (F.when(ra & rb, "both").when(ra, "a_only").when(rb, "b_only").otherwise("neither"))
    return tp.groupBy(cat.alias("category")).agg(F.count(F.lit(1)).alias("n"))


def class_probability(probs: DataFrame, label_id: int) -> DataFrame:
    """Band ``label_id`` of a class-probability layer."""
    return probs.select("x", "y", F.get(F.col("probs"), label_id).alias("p"))
