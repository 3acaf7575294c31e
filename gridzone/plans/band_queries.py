"""Band maths, point look-ups and model evaluation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridzone.operators import bands as B
from gridzone.operators import stats
from gridzone.plans import sqlparts as S
from gridzone.plans.registry import query
from gridzone.sources import layers as L
from gridzone.sources.tables import grid_size

PT_CELL_SQL = ("CAST(floor((lon - (-80.0::DOUBLE)) / 5.0::DOUBLE * CAST(g.n AS DOUBLE)) AS BIGINT) AS x, "
               "CAST(floor((42.0::DOUBLE - lat) / 2.0::DOUBLE * CAST(g.n AS DOUBLE)) AS BIGINT) AS y")
N_BREAKS = 10
WEIGHTS = {"a": 2.0, "b": -1.0, "v": 0.0, "w": 3.0}
PROB_LABEL = 2


def _n(spark, sf):
    return grid_size(spark, sf)


def _pts_cells(spark: SparkSession, sf_dir: str, n: int):
    pts = L.points(spark, sf_dir)
    cx, cy = L.lonlat_to_cell(F.col("lon"), F.col("lat"), n)
    return pts, cx, cy


@query(
    "point_value",
    S.with_(S.grid(), S.layers("lv", "pts"), f"pc AS (SELECT pid, {PT_CELL_SQL} FROM pts, g)")
    + "SELECT pid, x, y, lv.v AS value FROM pc JOIN lv USING (x, y)",
)
def point_value_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value layer under every event point (cell look-up by equi-join on x, y)."""
    n = _n(spark, sf_dir)
    pts, cx, cy = _pts_cells(spark, sf_dir, n)
    return B.point_value(pts, L.layer_v(spark, sf_dir, n), cx, cy)


@query(
    "point_diff",
    S.with_(S.grid(), S.layers("lv", "lw", "pts"), f"pc AS (SELECT pid, {PT_CELL_SQL} FROM pts, g)")
    + "SELECT pid, x, y, lv.v AS value1, lw.v AS value2 FROM pc LEFT JOIN lv USING (x, y) LEFT JOIN lw USING (x, y) "
      "WHERE lv.v IS NOT NULL OR lw.v IS NOT NULL",
)
def point_diff_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both value layers under every event point (NULL where one has no data)."""
    n = _n(spark, sf_dir)
    pts, cx, cy = _pts_cells(spark, sf_dir, n)
    return B.point_diff(pts, L.layer_v(spark, sf_dir, n), L.layer_w(spark, sf_dir, n), cx, cy)


@query("layer_diff", S.with_(S.grid(), S.layers("lv", "lw")) + "SELECT x, y, lv.v - lw.v AS v FROM lv JOIN lw USING (x, y)")
def layer_diff_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-cell difference of the two value layers where both hold data."""
    n = _n(spark, sf_dir)
    return B.layer_diff(L.layer_v(spark, sf_dir, n), L.layer_w(spark, sf_dir, n))


@query(
    "layer_diff4",
    S.with_(S.grid(), S.layers("lv", "lw", "bands"))
    + "SELECT x, y, (lv.v - lw.v) - (bands.b2 - bands.b3) AS v FROM lv JOIN lw USING (x, y) JOIN bands USING (x, y)",
)
def layer_diff4_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-cell difference of two differences over four layers."""
    n = _n(spark, sf_dir)
    img = L.bands(spark, sf_dir, n)
    return B.layer_diff4(
        L.layer_v(spark, sf_dir, n), L.layer_w(spark, sf_dir, n),
        img.select("x", "y", F.col("b2").alias("v")), img.select("x", "y", F.col("b3").alias("v")),
    )


@query(
    "band_select",
    S.with_(S.grid(), S.layers("bands"))
    + "SELECT x, y, 'rgb' AS composite, b0 AS c0, b1 AS c1, b2 AS c2 FROM bands "
      "UNION ALL SELECT x, y, 'irrg' AS composite, b3 AS c0, b0 AS c1, b1 AS c2 FROM bands",
)
def band_select_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RGB and IR-R-G composites of the four-band image."""
    img = L.bands(spark, sf_dir, _n(spark, sf_dir))
    return B.band_select(img, "rgb").unionByName(B.band_select(img, "irrg"))


@query(
    "grayscale",
    S.with_(S.grid(), S.layers("bands"))
    + "SELECT x, y, CAST(floor(0.299::DOUBLE * b0 + 0.587::DOUBLE * b1 + 0.114::DOUBLE * b2 + 0.5::DOUBLE) AS BIGINT) AS gray FROM bands",
)
def grayscale_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Luma of the RGB bands, rounded half up."""
    img = L.bands(spark, sf_dir, _n(spark, sf_dir))
    return img.select("x", "y", B.grayscale(F.col("b0"), F.col("b1"), F.col("b2")).alias("gray"))


@query(
    "ndvi",
    S.with_(S.grid(), S.layers("bands"))
    + "SELECT x, y, CASE WHEN b3 + b0 <> 0 THEN round((b3 - b0) / (b3 + b0), 6) END AS ndvi FROM bands",
)
def ndvi_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised difference of the infrared and red bands (NULL where their sum is 0)."""
    img = L.bands(spark, sf_dir, _n(spark, sf_dir))
    return img.select("x", "y", F.round(B.ndvi(F.col("b3"), F.col("b0")), 6).alias("ndvi"))


_BREAKS_SQL = [
    "h AS (SELECT v, count(*) AS c FROM lv GROUP BY ALL)",
    "r AS (SELECT v, c, sum(c) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM h)",
    f"tg AS (SELECT CAST(i AS INTEGER) AS i, (i * (SELECT sum(c) FROM h) + {N_BREAKS - 1}) // {N_BREAKS} AS k FROM range(1, {N_BREAKS + 1}) t(i))",
    "brk AS (SELECT tg.i, r.v AS brk FROM tg JOIN r ON r.cum - r.c < tg.k AND tg.k <= r.cum)",
]


@query("class_breaks", S.with_(S.grid(), S.layers("lv"), _BREAKS_SQL) + "SELECT i, brk FROM brk")
def class_breaks_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten exact quantile breaks of the value layer (distributed ranks, no single-task sort)."""
    return stats.class_breaks(L.layer_v(spark, sf_dir, _n(spark, sf_dir)), "v", N_BREAKS)


@query(
    "classify_breaks",
    S.with_(S.grid(), S.layers("lv"), _BREAKS_SQL)
    + "SELECT x, y, CAST((SELECT count(*) FROM brk WHERE brk.brk <= lv.v) AS INTEGER) AS cls FROM lv",
)
def classify_breaks_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class index of every cell by the layer's breaks (colour-ramp class without the image)."""
    lv = L.layer_v(spark, sf_dir, _n(spark, sf_dir))
    return stats.classified(lv, "v", stats.class_breaks(lv, "v", N_BREAKS)).select("x", "y", "cls")


@query(
    "weighted_overlay",
    S.with_(S.grid(), S.layers("la", "lb", "lw"))
    + "SELECT x, y, la.v * 2.0 + lb.v * -1.0 + lw.v * 3.0 AS value FROM la JOIN lb USING (x, y) JOIN lw USING (x, y)",
)
def weighted_overlay_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted sum of the class and value layers (zero weights skipped)."""
    n = _n(spark, sf_dir)
    layers = {"a": L.layer_a(spark, sf_dir, n), "b": L.layer_b(spark, sf_dir, n),
              "v": L.layer_v(spark, sf_dir, n), "w": L.layer_w(spark, sf_dir, n)}
    return B.weighted_overlay(layers, WEIGHTS)


_NAMES_SQL = "nm AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{n}')" for i, n in enumerate(B.LABEL_NAMES)) + ") t(cls, name))"


_WO_SQL = ("wo AS (SELECT x, y, la.v * 2.0 + lb.v * -1.0 + lw.v * 3.0 AS value "
           "FROM la JOIN lb USING (x, y) JOIN lw USING (x, y))")


@query(
    "weighted_breaks",
    S.with_(
        S.grid(), S.layers("la", "lb", "lw"), _WO_SQL,
        "h AS (SELECT value AS v, count(*) AS c FROM wo GROUP BY ALL)",
        "r AS (SELECT v, c, sum(c) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM h)",
        f"tg AS (SELECT CAST(i AS INTEGER) AS i, (i * (SELECT sum(c) FROM h) + {N_BREAKS - 1}) // {N_BREAKS} AS k "
        f"FROM range(1, {N_BREAKS + 1}) t(i))",
    )
    + "SELECT tg.i, r.v AS brk FROM tg JOIN r ON r.cum - r.c < tg.k AND tg.k <= r.cum",
)
def weighted_breaks_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten exact breaks of the weighted overlay (what the overlay's colour ramp is classed by)."""
    n = _n(spark, sf_dir)
    layers = {"a": L.layer_a(spark, sf_dir, n), "b": L.layer_b(spark, sf_dir, n),
              "v": L.layer_v(spark, sf_dir, n), "w": L.layer_w(spark, sf_dir, n)}
    return stats.class_breaks(B.weighted_overlay(layers, WEIGHTS), "value", N_BREAKS)


@query(
    "label_lookup",
    S.with_(S.grid(), S.layers("tp"), _NAMES_SQL)
    + "SELECT x, y, truth, a.name AS truth_name, pred_a, b.name AS pred_name FROM tp "
      "LEFT JOIN nm a ON a.cls = tp.truth LEFT JOIN nm b ON b.cls = tp.pred_a",
)
def label_lookup_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label and prediction class names per cell (six-row name table, broadcast)."""
    tp = L.truth_pred(spark, sf_dir, _n(spark, sf_dir)).select("x", "y", "truth", "pred_a")
    names = B.label_names(spark)
    t = tp.join(F.broadcast(names.withColumnRenamed("name", "truth_name")), F.col("truth") == F.col("cls"), "left").drop("cls")
    return t.join(F.broadcast(names.withColumnRenamed("name", "pred_name")), F.col("pred_a") == F.col("cls"), "left").drop("cls")


@query(
    "prediction_incorrect",
    S.with_(S.grid(), S.layers("tp")) + "SELECT x, y, pred_a AS pred, truth FROM tp WHERE pred_a <> truth",
)
def prediction_incorrect_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells where model A's class differs from the label."""
    return B.prediction_incorrect(L.truth_pred(spark, sf_dir, _n(spark, sf_dir)), "pred_a")


@query(
    "confusion_matrix",
    S.with_(S.grid(), S.layers("tp")) + "SELECT truth, pred_a AS pred, count(*) AS n FROM tp GROUP BY ALL",
)
def confusion_matrix_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells per (label, model A class)."""
    return B.confusion_matrix(L.truth_pred(spark, sf_dir, _n(spark, sf_dir)), "pred_a")


@query(
    "prediction_ab",
    S.with_(S.grid(), S.layers("tp"))
    + "SELECT CASE WHEN pred_a = truth AND pred_b = truth THEN 'both' WHEN pred_a = truth THEN 'a_only' "
      "WHEN pred_b = truth THEN 'b_only' ELSE 'neither' END AS category, count(*) AS n FROM tp GROUP BY ALL",
)
def prediction_ab_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells per agreement class of models A and B with the label."""
    return B.prediction_ab(L.truth_pred(spark, sf_dir, _n(spark, sf_dir)))


@query(
    "class_probability",
    S.with_(S.grid())
    + f"SELECT l_orderkey % g.n AS x, l_partkey % g.n AS y, round(sum(CASE WHEN CAST(floor(l_quantity) AS BIGINT) % 6 = {PROB_LABEL} "
      "THEN 1 ELSE 0 END) / count(*), 6) AS p FROM lineitem, g GROUP BY ALL",
)
def class_probability_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability band of class 2 from the six-band probability layer."""
    probs = L.probabilities(spark, sf_dir, _n(spark, sf_dir))
    return B.class_probability(probs, PROB_LABEL).withColumn("p", F.round("p", 6))
