"""Join helpers: size-checked broadcast and the cell x span range join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A broadcast side is shipped whole to every executor; above this row count
# (about 40 MB for span pieces) the plain shuffle join is used instead.
BROADCAST_MAX_ROWS = 1_500_000


def sized_broadcast(df: DataFrame, max_rows: int | None = None) -> tuple[DataFrame, int]:
    """Return ``(broadcast(df), rows)`` when ``rows <= max_rows`` else ``(df, rows)``.

    Only for polygon-side tables (spans, edges, keys) whose size follows from the
    query input, never from the layers; the count is a small job on that input.
    """
    limit = BROADCAST_MAX_ROWS if max_rows is None else max_rows
    rows = df.count()
    return (F.broadcast(df) if rows <= limit else df), rows


def cells_in_zone(cells: DataFrame, pieces: DataFrame, block: int) -> DataFrame:
    """Range join cell x span piece: equi on (x, blk), residual ``r0 <= y < r1``.

    Adds ``poly_id``; a cell inside several zones appears once per zone.
    """
    c = cells.withColumn("blk", F.floor(F.col("y") / block))
    j = c.join(pieces.withColumnRenamed("x", "_px").withColumnRenamed("blk", "_pb"),
               (F.col("x") == F.col("_px")) & (F.col("blk") == F.col("_pb"))
               & (F.col("y") >= F.col("r0")) & (F.col("y") < F.col("r1")))
    return j.drop("_px", "_pb", "blk", "r0", "r1")
