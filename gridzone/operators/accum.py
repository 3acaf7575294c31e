"""Running-count accumulator: answer zonal cross-tabs from the zone boundary.

Stored table (built once per layer pair, "ingest"): ``rank_bitmaps``, one row per
pixel column and tile with, for each value pair (a, b), the number of its
cells in the column above the tile and the tile's own cells as 64-row bitmaps.

Query for a row span [r0, r1) of column x: count(pair) = P(r1) - P(r0), and P(e)
is the count above e's tile plus the set bits above e. So a span end needs one
row; the raw cells are not read, and the work follows the polygon
boundary, not its area.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridzone.operators.joins import sized_broadcast


def overlay_pairs(a: DataFrame, b: DataFrame, one_sided: bool = False) -> DataFrame:
    """Cells where both class layers hold data: ``(x, y, a, b)``; with ``one_sided`` also those of one layer, the other NULL."""
    return (
        a.filter(F.col("v").isNotNull()).select("x", "y", F.col("v").alias("a"))
        .join(b.filter(F.col("v").isNotNull()).select("x", "y", F.col("v").alias("b")), ["x", "y"], "full" if one_sided else "inner")
    )


def column_prefix_counts(pairs: DataFrame) -> DataFrame:
    """Dense per-cell form: for each cell, cells of its own pair in its column at rows <= y."""
    w = Window.partitionBy("x", "a", "b").orderBy("y").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return pairs.select("x", "y", "a", "b", F.count(F.lit(1)).over(w).alias("cum"))


def span_ends(spans: DataFrame) -> DataFrame:
    """Signed span ends ``(poly_id, x, e, sign)``: +1 at r1, -1 at r0 (r0 = 0 adds nothing)."""
    ends = F.array(F.struct(F.col("r1").alias("e"), F.lit(1).alias("sign")),
                   F.struct(F.col("r0").alias("e"), F.lit(-1).alias("sign")))
    return spans.select("poly_id", "x", F.inline(ends)).filter(F.col("e") > 0)


#: Rows of a bitmap word.
WORD = 64


def rank_bitmaps(pairs: DataFrame, height: int, tile: int) -> DataFrame:
    """Stored form of the running counts: one row per pixel column and ``tile`` rows, ``(x, tr, entries)``.

    ``entries`` holds (a, b, above, words): cells of the pair in the column above the tile, and word k with bit i set
    where row ``64 k + i`` of the tile has the pair. A pair has an entry from its first tile down, with empty words where the
    tile does not hold it, so there are at most as many entries as pairs in a column and tile.
    Words are gathered map-side; the running sum is a window over the tiles of one column and pair.
    """
    n_words = -(-tile // WORD)
    inside = F.col("y") % tile
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (inside % WORD).cast("int"))
    words = [F.coalesce(F.bit_or(F.when(F.floor(inside / WORD) == k, bit)), F.lit(0).cast("bigint")) for k in range(n_words)]
    here = pairs.groupBy("x", "a", "b", F.floor(F.col("y") / tile).alias("tr")).agg(F.array(*words).alias("words"), F.count(F.lit(1)).alias("n"))
    column = Window.partitionBy("x", "a", "b").orderBy("tr")
    run = here.select(
        "x", "a", "b", "tr", "words", "n",
        F.sum("n").over(column.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("upto"),
        F.coalesce(F.lead("tr").over(column) - 1, F.lit((height - 1) // tile)).alias("until"),
    )
    none = F.array(*[F.lit(0).cast("bigint")] * n_words)
    own = F.col("at") == F.col("tr")
    spread = run.withColumn("at", F.explode(F.sequence("tr", "until"))).select(
        "x", F.col("at").alias("tr"), "a", "b", F.when(own, F.col("upto") - F.col("n")).otherwise(F.col("upto")).alias("above"), F.when(own, F.col("words")).otherwise(none).alias("words"))
    return spread.groupBy("x", "tr").agg(F.collect_list(F.struct("a", "b", "above", "words")).alias("entries"))


def rank(above: Column, words: Column, rows: Column, n_words: int) -> Column:
    """Cells of a pair in its column before row ``rows`` (1 .. tile) of the tile: the count above plus the bits before it."""
    out = above
    for k in range(n_words):
        left = (rows - WORD * k).cast("int")
        mask = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("bigint"), left))
        bits = F.when(left >= WORD, words[k]).when(left > 0, words[k].bitwiseAND(mask)).otherwise(F.lit(0).cast("bigint"))
        out = out + F.bit_count(bits)
    return out


def block_prefix_counts(ranks: DataFrame, block: int, height: int, tile: int) -> DataFrame:
    """Running counts up to the end of each ``block`` rows, ``(x, blk, a, b, cum)`` from a pair's first block down, read off ``rank_bitmaps``."""
    if tile % block:
        raise ValueError("tile must be a multiple of the block length")
    per = tile // block
    first = F.col("tr") * per
    blocks = F.sequence(first, F.least(first + per - 1, F.lit(-(-height // block) - 1)))
    e = ranks.select("x", "tr", F.explode(blocks).alias("blk"), "entries").select("x", "tr", "blk", F.inline("entries"))
    rows = (F.col("blk") + 1) * block - F.col("tr") * tile
    return e.select("x", "blk", "a", "b", rank(F.col("above"), F.col("words"), rows, -(-tile // WORD)).cast("bigint").alias("cum")).filter("cum > 0")


def zonal_crosstab_accum(ranks: DataFrame, spans: DataFrame, tile: int, max_rows: int | None = None, stored_tile: int | None = None) -> DataFrame:
    """Cross-tab ``(poly_id, a, b, n)`` from the rank bitmaps of the columns and tiles that hold a span end.

    ``ranks`` is ``rank_bitmaps(pairs, height, tile)``; ``spans`` must be clipped to the grid (``polygon_spans`` does
    this). Where the table is stored by tile
    (``catalog.write_tiled``) the look-up also matches the tile key and its folder, so only folders holding a span end are read;
    ``stored_tile`` is the side of those tiles where it is not ``tile``.
    """
    from gridzone.operators.layout import zorder
    from gridzone.sources.catalog import folder

    tr, side = F.floor((F.col("e") - 1) / tile), stored_tile or tile
    ends = span_ends(spans).select("poly_id", F.col("x").alias("ex"), tr.alias("et"), (F.col("e") - tr * tile).alias("rows"), "sign")
    ends = ends.withColumn("ez", zorder(F.floor(F.col("ex") / side), F.floor(F.col("et") * tile / side)))
    ends = sized_broadcast(ends, max_rows)[0]
    cond = (F.col("x") == F.col("ex")) & (F.col("tr") == F.col("et"))
    if "zc" in ranks.columns:
        cond = (F.col("zc") == folder(F.col("ez"))) & (F.col("z") == F.col("ez")) & cond
    row = ranks.join(ends, cond).select("poly_id", "rows", "sign", F.inline("entries"))
    n = F.col("sign") * rank(F.col("above"), F.col("words"), F.col("rows"), -(-tile // WORD))
    return row.groupBy("poly_id", "a", "b").agg(F.sum(n).cast("bigint").alias("n")).filter(F.col("n") != 0)


# ------------------------------------------------------------------ literal marching behaviour
def boundary_sequence(boundary: DataFrame, layer: DataFrame, tile: int) -> DataFrame:
    """Boundary cells in the reference's visiting order, with the layer value (NULL = no-data).

    Per tile column ``key_col`` the order key is (tile row, column in tile, row in tile).
    """
    c = boundary.select("x", "y").distinct().join(layer.select("x", "y", "v"), ["x", "y"], "left")
    order = (F.floor(F.col("y") / tile) * (tile * tile) + (F.col("x") % tile) * tile + (F.col("y") % tile))
    return c.select(F.floor(F.col("x") / tile).alias("key_col"), order.alias("ord"), "x", "y", "v")


def last_seen_fill(seq: DataFrame) -> DataFrame:
    """Carry the last data value forward along each tile column, skipping no-data."""
    w = Window.partitionBy("key_col").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    return seq.withColumn("last_seen", F.last("v", ignorenulls=True).over(w))


def boundary_diffs(seq: DataFrame) -> DataFrame:
    """Per tile column: differences v - last_seen over data cells and their sum."""
    f = last_seen_fill(seq).filter(F.col("v").isNotNull() & F.col("last_seen").isNotNull())
    return f.groupBy("key_col").agg(
        F.count(F.lit(1)).alias("n_diffs"), F.sum(F.col("v") - F.col("last_seen")).cast("bigint").alias("sum_diff")
    )


def boundary_last_minus_first(seq: DataFrame, bands: int = 64) -> DataFrame:
    """The reference's marching result as written: every band holds the same
    land-cover tile, and each tile column's sum telescopes to last - first.

    Returns ``(band, a, b, n)`` with band = a * 4 + b.
    """
    d = seq.filter(F.col("v").isNotNull()).groupBy("key_col").agg(
        (F.max_by("v", "ord") - F.min_by("v", "ord")).alias("d")
    )
    total = d.agg(F.coalesce(F.sum("d"), F.lit(0)).cast("bigint").alias("n"))
    return total.select(F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band"), "n").select(
        "band", band_label_a(F.col("band")).alias("a"), band_label_b(F.col("band")).alias("b"), "n"
    )


# Classes per layer of the 64-band layout, band = a * 4 + b.
CLASSES_A, CLASSES_B = 16, 4


def pair_band(a, b):
    """Band of a class pair; a class outside the 16 x 4 layout fails instead of taking another pair's band."""
    outside = (a < 0) | (a >= CLASSES_A) | (b < 0) | (b >= CLASSES_B)
    message = F.concat(F.lit("class pair outside 16 x 4: "), a.cast("string"), F.lit(", "), b.cast("string"))
    return F.when(outside, F.raise_error(message).cast("bigint")).otherwise(a * CLASSES_B + b)


def band_label_a(band):
    return F.floor(band / 4)


def band_label_b(band):
    return band % 4


def band_vectors(pairs_in_zone: DataFrame, tile: int) -> DataFrame:
    """Per tile column, the 64-long vector of pair counts (band = a * 4 + b)."""
    bands = CLASSES_A * CLASSES_B
    per = pairs_in_zone.groupBy(F.floor(F.col("x") / tile).alias("key_col"), pair_band(F.col("a"), F.col("b")).alias("band")).agg(
        F.count(F.lit(1)).alias("n")
    )
    m = per.groupBy("key_col").agg(F.map_from_entries(F.collect_list(F.struct("band", "n"))).alias("m"))
    return m.select(
        "key_col",
        F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.coalesce(F.col("m")[i], F.lit(0))).alias("vec"),
    )


def band_vector_sum(vectors: DataFrame) -> DataFrame:
    """Element-wise sum of the vectors (partial + final aggregation per band)."""
    e = vectors.select(F.posexplode("vec").alias("band", "n"))
    return e.groupBy("band").agg(F.sum("n").cast("bigint").alias("n")).select(
        F.col("band").cast("bigint").alias("band"),
        band_label_a(F.col("band")).alias("a"), band_label_b(F.col("band")).alias("b"), "n",
    )
