"""Exact order statistics in one lazy plan, without a single-task sort of the values.

A global running count over sorted values normally needs one window partition
(one task). Here values are first reduced to a histogram (distinct value ->
count, partial aggregation). A value falls into a band that grows with its order of magnitude
(``bands``: some thousand to a power of two, so outliers take no band away from
the rest); each band has its own running count, and the totals of
the bands below come from a running sum over one small row per band. Nothing is
collected and nothing runs before the query does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bands of values between one power of two and the next.
BANDS = 4096


def bands(v: Column) -> Column:
    """A whole number that never falls as ``v`` grows: sign, exponent and the leading part of the mantissa. NaN, as Spark sorts it, comes last."""
    x = v.cast("double")
    size = F.greatest(F.abs(x), F.lit(2.0**-1000))
    exponent = F.floor(F.log2(size))
    # the mantissa is taken at the exponent as computed: one too high or low near a power of two, it still lands beside that power
    place = F.floor((exponent + 1001 + (size / F.pow(F.lit(2.0), exponent) - 1)) * BANDS)
    signed = F.when(F.abs(x) <= 2.0**-1000, F.lit(0)).when(x < 0, -place).otherwise(place)
    return F.when(F.isnan(x), F.lit(1 << 50)).when(x == float("inf"), F.lit((1 << 50) - 1)).when(x == float("-inf"), F.lit(-(1 << 50))).otherwise(signed).cast("bigint")


def value_ranks(values: DataFrame, col: str) -> DataFrame:
    """``(v, c, cum, total)``: distinct values, their counts, the running count (inclusive) and the number of values."""
    h = values.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("c")).withColumn("band", bands(F.col("v")))
    lower = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)  # one row a band, however many values
    whole = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = h.groupBy("band").agg(F.sum("c").alias("t"))
    sums = sums.select("band", F.coalesce(F.sum("t").over(lower), F.lit(0)).alias("below"), F.sum("t").over(whole).alias("total"))
    w = Window.partitionBy("band").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return h.withColumn("own", F.sum("c").over(w)).join(sums, "band").select("v", "c", (F.col("below") + F.col("own")).cast("bigint").alias("cum"), "total")


def class_breaks(values: DataFrame, col: str, n: int = 10) -> DataFrame:
    """``n`` exact breaks: break i (1..n) is the smallest value whose running
    count reaches ceil(i * N / n), N = number of non-null values.

    A value with running count ``cum`` and count ``c`` is break i exactly when
    cum - c < ceil(i N / n) <= cum, i.e. for i in
    [floor((cum - c) n / N) + 1, floor(cum n / N)]: each value emits its own
    (usually empty) range of i, so no join against the targets is needed.
    """
    r = value_ranks(values, col)
    lo = F.expr(f"((cum - c) * {n}) div total") + 1  # integer division: exact for any count
    hi = F.expr(f"(cum * {n}) div total")
    e = r.filter(lo <= hi).select("v", F.explode(F.sequence(lo, hi)).alias("i"))
    return e.select(F.col("i").cast("int").alias("i"), F.col("v").alias("brk"))


def breaks_array(breaks: DataFrame) -> Column:
    """The breaks as one sorted array, a scalar subquery of the plan that uses it."""
    return breaks.agg(F.sort_array(F.collect_list("brk")).alias("breaks")).scalar()


def classify(v: Column, breaks: Column) -> Column:
    """Class index of a value: number of breaks <= v (0 = below the first break)."""
    return F.size(F.filter(breaks, lambda b: b <= v))


def classified(values: DataFrame, col: str, breaks: DataFrame, name: str = "cls") -> DataFrame:
    """``values`` with the class index of ``col`` by a table of breaks, in the same plan."""
    at = values.withColumn("_breaks", breaks_array(breaks))  # a subquery may not stand inside the array function itself
    return at.withColumn(name, classify(F.col(col), F.col("_breaks"))).drop("_breaks")
