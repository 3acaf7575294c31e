"""Helpers shared by the operators: shared scratch tables, connected components, row readers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridzone.session import ensure_checkpoint_dir

#: ASCII white space as the contracts define it: [\x20\x09-\x0D].
WS = "\t\n\x0b\x0c\r "
WS_CLASS = r"[\x20\x09-\x0D]"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_path(spark: SparkSession, what: str) -> str:
    """A new folder below the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read again: later reads never recompute it,
    and an executor that is lost afterwards takes nothing with it."""
    spark = df.sparkSession
    path = scratch_path(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame, what: str = "components", max_rounds: int = 60) -> DataFrame:
    """``edges`` (a, b) -> (node, component), the smallest node of each connected component.

    Alternates the large-star and small-star steps on an edge table; a round
    is two grouped minima (combined map-side, so a hub is one small row per
    task) and two joins, and the edge table never grows beyond its first size
    plus one row per node. Ends when a round changes nothing. Nodes without
    edges are not returned. Every round is a table in the shared folder.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = stored(e, what)

    def state(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = state(e)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
            .select("x.u", "x.v")
            .where("u <> v")
            .distinct()
        )
        e = stored(small, what)
        after = state(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    top = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(top)
