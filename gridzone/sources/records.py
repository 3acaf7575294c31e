"""JSON documents derived from ``customer`` + ``nation`` (one small document per customer).

* geocoder responses: ``features`` (two per customer, none for every tenth one)
* office directories: three officials and two offices per customer
The documents are written with ``to_json`` and read back with ``from_json`` by
the record jobs, the same path real JSON input takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridzone.operators.records import PHILADELPHIA_COUNTY
from gridzone.sources.tables import read_table


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    # nation has 25 rows: broadcast is bounded by the table's definition
    return c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).drop("n_nationkey")


def geocode_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = customers(spark, sf_dir)
    k = F.col("c_custkey")
    f1 = F.struct(
        F.struct(F.array(F.lit(-75.0) - (k % 100) / 100.0, F.lit(39.9) + (k % 50) / 100.0).alias("coordinates")).alias("geometry"),
        F.struct(
            F.when(F.col("c_nationkey") % 3 == 0, F.lit(PHILADELPHIA_COUNTY)).otherwise(F.concat("n_name", F.lit(" County"))).alias("county"),
            F.col("c_name").alias("name"),
            F.concat("c_name", F.lit(", "), "n_name").alias("label"),
            F.when(k % 4 != 0, F.lpad((k % 100000).cast("string"), 5, "0")).alias("postalcode"),
        ).alias("properties"),
    )
    f2 = F.struct(
        F.struct(F.array(F.lit(-75.1), F.lit(40.0)).alias("coordinates")).alias("geometry"),
        F.struct(
            F.when(k % 2 == 0, F.lit(PHILADELPHIA_COUNTY)).otherwise(F.lit("Delaware County")).alias("county"),
            F.col("c_mktsegment").alias("name"),
            F.concat("c_mktsegment", F.lit(", "), "n_name").alias("label"),
            F.when(k % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("19"), F.lpad(F.col("c_nationkey").cast("string"), 3, "0"))).alias("postalcode"),
        ).alias("properties"),
    )
    feats = F.when(k % 10 != 7, F.array(f1, f2))
    return c.select(k.alias("doc_id"), F.to_json(F.struct(feats.alias("features"))).alias("json"))


def directory_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = customers(spark, sf_dir)
    key = F.col("c_custkey")

    def official(i: int):
        parties = F.array(F.lit("Democratic"), F.lit("Republican"), F.lit(None).cast("string"))
        channels = [F.struct(F.lit("Facebook").alias("type"), F.concat(F.lit("fb"), key.cast("string"), F.lit(str(i))).alias("id"))]
        if i == 1:
            channels.append(F.struct(F.lit("Twitter").alias("type"), F.concat(F.lit("tw"), key.cast("string")).alias("id")))
        return F.struct(
            F.concat("c_name", F.lit(f" #{i}")).alias("name"),
            F.get(parties, ((key + i) % 3).cast("int")).alias("party"),
            F.when((key + i) % 2 == 0, F.array(F.concat(F.lit(f"o{i}@n"), F.col("c_nationkey").cast("string"), F.lit(".example")))).alias("emails"),
            (F.array(F.concat(F.lit("https://example.org/"), key.cast("string"), F.lit(f"/{i}"))) if i != 1
             else F.lit(None).cast("array<string>")).alias("urls"),
            (F.array(F.concat(F.lit("555-"), F.lpad((key % 10000).cast("string"), 4, "0"))) if i == 0
             else F.lit(None).cast("array<string>")).alias("phones"),
            (F.array(*channels) if i != 2 else F.array().cast("array<struct<type:string,id:string>>")).alias("channels"),
            (F.array(F.struct(F.concat(key.cast("string"), F.lit(" Main St")).alias("line1"), F.col("n_name").alias("city"),
                              F.lit("PA").alias("state"), F.lpad((key % 100000).cast("string"), 5, "0").alias("zip")))
             if i != 2 else F.lit(None).cast("array<struct<line1:string,city:string,state:string,zip:string>>")).alias("address"),
            F.when(key % 5 == i, F.concat(F.lit("https://example.org/p/"), key.cast("string"))).alias("photoUrl"),
        )

    offices = F.array(
        F.struct(F.concat(F.lit("District "), F.col("c_nationkey").cast("string")).alias("name"),
                 F.array(F.lit("country")).alias("levels"), F.array(F.lit(0)).alias("officialIndices")),
        F.struct(F.concat("n_name", F.lit(" Assembly")).alias("name"),
                 F.array(F.lit("administrativeArea1")).alias("levels"), F.array(F.lit(1), F.lit(2)).alias("officialIndices")),
    )
    doc = F.struct(F.array(official(0), official(1), official(2)).alias("officials"), offices.alias("offices"))
    return c.select(key.alias("doc_id"), F.to_json(doc).alias("json"))


def segment_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demographic items per nation: descriptor = market segment, quantity = share of customers."""
    c = customers(spark, sf_dir)
    cnt = c.groupBy("n_name", F.col("c_mktsegment").alias("descriptor")).agg(F.count(F.lit(1)).alias("cnt"))
    tot = c.groupBy("n_name").agg(F.count(F.lit(1)).alias("tot"))
    return cnt.join(tot, "n_name").select("n_name", "descriptor", (F.col("cnt") / F.col("tot")).alias("quantity"))
