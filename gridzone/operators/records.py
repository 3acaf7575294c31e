"""Record-shaping jobs on nested JSON documents (geocoder results, office directories,
demographic series) and small per-group reports. Every document is handled by
array functions inside its own row; groups only feed bounded aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values used by the record jobs.
PHILADELPHIA_COUNTY = "Philadelphia County"
NO_FEATURES_ERROR = "No features were returned from the geocoder."
FACEBOOK, TWITTER = "Facebook", "Twitter"
FACEBOOK_URL, TWITTER_URL = "https://www.facebook.com/", "https://www.twitter.com/"
LEVEL_COUNTRY, LEVEL_OTHER = "country", "pennsylvania"
PARTY_LONG, PARTY_SHORT = "Democratic", "Democrat"

GEOCODE_SCHEMA = (
    "features ARRAY<STRUCT<geometry: STRUCT<coordinates: ARRAY<DOUBLE>>, "
    "properties: STRUCT<county: STRING, name: STRING, label: STRING, postalcode: STRING>>>"
)

DIRECTORY_SCHEMA = (
    "officials ARRAY<STRUCT<name: STRING, party: STRING, emails: ARRAY<STRING>, urls: ARRAY<STRING>, "
    "phones: ARRAY<STRING>, channels: ARRAY<STRUCT<type: STRING, id: STRING>>, "
    "address: ARRAY<STRUCT<line1: STRING, city: STRING, state: STRING, zip: STRING>>, photoUrl: STRING>>, "
    "offices ARRAY<STRUCT<name: STRING, levels: ARRAY<STRING>, officialIndices: ARRAY<INT>>>"
)


def geocode_clean(docs: DataFrame, id_col: str = "doc_id", json_col: str = "json") -> DataFrame:
    """Geocoder response -> address records of the one county kept.

    Features are exploded, filtered on ``properties.county``, coordinates are
    swapped from [lng, lat] into (lat, lng), a missing postal code becomes NULL.
    A response without ``features`` yields one row carrying the error text.
    """
    p = docs.select(F.col(id_col).alias("doc_id"), F.from_json(json_col, GEOCODE_SCHEMA).alias("r"))
    ok = p.filter(F.col("r.features").isNotNull()).select("doc_id", F.explode("r.features").alias("f"))
    ok = ok.filter(F.col("f.properties.county") == PHILADELPHIA_COUNTY).select(
        "doc_id",
        F.col("f.properties.name").alias("text"),
        F.col("f.properties.label").alias("full_name"),
        F.get(F.col("f.geometry.coordinates"), 1).alias("lat"),
        F.get(F.col("f.geometry.coordinates"), 0).alias("lng"),
        F.when(F.col("f.properties.postalcode") != "", F.col("f.properties.postalcode")).alias("zip_code"),
        F.lit(None).cast("string").alias("error"),
    )
    bad = p.filter(F.col("r.features").isNull()).select(
        "doc_id", *[F.lit(None).cast(t).alias(c) for c, t in
                    [("text", "string"), ("full_name", "string"), ("lat", "double"), ("lng", "double"), ("zip_code", "string")]],
        F.lit(NO_FEATURES_ERROR).alias("error"),
    )
    return ok.unionByName(bad)


def address_record(text: Column, lat: Column, lng: Column, zip_code: Column) -> Column:
    """Address record: name, nested lat/lng, zip."""
    return F.struct(text.alias("text"), F.struct(lat.alias("lat"), lng.alias("lng")).alias("latlng"),
                    zip_code.alias("zipCode"))


def _first_or_empty(arr: Column) -> Column:
    return F.coalesce(F.get(arr, 0), F.lit(""))


def _channel_url(channels: Column, kind: str, prefix: str) -> Column:
    """URL of the first channel of ``kind`` ('' when none): a native search over the
    ``type`` field array, no per-element lambda."""
    pos = F.array_position(channels["type"], kind)
    return F.when(pos > 0, F.concat(F.lit(prefix), F.element_at(channels, pos.cast("int"))["id"])).otherwise(F.lit(""))


def directory_flatten(docs: DataFrame, id_col: str = "doc_id", json_col: str = "json") -> DataFrame:
    """Office directory -> one row per official, listed in reverse order (``ord``).

    level/district come from the first office whose officialIndices holds the
    official's position; level is ``country`` or else ``pennsylvania``.
    """
    p = docs.select(F.col(id_col).alias("doc_id"), F.from_json(json_col, DIRECTORY_SCHEMA).alias("r"))
    # once per document: all official indices in office order, and the office owning each
    idxs = F.flatten(F.col("r.offices.officialIndices"))
    owner = F.flatten(F.transform("r.offices", lambda of, k: F.array_repeat(k, F.size(of["officialIndices"]))))
    o = p.select("doc_id", F.size("r.officials").alias("cnt"), F.col("r.offices").alias("offices"),
                 idxs.alias("idxs"), owner.alias("owner"), F.posexplode("r.officials").alias("i", "o"))
    pos = F.array_position("idxs", F.col("i"))  # first office listing the official (native search)
    office = F.when(pos > 0, F.get(F.col("offices"), F.get(F.col("owner"), (pos - 1).cast("int"))))
    party = F.col("o.party")
    addr = F.get(F.col("o.address"), 0)
    return o.select(
        "doc_id",
        (F.col("cnt") - 1 - F.col("i")).alias("ord"),
        F.col("o.name").alias("name"),
        F.when(F.get(office["levels"], 0) == LEVEL_COUNTRY, LEVEL_COUNTRY).otherwise(LEVEL_OTHER).alias("level"),
        office["name"].alias("district"),
        F.when(party.isNull() | (party == ""), "").when(party == PARTY_LONG, PARTY_SHORT).otherwise(party).alias("party"),
        _first_or_empty(F.col("o.emails")).alias("email"),
        _first_or_empty(F.col("o.urls")).alias("link"),
        _channel_url(F.col("o.channels"), FACEBOOK, FACEBOOK_URL).alias("facebook"),
        _channel_url(F.col("o.channels"), TWITTER, TWITTER_URL).alias("twitter"),
        F.when(addr.isNull(), "").otherwise(
            F.format_string("%s\n%s, %s %s", addr["line1"], addr["city"], addr["state"], addr["zip"])).alias("address"),
        _first_or_empty(F.col("o.phones")).alias("phone"),
        F.col("o.photoUrl").alias("photo_url"),
    )


def demographic_series(items: DataFrame, group: str) -> DataFrame:
    """Bar-chart series per group: value = round(quantity * 100), values <= 0 dropped,
    bar width = round(value / max * 20) where max is the group's largest value
    (80 when that is 0)."""
    v = items.select(group, "descriptor", F.round(F.col("quantity") * 100).cast("bigint").alias("value"))
    w = Window.partitionBy(group)
    m = v.withColumn("max_value", F.max("value").over(w))
    ref = F.when(F.col("max_value") * 0.8 != 0, F.col("max_value")).otherwise(F.lit(80))
    return m.filter(F.col("value") > 0).withColumn("width", F.round(F.col("value") / ref * 20.0).cast("bigint"))


def joined_text(items: DataFrame, group: str, template: Column, order: str) -> DataFrame:
    """One summary string per group: template per item, ', '-joined in ``order``."""
    g = items.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("k"), template.alias("t")))).alias("xs"))
    return g.select(group, F.array_join(F.transform("xs", lambda s: s["t"]), ", ").alias("text"))


def topn_preview(df: DataFrame, group: str, order: list[Column], n: int = 3) -> DataFrame:
    """First ``n`` rows per group in ``order`` plus the number of rows not shown.

    ``row_number() <= n`` lets Spark insert a partial per-group limit before
    the shuffle, so a huge group never moves whole.
    """
    w = Window.partitionBy(group).orderBy(*order)
    top = df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    cnt = df.groupBy(group).agg(F.count(F.lit(1)).alias("_cnt"))
    return top.join(cnt, group).withColumn("hidden", F.greatest(F.col("_cnt") - n, F.lit(0))).drop("_cnt")
