"""Record-shaping queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridzone.functions.text import ordinal, sentence_case
from gridzone.operators import records as R
from gridzone.plans import sqlparts as S
from gridzone.plans.registry import query
from gridzone.sources import records as RS
from gridzone.sources.tables import read_table

_C = ("c AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, n_name "
      "FROM customer JOIN nation ON c_nationkey = n_nationkey)")


@query(
    "geocode_clean",
    S.with_(
        _C,
        "f AS (SELECT c_custkey AS doc_id, CASE WHEN c_nationkey % 3 = 0 THEN 'Philadelphia County' ELSE n_name || ' County' END AS county, "
        "c_name AS text, c_name || ', ' || n_name AS full_name, 39.9::DOUBLE + (c_custkey % 50) / 100.0::DOUBLE AS lat, "
        "-75.0::DOUBLE - (c_custkey % 100) / 100.0::DOUBLE AS lng, "
        "CASE WHEN c_custkey % 4 <> 0 THEN lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') END AS zip_code "
        "FROM c WHERE c_custkey % 10 <> 7 "
        "UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'Philadelphia County' ELSE 'Delaware County' END, "
        "c_mktsegment, c_mktsegment || ', ' || n_name, 40.0::DOUBLE, -75.1::DOUBLE, "
        "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE '19' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') END "
        "FROM c WHERE c_custkey % 10 <> 7)",
    )
    + f"SELECT doc_id, text, full_name, lat, lng, zip_code, NULL::VARCHAR AS error FROM f WHERE county = '{R.PHILADELPHIA_COUNTY}' "
      f"UNION ALL SELECT c_custkey, NULL, NULL, NULL::DOUBLE, NULL::DOUBLE, NULL, '{R.NO_FEATURES_ERROR}' FROM c WHERE c_custkey % 10 = 7",
)
def geocode_clean_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geocoder responses (JSON) -> address records of Philadelphia County."""
    return R.geocode_clean(RS.geocode_docs(spark, sf_dir))


_NL = "chr(10)"


@query(
    "directory_flatten",
    S.with_(_C, "o AS (SELECT c.*, k FROM c, range(3) r(k))")
    + "SELECT c_custkey AS doc_id, 2 - k AS ord, c_name || ' #' || k AS name, "
      "CASE WHEN k = 0 THEN 'country' ELSE 'pennsylvania' END AS level, "
      "CASE WHEN k = 0 THEN 'District ' || c_nationkey ELSE n_name || ' Assembly' END AS district, "
      "CASE (c_custkey + k) % 3 WHEN 0 THEN 'Democrat' WHEN 1 THEN 'Republican' ELSE '' END AS party, "
      "CASE WHEN (c_custkey + k) % 2 = 0 THEN 'o' || k || '@n' || c_nationkey || '.example' ELSE '' END AS email, "
      "CASE WHEN k <> 1 THEN 'https://example.org/' || c_custkey || '/' || k ELSE '' END AS link, "
      "CASE WHEN k <> 2 THEN 'https://www.facebook.com/fb' || c_custkey || k ELSE '' END AS facebook, "
      "CASE WHEN k = 1 THEN 'https://www.twitter.com/tw' || c_custkey ELSE '' END AS twitter, "
      f"CASE WHEN k <> 2 THEN c_custkey || ' Main St' || {_NL} || n_name || ', PA ' || lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') ELSE '' END AS address, "
      "CASE WHEN k = 0 THEN '555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') ELSE '' END AS phone, "
      "CASE WHEN c_custkey % 5 = k THEN 'https://example.org/p/' || c_custkey END AS photo_url FROM o",
)
def directory_flatten_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Office directories (JSON) -> one row per official, reverse order, links and address text."""
    r = R.directory_flatten(RS.directory_docs(spark, sf_dir))
    return r.withColumn("ord", F.col("ord").cast("bigint"))


_SERIES_SQL = [
    _C,
    "cnt AS (SELECT n_name, c_mktsegment AS descriptor, count(*) AS cnt FROM c GROUP BY ALL)",
    "tot AS (SELECT n_name, count(*) AS tot FROM c GROUP BY ALL)",
    "v AS (SELECT n_name, descriptor, CAST(round(cnt / tot * 100) AS BIGINT) AS value FROM cnt JOIN tot USING (n_name))",
]


@query(
    "demographic_series",
    S.with_(*_SERIES_SQL, "m AS (SELECT *, max(value) OVER (PARTITION BY n_name) AS max_value FROM v)")
    + "SELECT n_name, descriptor, value, max_value, CAST(round(value / (CASE WHEN max_value * 0.8 <> 0 THEN max_value "
      "ELSE 80 END) * 20.0) AS BIGINT) AS width FROM m WHERE value > 0",
)
def demographic_series_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market-segment shares per nation as a bar series (percent, series maximum, bar width)."""
    return R.demographic_series(RS.segment_shares(spark, sf_dir), "n_name")


@query(
    "demographic_text",
    S.with_(*_SERIES_SQL,
            "mk AS (SELECT n_name, string_agg(value || '% ' || descriptor, ', ' ORDER BY descriptor) AS makeup FROM v GROUP BY ALL)",
            "inc AS (SELECT n_name, '$' || format('{:,.2f}', round(avg(c_acctbal), 2)) AS income, "
            "format('{:,}', count(*)) || ' people' AS population FROM c GROUP BY ALL)")
    + "SELECT n_name, income, population, makeup FROM inc JOIN mk USING (n_name)",
)
def demographic_text_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per nation: income, population and segment make-up as display text."""
    c = RS.customers(spark, sf_dir)
    inc = c.groupBy("n_name").agg(
        F.concat(F.lit("$"), F.format_number(F.round(F.avg("c_acctbal"), 2), 2)).alias("income"),
        F.concat(F.format_number(F.count(F.lit(1)), 0), F.lit(" people")).alias("population"),
    )
    sh = RS.segment_shares(spark, sf_dir).withColumn("value", F.round(F.col("quantity") * 100).cast("bigint"))
    mk = R.joined_text(sh, "n_name", F.concat(F.col("value").cast("string"), F.lit("% "), F.col("descriptor")), "descriptor")
    return inc.join(mk.withColumnRenamed("text", "makeup"), "n_name")


@query(
    "topn_preview",
    S.with_(_C)
    + "SELECT n_name, rnk AS rank, c_custkey, c_name, c_acctbal, greatest(cnt - 3, 0) AS hidden FROM ("
      "SELECT n_name, c_custkey, c_name, c_acctbal, row_number() OVER (PARTITION BY n_name ORDER BY c_acctbal DESC, c_custkey) AS rnk, "
      "count(*) OVER (PARTITION BY n_name) AS cnt FROM c) WHERE rnk <= 3",
)
def topn_preview_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top three customers by balance per nation plus the number not shown."""
    c = RS.customers(spark, sf_dir).select("n_name", "c_custkey", "c_name", "c_acctbal")
    r = R.topn_preview(c, "n_name", [F.col("c_acctbal").desc(), F.col("c_custkey")], 3)
    return r.withColumn("rank", F.col("rank").cast("bigint"))


_WORD = ("lambda w: regexp_extract(w, '^([^A-Za-z0-9_]*)', 1) || upper(substr(w, length(regexp_extract(w, '^([^A-Za-z0-9_]*)', 1)) + 1, 1)) "
         "|| lower(substr(w, length(regexp_extract(w, '^([^A-Za-z0-9_]*)', 1)) + 2))")


@query(
    "label_text",
    f"SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), {_WORD}), ' ') AS name_case, "
    f"array_to_string(list_transform(string_split(p_type, ' '), {_WORD}), ' ') AS type_case, "
    "CAST(p_size AS VARCHAR) || CASE WHEN p_size % 100 BETWEEN 11 AND 13 THEN 'th' WHEN p_size % 10 = 1 THEN 'st' "
    "WHEN p_size % 10 = 2 THEN 'nd' WHEN p_size % 10 = 3 THEN 'rd' ELSE 'th' END AS size_label FROM part",
)
def label_text_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-cased part names and types, ordinal size labels."""
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type", "p_size"])
    return p.select("p_partkey", sentence_case(F.col("p_name")).alias("name_case"),
                    sentence_case(F.col("p_type")).alias("type_case"), ordinal(F.col("p_size")).alias("size_label"))


# ---------------------------------------------------------------- GeoJSON sink + source round trip
def _bbox_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounding-box ring (5 closed vertices) of the event points of each event type."""
    from gridzone.sources.layers import points

    b = points(spark, sf_dir).groupBy(F.col("event_type").alias("poly_id")).agg(
        F.min("lon").alias("x0"), F.min("lat").alias("y0"), F.max("lon").alias("x1"), F.max("lat").alias("y1")
    )
    corners = F.array(
        F.struct(F.lit(0).alias("seq"), F.col("x0").alias("px"), F.col("y0").alias("py")),
        F.struct(F.lit(1).alias("seq"), F.col("x1").alias("px"), F.col("y0").alias("py")),
        F.struct(F.lit(2).alias("seq"), F.col("x1").alias("px"), F.col("y1").alias("py")),
        F.struct(F.lit(3).alias("seq"), F.col("x0").alias("px"), F.col("y1").alias("py")),
        F.struct(F.lit(4).alias("seq"), F.col("x0").alias("px"), F.col("y0").alias("py")),
    )
    return b.select("poly_id", F.lit(0).alias("part"), F.lit(0).alias("ring"), F.inline(corners))


def _feature_sql() -> str:
    """The Feature text put together from decimals: whole hundredths of a degree, the last digits written out."""
    at = lambda c: (f"(CASE WHEN {c} < 0 THEN '-' ELSE '' END || CAST(abs(CAST(round({c} * 100) AS BIGINT)) // 100 AS VARCHAR) || '.' || "  # noqa: E731
                    f"CASE WHEN abs(CAST(round({c} * 100) AS BIGINT)) % 10 = 0 THEN CAST(abs(CAST(round({c} * 100) AS BIGINT)) // 10 % 10 AS VARCHAR) "
                    f"ELSE lpad(CAST(abs(CAST(round({c} * 100) AS BIGINT)) % 100 AS VARCHAR), 2, '0') END)")
    corner = lambda x, y: f"'[' || {at(x)} || ',' || {at(y)} || ']'"
    ring = " || ',' || ".join(corner(x, y) for x, y in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0")))
    return S.with_(
        S.layers("pts"), "b AS (SELECT event_type AS poly_id, min(lon) AS x0, min(lat) AS y0, max(lon) AS x1, max(lat) AS y1 FROM pts GROUP BY ALL)"
    ) + ("SELECT poly_id, '{\"type\":\"Feature\",\"properties\":{\"id\":\"' || poly_id || '\"},\"geometry\":{\"type\":\"Polygon\",\"coordinates\":[[' || "
         + ring + " || ']]}}' AS feature FROM b")


@query("geojson_feature", _feature_sql())
def geojson_feature_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GeoJSON Feature text of each event type's bounding-box polygon, to hundredths of a degree."""
    from gridzone.sources.reports import geojson_feature

    v = _bbox_vertices(spark, sf_dir).withColumns({c: F.round(c, 2) for c in ("px", "py")})
    return geojson_feature(v)


@query(
    "geojson_vertices",
    S.with_(S.layers("pts"),
            "b AS (SELECT event_type AS poly_id, min(lon) AS x0, min(lat) AS y0, max(lon) AS x1, max(lat) AS y1 FROM pts GROUP BY ALL)")
    + "SELECT poly_id, 0 AS part, 0 AS ring, 0 AS seq, x0 AS px, y0 AS py FROM b UNION ALL "
      "SELECT poly_id, 0, 0, 1, x1, y0 FROM b UNION ALL SELECT poly_id, 0, 0, 2, x1, y1 FROM b UNION ALL "
      "SELECT poly_id, 0, 0, 3, x0, y1 FROM b UNION ALL SELECT poly_id, 0, 0, 4, x0, y0 FROM b",
)
def geojson_vertices_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round trip: bounding-box polygons written as GeoJSON Features, parsed back to vertices."""
    from gridzone.sources.polygons import geojson_vertices
    from gridzone.sources.reports import geojson_feature

    feats = geojson_feature(_bbox_vertices(spark, sf_dir))
    return geojson_vertices(feats, "poly_id", "feature")
