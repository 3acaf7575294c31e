"""Queries of the operators over the driver tables, for ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridzone.llm import langid, lexsearch, pii, quality, secretscan, segment, sharding, spelling, vecdedup, warc
from gridzone.llm.common import read
from gridzone.llm.linededup import dedup_lines
from gridzone.llm.packing import pack
from gridzone.llm.simhash import near_duplicates
from gridzone.llm.tokens import public_vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"), shingle_words=4, max_bits=4)


@query
def op9_line_dedup(spark, sf_dir):
    docs = dedup_lines(read(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op9_line_dedup"] = r"""
WITH lines AS (
  SELECT d.rid, d.doc_id, u.pos, u.line
  FROM (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents) d,
       LATERAL (SELECT unnest(d.ls) AS line, generate_subscripts(d.ls, 1) AS pos) u
), keyed AS (
  SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), common AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 10
)
SELECT any_value(k.doc_id) AS doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.pos) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN common c ON k.key = c.key GROUP BY k.rid
"""


@query
def op7_packing(spark, sf_dir):
    pieces = pack(read(spark, sf_dir, "documents"), public_vocabulary("byte_bpe_50k.json"), end_id=1, window=2048)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op4_pii(spark, sf_dir):
    found = pii.find_pii(read(spark, sf_dir, "documents"))
    of = lambda *kinds: F.filter("pii", lambda s: s["kind"].isin(*kinds))
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.joined(of(*pii.BASE_KINDS)), 256).alias("base_sha256"), pii.joined(F.col("pii")).alias("spans"))


@query
def op3_quality(spark, sf_dir):
    judged = quality.judged(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"]
    return judged.select("doc_id", *(F.col(f"__{n}").alias(n) for n in names))


@query
def op5_secrets(spark, sf_dir):
    found = secretscan.find_secrets(read(spark, sf_dir, "documents"))
    of = lambda *kinds: F.filter("secrets", lambda s: s["kind"].isin(*kinds))
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in secretscan.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(secretscan.joined(of(*secretscan.BASE_KINDS)), 256).alias("base_sha256"), secretscan.joined(F.col("secrets")).alias("spans"))


@query
def op8_langid(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    found = langid.identify(docs, docs.where(~held_out & F.col("lang").isNotNull()))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op2_warc(spark, sf_dir):
    records = warc.round_trip(spark, read(spark, sf_dir, "pages"))
    page = lambda c: F.regexp_extract(c, "^urn:page:(.*)$", 1).cast("long")
    return records.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


ORACLE["op2_warc"] = """
SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
       CASE WHEN strlen(coalesce(html, '')) >= 100 AND page_id <> min(page_id) OVER (PARTITION BY coalesce(html, '')) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(coalesce(html, '')) >= 100 AND page_id <> min(page_id) OVER (PARTITION BY coalesce(html, '')) THEN min(page_id) OVER (PARTITION BY coalesce(html, '')) END AS refers_to
FROM pages
"""


@query
def op10_sentencepiece(spark, sf_dir):
    model = public_vocabulary("piece_bpe_32k.model")
    samples = segment.sample(read(spark, sf_dir, "documents"), model, k=2, seed=1, decoded=True)
    decoded = F.sha2("decoded", 256).alias("decoded_sha256")
    return samples.select("doc_id", "sample", "n_pieces", F.crc32("ids").alias("ids_crc32"), "log_prob", "perturbed", "inclusion", decoded)


@query
def op6_embeddings(spark, sf_dir):
    return vecdedup.near_duplicates(read(spark, sf_dir, "embeddings"), threshold=0.98)


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


@query
def op13_spelling(spark, sf_dir):
    return spelling.group_variants(spelling.count_words(read(spark, sf_dir, "documents"), min_chars=7, typo_rate=31), min_count=2, ratio=10)


@query
def op12_search(spark, sf_dir):
    docs, items = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return lexsearch.search(lexsearch.build_index(docs, items), docs, items, k=20)


ORACLE["op12_search"] = r"""
WITH words AS (
  SELECT rid, doc_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS rid, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
), docs AS (SELECT rid, doc_id, count(*)::BIGINT AS n FROM words GROUP BY ALL
), totals AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM docs
), freq AS (SELECT rid, term, count(*)::BIGINT AS tf FROM words GROUP BY ALL
), weights AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM freq, totals GROUP BY term, big_n
), items AS (
  SELECT iid, item_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS iid, item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM benchmark)
), scores AS (
  SELECT iid, item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l))))::BIGINT AS score
  FROM items JOIN weights USING (term) JOIN freq USING (term) JOIN docs USING (rid), totals GROUP BY ALL
), ranked AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id)::INT AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


@query
def op11_sharding(spark, sf_dir):
    dealt = sharding.shuffle_into_shards(read(spark, sf_dir, "documents").select("doc_id", "text"), shards=8, seed=11, from_files=True)
    text = F.coalesce("text", F.lit(""))
    return dealt.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
