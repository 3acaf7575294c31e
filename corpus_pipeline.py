"""Corpus pipeline: five stages over ``documents``, each an operator of ``gridzone.llm``.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; its result is written as Parquet into the shared folder and read again as
the next one's ``docs``. All but the last return the columns of ``documents``
(``n_chars`` follows the text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridzone.llm import linededup, pii, quality, simhash
from gridzone.llm.common import read, stored
from gridzone.llm.packing import pack
from gridzone.llm.tokens import public_vocabulary

VOCABULARY = "byte_bpe_50k.json"


def _with_text(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars"))).select(columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; trusted text is that of good ``labels``."""
    return quality.kept(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten or more documents go, but for the first one by (doc_id, position), so that no text is lost from the
    corpus. Documents stay, also those left without lines."""
    bitmaps = linededup.drop_bitmaps(docs, min_docs=10, min_chars=1, keep_first=True)
    return _with_text(linededup.apply_bitmaps(docs, bitmaps), docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.deduplicated(docs, shingle_words=4, max_bits=4).select(docs.columns)


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in angle brackets."""
    return _with_text(docs.withColumn("text", pii.redact(F.col("text"))), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in windows of 2048: doc_id, start, length, ids, doc_tokens, sequence_id, offset."""
    return pack(docs, public_vocabulary(VOCABULARY), end_id=1, window=2048)


STAGES = [("quality", quality_rules), ("line_dedup", line_dedup), ("simhash", simhash_dedup), ("pii", pii_redaction), ("packing", packing)]

#: The log ratios, fingerprints, validators and token ids have no form in SQL; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
