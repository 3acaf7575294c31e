"""Line dedup: per-document keep bitmaps from range-partitioned line hashes. DataFrame functions only.

A line's key is hashed to 96 bits; rows are (hash, document, position) and a
96-bit hash of the whole text, which tells rows of one id apart, never
text. They are range-partitioned and sorted by (hash, document, position): the
bounds cut inside a hash, so a line that a third of all documents carries
spreads over as many tasks as its rows need. Each task streams through its run
and keeps the first occurrence in each document; those are counted per hash with a
partial sum in the same task, so one small row per hash and task is shuffled.

The result per document (id and text) is a bitmap of dropped lines, as the 64-line words
that have a dropped line at all: an untouched document costs nothing, however
long it is. Text is cut only where a caller asks for it (``apply_bitmaps``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridzone.llm.common import WS, stored

#: Tasks that the rows of one line are spread over where they meet its count.
SALTS = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only. ``lower`` is much faster and does the same where all is ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def lines_of(text: Column) -> Column:
    """The lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _row_keys(text: Column) -> list[Column]:
    """(t1, t2): what tells rows of one id apart. Rows equal in both are the same document written twice."""
    return [F.xxhash64(text).alias("t1"), F.hash(text).alias("t2")]


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, t1, t2, pos, h1, h2) of every line whose key has at least ``min_chars`` code points. A text is hashed once, below its lines."""
    keys = F.transform(lines_of(lower_ascii(F.col(text_col))), lambda line: F.btrim(line, F.lit(WS)))
    rows = docs.select(F.col(id_col).alias("id"), *_row_keys(F.col(text_col)), keys.alias("keys"))
    return (
        rows.select("id", "t1", "t2", F.posexplode("keys").alias("pos", "key"))
        .where(F.char_length("key") >= min_chars)
        .select("id", "t1", "t2", "pos", F.xxhash64("key").alias("h1"), F.hash("key").alias("h2"))
    )


def drop_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """(id, t1, t2, dropped): for each document that loses lines, its sorted (word, bits) words of 64 lines.

    A key found in at least ``min_docs`` documents loses all its lines, or, with
    ``keep_first``, all but the first one by (document, position). Documents are
    counted by their id: rows that repeat an id count as one document, as
    does a null id. Lines are dropped row by row: rows of one id that differ in text
    (t1, t2) have bitmaps of their own, and the first line is that of one text. Null or empty texts have one empty line, whose key has no
    code point.
    """
    keys = stored(line_keys(docs, id_col, text_col, max(1, min_chars)), "line-keys")  # the range is sampled on hashes, not on texts
    ranged = keys.repartitionByRange("h1", "h2", "id")
    runs = ranged.sortWithinPartitions("h1", "h2", "id", "pos", "t1", "t2")
    in_doc = Window.partitionBy("h1", "h2", "id").orderBy("pos", "t1", "t2")  # as ranged and sorted: no further exchange or sort
    firsts = runs.withColumn("nth", F.row_number().over(in_doc)).where("nth = 1")
    common = firsts.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("id", "pos", "t1", "t2")).alias("first")).where(F.col("n") >= min_docs)
    # A line of a third of all documents meets its one row in SALTS tasks, not in one.
    salted = common.select("h1", "h2", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    hits = keys.withColumn("salt", F.pmod(F.hash("id", "t1"), F.lit(SALTS))).join(salted, ["h1", "h2", "salt"])
    if keep_first:
        hits = hits.where(~F.struct("id", "pos", "t1", "t2").eqNullSafe(F.col("first")))
    word = F.floor(F.col("pos") / 64).cast("int")
    bits = hits.groupBy("id", "t1", "t2", word.alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    return bits.groupBy("id", "t1", "t2").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("dropped")).withColumnRenamed("id", id_col)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: bool = False) -> DataFrame:
    """``docs`` with ``text_col`` cut to the kept lines; with ``counts`` also n_lines and n_dropped (long). All other columns stay, whatever their names."""
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    text = F.col("row")[text_col]
    words = F.transform(F.sequence(F.lit(0), F.element_at("dropped", -1)["word"]), lambda w: F.coalesce(F.try_element_at("by_word", w), F.lit(0).cast("long")))
    maps = bitmaps.withColumn("by_word", F.map_from_entries("dropped")).select(F.col(id_col).alias("id"), "t1", "t2", words.alias("bits"))
    t1, t2 = _row_keys(text)
    joined = row.join(maps, F.col("row")[id_col].eqNullSafe(maps["id"]) & (t1 == maps["t1"]) & (t2 == maps["t2"]), "left").select("row", "bits")
    kept = F.filter("lines", lambda line, i: F.coalesce(F.call_function("shiftright", F.get("bits", F.call_function("shiftright", i, F.lit(6))), F.pmod(i, F.lit(64))).bitwiseAND(1), F.lit(0)) == 0)
    none = F.col("bits").isNull()
    out = joined.withColumn("lines", lines_of(text)).withColumn("kept", F.when(~none, kept))
    cut = F.when(none, text).otherwise(F.array_join("kept", "\n"))
    columns = [(cut if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns]
    n = F.size("lines").cast("long")
    return out.select(*columns, *([n.alias("n_lines"), F.when(none, F.lit(0)).otherwise(n - F.size("kept")).cast("long").alias("n_dropped")] if counts else []))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **rule) -> DataFrame:
    """One row per document: id, ``n_lines``, ``n_dropped`` and the kept text as ``kept``.

    See ``drop_bitmaps`` for the rule and what nulls and repeated ids mean; other
    columns of ``docs`` are ignored, whatever their names. Repeated rows stay.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    cut = apply_bitmaps(own, drop_bitmaps(own, **rule), counts=True)
    return cut.select(F.col("doc_id").alias(id_col), "n_lines", "n_dropped", F.coalesce("text", F.lit("")).alias("kept"))
