"""Quality rules against a brute-force version, and what they reject."""

import math
import re
from collections import Counter

from gridzone.llm import quality

SF = "/root/testdata/sf0.001"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts_and_base_rule(spark):
    from gridzone.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op3_quality"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        n, *_, repeated = want = brute(texts[r.doc_id])
        assert tuple(r[c] for c in COUNTS) == want
        assert r.base_failed == (n < 10 or 100 * repeated > 20 * n)
        assert not (r.kept and r.base_failed)


def test_scores_and_verdicts_equal_brute_force(spark):
    """The log ratios, scores and verdicts again, with bins taken from Spark's own hash."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    bins = {r.doc_id: r.bins for r in docs.select("doc_id", quality._bins(quality._word_hashes(F.col("text")), quality.BUCKETS).alias("bins")).collect()}
    good = {r.doc_id for r in labels.collect() if r.quality == 1 and r.toxic == 0}
    raw, target = Counter(), Counter()
    for d, b in bins.items():
        raw.update(b)
        target.update(b if d in good else ())
    n, m, k = sum(raw.values()), sum(target.values()), quality.BUCKETS
    score = {d: sum(math.log((target[x] + 1) / (m + k)) - math.log((raw[x] + 1) / (n + k)) for x in b) / len(b) if b else 0.0 for d, b in bins.items()}
    own = [score[d] for d in good if d in bins and len(bins[d]) >= 19]
    mean = sum(own) / len(own)
    lowest = round(mean - 4 * math.sqrt(sum((x - mean) ** 2 for x in own) / len(own)), 4)
    for r in quality.judged(docs, labels).collect():
        assert abs(r["__score"] - score[r.doc_id]) < 1e-5
        edge = lowest - 0.35 / math.sqrt(max(1, len(bins[r.doc_id])))
        if abs(score[r.doc_id] - edge) > 1e-3:
            assert r["__kept"] == (not r["__base_failed"] and score[r.doc_id] >= edge)


def test_keeps_clean_and_rejects_junk(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.judged(docs, labels).select("doc_id", "__kept", "__base_failed").join(labels, "doc_id").where("not __base_failed").collect()
    good = [r["__kept"] for r in judged if r.quality == 1]
    bad = [r["__kept"] for r in judged if r.quality == 0]
    assert all(good) and sum(bad) <= 0.1 * len(bad)


def test_every_trusted_document_counts(spark):
    """With all documents trusted both counts are the same, however many there are, and the threshold sees them all."""
    from pyspark.sql import functions as F

    docs = spark.range(20_300).select(F.col("id").alias("doc_id"), F.concat(F.lit("word"), "id").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    trusted = quality.trusted_ids(labels.unionByName(labels))
    assert trusted.count() == 20_300
    assert set(quality.log_ratios(docs, trusted).first().ratios) == {0.0}


def test_shuffled_ids_give_the_same(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    want = sorted(quality.judged(docs, labels).select("doc_id", "__score", "__kept").collect())
    monkeypatch.setattr(quality, "BROADCAST_IDS", 0)
    assert sorted(quality.judged(docs, labels).select("doc_id", "__score", "__kept").collect()) == want


def test_edge_cases(spark):
    long = " ".join(f"w{i % 6000}" for i in range(40000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a b c d e a b c d e"), (5, "x\n\nx\n x\nx"), (5, "x\n\nx\n x\nx"), (6, "# * é\x0b| <>\r\n"), (7, long), (None, "one two")]
    df = spark.createDataFrame([(d, t, "z", 1) for d, t in rows], "doc_id long, text string, kept string, hashes int")
    labels = spark.createDataFrame([(7, 1, 0), (7, 1, None), (None, 1, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    for own in (labels, labels.limit(0)):
        got = quality.judged(df, own).collect()
        assert sorted((r.doc_id or 0, tuple(r["__" + c] for c in COUNTS)) for r in got) == sorted((d or 0, brute(t)) for d, t in rows)
        assert all(r["__base_failed"] == (r["__n_words"] < 10 or r["__n_repeat_words"] * 5 > r["__n_words"]) and r.kept == "z" for r in got)
    assert quality.judged(df.limit(0), labels).collect() == []
