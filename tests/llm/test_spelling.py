import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridzone.llm import spelling
from gridzone.llm.queries import QUERIES

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")


def lower(run):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)


def brute_counts(rows, min_chars=7, rate=31):
    n = Counter()
    for doc, text in rows:
        for run in LETTERS.findall(text or ""):
            word = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if rate and h % rate == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= min_chars:
                n[word] += 1
    return n


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, min_count=2, ratio=10):
    n = {w: c for w, c in counts.items() if c >= min_count}
    near = {w: [v for v in n if abs(len(v) - len(w)) <= 1 and one_edit(v, w)] for w in n}
    best = {w: min(vs, key=lambda v: (-n[v], v)) if vs else None for w, vs in near.items()}
    form = {w: b if b and n[b] >= ratio * n[w] else None for w, b in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def words_df(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def test_variants_equal_brute_force(spark):
    rng = random.Random(1)
    stems = ["".join(rng.choice("abcé") for _ in range(rng.randint(6, 11))) for _ in range(40)]
    counts = Counter()
    for s in stems:
        counts[s] += rng.choice([3, 40, 500, 6000])
        for _ in range(12):
            w = list(s)
            for _ in range(rng.randint(1, 2)):
                at = rng.randrange(len(w))
                kind = rng.randrange(3)
                if kind == 0:
                    w[at] = rng.choice("abcé")
                elif kind == 1:
                    w.insert(at, rng.choice([w[at], "a"]))
                else:
                    del w[at]
            counts["".join(w)] += rng.choice([1, 2, 3, 30, 400])
    want = brute(counts)
    assert any(r[2] not in (r[0], r[1]) for r in want)  # chains are followed
    assert got(spelling.group_variants(words_df(spark, counts))) == want


def test_large_keys_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 16)
    rng = random.Random(2)
    counts = {"pre" + a + b + "suffix": rng.randint(2, 900) for a in "abcdefghijklm" for b in "abcdefghijkl"}
    counts["prefsuffix"] = 90000
    counts["presuffix"] = 5
    assert got(spelling.group_variants(words_df(spark, counts))) == brute(counts)


def test_short_long_and_wide_words(spark):
    long = "ab" * 700
    counts = {"a": 50, "ab": 3, "b": 700, "": 9, long: 2, long + "b": 40, long[:700] + "x" + long[701:]: 500, "中文字": 4, "中文": 50, "\U0001f600a中": 2, "\U0001f600中": 30}
    assert got(spelling.group_variants(words_df(spark, counts))) == brute(counts)


def test_counts_and_query_on_awkward_rows(spark, tmp_path):
    rng = random.Random(3)
    vocab = ["Streaming", "streamimg", "stréaming", "PARTITION", "partitions", "shuffling", "ÉCLAIRSÀ", "éclairs"]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(60))) for i in range(50)]
    rows += [(None, "streaming"), (None, None), (7, ""), (3, rows[3][1]), (3, rows[3][1]), (99, "streaming\n" * 30000)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    assert {r["word"]: r["n"] for r in spelling.count_words(docs, typo_rate=31).collect()} == brute_counts(rows)
    assert {r["word"]: r["n"] for r in spelling.count_words(docs).collect()} == brute_counts(rows, rate=0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert got(QUERIES["op13_spelling"](spark, str(tmp_path))) == brute(brute_counts(rows))


def test_empty_table_and_ratio(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert got(spelling.group_variants(spelling.count_words(none))) == []
    with pytest.raises(ValueError):
        spelling.group_variants(words_df(spark, {"abcdefg": 2}), ratio=1)


def test_query_on_the_sample_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    counts = {w: c for w, c in brute_counts(rows).items() if c >= 2}
    neighbours = {}
    for w in counts:
        for i in range(len(w)):
            neighbours.setdefault((len(w), w[:i], w[i + 1 :]), set()).add(w)
    near = {w: set() for w in counts}
    for w in counts:
        for i in range(len(w)):
            near[w] |= neighbours[(len(w), w[:i], w[i + 1 :])] - {w}
            shorter = w[:i] + w[i + 1 :]
            if shorter in counts:
                near[w].add(shorter)
                near[shorter].add(w)
    out = QUERIES["op13_spelling"](spark, sf)
    assert out.where(F.col("form").isNotNull()).count() >= 5
    assert {r["word"]: r["n_near"] for r in out.collect()} == {w: len(v) for w, v in near.items()}
