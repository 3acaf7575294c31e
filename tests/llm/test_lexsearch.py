import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gridzone.llm import lexsearch
from gridzone.llm.queries import QUERIES

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERMS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    tfs = [(i, Counter(split(t))) for i, t in docs if split(t)]
    n_docs, total = len(tfs), sum(c.total() for _, c in tfs)
    df = Counter(t for _, c in tfs for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in tfs:
            m = 100 - 25 + (25 * c.total() * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in split(text) if t in c)
            if s > 0:
                scores.append((-s, doc is not None, doc))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


def got(df):
    return [tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[3], r[2] is not None, r[2] or 0))


def corpus(rng, n, words):
    vocab = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    return [" ".join(rng.choices(vocab, weights, k=rng.randint(1, 200))) for _ in range(n)]


def test_ranks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lexsearch, "ROWS", 32)
    rng = random.Random(4)
    texts = corpus(rng, 400, 600)
    items = [(i, " ".join(rng.sample(rng.choice(texts).split(), 1) * 2 + rng.choices(["w1", "W7", "w99", "w401", "w599", "nowhere"], k=6))) for i in range(25)]
    items += [(100 + i, texts[i * 7]) for i in range(10)]
    docs = list(enumerate(texts))
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    index = lexsearch.build_index(d, q)
    assert order(got(lexsearch.search(index, d, q))) == order(brute(docs, items))
    monkeypatch.setattr(lexsearch, "QUERY_TERMS", 40)  # several blocks of queries, one above the bound on its own
    monkeypatch.setattr(lexsearch, "VOCABULARY", 10)  # frequencies of every term
    assert order(got(lexsearch.search(lexsearch.build_index(d, q), d, q, k=3))) == order(brute(docs, items, 3))


def test_awkward_rows(spark, tmp_path):
    texts = ["", None, "!!! --- \n", "Äpfel äpfel ÄPFEL x", "a\x00b\tc_d {e}", "tie one", "tie two", "long " * 400_000 + "tail", "rare"]
    docs = list(enumerate(texts)) + [(5, "tie one"), (5, "tie other"), (None, "tie null"), (None, "tie null"), (None, None)]
    items = [(1, "tie"), (1, "tie"), (2, "ÄPFEL a b"), (3, None), (4, ""), (5, "?"), (None, "rare tail"), (6, "long tie tie"), (7, "nowhere")]
    d = spark.createDataFrame([(i, t, "x", 0) for i, t in docs], "doc_id long, text string, query string, score int")
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    q.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert order(got(QUERIES["op12_search"](spark, str(tmp_path)))) == order(brute(docs, items))


def test_empty_tables(spark):
    d, none = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, text string")
    q = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert got(lexsearch.search(lexsearch.build_index(none, q), none, q)) == []
    assert got(lexsearch.search(lexsearch.build_index(d, q.limit(0)), d, q.limit(0))) == []


def test_bounds_are_never_below_scores_and_exclude_most(spark):
    rng = random.Random(5)
    texts = [t.encode() for t in corpus(rng, 300, 500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(range(300)), pa.array(texts, pa.binary())], names=["id", "key", "text"])
    rows = list(lexsearch._indexed([batch], None))
    df = Counter()
    for r in rows:
        for t, n in zip(r.column("term").to_pylist(), r.column("df").to_pylist(), strict=True):
            if t:
                df[t] += n
    counted = [Counter(lexsearch.terms(t)) for t in texts]
    assert df == Counter(t for c in counted for t in c)
    queries = [rng.choices([b"w3", b"w40", b"w200", b"w450", b"w9"], k=5) for _ in range(20)]
    block = lexsearch._Block()
    for i, q in enumerate(queries):
        block.ids.append(i)
        block.slots.append({block.vocabulary.setdefault(t, len(block.vocabulary)): c for t, c in Counter(q).items()})
    block.weigh(df, 300, sum(c.total() for c in counted))
    seen, loose = 0, 0
    for bits, lengths, slices, ids, _ in lexsearch._blocks_of([r for r in rows if r.column("bits")[0].as_py()]):
        for lo, sums in lexsearch._bounds(bits, lengths, slices, block, {}):
            for col in range(sums.shape[1]):
                doc = ids[lo + col].as_py()
                c = counted[doc]
                for qi, q in enumerate(queries):
                    norm = block.norm(c.total())
                    exact = sum(int(block.weights[block.vocabulary[t]]) * lexsearch._share(c[t], norm) for t in q if t in c)
                    assert sums[qi, col] >= exact
                    seen += 1
                    loose += sums[qi, col] > 1.15 * exact + 1
    assert seen == 300 * 20 and loose < 0.1 * seen


def test_terms():
    text = "Don't STOP_ßÄ9 x\x85y\x00z"
    assert [t.decode() for t in lexsearch.terms(text.encode())] == split(text)
    assert np.array_equal(lexsearch._share(np.array([1, 2]), 100), [1000000000 // 2200, 2000000000 // 3200])


@pytest.mark.parametrize("n", [3, 8])
def test_few_documents(spark, n):
    docs = [(i, f"same words here {i}") for i in range(n)]
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(9, "words 2")], "item_id long, text string")
    assert got(lexsearch.search(lexsearch.build_index(d, q), d, q)) == brute(docs, [(9, "words 2")])
