"""SimHash near-duplicates against a brute-force version."""

import random
import re

import numpy as np
import pytest
import xxhash

from gridzone.llm import simhash
from gridzone.llm.simhash import near_duplicates

SF = "/root/testdata/sf0.001"


def brute_fp(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, most=4):
    """{position: (hex, smallest id reachable)}"""
    fp = [brute_fp(t) for _, t in rows]
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= most:
                comp[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), d), d)
    return sorted((d, f"{fp[i]:016x}", low[root(i)]) for i, (d, _) in enumerate(rows))


def run(df, **kw):
    return sorted(tuple(r) for r in near_duplicates(df, **kw).select("doc_id", "fingerprint", "component_id").collect())


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert run(docs) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_edge_cases(spark):
    rng = random.Random(5)
    long = " ".join(rng.choice("alpha beta gamma delta epsilon zeta".split()) + str(rng.randrange(900)) for _ in range(30000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "É é É é x"), (7, "é é é é x"), (8, long), (9, long + " tail"), (9, "one two"), (10, "a b c d"), (11, "a b c d")]
    df = spark.createDataFrame([(d, t, "x", 0) for d, t in rows], "doc_id long, text string, fingerprint string, component_id int")
    assert run(df) == brute(rows)


def test_empty_table(spark):
    assert run(spark.createDataFrame([], "doc_id long, text string")) == []


def _planted(n, seed):
    """Clusters of fingerprints around common centres, chains, and lone ones."""
    rng = np.random.default_rng(seed)
    fps = set()
    for centre in rng.integers(0, 2**63, n // 20, dtype=np.uint64):
        x = int(centre)
        for _ in range(12):
            for b in rng.choice(64, rng.integers(0, 5), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    fps.update(int(x) for x in rng.integers(0, 2**63, n, dtype=np.uint64))
    return sorted(fps)


@pytest.mark.parametrize("hot,most", [(False, 4), (True, 4), (True, 2)])
def test_links_lose_nothing(spark, monkeypatch, hot, most):
    """Components over the links are those of all pairs, also where prefixes are dealt again and bisected."""
    fps = _planted(300, 3)
    if hot:
        monkeypatch.setattr(simhash, "HOT_ROWS", 20)
        monkeypatch.setattr(simhash, "HOT_TIMES", 0)
    df = spark.createDataFrame([(x - 2**64 if x >= 2**63 else x,) for x in fps], "fp long")
    links = [(r.a % 2**64, r.b % 2**64) for r in simhash.near_links(df, most).collect()]
    assert set(parts(fps, links)) == set(parts(fps, [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= most]))


def parts(nodes, links):
    comp = {n: n for n in nodes}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for a, b in links:
        comp[root(a)] = root(b)
    groups = {}
    for n in nodes:
        groups.setdefault(root(n), set()).add(n)
    return [frozenset(g) for g in groups.values()]


def test_bisecting_equals_one_pass(monkeypatch):
    fps = np.array(_planted(200, 8), dtype=np.uint64)
    left = np.full(len(fps), 2)
    whole = np.concatenate(simhash._meet(fps, left, fps, 64), axis=1)
    monkeypatch.setattr(simhash, "VARIANTS_PER_PREFIX", 5000)
    split = np.concatenate(simhash._meet(fps, left, fps, 64), axis=1)
    nodes = [int(x) for x in fps]
    assert set(parts(nodes, whole.T.tolist())) == set(parts(nodes, split.T.tolist()))
