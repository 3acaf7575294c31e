import math
import zlib
from collections import Counter

import numpy as np
import pytest

from gridzone.llm import sharding
from gridzone.llm.queries import QUERIES


def matrix(cells, capacities, seed):
    before = np.concatenate([[0], np.cumsum(cells)])
    return np.stack([sharding.matrix_row(i, before, np.array(capacities), seed) for i in range(len(cells))])


@pytest.mark.parametrize("cells", [[5], [3, 0, 9, 1], [100] * 13, [1] * 40])
def test_matrix_has_exact_margins(cells):
    capacities = sharding.even_sizes(sum(cells), 7)
    for seed in range(20):
        m = matrix(cells, capacities, seed)
        assert (m >= 0).all() and m.sum(axis=1).tolist() == cells and (m.sum(axis=0) == capacities).all()


def test_matrix_follows_the_hypergeometric_law():
    cells, capacities, n = [6, 4, 5], [8, 7], 4000
    got = Counter(int(matrix(cells, capacities, s)[2, 0]) for s in range(n))
    p = {k: math.comb(8, k) * math.comb(7, 5 - k) / math.comb(15, 5) for k in range(6)}
    chi = sum((got[k] - n * q) ** 2 / (n * q) for k, q in p.items())
    assert chi < 20.5  # 0.999 quantile for 5 degrees of freedom


def test_every_arrangement_is_equally_likely():
    before, capacities, n = np.array([0, 2, 4]), np.array([2, 2]), 6000
    got = Counter(tuple(np.concatenate([sharding.local_deal(c, before, capacities, s) for c in (0, 1)]).tolist()) for s in range(n))
    assert len(got) == 6 and sum((k - n / 6) ** 2 / (n / 6) for k in got.values()) < 20.5


def test_large_numbers(monkeypatch):
    rng = np.random.default_rng(1)
    good, bad, sample = 40 * 10**9, 60 * 10**9, 10**8
    draws = np.array([sharding._hypergeometric(rng, good, bad, sample) for _ in range(200)])
    mean, deviation = sample * 0.4, (sample * 0.24) ** 0.5
    assert abs(draws.mean() - mean) < 5 * deviation / 200**0.5 and 0.8 < draws.std() / deviation < 1.2
    monkeypatch.setattr(sharding, "NUMPY_ROWS", 0)
    got = Counter(sharding._hypergeometric(rng, 8, 7, 5) for _ in range(4000))
    p = {k: math.comb(8, k) * math.comb(7, 5 - k) / math.comb(15, 5) for k in range(6)}
    assert sum((got[k] - 4000 * q) ** 2 / (4000 * q) for k, q in p.items()) < 20.5
    assert sharding._hypergeometric(rng, 3, 0, 2) == 2 and sharding._hypergeometric(rng, 0, 3, 2) == 0
    m = matrix([30, 50, 7], sharding.even_sizes(87, 4), 3)
    assert m.sum(axis=1).tolist() == [30, 50, 7] and m.sum(axis=0).tolist() == [22, 22, 22, 21]


def check(rows, n, shards):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(by.get(k, [])) for k in range(shards)]
    assert sum(sizes) == n == len(rows) and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_rows_and_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 64)
    rows = [(i if i % 5 else None, "t" * (i % 3) if i % 7 else None, i, 1, "m") for i in range(1500)] + [(1, "same", 0, 2, "m")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard long, __place0 int, _metadata string")
    out = sharding.shuffle_into_shards(docs, 7, seed=5)
    got = out.collect()
    check(got, 1800, 7)
    assert out.columns == ["doc_id", "text", "__place0", "_metadata", "shard", "slot"]
    assert Counter((r["doc_id"], r["text"], r["__place0"], r["_metadata"]) for r in got) == Counter((a, b, d, e) for a, b, _, d, e in rows)


def test_same_result_however_files_are_split_or_read_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 50)
    path = f"{tmp_path}/t"
    spark.range(3000).selectExpr("id as doc_id", "repeat(uuid(), 20) as text").repartition(3).write.option("parquet.block.size", 4096).parquet(path)
    results = []
    for size in ("128m", "20k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            out = sharding.shuffle_into_shards(spark.read.parquet(path), 4, seed=1, from_files=True).collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024))
        check(out, 3000, 4)
        results.append(sorted((r["doc_id"], r["shard"], r["slot"]) for r in out))
    assert results[0] == results[1]
    other = sharding.shuffle_into_shards(spark.read.parquet(path), 4, seed=2, from_files=True)
    moved = {r["doc_id"]: (r["shard"], r["slot"]) for r in other.collect()}
    same = sum(moved[d] == (s, t) for d, s, t in results[0])
    assert same < 20  # about one row in 3000 keeps its place
    order = [d for d, _, _ in sorted(results[0], key=lambda r: r[1:])]
    assert abs(np.corrcoef(order, range(3000))[0, 1]) < 0.1
    with pytest.raises(ValueError):
        sharding.shuffle_into_shards(spark.read.parquet(path).where("doc_id > 10"), 4, from_files=True)


def test_small_and_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shuffle_into_shards(none, 8).collect() == []
    check(sharding.shuffle_into_shards(spark.range(3), 8).collect(), 3, 8)
    with pytest.raises(ValueError):
        sharding.shuffle_into_shards(none, 0)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    got = QUERIES["op11_sharding"](spark, sf).collect()
    check(got, docs.total(), 8)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == docs
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}


def test_query_on_awkward_rows(spark, tmp_path):
    rows = [(None, None, 1), (1, "", 2), (1, "", 2), (2, "é" * 500_000, 3), (3, None, 4)]
    spark.createDataFrame(rows, "doc_id long, text string, slot int").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_sharding"](spark, str(tmp_path)).collect()
    check(got, 5, 8)
    assert sorted(r["size"] for r in got) == [1, 1, 1, 1, 1_000_001]
