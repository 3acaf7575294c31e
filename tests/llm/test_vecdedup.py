"""Embedding near-duplicates against brute force, and the graph's parts."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridzone.llm import vecdedup

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def brute(rows, threshold=0.98):
    n = len(rows)
    comp, links = list(range(n)), [0] * n

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ok = [v is not None and None not in v and np.isfinite(v).all() and np.any(v) and lab is not None for _, v, lab, *_ in rows]
    unit = [np.asarray(r[1], np.float32).astype(float) / np.linalg.norm(np.asarray(r[1], np.float32).astype(float)) if o else None for r, o in zip(rows, ok, strict=True)]
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                comp[root(i)] = root(j)
    low = {}
    for i, r in enumerate(rows):
        low[root(i)] = min(low.get(root(i), r[0]), r[0])
    return sorted((r[0], links[i], low[root(i)], r[0] == low[root(i)]) for i, r in enumerate(rows))


def planted(n, seed, d=16, labels=3):
    rng = np.random.default_rng(seed)
    rows = []
    base = rng.normal(size=(n, d))
    for i, x in enumerate(base):
        rows.append((x, int(rng.integers(labels))))
        if i % 6 == 0:
            rows.append((x + rng.normal(size=d) * np.linalg.norm(x) / d**0.5 * rng.uniform(0.01, 0.25), rows[-1][1]))
        if i % 15 == 0:
            rows.append((x * 1.0, rows[-1][1]))
    centre = rng.normal(size=d)
    rows += [(centre + rng.normal(size=d) * np.linalg.norm(centre) / d**0.5 * 0.06, 0) for _ in range(n // 4)]
    order = rng.permutation(len(rows))
    return [(int(100 + k), [float(np.float32(c)) for c in rows[i][0]], rows[i][1], "x") for k, i in enumerate(order)]


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in vecdedup.near_duplicates(df).select("vec_id", "n_links", "component_id", "kept").collect())


def test_one_shard_per_label(spark):
    rows = planted(250, 4)
    assert run(spark, rows) == brute(rows)


def test_many_overlapping_shards_and_blocks(spark, monkeypatch):
    """Small limits: labels are cut into shards, clusters into blocks. The planted pairs reach far below the usual distance."""
    monkeypatch.setattr(vecdedup, "SHARD", 60)
    monkeypatch.setattr(vecdedup, "BLOCK", 16)
    rows = planted(250, 5)
    want, got = brute(rows), run(spark, rows)
    assert [r[0] for r in got] == [r[0] for r in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert sum(g[1] for g in got) >= 0.98 * sum(w[1] for w in want)


def test_driver_table(spark):
    rows = [(r.vec_id, r.embedding, r.label, "x") for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    assert run(spark, rows) == brute(rows)


def test_edge_cases(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, None, 0, ""), (2, [], 0, ""), (3, [0.0, 0.0, 0.0], 0, ""), (4, [1.0, None, 1.0], 0, ""), (5, [1.0, float("nan"), 0.0], 0, ""), (6, [float("inf"), 1.0, 0.0], 0, ""),
            (9, v, 0, ""), (8, v, 0, ""), (8, v, 0, ""), (7, v, 1, ""), (10, v, None, ""), (11, v, None, ""), (12, [2.0, 4.0, 6.0], 0, ""), (13, [1.0, 2.0], 0, ""), (14, [-0.0, 1.0, 0.0], 2, ""), (15, [0.0, 1.0, 0.0], 2, "")]
    got = run(spark, rows)
    assert got == sorted([(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 7, 10, 11, 13)] + [(8, 3, 8, True), (8, 3, 8, True), (9, 3, 8, False), (12, 3, 8, False), (14, 1, 14, True), (15, 1, 14, False)])
    assert run(spark, []) == []


def test_search_finds_neighbours_through_the_graph():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(800, 32))
    x[1::2] = x[::2] + rng.normal(size=(400, 32)) * 0.05
    x /= np.linalg.norm(x, axis=1)[:, None]
    graph = vecdedup.robust_graph(x)
    assert max(map(len, graph)) < 200 and all(i not in g for i, g in enumerate(graph))
    links = vecdedup.range_links(x, graph, 0.98)
    want = {(i, j) for i, j in zip(*np.nonzero(x @ x.T >= 0.98), strict=True) if i != j}
    found = set(map(tuple, links.T.tolist()))
    assert found <= want and len(found) >= 0.9 * len(want)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_tiny_shards(n):
    x = np.eye(4)[:n]
    assert len(vecdedup.robust_graph(x)) == n and vecdedup.range_links(x, vecdedup.robust_graph(x), 0.98).shape[1] == 0


def test_bridged_clusters_larger_than_the_widest_beam():
    """Every member's nearest WIDEST are its own group's, and no member is a multiple of 64 (those were audited): the other group is found all the same."""
    rng = np.random.default_rng(8)
    n, d, size = 4096, 32, vecdedup.WIDEST + 6
    x = rng.normal(size=(n, d))
    a, b = np.linalg.qr(rng.normal(size=(d, 2)))[0].T
    members = np.flatnonzero(np.arange(n) % 64)[: 2 * size]
    x[members[:size]] = a + rng.normal(size=(size, d)) * 0.0005
    x[members[size:]] = 0.985 * a + (1 - 0.985**2) ** 0.5 * b + rng.normal(size=(size, d)) * 0.0005
    x /= np.linalg.norm(x, axis=1)[:, None]
    assert (x[members] @ x[members].T >= 0.98).all()
    links = vecdedup.range_links(x, vecdedup.robust_graph(x), 0.98)
    assert len(set(vecdedup._roots(n, links)[members])) == 1


def test_pairs_that_share_no_shard_are_joined(spark, monkeypatch):
    """A label whose first deal finds no link at all is audited, reported, and dealt again until all are joined."""
    monkeypatch.setattr(vecdedup, "SHARD", 60)
    monkeypatch.setattr(vecdedup, "SAMPLE", 400)
    rows, found = planted(150, 6, labels=1), vecdedup.found_links
    monkeypatch.setattr(vecdedup, "found_links", lambda v, t, seed=0: found(v, t, seed).where(F.lit(seed > 0)))
    assert run(spark, rows) == brute(rows)


def test_without_its_graph_the_search_finds_less():
    rng = np.random.default_rng(11)
    x = rng.normal(size=(600, 32))
    x[1::2] = x[::2] + rng.normal(size=(300, 32)) * 0.05
    x /= np.linalg.norm(x, axis=1)[:, None]
    want = np.count_nonzero(x @ x.T >= 0.98) - len(x)
    with_graph = vecdedup.range_links(x, vecdedup.robust_graph(x), 0.98).shape[1]
    without = vecdedup.range_links(x, [np.empty(0, np.int64)] * len(x), 0.98).shape[1]
    assert with_graph >= 0.9 * want and without < 0.1 * want


def audited(spark, rows):
    """Pairs that one round of search leaves apart, and all of them."""
    v = spark.createDataFrame([(str(r[2]), r[0], r[1]) for r in rows], "shard string, node long, v array<float>")
    links = vecdedup.found_links(v, 0.98)
    linked = vecdedup.connected_components(links)
    table = vecdedup.recall(vecdedup._audit(v, linked, 0.98, 0), 0)
    assert table.columns == ["label", "n_links", "n_apart", "recall"]
    return table.agg(F.sum("n_apart"), F.sum("n_links")).first()


def test_search_leaves_a_shard(spark, monkeypatch):
    """Small shards with little overlap: visits to other shards join what the members' own searches leave apart."""
    monkeypatch.setattr(vecdedup, "SHARD", 40)
    monkeypatch.setattr(vecdedup, "OVERLAP", 2)
    monkeypatch.setattr(vecdedup, "SAMPLE", 1000)
    rows = planted(200, 12, labels=1)
    apart, n = audited(spark, rows)
    nothing = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    monkeypatch.setattr(vecdedup, "_search_visitors", lambda threshold: lambda members, visitors: nothing)
    alone, _ = audited(spark, rows)
    assert apart <= alone and apart <= 0.1 * n, (apart, alone, n)


def test_shards_that_pivots_do_not_divide(spark, monkeypatch):
    """A pivot near everything: the split goes on until no shard is too large."""
    monkeypatch.setattr(vecdedup, "SHARD", 40)
    rng = np.random.default_rng(2)
    v = [("0", i, [float(c) for c in rng.normal(size=8) * (0.001 if i % 3 else 1) + 5]) for i in range(400)]
    shards = vecdedup._shards(spark.createDataFrame(v, "shard string, node long, v array<float>"))
    assert shards.groupBy("shard").count().agg(F.max("count")).first()[0] <= 40
    assert shards.select("node").distinct().count() == 400
