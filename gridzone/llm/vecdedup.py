"""Embedding near-duplicates over a robust-pruned flat graph.

1. Equal vectors of a label collapse to one row with a multiplicity.
2. Labels with more than ``SHARD`` vectors are dealt to overlapping cluster
   shards: pivots are drawn by hash, each vector joins its ``OVERLAP`` nearest,
   and shards that are still too large are dealt again. Pivots are at most ``MAX_PIVOTS``
   a round, the only vectors the driver sees.
3. Each shard builds a graph: nearest candidates of every node, robust-pruned.
   The adjacency lists of a node in all its shards are united.
4. Each shard searches for every member over the united lists: greedy from
   the medoid, with a beam that doubles while half of it is in range. Only rows whose widest beam is still
   half in range are compared with the whole shard.
5. The search leaves a shard along the united lists: where a node near a member has neighbours
   that live elsewhere, the member visits their shard and is searched for from there.
6. Found links are joined to components, and within a component all pairs are
   verified in blocks in double precision. So a cluster that was cut by shards
   gets all its links back, and a pair is lost only if no chain of found links connects it.
7. Every label is audited: ``SAMPLE`` of its vectors, drawn anew each
   round, are compared with the whole label in blocks; recall is written as a table. While a pair is found
   apart it is joined, and the label is dealt and searched again with other pivots and graphs; the
   links of all rounds are united.

A component's pairs are counted, never listed; one of K distinct vectors is
K^2 / 2 dot products over (K / BLOCK)^2 / 2 tasks.
"""

from __future__ import annotations

import logging
import math

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridzone.llm.common import connected_components, stored

#: Vectors a shard should hold, shards a vector joins, pivots of one shard and of one round.
SHARD, OVERLAP, FAN, MAX_PIVOTS = 8192, 3, 64, 8192
#: Candidates and neighbours of a node, slack of the pruning rule, first and widest beam.
CANDIDATES, DEGREE, ALPHA, BEAM, WIDEST = 32, 12, 1.2, 16, 64
#: Vectors of a component verified at a time; vectors audited in each label.
BLOCK, SAMPLE = 1024, 256

log = logging.getLogger(__name__)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Unit vectors in double precision."""
    values = column.combine_chunks()
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(values), -1)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def robust_graph(x: np.ndarray, seed: int = 1) -> list[np.ndarray]:
    """Neighbours of every row: of its nearest candidates, from near to far, those not much closer to one already
    taken; links in both directions, and two random ones each that keep the graph in one piece."""
    n = len(x)
    c = min(CANDIDATES, n - 1)
    if c < 1:
        return [np.empty(0, np.int64)] * n
    links = []
    for lo in range(0, n, 512):
        own = np.arange(lo, min(n, lo + 512))
        sims = x[own] @ x.T
        sims[np.arange(len(own)), own] = -np.inf
        near = np.argpartition(-sims, c - 1, axis=1)[:, :c]
        near = np.take_along_axis(near, np.argsort(-np.take_along_axis(sims, near, 1), axis=1, kind="stable"), 1)
        dist = np.sqrt(np.maximum(0, 2 - 2 * np.take_along_axis(sims, near, 1)))
        between = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("acd,aed->ace", x[near], x[near])))
        alive, rows = np.ones(near.shape, bool), np.arange(len(own))
        for _ in range(DEGREE):
            pick = alive.argmax(axis=1)
            some = alive[rows, pick]
            if not some.any():
                break
            links.append(np.stack([own[some], near[rows[some], pick[some]]]))
            alive &= ALPHA * between[rows, pick] > dist
            alive[rows, pick] = False
    far = np.random.default_rng(seed).integers(0, n, (2, n))
    links += [np.stack([np.arange(n), f]) for f in far]
    a, b = np.concatenate(links, axis=1)
    back = _few_each(np.stack([b, a]), n, seed)  # a hub is not linked back to all that link to it
    pairs = np.unique(np.concatenate([a * n + b, back[0] * n + back[1]]))
    a, b = pairs // n, pairs % n
    a, b = a[a != b], b[a != b]
    return np.split(b, np.searchsorted(a, np.arange(1, n)))


def _few_each(links: np.ndarray, n: int, seed: int) -> np.ndarray:
    """At most 2 * DEGREE links from each row, a random choice where there are more."""
    order = np.lexsort((np.random.default_rng(seed).random(links.shape[1]), links[0]))
    links = links[:, order]
    nth = np.arange(links.shape[1]) - np.searchsorted(links[0], links[0])
    return links[:, nth < 2 * DEGREE]


def search(x: np.ndarray, graph: np.ndarray, points: np.ndarray, entries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy best-first search for all ``points`` in lockstep: (nodes, similarities) of each final beam, best first.
    ``graph`` and ``entries`` (a row for each point) are padded with -1."""
    q, m = entries.shape
    nodes, sims = np.full((q, max(beam, m)), -1), np.full((q, max(beam, m)), -np.inf)
    nodes[:, :m], sims[:, :m] = entries, np.where(entries < 0, -np.inf, np.einsum("qmd,qd->qm", x[entries], points))
    order = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
    nodes, sims = np.take_along_axis(nodes, order, 1), np.take_along_axis(sims, order, 1)
    open_ = nodes >= 0
    live = np.arange(q)
    while len(live):
        at = open_[live].argmax(axis=1)  # beams are sorted: the best that is still open
        some = open_[live, at]
        live, at = live[some], at[some]
        if not len(live):
            break
        open_[live, at] = False
        new = graph[nodes[live, at]]
        known = (new[:, :, None] == nodes[live][:, None, :]).any(axis=2) | (new < 0)
        value = np.where(known, -np.inf, np.einsum("qrd,qd->qr", x[new], points[live]))
        both_n, both_s = np.concatenate([nodes[live], new], 1), np.concatenate([sims[live], value], 1)
        both_o = np.concatenate([open_[live], ~known], 1)
        order = np.argsort(-both_s, axis=1, kind="stable")[:, :beam]
        nodes[live], sims[live] = np.take_along_axis(both_n, order, 1), np.take_along_axis(both_s, order, 1)
        open_[live] = np.take_along_axis(both_o, order, 1)
    return nodes, sims


def _padded(lists: list[np.ndarray]) -> np.ndarray:
    out = np.full((len(lists), max(1, max(map(len, lists), default=0))), -1)
    for i, own in enumerate(lists):
        out[i, : len(own)] = own
    return out


def _in_range(x, graph, points, entries, own, threshold, beam):
    """Range searches with beams that double while half of one is in range: (links, rows whose widest beam is still
    half in range, pairs within twice the threshold's angle in the first beam), all as rows of ``points`` and ``x``.
    ``own`` is a point's row of ``x``, -1 where it is a visitor."""
    found, near, todo, wide = [np.empty((2, 0), np.int64)], [np.empty((2, 0), np.int64)], np.arange(len(points)), beam
    while len(todo) and wide <= WIDEST:
        more = []
        for lo in range(0, len(todo), 1024):
            rows = todo[lo : lo + 1024]
            nodes, sims = search(x, graph, points[rows], entries[rows], wide)
            other = (nodes != own[rows][:, None]) & (nodes >= 0)
            hit = (sims >= threshold) & other
            row, col = np.nonzero(hit)
            found.append(np.stack([rows[row], nodes[row, col]]))
            more.append(rows[2 * hit.sum(axis=1) >= wide])  # half in range: there may be more
            if wide == beam:
                row, col = np.nonzero((sims >= 2 * threshold**2 - 1) & other)
                near.append(np.stack([rows[row], nodes[row, col]]))
        todo, wide = np.concatenate(more), 2 * wide
    return np.concatenate(found, axis=1), todo, np.concatenate(near, axis=1)


def range_links(x: np.ndarray, neighbours: list[np.ndarray], threshold: float, beam: int = BEAM) -> np.ndarray:
    """Links (2, n) at or above the threshold that range searches from the medoid find for every row."""
    return _member_links(x, neighbours, threshold, beam)[0]


def _member_links(x, neighbours, threshold, beam=BEAM):
    """The links of ``range_links`` and the pairs near each other (``_in_range``)."""
    n = len(x)
    if n < 2:
        return np.empty((2, 0), np.int64), np.empty((2, 0), np.int64)
    entries = np.full((n, 1), int((x @ x.sum(axis=0)).argmax()))
    links, full, near = _in_range(x, _padded(neighbours), x, entries, np.arange(n), threshold, beam)
    return np.concatenate([links, _exact_links(x, full, threshold, _roots(n, links))], axis=1), near


def _exact_links(x: np.ndarray, rows: np.ndarray, threshold: float, root: np.ndarray) -> np.ndarray:
    """Links (2, n) of ``rows`` with any row at or above the threshold, one for each two components that are still apart (``root``)."""
    n, out = len(x), [np.empty((2, 0), np.int64)]
    for lo in range(0, len(rows), 512):
        own = rows[lo : lo + 512]
        row, col = np.nonzero((x[own] @ x.T >= threshold) & (root[own][:, None] != root[None, :]))
        if len(row):
            one = np.unique(root[own[row]] * n + root[col], return_index=True)[1]
            out.append(np.stack([own[row[one]], col[one]]))
            root = _roots(n, np.concatenate([np.stack([np.arange(n), root]), out[-1]], axis=1))
    return np.concatenate(out, axis=1)


def _roots(n: int, links: np.ndarray) -> np.ndarray:
    """Smallest row of each row's component."""
    label = np.arange(n)
    a, b = links
    while True:
        new = label.copy()
        low = np.minimum(label[a], label[b])
        for ends in (a, b, label[a], label[b]):
            np.minimum.at(new, ends, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _nearest(pivots: Broadcast):
    """UDF (shard, v) -> the OVERLAP nearest of the shard's pivots."""

    @F.arrow_udf("array<int>")
    def nearest(shard: pa.Array, v: pa.Array) -> pa.Array:
        out, names = [None] * len(shard), np.array(shard.to_pylist())
        for s in np.unique(names):
            at = np.flatnonzero(names == s)
            x = _matrix(pa.chunked_array([v.take(pa.array(at))]))
            for i, few in zip(at.tolist(), np.argsort(-(x @ pivots.value[s].T), axis=1, kind="stable")[:, :OVERLAP].tolist(), strict=True):
                out[i] = few
        return pa.array(out, pa.list_(pa.int32()))

    return nearest


def _shards(vectors: DataFrame, seed: int = 0) -> DataFrame:
    """(shard, node, v): every shard near SHARD vectors; a vector is in one shard or in the nearest few of its label's.
    ``seed`` draws the pivots."""
    own, parents, deal = stored(vectors.select("shard", "node", "v"), "shards"), {}, 0
    while True:
        deal += 1
        sizes = own.groupBy("shard").count().where(F.col("count") > SHARD).orderBy(F.desc("count"), "shard").limit(MAX_PIVOTS // FAN)
        counts = {r["shard"]: r["count"] for r in sizes.collect()}  # at most MAX_PIVOTS / FAN
        if not counts:
            return own
        # Pivots that most vectors share do not divide a shard. It is then halved by hash; the searches and the audit reach across.
        stuck = [name for name, n in counts.items() if 4 * n > 3 * parents.get(name.rpartition("/")[0], 2 * n)]
        large = {name: min(FAN, max(2 * OVERLAP, math.ceil(1.3 * OVERLAP * n / SHARD))) for name, n in counts.items() if name not in stuck}
        parents |= counts
        if stuck:
            log.warning("halved by hash: %d shards that pivots do not divide", len(stuck))
            halves, rest = F.pmod(F.xxhash64("node", F.lit(deal)), F.lit(2)), ~F.col("shard").isin(stuck)
            own = stored(own.where(rest).union(own.where(~rest).select(F.concat_ws("/", "shard", halves).alias("shard"), "node", "v")), "shards")
        if not large:
            continue
        split = F.col("shard").isin(list(large))
        by_hash = Window.partitionBy("shard").orderBy(F.xxhash64("node", F.lit(seed), F.lit(deal)), "node")
        wanted = own.sparkSession.createDataFrame(list(large.items()), "shard string, k int")
        pivots = own.where(split).withColumn("nth", F.row_number().over(by_hash)).where(F.col("nth") <= FAN).join(F.broadcast(wanted), "shard").where("nth <= k")
        pivots = pivots.orderBy("shard", "nth").select("shard", "v").toArrow()  # at most MAX_PIVOTS
        names = np.array(pivots.column("shard").to_pylist())
        centres = {s: _matrix(pivots.column("v").filter(pa.array(names == s))) for s in large}
        shared = own.sparkSession.sparkContext.broadcast(centres)

        nearest = _nearest(shared)
        dealt = own.where(split).withColumn("p", F.explode(nearest("shard", "v"))).select(F.concat_ws("/", "shard", "p").alias("shard"), "node", "v")
        own = stored(own.where(~split).union(dealt), "shards")


def _graph_of(seed: int):
    def graph(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        near = robust_graph(_matrix(table.column("v")), seed + 1)
        return pa.table({"node": node, "near": pa.array([node[b] for b in near], pa.list_(pa.int64()))})

    return graph


def _local(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """A shard's nodes in order, their vectors, and of each its neighbours here (as rows) and elsewhere (as nodes)."""
    table = table.sort_by("node")
    node, x = table.column("node").to_numpy(), _matrix(table.column("v"))
    near = table.column("near").combine_chunks()
    ends, flat = near.offsets.to_numpy() - near.offsets[0].as_py(), near.flatten().to_numpy()
    at = np.minimum(np.searchsorted(node, flat), len(node) - 1)
    here = node[at] == flat
    spans = list(zip(ends, ends[1:], strict=False))
    return node, x, [at[a:b][here[a:b]] for a, b in spans], [flat[a:b][~here[a:b]] for a, b in spans]


def _search_members(threshold: float):
    def links(table: pa.Table) -> pa.Table:
        """A forest over the links found in the shard, and (member, node elsewhere to go on from) with ``out``."""
        node, x, local, elsewhere = _local(table)
        found, (row, by) = _member_links(x, local, threshold)
        root = _roots(len(node), found)
        own = root != np.arange(len(node))
        n = np.array([len(e) for e in elsewhere], dtype=np.int64)
        beyond = np.concatenate([np.empty(0, np.int64), *(elsewhere[i] for i in by.tolist())])
        leave = np.unique(np.stack([node[np.repeat(row, n[by])], beyond]), axis=1)
        ends = np.concatenate([np.stack([node[own], node[root[own]]]), leave], axis=1)
        return pa.table({"a": ends[0], "b": ends[1], "out": np.arange(ends.shape[1]) >= own.sum()})

    return links


def _search_visitors(threshold: float):
    def links(members: pa.Table, visitors: pa.Table) -> pa.Table:
        """A forest over the links that visitors, searched for from their entries, have with a shard's members."""
        if not len(members) or not len(visitors):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        node, x, local, _ = _local(members)
        points, n = _matrix(visitors.column("v")), len(node)
        entries = _padded([np.searchsorted(node, e) for e in visitors.column("entries").combine_chunks().to_numpy(zero_copy_only=False)])
        found, full, _ = _in_range(x, _padded(local), points, entries, np.full(len(points), -1), threshold, BEAM)
        both, found = np.concatenate([x, points]), found + np.array([[n], [0]])
        names = np.concatenate([node, visitors.column("node").to_numpy()])
        found = np.concatenate([found, _exact_links(both, n + full, threshold, _roots(len(both), found))], axis=1)
        root = _roots(len(both), found)
        own = root != np.arange(len(both))
        return pa.table({"a": names[own], "b": names[root[own]]})

    return links


def found_links(vectors: DataFrame, threshold: float, seed: int = 0) -> DataFrame:
    """(a, b): links found by graph search, a forest for each shard, for vectors (shard, node, v)."""
    shards = _shards(vectors, seed)
    lists = shards.groupBy("shard").applyInArrow(_graph_of(seed), "node long, near array<long>")
    united = lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))  # of a few shards each
    united = stored(shards.join(united, "node"), "vector-graph")
    found = stored(united.groupBy("shard").applyInArrow(_search_members(threshold), "a long, b long, out boolean"), "vector-links")
    home = shards.groupBy(F.col("node").alias("b")).agg(F.min("shard").alias("shard"))
    visits = found.where("out").join(home, "b").groupBy("shard", F.col("a").alias("node")).agg(F.collect_set("b").alias("entries"))
    visits = visits.join(shards.select("shard", "node"), ["shard", "node"], "left_anti").join(vectors.select("node", "v"), "node")
    visits = stored(visits.select("shard", "node", "v", "entries"), "vector-visits")
    visited = united.join(visits.select("shard").distinct(), "shard", "left_semi")
    across = visited.groupBy("shard").cogroup(visits.groupBy("shard")).applyInArrow(_search_visitors(threshold), "a long, b long")
    return found.where(~F.col("out")).select("a", "b").union(across)


def _audit(vectors: DataFrame, linked: DataFrame, threshold: float, seed: int) -> DataFrame:
    """(shard, n_links, a, b): SAMPLE vectors of each label (shard) against all of it, in blocks of SHARD. A row without
    ``a`` has a block's count of linked pairs; one with it such a pair of two components that are still apart, one for each two."""
    own = vectors.join(linked, "node", "left").select("shard", "node", "v", F.coalesce("component", "node").alias("component"))
    blocks = vectors.groupBy("shard").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("blocks"))
    own = own.join(blocks, "shard")
    drawn = Window.partitionBy("shard").orderBy(F.xxhash64("node", F.lit(seed), F.lit("audit")), "node")
    keys = own.select("shard", "node").withColumn("nth", F.row_number().over(drawn)).where(F.col("nth") <= SAMPLE).select("node")
    sample = own.join(keys, "node").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = own.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    columns = ["shard", "block", "node", "component", "v"]
    both = dealt.select(*columns, F.lit(False).alias("drawn")).union(sample.select(*columns, F.lit(True).alias("drawn")))

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        node, part, x = table.column("node").to_numpy(), table.column("component").to_numpy(), _matrix(table.column("v"))
        drawn = table.column("drawn").to_numpy(zero_copy_only=False)
        a, b = np.flatnonzero(drawn), np.flatnonzero(~drawn)
        near = (x[a] @ x[b].T >= threshold) & (node[a][:, None] != node[b][None, :])
        row, col = np.nonzero(near & (part[a][:, None] != part[b][None, :]))
        one = np.unique(np.stack([part[a[row]], part[b[col]]]), axis=1, return_index=True)[1] if len(row) else row
        ends = [None, *node[a[row[one]]].tolist()], [None, *node[b[col[one]]].tolist()]
        counts = [[int(near.sum()), len(row)], *[[0, 0]] * len(one)]
        return pa.table({
            "shard": pa.array([key[0].as_py()] * len(counts), pa.string()), "n_links": pa.array([n for n, _ in counts], pa.int64()),
            "n_apart": pa.array([n for _, n in counts], pa.int64()), "a": pa.array(ends[0], pa.int64()), "b": pa.array(ends[1], pa.int64()),
        })

    return both.groupBy("shard", "block").applyInArrow(compare, "shard string, n_links long, n_apart long, a long, b long")


def linked_components(vectors: DataFrame, threshold: float) -> DataFrame:
    """(node, component) over the found links of vectors (shard, node, v); labels are dealt and searched again until an audit finds nothing apart."""
    links = stored(found_links(vectors, threshold), "vector-links")
    linked = stored(connected_components(links, "vector-components"), "vector-components")
    several = vectors.groupBy("shard").count().where(F.col("count") > 1).select("shard")
    due, seed = stored(vectors.select("shard", "node", "v").join(several, "shard"), "audited-vectors"), 0
    while not due.isEmpty():
        audit = stored(_audit(due, linked, threshold, seed), "vector-audit")
        recall(audit, seed)
        if audit.where("a is not null").isEmpty():
            break
        seed += 1
        missed = audit.where("a is not null").select("shard").distinct()
        due = stored(due.join(missed, "shard"), "audited-vectors")
        # A component's star stands for all links found before.
        stars = linked.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a <> b")
        links = stars.union(audit.where("a is not null").select("a", "b")).union(found_links(due, threshold, seed))
        linked = stored(connected_components(links, "vector-components"), "vector-components")
    return linked


def recall(audit: DataFrame, seed: int) -> DataFrame:
    """Written table (label, n_links, n_apart, recall) of one audit, in the shared folder; the whole is logged."""
    by_label = audit.groupBy(F.col("shard").alias("label")).agg(F.sum("n_links").alias("n_links"), F.sum("n_apart").alias("n_apart"))
    table = stored(by_label.withColumn("recall", F.when(F.col("n_links") > 0, 1 - F.col("n_apart") / F.col("n_links"))), "vector-recall")
    n, apart = table.agg(F.sum("n_links"), F.sum("n_apart")).first()
    log.warning("round %d: %d of %d audited pairs joined, recall %.6f", seed, (n or 0) - (apart or 0), n or 0, 1 - apart / n if n else 1)
    return table


def verified(members: DataFrame, threshold: float, buckets: int) -> DataFrame:
    """(node, links): for members (component, node, weight, v), the summed weight of others in the component at or above the threshold.
    Components of up to BLOCK members are dealt to ``buckets`` groups."""
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = members.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    # Components of one block share buckets; a larger one has a group for every pair of its blocks.
    small = own.where("blocks = 1").withColumn("bucket", F.pmod(F.xxhash64("component"), F.lit(buckets))).withColumn("i", F.lit(-1)).withColumn("j", F.lit(-1))
    large = own.where("blocks > 1").withColumn("o", other).withColumn("bucket", F.col("component")).withColumn("i", F.least("block", "o")).withColumn("j", F.greatest("block", "o"))
    columns = ["bucket", "i", "j", "component", "block", "node", "weight", "v"]

    def count(key: tuple, table: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        node, weight, x = table.column("node").to_numpy(), table.column("weight").to_numpy(), _matrix(table.column("v"))
        total = np.zeros(len(node), dtype=np.int64)
        part = table.column("component" if i < 0 else "block").to_numpy()
        groups = [(rows, rows) for rows in _runs(part)] if i == j else []
        if i != j:
            a, b = np.flatnonzero(part == i), np.flatnonzero(part == j)
            groups = [(a, b)]
        for a, b in groups:
            near = x[a] @ x[b].T >= threshold
            if a is b:
                np.fill_diagonal(near, False)
                total[a] += near @ weight[b]
            else:
                total[a] += near @ weight[b]
                total[b] += near.T @ weight[a]
        return pa.table({"node": node, "links": total})

    pairs = small.select(columns).union(large.select(columns)).groupBy("bucket", "i", "j").applyInArrow(count, "node long, links long")
    return pairs.groupBy("node").agg(F.sum("links").alias("links"))


def _runs(part: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(part, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(part[order])) + 1)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98) -> DataFrame:
    """One row per row of ``vectors``: id, ``n_links``, ``component_id`` and ``kept`` (id = component_id).

    Vectors link within a label (and length) at a cosine of ``threshold`` or
    more. Those that are null, zero, or hold null or non-finite components, and
    those with a null label, link with nothing. Repeated rows and ids are vectors of
    their own. Other columns are ignored, whatever their names. An empty table
    gives no rows.
    """
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    square = F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    own = vectors.select(F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("v"))
    valid = F.coalesce(finite & (square > 0) & (square < float("inf")) & F.col("label").isNotNull(), F.lit(False))
    own = own.withColumn("k1", F.when(valid, F.xxhash64("label", "v"))).withColumn("k2", F.when(valid, F.hash("v", "label")))
    keyed = stored(own.select("id", "k1", "k2"), "vector-keys")
    shard = F.concat_ws(":", F.col("label"), F.size("v"))
    distinct = own.where("k1 is not null").groupBy("k1", "k2").agg(F.min("id").alias("first"), F.count("*").alias("weight"), F.first("label").alias("label"), F.first("v").alias("v"))
    distinct = stored(distinct.select("k1", "k2", "first", "weight", shard.alias("shard"), "v", F.monotonically_increasing_id().alias("node")), "vectors")
    linked = linked_components(distinct, threshold)
    buckets = linked.count() // BLOCK + 1
    counts = verified(distinct.join(linked, "node").select("component", "node", "weight", "v"), threshold, buckets)
    node = distinct.select("k1", "k2", "first", "weight", "node").join(linked, "node", "left").join(counts, "node", "left")
    node = node.withColumn("component", F.coalesce("component", "node"))
    smallest = node.groupBy("component").agg(F.min("first").alias("component_id"))
    node = node.join(smallest, "component").select("k1", "k2", "component_id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = keyed.join(node, ["k1", "k2"], "left").select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
