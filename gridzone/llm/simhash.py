"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most ``max_bits`` apart have a common variant within
``max_bits / 2`` flips of either. Every distinct fingerprint therefore emits
all variants within half the radius and equal variants meet.

What is shuffled is the variant's leading ``t`` bits with the fingerprint and
the flips still allowed: one row for every way to flip at most half the radius
within the prefix (37 rows at t = 8) instead of all 2 081 variants of 64 bits.
The remaining flips are made where the prefix arrives, in numpy, so each
variant exists exactly once, in one task. ``t`` grows with the number of
distinct fingerprints so that a prefix never holds much more than
``VARIANTS_PER_PREFIX`` variants on average. A prefix with over 1/1024 of all
rows and several times the mean (at most 1024 of these exist, which bounds what
the driver reads) is dealt out once more by further bits, and inside a task a prefix is bisected until a
part's variants fit the same bound, so memory is bounded whatever the skew.

All fingerprints of one variant are within ``max_bits`` of each other, so the
group is linked as a star to its smallest one; no group is expanded to pairs.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from gridzone.llm.common import connected_components, stored

#: Variants that one prefix should hold on average, and the most that one numpy pass expands.
VARIANTS_PER_PREFIX = 2_000_000
#: A prefix with more than HOT_TIMES its mean share of the rows, and 1/1024 of them, is dealt out again by HOT_BITS further bits.
HOT_TIMES, HOT_BITS, HOT_ROWS = 8, 8, 20_000


def fingerprint_of(text: str | None, shingle_words: int) -> int:
    """Unsigned 64-bit fingerprint of one text; 0 without words (and for null)."""
    words = text.encode().lower().split() if text else []  # bytes: lower() is A-Z only, split() the six ASCII spaces
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle_words:
        hashes = [digest(b" ".join(words), 42)]
    else:
        hashes = [digest(s, 42) for s in map(b" ".join, zip(*(words[i:] for i in range(shingle_words)), strict=False))]
    bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8)).reshape(-1, 64)
    return int.from_bytes(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)).tobytes(), "big")


def fingerprint(text: str | Column, shingle_words: int = 4) -> Column:
    """The fingerprint as a (signed) long."""

    @F.pandas_udf(LongType())
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t, shingle_words) for t in texts], dtype=np.uint64).view(np.int64))

    return fp(text)


def _masks(bits: list[int], most: int) -> list[tuple[int, int]]:
    """(flips, mask) of every way to flip at most ``most`` of the bits."""
    return [(k, sum(1 << b for b in c)) for k in range(most + 1) for c in combinations(bits, k)]


def _deal(rows: DataFrame, key: str, value: Column, left: Column, bits: int, radius: int) -> DataFrame:
    """One row per way to flip up to ``left`` of the ``bits`` bits of ``value``: key, and flips still left."""
    ways = F.array(*(F.struct(F.lit(k).cast("byte").alias("k"), F.lit(m).cast("long").alias("m")) for k, m in _masks(list(range(bits)), radius)))
    return (
        rows.withColumn("w", F.explode(ways))
        .where(F.col("w.k") <= left)
        .withColumn(key, value.bitwiseXOR(F.col("w.m")))
        .withColumn("left", (left - F.col("w.k")).cast("byte"))
        .drop("w")
    )


def _expand(variant: np.ndarray, left: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """All variants that flip up to ``left`` of the lowest ``bits`` bits, with the rows they come from."""
    keys, rows, at = [], [], np.arange(len(variant))
    for k in range(int(left.max(initial=0)) + 1):
        masks = np.array([m for n, m in _masks(list(range(bits)), k) if n == k], dtype=np.uint64)
        own = left >= k
        keys.append((variant[own][:, None] ^ masks[None, :]).ravel())
        rows.append(np.repeat(at[own], len(masks)))
    return np.concatenate(keys), np.concatenate(rows)


def _meet(variant: np.ndarray, left: np.ndarray, fps: np.ndarray, bits: int) -> list[np.ndarray]:
    """Star links (2, n) between fingerprints with a common variant; bisects until a part fits in memory."""
    if len(variant) < 2:
        return []
    ways = np.array([math.comb(bits, k) for k in range(int(left.max()) + 1)]).cumsum()
    if bits and ways[left].sum() > VARIANTS_PER_PREFIX:
        bit = np.uint64(1 << (bits - 1))
        found = []
        for side in (np.uint64(0), bit):
            same = (variant & bit) == side
            moved = ~same & (left > 0)
            found += _meet(
                np.concatenate([variant[same], variant[moved] ^ bit]), np.concatenate([left[same], left[moved] - 1]), np.concatenate([fps[same], fps[moved]]), bits - 1
            )
        return found
    keys, rows = _expand(variant, left, bits)
    order = np.sort(keys)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return []
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    hit = twice[at] == keys
    group, member = at[hit], fps[rows[hit]]
    order = np.lexsort((member, group))
    group, member = group[order], member[order]
    first = np.concatenate([[True], group[1:] != group[:-1]])
    centre = member[np.flatnonzero(first)[np.cumsum(first) - 1]]
    apart = centre != member
    if not apart.any():
        return []
    pairs = np.stack([centre[apart], member[apart]])
    order = np.lexsort(pairs)
    pairs = pairs[:, order]
    return [pairs[:, np.concatenate([[True], (pairs[:, 1:] != pairs[:, :-1]).any(axis=0)])]]


def _forest(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component within these pairs), for nodes that aren't the smallest."""
    nodes, ends = np.unique(pairs, return_inverse=True)
    a, b = ends.reshape(pairs.shape)
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def near_links(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """Distinct fingerprints (fp long) -> links (a, b) whose components are those of "at most max_bits apart".

    ``max_bits`` must be even (half of it is flipped from either side). Every
    link joins a fingerprint to the smallest of its component within a prefix,
    reached over pairs whose distance was verified.
    """
    if max_bits % 2 or not 0 <= max_bits <= 6:
        raise ValueError("max_bits must be 0, 2, 4 or 6")
    radius = max_bits // 2
    n = fps.count()
    ball = sum(math.comb(64, k) for k in range(radius + 1))
    t = min(24, max(8, math.ceil(math.log2(max(1, n * ball / VARIANTS_PER_PREFIX)))))
    top = F.shiftrightunsigned("fp", 64 - t)
    rows = _deal(fps.select("fp"), "prefix", top, F.lit(radius), t, radius)
    share = n * sum(math.comb(t, k) for k in range(radius + 1)) * max(HOT_TIMES / 2**t, 1 / 1024)
    hot = [r.prefix for r in rows.groupBy("prefix").count().where(F.col("count") > max(share, HOT_ROWS)).select("prefix").collect()]
    if hot:
        is_hot = F.col("prefix").isin(hot)
        more = F.shiftrightunsigned("fp", 64 - t - HOT_BITS).bitwiseAND(F.lit((1 << HOT_BITS) - 1))
        cold = rows.where(~is_hot).withColumn("more", F.lit(-1).cast("long"))
        rows = cold.unionByName(_deal(rows.where(is_hot), "more", more, F.col("left").cast("int"), HOT_BITS, radius))
    else:
        rows = rows.withColumn("more", F.lit(-1).cast("long"))

    def link(key: tuple, table: pa.Table) -> pa.Table:
        prefix, more = key[0].as_py(), key[1].as_py()
        own = table.column("fp").to_numpy().view(np.uint64)
        left = table.column("left").to_numpy().astype(np.int64)
        bits, lead = 64 - t, prefix
        if more >= 0:
            bits, lead = bits - HOT_BITS, prefix << HOT_BITS | more
        variant = (own & np.uint64((1 << bits) - 1)) | np.uint64(lead << bits)
        found = _meet(variant, left, own, bits)
        a = b = np.empty(0, np.uint64)
        if found:
            pairs = np.concatenate(found, axis=1)
            pairs = pairs[:, np.bitwise_count(pairs[0] ^ pairs[1]) <= max_bits]
            a, b = _forest(pairs)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return rows.groupBy("prefix", "more").applyInArrow(link, "a long, b long")


def _components(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(rows (id, text_hash, fp), distinct fingerprints (fp, first, component)); a component is named by its smallest fingerprint."""
    named = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"), fingerprint(F.col(text_col), shingle_words).alias("fp"))
    rows = stored(named, "fingerprints")
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "text_hash"))).alias("first")
    distinct = stored(rows.groupBy("fp").agg(first, F.min("text_hash").alias("any_hash")), "distinct-fingerprints")
    linked = connected_components(near_links(distinct, max_bits), "simhash")
    node = distinct.join(linked, distinct.fp == linked.node, "left").select("fp", "first", "any_hash", F.coalesce("component", "fp").alias("component"))
    return rows, node


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """One row per document: its id, ``fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_bits`` differing bits. Null, empty and blank texts have fingerprint
    zero and link like any other. Repeated rows stay (one result row each); a
    null id is never the smallest of a group that has another. Other columns of
    ``docs`` are ignored, whatever their names. An empty table gives no rows.
    """
    rows, node = _components(docs, id_col, text_col, shingle_words, max_bits)
    smallest = node.groupBy("component").agg(F.min("first.id").alias("component_id"))
    component = node.join(smallest, "component").select("fp", "component_id")
    return rows.join(component, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id (of repeated rows one, of rows with one id and
    different texts the smaller text hash). Groups and null ids as in ``near_duplicates``; all columns stay."""
    _, node = _components(docs, id_col, text_col, shingle_words, max_bits)
    best = node.groupBy("component").agg(F.min("first").alias("first"), F.min("any_hash").alias("any_hash"))
    best = best.select(F.col("first.id").alias("id"), F.coalesce("first.text_hash", "any_hash").alias("hash"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.xxhash64(F.col(text_col)).alias("own"))
    mine = F.col("row")[id_col]
    chosen = rows.join(best, mine.eqNullSafe(best["id"]) & (F.col("own") == best["hash"]), "left_semi")
    nth = F.row_number().over(Window.partitionBy(mine, "own").orderBy(F.lit(0)))
    return chosen.withColumn("nth", nth).where("nth = 1").select(*(F.col("row")[c].alias(c) for c in docs.columns))
