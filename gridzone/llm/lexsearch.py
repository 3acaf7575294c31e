"""Ranked lexical search over bit-sliced Bloom signatures.

Index: every document's terms are entered into a Bloom filter, once for each
level of its term frequency (``LEVELS``: an entry (term, level) says "at least so
often"). Filters of documents of like size form blocks, stored by bit: one
bitmap over the block's documents for each filter bit (a slice). Lengths are
stored exactly.

Search: the documents that may hold a term are the AND of its slices, which can
only overestimate. Each level passed raises the term's share of the score to what the
next level's frequency would give, so the weighted sums over a block's bitmaps
are upper bounds of the scores. The documents with the highest bounds are scored
exactly; the k-th best of those is a threshold that the true k-th best reaches.
Every document whose bound reaches it is scored exactly from its
whole text, ties included, so the result is that of scoring all.

Queries are taken in blocks of bounded size; a block's terms and weights travel
with the tasks. Bitmaps, bounds and scores stay in the tasks, the driver sees the terms, document
frequencies and thresholds of one block of queries.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridzone.llm.common import stored
from gridzone.operators.joins import sized_broadcast

#: Least frequencies that have an entry of their own.
LEVELS = (1, 2, 3, 4, 6, 9, 13, 19, 28)
#: Filter bits per entry at least (up to twice as many), hashes per entry, smallest and largest filter (beyond, filters get denser and bounds looser).
BITS_PER_ENTRY, HASHES, LEAST_BITS, MOST_BITS = 8, 4, 512, 1 << 20
#: Documents and cells (bits x documents) of a block at most.
ROWS, CELLS = 4096, 1 << 24
#: Distinct terms of a block of queries (a longer single query is a block of its own), and terms x documents of one sum.
QUERY_TERMS, SUM_CELLS = 8192, 1 << 23
#: Terms of all queries up to which document frequencies are counted for them alone, in the task; beyond, for every term.
VOCABULARY = 1_000_000
REMEMBERED = 300_000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)

#: Bytes that end a term become spaces, A-Z become a-z; bytes of characters beyond ASCII stay.
_TABLE = bytes(c if c >= 128 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """The maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased, as UTF-8."""
    return text.translate(_TABLE).split()


class _Hashes(dict):
    def __missing__(self, term: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) >= REMEMBERED:
            self.clear()
        self[term] = h = xxh3_64_intdigest(term)
        return h


def _positions(hashes: np.ndarray, level, bits: int) -> np.ndarray:
    """(n, HASHES) filter bits of entries (hash, level)."""
    h = (hashes + np.asarray(level, dtype=np.uint64) * GOLDEN) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(29)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return ((h[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) & np.uint64(bits - 1)).astype(np.int64)


def _indexed(batches: Iterator[pa.RecordBatch], vocabulary: set[bytes] | None) -> Iterator[pa.RecordBatch]:
    known, df, held = _Hashes(), Counter(), {}
    least = np.array(LEVELS)
    docs_with_terms = n_terms = 0
    id_type = None

    def block(bits):
        ids, keys, lengths, entries = zip(*held.pop(bits), strict=True)
        cells = np.zeros((bits, len(ids)), dtype=bool)
        for row, (hashes, level) in enumerate(entries):
            cells[_positions(hashes, level, bits).ravel(), row] = True
        slices = np.packbits(cells, axis=1).tobytes()
        return out(bits=[bits], ids=[list(ids)], keys=[list(keys)], lengths=[list(lengths)], slices=[slices])

    def out(**columns):
        n = len(next(iter(columns.values())))
        kinds = {"bits": pa.int32(), "ids": pa.list_(id_type), "keys": pa.list_(pa.int64()), "lengths": pa.list_(pa.int64()), "slices": pa.binary(), "term": pa.binary(), "df": pa.int64(), "docs": pa.int64(), "terms": pa.int64()}
        return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in kinds.items()], names=list(kinds))

    def frequencies():
        return out(term=list(df), df=list(df.values()))

    for batch in batches:
        id_type = batch.schema.field("id").type
        for doc, key, text in zip(batch.column("id").to_pylist(), batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
            counts = Counter(terms(text)) if text else None
            if not counts:
                continue
            hashes = np.fromiter(map(known.__getitem__, counts), dtype=np.uint64, count=len(counts))
            tf = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
            length = int(tf.sum())
            docs_with_terms, n_terms = docs_with_terms + 1, n_terms + length
            df.update(counts.keys() if vocabulary is None else vocabulary & counts.keys())
            reached = np.searchsorted(least, tf, side="right")
            level = np.arange(int(reached.sum())) - np.repeat(np.cumsum(reached) - reached, reached)
            bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_PER_ENTRY * len(level) - 1).bit_length()))
            rows = held.setdefault(bits, [])
            rows.append((doc, key, length, (np.repeat(hashes, reached), level.astype(np.uint8))))
            if len(rows) == min(ROWS, max(8, CELLS // bits)):
                yield block(bits)
            if len(df) > VOCABULARY:
                yield frequencies()
                df.clear()
    for bits in list(held):
        yield block(bits)
    if df:
        yield frequencies()
    if docs_with_terms:
        yield out(docs=[docs_with_terms], terms=[n_terms])


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, text): rows are told apart by id and a hash of the text; rows equal in both score the same."""
    text = F.col(text_col)
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), text.cast("binary").alias("text"))


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = {t for text in batch.column("text").to_pylist() if text for t in terms(text)}
        yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.binary())], names=["term"])


def build_index(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", query_text_col: str = "text") -> DataFrame:
    """The stored index of ``docs``: blocks (bits, ids, keys, lengths, slices), document frequencies (term, df; of the terms of
    ``queries`` alone while these are few) and totals (docs, terms), each in rows of their own."""
    words = queries.select(F.col(query_text_col).cast("binary").alias("text")).mapInArrow(_query_terms, "term binary").distinct()
    few = [bytes(r[0]) for r in words.limit(VOCABULARY + 1).collect()]
    vocabulary = set(few) if len(few) <= VOCABULARY else None
    own = _slim(docs, id_col, text_col)
    kind = own.schema["id"].dataType.simpleString()
    schema = f"bits int, ids array<{kind}>, keys array<long>, lengths array<long>, slices binary, term binary, df long, docs long, terms long"
    return stored(own.mapInArrow(lambda it: _indexed(it, vocabulary), schema), "search-index")


@dataclass
class _Block:
    """Queries of one block: their ids, (term numbers, weights x repeats) and the terms' text, hashes and weights."""

    ids: list = field(default_factory=list)
    slots: list = field(default_factory=list)
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    hashes: np.ndarray | None = None
    weights: np.ndarray | None = None
    docs: int = 0
    terms: int = 0

    def weigh(self, df: dict[bytes, int], docs: int, n_terms: int) -> None:
        from xxhash import xxh3_64_intdigest

        self.docs, self.terms = docs, n_terms
        self.hashes = np.array([xxh3_64_intdigest(t) for t in self.vocabulary], dtype=np.uint64)
        self.weights = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * df.get(t, 0) + 1))) for t in self.vocabulary], dtype=np.int64)
        self.slots = [(i := np.array(list(c), dtype=np.int64), np.array(list(c.values()), dtype=np.int64) * self.weights[i]) for c in self.slots]

    def norm(self, length):
        return 75 + (25 * length * self.docs) // self.terms


def _share(tf, norm):
    return (1_000_000_000 * tf) // (1000 * tf + 12 * norm)


def _query_blocks(queries: DataFrame) -> Iterator[_Block]:
    block = _Block()
    for query, text in queries.toLocalIterator():
        counts = Counter(terms(bytes(text or b"")))
        if block.ids and len(block.vocabulary.keys() | counts.keys()) > QUERY_TERMS:
            yield block
            block = _Block()
        block.ids.append(query)
        block.slots.append({block.vocabulary.setdefault(t, len(block.vocabulary)): c for t, c in counts.items()})
    if block.ids:
        yield block


def _bounds(bits: int, lengths: np.ndarray, slices: np.ndarray, block: _Block, cache: dict) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, bounds (queries, rows)) of a block of documents, by ranges of rows."""
    if bits not in cache:
        cache[bits] = [_positions(block.hashes, lvl, bits) for lvl in range(len(LEVELS))]
    norm = block.norm(lengths)
    step = max(8, SUM_CELLS // max(1, len(block.hashes)) // 8 * 8)
    for lo in range(0, len(lengths), step):
        own = norm[lo : lo + step]
        part = slices[:, lo // 8 : (lo + len(own) + 7) // 8]
        shares = np.zeros((len(block.hashes), len(own)), dtype=np.float32)  # whole numbers below 2^24
        present, below = None, 0
        for lvl, at in enumerate(cache[bits]):
            here = np.bitwise_and.reduce([part[at[:, j]] for j in range(HASHES)])
            present = here if present is None else present & here
            if not present.any():
                break
            above = LEVELS[lvl + 1] - 1 if lvl + 1 < len(LEVELS) else int(lengths.max())
            share = _share(np.minimum(above, lengths[lo : lo + step]), own)
            shares += np.unpackbits(present, axis=1, count=len(own)) * (share - below).astype(np.float32)
            below = share
        sums = np.zeros((len(block.slots), len(own)))
        for q, (at, weights) in enumerate(block.slots):
            if len(at):
                sums[q] = weights.astype(np.float64) @ shares[at]
        yield lo, sums * (1 + 1e-12)


def _blocks_of(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for row in range(batch.num_rows):
            bits, lengths = batch.column("bits")[row].as_py(), batch.column("lengths")[row].values.to_numpy(zero_copy_only=False)
            slices = np.frombuffer(batch.column("slices")[row].as_buffer(), dtype=np.uint8).reshape(bits, -1)
            yield bits, lengths, slices, batch.column("ids")[row].values, batch.column("keys")[row].values


def _highest(batches: Iterator[pa.RecordBatch], block: _Block, k: int) -> Iterator[pa.RecordBatch]:
    """The k documents of highest bound of each query in a task."""
    best: list[list] = [[] for _ in block.ids]
    id_type, cache, count = None, {}, 0
    for bits, lengths, slices, ids, keys in _blocks_of(batches):
        id_type = ids.type
        for lo, sums in _bounds(bits, lengths, slices, block, cache):
            width = min(k, sums.shape[1])
            top = np.argpartition(-sums, width - 1, axis=1)[:, :width]
            for q, own in enumerate(top):
                heap = best[q]
                for row, bound in zip(own.tolist(), sums[q, own].tolist(), strict=True):
                    if bound > 0 and (len(heap) < k or bound > heap[0][0]):
                        count += 1
                        (heapq.heappush if len(heap) < k else heapq.heapreplace)(heap, (bound, count, ids[lo + row].as_py(), keys[lo + row].as_py()))
    rows = [(q, bound, doc, key) for q, heap in enumerate(best) for bound, _, doc, key in heap]
    if rows:
        q, bound, doc, key = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(doc, id_type), pa.array(key, pa.int64()), pa.array(bound, pa.float64())], names=["query", "id", "key", "bound"])


def _reaching(batches: Iterator[pa.RecordBatch], block: _Block, least: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Every (query, document) whose bound reaches the query's threshold."""
    cache: dict = {}
    for bits, lengths, slices, ids, keys in _blocks_of(batches):
        for lo, sums in _bounds(bits, lengths, slices, block, cache):
            q, row = np.nonzero(sums >= least[:, None])
            if len(q):
                rows = pa.array(lo + row)
                yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), ids.take(rows), keys.take(rows)], names=["query", "id", "key"])


def _scored(batches: Iterator[pa.RecordBatch], block: _Block) -> Iterator[pa.RecordBatch]:
    number = block.vocabulary
    share = np.zeros(len(number), dtype=np.int64)
    for batch in batches:
        ids = batch.column("id")
        rows, queries, scores = [], [], []
        for row, (text, own) in enumerate(zip(batch.column("text").to_pylist(), batch.column("queries").to_pylist(), strict=True)):
            counts = Counter(terms(text or b""))
            norm = block.norm(counts.total())
            here = [t for t in counts if t in number]
            at = [number[t] for t in here]
            share[at] = _share(np.array([counts[t] for t in here], dtype=np.int64), norm)
            for q in own:
                slots, weights = block.slots[q]
                score = int((weights * share[slots]).sum())
                if score > 0:
                    rows.append(row)
                    queries.append(q)
                    scores.append(score)
            share[at] = 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(queries, pa.int32()), ids.take(pa.array(rows)), pa.array(scores, pa.int64())], names=["query", "id", "score"])


def _best(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("id"))
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: DataFrame, docs: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", query_col: str = "item_id", query_text_col: str = "text") -> DataFrame:
    """(query id, rank, document id, score): the ``k`` best documents of each row of ``queries``, scores above 0 only.

    ``index`` is ``build_index(docs, queries)``. Null and empty texts have no terms: such documents are never found, such queries
    find nothing. Rows that repeat are documents and queries of their own; ids may be null (null sorts first among equal
    scores). Other columns are ignored, whatever their names; an empty table gives no rows. The ranks among rows equal in score
    and id are dealt arbitrarily. Whole texts are scored.
    """
    spark = docs.sparkSession
    own = _slim(docs, id_col, text_col)
    asked = queries.select(F.col(query_col).alias("query"), F.col(query_text_col).cast("binary").alias("text"))
    doc_kind, query_kind = (df.schema[c].dataType.simpleString() for df, c in ((own, "id"), (asked, "query")))
    found = spark.createDataFrame([], f"{query_col} {query_kind}, rank int, {id_col} {doc_kind}, score long")
    n_docs, n_terms = index.where("docs IS NOT NULL").agg(F.sum("docs"), F.sum("terms")).first()
    if not n_docs:
        return found
    blocks = index.where("slices IS NOT NULL").select("bits", "ids", "keys", "lengths", "slices")
    for block in _query_blocks(asked):
        mine = F.broadcast(spark.createDataFrame([(bytearray(t),) for t in block.vocabulary] or [(None,)], "term binary"))
        df = index.where("term IS NOT NULL").select("term", "df").join(mine, "term").groupBy("term").agg(F.sum("df").alias("df"))
        block.weigh({bytes(r["term"]): r["df"] for r in df.collect()}, n_docs, n_terms)

        def exact(candidates, block=block):
            per_doc = stored(candidates.groupBy("id", "key").agg(F.collect_set("query").alias("queries")), "search-candidates")
            c = sized_broadcast(per_doc.select(F.col("id").alias("cid"), F.col("key").alias("ckey"), "queries"))[0]
            texts = own.join(c, own["id"].eqNullSafe(c["cid"]) & (own["key"] == c["ckey"])).select("id", "text", "queries")
            return texts.mapInArrow(lambda it: _scored(it, block), f"query int, id {doc_kind}, score long")

        first = blocks.mapInArrow(lambda it, b=block: _highest(it, b, 2 * k), f"query int, id {doc_kind}, key long, bound double")
        first = first.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("bound")))).where(F.col("place") <= 2 * k)
        least = np.ones(len(block.ids))
        for r in _best(exact(first), k).where(F.col("rank") == k).collect():
            least[r["query"]] = r["score"]
        candidates = blocks.mapInArrow(lambda it, b=block, t=least: _reaching(it, b, t), f"query int, id {doc_kind}, key long")
        names = F.broadcast(spark.createDataFrame(list(enumerate(block.ids)), f"query int, name {query_kind}"))
        top = _best(exact(candidates), k).join(names, "query").select(F.col("name").alias(query_col), "rank", F.col("id").alias(id_col), "score")
        found = found.unionByName(stored(top, "search-found"))
    return found
