"""Packing of token ids into windows by Karmarkar-Karp multiway differencing.

Documents are encoded and cut into pieces: whole windows, then the rest in
pieces of at most ``max_piece``. Each task packs groups of about
``group_windows`` windows: every piece starts as a partition with one loaded
window; the two partitions with the largest imbalance are merged with their
windows opposed (heaviest on lightest) until one is left. Windows come out near
equal, so with ceil(tokens / window) of them all are nearly full; where one
exceeds the capacity the group is packed again into more windows.

Nothing is shuffled: text is read once, ids leave the task already placed. A
group holds a bounded number of tokens, whatever the table. Window numbers are
(task, running number), the same when a task is run again over the same split;
give it a table that is read from files, as the query and the pipeline do.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridzone.llm.tokens import encoder

SCHEMA = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
#: Documents numbered together, by characters of text, and how many of these are encoded at a time.
CHARS_AT_ONCE, ENCODED_AT_ONCE = 6_000_000, 1_500_000


def difference(weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Karmarkar-Karp: (window of each weight, load of each of the k windows)."""
    heap = [(-int(w), i) for i, w in enumerate(weights)]
    loads: list[np.ndarray | None] = []
    for w in weights:
        one = np.zeros(k, dtype=np.int64)
        one[0] = w
        loads.append(one)  # each partition's loads, heaviest first
    merged: list[tuple[int, int, np.ndarray]] = []
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        both = loads[a] + loads[b][::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        loads[a] = loads[b] = None
        loads.append(both)
        merged.append((a, b, order))
        heapq.heappush(heap, (int(both[-1] - both[0]), len(loads) - 1))
    n = len(weights)
    place: list = [None] * len(loads)
    place[-1] = np.arange(k)
    for node in range(len(loads) - 1, n - 1, -1):
        a, b, order = merged[node - n]
        windows = np.empty(k, dtype=np.int64)
        windows[order] = place[node]
        place[a], place[b], place[node] = windows, windows[::-1], None
    return np.array([place[i][0] for i in range(n)]), loads[-1]


def balance(weights: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """(window of each weight, number of windows), no window above ``capacity``; each weight must fit in one."""
    k = max(1, -(-int(weights.sum()) // capacity))
    while True:
        window, loads = difference(weights, k)
        over = np.maximum(loads - capacity, 0).sum()
        if not over:
            return window, k
        k += max(1, int(over) // capacity)


def _cuts(sizes: np.ndarray, chars: int) -> list[int]:
    """Bounds of runs of about ``chars`` characters in texts of these ``sizes``."""
    upto = np.cumsum(sizes)
    return sorted({0, *np.flatnonzero(np.diff(upto // chars, prepend=0, append=0)).tolist(), len(sizes)}) if len(sizes) else [0]


def _packed(batches: Iterator[pa.RecordBatch], path: str, end_id: int, window: int, max_piece: int, group_windows: int) -> Iterator[pa.RecordBatch]:
    encode, end = encoder(path).encode, np.array([end_id], dtype="<u4").tobytes()
    number = TaskContext.get().partitionId() << 32

    def rows(pieces, sequence, offset):
        doc, start, ids, total = zip(*pieces, strict=True)
        columns = [pa.array(doc, id_type), pa.array(start, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
        columns += [pa.array(x, pa.int64()) for x in (total, sequence, offset)]
        return pa.RecordBatch.from_arrays(columns, names=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    def place(pieces):
        nonlocal number
        lengths = np.array([len(p[2]) // 4 for p in pieces])
        at, k = balance(lengths, window)
        used = np.unique(at, return_inverse=True)[1]  # an empty window gets no number
        order = np.argsort(used, kind="stable")
        before = np.cumsum(lengths[order]) - lengths[order]
        first = np.concatenate([[True], np.diff(used[order]) > 0])
        offset = before - before[first][np.cumsum(first) - 1]
        out = rows([pieces[i] for i in order], (number + used[order]).tolist(), offset.tolist())
        number += int(used.max()) + 1
        return out

    held, held_tokens = [], 0
    for batch in batches:
        id_type = batch.schema.field("id").type
        ids, texts = batch.column("id").to_pylist(), batch.column("text")
        sizes = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
        for lo, hi in pairwise(_cuts(sizes, CHARS_AT_ONCE)):
            whole = []
            coded = (x for a, b in pairwise(_cuts(sizes[lo:hi], ENCODED_AT_ONCE)) for x in encode([x or "" for x in texts.slice(lo + a, b - a).to_pylist()]))
            for doc, data in zip(ids[lo:hi], coded, strict=True):
                data += end
                n = len(data) // 4
                full = n - n % window
                for s in range(0, full, window):
                    whole.append((doc, s, data[4 * s : 4 * (s + window)], n))
                for s in range(full, n, max_piece):
                    piece = data[4 * s : 4 * min(n, s + max_piece)]
                    held.append((doc, s, piece, n))
                    held_tokens += len(piece) // 4
                if held_tokens >= group_windows * window:
                    yield place(held)
                    held, held_tokens = [], 0
            if whole:
                yield rows(whole, list(range(number, number + len(whole))), [0] * len(whole))
                number += len(whole)
    if held:
        yield place(held)


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, window: int = 2048, max_piece: int = 512, group_windows: int = 128) -> DataFrame:
    """One row per piece: id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    ``vocabulary`` is the path of a byte-level BPE file for ``tokenizers``. Null
    and empty texts have the end id alone. Rows that repeat an id or a whole row
    are documents of their own; a null id stays null. Other columns of ``docs``
    are ignored, whatever their names. An empty table gives no rows.
    """
    if not 0 < max_piece <= window:
        raise ValueError("max_piece must be between 1 and window")
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = own.schema["id"].dataType.simpleString()
    return own.mapInArrow(lambda it: _packed(it, vocabulary, end_id, window, max_piece, group_windows), f"id {kind}, {SCHEMA}").withColumnRenamed("id", id_col)
