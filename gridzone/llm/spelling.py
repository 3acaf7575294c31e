"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling.

Word counts are gathered per task and summed by Spark. Two words of L and L or
L + 1 code points are one edit apart exactly when common prefix plus common
suffix reach the longer length minus one. The edit lies at the end of the
common prefix, so a class of words (short L, long L + 1) is dealt by everything
outside one of a few windows of about ``WINDOW`` code points: words that differ
in window w alone meet under one key, and a pair counts only in the window that
holds its edit, so it counts once. Keys with over ``BLOCK`` words are cut into blocks and dealt
as pairs of blocks, so no task holds an unbounded group.

A task takes its groups as padded code-point matrices, stacked by word length
and group size, and compares every pair of a stack at once, column by column
from both ends. A word leaves the tile as one row: how many are near and the
most frequent of them; pairs are never listed.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridzone.llm.common import stored
from gridzone.operators.joins import sized_broadcast

#: Code points in a window, and windows of a long word at most (its windows are longer instead).
WINDOW, WINDOWS = 3, 8
#: Words of one key compared in one tile; larger keys become pairs of blocks of about this size.
BLOCK = 1024
#: Words counted in a task's memory before they are handed on, and distinct runs remembered.
COUNTED, REMEMBERED = 400_000, 300_000
#: Rows of a task compared together, and cells of a tile.
ROWS_AT_ONCE, TILE_CELLS = 200_000, 2_000_000
ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _counted(batches: Iterator[pa.RecordBatch], letters: str, min_chars: int, typo_rate: int) -> Iterator[pa.RecordBatch]:
    runs = re.compile(f"[{letters}]{{{min_chars},}}").findall  # shorter runs cannot become long enough
    total: Counter = Counter()
    known: dict[str, tuple[str, bytes]] = {}

    def out():
        return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if not text:
                continue
            start = zlib.crc32(f"{doc or ''}:".encode())
            for run, c in Counter(runs(text)).items():
                low = known.get(run)
                if low is None:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    word = run.translate(ASCII_LOWER)
                    low = known[run] = (word, word.encode())
                word, h = low[0], zlib.crc32(low[1], start)
                if typo_rate and h % typo_rate == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
                    if len(word) < min_chars:
                        continue
                total[word] += c
            if len(total) >= COUNTED:
                yield out()
                total.clear()
    if total:
        yield out()


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: str = "A-Za-zÀ-ÿ", min_chars: int = 7, typo_rate: int = 0) -> DataFrame:
    """(word, n): maximal runs of ``letters`` with A-Z lower-cased and their number in all texts, of at least ``min_chars`` code points.

    With a ``typo_rate`` k > 0 a run whose crc32 of ``<id>:<run>`` k divides loses one code point (a known error of the
    input that variants are to be found for). A null id is written as nothing there, a null or empty text has no words.
    Repeated rows count again; other columns are ignored, whatever their names.
    """
    own = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    counts = own.mapInArrow(lambda it: _counted(it, letters, min_chars, typo_rate), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


def _keyed(words: DataFrame) -> DataFrame:
    """(key, short, win, windows, word, n): each word as a short word of its class and as a long one of the class below."""
    w = words.select("word", "n", F.char_length("word").alias("chars"))
    w = w.select("*", F.explode(F.array("chars", F.col("chars") - 1)).alias("short")).where("short >= 0")
    w = w.withColumn("windows", F.greatest(F.lit(1), F.least(F.lit(WINDOWS), F.ceil(F.col("short") / WINDOW))).cast("int"))
    w = w.select("*", F.explode(F.sequence(F.lit(0), F.col("windows") - 1)).alias("win"))
    before = F.expr("substring(word, 1, cast(short * win div windows as int))")
    after = F.expr("substring(word, cast(short * (win + 1) div windows as int) + 1 + chars - short)")
    return w.select(F.xxhash64("short", "win", before, after).alias("key"), "short", "win", "windows", "word", "n")


def _dealt(keyed: DataFrame) -> DataFrame:
    """Adds (bi, bj, own): the pair of blocks that a row is compared in and its own block; one pair (0, 0) for all but large keys."""
    large = keyed.groupBy("key", "short", "win").agg(F.count("*").alias("size")).where(F.col("size") > BLOCK)
    large = stored(large.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).drop("size"), "spelling-large")
    blocks = F.coalesce("blocks", F.lit(1))
    k = keyed.join(sized_broadcast(large)[0], ["key", "short", "win"], "left").withColumn("own", F.pmod(F.hash("word"), blocks))
    pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: F.struct(F.least(b, "own").alias("bi"), F.greatest(b, "own").alias("bj")))
    return k.select("key", "short", "win", "windows", "word", "n", "own", F.inline(pairs))


def _sizes(n: int) -> int:
    """The padded size of a group: n up to 4, else 3 or 4 eighths of a power of two above."""
    step = 1 << max(0, n.bit_length() - 3)
    return -(-n // step) * step


def _near(codes: np.ndarray, right: np.ndarray, long: np.ndarray, own: np.ndarray, until: np.ndarray, across: np.ndarray) -> np.ndarray:
    """(g, g, G) which words of each of G groups are one edit apart.

    ``codes`` and ``right`` (L + 1, g, G) hold the words padded after and before; ``long`` (g, G) is 1 for L + 1 code points, 0 for L,
    -1 for padding; the edit must lie before ``until`` (G); ``across``: only words of different blocks are compared.
    """
    width, g, groups = codes.shape
    small = np.uint8 if width < 120 else np.int32
    prefix, suffix = np.zeros((g, g, groups), small), np.zeros((g, g, groups), small)
    for matrix, length in ((codes, prefix), (right, suffix)):
        same = np.ones((g, g, groups), bool)
        for c in range(width - 1) if matrix is codes else range(width - 1, 0, -1):
            same &= matrix[c][:, None] == matrix[c][None]
            if not same.any():
                break
            length += same
    either = np.maximum(np.maximum(long[:, None], long[None]), 0).astype(small)
    near = (prefix + suffix + small(1) >= either + small(width - 1)) & (prefix < until)
    near &= (long[:, None] >= 0) & (long[None] >= 0) & (long[:, None] + long[None] < 2)
    near &= ~across | (own[:, None] != own[None])
    near[np.arange(g), np.arange(g)] = False
    return near


def _tiles(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """``table`` holds whole groups, sorted by group, then by falling n and rising word."""
    group = np.stack([np.asarray(table.column(c).to_numpy(), dtype=np.int64) for c in ("key", "short", "win", "bi", "bj")])
    n = len(table)
    first = np.flatnonzero(np.concatenate([[True], (group[:, 1:] != group[:, :-1]).any(axis=0)]))
    size = np.diff(np.append(first, n))
    short, win, windows = group[1][first], group[2][first], table.column("windows").to_numpy()[first]
    until = np.where(win + 1 == windows, short + 2, short * (win + 1) // windows)
    across = group[3][first] != group[4][first]
    words, counts, owns = np.array(table.column("word").to_pylist(), dtype=object), table.column("n").to_numpy(), table.column("own").to_numpy()
    padded = np.array([_sizes(int(s)) for s in range(int(size.max()) + 1)])[size]
    for length, g in np.unique(np.stack([short, padded])[:, size > 1], axis=1).T:
        of = np.flatnonzero((short == length) & (padded == g) & (size > 1))
        step = max(1, TILE_CELLS // int(g * max(g, length + 1)))
        for lo in range(0, len(of), step):
            yield from _tile(of[lo : lo + step], int(length), int(g), first, size, until, across, words, counts, owns)


def _tile(of, length, g, first, size, until, across, words, counts, owns) -> Iterator[pa.RecordBatch]:
    width = length + 1
    at = first[of] + np.arange(g)[:, None]  # (g, G)
    there = np.arange(g)[:, None] < size[of]
    at = np.where(there, at, 0)
    own_words = np.where(there, words[at], "")
    flat = own_words.ravel()
    matrix = np.array(flat.tolist(), dtype=f"<U{width}").view(np.uint32).reshape(len(flat), width)
    chars = (matrix > 0).sum(axis=1)
    shift = np.arange(width)[None] - (width - chars)[:, None]
    right = np.where(shift >= 0, np.take_along_axis(matrix, np.maximum(shift, 0), axis=1), 0)
    small = np.uint8 if matrix.max(initial=0) < 256 else np.uint32
    stack = lambda m: np.ascontiguousarray(m.T.astype(small)).reshape(width, *at.shape)
    long = np.where(there, chars.reshape(at.shape) - length, -1).astype(np.int8)
    near = _near(stack(matrix), stack(right), long, owns[at], until[of], across[of])
    found = near.sum(axis=1)
    best = np.take_along_axis(at, near.argmax(axis=1), axis=0)  # rows are in order of n and word
    rows, near_rows = at[found > 0], best[found > 0]
    if len(rows):
        columns = [pa.array(words[rows], pa.string()), pa.array(found[found > 0], pa.int64()), pa.array(counts[near_rows], pa.int64()), pa.array(words[near_rows], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "near_n", "near"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < ROWS_AT_ONCE:
            continue
        table = pa.Table.from_batches(held)
        keys = [table.column(c).to_numpy() for c in ("key", "short", "win", "bi", "bj")]
        last = np.ones(rows, bool)
        for k in keys:
            last &= k == k[-1]
        cut = rows - int(np.argmin(last[::-1])) if not last.all() else 0  # the last group may go on in the next batch
        if cut:
            yield from _tiles(table.slice(0, cut))
        held = table.slice(cut).to_batches()
        rows -= cut
    if rows:
        yield from _tiles(pa.Table.from_batches(held))


def near_words(words: DataFrame) -> DataFrame:
    """``words`` (word, n), each word once -> (word, n_near, near_n, near): how many words are exactly one inserted, deleted or
    replaced code point away, and the most frequent of them (ties: the smallest). Words without any are not returned."""
    dealt = _dealt(_keyed(words))
    group = ["key", "short", "win", "bi", "bj"]
    runs = dealt.repartition(*group).sortWithinPartitions(*group, F.desc("n"), "word")
    found = runs.mapInArrow(_compared, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", (-F.col("best.minus")).alias("near_n"), F.col("best.near").alias("near"))


def follow(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form), without cycles -> (word, root): the last word that forms lead to. Every round doubles the steps taken."""
    state = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")), "spelling-forms")
    while state.where("open").limit(1).count():
        onward = state.select(F.col("word").alias("via"), F.col("root").alias("beyond"))
        step = state.join(onward, state["root"] == onward["via"], "left")
        state = stored(step.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("open")), "spelling-forms")
    return state.select("word", "root")


def group_variants(words: DataFrame, min_count: int = 2, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``words`` (word, n) seen at least ``min_count`` times.

    ``form`` is the near word of largest n (ties: the smallest in code-point order) if that n is at least ``ratio`` times
    the word's own, else null; ``root`` is where forms lead to, the word itself if it has none. ``ratio`` must be above 1, so
    that n grows along forms and no cycle arises. An empty table gives no rows.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1")
    w = stored(words.where(F.col("word").isNotNull() & (F.col("n") >= min_count)).select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    is_form = F.col("near_n") >= ratio * F.col("n")
    all_words = w.join(near_words(w), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n"))
    all_words = stored(all_words, "spelling-near")
    roots = follow(all_words.where("form IS NOT NULL"))
    return all_words.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
