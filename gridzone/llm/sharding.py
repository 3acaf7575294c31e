"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

The rows of a uniformly random permutation that go from one part of the input
to one part of the output follow a multivariate hypergeometric law. So the matrix
of these counts is drawn first: its rows sum to the input cells, its columns to
the output buckets, and shards of exact sizes are runs of buckets. Each task permutes its
cell and deals it out by the counts, rows are exchanged by bucket, and every
bucket is permuted again. Matrix, local permutations and bucket permutations together are
a uniform permutation of the table, and as every bucket's size is known
beforehand, slots have no gaps and need no count afterwards.

The matrix is never held whole: it is split in halves over the input cells, each half's share of
the buckets being one draw seeded by the range of cells, so a task draws the one
row of its cell along a path of log2(cells) nodes.

Cells are ranges of rows of a file (file and row number, not the split that a task happens to
read), so a task run again, or an executor lost between the count and
the deal, changes nothing.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridzone.llm.common import stored

#: Rows of an input cell at least, and cells at most (cells grow beyond; their row counts travel with the tasks).
CELL_ROWS, CELLS = 1 << 16, 1 << 20
#: Rows and bytes on file of an output bucket at most, on average.
BUCKET_ROWS, BUCKET_BYTES = 1 << 20, 64 << 20
#: numpy draws below this many rows; beyond, ``_hypergeometric`` does.
NUMPY_ROWS = 10**9
#: Standard deviations either side of the mean that the sampler for large numbers tabulates.
SPREAD = 14


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """One draw, for any 64-bit numbers: inverse transform over the probabilities about the mode, by their ratios."""
    if good + bad < NUMPY_ROWS:
        return int(rng.hypergeometric(good, bad, sample))
    low, high = max(0, sample - bad), min(good, sample)
    total = good + bad
    mode = min(high, max(low, (sample + 1) * (good + 1) // (total + 2)))
    deviation = (sample / total * good * (bad / total) * ((total - sample) / max(1, total - 1))) ** 0.5
    reach = int(SPREAD * deviation) + 50
    first, last = max(low, mode - reach), min(high, mode + reach)
    x = np.arange(first, last, dtype=np.float64)  # probability of x + 1 over that of x
    steps = np.log(good - x) + np.log(sample - x) - np.log(x + 1) - np.log((bad - sample) + x + 1)
    log = np.concatenate([[0.0], np.cumsum(steps)])
    weight = np.exp(log - log.max())
    reached = np.cumsum(weight)
    return first + int(np.searchsorted(reached, rng.random() * reached[-1], side="right"))


def _share(rng: np.random.Generator, capacities: np.ndarray, sample: int) -> np.ndarray:
    """How many of ``sample`` rows drawn without replacement fall into each of the ``capacities``."""
    rest = int(capacities.sum())
    if rest < NUMPY_ROWS:
        return rng.multivariate_hypergeometric(capacities, sample, method="marginals")
    out = np.zeros_like(capacities)
    for i, c in enumerate(capacities.tolist()):
        out[i] = _hypergeometric(rng, c, rest - c, sample) if sample else 0
        rest -= c
        sample -= int(out[i])
    return out


def matrix_row(cell: int, before: np.ndarray, capacities: np.ndarray, seed: int) -> np.ndarray:
    """Row ``cell`` of the communication matrix: rows of the cell dealt to each bucket.

    ``before`` (cells + 1) counts the rows before each cell, ``capacities`` the rows of each bucket, with equal totals. Rows
    drawn with one seed add up to the capacities exactly.
    """
    lo, hi = 0, len(before) - 1
    while hi - lo > 1:
        mid = (lo + hi) // 2
        left = _share(np.random.default_rng([seed, lo, hi]), capacities, int(before[mid] - before[lo]))
        capacities, lo, hi = (left, lo, mid) if cell < mid else (capacities - left, mid, hi)
    return capacities


def local_deal(cell: int, before: np.ndarray, capacities: np.ndarray, seed: int) -> np.ndarray:
    """The bucket of each row of a cell: its row of the matrix, written out and permuted."""
    dealt = np.repeat(np.arange(len(capacities), dtype=np.int32), matrix_row(cell, before, capacities, seed))
    np.random.default_rng([seed, cell, 0, 1]).shuffle(dealt)
    return dealt


def even_sizes(total: int, parts: int) -> np.ndarray:
    """Sizes of ``parts`` parts of ``total``, at most one apart."""
    return total // parts + (np.arange(parts) < total % parts).astype(np.int64)


class _Deal:
    """Cells by (file, row number), and what a task deals their rows by."""

    def __init__(self, files: list, capacities: np.ndarray, cell_rows: int, seed: int):
        rows = np.array([r["rows"] for r in files], dtype=np.int64)
        cells = -(-rows // cell_rows)
        first = np.cumsum(cells) - cells
        sizes = np.full(int(cells.sum()), cell_rows, dtype=np.int64)
        sizes[first + cells - 1] = rows - (cells - 1) * cell_rows
        names = np.array([r["file"] for r in files], dtype=np.int64)
        order = np.argsort(names)
        self.names, self.first = names[order], first[order]
        self.before = np.concatenate([[0], np.cumsum(sizes)])
        self.capacities, self.cell_rows, self.seed = capacities, cell_rows, seed

    def buckets(self, file: np.ndarray, row: np.ndarray) -> np.ndarray:
        cell = self.first[np.searchsorted(self.names, file)] + row // self.cell_rows
        out = np.empty(len(row), dtype=np.int32)
        for c in np.unique(cell).tolist():
            here = cell == c
            out[here] = _dealt(self, c)[row[here] % self.cell_rows]
        return out


@lru_cache(maxsize=4)
def _dealt(deal: _Deal, cell: int) -> np.ndarray:
    return local_deal(cell, deal.before, deal.capacities, deal.seed)


def shuffle_into_shards(docs: DataFrame, shards: int, seed: int = 0, from_files: bool = False, shard_col: str = "shard", slot_col: str = "slot") -> DataFrame:
    """``docs`` with ``shard_col`` (int, 0 to shards - 1) and ``slot_col`` (long, 0 without gaps in each shard), uniformly permuted.

    Shard sizes are at most one apart. ``from_files``: ``docs`` is a table as read from Parquet files, all its rows, with columns selected
    at most; otherwise it is written to the shared folder first, as rows need a place that a second reading finds again. The result depends on
    the table's files, ``seed`` and the session's number of shuffle partitions, which sets how many buckets a shard has at least. Nulls, empty
    texts and repeated rows are rows like any other; columns named like the two new ones are replaced; an empty table gives no rows.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    spark = docs.sparkSession
    docs = docs.drop(shard_col, slot_col)
    table = docs if from_files else stored(docs, "shards-input")
    columns = table.columns
    place = table.metadataColumn("_metadata")
    names = iter(n for n in (f"__place{i}" for i in range(len(columns) + 5)) if n.lower() not in {c.lower() for c in columns})
    file, row, bucket, key = (next(names) for _ in range(4))

    at = table.select(F.xxhash64(place["file_path"]).alias("file"), place["row_index"].alias("row"), place["file_size"].alias("bytes"), place["file_path"].alias("path"))
    files = at.groupBy("path").agg(F.first("file").alias("file"), F.count("*").alias("rows"), F.max("row").alias("last"), F.max("bytes").alias("bytes")).orderBy("path").drop("path").collect()
    if any(r["rows"] != r["last"] + 1 for r in files) or len({r["file"] for r in files}) < len(files):
        raise ValueError("from_files asks for whole tables as read from files")
    total, size = sum(r["rows"] for r in files), sum(r["bytes"] for r in files)
    split = max(total // BUCKET_ROWS, size // BUCKET_BYTES, 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))) // shards + 1
    shard_rows = even_sizes(total, shards)
    capacities = np.concatenate([even_sizes(int(n), split) for n in shard_rows])
    deal = _Deal(files, capacities, max(CELL_ROWS, -(-total // CELLS)), seed) if total else None

    @F.pandas_udf("int")
    def dealt(file: pd.Series, row: pd.Series) -> pd.Series:
        return pd.Series(deal.buckets(file.to_numpy(), row.to_numpy()))

    placed = table.select("*", F.xxhash64(place["file_path"]).alias(file), place["row_index"].alias(row))
    placed = placed.withColumn(bucket, dealt(file, row)).withColumn(key, F.xxhash64(F.lit(seed), file, row))
    again = F.row_number().over(Window.partitionBy(bucket).orderBy(key, file, row))
    shard, part = F.expr(f"{bucket} div {split}"), F.col(bucket) % split
    rows = F.lit(total // shards).cast("long") + F.when(shard < total % shards, 1).otherwise(0)  # of the shard
    before = part * F.floor(rows / split) + F.least(part, rows % split)  # in the shard's earlier buckets
    return placed.select(*(F.col(f"`{c}`") for c in columns), shard.cast("int").alias(shard_col), (before + again - 1).cast("long").alias(slot_col))
