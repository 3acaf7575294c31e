"""Language identification by prediction by partial matching (PPM).

For every language a byte context tree of up to three bytes with PPM's escape
method C: a symbol seen c times in a context with n occurrences of d different
symbols costs log2((n + d) / c) bits there, any other symbol the escape
log2((n + d) / d) plus its cost one byte shorter, down to a uniform byte. The
language whose frozen statistics give a text the shortest code wins; the score
is its posterior under equal priors.

Statistics come from a bounded sample of labelled documents (whole texts of
``DOCS_PER_LANG`` documents per language, those with the smallest hash of their
id): Spark counts 4-byte sequences per language, and the driver turns all of them
into sparse trees, the seen symbols and the escapes of each language's contexts.
The model's size follows the sample; no order, context or language is cut, and
languages without text to learn from are logged. Predicting looks up each distinct
4-byte sequence of a block once, for whole texts in numpy, without a shuffle.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

#: Bound of the sample.
DOCS_PER_LANG = 500
ORDER = 3
#: Bytes scored at a time; costs (sequences x languages) held at a time.
BLOCK, CELLS = 1_000_000, 4_000_000
#: What stands before a text's first byte.
PAD = b"\n" * ORDER
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"


@dataclass
class Sparse:
    """Bits of the languages that have a byte sequence: those of ``keys[i]`` are entries ``start[i]`` to ``start[i + 1]``."""

    keys: np.ndarray
    start: np.ndarray
    lang: np.ndarray
    bits: np.ndarray

    def entries(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index into ``keys``, language, bits) of all entries of ``keys``."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        n = np.where(self.keys[at] == keys, self.start[at + 1] - self.start[at], 0)
        entry = np.arange(n.sum()) + np.repeat(self.start[at] - (np.cumsum(n) - n), n)
        return np.repeat(np.arange(len(keys)), n), self.lang[entry], self.bits[entry]


@dataclass
class Model:
    langs: list[str]
    escapes: list[Sparse]  # by length of the context
    symbols: list[Sparse]  # contexts with the byte that follows

    def costs(self, gram: np.ndarray) -> np.ndarray:
        """Bits of the last byte of 4-byte sequences under each language."""
        out = np.full((len(gram), len(self.langs)), 8.0)
        for order in range(ORDER + 1):  # from the shortest context on: a seen byte's own cost, or the escape on top
            own, at = np.unique(gram & (1 << 8 * (order + 1)) - 1, return_inverse=True)
            add, direct = np.zeros((len(own), len(self.langs))), np.full((len(own), len(self.langs)), np.nan)
            row, lang, bits = self.escapes[order].entries(own >> 8)
            add[row, lang] = bits
            row, lang, bits = self.symbols[order].entries(own)
            direct[row, lang] = bits
            out += add[at]
            direct = direct[at]
            out = np.where(np.isnan(direct), out, direct)
        return out

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text under each language."""
        total = np.zeros((len(texts), len(self.langs)))
        block, owner, size = [], [], 0
        for i, text in enumerate(texts):
            padded = PAD + text
            for at in range(0, len(text), BLOCK):
                block.append(padded[at : at + BLOCK + ORDER])
                owner.append(i)
                size += len(block[-1])
                if size >= BLOCK:
                    self._add(total, block, owner)
                    block, owner, size = [], [], 0
        if block:
            self._add(total, block, owner)
        return total

    def _add(self, total: np.ndarray, block: list[bytes], owner: list[int]) -> None:
        """Each block begins with ORDER bytes of context."""
        b = np.frombuffer(b"".join(block), np.uint8).astype(np.int64)
        ends = np.cumsum([len(x) for x in block])
        of = np.repeat(np.arange(len(block)), [len(x) - ORDER for x in block])
        last = np.arange(len(b))[ORDER:]
        last = last[last - (ends - [len(x) for x in block])[np.searchsorted(ends, last, side="right")] >= ORDER]
        gram, at = np.unique(((b[last - 3] << 8 | b[last - 2]) << 8 | b[last - 1]) << 8 | b[last], return_inverse=True)
        # How often each block has each sequence, by sequence
        pair, n = np.unique(at * len(block) + of, return_counts=True)
        at, of, step = pair // len(block), pair % len(block), max(1, CELLS // len(self.langs))
        for lo in range(0, len(gram), step):
            cost = self.costs(gram[lo : lo + step])
            here = np.arange(*np.searchsorted(at, [lo, lo + step]))
            for some in np.array_split(here, max(1, -(-len(here) // step))):
                by = some[np.argsort(of[some], kind="stable")]
                first = np.flatnonzero(np.diff(of[by], prepend=-1))
                sums = np.add.reduceat(cost[at[by] - lo] * n[by, None], first, axis=0) if len(by) else np.empty((0, len(self.langs)))
                np.add.at(total, np.asarray(owner)[of[by[first]]], sums)


def _sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_lang: int) -> DataFrame:
    """(lang, text) of ``per_lang`` documents of each language, or all that it has."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    place = F.struct(F.xxhash64("id").alias("h"), F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), F.xxhash64("text").alias("t"))
    first = Window.partitionBy("lang").orderBy("place")
    nth = own.select("lang", place.alias("place")).withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= per_lang)
    until = nth.groupBy("lang").agg(F.max("place").alias("until"))  # a row for each language
    return own.join(F.broadcast(until), "lang").where(place <= F.col("until")).select("lang", "text")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(text.encode())
        for lang, texts in by_lang.items():
            for text in texts:
                b = np.frombuffer(PAD + text, np.uint8).astype(np.int64)
                if len(b) > ORDER:
                    gram, n = np.unique(((b[:-3] << 8 | b[1:-2]) << 8 | b[2:-1]) << 8 | b[3:], return_counts=True)
                    yield pa.RecordBatch.from_pydict({"lang": [lang] * len(gram), "gram": gram, "n": n})


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = DOCS_PER_LANG) -> Model | None:
    """The model of a labelled table; None if no row has a text and a language."""
    grams = _sample(docs, id_col, text_col, lang_col, per_lang).select("lang", "text").mapInArrow(_count, "lang string, gram long, n long")
    table = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    names = table.column("lang").combine_chunks().dictionary_encode()
    langs = names.dictionary.to_pylist()
    labels = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang")).distinct().toArrow().column("lang").to_pylist()
    if left_out := sorted(set(labels) - set(langs)):
        log.warning("%d languages have no text to learn from and are never predicted: %s", len(left_out), left_out)
    if not table.num_rows:
        return None
    order = np.argsort(langs)
    rank = np.empty(len(langs), np.int64)
    rank[order] = np.arange(len(langs))
    return _trees(sorted(langs), rank[names.indices.to_numpy()], table.column("gram").to_numpy(), table.column("n").to_numpy())


def build(lang: list[str], gram: np.ndarray, n: np.ndarray) -> Model:
    """The trees of counted 4-byte sequences (three of context, one that follows)."""
    langs = sorted(set(lang))
    return _trees(langs, np.searchsorted(langs, lang), np.asarray(gram), np.asarray(n))


def _trees(langs: list[str], of: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Model:
    escapes, symbols, k = [], [], len(langs)
    for order in range(ORDER + 1):
        seen, at = np.unique((gram & (1 << 8 * (order + 1)) - 1) * k + of, return_inverse=True)
        count = np.bincount(at, n)
        key, lang = seen // k, seen % k
        context, at = np.unique((key >> 8) * k + lang, return_inverse=True)
        total, kinds = np.bincount(at, count), np.bincount(at)
        escapes.append(_sparse(context // k, context % k, np.log2((total + kinds) / kinds)))
        symbols.append(_sparse(key, lang, np.log2((total + kinds)[at] / count)))
    return Model(langs, escapes, symbols)


def _sparse(key: np.ndarray, lang: np.ndarray, bits: np.ndarray) -> Sparse:
    keys, start = np.unique(key, return_index=True)
    return Sparse(keys, np.append(start, len(key)), lang.astype(np.int32), bits.astype(np.float32))


def has_letter(text: str | None) -> bool:
    found = LETTER.search(text) if text else None
    return bool(found) and (found[0].isalpha() or any(map(str.isalpha, text)))


def predicted(model: Model | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    own = [i for i, t in enumerate(texts) if has_letter(t)] if model else []
    lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if own:
        bits = model.code_lengths([texts[i].encode() for i in own])
        best = bits.argmin(axis=1)  # of equal lengths the first language by name
        short = bits[np.arange(len(own)), best]
        posterior = 1 / np.exp2(np.maximum(short[:, None] - bits, -1000)).sum(axis=1)
        for i, b, p in zip(own, best, posterior, strict=True):
            lang[i], score[i] = model.langs[b], float(p)
    return lang, score


def language(text: Column, model: Broadcast) -> Column:
    """struct<lang, score> of a text under a broadcast model (its size follows the sample)."""

    @F.arrow_udf("struct<lang string, score double>")
    def predict(texts: pa.Array) -> pa.Array:
        lang, score = predicted(model.value, texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["lang", "score"])

    return predict(text)


def identify(docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: id, ``lang_pred`` and ``score``, learned from ``training``.

    Only the text is looked at. Null, empty and letterless texts are ``und`` with
    score 0, as is every text when there is nothing to learn from. Repeated rows and
    ids stay; other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(learn(training, id_col, text_col, lang_col))
    own = docs.select(F.col(id_col), language(F.col(text_col), model).alias("found"))
    return own.select(id_col, F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))
