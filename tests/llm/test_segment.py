"""Sampled segmentations against enumeration of all of them, and decoding."""

import hashlib
import math

import numpy as np
import pytest
import sentencepiece

from gridzone.llm import segment
from gridzone.llm.tokens import public_vocabulary

MODEL = public_vocabulary("piece_bpe_32k.model")
SP = sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def sampler():
    return segment.Sampler(MODEL)


def every(sampler, text):
    """{ids: log p} of all segmentations."""
    text, out = SP.normalize(text), {}

    def go(at, ids, log):
        if at == len(text):
            out[ids] = log
        for end in range(at + 1, min(len(text), at + sampler.longest) + 1):
            piece = sampler.pieces.get(text[at:end])
            if piece:
                go(end, (*ids, piece[1]), log + piece[0])
            elif end == at + 1:
                go(end, (*ids, *(SP.piece_to_id(f"<0x{b:02X}>") for b in text[at].encode())), log + sampler.unknown)

    go(0, (), 0.0)
    norm = math.log(sum(map(math.exp, out.values())))
    return {ids: x - norm for ids, x in out.items()}


def ids_of(s):
    return tuple(np.frombuffer(s[0], "<u4").tolist())


def draws(sampler, text, n, k, seed=7):
    keys = np.arange(n, dtype=np.uint64)
    return [s for lo in range(0, n, 500) for s in sampler.sample([text] * len(keys[lo : lo + 500]), keys[lo : lo + 500], k, seed)]


@pytest.mark.parametrize("text", ["the cat", "a\nb é", "  in it", "ab ab"])
def test_distinct_with_exact_probabilities(sampler, text):
    all_of = every(sampler, text)
    for found in draws(sampler, text, 100, 6):
        assert len({ids_of(s) for s in found}) == len(found) == min(6, len(all_of))
        assert all(all_of[ids_of(s)] == pytest.approx(s[2], abs=1e-9) for s in found)
        values = [s[3] for s in found]
        assert values == sorted(values, reverse=True)


def test_all_segmentations_when_k_is_large(sampler):
    all_of = every(sampler, "in it")
    found = draws(sampler, "in it", 1, 10 * len(all_of))[0]
    assert {ids_of(s) for s in found} == set(all_of) and all(s[4] == 1.0 for s in found)


def test_sampling_law(sampler):
    """First draws follow p, second ones p without the first; inclusion weights estimate without bias."""
    text, n = "the cat", 6000
    all_of = {ids: math.exp(x) for ids, x in every(sampler, text).items()}
    runs = draws(sampler, text, n, 3)
    second = {ids: sum(p * all_of[ids] / (1 - p) for other, p in all_of.items() if other != ids) for ids in all_of}
    for nth, law in ((0, all_of), (1, second)):
        seen = {}
        for found in runs:
            seen[ids_of(found[nth])] = seen.get(ids_of(found[nth]), 0) + 1
        for ids, p in law.items():
            assert abs(seen.get(ids, 0) / n - p) < 5 * math.sqrt(p / n) + 1e-3
    length = sum(p * len(ids) for ids, p in all_of.items())
    estimates = [sum(math.exp(s[2]) / s[4] * len(ids_of(s)) for s in found) for found in runs]
    assert abs(np.mean(estimates) - length) < 5 * np.std(estimates) / math.sqrt(n)


def test_samples_do_not_depend_on_the_batch(sampler):
    texts = ["the cat sat", "", "on\nthe mat " * 30, "éé 😀 x", "the cat sat"]
    keys = np.array([5, 6, 7, 8, 5], dtype=np.uint64)
    whole = sampler.sample(texts, keys, 3, 1)
    assert whole == [sampler.sample([t], keys[i : i + 1], 3, 1)[0] for i, t in enumerate(texts)]
    assert whole[0] == whole[4] and sampler.sample(texts, keys, 3, 2) != whole


def test_own_decoding_equals_the_model_s(sampler):
    texts = ["", " ", "  a  b ", "x\ny\tz", "é▁ß", "😀 ﬁ", "a" * 50, "▁▁", "\u2581x", "word " * 40, "\x00\x7f"]
    for found in sampler.sample(texts, np.arange(len(texts), dtype=np.uint64), 3, 1, True):
        for s in found:
            assert s[5] == (SP.decode(list(ids_of(s))) if s[1] else "")


def test_query_decodes_to_the_text(spark):
    from gridzone.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = QUERIES["op10_sentencepiece"](spark, "/root/testdata/sf0.001").collect()
    want = {d: hashlib.sha256(SP.decode(SP.encode(t or "")).encode()).hexdigest() for d, t in texts.items()}
    assert all(r.decoded_sha256 == want[r.doc_id] and 0 < r.inclusion <= 1 for r in rows)
    assert len(rows) == 2 * len(texts) == len({(r.doc_id, r.ids_crc32) for r in rows})


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "x" * 30000), (4, "same text"), (4, "same text"), (None, "hm"), (5, "word " * 20000)]
    df = spark.createDataFrame([(d, t, "z", 0) for d, t in rows], "doc_id long, text string, ids string, key int")
    got = segment.sample(df, MODEL, k=2).withColumn("t", segment.decode(segment.F.col("ids"), MODEL)).collect()
    texts = {d: t or "" for d, t in rows}
    assert sorted((r.doc_id or 0, r.sample) for r in got) == [(0, 0), (0, 1), (1, 0), (2, 0), (3, 0), (3, 1), (4, 0), (4, 0), (4, 1), (4, 1), (5, 0), (5, 1)]
    assert all(r.t == texts[r.doc_id] for r in got)
    assert segment.sample(df.limit(0), MODEL).collect() == []
    own = df.select(segment.decode(segment.encode(segment.F.col("text"), MODEL), MODEL).alias("t"), "text").collect()
    assert all(r.t == r.text for r in own)


def test_words_are_looked_up_once_and_forgotten(monkeypatch):
    """Samples do not depend on what a worker remembers; each distinct word of a batch is looked up once."""
    import numpy as np

    from gridzone.llm import segment
    from gridzone.llm.tokens import public_vocabulary

    path = public_vocabulary("piece_bpe_32k.model")
    texts, keys = ["the cat, the caté the \U0001f600 dog\n", "", " x the dog the dog", "a" * 300], np.arange(4, dtype=np.uint64)
    one, other = segment.Sampler(path), segment.Sampler(path)
    want = one.sample(texts, keys, 2, 1, True)
    asked = []
    learn = other._learn
    monkeypatch.setattr(other, "_learn", lambda words: (asked.append(len(words) == len(set(words))), learn(words))[1])
    monkeypatch.setattr(segment, "REMEMBERED_ARCS", 5)
    for _ in range(3):
        assert other.sample(texts, keys, 2, 1, True) == want
    assert [other.sample([t], keys[i : i + 1], 2, 1, True)[0] for i, t in enumerate(texts)] == want
    assert all(asked) and all(isinstance(w, bytes) for w in other.words)
