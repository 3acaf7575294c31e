"""Packing: exact ids, every id in one piece, gapless windows, little padding."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from gridzone.llm.packing import balance, difference, pack
from gridzone.llm.tokens import Encoder, public_vocabulary

SF = "/root/testdata/sf0.01"
VOCABULARY = public_vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def check(pieces, docs, tokenizer, window=2048):
    want = sorted((d, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])) for d, t in docs)
    by_doc, by_sequence = {}, {}
    for p in pieces:
        assert len(p.ids) == 4 * p.length and 0 < p.length <= window
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    if len({d for d, _ in docs}) == len(docs):
        got = sorted((d, tuple(np.frombuffer(b"".join(p.ids for p in sorted(ps, key=lambda p: p.start)), "<u4").tolist())) for d, ps in by_doc.items())
        assert got == want
        assert all(p.doc_tokens == len(dict(want)[p.doc_id]) for p in pieces)
    assert sum(p.length for p in pieces) == sum(len(ids) for _, ids in want)
    for ps in by_sequence.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
    return by_sequence


def test_documents(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = check(pack(docs, VOCABULARY).collect(), [tuple(r) for r in docs.select("doc_id", "text").collect()], tokenizer)
    tokens = sum(p.length for ps in got.values() for p in ps)
    assert len(got) * 2048 < 1.03 * tokens + 2048 * docs.rdd.getNumPartitions()


def test_query_digests(spark, tokenizer):
    from gridzone.llm.queries import QUERIES

    rows = QUERIES["op7_packing"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in rows:
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids + [1]
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
        assert r.doc_tokens == len(ids)


def test_edge_cases(spark, tokenizer):
    docs = [(1, None), (2, ""), (3, "word " * 30000), (4, "same"), (4, "same"), (5, "x" * 9000), (6, "  two  spaces \n\n end ")]
    df = spark.createDataFrame([(d, t, "z") for d, t in docs], "doc_id long, text string, offset string")
    check(pack(df, VOCABULARY).collect(), docs, tokenizer)
    check(pack(df.where("doc_id <> 4"), VOCABULARY, max_piece=100).collect(), [d for d in docs if d[0] != 4], tokenizer)
    assert pack(df.limit(0), VOCABULARY).collect() == []
    assert pack(spark.createDataFrame([(None, "a")], "doc_id long, text string"), VOCABULARY).first().doc_id is None


def test_encoder_equals_tokenizer(tokenizer):
    rng = random.Random(4)
    bits = ["a", "the", " ", "  ", "\n", "\t", "\x1c", "\xa0", "²", "Ⅷ", "'s", "'ll", "_", "é", "é", "中文", "😀", "12", "٣", "<|endoftext|>", ".", "!!", " ", "\x85", " \n", "\r\n", "½x"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(12))) for _ in range(3000)]
    encoder = Encoder(VOCABULARY)
    for text, got in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_differencing_balances_and_respects_capacity():
    rng = np.random.default_rng(1)
    for n, k in [(400, 40), (30, 7), (5, 5), (1, 3)]:
        w = rng.integers(1, 512, n)
        window, loads = difference(w, k)
        assert sorted(np.bincount(window, w, k).astype(int)) == sorted(loads)
        if n >= 10 * k:
            assert loads.max() - loads.min() <= 8
    for w in (np.full(50, 1100), rng.integers(1, 2049, 300), np.array([2048, 2048, 1])):
        window, k = balance(w, 2048)
        assert np.bincount(window, w, k).max() <= 2048


def test_ids_of_odd_strings_equal_the_tokenizer():
    """Every kind of space, line break, mark, special token and combining sign beside one another."""
    import random

    from gridzone.llm.tokens import Encoder, public_vocabulary

    rng = random.Random(5)
    bits = ["a", "Word", "é", "ÿ", "ß", "'s", "don't", " ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "\u00a0", "\u3000", ".", ",", "...", "!?", "%", "$5", "12", "3,4", "a,b",
            "x.y.z", "#tag", "|", "\x00", "<|endoftext|>", "日本", "😀", "\r\n", "\x0b", "\x85", "\u0301", "Ǆ", "İ", "word,'s"]
    odd = ["".join(rng.choices(bits, k=rng.randrange(0, 14))) for _ in range(6000)]
    encoder = Encoder(public_vocabulary("byte_bpe_50k.json"))
    got = [ids for i in range(0, len(odd), 700) for ids in encoder.encode(odd[i : i + 700])]
    assert got == encoder._plain(odd)


def test_encodes_little_text_at_a_time(monkeypatch):
    """A large batch is encoded in small runs of texts; the pieces and their numbers are those of one run."""
    import pyarrow as pa

    from gridzone.llm import packing

    texts = [None, "", *(f"a{i} " * (i % 700) for i in range(3000))]
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": texts})
    at_once = []

    class Encoder:
        def encode(self, some):
            at_once.append(sum(map(len, some)))
            return [t[: len(t) // 4 * 4].encode() for t in some]

    monkeypatch.setattr(packing, "encoder", lambda path: Encoder())
    monkeypatch.setattr(packing.TaskContext, "get", staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 3})()))
    run = lambda: pa.Table.from_batches(packing._packed(iter([batch]), "", 1, 2048, 512, 128))
    got = run()
    assert sum(at_once) > 3 * 1_500_000 and max(at_once) < 1_600_000
    monkeypatch.setattr(packing, "ENCODED_AT_ONCE", 1 << 40)
    assert run().equals(got)


def test_remembers_few_parts():
    from gridzone.llm import tokens

    e = tokens.Encoder(tokens.public_vocabulary("byte_bpe_50k.json"))
    e.encode([" ".join(f"x{i}" for i in range(lo, lo + 50_000)) for lo in range(0, 300_000, 50_000)])
    e.encode(["one two"])
    assert len(e.parts) < 10
