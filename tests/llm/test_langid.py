"""Language identification: exact code lengths against a plain PPM, and held-out accuracy."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridzone.llm import langid

SF = "/root/testdata/sf0.01"


def brute_bits(texts, text):
    """Code length of ``text`` after counting ``texts``, straight from the definition."""
    seen = defaultdict(Counter)
    for t in texts:
        b = langid.PAD + t
        for i in range(3, len(b)):
            for order in range(4):
                seen[b[i - order : i]][b[i]] += 1
    b, total = langid.PAD + text, 0.0
    for i in range(3, len(b)):
        for order in (3, 2, 1, 0):
            here = seen.get(b[i - order : i])
            if not here:
                continue
            n, d = sum(here.values()), len(here)
            if b[i] in here:
                total += math.log2((n + d) / here[b[i]])
                break
            total += math.log2((n + d) / d)
        else:
            total += 8
    return total


@pytest.mark.parametrize("block", [1_000_000, 7])
def test_code_lengths(monkeypatch, block):
    monkeypatch.setattr(langid, "BLOCK", block)
    rng = random.Random(1)
    train = {"aa": ["abra cadabra " * 3, "alakazam ab"], "bb": ["bonjour é è à", "bo bo bo"]}
    counts = Counter()
    for lang, texts in train.items():
        for t in texts:
            b = langid.PAD + t.encode()
            for i in range(3, len(b)):
                counts[lang, int.from_bytes(b[i - 3 : i + 1], "big")] += 1
    lang, gram, n = zip(*((a, g, c) for (a, g), c in counts.items()), strict=True)
    model = langid.build(list(lang), np.array(gram), np.array(n))
    texts = ["abracadabra", "bonjour", "zzz", "é", "", "".join(rng.choices("abé xyz\n", k=60))]
    got = model.code_lengths([t.encode() for t in texts])
    for t, row in zip(texts, got, strict=True):
        for code, bits in zip(model.langs, row, strict=True):
            assert bits == pytest.approx(brute_bits([x.encode() for x in train[code]], t.encode()), rel=1e-5)


def test_held_out_accuracy(spark):
    from gridzone.llm.queries import QUERIES

    truth = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op8_langid"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    right = sum(r.lang_pred == truth[r.doc_id].lang for r in held if truth[r.doc_id].lang and len(truth[r.doc_id].text or "") > 30)
    assert right >= 0.98 * sum(bool(truth[r.doc_id].lang) and len(truth[r.doc_id].text or "") > 30 for r in held)


def test_edge_cases(spark):
    long = "le chat et la souris " * 60000
    train = spark.createDataFrame([(1, "the cat and the dog sat", "en"), (2, "le chat et le chien", "fr"), (3, None, "xx"), (4, "hm", None), (5, "", "yy")], "doc_id long, text string, lang string")
    rows = [(1, None), (2, ""), (3, " 123 ... \n"), (4, "the dog"), (4, "the dog"), (5, long), (None, "le chien"), (6, "²½")]
    df = spark.createDataFrame([(d, t, "zz", 1) for d, t in rows], "doc_id long, text string, lang_pred string, score int")
    got = sorted((r.doc_id or 0, r.lang_pred) for r in langid.identify(df, train).collect())
    assert got == [(0, "fr"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (5, "fr"), (6, "und")]
    assert {r.lang_pred for r in langid.identify(df, train.limit(0)).collect()} == {"und"}
    assert langid.identify(df.limit(0), train).collect() == []


def test_no_order_and_no_language_is_cut():
    """Many languages over many symbols, one of them with a single short text."""
    rng = random.Random(4)
    train = {f"l{i:03d}": ["".join(chr(rng.randrange(33, 500)) for _ in range(300))] for i in range(260)} | {"tiny": ["qzj qzj"]}
    rows = []
    for lang, texts in train.items():
        b = langid.PAD + texts[0].encode()
        rows += [(lang, g, c) for g, c in Counter(int.from_bytes(b[i - 3 : i + 1], "big") for i in range(3, len(b))).items()]
    lang, gram, n = zip(*rows, strict=True)
    model = langid.build(list(lang), np.array(gram), np.array(n))
    assert model.langs == sorted(train)
    probes = ["qzj", train["l007"][0][40:80], "other"]
    for t, row in zip(probes, model.code_lengths([p.encode() for p in probes]), strict=True):
        for code in ("tiny", "l007", "l259"):
            assert row[model.langs.index(code)] == pytest.approx(brute_bits([train[code][0].encode()], t.encode()), rel=1e-5)
    assert langid.predicted(model, probes[:2])[0] == ["tiny", "l007"]


def test_learn_keeps_small_and_many_languages(spark):
    rows = [(i, f"word{i} text{i} of language {i} " * 3, f"l{i:03d}") for i in range(300)] + [(None, "qzj qzj", "zz"), (900, None, "none")]
    model = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == sorted({lang for _, t, lang in rows if t})
    assert langid.predicted(model, ["qzj qzj"])[0] == ["zz"]
