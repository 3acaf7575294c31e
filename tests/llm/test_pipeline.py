"""Each pipeline stage on its own input against a brute-force version, and the whole run."""

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from gridzone.llm import pii, quality
from gridzone.llm.tokens import public_vocabulary
from tests.llm import test_linededup, test_simhash
from tests.llm import test_packing as packing_tests

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """{stage: (input rows, output rows)}."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        path = str(tmp_path_factory.mktemp(name) / "t")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = (before, docs.collect())
    return out


def test_columns_stay(staged):
    for name in ("quality", "line_dedup", "simhash", "pii"):
        rows = staged[name][1]
        assert rows and list(rows[0].asDict()) == COLUMNS
        assert all(r.n_chars == len(r.text) for r in rows)


def test_quality_keeps_what_the_operator_keeps(spark, staged):
    before, after = staged["quality"]
    docs, labels = spark.createDataFrame(before), spark.read.parquet(f"{SF}/labels.parquet")
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in quality.judged(docs, labels).collect() if r["__kept"])
    texts = {r.doc_id: r for r in before}
    assert all(r == texts[r.doc_id] for r in after) and 0 < len(after) < len(before)


def test_line_dedup(staged):
    before, after = staged["line_dedup"]
    want = test_linededup.brute([(r.doc_id, r.text) for r in before], 10, keep_first=True)
    assert sorted((r.doc_id, r.text) for r in after) == [(d, t) for d, _, _, t in want]


def test_simhash_keeps_one_of_each_group(staged):
    before, after = staged["simhash"]
    groups = test_simhash.brute([(r.doc_id, r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted({low for _, _, low in groups})


def test_pii_leaves_no_base_span(staged):
    before, after = staged["pii"]
    assert {r.doc_id: r.text for r in after} == {r.doc_id: pii.redacted(r.text) for r in before}
    assert sum(len(pii.find(r.text)) for r in before) > 0 == sum(len(pii.find(r.text)) for r in after)


def test_packing(staged):
    before, after = staged["packing"]
    packing_tests.check(after, [(r.doc_id, r.text) for r in before], Tokenizer.from_file(public_vocabulary("byte_bpe_50k.json")))


def test_run_gives_the_last_stage(spark, staged):
    got = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.start, bytes(r.ids)) for r in got.collect()) == sorted((r.doc_id, r.start, bytes(r.ids)) for r in staged["packing"][1])


def test_edge_cases_pass_every_stage(spark):
    text = "some words that stand here in this short text of more than ten words"
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, text, None, None, None), (3, text, None, None, None), (4, "x " * 50000, "en", "s", 9), (None, text + " too", "en", "s", 3)]
    docs = spark.createDataFrame([(*r, "own") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, component string")
    for own in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, own, SF)
            if name != "packing":
                assert out.columns == own.columns
            assert bool(out.count()) == bool(own.count())
    kept = corpus_pipeline.simhash_dedup(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0, r.component) for r in kept) == [(0, "own"), (1, "own"), (3, "own"), (4, "own")]
