"""Line dedup against a brute-force version, with small thresholds and hot lines."""

import hashlib
import re

import pytest

from gridzone.llm import linededup

STRIP = re.compile(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$")


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), STRIP.sub("", line))


def brute(rows, min_docs, keep_first=False):
    where = {}
    for d, t in rows:
        for pos, line in enumerate((t or "").split("\n")):
            if key(line):
                where.setdefault(key(line), set()).add((d, pos))
    common = {k: min(v) for k, v in where.items() if len({d for d, _ in v}) >= min_docs}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for pos, x in enumerate(lines) if key(x) not in common or keep_first and common[key(x)] == (d, pos)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def run(df, **rule):
    return sorted(tuple(r) for r in linededup.dedup_lines(df, **rule).collect())


ROWS = (
    [(i, f"Hot LINE\nown {i}\n  hot line\t\nÉ\n" + "x\n" * (i % 3)) for i in range(1, 14)]
    + [(20, None), (21, ""), (22, "\n\n"), (23, "hot line"), (24, "é\nÉ"), (24, "é\nÉ"), (25, "\n".join(f"l{i % 7}" for i in range(500)) + "\nhot line\nend"), (26, "own 1\x0b")]
    + [(27, "\n".join(["hot line", "tail"] * 9000))]
)


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("min_docs", [2, 10])
def test_brute_force(spark, min_docs, keep_first):
    df = spark.createDataFrame([(d, t, "z", 0) for d, t in ROWS], "doc_id long, text string, kept string, h1 int").repartition(5)
    assert run(df, min_docs=min_docs, keep_first=keep_first) == brute(ROWS, min_docs, keep_first)


def test_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a\nb"), (None, "a"), (1, "a"), (2, "a")], "doc_id long, text string")
    assert sorted(map(str, linededup.dedup_lines(df, min_docs=3).collect())) == sorted(
        ["Row(doc_id=None, n_lines=2, n_dropped=1, kept='b')", "Row(doc_id=None, n_lines=1, n_dropped=1, kept='')", "Row(doc_id=1, n_lines=1, n_dropped=1, kept='')", "Row(doc_id=2, n_lines=1, n_dropped=1, kept='')"]
    )
    assert run(df.limit(0), min_docs=2) == []


def test_bitmaps_hold_only_words_with_drops(spark):
    df = spark.createDataFrame([(1, "\n".join(["own"] + [str(i) for i in range(300)] + ["common"])), (2, "common")], "doc_id long, text string")
    maps = {r.doc_id: r.dropped for r in linededup.drop_bitmaps(df, min_docs=2).collect()}
    assert [(w.word, w.bits) for w in maps[1]] == [(301 // 64, 1 << 301 % 64)] and [(w.word, w.bits) for w in maps[2]] == [(0, 1)]


def test_query_equals_brute_force(spark):
    from gridzone.llm.queries import QUERIES

    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in QUERIES["op9_line_dedup"](spark, d).collect())
    assert got == [(i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in brute(rows, 10)]


def test_rows_of_one_id_lose_only_their_own_lines(spark):
    """Rows that share an id, null or not, have the common line at different positions."""
    rows = [(None, "hot\nown1"), (None, "own2\nhot"), (5, "hot\na"), (5, "b\nhot\nc"), (5, "b\nhot\nc"), (6, "hot"), (7, "x\nhot")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = lambda **rule: sorted((r.doc_id or 0, r.n_dropped, r.kept) for r in linededup.dedup_lines(df, min_docs=4, **rule).collect())
    rest = [(5, 1, "a"), (5, 1, "b\nc"), (5, 1, "b\nc"), (6, 1, ""), (7, 1, "x")]
    assert kept() == [(0, 1, "own1"), (0, 1, "own2"), *rest]
    assert kept(keep_first=True) == [(0, 0, "hot\nown1"), (0, 1, "own2"), *rest]
    same = spark.createDataFrame([(None, "hot\nown1"), (None, "hot\nown2"), (6, "hot"), (7, "hot")], "doc_id long, text string")
    firsts = [r.kept for r in linededup.dedup_lines(same, min_docs=3, keep_first=True).collect()]
    assert sum(t.split("\n").count("hot") for t in firsts) == 1 and {t.split("\n")[-1] for t in firsts} == {"own1", "own2", ""}


def test_a_very_long_text_and_clashing_names(spark):
    """10 MB in 200 000 lines; columns named like those used inside stay."""
    import time

    long = "\n".join(f"line {i} " + "x" * 40 for i in range(200_000))
    rows = [(i, "shared\nown %d" % i, i, "b", 1) for i in range(12)] + [(99, long + "\nshared", 7, "b", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bits long, `__bits` string, kept int")
    start = time.time()
    cut = linededup.apply_bitmaps(docs, linededup.drop_bitmaps(docs))
    got = {r.doc_id: r for r in cut.collect()}
    assert time.time() - start < 60
    assert cut.columns == docs.columns and got[99].text == long
    assert all(got[i].text == f"own {i}" and (got[i].bits, got[i]["__bits"], got[i].kept) == (i, "b", 1) for i in range(12))
