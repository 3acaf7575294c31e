"""Personal data against plain regular expressions, and by planted cases."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from gridzone.llm import pii

SF = "/root/testdata/sf0.01"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def brute(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def base(spans):
    return [s[:3] for s in spans if s[0] in pii.BASE_KINDS]


def test_random_texts():
    rng = random.Random(2)
    bits = ["a@b.c", "@", ".", "-", " ", "x", "%", "+", "1", "255", "256", "10.0.0.1", "4111111111111111", "+1 555 0100 200", "(0)", "é", "_", "007", "\n", "4149601755386017", "c@d.e@f.g"]
    for _ in range(20000):
        text = "".join(rng.choices(bits, k=rng.randrange(14)))
        assert base(pii.find(text)) == brute(text), repr(text)


def test_query_equals_brute_force(spark):
    from gridzone.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op4_pii"](spark, SF).collect()
    assert len(rows) == len(texts)
    found = 0
    for r in rows:
        want = brute(texts[r.doc_id])
        found += len(want)
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w[0] == k for w in want) for k in pii.BASE_KINDS]
        own = [x.split(":") for x in r.spans.split(",") if x]
        assert [(k, int(s), int(e)) for k, s, e in own if k in pii.BASE_KINDS] == want
    assert found > 20


def test_checksums_and_context_decide_added_kinds():
    kinds = lambda t: [s[0] for s in pii.find(t)]
    assert kinds("pay to DE89 3704 0044 0532 0130 00 please") == ["iban"]
    assert kinds("pay to DE88 3704 0044 0532 0130 00 please") == []
    assert kinds("his SSN is 123-45-6789.") == ["ssn"] and kinds("part 123-45-6789.") == [] and kinds("SSN 666-45-6789") == []
    plain, helped, hurt = (pii.find(t)[0][3] for t in ("x 10.0.0.1 y", "server 10.0.0.1", "version 10.0.0.1"))
    assert hurt < plain < helped


def test_edge_cases(spark):
    long = "filler words here " * 20000 + "me@example.org"
    rows = [(1, None), (2, ""), (3, "a@b.co"), (3, "a@b.co"), (4, long), (None, "+49 30 1234567")]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, pii string")
    got = pii.find_pii(df).collect()
    assert sorted((r.doc_id or 0, [s.kind for s in r.pii]) for r in got) == [(0, ["phone"]), (1, []), (2, []), (3, ["email"]), (3, ["email"]), (4, ["email"])]
    assert next(r for r in got if r.doc_id == 4).pii[0].start == len(long) - 14
    assert pii.find_pii(df.limit(0)).collect() == []
    cut = df.select("doc_id", pii.redact(F.col("text")).alias("t"), "pii")
    assert {r.t for r in cut.collect()} == {None, "", "<EMAIL>", "<PHONE>", "filler words here " * 20000 + "<EMAIL>"}


def test_redaction_leaves_nothing_of_a_span():
    text = "mail a.b@c.org or card 4111 1111 1111 1111, +4111111111111111 ok"
    assert pii.redacted(text) == "mail <EMAIL> or card <CARD>, +<CARD> ok"


def test_iban_before_capital_words():
    iban = "AT61 1904 3002 3457 3201"
    for after in (" BIC x", " EUR", " 5", " PLEASE", "", "."):
        assert pii.redacted(f"pay to {iban}{after}") == f"pay to <IBAN>{after}"
    assert pii.redacted(f"konto XX12 3456 7890 {iban} EUR 5") == "konto XX12 3456 7890 <IBAN> EUR 5"
