"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

A span's score is its kind's start value, raised by a passed checksum and by
words nearby that announce such a value, lowered by words that announce
something else (an order, a version). Spans of the four base kinds stay whatever their score
(it is there for the caller to use); spans of the kinds that the method adds
(``iban`` by mod-97, ``ssn`` by area rules and context) need ``min_score``.

One pass over the text in an Arrow UDF; nothing is shuffled and other columns
never leave the JVM.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base kinds' order in digests; added kinds follow.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
DIGIT = re.compile("[0-9]")
NOT_DIGIT = re.compile("[^0-9]+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: Code points to either side of a span where context words count.
CONTEXT = 48
START = {"email": 0.7, "ip": 0.5, "card": 0.4, "phone": 0.5, "iban": 0.5, "ssn": 0.3}
CHECKED = {"card": 0.3, "iban": 0.4}
FOR = {
    "email": re.compile(r"\b(?:e-?mail|mail|contact|write|reach)", re.I),
    "ip": re.compile(r"\b(?:ip|host|server|address|login|logged)", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|credit|debit|payment|pay)", re.I),
    "phone": re.compile(r"\b(?:phone|tel|call|mobile|fax|sms|whatsapp)", re.I),
    "iban": re.compile(r"\b(?:iban|account|bank|transfer|konto)", re.I),
    "ssn": re.compile(r"\b(?:ssn|social security|taxpayer)", re.I),
}
AGAINST = re.compile(r"\b(?:order|invoice|isbn|version|serial|build|sku)", re.I)


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def mod_97(iban: str) -> bool:
    compact = iban.replace(" ", "")
    return 15 <= len(compact) <= 34 and int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def _emails(text: str):
    """Spans of local@domain, leftmost first. Found from the @: the local part is all that may stand before it and is free."""
    free = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            free = m.end()


def _ibans(text: str):
    """Spans that pass mod-97, the longest end at a group border first: a match may run on into the words that follow."""
    m = IBAN.search(text)
    while m:
        ends = [m.end(), *(i for i in range(m.end() - 1, m.start(), -1) if text[i] == " ")]
        end = next((e for e in ends if mod_97(text[m.start() : e])), None)
        if end:
            yield m.start(), end
        m = IBAN.search(text, end or m.start() + 1)


def _proposed(text: str):
    if "@" in text:
        yield from (("email", *span) for span in _emails(text))
    if not DIGIT.search(text):
        return
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            yield "ip", *m.span()
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield "card", *m.span()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                yield "phone", *m.span()
    yield from (("iban", *span) for span in _ibans(text))
    for m in SSN.finditer(text):
        if m[0][:3] not in ("000", "666") and m[0] < "900" and m[0][4:6] != "00" and m[0][7:] != "0000":
            yield "ssn", *m.span()


def find(text: str | None, min_score: float = 0.6) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) in code points, by kind and then start."""
    spans = []
    for kind, start, end in _proposed(text or ""):
        near = text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT]
        score = START[kind] + CHECKED.get(kind, 0) + 0.3 * bool(FOR[kind].search(near)) - 0.3 * bool(AGAINST.search(near))
        score = round(min(1.0, max(0.0, score)), 3)
        if kind in BASE_KINDS or score >= min_score:
            spans.append((kind, start, end, score))
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))


def redacted(text: str | None, min_score: float = 0.6) -> str | None:
    """The text with every span replaced by its kind in angle brackets; spans that overlap become one, named by the first."""
    if text is None:
        return None
    out, at = [], 0
    for kind, start, end, _ in sorted(find(text, min_score), key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])


def spans(text: Column, min_score: float = 0.6) -> Column:
    """array<struct<kind, start, end, score>> of a text; empty for null and empty texts."""

    @F.arrow_udf("array<struct<kind string, start long, end long, score double>>")
    def found(texts: pa.Array) -> pa.Array:
        return pa.array([[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in find(t, min_score)] for t in texts.to_pylist()], pa.list_(SPAN))

    return found(text)


def redact(text: Column, min_score: float = 0.6) -> Column:
    """The text with every span replaced; null stays null."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array) -> pa.Array:
        return pa.array([redacted(t, min_score) for t in texts.to_pylist()], pa.string())

    return cut(text)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_score: float = 0.6) -> DataFrame:
    """One row per row of ``docs``: id and ``pii`` (the spans).

    Null and empty texts have no spans; repeated rows and ids stay. Other columns
    are ignored, whatever their names. An empty table gives no rows.
    """
    return docs.select(F.col(id_col), spans(F.col(text_col), min_score).alias("pii"))


def joined(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
