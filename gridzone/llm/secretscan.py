"""Secret scan: fixed shapes, and a battery of randomness tests for long tokens. DataFrame functions only.

Shapes (assignments, access keys, hex strings) are found by pattern. Every
other long token that mixes letters and digits or upper and lower case, or is
written in the base32 alphabet, is a candidate of kind
``random``: its encoding is inferred (hex, base32, base64) and three tests ask
whether it could be uniform over that alphabet - chi-squared over eight equal
parts of the alphabet, runs about its middle, and lag-1 serial correlation.
Fisher's method joins their p-values.

Benjamini-Hochberg then decides which candidates are structured (not random),
separately for each power-of-two class of lengths, because a short token's
tests have little power and a few long ones would otherwise set everyone's
threshold. What is not rejected is reported. The step-up rule needs ranks among
all candidates: they come from a histogram of p-values (LENGTHS x BINS rows at
most, whatever the corpus), so no sort over candidates and no task holds them all.

That bounds the share of random tokens among those dropped, not of ordinary ones among
those reported. So a second null is held too: that a token is word-like (letters as often as in
prose, few digits and separators), tested by its surprisal under that
law. A token is reported only if Benjamini-Hochberg, again by length class, rejects this null,
so of the reported tokens at most a share FDR is expected to be slugs, paths or identifiers.

Text is scanned once; the spans found are a small table in the shared folder,
and everything after works on that. Positions are summed up in blocks of matches, so a text with
many thousand matches costs little more than their number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridzone.llm.common import stored

#: In the order of equal starts; ``random`` is the added kind.
BASE_KINDS = ("assign", "access", "hex")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A maximal run is the leftmost match, so the least length can stand in the pattern; not so for ASSIGN's value.
ACCESS, HEX, CANDIDATE = "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}", "[A-Za-z0-9+/_=-]{20,}"
MIN_VALUE = 6
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE16 = "0123456789abcdef"
#: False-discovery rate; parts of the alphabet; histogram bins of -log10(p), each BIN wide.
FDR, PARTS, BINS, BIN = 0.01, 8, 400, 0.05
SPAN = "array<struct<start:bigint,end:bigint,token:string>>"
#: Matches whose positions are summed up together; code points of a bucket in which candidates meet base spans.
BLOCK, BUCKET = 128, 1024
#: Letters a to z per thousand in prose, rounded means of English, French, German and Spanish.
LETTERS = (80, 14, 32, 41, 145, 15, 18, 33, 71, 4, 7, 47, 28, 77, 62, 24, 8, 66, 71, 70, 45, 13, 10, 3, 8, 6)
#: Shares of letters, digits and other characters in slugs, paths and identifiers.
WORD_LIKE = (0.76, 0.13, 0.11)


def _matches(text: Column, pattern: str, value_group: int = 0, min_value: int = 0) -> Column:
    """array<struct<start, end, token>> in code points of the leftmost non-overlapping matches."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    # gaps has one entry more; the last one never counts
    steps = F.arrays_zip(F.transform(gaps, F.char_length).alias("gap"), found.alias("token"), F.transform(values, F.char_length).alias("value"))
    steps = F.filter(steps, lambda x: x["token"].isNotNull())
    length = lambda x: x["gap"] + F.char_length(x["token"])
    none = F.array().cast(SPAN)

    def span(at, x):
        return F.struct((at + x["gap"]).alias("start"), (at + length(x)).alias("end"), x["token"].alias("token"))

    def block_spans(block, at):
        return F.aggregate(
            block,
            F.struct(at.alias("at"), none.alias("out")),
            lambda a, x: F.struct((a["at"] + length(x)).alias("at"), F.when(x["value"] >= min_value, F.concat(a["out"], F.array(span(a["at"], x)))).otherwise(a["out"]).alias("out")),
            lambda a: a["out"],
        )

    def spans(all_steps):
        blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(all_steps) / BLOCK)), lambda b: F.slice(all_steps, (b * BLOCK + 1).cast("int"), F.lit(BLOCK)))
        return F.aggregate(
            blocks,
            F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{SPAN}>").alias("out")),
            lambda a, block: F.struct(
                (a["at"] + F.aggregate(block, F.lit(0).cast("bigint"), lambda n, x: n + length(x))).alias("at"),
                F.concat(a["out"], F.array(block_spans(block, a["at"]))).alias("out"),
            ),
            lambda a: F.flatten(a["out"]),
        )

    once = F.get(F.transform(F.array(steps), spans), F.lit(0))  # steps bound to a variable: matched once
    return F.when(text.rlike(pattern), once).otherwise(none)


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal Z (Abramowitz and Stegun 26.2.17, error below 1e-7)."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def randomness(tokens: DataFrame, token: str = "token") -> DataFrame:
    """``tokens`` with __encoding, __p_uniform, __p_runs, __p_serial and their joint __p. One row each, no shuffle."""
    t = F.col(token)
    is_hex, is_32 = t.rlike(r"\A(?:[0-9a-f]+|[0-9A-F]+)\z"), t.rlike(r"\A[A-Z2-7]+=*\z")
    out = tokens.withColumn("__encoding", F.when(is_hex, "hex").when(is_32, "base32").otherwise("base64"))
    alphabet = F.when(F.col("__encoding") == "hex", BASE16).when(F.col("__encoding") == "base32", BASE32).otherwise(BASE64)
    plain = F.when(is_hex, F.lower(t)).otherwise(F.translate(F.rtrim(t, F.lit("=")), "-_", "+/"))
    out = out.withColumn("__alphabet", alphabet).withColumn("__k", F.char_length("__alphabet")).withColumn("__chars", F.filter(F.split(plain, ""), lambda c: c != ""))
    out = out.withColumn("__codes", F.filter(F.transform("__chars", lambda c: F.call_function("locate", c, F.col("__alphabet")) - 1), lambda c: c >= 0))
    out = out.withColumn("__n", F.size("__codes").cast("double"))
    part = lambda c: F.floor(c * PARTS / F.col("__k"))
    counts = F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda b: F.size(F.filter("__codes", lambda c: part(c) == b)))
    out = out.withColumn("__chi", F.aggregate(counts, F.lit(0.0), lambda a, o: a + F.pow(o - F.col("__n") / PARTS, 2) / (F.col("__n") / PARTS)))
    spread = 2 / (9.0 * (PARTS - 1))  # Wilson-Hilferty
    out = out.withColumn("__p_uniform", _upper_tail((F.cbrt(F.col("__chi") / (PARTS - 1)) - (1 - spread)) / spread**0.5))
    low = lambda c: (c < F.col("__k") / 2).cast("int")
    out = out.withColumn("__low", F.transform("__codes", low)).withColumn("__n1", F.aggregate("__low", F.lit(0), lambda a, x: a + x).cast("double"))
    n, n1, n2 = F.col("__n"), F.col("__n1"), F.col("__n") - F.col("__n1")
    changes = F.aggregate(F.sequence(F.lit(1), F.greatest(F.size("__low") - 1, F.lit(1))), F.lit(0), lambda a, i: a + F.coalesce((F.get("__low", i) != F.get("__low", i - 1)).cast("int"), F.lit(0)))
    out = out.withColumn("__runs", 1.0 + changes)
    mean, two = 2 * n1 * n2 / n + 1, 2 * n1 * n2
    var = two * (two - n) / (n * n * (n - 1))
    out = out.withColumn("__p_runs", F.when(var > 0, 2 * _upper_tail(F.abs((F.col("__runs") - mean) / F.sqrt(var)))).otherwise(F.lit(1e-20)))
    out = out.withColumn("__mean", F.aggregate("__codes", F.lit(0.0), lambda a, c: a + c) / n)
    out = out.withColumn("__dev", F.transform("__codes", lambda c: c - F.col("__mean")))
    lagged = F.zip_with(F.slice("__dev", F.lit(1), F.greatest(F.size("__dev") - 1, F.lit(0))), F.slice("__dev", F.lit(2), F.greatest(F.size("__dev") - 1, F.lit(0))), lambda a, b: a * b)
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
    out = out.withColumn("__lag", total(lagged)).withColumn("__sq", total(F.transform("__dev", lambda x: x * x)))
    out = out.withColumn("__p_serial", F.when(F.col("__sq") > 0, 2 * _upper_tail(F.abs(F.col("__lag") / F.col("__sq") * F.sqrt(n)))).otherwise(F.lit(1e-20)))
    safe = lambda c: F.greatest(F.least(F.col(c), F.lit(1.0)), F.lit(1e-20))
    half = -(F.log(safe("__p_uniform")) + F.log(safe("__p_runs")) + F.log(safe("__p_serial")))
    out = out.withColumn("__half", half).withColumn("__p", F.exp(-F.col("__half")) * (1 + F.col("__half") + F.col("__half") * F.col("__half") / 2))
    return out.drop("__alphabet", "__k", "__chars", "__codes", "__n", "__chi", "__low", "__n1", "__runs", "__mean", "__dev", "__lag", "__sq", "__half")


def word_surprise(tokens: DataFrame, token: str = "token") -> DataFrame:
    """``tokens`` with __p_word: how likely a word-like token is at least so surprising. One row each, no shuffle."""
    letters, digits, others = WORD_LIKE
    shares = [letters * x / sum(LETTERS) for x in LETTERS] + [digits / 10] * 10 + [others / 5] * 5
    symbols = "abcdefghijklmnopqrstuvwxyz0123456789-_/+="
    nats = [-math.log(p) for p in shares]
    mean = sum(p * x for p, x in zip(shares, nats))
    spread = sum(p * (x - mean) ** 2 for p, x in zip(shares, nats)) ** 0.5
    table = F.array(*map(F.lit, nats))
    chars = F.filter(F.split(F.lower(token), ""), lambda c: c != "")
    sum_nats = F.aggregate(chars, F.lit(0.0), lambda a, c: a + F.get(table, F.call_function("locate", c, F.lit(symbols)) - 1))
    n = F.char_length(token)
    return tokens.withColumn("__p_word", _upper_tail((sum_nats - n * mean) / (spread * F.sqrt(n))))


def _rank_bin(p: Column) -> Column:
    """Histogram bin of a p-value; 0 holds the largest."""
    return F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-30))) / BIN), F.lit(BINS)).cast("int")


def rejected_from(tested: DataFrame, fdr: float = FDR, bin: str = "bin") -> DataFrame:
    """(length_class, from_bin): Benjamini-Hochberg rejects the candidates in bin ``from_bin`` and above; absent where it rejects none.
    With a column ``token_hash`` the copies of a token count once."""
    each = tested.select("length_class", F.col(bin).alias("bin"), "token_hash").distinct() if "token_hash" in tested.columns else tested.select("length_class", F.col(bin).alias("bin"))
    bins = each.groupBy("length_class", "bin").count()
    by_p = Window.partitionBy("length_class").orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = bins.withColumn("rank", F.sum("count").over(by_p)).withColumn("all", F.sum("count").over(Window.partitionBy("length_class")))
    largest_p = F.pow(F.lit(10.0), -F.col("bin") * BIN)
    return ranked.where(largest_p <= fdr * F.col("rank") / F.col("all")).groupBy("length_class").agg(F.min("bin").alias("from_bin"))


def _apart(found: DataFrame) -> DataFrame:
    """(row, start, end, token) of the candidates that overlap no base span. Both are dealt by the buckets of code points they reach
    into, so a text with very many of both is no product of the two."""
    buckets = F.explode(F.sequence(F.floor(F.col("start") / BUCKET), F.floor((F.col("end") - 1) / BUCKET)))
    some = found.where(F.size("candidates") > 0)
    alone = some.where(F.size("base") == 0).select("row", F.inline("candidates"))
    both = some.where(F.size("base") > 0)
    candidates = both.select("row", F.inline("candidates"))
    base = both.select("row", F.inline(F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"))))).select("*", buckets.alias("bucket"))
    base = base.select(F.col("row").alias("brow"), "bucket", F.col("start").alias("bstart"), F.col("end").alias("bend"))
    dealt = candidates.select("*", buckets.alias("own"))
    meet = dealt.join(base, (F.col("row") == F.col("brow")) & (F.col("own") == F.col("bucket")) & (F.col("bstart") < F.col("end")) & (F.col("start") < F.col("bend")), "left_semi")
    hit = meet.select("row", "start").distinct()
    return alone.unionByName(candidates.join(hit, ["row", "start"], "left_anti"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """One row per row of ``docs``: id and ``secrets``, array<struct<start, rank, kind, end, score>> by start and then kind.

    ``score`` is the joint p-value of ``random`` spans (high: like random), else
    null. A candidate that overlaps a base span is not reported again, nor one that may be word-like. Null and
    empty texts have no spans; repeated rows and ids stay; other columns are
    ignored, whatever their names. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        _matches(text, ASSIGN, 1, MIN_VALUE).alias("assign"),
        _matches(text, ACCESS).alias("access"),
        _matches(text, HEX).alias("hex"),
        _matches(text, CANDIDATE).alias("candidates"),
    )
    tagged = lambda spans, rank, kind: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end"), F.lit(None).cast("double").alias("score")))
    base = F.concat(*(tagged(F.col(k), i, k) for i, k in enumerate(BASE_KINDS)))
    both = lambda c, a, b: c["token"].rlike(a) & c["token"].rlike(b)
    mixed = F.filter("candidates", lambda c: both(c, "[0-9]", "[A-Za-z]") | both(c, "[a-z]", "[A-Z]") | both(c, r"\A[A-Z2-7]+=*\z", "[A-Z]"))
    found = stored(found.select("id", "row", F.sort_array(base).alias("base"), mixed.alias("candidates")), "secret-spans")
    tested = word_surprise(randomness(_apart(found)))
    tested = tested.select("row", "start", "end", F.xxhash64("token").alias("token_hash"), F.col("__p").alias("score"), "__p_word", F.floor(F.log2(F.col("end") - F.col("start"))).cast("int").alias("length_class"))
    tested = stored(tested.withColumn("bin", _rank_bin(F.col("score"))).withColumn("word_bin", _rank_bin(F.col("__p_word"))).drop("__p_word"), "secret-tests")
    structured = F.broadcast(rejected_from(tested, fdr))  # a row per power of two of length, here and below
    unlike_words = F.broadcast(rejected_from(tested, fdr, "word_bin").withColumnRenamed("from_bin", "from_word_bin"))
    kept = tested.join(structured, "length_class", "left").where(F.col("from_bin").isNull() | (F.col("bin") < F.col("from_bin")))
    kept = kept.join(unlike_words, "length_class").where(F.col("word_bin") >= F.col("from_word_bin"))
    extra = kept.groupBy("row").agg(F.collect_list(F.struct("start", F.lit(len(BASE_KINDS)).alias("rank"), F.lit("random").alias("kind"), "end", "score")).alias("extra"))
    all_spans = F.when(F.col("extra").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "extra")))
    return found.join(extra, "row", "left").select(F.col("id").alias(id_col), all_spans.alias("secrets"))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
