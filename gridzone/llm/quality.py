"""Quality rules: hashed n-gram log-likelihood ratio of trusted text against the raw corpus. DataFrame functions only.

Words and word pairs are hashed into ``buckets`` bins. Two multinomials over
the bins are counted: one over all trusted documents, one over all documents. A document's score is the mean over its n-grams of
log p_trusted - log p_raw (length-normalised). The threshold follows from the
scores of the trusted documents and the document's length; it is rounded, so it
does not depend on the order of sums, and nothing is drawn at random.

Counting explodes bins and sums them map-side: a task sends at most one row per
bin. The table of log ratios has ``buckets`` floats whatever the corpus; it
reaches the scoring passes as a scalar subquery, so each is one scan. Trusted ids
grow with the corpus: they are counted and broadcast up to ``BROADCAST_IDS``, beyond
that the joins shuffle. Texts meet them once, for the counts; for the threshold the
scores do, two numbers a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridzone.llm.common import WS_CLASS
from gridzone.operators.joins import sized_broadcast

BUCKETS = 1 << 14
#: Trusted ids broadcast at most; more are joined by shuffle, all the same.
BROADCAST_IDS = 1_000_000
SYMBOLS = r"[#*$%&|<>]"
#: Base rules: fewest words, and the largest share (percent) of words in repeated 5-word windows.
MIN_WORDS, REPEAT_WORDS, MAX_REPEAT_PERCENT = 10, 5, 20
#: A document is rejected when its score is over SPREADS standard deviations below the mean score of trusted documents,
#: less SHORT / sqrt(n-grams), the spread that a short text has by chance.
SPREADS, SHORT = 4, 0.35


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WS_CLASS + "+"), lambda w: w != "")


def _word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _bins(hashes: Column, buckets: int) -> Column:
    """The bins of all words, then of all pairs of neighbours."""
    n = F.size(hashes)
    pairs = F.zip_with(F.slice(hashes, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(hashes, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast("int"))
    return F.concat(F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int")), pairs)


def trusted_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """All ids labelled good and not toxic, each once."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).select(F.col(id_col).alias("trusted_id")).where("trusted_id is not null")
    return good.distinct()


def log_ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """One row: ``ratios``, an array of log p_trusted - log p_raw for each bin, both add-one smoothed."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marked = own.join(trusted, F.col("id") == F.col("trusted_id"), "left").select(_word_hashes(F.col("text")).alias("hashes"), F.col("trusted_id").isNotNull().alias("good"))
    counts = marked.select(F.explode(_bins(F.col("hashes"), buckets)).alias("bin"), "good").groupBy("bin").agg(F.count("*").alias("raw"), F.count_if("good").alias("good"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bin")).join(counts, "bin", "left").select("bin", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("raw", F.lit(0)).alias("raw"))
    lists = every.agg(F.sort_array(F.collect_list(F.struct("bin", "good", "raw"))).alias("bins"), F.sum("good").alias("goods"), F.sum("raw").alias("raws"))  # bins in order, all of them
    ratio = F.transform("bins", lambda b: F.when(F.col("goods") == 0, F.lit(0.0)).otherwise(F.log((b["good"] + 1) / (F.col("goods") + buckets)) - F.log((b["raw"] + 1) / (F.col("raws") + buckets))).cast("float"))
    return lists.select(ratio.alias("ratios"))


def _repeat_words(n: int) -> Column:
    """Number of words within n-word windows that occur twice or more, from the sorted positions in __starts."""
    return F.aggregate(
        F.col("__starts"),
        F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-n).alias("last")),
        lambda a, s: F.struct((a["sum"] + F.least(F.lit(n), s - a["last"])).cast("long").alias("sum"), s.alias("last")),
        lambda a: a["sum"],
    )


def base_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with __hashes and the counts __n_words, __word_chars, __n_symbols, __n_dup_lines, __n_repeat_words."""
    text, k = F.coalesce(F.col(text_col), F.lit("")), REPEAT_WORDS
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    out = docs.withColumn("__words", words(text)).withColumn("__hashes", F.transform("__words", lambda w: F.xxhash64(w))).withColumn("__lines", lines)
    n = F.size("__hashes")
    window = lambda i: F.xxhash64(F.slice("__hashes", i, F.lit(k)))
    out = out.withColumn("__window_hashes", F.when(n >= k, F.transform(F.sequence(F.lit(1), n - (k - 1)), window)).otherwise(F.array().cast("array<bigint>")))
    repeats = F.size(F.array_distinct("__window_hashes")) < F.size("__window_hashes")
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    out = out.withColumn("__sorted", F.when(repeats, F.sort_array(F.transform("__window_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(none))
    same = lambda x, j: F.get(F.col("__sorted"), j)["h"] == x["h"]
    twice = F.filter("__sorted", lambda x, j: F.coalesce(same(x, j - 1), F.lit(False)) | F.coalesce(same(x, j + 1), F.lit(False)))
    out = out.withColumn("__starts", F.sort_array(F.transform(twice, lambda x: x["i"])))
    out = out.withColumn("__n_words", n.cast("long")).withColumn("__word_chars", F.char_length(F.array_join("__words", "")).cast("long"))
    out = out.withColumn("__n_symbols", F.regexp_count(text, F.lit(SYMBOLS)).cast("long"))
    out = out.withColumn("__n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
    return out.withColumn("__n_repeat_words", _repeat_words(k)).drop("__words", "__lines", "__window_hashes", "__sorted", "__starts")


def _scored(docs: DataFrame, ratios: Column, buckets: int) -> DataFrame:
    """``docs``, which has __hashes, with __n_grams and __score."""
    out = docs.withColumn("__bins", _bins(F.col("__hashes"), buckets)).withColumn("__ratios", ratios)
    total = F.aggregate("__bins", F.lit(0.0), lambda a, b: a + F.get("__ratios", b))
    out = out.withColumn("__n_grams", F.size("__bins")).withColumn("__total", total).drop("__bins", "__ratios")
    return out.withColumn("__score", F.when(F.col("__n_grams") > 0, F.col("__total") / F.col("__n_grams")).otherwise(F.lit(0.0))).drop("__total")


def lowest_score(docs: DataFrame, trusted: DataFrame, ratios: Column, id_col: str, text_col: str, buckets: int) -> DataFrame:
    """One row: ``lowest``, the threshold for long texts, from the scores of the trusted documents with enough words."""
    own = docs.select(F.col(id_col).alias("id"), _word_hashes(F.col(text_col)).alias("__hashes"))
    scores = _scored(own, ratios, buckets).select("id", "__n_grams", "__score")
    scores = scores.join(trusted, F.col("id") == F.col("trusted_id"))  # a semi join would be pushed below the scores and shuffle texts
    enough = F.when(F.col("__n_grams") >= 2 * MIN_WORDS - 1, F.col("__score"))
    return scores.agg(F.coalesce(F.round(F.avg(enough) - SPREADS * F.stddev_pop(enough), 4), F.lit(0.0)).alias("lowest"))


def _judged(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, buckets: int) -> DataFrame:
    """``row`` (a row of ``docs``, whatever its columns are called) with its counts, __score, __base_failed and __kept."""
    trusted = sized_broadcast(trusted_ids(labels), BROADCAST_IDS)[0]
    ratios = log_ratios(docs, trusted, id_col, text_col, buckets).scalar()
    lowest = lowest_score(docs, trusted, ratios, id_col, text_col, buckets).scalar()
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(text_col).alias("text"))
    counted = _scored(base_counts(rows), ratios, buckets)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_grams", "score"]
    # One row each through a generator: filters on the results stay above it. Pushed below, they would pull the array
    # expressions into one another and compute them once per element.
    one = F.explode(F.array(F.struct(*(F.col(f"__{n}").alias(n) for n in names))))
    out = counted.withColumn("__q", one).select("row", *(F.col(f"__q.{n}").alias(f"__{n}") for n in names))
    failed = (F.col("__n_words") < MIN_WORDS) | (100 * F.col("__n_repeat_words") > MAX_REPEAT_PERCENT * F.col("__n_words"))
    good = F.col("__score") >= lowest - SHORT / F.sqrt(F.greatest("__n_grams", F.lit(1)))
    return out.withColumn("__base_failed", failed).withColumn("__kept", ~failed & good).drop("__n_grams")


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``docs`` with the base counts, __score, __base_failed and __kept; rows and other columns stay as they are, but
    columns with one of these names are replaced.

    Null and empty texts have no words, so they fail the base rule; their score
    is 0. Repeated rows are each counted and each judged. Without trusted
    documents every score is 0 and only the base rule rejects. An empty table
    gives no rows. ``labels`` has doc_id, quality and toxic.
    """
    out = _judged(docs, labels, id_col, text_col, buckets)
    added = [c for c in out.columns if c != "row"]
    return out.select(*(F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in added), *added)


def kept(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, with their own columns alone, whatever these are called."""
    out = _judged(docs, labels, id_col, text_col, buckets).where("__kept")
    return out.select(*(F.col("row")[c].alias(c) for c in docs.columns))
