"""Text Column functions for labels and record shaping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NONWORD_PREFIX = r"^([^A-Za-z0-9_]*)"


def sentence_case(s: Column) -> Column:
    """Every word: first word character upper-case, the rest lower-case.

    A word starts at a character of [A-Za-z0-9_] and runs to the next
    whitespace; leading non-word characters of a token are kept as they are.
    Tokens and whitespace separators are kept apart, so spacing is preserved.
    """
    parts = F.split(s, r"(?<=\s)|(?=\s)")
    return F.array_join(F.transform(parts, lambda w: _word_case(w)), "")


def _word_case(w: Column) -> Column:
    pre = F.regexp_extract(w, _NONWORD_PREFIX, 1)
    k = F.length(pre)
    first = w.substr(k + 1, F.lit(1))
    rest = F.when(F.length(w) > k + 1, w.substr(k + 2, F.length(w))).otherwise(F.lit(""))
    return F.concat(pre, F.upper(first), F.lower(rest))


def ordinal(n: Column) -> Column:
    """English ordinal label: 1st 2nd 3rd 4th ... 11th 12th 13th ... 21st 22nd 23rd."""
    teen = (n % 100).between(11, 13)
    suffix = (F.when(teen, "th").when(n % 10 == 1, "st").when(n % 10 == 2, "nd").when(n % 10 == 3, "rd").otherwise("th"))
    return F.concat(n.cast("string"), suffix)
