"""Text functions that Spark has no expression for: folds, similarity ratios, quotes."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Endings that name a legal form.
LEGAL_FORMS = {
    "ag", "gmbh", "co", "kg", "nv", "bv", "sa", "srl", "spa", "ltd", "limited", "llc", "inc", "corp", "corporation", "plc", "oy", "ab", "as", "aps", "sas", "sarl", "sl", "kft", "doo", "sp", "zoo",
    "pte", "pty",
}


def fold(name: str | None) -> str | None:
    """NFKD without combining marks, white space collapsed and tightened around . and , and case folded."""
    if name is None:
        return None
    plain = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
    return re.sub(r"\s*([.,])\s*", r"\1", " ".join(plain.split())).casefold()


def fold_actor(name: str | None) -> str | None:
    """fold(), without dots ("A.G." is "ag"), other punctuation and legal forms at the end; nothing may be left."""
    if name is None:
        return None
    words = re.sub(r"[^\w\s]", " ", fold(name.replace(".", ""))).split()
    while words and words[-1] in LEGAL_FORMS:
        words.pop()
    return " ".join(words)


def common_length(a: str, b: str) -> int:
    """The length of the longest common subsequence, 64 characters of b at a time in one integer."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    open_ = full
    for c in b:
        hit = open_ & places.get(c, 0)
        open_ = ((open_ + hit) | (open_ - hit)) & full
    return len(a) - bin(open_).count("1")


def ratio(a: str, b: str) -> float:
    """200 * common subsequence / total length; 100 for two empty texts."""
    return 200.0 * common_length(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """The best ratio among the shared words and each side's shared and own words; 100 if one side holds the other."""
    x, y = set(a.split()), set(b.split())
    both, left, right = x & y, x - y, y - x
    if both and (not left or not right):
        return 100.0
    base = " ".join(sorted(both))
    one, two = (" ".join(filter(None, [base, " ".join(sorted(s))])) for s in (left, right))
    return max(ratio(base, one), ratio(base, two), ratio(one, two)) if base else ratio(one, two)


def partial_ratio(short: str, long: str) -> float:
    """The best ratio of the shorter text with a window as long of the longer one."""
    if len(short) > len(long):
        short, long = long, short
    if not short:
        return 0.0
    return max(ratio(short, long[i : i + len(short)]) for i in range(max(1, len(long) - len(short) + 1)))


def quoted(quote: str | None, page: str | None, least: float = 95.0) -> bool:
    """Whether the page has the quote, piece by piece around ellipses; nearly, where not literally."""
    if not quote or not page:
        return False
    squeeze = lambda s: "".join(s.split()).casefold()
    text = squeeze(page)
    pieces = [squeeze(p) for p in re.split(r"\.\.\.|…", quote) if p.strip()]
    return bool(pieces) and all(p in text or partial_ratio(p, text) >= least for p in pieces)


def _one(fn):
    @F.pandas_udf("string")
    def udf(s: pd.Series) -> pd.Series:
        return s.map(fn, na_action="ignore")

    return udf


def _two(fn):
    @F.pandas_udf("double")
    def udf(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else float(fn(x, y)) for x, y in zip(a, b, strict=True)], dtype="float64")

    return udf


def fold_column(c: Column) -> Column:
    return _one(fold)(c)


def fold_actor_column(c: Column) -> Column:
    return _one(fold_actor)(c)


def ratio_column(kind: str, a: Column, b: Column) -> Column:
    """kind: ratio, token_sort_ratio, token_set_ratio or partial_ratio."""
    return _two({"ratio": ratio, "token_sort_ratio": token_sort_ratio, "token_set_ratio": token_set_ratio, "partial_ratio": partial_ratio}[kind])(a, b)


def trigrams(c: Column) -> Column:
    """The distinct three-letter pieces of the words, each padded with two spaces in front and one behind."""
    words = F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    pieces = F.transform(
        words,
        lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))),
    )
    return F.array_distinct(F.flatten(pieces))


def trigram_similarity(a: Column, b: Column) -> Column:
    """Shared trigrams over all trigrams; JVM side."""
    x, y = trigrams(a), trigrams(b)
    return F.size(F.array_intersect(x, y)) / F.nullif(F.size(F.array_union(x, y)), F.lit(0))
