"""The few functions that need Python, all Arrow-batched.

They run only on rows that cheap column expressions could not decide.
"""

from __future__ import annotations

from difflib import SequenceMatcher
from urllib.parse import urljoin, urlsplit

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType

from newsledger import fixed_values as fixed
from newsledger.functions import text as T
from newsledger.functions.urls import unescape_html


@pandas_udf(DoubleType())
def sequence_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Ratcliff/Obershelp ratio; the order of the arguments matters."""
    return pd.Series([SequenceMatcher(None, a, b).ratio() for a, b in zip(left, right)],
                     dtype="float64")


def ratio_or_zero(left: str, right: str, floor: float) -> float:
    """The ratio, or 0 where a cheap upper bound already lies below ``floor``."""
    match = SequenceMatcher(None, left, right)
    return match.ratio() if match.quick_ratio() >= floor else 0.0


def ratio_above(left: Column, right: Column, floor: float) -> Column:
    """``sequence_ratio`` for callers that need only values from ``floor`` upward."""
    @pandas_udf(DoubleType())
    def bounded(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([ratio_or_zero(x, y, floor) for x, y in zip(a, b)], dtype="float64")
    return bounded(left, right)


#: Longest left title of ``common_in_order``: its places are the bits of one number.
LCS_CHARS = 62


def _classes(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the characters, 64 beyond the end, and the lengths."""
    listed = texts.to_list()
    codes = np.array(listed, dtype=str)
    codes = codes.view(np.uint32).reshape(len(listed), -1)
    sizes = np.fromiter(map(len, listed), dtype=np.int64, count=len(listed))
    inside = np.arange(codes.shape[1])[None, :] < sizes[:, None]
    return np.where(inside, codes % 64, 64).astype(np.int64), sizes


@pandas_udf(IntegerType())
def common_in_order(left: pd.Series, right: pd.Series) -> pd.Series:
    """Upper bound of the characters two titles share in one order: their longest common
    subsequence, where letters of one class count as equal. One addition a character."""
    if not len(left):
        return pd.Series([], dtype="int32")
    (x, sizes), (y, _) = _classes(left), _classes(right)
    rows, one = np.arange(len(x)), np.uint64(1)
    masks = np.zeros((len(x), 65), dtype=np.uint64)
    for i in range(x.shape[1]):
        masks[rows, x[:, i]] |= one << np.uint64(i)
    masks[:, 64] = 0
    full = (one << sizes.astype(np.uint64)) - one
    gaps = full.copy()
    for j in range(y.shape[1]):
        hit = gaps & masks[rows, y[:, j]]
        gaps = ((gaps + hit) | (gaps ^ hit)) & full
    return pd.Series(sizes - np.bitwise_count(gaps).astype(np.int64)).astype("int32")


def blend(ratio: Column, jaccard: Column) -> Column:
    return F.greatest(ratio, ratio * 0.6 + jaccard * 0.4)


def title_similarity(title_a: Column, tokens_a: Column,
                     title_b: Column, tokens_b: Column) -> Column:
    return blend(sequence_ratio(title_a, title_b), T.jaccard(tokens_a, tokens_b))


def ratio_bound(length_a: Column, length_b: Column) -> Column:
    """Upper bound of the ratio from the two lengths alone."""
    total = length_a + length_b
    return F.when(total == 0, 1.0).otherwise(2.0 * F.least(length_a, length_b) / total)


#: Characters an excerpt keeps: of the page head, before and after a hit, and the gap between
#: windows that still joins them.
HEAD_CHARS, BEFORE_CHARS, AFTER_CHARS, JOIN_CHARS = 600, 320, 560, 80


def _hits(body: Column, pattern: Column) -> Column:
    """Start and end (exclusive, from 0) of each match: lengths of the pieces between the
    matches and of the matches, summed up."""
    loose = F.concat(F.lit("(?i)"), pattern)
    steps = F.arrays_zip(F.transform(F.split(body, loose, -1), F.char_length).alias("gap"),
                         F.transform(F.regexp_extract_all(body, loose, F.lit(0)), F.char_length)
                         .alias("hit"))
    start = F.struct(F.lit(0).alias("at"),
                     F.array().cast("array<struct<first:int,last:int>>").alias("spans"))

    def step(held: Column, s: Column) -> Column:
        first = held["at"] + F.coalesce(s["gap"], F.lit(0))
        last = first + F.coalesce(s["hit"], F.lit(0))
        span = F.array(F.struct(first.alias("first"), last.alias("last")))
        return F.struct(last.alias("at"), F.when(s["hit"].isNull(), held["spans"]).otherwise(
            F.concat(held["spans"], span)).alias("spans"))
    return F.aggregate(steps, start, step)["spans"]


def _joined(spans: Column) -> Column:
    """Sorted windows, those that lie close together as one."""
    none = F.array().cast("array<struct<first:int,last:int>>")

    def step(held: Column, s: Column) -> Column:
        end = F.try_element_at(held, F.lit(-1))
        wider = F.struct(end["first"].alias("first"),
                         F.greatest(end["last"], s["last"]).alias("last"))
        return F.when(s["first"] <= end["last"] + JOIN_CHARS,
                      F.concat(F.slice(held, F.lit(1), F.size(held) - 1), F.array(wider))
                      ).otherwise(F.concat(held, F.array(s)))
    return F.aggregate(F.array_sort(spans), none, step)


def excerpt(body: Column, patterns: Column, limit: int = 5000) -> Column:
    """Page head plus the text around the required patterns, up to ``limit`` characters."""
    body = T.text(body)
    size, gap = F.char_length(body), F.lit(fixed.EXCERPT_SEPARATOR)
    around = F.flatten(F.transform(patterns, lambda p: F.transform(
        _hits(body, p), lambda s: F.struct(
            F.greatest(F.lit(0), s["first"] - BEFORE_CHARS).alias("first"),
            F.least(size, s["last"] + AFTER_CHARS).alias("last")))))
    pieces = F.filter(F.transform(_joined(around), lambda s: F.regexp_replace(
        F.substring(body, s["first"] + 1, s["last"] - s["first"]), r"^\s+|\s+$", "")),
        lambda t: t != "")
    head = F.regexp_replace(F.substring(body, 1, HEAD_CHARS), r"\s+$", "")

    def add(held: Column, piece: Column) -> Column:  # the cut at the limit ends what grows past it
        return F.when(F.contains(held, piece) | (F.char_length(held) >= limit), held).otherwise(
            F.concat(held, gap, piece))
    plain = F.substring(body, 1, limit)
    return F.when((size <= limit) | (F.size(patterns) <= 0) | (F.size(pieces) == 0), plain).otherwise(
        F.substring(F.aggregate(pieces, head, add), 1, limit))


@pandas_udf(ArrayType(StringType()))
def _resolved(found: pd.Series, base: pd.Series) -> pd.Series:
    out = []
    for candidates, origin in zip(found, base):
        links = set()
        for candidate in candidates:
            link = urljoin(origin or "", candidate.strip()).rstrip(fixed.TRAILING_PUNCTUATION)
            try:
                parts = urlsplit(link)
            except ValueError:
                continue
            if parts.scheme in ("http", "https") and parts.hostname:
                links.add(link)
        out.append(sorted(links))
    return pd.Series(out, dtype="object")


def extract_links(body: Column, base: Column) -> Column:
    """Links of a body, relative ones resolved against the page address."""
    decoded = unescape_html(T.text(body))
    found = F.concat(F.regexp_extract_all(decoded, F.lit(fixed.HREF_PATTERN), 1),
                     F.regexp_extract_all(decoded, F.lit(fixed.HTTP_URL_PATTERN), 0))
    return _resolved(found, base)


def compact_prices_json(prices: Column) -> Column:
    """Render prices given as JSON text: one map, or a list of maps under conditions.

    A condition is shown as JSON with sorted keys. Values stay as JSON writes them; anything
    that is neither a map nor a list stays as it is.
    """
    one = T.compact_prices(F.from_json(prices, "map<string,string>"))
    entries = F.from_json(prices, "array<struct<constraint:string,prices:map<string,string>>>")

    def line(entry: Column) -> Column:
        rule = F.to_json(F.try_parse_json(entry["constraint"]))
        label = F.when(F.coalesce(rule, F.lit("{}")).isin("{}", "null", "\"\""), "default")
        return F.concat(F.coalesce(label, rule), F.lit(": "),
                        F.coalesce(T.compact_prices(entry["prices"]), F.lit("")))
    opens = F.substring(F.ltrim(prices), 1, 1)
    return F.when(opens == "{", one).when(
        opens == "[", F.array_join(F.transform(entries, line), " | ")).otherwise(prices)
