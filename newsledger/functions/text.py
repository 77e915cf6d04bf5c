"""Text and title rules as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from newsledger import fixed_values as fixed
from newsledger.functions.urls import strip

_MODEL_PATTERN = r"(?iU)\b(?:" + "|".join(
    rf"{family}[-\s]?[\w.]+" for family in fixed.MODEL_FAMILIES) + r")\b"


def empty_strings() -> Column:
    return F.array().cast("array<string>")


def text(value: Column) -> Column:
    """Missing text counts as empty text."""
    return F.coalesce(value, F.lit(""))


def collapse_space(value: Column) -> Column:
    return strip(F.regexp_replace(value, r"(?U)\s+", " "))


# --- HTML ---------------------------------------------------------------------
def strip_tags(html: Column) -> Column:
    return strip(F.regexp_replace(text(html), "<[^>]+>", " "))


def visible_text(html: Column) -> Column:
    """Readable text of a page: script and style blocks go first, then tags."""
    body = F.regexp_replace(text(html), r"(?is)<(script|style)\b[^>]*>.*?</\1>", " ")
    return collapse_space(strip_tags(body))


# --- keywords -----------------------------------------------------------------
def fold_case(value: Column) -> Column:
    """Lower case with the letters that only a case-blind match would unify."""
    for letter, plain in (("ſ", "s"), ("ı", "i"), ("İ", "i")):
        value = F.replace(value, F.lit(letter), F.lit(plain))
    return F.lower(value)


def keyword_pattern(keyword: str) -> str:
    """Case-blind, not flanked by ASCII letters, digits or underscore."""
    return rf"(?iu)(?<![0-9A-Za-z_])\Q{keyword}\E(?![0-9A-Za-z_])"


def _is_word(keyword: str) -> bool:
    return keyword.isascii() and keyword.replace("_", "a").isalnum()


def words_present(folded: Column, keywords: Iterable[str]) -> Column:
    """Which of the one-word keywords occur, sorted.

    A keyword of word characters only is matched exactly when it is one of the text's words.
    The text is not cut into words: that costs far more than one search for each keyword. A
    pattern that starts with its letters lets Java skip ahead; what stands before is tested last.
    """
    words = sorted({k.lower() for k in keywords if _is_word(k)})
    tests = [F.when(folded.contains(w) & (folded.contains(f" {w} ") | folded.rlike(
        f"{w}(?<![0-9a-z_]{w})(?![0-9a-z_])")), F.lit(w)) for w in words]
    return F.array_compact(F.array(*tests)) if tests else empty_strings()


def has_keyword(value: Column, folded: Column, present: Column, keyword: str) -> Column:
    """One keyword. The substring test rules most texts out before a pattern runs."""
    if not keyword.isascii():
        # folding changes no other letters, so the text is lower-cased once for these
        same = not set(keyword.lower()) & set("siſı\u0307")
        return (folded if same else F.lower(value)).contains(keyword.lower())
    if _is_word(keyword):
        return F.array_contains(present, keyword.lower())
    return folded.contains(keyword.lower()) & value.rlike(keyword_pattern(keyword))


def keyword_hits(value: Column, folded: Column, keywords: Iterable[str],
                 present: Column | None = None) -> Column:
    """Keywords found, in keyword order. ``present`` may be computed once beforehand."""
    keywords = list(keywords)
    present = words_present(folded, keywords) if present is None else present
    tests = [F.when(has_keyword(value, folded, present, k), F.lit(k)) for k in keywords]
    return F.array_compact(F.array(*tests)) if tests else empty_strings()


def contains_any(lowered: Column, markers: Iterable[str]) -> Column:
    found = F.lit(False)
    for marker in markers:
        found = found | lowered.contains(marker.lower())
    return found


def matched_markers(lowered: Column, markers: Iterable[str]) -> Column:
    """Markers found as plain substrings, sorted and distinct."""
    marks = sorted(set(markers))
    if not marks:
        return empty_strings()
    return F.array_compact(
        F.array(*[F.when(lowered.contains(m.lower()), F.lit(m)) for m in marks]))


def marker_groups(lowered: Column, groups: Mapping[str, Iterable[str]]) -> Column:
    """Sorted names of the marker groups with at least one hit."""
    names = sorted(groups)
    if not names:
        return empty_strings()
    return F.array_compact(
        F.array(*[F.when(contains_any(lowered, groups[n]), F.lit(n)) for n in names]))


def all_patterns(value: Column, patterns: Column) -> Column:
    """Every required pattern occurs, ignoring case; true for no pattern at all."""
    return F.forall(F.coalesce(patterns, empty_strings()),
                    lambda p: F.regexp_like(value, F.concat(F.lit("(?iu)"), p)))


# --- titles -------------------------------------------------------------------
def normalized_title(title: Column) -> Column:
    return collapse_space(F.lower(text(title)))


def title_tokens(title: Column) -> Column:
    """ASCII words without stop words, and pairs of neighbouring Han characters."""
    words = F.regexp_extract_all(F.lower(title), F.lit(r"[a-z0-9][a-z0-9_.\-]*"), 0)
    words = F.filter(words, lambda w: (F.length(w) >= 2) & ~w.isin(fixed.TITLE_STOPWORDS))
    runs = F.regexp_extract_all(title, F.lit("[\\u4e00-\\u9fff]{2,}"), 0)
    pairs = F.flatten(F.transform(runs, lambda run: F.transform(
        F.sequence(F.lit(1), F.length(run) - 1), lambda i: F.substring(run, i, F.lit(2)))))
    return F.array_distinct(F.concat(words, pairs))


def jaccard(left: Column, right: Column) -> Column:
    both = F.size(F.array_intersect(left, right))
    return F.when((F.size(left) > 0) & (F.size(right) > 0),
                  both / F.size(F.array_union(left, right))).otherwise(0.0)


def title_is_mergeable(title: Column, tokens: Column) -> Column:
    return (F.length(title) >= 18) & (F.size(tokens) >= 4)


def title_vendors(title: Column) -> Column:
    low = F.lower(title)
    hits = [F.when(low.contains(alias), F.lit(name))
            for alias, name in fixed.VENDOR_ALIASES.items()]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*hits))))


def title_models(title: Column) -> Column:
    found = F.regexp_extract_all(F.lower(title), F.lit(_MODEL_PATTERN), 0)
    dashed = F.transform(found, lambda m: F.regexp_replace(m, r"(?U)\s+", "-"))
    return F.array_sort(F.array_distinct(dashed))


def _compatible(left: Column, right: Column) -> Column:
    return (F.size(left) == 0) | (F.size(right) == 0) | F.arrays_overlap(left, right)


def titles_compatible(vendors_a: Column, models_a: Column,
                      vendors_b: Column, models_b: Column) -> Column:
    """Two titles clash only when both name vendors, or models, with none in common."""
    return _compatible(vendors_a, vendors_b) & _compatible(models_a, models_b)


def title_key(title: Column) -> Column:
    words = F.regexp_extract_all(F.lower(text(title)), F.lit(r"[a-z0-9][a-z0-9_+.\-]*"), 0)
    return F.array_join(F.slice(F.filter(words, lambda w: F.length(w) > 2), 1, 20), " ")


# --- small identifiers --------------------------------------------------------
def price_match_text(value: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text(value)), "[^a-z0-9]+", " "))


def community_id(name: Column) -> Column:
    slug = F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_")
    return F.concat(F.lit("r_"), F.regexp_replace(slug, "^_+|_+$", ""))


def compact_prices(prices: Column) -> Column:
    """Render a flat price map: the usual four keys first, then the others sorted."""
    preferred = ["input_mtok", "cache_read_mtok", "cache_write_mtok", "output_mtok"]
    first = F.filter(F.array(*[F.lit(k) for k in preferred]),
                     lambda k: F.map_contains_key(prices, k))
    rest = F.array_sort(F.filter(F.map_keys(prices), lambda k: ~k.isin(preferred)))

    def part(key: Column) -> Column:
        value = F.coalesce(F.element_at(prices, key).cast("string"), F.lit("null"))
        return F.when(key.endswith("_mtok"),
                      F.concat(key, F.lit("=$"), value, F.lit("/M"))).otherwise(
            F.concat(key, F.lit("="), value))

    return F.array_join(F.transform(F.concat(first, rest), part), ", ")
