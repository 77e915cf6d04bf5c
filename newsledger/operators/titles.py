"""Exact join of similar titles.

Similarity 0.86 needs a ratio of 0.86, or a Jaccard value above 0.86.

* Ratio r = 2M/(a+b) over M matched characters. A title of length a loses at most
  2(a-M) + (b-M) bigrams against its partner, which for r >= 0.86 is at most 28/57 a. Under
  any common order the first bigram that both have lies among the first 28/57 a + 1 of each,
  the second among one more. Titles with too few distinct bigrams for the bound meet in a
  block of their own.
* Jaccard: the same argument with 0.14 of the words.

The order is by how often a bigram or word occurs in the corpus, rarest first, so blocks stay
small. A pair is dropped before its titles are read where lengths, or the places of the shared
bigram, already rule the threshold out. A block that is still too large is split by the second
shared bigram or word.

Where few titles meet at all (some hours of a day), ``signed`` titles are compared directly: bit
sets of bigrams, trigrams and words and the longest common subsequence rule nearly all pairs out
where they meet, so no candidate is written or shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from newsledger.functions import similarity as S, text as T
from newsledger.operators.barrier import computed

THRESHOLD = 0.86
#: The least ratio that equal words can lift to the threshold: (0.86 - 0.4) / 0.6.
LEAST_RATIO = 0.7666
#: 64-bit words of a title's bit sets of bigrams and of trigrams.
SET_WORDS = 8
#: Rounding of the bounds.
SLACK = 1e-6
#: Counters of bigrams and words; those that share one count together.
COUNTERS = 4096
# share of a title's bigrams that a partner at the threshold may lack: with
# M = 0.43 (a + b) and b <= 57/43 a, 2 (a - M) + (b - M) is largest for the shortest
# partner, b = 43/57 a, where it is 28/57 a
_LOST = (28, 57)


def _grams(title: Column, size: int) -> Column:
    return F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(title) - size + 1)),
        lambda i: F.substring(title, i, F.lit(size))))


def bigrams(title: Column) -> Column:
    return _grams(title, 2)


def _counter(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(COUNTERS)).cast("int")


def corpus_order(rows: DataFrame) -> Column:
    """Places of the counters by how often their bigrams and words occur in ``rows`` (title_n,
    tokens): a literal array, the rarest first."""
    terms = F.concat(bigrams(F.col("title_n")), F.col("tokens"))
    counts = dict(rows.select(F.explode(F.transform(terms, _counter)).alias("c"))
                  .groupBy("c").agg(F.count("*")).collect())
    rank = {c: i for i, c in enumerate(sorted(range(COUNTERS),
                                              key=lambda c: (counts.get(c, 0), c)))}
    return F.split(F.lit(",".join(str(rank[c]) for c in range(COUNTERS))), ",").cast("array<int>")


def _ranked(terms: Column, order: Column | None) -> Column:
    def place(t: Column) -> Column:
        return F.lit(0) if order is None else F.element_at(order, _counter(t) + 1)
    return F.transform(F.array_sort(F.transform(terms, lambda t: F.struct(
        place(t).alias("r"), F.xxhash64(t).alias("h"), t.alias("t")))), lambda x: x["t"])


def _prefixes(rows: DataFrame, order: Column | None) -> DataFrame:
    """Add ranked bigrams and words and how many of each a partner may lack. Each step is
    computed once: lambdas below refer to columns, not to the expressions behind them."""
    title, tokens = F.col("title_n"), F.col("tokens")
    rows = computed(rows, {"_grams": bigrams(title)})
    return computed(rows, {
        "_grams": _ranked(F.col("_grams"), order), "_words": _ranked(tokens, order),
        "_many": F.size("_grams"), "_length": F.length(title),
        "_lost": F.floor(F.length(title) * _LOST[0] / _LOST[1] + 1e-9).cast("int"),
        "_less": (F.size(tokens) - F.ceil(F.size(tokens) * 0.86)).cast("int")})


_PREFIX = ("_grams", "_words", "_many", "_length", "_lost", "_less")


def with_block_keys(rows: DataFrame, order: Column | None = None) -> DataFrame:
    """Add ``_keys`` of a title (title_n, tokens), of which two titles at the threshold share at
    least one, each with its place among the title's bigrams, how many follow, and how many a
    partner must have."""
    rows = _prefixes(rows, order)
    lost, many = F.col("_lost"), F.col("_many")
    first = F.transform(F.slice("_grams", F.lit(1), lost + 1), lambda g, i: F.struct(
        F.concat(F.lit("g"), g).alias("key"), i.alias("at"), (many - i - 1).alias("left"),
        (many - lost).alias("need")))

    def loose(key: Column) -> Column:
        return F.struct(key.alias("key"), F.lit(0).alias("at"), F.col("_length").alias("left"),
                        F.lit(0).alias("need"))
    weak = F.filter(F.array(loose(F.lit("weak"))), lambda _: many <= lost)
    words = F.transform(F.slice("_words", F.lit(1), F.col("_less") + 1),
                        lambda w: loose(F.concat(F.lit("w"), w)))
    return computed(rows, {"_keys": F.concat(first, weak, words)}).drop(*_PREFIX)


def split_keys(rows: DataFrame, order: Column) -> DataFrame:
    """Members of large blocks (block, key, title_n, tokens) under pairs of keys instead: two
    titles that share their first bigram or word share a second one."""
    rows = _prefixes(rows, order)
    second = F.transform(F.slice("_grams", F.lit(1), F.col("_lost") + 2),
                         lambda g: F.concat(F.lit("g"), g))
    words = F.transform(F.slice("_words", F.lit(1), F.col("_less") + 2),
                        lambda w: F.concat(F.lit("w"), w))
    alone = F.array(F.lit("+"))
    others = (F.when(F.col("key").startswith("g"), F.when(
        F.col("_many") <= F.col("_lost") + 1, F.concat(second, alone)).otherwise(second))
        .when(F.col("key") == "weak", alone)
        .otherwise(F.when(F.size("tokens") <= 1, F.concat(words, alone)).otherwise(words)))
    rows = computed(rows, {"_others": others})
    kept = [c for c in rows.columns if c not in ("key", "title_n", "tokens", "_others", "at",
                                                 "left", "need", *_PREFIX)]
    pair = F.concat_ws("\x00", F.greatest("key", "_other"), F.least("key", "_other"))
    return (rows.withColumn("_other", F.explode("_others")).where(F.col("_other") != F.col("key"))
            .select(*kept, pair.alias("key"), F.lit(0).alias("at"), F.col("length").alias("left"),
                    F.lit(0).alias("need")).distinct())


# --- direct comparison -------------------------------------------------------------
def _places(terms: Column, words: int) -> Column:
    return F.array_distinct(F.transform(
        terms, lambda t: F.pmod(F.xxhash64(t), F.lit(64 * words)).cast("int")))


def _bits(places: Column, word: int) -> Column:
    """The bits of one 64-bit word of a set."""
    mine = F.filter(places, lambda b: F.floor(b / 64) == word)
    return F.aggregate(mine, F.lit(0).cast("bigint"), lambda bits, b: bits.bitwiseOR(
        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(b, F.lit(64)).cast("int"))))


def signed(rows: DataFrame) -> DataFrame:
    """Add what direct comparison needs: length, bit sets of bigrams, trigrams and words, how many
    bits they hold, and how many words a partner may lack (-1: no words, no Jaccard value)."""
    title, tokens = F.col("title_n"), F.col("tokens")
    rows = computed(rows, {"_g": _places(_grams(title, 2), SET_WORDS),
                           "_h": _places(_grams(title, 3), SET_WORDS),
                           "_w": _places(tokens, 1)})
    sets = {f"{name}{i}": _bits(F.col(f"_{name}"), i) for name in "gh" for i in range(SET_WORDS)}
    return computed(rows, {
        **sets, "w0": _bits(F.col("_w"), 0), "g_n": F.size("_g"), "h_n": F.size("_h"),
        "w_n": F.size("_w"), "length": F.length(title),
        "less": F.when(F.size(tokens) > 0, F.size(tokens) - F.ceil(F.size(tokens) * 0.86))
        .otherwise(-1).cast("int")}).drop("_g", "_h", "_w")


SIGNED = [*[f"{name}{i}" for name in "gh" for i in range(SET_WORDS)], "w0", "g_n", "h_n", "w_n",
          "length", "less"]


def _shared(name: str, words: int) -> Column:
    both = [F.bit_count(F.col(f"x_{name}{i}").bitwiseAND(F.col(f"y_{name}{i}")))
            for i in range(words)]
    return sum(both[1:], both[0])


def _words_match(bound: Column) -> Column:
    """By their words alone: either title may lack 0.14 of them, at a ratio of 0.7666."""
    return (bound >= LEAST_RATIO) & (_shared("w", 1) >= F.greatest(
        F.col("x_w_n") - F.col("x_less"), F.col("y_w_n") - F.col("y_less")))


def _enough(name: str, shared: Column, mine: float, other: float) -> Column:
    a, b = F.col("x_length"), F.col("y_length")
    return shared + SLACK >= F.greatest(F.col(f"x_{name}_n") - (mine * a - other * b),
                                        F.col(f"y_{name}_n") - (mine * b - other * a))


def may_meet() -> Column:
    """``may_match`` without its trigrams: short enough for a join's condition."""
    bound = S.ratio_bound(F.col("x_length"), F.col("y_length"))
    return ((bound >= THRESHOLD) & _enough("g", _shared("g", SET_WORDS), 0.71, 0.29)
            ) | _words_match(bound)


def matching(pairs: DataFrame) -> DataFrame:
    """Pairs left by ``may_meet`` that ``may_match`` keeps, by their trigrams."""
    bound = S.ratio_bound(F.col("x_length"), F.col("y_length"))
    rows = computed(pairs, {"_h": _shared("h", SET_WORDS)})
    return rows.where(((bound >= THRESHOLD) & _enough("h", F.col("_h"), 0.85, 0.15))
                      | _words_match(bound)).drop("_h")


def may_match() -> Column:
    """Whether two signed titles (columns prefixed ``x_`` and ``y_``) may reach the threshold.

    With M >= 0.43 (a+b) matched characters in one order, a title of length a loses at most
    2 (a-M) + (b-M) bigrams and 3 (a-M) + 2 (b-M) trigrams. Bits shared by chance only add pairs.
    """
    a, b = F.col("x_length"), F.col("y_length")
    bound = S.ratio_bound(a, b)

    return (((bound >= THRESHOLD) & _enough("g", _shared("g", SET_WORDS), 0.71, 0.29)
             & _enough("h", _shared("h", SET_WORDS), 0.85, 0.15)) | _words_match(bound))


def nearly_equal() -> Column:
    """Three quarters of the bigrams of either title are in the other."""
    return _shared("g", SET_WORDS) * 4 >= F.greatest("x_g_n", "y_g_n") * 3


def in_order(pairs: DataFrame) -> DataFrame:
    """Pairs left by ``may_match`` with enough characters in common in one order.

    Deleting and inserting the unmatched ones is an edit script of a + b - 2M steps, and the edit
    distance is no longer than that script. It is tested first, in Spark: rows that wait for Python
    are queued on disk, so only pairs close to the threshold may get there. Titles too long for
    the bits of a number take the edit distance alone."""
    a, b = F.col("x_length"), F.col("y_length")
    lack = F.when(_words_match(S.ratio_bound(a, b)), 1 - LEAST_RATIO).otherwise(1 - THRESHOLD)
    rows = computed(pairs, {"_most": lack * (a + b) + SLACK})
    far = F.call_function("levenshtein", "x_title_n", "y_title_n",
                          F.floor(F.col("_most")).cast("int"))
    rows = computed(rows, {"_far": far}).where("_far >= 0")
    # naming the distance keeps the filter below from being pushed under it
    short = (a <= S.LCS_CHARS) & (F.col("_far") >= 0)
    rows = rows.withColumn("_common", S.common_in_order(
        F.when(short, F.col("x_title_n")).otherwise(""),
        F.when(short, F.col("y_title_n")).otherwise("")))
    return rows.where(~short | (a + b - 2 * F.col("_common") <= F.col("_most"))).drop(
        "_common", "_most", "_far")


def meet(x: DataFrame, y: DataFrame, keys: Sequence[str], condition: Column) -> DataFrame:
    """Rows of ``x`` and ``y`` (columns prefixed ``x_`` and ``y_``) that share the key columns,
    fulfil the condition and may reach the threshold by length and place."""
    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(*keys, *[F.col(c).alias(f"{name}_{c}") for c in rows.columns
                                    if c not in keys])
    bound = S.ratio_bound(F.col("x_length"), F.col("y_length"))
    room = (F.least("x_at", "y_at") + 1 + F.least("x_left", "y_left")
            >= F.greatest("x_need", "y_need"))
    word = F.col("key").startswith("w") & (bound >= LEAST_RATIO)
    return side(x, "x").join(side(y, "y"), list(keys)).where(
        condition & (word | ((bound >= THRESHOLD) & room)))


def similar(rows: DataFrame, later: str, earlier: str) -> DataFrame:
    """Keep pairs at the threshold, with their ``similarity``; ``later`` and ``earlier`` are
    structs with title_n and tokens. The ratio runs only where the lengths allow it."""
    a, b = F.col(f"{later}.title_n"), F.col(f"{earlier}.title_n")
    rows = computed(rows, {
        "_j": T.jaccard(F.col(f"{later}.tokens"), F.col(f"{earlier}.tokens")),
        "_top": S.ratio_bound(F.length(a), F.length(b))})
    rows = rows.where(S.blend(F.col("_top"), F.col("_j")) >= THRESHOLD)
    rows = rows.withColumn("_r", S.ratio_above(a, b, LEAST_RATIO))
    return (computed(rows, {"similarity": S.blend(F.col("_r"), F.col("_j"))})
            .where(F.col("similarity") >= THRESHOLD).drop("_j", "_top", "_r"))
