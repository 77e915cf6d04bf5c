"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over neighbouring words: marked positions enter the hash, the others
are ignored, so a changed word at an ignored position leaves the hash alone. Hashes of all
benchmark items at all positions meet those of every document; each hit fixes how the two
texts lie against each other, and the words around it are compared. A document is
contaminated where ``window`` aligned words in a row (all words of a shorter item) agree in
at least ``identity`` of the places. An item of fewer than 8 words is found by the hash of all
its words and must be repeated whole, word by word.

Benchmark hashes go to every task only while the benchmark text is at most
``broadcast_bytes`` long, which is checked; beyond that documents and benchmark meet in a
join on the hash. Both ways give the same result.

Defined results: words are runs of letters and digits, in lower case; in scripts written without
spaces every letter is a word. Items without a word match nothing; null text is empty.
Items with equal id and text count once; null ids take part. Empty tables give no match.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from newsledger.llm.common import full_text

#: The seeds: 1 is compared, 0 ignored. Together they miss no window of 8 to 13 words that
#: agrees in 0.8 of its places: for each way to spread the differing words, one of the seeds
#: fits between them (found by greedy search over all masks of weight 5, proven by a test).
SEEDS = ("110111", "11001011", "11111")
MIN_WORDS = 8
WINDOW, IDENTITY = 13, 0.8
#: Benchmark text that may be sent to every task.
BROADCAST_BYTES = 8_000_000
_WORD = re.compile(r"[^\W_]+")
#: Letters of scripts written without spaces: Thai, Lao, Myanmar, Khmer, kana, Bopomofo, Yi and
#: Chinese characters.
_SPACELESS = ("\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3021-\u3029\u3031-\u312f"
              "\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\ua48f\uaa60-\uaa7f"
              "\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff")
_ANY_WORD = re.compile(rf"(?![\W_])[{_SPACELESS}]|[^\W_{_SPACELESS}]+")
_ODD = [pow(0x9E3779B97F4A7C15, 2 * i + 1, 2**64) | 1 for i in range(64)]


def split_words(text: str | None) -> list[str]:
    text = (text or "").lower()
    return (_WORD if text.isascii() else _ANY_WORD).findall(text)


class Words:
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self, bound: int = 500_000):
        self.known, self.bound = {}, bound

    def __call__(self, text: str | None) -> np.ndarray:
        words = split_words(text)
        known = self.known
        if len(known) > self.bound:
            known.clear()
        try:
            return np.array([known[w] for w in words], np.uint64)
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w)
            return np.array([known[w] for w in words], np.uint64)


def seed_hashes(words: np.ndarray, seed: str) -> np.ndarray:
    """The hash of each placement of a seed over the words."""
    n = len(words) - len(seed) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, len(seed), np.uint64)
    for i, mark in enumerate(seed):
        if mark == "1":
            out += words[i:i + n] * np.uint64(_ODD[i])
            out ^= out >> np.uint64(29)
    return out * np.uint64(_ODD[40])


def overlap(doc: np.ndarray, item: np.ndarray, shift: int, window: int = WINDOW,
            identity: float = IDENTITY) -> tuple[int, int, int] | None:
    """(first word, word after the last, equal words) of the leak at this alignment.

    Word i of the item lies on word i + ``shift`` of the document.
    """
    lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
    short = len(item) < MIN_WORDS
    width = len(item) if short else min(window, len(item))
    if hi - lo < width or not width or width < MIN_WORDS and not short:
        return None
    equal = (item[lo:hi] == doc[lo + shift:hi + shift]).astype(np.int64)
    sums = np.concatenate([[0], np.cumsum(equal)])
    needed = width if short else identity * width - 1e-9
    good = np.nonzero(sums[width:] - sums[:-width] >= needed)[0]
    if not len(good):
        return None
    first, last = int(good[0]), int(good[-1]) + width
    return lo + first + shift, lo + last + shift, int(sums[last] - sums[first])


def item_seeds(words: int) -> tuple[str, ...]:
    """The seeds of an item: a short one has a single seed, all its words."""
    return SEEDS if words >= MIN_WORDS else ("1" * words,) if words else ()


def first_places(hashes: np.ndarray, seed: str) -> np.ndarray:
    """Where a document's hashes of a seed are looked up. All words of a short item agree
    wherever it lies, so its first place is enough."""
    if seed in SEEDS:
        return np.arange(len(hashes))
    return np.sort(np.unique(hashes, return_index=True)[1])


class Index:
    """Seed hashes of a bounded benchmark, for lookups inside a task."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        words = Words()
        self.ids = [i for i, _ in items]
        self.words = [words(t) for _, t in items]
        self.tables = []
        seeds = [item_seeds(len(w)) for w in self.words]
        for seed in sorted({s for own in seeds for s in own}):
            made = [seed_hashes(w, seed) if seed in own else np.zeros(0, np.uint64)
                    for w, own in zip(self.words, seeds)]
            hashes = np.concatenate([np.zeros(0, np.uint64), *made])
            item = np.repeat(np.arange(len(made)), [len(m) for m in made])
            at = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(m)) for m in made]])
            order = np.argsort(hashes, kind="stable")
            gate = np.zeros(1 << 20, bool)
            gate[(hashes >> np.uint64(44)).astype(np.int64)] = True
            self.tables.append((seed, hashes[order], item[order], at[order], gate))

    def search(self, doc: np.ndarray) -> dict[int, set[int]]:
        """Alignments to verify: item number to shifts."""
        found = defaultdict(set)
        for seed, hashes, items, places, gate in self.tables:
            own = seed_hashes(doc, seed)
            maybe = np.nonzero(gate[(own >> np.uint64(44)).astype(np.int64)])[0]
            if not len(maybe):
                continue
            left = np.searchsorted(hashes, own[maybe], "left")
            right = np.searchsorted(hashes, own[maybe], "right")
            for at, a, b in zip(maybe.tolist(), left.tolist(), right.tolist()):
                for k in range(a, b):
                    found[int(items[k])].add(at - int(places[k]))
        return found


LEAK = "struct<item_id:bigint,first_word:int,end_word:int,equal_words:int>"


def best_overlap(doc, item, shifts, window, identity):
    made = [o for s in shifts if (o := overlap(doc, item, s, window, identity))]
    return max(made, key=lambda o: (o[2], -o[0])) if made else None


def leaks(items: list[tuple[int | None, str | None]], window: int = WINDOW,
          identity: float = IDENTITY):
    """Column function: text to its leaks, the best alignment of each item."""
    @F.pandas_udf(f"array<{LEAK}>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index, words = Index(items), Words()
        for texts in parts:
            out = []
            for text in texts:
                doc = words(text)
                rows = []
                for k, shifts in index.search(doc).items():
                    best = best_overlap(doc, index.words[k], shifts, window, identity)
                    if best:
                        rows.append({"item_id": index.ids[k], "first_word": best[0],
                                     "end_word": best[1], "equal_words": best[2]})
                out.append(sorted(rows, key=lambda r: (r["item_id"] is None, r["item_id"])))
            yield pd.Series(out, dtype=object)
    return run


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(benchmark["item_id"].alias("__item"),
                            full_text(benchmark["text"]).alias("__text")).distinct()


def _bounded(items: DataFrame, limit: int) -> list | None:
    """The benchmark's rows if its text is short enough to be sent to every task."""
    size = items.agg(F.sum(F.octet_length("__text") + 16)).first()[0] or 0
    return [tuple(r) for r in items.orderBy("__item", "__text").collect()] if size <= limit else None


def _lengths(batches):
    """How many words the short items have."""
    found = {n for batch in batches for text in batch.column("__text").to_pylist()
             if 0 < (n := len(split_words(text))) < MIN_WORDS}
    yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int32())], ["n"])


def _placed(batches, short: tuple[str, ...] | None = None):
    """Seed hashes of each text with their place: item or, where the seeds of ``short`` items
    are given, document words at a hash."""
    words = Words()
    for batch in batches:
        keys, hashes, places = [], [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = words(text)
            for seed in item_seeds(len(own)) if short is None else SEEDS + short:
                made = seed_hashes(own, seed)
                at = first_places(made, seed)
                keys += [key] * len(at)
                hashes.append(made[at])
                places += at.tolist()
        flat = np.concatenate([np.zeros(0, np.uint64), *hashes]).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, batch.schema.field(0).type), pa.array(flat),
             pa.array(places, pa.int32())], ["key", "hash", "at"])


def _joined_leaks(docs: DataFrame, items: DataFrame, window: int, identity: float) -> DataFrame:
    """(doc key, item leaks) by a join on the hash, for a benchmark of any size.

    Texts are keyed by their digests; candidates are distinct (document, item, shift).
    """
    spark = docs.sparkSession
    texts = docs.select(F.md5("__text").alias("key"), "__text").distinct()
    questions = items.select(F.md5("__text").alias("key"), "__text").distinct()
    placed = "key string, hash long, at int"
    # At most MIN_WORDS - 1 lengths, so many rows a task.
    short = tuple("1" * r[0] for r in questions.select("__text").mapInArrow(_lengths, "n int")
                  .distinct().orderBy("n").collect())
    short = tuple(s for s in short if s not in SEEDS)
    left = texts.mapInArrow(lambda batches: _placed(batches, short), placed)
    right = questions.mapInArrow(_placed, placed)
    pairs = (left.alias("d").join(right.alias("b"), F.col("d.hash") == F.col("b.hash"))
             .select(F.col("d.key").alias("d"), F.col("b.key").alias("b"),
                     (F.col("d.at") - F.col("b.at")).alias("shift")).distinct())
    full = (pairs.join(texts.select(F.col("key").alias("d"), F.col("__text").alias("doc")), "d")
            .join(questions.select(F.col("key").alias("b"), F.col("__text").alias("item")), "b"))

    @F.pandas_udf("first_word int, end_word int, equal_words int")
    def verify(docs_: pd.Series, items_: pd.Series, shifts: pd.Series) -> pd.DataFrame:
        words = Words()
        rows = [overlap(words(d), words(i), s, window, identity) or (None, None, None)
                for d, i, s in zip(docs_, items_, shifts)]
        return pd.DataFrame(rows, columns=["first_word", "end_word", "equal_words"],
                            dtype="Int32")

    best = (full.select("d", "b", verify("doc", "item", "shift").alias("v"))
            .where("v.equal_words is not null").groupBy("d", "b")
            .agg(F.max(F.struct("v.equal_words", (-F.col("v.first_word")).alias("minus"),
                                "v.end_word")).alias("v")))
    return (best.join(items.select(F.md5("__text").alias("b"), "__item"), "b")
            .select("d", F.col("__item").alias("item_id"), (-F.col("v.minus")).alias("first_word"),
                    F.col("v.end_word").alias("end_word"),
                    F.col("v.equal_words").alias("equal_words")))


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
               identity: float = IDENTITY, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document and benchmark item that it repeats: doc_id, item_id, first_word,
    end_word (exclusive, in words of the document), equal_words."""
    items = _items(benchmark)
    known = _bounded(items, broadcast_bytes)
    text = full_text(docs["text"])
    if known is not None:
        found = docs.select(docs["doc_id"], F.explode(
            leaks(known, window, identity)(docs["text"])).alias("leak"))
        return found.select("doc_id", "leak.*")
    rows = docs.select(docs["doc_id"], text.alias("__text"))
    joined = _joined_leaks(rows, items, window, identity)
    return (rows.select("doc_id", F.md5("__text").alias("d")).join(joined, "d")
            .select("doc_id", "item_id", "first_word", "end_word", "equal_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  identity: float = IDENTITY, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of ``docs`` that repeat no benchmark item, with all their columns."""
    items = _items(benchmark)
    known = _bounded(items, broadcast_bytes)
    if known is not None:
        return docs.where(F.size(leaks(known, window, identity)(docs["text"])) == 0)
    key = F.md5(full_text(docs["text"]))
    rows = docs.select(docs["doc_id"], full_text(docs["text"]).alias("__text"))
    bad = (_joined_leaks(rows, items, window, identity)
           .select(F.col("d").alias("__leaky")).distinct())
    return docs.join(bad, key == bad["__leaky"], "left_anti")
