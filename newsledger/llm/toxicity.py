"""Toxicity: a weighted lexicon matched by Aho-Corasick, normalised by text length.

Folding first undoes disguises: compatibility forms, look-alike Cyrillic and Greek letters
and digits that stand for letters. The lexicon holds words and word beginnings whose share of
toxic documents is far above their share of clean ones, weighted by the log of that ratio;
it is learned from labelled rows. Phrases of a lexicon match and a neighbouring word that
are seen mostly in clean text are exceptions: a match inside one does not count. A logistic
curve over the summed weights, in total and per word, gives the score.

What is fitted is fitted on at most ``max_rows`` labelled rows, chosen by a hash of their id;
every document is scored over its whole text.

Defined results: null and empty texts have no match and get the score of a text without any;
labels that are null are left out, repeated labels of one id count as toxic if one says
so. Without labels of both kinds the score is the share of toxic labels (0 if there are none).
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from newsledger.llm.common import full_text, id_bucket
from newsledger.session import materialize

#: Labelled rows the lexicon and the curve are fitted on, at most.
MAX_ROWS = 20_000
#: Entries and exceptions that a lexicon keeps, the clearest first.
MAX_ENTRIES, MAX_EXCEPTIONS = 500, 500
#: Ratio of shares, and gap in standard deviations, that an entry must have.
RATIO, GAP = 5, 6
#: Lengths of word beginnings that may become entries.
STEMS = range(4, 9)

# Look-alike letters and digits, and the Latin letters they stand for.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s",
    "ј": "j", "һ": "h", "к": "k", "м": "m", "т": "t", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "τ": "t", "υ": "u",
    "χ": "x", "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t",
}
FOLD = str.maketrans(LOOKALIKES)
_SIGNS = re.compile(r"(?<=[^\W\d_])[@$](?=[^\W\d_])")
_WORD = re.compile(r"[^\W_]+")


def fold(text: str | None) -> str:
    """Lower case, compatibility forms, look-alikes and digits undone."""
    text = text or ""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    if "@" in text or "$" in text:
        text = _SIGNS.sub(lambda m: "a" if m[0] == "@" else "s", text)
    return text.lower().translate(FOLD)


@dataclass
class Model:
    """Entries (``word`` or ``stem*``) with weights, exceptions, and the fitted curve."""
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)
    base: float = 0.0

    def automaton(self):
        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            stem = entry.rstrip("*")
            found.add_word(stem, found.get(stem, ()) + ((len(stem), entry != stem, weight),))
        if self.weights:
            found.make_automaton()
        return found


def _neighbours(text: str, start: int, end: int) -> tuple[str, str, str]:
    """The word at a match and the words beside it."""
    while end < len(text) and text[end].isalnum():
        end += 1
    before = _WORD.findall(text[max(0, start - 40):start])
    after = _WORD.search(text, end, end + 40)
    return (before[-1] if before else "", text[start:end], after[0] if after else "")


def matches(text: str, model: Model, automaton) -> Iterator[tuple[int, int, float]]:
    """(start, end, weight) of the heaviest entry at each word of a folded text."""
    if not model.weights:
        return
    best: dict[int, tuple[int, float]] = {}
    for last, entries in automaton.iter(text):
        for length, is_stem, weight in entries:
            start = last - length + 1
            if start and text[start - 1].isalnum():
                continue
            if not is_stem and last + 1 < len(text) and text[last + 1].isalnum():
                continue
            if weight > best.get(start, (0, 0.0))[1]:
                best[start] = (last + 1, weight)
    for start, (end, weight) in sorted(best.items()):
        if model.exceptions:
            before, word, after = _neighbours(text, start, end)
            if f"{before} {word}" in model.exceptions or f"{word} {after}" in model.exceptions:
                continue
        yield start, end, weight


def features(text: str | None, model: Model, automaton) -> tuple[float, float]:
    """Logs of the summed weights, in total and per hundred words."""
    folded = fold(text)
    total = sum(w for *_, w in matches(folded, model, automaton))
    if not total:
        return 0.0, 0.0
    return math.log1p(total), math.log1p(100 * total / (folded.count(" ") + 1))


def scorer(model: Model):
    """Column function: text to a score between 0 and 1."""
    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = model.automaton()
        bias, total, rate = model.curve
        for texts in parts:
            if model.curve == (0.0, 0.0, 0.0):
                yield pd.Series([model.base] * len(texts), dtype=float)
                continue
            made = np.array([features(t, model, automaton) for t in texts]).reshape(-1, 2)
            yield pd.Series(1 / (1 + np.exp(-(bias + total * made[:, 0] + rate * made[:, 1]))))
    return run


# ---- learning

def _entries(text: str) -> set[str]:
    words = {w for w in _WORD.findall(text) if len(w) > 2}
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) >= n}


def _count_entries(batches):
    """Toxic and clean documents with each entry; combined within a task."""
    counts = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(),
                               batch.column("toxic").to_pylist()):
            counts[toxic].update(_entries(fold(text)))
    for toxic, found in enumerate(counts):
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()),
             pa.array([n * toxic for n in found.values()], pa.int64()),
             pa.array([n * (1 - toxic) for n in found.values()], pa.int64())],
            ["entry", "toxic", "clean"])


def _may_mark(n_toxic: int, n_clean: int, support: int) -> Column:
    """The tests of ``rate`` as a condition on the columns toxic and clean, a hair wider."""
    a, b, share = F.col("toxic"), F.col("clean"), n_toxic / (n_toxic + n_clean)
    weight = F.log((a + 0.5) / (n_toxic + 1)) - F.log((b + 0.5) / (n_clean + 1))
    gap = a - (a + b) * share
    spread = F.sqrt((a + b) * (share * max(1e-9, 1 - share)))
    return (a >= support) & (weight >= math.log(RATIO) - 1e-6) & (gap >= (GAP - 1e-6) * spread)


def _places(batches, known: frozenset[str]):
    """The entries of each toxic text, which is named by its hash."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        found = [sorted(known & _entries(fold(t))) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [pa.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) >> 1
                       for t in texts], pa.int64()), pa.array(found, pa.list_(pa.string()))],
            ["name", "entries"])


def _surroundings(batches, model: Model):
    """Documents with each phrase around a match, by label."""
    automaton = model.automaton()
    counts = Counter()
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(),
                               batch.column("toxic").to_pylist()):
            folded, seen = fold(text), set()
            for start, end, _ in matches(folded, model, automaton):
                before, word, after = _neighbours(folded, start, end)
                seen |= {f"{before} {word}"} if before else set()
                seen |= {f"{word} {after}"} if after else set()
            counts.update((phrase, toxic) for phrase in seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in counts], pa.string()),
         pa.array([int(k[1]) for k in counts], pa.int64()),
         pa.array(list(counts.values()), pa.int64())], ["entry", "toxic", "n"])


def _training_features(batches, model: Model):
    automaton = model.automaton()
    for batch in batches:
        made = [features(t, model, automaton) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([m[0] for m in made], pa.float64()),
             pa.array([m[1] for m in made], pa.float64()), batch.column("toxic")],
            ["total", "rate", "toxic"])


def rate(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int
         ) -> list[tuple[str, float]]:
    """Entries that mark toxic documents with their weight, the log ratio of the two shares.

    An entry needs a ratio of 5 and a gap that chance does not explain (z of 6). Clearest gaps
    come first, of equal ones the longer entry.
    """
    rated = []
    for entry, a in toxic.items():
        b = clean.get(entry, 0)
        weight = math.log((a + 0.5) / (n_toxic + 1)) - math.log((b + 0.5) / (n_clean + 1))
        share = (a + b) / (n_toxic + n_clean)
        spread = math.sqrt(n_toxic * share * max(1e-9, 1 - n_toxic / (n_toxic + n_clean)))
        z = (a - n_toxic * share) / max(spread, 1e-9)
        if weight >= math.log(RATIO) and z >= GAP:
            rated.append((-round(z, 6), -len(entry.rstrip("*")), entry, weight))
    return [(entry, weight) for *_, entry, weight in sorted(rated)]


def choose(rated: list[tuple[str, float]], found_in: dict[str, set[int]], support: int,
           max_entries: int = MAX_ENTRIES) -> dict[str, float]:
    """The lexicon: entries in order of their gap that each explain documents of their own.

    ``found_in`` has the different toxic texts of each entry. An entry must occur in
    ``support`` texts that fewer than two entries before it explain; words that only share a
    few copied texts with real ones drop out. Entries that begin alike explain once.
    """
    kept: dict[str, float] = {}
    explained: Counter = Counter()
    for entry, weight in rated:
        texts, stem = found_in.get(entry, set()), entry.rstrip("*")
        alike = set().union(*(found_in[k] for k in kept
                              if k.rstrip("*").startswith(stem) or stem.startswith(k.rstrip("*"))))
        fresh = [t for t in texts - alike if explained[t] < 2]
        if len(fresh) < support:
            continue
        kept[entry] = weight
        explained.update(texts - alike)
        if len(kept) == max_entries:
            break
    return kept


def fit_curve(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, float, float]:
    """Logistic regression on two features by Newton steps, lightly penalised."""
    rows = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -30, 30)))
        grad = rows.T @ (p - y) + 0.01 * beta
        hess = (rows * (p * (1 - p))[:, None]).T @ rows + 0.01 * np.eye(3)
        step = np.linalg.solve(hess, grad)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def learn(docs: DataFrame, labels: DataFrame, lexicon: dict[str, float] | None = None,
          exceptions: Sequence[str] = (), max_rows: int = MAX_ROWS) -> Model:
    """Fit a model on the documents that ``labels`` (doc_id, toxic) covers.

    ``lexicon`` and ``exceptions`` add given entries and phrases to those learned.
    """
    chosen = (labels.where(labels["doc_id"].isNotNull() & labels["toxic"].isNotNull())
              .groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").alias("__toxic"))
              .orderBy(F.xxhash64("__id"), "__id").limit(max_rows))
    # At most max_rows pairs of an id and a label: a proven bound for the broadcast.
    rows = materialize(docs.select(docs["doc_id"].alias("__id"), full_text(docs["text"])
                                   .alias("text"))
                       .join(F.broadcast(chosen), "__id")
                       .select("text", (F.col("__toxic") > 0).cast("int").alias("toxic")))
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Model(base=float(n_toxic > 0))
    support = max(3, n_toxic // 200)
    # Every entry is tested where it is counted; what leaves passes the tests.
    counted = (rows.mapInArrow(_count_entries, "entry string, toxic long, clean long")
               .groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
               .where(_may_mark(n_toxic, n_clean, support)).collect())
    rated = rate({r["entry"]: r["toxic"] for r in counted},
                 {r["entry"]: r["clean"] for r in counted}, n_toxic, n_clean)
    marks = frozenset(entry for entry, _ in rated)
    found_in: dict[str, set[int]] = defaultdict(set)
    for name, entries in (rows.where("toxic = 1")
                          .mapInArrow(lambda b: _places(b, marks),
                                      "name long, entries array<string>").collect()):
        for entry in entries:
            found_in[entry].add(name)
    weights = choose(rated, found_in, support)
    weights.update({fold(k): v for k, v in (lexicon or {}).items()})
    bare = Model(weights, frozenset(fold(p) for p in exceptions))
    around = defaultdict(lambda: [0, 0])
    phrases = (rows.mapInArrow(lambda b: _surroundings(b, bare),
                               "entry string, toxic long, n long")
               .groupBy("entry").agg(F.sum(F.col("n") * F.col("toxic")).alias("t"),
                                     F.sum(F.col("n") * (1 - F.col("toxic"))).alias("c"))
               .where((F.col("c") >= 5) & (F.col("c") * F.lit(n_toxic / n_clean)
                                           > 2 * F.col("t")))
               .orderBy(F.desc("c"), "entry").limit(MAX_EXCEPTIONS))
    model = Model(weights, bare.exceptions | {r["entry"] for r in phrases.collect()})
    fitted = rows.mapInArrow(lambda b: _training_features(b, model),
                             "total double, rate double, toxic int").toPandas()
    curve = fit_curve(fitted[["total", "rate"]].to_numpy(), fitted["toxic"].to_numpy(float))
    return Model(model.weights, model.exceptions, curve, n_toxic / (n_toxic + n_clean))


# ---- operators

def score_documents(docs: DataFrame, labels: DataFrame, held_out: int = 0,
                    buckets: int = 5) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Labels are learned only from ids whose crc32 (of the id as text) modulo ``buckets`` is not
    ``held_out``.
    """
    model = learn(docs, labels.where(id_bucket(labels["doc_id"], buckets) != held_out))
    scored = docs.select(docs["doc_id"],
                         (id_bucket(docs["doc_id"], buckets) == held_out).alias("held_out"),
                         scorer(model)(docs["text"]).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def reject(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score stays below the threshold, with all their columns."""
    return docs.where(scorer(learn(docs, labels))(docs["text"]) < threshold)
