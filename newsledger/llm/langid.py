"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter trigram is the element-wise product of
its letters' vectors, each rotated by its place (binding); a text is the sum of its
trigrams' vectors (bundling); a language's prototype is the sum of the unit vectors of its
training texts. A text gets the language whose prototype has the largest cosine with it.

Prototypes are fitted on at most ``max_rows`` rows, chosen by a hash of their id; partial sums
per language and task combine in Spark, so the driver sees one vector a language. All
documents are compared over their whole text.

Defined results: letters are compared in lower case, anything else separates words. Text that
is null or has no letter is ``und`` with score 0; so is everything if nothing could be
learned. Rows without a language teach nothing. Ties go to the first language in code point
order. Scores are cosines, negative ones cut to 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsledger.llm.common import full_text, id_bucket, sampled

DIMENSIONS = 1024
#: Rows the prototypes are fitted on, at most.
MAX_ROWS = 20_000
#: Trigram vectors that a task remembers: 1 KB each.
REMEMBERED = 30_000
UNKNOWN = "und"


class Space:
    """Letter vectors, bound trigrams and bundled texts."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.table = np.zeros((1024, dimensions), np.int8)
        self.kinds = np.zeros(0x110000, np.uint8)  # 0 not seen yet, 1 other, 2 letter

    def letter(self, point: int) -> np.ndarray:
        """The random vector of a code point, the same in every task."""
        if point not in self.letters:
            bits = np.random.Generator(np.random.PCG64(point)).integers(
                0, 2, self.dimensions, np.int8)
            self.letters[point] = 2 * bits - 1
        return self.letters[point]

    def bound(self, code: int) -> np.ndarray:
        first, second, third = code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF
        return (np.roll(self.letter(first), 2) * np.roll(self.letter(second), 1)
                * self.letter(third))

    def _rows(self, codes: list[int]) -> list[int]:
        known = self.rows
        if len(known) > REMEMBERED:
            known.clear()
        for code in codes:
            if code not in known:
                at = len(known)
                if at == len(self.table):
                    self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                self.table[at] = self.bound(code)
                known[code] = at
        return [known[c] for c in codes]

    def trigrams(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct trigrams, packed, and how often each occurs."""
        lowered = (text or "").lower()
        points = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = self.kinds[points]
        if (kinds == 0).any():
            for p in np.unique(points[kinds == 0]).tolist():
                self.kinds[p] = 2 if chr(p).isalpha() else 1
            kinds = self.kinds[points]
        letters = kinds == 2
        if not letters.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        spaced = np.concatenate([[32], np.where(letters, points, 32), [32]]).astype(np.int64)
        gap = spaced == 32
        line = spaced[~(gap & np.concatenate([[False], gap[:-1]]))]
        packed = line[:-2] << 42 | line[1:-1] << 21 | line[2:]
        return np.unique(packed, return_counts=True)

    def bundle(self, text: str | None) -> np.ndarray | None:
        """The unit vector of a text, or None if it has no letter."""
        codes, counts = self.trigrams(text)
        if not len(codes):
            return None
        total = np.zeros(self.dimensions, np.float32)
        weights = counts.astype(np.float32)
        for at in range(0, len(codes), 4096):
            rows = self._rows(codes[at:at + 4096].tolist())
            total += weights[at:at + 4096] @ self.table[rows].astype(np.float32)
        length = float(np.linalg.norm(total))
        return total / length if length else total


def _partial_sums(batches, dimensions: int):
    """The sum of unit vectors per language within a task."""
    space, sums = Space(dimensions), {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(),
                              batch.column("text").to_pylist()):
            vector = space.bundle(text)
            if vector is not None:
                sums[lang] = sums.get(lang, 0) + vector.astype(np.float64)
    for lang, vector in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * dimensions), pa.array(np.arange(dimensions), pa.int32()),
             pa.array(vector)], ["lang", "at", "value"])


def learn(docs: DataFrame, dimensions: int = DIMENSIONS, max_rows: int = MAX_ROWS
          ) -> dict[str, np.ndarray]:
    """Unit prototypes of the languages in ``docs`` (doc_id, text, lang)."""
    rows = docs.where(docs["lang"].isNotNull()).select(
        docs["doc_id"].alias("__id"), docs["lang"].alias("lang"),
        full_text(docs["text"]).alias("text"))
    # A hash of the id thins the rows where they lie. Only if rows that repeat an id exceed
    # the bound even so do they pass through a limit.
    total = rows.count()
    chosen = rows if total <= max_rows else rows.where(
        sampled(F.xxhash64("__id"), max_rows * 19 // 20, total))
    if chosen.count() > max_rows:
        chosen = chosen.limit(max_rows)
    chosen = chosen.select("lang", "text")
    sums = (chosen.mapInArrow(lambda b: _partial_sums(b, dimensions),
                              "lang string, at int, value double")
            .groupBy("lang", "at").agg(F.sum("value").alias("value")))
    found: dict[str, np.ndarray] = {}
    for row in sums.toPandas().itertuples():
        found.setdefault(row.lang, np.zeros(dimensions))[row.at] = row.value
    return {k: v / (np.linalg.norm(v) or 1.0) for k, v in sorted(found.items())}


def predictor(prototypes: dict[str, np.ndarray]):
    """Column function: text to its language and the cosine with that prototype."""
    names = list(prototypes)

    @F.pandas_udf("lang_pred string, score double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        matrix = np.array([prototypes[n] for n in names], np.float32)
        space = Space(matrix.shape[1]) if names else None
        for texts in parts:
            made = []
            for text in texts:
                vector = space.bundle(text) if names else None
                if vector is None:
                    made.append((UNKNOWN, 0.0))
                    continue
                cosines = matrix @ vector
                best = int(np.argmax(cosines))
                made.append((names[best], float(min(1.0, max(0.0, cosines[best])))))
            yield pd.DataFrame(made, columns=["lang_pred", "score"])
    return run


def identify(docs: DataFrame, held_out: int = 2, buckets: int = 4,
             dimensions: int = DIMENSIONS, max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Ids whose crc32 (of the id as text) modulo ``buckets`` is ``held_out`` teach nothing.
    """
    held = id_bucket(docs["doc_id"], buckets) == held_out
    prototypes = learn(docs.where(~held), dimensions, max_rows)
    return docs.select(docs["doc_id"], held.alias("held_out"),
                       predictor(prototypes)(docs["text"]).alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score")
