r"""Ranked lexical search over a length-stratified index.

A document of n terms has the normaliser m = 100 - 25 + (25 * n * N) div L, where N documents
hold L terms together. It is the only way a document's length enters its score, so documents of
equal m form a stratum, in which the impact of a term depends on nothing but how often it occurs:
it is computed once for each tf and shared by all postings of that tf.

1. ``build`` reads every document once and keeps, for the terms of the queries, its postings; N,
   L and document frequencies are counted over all documents. Documents are then laid out by m,
   large strata over several partitions, and written.
2. ``search`` reads the layout in blocks of bounded size. In a block, postings are sorted by
   stratum, term and tf. The largest tf of a term in a stratum bounds its impact there; the sum
   over an item's terms bounds every score of the stratum. Each item visits strata in falling
   order of bound and stops where no score can reach its best ``k`` so far, which carry over from
   block to block. The best of all tasks are ranked together.

Items are taken in blocks of at most about ``BLOCK_BYTES`` of text, by a hash; every block of
items has an index of its own terms. All sums are exact integers.

Defined results: null text has no term; documents without a term count nowhere and are never
found. Every row of documents and of items stands for itself, repeated ones too, so a repeated
item is ranked once more. An item without terms or hits has no row. Equal scores go by doc_id,
null last. Empty tables give empty results.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from newsledger.llm.common import LOWER, UPPER, full_text, tasks
from newsledger.session import materialize

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWERED = str.maketrans(UPPER, LOWER)
TOP = 20
#: Text of items that one pass over the documents serves.
BLOCK_BYTES = 8 << 20
#: Postings, and (stratum, term) cells, that a task holds at once.
BLOCK_POSTINGS, BLOCK_CELLS = 2_000_000, 4_000_000

ORACLE = rf"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
d AS (SELECT r, doc_id, len(ts) AS n FROM t WHERE len(ts) > 0),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM d),
q AS (
  SELECT item, item_id, term, count(*) AS times FROM (
    SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
f AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM t)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM f GROUP BY term), c),
s AS (
  SELECT item, item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf)
    // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // total)))) AS BIGINT) AS score
  FROM q JOIN f USING (term) JOIN w USING (term) JOIN d USING (r), c GROUP BY ALL),
k AS (
  SELECT *, CAST(row_number() OVER (
    PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= {TOP}
"""


def terms(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(_LOWERED))


@dataclass
class Index:
    """Documents in order of m: doc_id, m, and the numbers and tf of their query terms."""
    rows: DataFrame
    numbers: dict[str, int]
    weights: np.ndarray


def _binary(values: list[np.ndarray]) -> pa.Array:
    return pa.array([v.tobytes() for v in values], pa.binary())


def _postings(batches: Iterable[pa.RecordBatch], numbers: dict[str, int]):
    for batch in batches:
        ids, sizes, whats, tfs = [], [], [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                batch.column("text").to_pylist()):
            found = terms(text)
            if not found:
                continue
            held = sorted((numbers[t], n) for t, n in Counter(found).items() if t in numbers)
            ids.append(doc_id)
            sizes.append(len(found))
            whats.append(np.array([t for t, _ in held], np.int32))
            tfs.append(np.array([n for _, n in held], np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(range(len(ids)), pa.int32()),
             pa.array(sizes, pa.int64()), _binary(whats), _binary(tfs)],
            ["doc_id", "place", "n", "terms", "tfs"])


def _counts(batches: Iterable[pa.RecordBatch], size: int):
    """Documents per term; at the two numbers after the terms, documents and their lengths."""
    total = np.zeros(size + 2, np.int64)
    for batch in batches:
        packed = b"".join(batch.column("terms").to_pylist())
        total[:size] += np.bincount(np.frombuffer(packed, np.int32), minlength=size)
        total[size] += batch.num_rows
        total[size + 1] += sum(batch.column("n").to_pylist())
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])],
                                     ["number", "count"])


def build(docs: DataFrame, vocabulary: Iterable[str]) -> Index:
    """Index every document of ``docs`` (doc_id, text) for the terms of ``vocabulary``."""
    spark = docs.sparkSession
    numbers = {t: i for i, t in enumerate(sorted(set(vocabulary)))}
    size = len(numbers)
    postings = materialize(
        docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                    full_text(docs["text"]).alias("text"))
        .mapInArrow(lambda b: _postings(b, numbers),
                    "doc_id long, place int, n long, terms binary, tfs binary"))
    counted = dict(
        postings.select("n", "terms")
        .mapInArrow(lambda b: _counts(b, size), "number long, count long")
        .groupBy("number").agg(F.sum("count")).collect())
    whole, length = counted.get(size, 0), counted.get(size + 1, 0)
    weights = np.array([math.floor(1000 * math.log((2 * whole + 2) / (2 * counted[i] + 1)))
                        if i in counted else 0 for i in range(size)], np.int64)
    m = F.expr(f"100 - 25 + (cast(n as decimal(19)) * cast({25 * whole} as decimal(19)))"
               f" div cast({max(1, length)} as decimal(19))")
    rows = materialize(
        postings.select("doc_id", m.cast("long").alias("m"), "place", "terms", "tfs")
        .repartitionByRange(tasks(spark), "m", F.xxhash64("doc_id", "place"))
        .sortWithinPartitions("m").drop("place"))
    return Index(rows, numbers, weights)


class Best:
    """The best documents of an item so far; ``least`` is what a score must reach to enter."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.nulls = np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        fit = scores >= self.least
        if not fit.any():
            return
        scores = np.concatenate([self.scores, scores[fit]])
        ids, nulls = np.concatenate([self.ids, ids[fit]]), np.concatenate([self.nulls, nulls[fit]])
        first = np.lexsort((ids, nulls, -scores))[:self.k]
        self.scores, self.ids, self.nulls = scores[first], ids[first], nulls[first]
        if len(first) == self.k:
            self.least = int(self.scores[-1])


class Strata:
    """The postings of a block of documents, ordered by m, by stratum, term and tf."""

    def __init__(self, ids: list, m: list, whats: list[bytes], tfs: list[bytes], size: int):
        self.nulls = np.array([i is None for i in ids], bool)
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)
        norm = np.array(m, np.int64)
        first = np.flatnonzero(np.concatenate([[True], norm[1:] != norm[:-1]]))
        self.edges = np.append(first, len(norm))
        stratum = np.repeat(np.arange(len(first)), np.diff(self.edges))
        what, tf = (np.frombuffer(b"".join(x), np.int32) for x in (whats, tfs))
        doc = np.repeat(np.arange(len(ids)), [len(w) // 4 for w in whats])
        place = stratum[doc]
        order = np.lexsort((tf, what, place))
        what, tf, place = what[order], tf[order].astype(np.int64), place[order]
        cell = place * size + what
        runs = np.flatnonzero(np.concatenate(
            [[True], (cell[1:] != cell[:-1]) | (tf[1:] != tf[:-1])])[:len(cell)])
        # one impact for each (stratum, term, tf)
        impact = 1_000_000_000 * tf[runs] // (1000 * tf[runs] + 12 * norm[first][place[runs]])
        self.impacts = np.repeat(impact, np.diff(np.append(runs, len(cell))))
        self.docs = doc[order] - first[place]
        cells = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])[:len(cell)])
        ends = np.append(cells[1:], len(cell))
        self.starts = np.full(len(first) * size, -1, np.int64)
        self.stops = np.zeros(len(first) * size, np.int64)
        self.most = np.zeros(len(first) * size, np.int64)
        self.starts[cell[cells]], self.stops[cell[cells]] = cells, ends
        self.most[cell[cells]] = self.impacts[ends - 1]  # tf rises within a cell
        self.starts, self.stops, self.most = (
            x.reshape(len(first), size) for x in (self.starts, self.stops, self.most))

    def visit(self, what: np.ndarray, gains: np.ndarray, best: Best) -> int:
        """Score an item against the strata that may hold one of its best; how many did."""
        bounds, visits = self.most[:, what] @ gains, 0
        for s in np.argsort(-bounds, kind="stable").tolist():
            if bounds[s] < best.least:
                break
            visits += 1
            low, high = self.edges[s], self.edges[s + 1]
            scores = np.zeros(high - low, np.int64)
            for a, b, gain in zip(self.starts[s, what].tolist(), self.stops[s, what].tolist(),
                                  gains.tolist()):
                if a >= 0:
                    scores[self.docs[a:b]] += gain * self.impacts[a:b]
            best.add(scores, self.ids[low:high], self.nulls[low:high])
        return visits


def _best(batches: Iterable[pa.RecordBatch], queries: list[tuple[int, np.ndarray, np.ndarray]],
          size: int, k: int, postings: int, cells: int):
    """The best documents of each item among a task's, as (item, doc_id, score)."""
    found = [Best(k) for _ in queries]
    ids, norms, whats, tfs, held, strata = [], [], [], [], 0, 0

    def settle() -> None:
        block = Strata(ids, norms, whats, tfs, size)
        for (_, what, gains), best in zip(queries, found):
            block.visit(what, gains, best)

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "m", "terms", "tfs"))):
            new = not norms or norms[-1] != row[1]
            if norms and (held > postings or (new and (strata + 1) * size > cells)):
                settle()
                ids, norms, whats, tfs, held, strata, new = [], [], [], [], 0, 0, True
            for kept, value in zip((ids, norms, whats, tfs), row):
                kept.append(value)
            held += len(row[2]) // 4
            strata += new
    if norms:
        settle()
    for (item, _, _), best in zip(queries, found):
        n = len(best.scores)
        yield pa.RecordBatch.from_arrays(
            [pa.array([item] * n, pa.int64()), pa.array(best.ids, mask=best.nulls),
             pa.array(best.scores)], ["item", "doc_id", "score"])


def search(index: Index, items: list[tuple[int, str | None]], k: int = TOP,
           postings: int = BLOCK_POSTINGS, cells: int = BLOCK_CELLS) -> DataFrame:
    """(item, rank, doc_id, score): the ``k`` best documents for each numbered text."""
    size, queries = len(index.numbers), []
    for item, text in items:
        held = sorted((index.numbers[t], n) for t, n in Counter(terms(text)).items()
                      if t in index.numbers)
        what = np.array([t for t, _ in held], np.int64)
        gains = np.array([n for _, n in held], np.int64) * index.weights[what]
        if gains.any():
            queries.append((item, what[gains > 0], gains[gains > 0]))
    found = index.rows.mapInArrow(
        lambda b: _best(b, queries, size, k, postings, cells) if queries else iter(()),
        "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(),
                                               F.col("doc_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item", "rank", "doc_id", "score"))


def rank(docs: DataFrame, items: DataFrame, k: int = TOP,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best of all documents for each row of items
    (item_id, text)."""
    spark = docs.sparkSession
    asked = materialize(items.select(items["item_id"].alias("item_id"),
                                     full_text(items["text"]).alias("text")))
    kind = asked.schema["item_id"].dataType
    blocks = 1 + (asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes
    made = None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        index = build(docs, (t for r in rows for t in terms(r.text)))
        names = spark.createDataFrame(
            [(i, r.item_id) for i, r in enumerate(rows)],
            f"item long, item_id {kind.simpleString()}")
        found = search(index, [(i, r.text) for i, r in enumerate(rows)], k)
        found = found.join(F.broadcast(names), "item").select(
            "item_id", "rank", "doc_id", "score")
        made = found if made is None else made.unionByName(found)
    return made
