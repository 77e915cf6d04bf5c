"""Shared pieces of the operators on documents.

Every operator selects the columns it needs first, under names that start with two
underscores, so extra columns of any name in the input neither clash nor travel.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows in one Arrow batch: bounds a Python worker's memory where texts are long.
BATCH_ROWS = 500


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the rows that one batch brings to a Python worker, and let Spark delete shuffle
    files once the step that wrote them has ended: steps pass written tables on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def full_text(column: Column | str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII takes the quicker built-in, which is the same there."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def id_bucket(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id written as text, modulo ``buckets``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % buckets


HASHES = 1 << 63


def sampled(hashed: Column, rows: int, total: int) -> Column:
    """True for about ``rows`` of ``total`` rows, by a 64-bit hash. The share is counted in 2^-63,
    so it does not vanish however many rows there are."""
    share = max(1, min(HASHES - 1, HASHES * rows // max(1, total)))
    return hashed.bitwiseAND(F.lit(HASHES - 1)) <= share


def tasks(spark: SparkSession) -> int:
    """Partitions for steps whose work per byte is high, which Spark must not coalesce."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def same(left: DataFrame, right: DataFrame, keys: Iterable[str]) -> Column:
    """Null-safe equality on ``keys`` for a join of frames with equal column names."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def without(docs: DataFrame, losers: DataFrame, keyed: dict[str, Column]) -> DataFrame:
    """Rows of ``docs`` whose key is not in ``losers``; the columns of ``docs`` stay as they are.

    ``keyed`` maps columns of ``losers`` to expressions over ``docs``.
    """
    held = docs.withColumns(keyed)
    return held.join(losers, same(held, losers, keyed), "left_anti").select(
        *[held[f"`{c}`"] for c in docs.columns])


def one_per_key(docs: DataFrame, keyed: dict[str, Column], repeated: DataFrame) -> DataFrame:
    """Reduce rows whose key is in ``repeated`` to one row a key, the largest by all columns.

    All other rows pass without a shuffle of their own; the reduction combines on the map side.
    """
    if repeated.isEmpty():
        return docs
    held = docs.withColumns(keyed)
    hit = held.join(F.broadcast(repeated) if repeated.count() <= 100_000 else repeated,
                    same(held, repeated, keyed), "left_semi")
    single = (hit.groupBy(*[F.col(k) for k in keyed])
              .agg(F.max(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("__row"))
              .select("__row.*"))
    return without(docs, repeated, keyed).unionByName(single)


def by_group(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables with all rows of one key each, from batches that arrive sorted by ``key``."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(key).to_pylist()
        start = 0
        for i, value in enumerate(column):
            if value != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, value
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Union-find over 0..n-1 that reports the links which joined two trees."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    def roots(self) -> np.ndarray:
        while True:
            above = self.parent[self.parent]
            if np.array_equal(above, self.parent):
                return self.parent
            self.parent = above

    def link(self, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, int]]:
        roots = self.roots()
        open_ = roots[left] != roots[right]
        for a, b in zip(left[open_].tolist(), right[open_].tolist()):
            x, y = self.find(a), self.find(b)
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                yield a, b
