"""Mix sources to target weights. DataFrame functions only.

Words per source are summed (combined on the map side), targets follow from the sums, and
each document is taken floor(rate) times plus once more where a hash of its id, read as a
number between 0 and 1, falls below the fraction of the rate. Equal ids decide equally, and
a rerun decides as before.

Targets: sources in code point order (null last) weigh 1, 2, 3, 1, ... and share all words
by weight. No target exceeds ``most`` times its source; the excess goes to the others by
weight until none is above. That is one level: sources fill up in the order of size over
weight, so sorted running sums give it in one pass over a table with one short row a source.

Defined results: null text has size 0; null source is a source of its own; a source without
words has target 0 and its documents are taken 0 times; a null id hashes like any value.
Empty tables give empty results. Repeated rows count and are taken one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsledger.llm.common import full_text
from newsledger.session import materialize

SEED, MOST, CYCLE = 7, 3, 3
WORD = r"[^\x20\x09-\x0D]+"

ORACLE = r"""
WITH s AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM t),
r AS (
  SELECT *, row_number() OVER o AS nth,
         sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (
           ORDER BY source_size * 6 // w, source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(w) OVER (ORDER BY source_size * 6 // w, source NULLS LAST
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM w WINDOW o AS (ORDER BY source_size * 6 // w, source NULLS LAST)),
f AS (SELECT min(nth) AS first FROM r WHERE rest * w <= 3 * source_size * weights),
g AS (
  SELECT r.source, r.source_size,
         CASE WHEN f.first IS NULL OR r.nth < f.first THEN 3 * r.source_size::DOUBLE
              ELSE l.rest::DOUBLE * r.w::DOUBLE / l.weights::DOUBLE END AS target
  FROM r CROSS JOIN f LEFT JOIN r l ON l.nth = f.first),
c AS (
  SELECT s.doc_id, s.size, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('7:' || coalesce(s.doc_id::VARCHAR, '')), 1, 8))::BIGINT
           / 4294967296.0::DOUBLE AS draw
  FROM s JOIN g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       (size * least(floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END, 3))
         ::BIGINT AS taken
FROM c
"""


def word_count(text: Column) -> Column:
    return F.regexp_count(full_text(text), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from rows of (source, size)."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    listed = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weighed = totals.select(
        "source", "source_size",
        (F.pmod(F.row_number().over(listed) - 1, F.lit(CYCLE)) + 1).alias("w"))
    # Sources that fill up first come first: those with the least room for their weight.
    order = [(F.col("source_size") * 6 / F.col("w")).cast("long"),
             F.col("source").isNull(), F.col("source")]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding,
                                                    Window.unboundedFollowing)
    # Words left, and weights left, if exactly the sources before this one are full.
    left = (F.sum("source_size").over(everything)
            - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
    ranked = weighed.select(
        "source", "source_size", "w", F.row_number().over(Window.orderBy(*order)).alias("at"),
        left.alias("left"), F.sum("w").over(onward).alias("weights"))
    # The first source with room for its share stops the filling; those behind it share alike.
    stops = F.col("left") * F.col("w") <= most * F.col("source_size") * F.col("weights")
    first = F.min(F.when(stops, F.struct("at", "left", "weights"))).over(
        Window.orderBy(*order).rowsBetween(Window.unboundedPreceding,
                                           Window.unboundedFollowing))
    share = (F.col("first.left").cast("double") * F.col("w").cast("double")
             / F.col("first.weights").cast("double"))
    full = (most * F.col("source_size")).cast("double")
    return ranked.withColumn("first", first).select(
        "source", "source_size",
        F.when(F.col("first").isNull() | (F.col("at") < F.col("first.at")), full)
        .otherwise(share).alias("target"))


def copies(doc_id: Column, target: Column, source_size: Column, seed: int = SEED,
           most: int = MOST) -> Column:
    """floor(rate) plus a hash-seeded copy with the fraction as its chance."""
    rate = F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)
    whole = F.floor(rate).cast("int")
    return F.least(whole + (draw < rate - whole).cast("int"), F.lit(most))


def plan(docs: DataFrame, seed: int = SEED, most: int = MOST) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    sizes = materialize(docs.select(docs["doc_id"], docs["source"],
                                    word_count(docs["text"]).alias("size")))
    targets = materialize(source_targets(sizes, most).withColumnRenamed("source", "name"))
    n = copies(F.col("doc_id"), F.col("target"), F.col("source_size"), seed, most)
    return (sizes.join(targets, F.col("source").eqNullSafe(F.col("name")))
            .select("doc_id", "source", "size", "source_size", "target", n.alias("copies"))
            .withColumn("taken", F.col("size") * F.col("copies")))


def mix(docs: DataFrame, seed: int = SEED, most: int = MOST) -> DataFrame:
    """The rows of ``docs``, each as often as its source's rate asks, with all columns.

    Only the targets, one row a source, are joined to the texts.
    """
    sizes = docs.select(docs["source"], word_count(docs["text"]).alias("size"))
    rates = materialize(source_targets(sizes, most)).select(
        F.col("source").alias("__source"), F.col("source_size").alias("__size"),
        F.col("target").alias("__target"))
    n = copies(docs["doc_id"], F.col("__target"), F.col("__size"), seed, most)
    joined = docs.join(rates, docs["source"].eqNullSafe(F.col("__source")))
    return (joined.withColumn("__n", n).where("__n > 0")
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
            .select(*[docs[f"`{c}`"] for c in docs.columns]))
