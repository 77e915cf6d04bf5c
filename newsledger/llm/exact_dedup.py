"""Exact deduplication by 128-bit content hash, with bytes compared inside equal hashes.

``classes`` groups by (hash, normalised text): rows of one hash meet, and the text in the
key compares their bytes, so two texts that share a hash stay apart. Copies combine before
the shuffle, which leaves one row a text and task however large a group of copies is. The
documents themselves then need only their hash to find their class; where one hash holds
several texts (never seen with MD5, but proven here by count) those rows alone are
matched by text as well.

Defined results: null text is empty text, and all empty texts are copies of each other. A
null doc_id is smaller than any other. Rows that repeat a doc_id with equal text count one
by one in ``group_size`` and only one of them is kept. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from newsledger.llm.common import ascii_lower, full_text, one_per_key, without
from newsledger.session import materialize


def content_hash(text: Column) -> Column:
    """MD5 of the UTF-8 bytes: 128 bits."""
    return F.md5(text)


def classes(docs: DataFrame, normalise: Callable[[Column], Column] = ascii_lower,
            digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per distinct normalised text: hash, text, id that stays, number of copies."""
    text = normalise(full_text(docs["text"]))
    return (docs.select(docs["doc_id"].alias("__id"), text.alias("__text"))
            .groupBy(digest(F.col("__text")).alias("__hash"), "__text")
            .agg(F.max("__id").alias("keep_id"), F.count("*").alias("group_size"))
            .withColumn("text_sha256", F.sha2("__text", 256)))


def assign(docs: DataFrame, normalise: Callable[[Column], Column] = ascii_lower,
           digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The row with the largest doc_id of each group of equal texts stays.
    """
    found = classes(docs, normalise, digest)
    narrow = materialize(found.drop("__text"))
    crowded = narrow.groupBy("__hash").count().where("count > 1").select("__hash")
    text = normalise(full_text(docs["text"]))
    rows = docs.select(docs["doc_id"], digest(text).alias("__hash"))
    if crowded.isEmpty():
        joined = rows.join(narrow, "__hash")
    else:
        texts = docs.select(docs["doc_id"], digest(text).alias("__hash"), text.alias("__text"))
        joined = (rows.join(crowded, "__hash", "left_anti").join(narrow, "__hash")
                  .unionByName(texts.join(crowded, "__hash", "left_semi")
                               .join(found, ["__hash", "__text"]).drop("__text")))
    repeats = (rows.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count()
               .where("count > 1"))
    nulls = rows.where(F.col("doc_id").isNull()).limit(2)
    wins = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    if repeats.isEmpty() and nulls.count() < 2:
        return joined.select("doc_id", "keep_id", "group_size", wins.alias("kept"),
                             "text_sha256")
    # Rows that repeat an id: count them, then lay them out again with a number each.
    counted = (joined.groupBy("doc_id", "keep_id", "group_size", "text_sha256")
               .agg(F.count("*").alias("__n")))
    return counted.select(
        "doc_id", "keep_id", "group_size", "text_sha256",
        F.explode(F.sequence(F.lit(1), F.col("__n").cast("int"))).alias("__nth")).select(
        "doc_id", "keep_id", "group_size", (wins & (F.col("__nth") == 1)).alias("kept"),
        "text_sha256")


def deduplicate(docs: DataFrame, normalise: Callable[[Column], Column] = ascii_lower) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Of rows that repeat both the id and the text, the largest by all columns stays.
    """
    made = materialize(assign(docs, normalise).select(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"),
        F.col("keep_id").alias("__keep")))
    keyed = {"__id": docs["doc_id"],
             "__sha": F.sha2(normalise(full_text(docs["text"])), 256)}
    losers = (made.where(~F.col("__id").eqNullSafe(F.col("__keep")))
              .select("__id", "__sha").distinct())
    repeated = (made.where(F.col("__id").eqNullSafe(F.col("__keep")))
                .groupBy("__id", "__sha").count().where("count > 1").select("__id", "__sha"))
    return one_per_key(without(docs, losers, keyed), keyed, repeated)
