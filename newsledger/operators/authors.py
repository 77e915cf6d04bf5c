"""Author ledger: how often authors are cited, counted by distinct posts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from newsledger import fixed_values as fixed
from newsledger.operators.ordered import newest

FORGET_DAYS = 60
DAYS_KEPT = 60


def cited_posts(items: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """(day, handle, status_id, author) of every link to a post, without seeds; row by row, so
    streams can use it."""
    link = F.explode("x_links").alias("link")
    rows = items.select("day", link)
    handle = F.regexp_extract("link", fixed.STATUS_REF_PATTERN, 1)
    rows = (rows.select("day", handle.alias("handle"),
                        F.regexp_extract("link", fixed.STATUS_REF_PATTERN, 2).alias("status_id"))
            .where(F.col("status_id") != "").withColumn("author", F.lower("handle"))
            .where(~F.col("author").isin(fixed.STATUS_RESERVED_HEADS)))
    if seeds is not None:
        rows = rows.join(seeds.select(F.lower("handle").alias("author")).distinct(), "author",
                         "left_anti")
    return rows


def author_sightings(items: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """(author, status_id, day, handle): posts linked by items, each once a day."""
    return (cited_posts(items, seeds).groupBy("author", "status_id", "day")
            .agg(F.min("handle").alias("handle")))


def manual_entries(manual: DataFrame) -> DataFrame:
    """Hand-kept candidates: posts named in the provenance, and the uncounted rest."""
    ids = F.array_distinct(F.regexp_extract_all(
        F.coalesce("provenance", F.lit("")), F.lit(fixed.STATUS_REF_PATTERN), 2))
    rest = F.greatest(F.lit(0), F.coalesce("score", F.lit(1)) - F.size("_ids"))
    return (manual.withColumn("_ids", ids).withColumn("author", F.lower("handle"))
            .groupBy("author").agg(
                F.max(rest).cast("int").alias("manual_count"),
                F.max(F.coalesce("has_test_signal", F.lit(False))).alias("has_test_signal")))


def current_sightings(sightings: DataFrame, manual: DataFrame, as_of) -> DataFrame:
    """Sightings still in the ledger at a day.

    An author with one post who stays unseen for more than 60 days is forgotten and
    starts over. So gaps split an author's days into stretches; the first stretch with
    two posts makes the entry permanent from there on; without one, only the last
    stretch counts, if it is recent enough.
    """
    days = sightings.where(F.col("day") <= as_of).select("author", "day").distinct()
    along = Window.partitionBy("author").orderBy("day")
    gap = F.datediff("day", F.lag("day").over(along)) > FORGET_DAYS
    days = days.withColumn("_break", F.coalesce(gap, F.lit(False)).cast("int"))
    days = days.withColumn("stretch", F.sum("_break").over(along)).drop("_break")
    rows = sightings.join(days, ["author", "day"])
    posts = rows.select("author", "stretch", "status_id").distinct()
    counts = posts.groupBy("author", "stretch").agg(F.count("*").alias("n")).join(
        manual.select("author", "manual_count"), "author", "left")
    firm = F.col("n") + F.coalesce("manual_count", F.lit(0)) >= 2
    start = counts.groupBy("author").agg(
        F.min(F.when(firm, F.col("stretch"))).alias("firm"), F.max("stretch").alias("last"))
    kept = rows.join(start, "author").where(
        F.col("stretch") >= F.coalesce("firm", "last"))
    recent = kept.groupBy("author").agg(F.max("day").alias("_seen"), F.first("firm").alias("_firm"))
    recent = recent.where(F.col("_firm").isNotNull()
                          | (F.datediff(as_of, "_seen") <= FORGET_DAYS)).select("author")
    return kept.join(recent, "author", "left_semi").drop("stretch", "firm", "last")


def author_ledger(sightings: DataFrame, manual: DataFrame) -> DataFrame:
    """One row per author: distinct posts plus the manual base, days and an example."""
    posts = sightings.groupBy("author", "status_id").agg(
        F.min("day").alias("first_day"), F.min("handle").alias("handle"))
    example = F.concat(F.lit("x.com/"), "handle", F.lit("/status/"), "status_id")
    counts = posts.groupBy("author").agg(
        F.count("*").alias("posts"),
        F.min_by("handle", F.struct("first_day", "status_id")).alias("handle"),
        F.min_by(example, F.struct("first_day", "status_id")).alias("example"))
    days = newest(sightings.select("author", "day").distinct(), ["author"],
                  F.trunc("day", "year"), ["day"], DAYS_KEPT)
    days = days.groupBy("author").agg(F.count("*").alias("day_count"), F.max("day").alias("last_day"))
    return (counts.join(days, "author").join(manual, "author", "full_outer")
            .fillna(0, ["posts", "day_count", "manual_count"])
            .withColumn("count", F.coalesce("posts", F.lit(0))
                        + F.coalesce("manual_count", F.lit(0)))
            .withColumn("has_test_signal", F.coalesce("has_test_signal", F.lit(False))))


def nominees(ledger: DataFrame, minimum: int = 3) -> DataFrame:
    """Frequent authors: nominated with a confirmed test signal, else for review."""
    return (ledger.where(F.col("count") >= minimum)
            .withColumn("list", F.when(F.col("has_test_signal"), "nominated").otherwise("review")))
