"""Lineages: which story of an earlier day a story continues.

The parent of a story depends on features of earlier stories only, never on ids given
out so far. So all parents are found at once, and the forest is resolved afterwards by
pointer doubling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsledger.functions import ids, similarity as S, text as T
from newsledger.operators import stories as ST, titles
from newsledger.operators.barrier import computed
from newsledger.operators.skew import salted_join
from newsledger.session import materialize

LOOKBACK_DAYS = 7
TITLE_THRESHOLD = 0.9
ORIGIN_THRESHOLD = 0.6
KEY = ["day", "story_id"]


def lineage_features(stories: DataFrame, story_items: DataFrame) -> dict[str, DataFrame]:
    """Story table with title features, and long tables of its items and origins.

    Sets stay long: a story may hold a third of all items.
    """
    records = ST.origin_records(story_items.select(
        *KEY, "source_item_id", "snapshot_hash", "url", "external_url", "tier"))
    records = materialize(records.select(*KEY, "source_item_id", "snapshot_hash", "origin_url"))
    versions = records.select(*KEY, "source_item_id", "snapshot_hash").distinct()
    origins = records.where(F.col("origin_url") != "").select(*KEY, "origin_url").distinct()
    least = records.groupBy(*KEY).agg(
        F.min(F.when(F.col("origin_url") != "", F.col("origin_url"))).alias("min_origin"),
        F.min("source_item_id").alias("min_item"))
    rows = stories.withColumn("place", F.struct(
        -F.col("source_count"), F.coalesce(-F.unix_micros("latest_at"), F.lit(2 ** 62)), "title",
        "story_id"))
    rows = computed(rows, {"title_n": T.normalized_title(F.col("title"))})
    rows = computed(rows, {"tokens": T.title_tokens(F.col("title_n")),
                           "vendors": T.title_vendors(F.col("title_n")),
                           "models": T.title_models(F.col("title_n"))})
    rows = rows.withColumn("mergeable", T.title_is_mergeable(F.col("title_n"), F.col("tokens")))
    return {"stories": materialize(rows.select(*KEY, "title", "title_n", "tokens", "vendors",
                                               "models", "mergeable", "place")
                                   .join(least, KEY)),
            "versions": materialize(versions), "origins": materialize(origins)}


def shared_item_parents(items: DataFrame, lookback: int = LOOKBACK_DAYS) -> DataFrame:
    """Parent by a shared item: the nearest earlier day, then the greatest story id.

    One row per (item, day) is enough, and each looks only at the day before it, so no
    pairs of stories are formed. ``items`` has day, story_id and source_item_id.
    """
    daily = items.groupBy("source_item_id", "day").agg(F.max("story_id").alias("top"))
    along = Window.partitionBy("source_item_id").orderBy("day")
    linked = (daily.withColumn("prior_day", F.lag("day").over(along))
              .withColumn("prior_story_id", F.lag("top").over(along))
              .where(F.datediff("day", "prior_day") <= lookback).drop("top"))
    best = F.max(F.struct("prior_day", "prior_story_id"))
    return (items.select(*KEY, "source_item_id").join(linked, ["source_item_id", "day"])
            .groupBy(*KEY).agg(best.alias("_b"))
            .select(*KEY, "_b.prior_day", "_b.prior_story_id", F.lit(1.0).alias("similarity"),
                    F.lit("shared_source_item").alias("link_reason")))


def _titles(rows: DataFrame, name: str) -> list[Column]:
    return [F.col("title_n").alias(f"{name}_title"), F.col("tokens").alias(f"{name}_tokens"),
            F.col("vendors").alias(f"{name}_vendors"), F.col("models").alias(f"{name}_models")]


def _best_similar(pairs: DataFrame, threshold: float, reason: str) -> DataFrame:
    """Per child the most similar, then nearest, then greatest prior story."""
    fits = T.titles_compatible(F.col("x_vendors"), F.col("x_models"),
                               F.col("y_vendors"), F.col("y_models"))
    rows = computed(pairs.where(fits), {
        "_j": T.jaccard(F.col("x_tokens"), F.col("y_tokens")),
        "_top": S.ratio_bound(F.length("x_title"), F.length("y_title"))})
    rows = rows.where(S.blend(F.col("_top"), F.col("_j")) >= threshold)
    same = F.col("x_title") == F.col("y_title")
    near = rows.where(~same).withColumn("_r", S.sequence_ratio(F.col("x_title"), F.col("y_title")))
    near = near.withColumn("similarity", S.blend(F.col("_r"), F.col("_j"))).drop("_r")
    rows = near.unionByName(rows.where(same).withColumn("similarity", F.lit(1.0)))
    best = F.max(F.struct("similarity", "prior_day", "prior_story_id"))
    return (rows.where(F.col("similarity") >= threshold).groupBy(*KEY).agg(best.alias("_b"))
            .select(*KEY, "_b.prior_day", "_b.prior_story_id", "_b.similarity",
                    F.lit(reason).alias("link_reason")))


def _within(lookback: int) -> Column:
    return F.datediff("day", "prior_day").between(1, lookback)


def shared_origin_parents(open_: DataFrame, features: dict[str, DataFrame],
                          lookback: int = LOOKBACK_DAYS) -> DataFrame:
    """Parent by a shared origin page, for compatible and fairly similar titles.

    Prior stories with equal titles collapse to the greatest id; the join key is
    (origin, day), so no pair outside the lookback is formed.
    """
    stories, origins = features["stories"], features["origins"]
    prior = (origins.join(stories, KEY).groupBy("origin_url", F.col("day").alias("prior_day"),
                                                *_titles(stories, "y"))
             .agg(F.max("story_id").alias("prior_story_id")))
    child = (open_.join(origins, KEY)
             .select(*KEY, "origin_url", *_titles(open_, "x"), F.explode(F.transform(
                 F.sequence(F.lit(1), F.lit(lookback)),
                 lambda i: F.date_sub(F.col("day"), i))).alias("prior_day")))
    pairs = salted_join(child, prior, ["origin_url", "prior_day"])
    return _best_similar(pairs, ORIGIN_THRESHOLD, "shared_origin_url")


def _blocks(rows: DataFrame, order: Column, *keep: str) -> DataFrame:
    """One row per title block: ids, names and what bounds the similarity, without the titles."""
    return titles.with_block_keys(rows, order).select(
        *keep, "vendors", "models", F.length("title_n").alias("length"), F.inline("_keys"))


def title_parents(open_: DataFrame, features: dict[str, DataFrame],
                  lookback: int = LOOKBACK_DAYS,
                  threshold: float = TITLE_THRESHOLD) -> DataFrame:
    """Parent by title: both mergeable, compatible, with a common vendor or model.

    Stories meet in a title block and on the prior day, by their rarest bigrams and words, as
    ids with lengths and places that allow the threshold; titles join the distinct pairs
    afterwards. A vendor named in a third of all titles is no join key.
    """
    if threshold < titles.THRESHOLD:
        raise ValueError("title blocks lose no pair only from 0.86 upward")
    named = F.col("mergeable") & ((F.size("vendors") > 0) | (F.size("models") > 0))
    columns = ["title_n", "tokens", "vendors", "models"]
    prior = materialize(features["stories"].where(named)
                        .groupBy(F.col("day").alias("prior_day"), *columns)
                        .agg(F.max("story_id").alias("prior_story_id")))
    order = titles.corpus_order(prior)
    child = open_.where(named).select(*KEY, *columns)
    near = (_blocks(child, order, *KEY)
            .withColumn("prior_day", F.explode(F.transform(
                F.sequence(F.lit(1), F.lit(lookback)), lambda i: F.date_sub(F.col("day"), i)))))
    far = _blocks(prior, order, "prior_day", "prior_story_id")
    common = (F.arrays_overlap("x_vendors", "y_vendors")
              | F.arrays_overlap("x_models", "y_models"))
    pairs = (titles.meet(near, far, ["prior_day", "key"], common)
             .select(F.col("x_day").alias("day"), F.col("x_story_id").alias("story_id"),
                     "prior_day", F.col("y_prior_story_id").alias("prior_story_id")).distinct())
    pairs = (pairs.join(child.select(*KEY, *_titles(child, "x")), KEY)
             .join(prior.select("prior_day", "prior_story_id", *_titles(prior, "y")),
                   ["prior_day", "prior_story_id"]))
    return _best_similar(pairs, threshold, "title_similarity")


def lineage_parents(features: dict[str, DataFrame], lookback: int = LOOKBACK_DAYS,
                    threshold: float = TITLE_THRESHOLD) -> DataFrame:
    """Best parent per story: shared item before shared origin before title."""
    stories = features["stories"]
    by_item = materialize(shared_item_parents(features["versions"], lookback))
    open_ = stories.join(by_item, KEY, "left_anti")
    by_origin = materialize(shared_origin_parents(open_, features, lookback))
    open_ = open_.join(by_origin, KEY, "left_anti")
    by_title = title_parents(open_, features, lookback, threshold)
    return materialize(by_item.unionByName(by_origin).unionByName(by_title))


def resolve_roots(stories: DataFrame, parents: DataFrame) -> DataFrame:
    """(day, story_id, root_day, root_story_id) by pointer doubling."""
    here = F.struct("day", "story_id")
    up = F.struct(F.col("prior_day").alias("day"), F.col("prior_story_id").alias("story_id"))
    rows = materialize(stories.select(*KEY).join(parents, KEY, "left").select(
        here.alias("node"), F.when(F.col("prior_day").isNotNull(), up).otherwise(here)
        .alias("root")))
    while True:
        jump = rows.select(F.col("node").alias("root"), F.col("root").alias("next"))
        after = materialize(rows.join(jump, "root").select("node", F.col("next").alias("root")))
        moved = (after.join(rows.withColumnRenamed("root", "old"), "node")
                 .where(F.col("root") != F.col("old")).limit(1).count())
        rows = after
        if not moved:
            return rows.select("node.*", F.col("root.day").alias("root_day"),
                               F.col("root.story_id").alias("root_story_id"))


def lineage_ids(roots: DataFrame) -> DataFrame:
    """Ids of root stories; of equal ids only the earliest root keeps the plain one."""
    basis = (F.when(F.col("min_origin").isNotNull(),
                    ids.short_id("lineage-", 20, F.lit("origin"), F.col("min_origin"),
                                 F.col("title_n")))
             .otherwise(ids.short_id("lineage-", 20, F.lit("item"), F.col("min_item"))))
    rows = roots.withColumn("base", basis)
    first = rows.groupBy("base").agg(F.min(F.struct("day", "place")).alias("first"))
    again = ids.short_id("lineage-", 20, F.col("base"), F.date_format("day", "yyyy-MM-dd"),
                         F.col("story_id"))
    return rows.join(first, "base").select(
        F.col("day").alias("root_day"), F.col("story_id").alias("root_story_id"),
        F.when(F.struct("day", "place") == F.col("first"), F.col("base")).otherwise(again)
        .alias("lineage_id"))


def update_types(parents: DataFrame, versions: DataFrame) -> DataFrame:
    """repeat, updated-capture or follow-up, by comparing version sets with joins."""
    held = versions.groupBy(*KEY, "source_item_id").agg(F.count("*").alias("held"))
    before = held.select(F.col("day").alias("prior_day"), F.col("story_id").alias("prior_story_id"),
                         "source_item_id", F.col("held").alias("before"))
    total = before.groupBy("prior_day", "prior_story_id").agg(F.sum("before").alias("all_before"))
    links = parents.select(*KEY, "prior_day", "prior_story_id")
    seen = versions.select(F.col("day").alias("prior_day"),
                           F.col("story_id").alias("prior_story_id"), "source_item_id",
                           "snapshot_hash", F.lit(1).alias("same"))
    per_item = (versions.join(links, KEY)
                .join(seen, ["prior_day", "prior_story_id", "source_item_id", "snapshot_hash"],
                      "left")
                .groupBy(*KEY, "prior_day", "prior_story_id", "source_item_id")
                .agg(F.count("*").alias("now"), F.count("same").alias("same")))
    differs = (F.col("before").isNotNull()
               & ((F.col("now") != F.col("same")) | (F.col("before") != F.col("same"))))
    facts = (per_item.join(before, ["prior_day", "prior_story_id", "source_item_id"], "left")
             .groupBy(*KEY, "prior_day", "prior_story_id")
             .agg(F.sum("now").alias("now"), F.sum("same").alias("same"),
                  F.max(differs.cast("int")).alias("differs"))
             .join(total, ["prior_day", "prior_story_id"]))
    equal = (F.col("now") == F.col("same")) & (F.col("all_before") == F.col("same"))
    return facts.select(*KEY, F.when(equal, "repeat").when(F.col("differs") == 1,
                                                           "updated-capture")
                        .otherwise("follow-up").alias("update_type"))


def build_lineages(stories: DataFrame, story_items: DataFrame, lookback: int = LOOKBACK_DAYS,
                   threshold: float = TITLE_THRESHOLD) -> DataFrame:
    """One entry per story and day, with its lineage, parent and kind of update."""
    features = lineage_features(stories, story_items)
    parents = lineage_parents(features, lookback, threshold)
    roots = resolve_roots(features["stories"], parents)
    origins = roots.where((F.col("day") == F.col("root_day"))
                          & (F.col("story_id") == F.col("root_story_id"))).select(*KEY)
    # written one by one: the driver plans a join of all of them again after each stage
    named = materialize(lineage_ids(features["stories"].join(origins, KEY)))
    types = materialize(update_types(parents, features["versions"]))
    return (features["stories"].select(*KEY, "title", "place").join(roots, KEY)
            .join(named, ["root_day", "root_story_id"])
            .join(parents, KEY, "left").join(types, KEY, "left")
            .withColumn("update_type", F.coalesce("update_type", F.lit("new")))
            .withColumn("link_reason", F.coalesce("link_reason", F.lit("new")))
            .withColumn("similarity", F.round(F.coalesce("similarity", F.lit(0.0)), 4)))


def lineage_groups(entries: DataFrame) -> DataFrame:
    return entries.groupBy("lineage_id").agg(
        F.min("day").alias("window_first_seen"), F.max("day").alias("window_latest_seen"),
        F.count("*").alias("event_count"), F.countDistinct("day").alias("day_count"),
        F.max_by("title", F.struct("day", "place")).alias("latest_title"))
