"""Scoring candidate sources: community audit and partition audit."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from newsledger import fixed_values as fixed
from newsledger.functions import times, urls as U
from newsledger.operators.barrier import computed
from newsledger.operators.classify import Rules
from newsledger.operators.features import Markers, community_features, item_quality
from newsledger.operators.ordered import exact_median, newest
from newsledger.operators.routing import audit_item_key, eligible_items, route_items
from newsledger.operators.signals import (
    audit_signals, baseline_lead, community_signals, effective_time, item_key, item_matches,
    signal_matches, signal_points)
from newsledger.session import materialize


# --- sampling -----------------------------------------------------------------
def attempt_history(captures: DataFrame, end_day: Column) -> DataFrame:
    """Retained attempts and the latest one per source."""
    return (captures.where(F.col("day") <= end_day).groupBy("source")
            .agg(F.count("*").alias("attempts"), F.max("day").alias("latest")))


def rotating_batch(entries: DataFrame, history: DataFrame, limit: int) -> DataFrame:
    """Least sampled first, then least recent, then configuration order."""
    return (entries.join(history, "source", "left")
            .withColumn("attempts", F.coalesce("attempts", F.lit(0)))
            .orderBy("attempts", F.col("latest").asc_nulls_first(), "entry_ord")
            .limit(max(1, limit)))


def daily_slot(entries: DataFrame, days: DataFrame, batch: int = 1) -> DataFrame:
    """The entries whose turn it is on each day; ``entry_ord`` counts from 0."""
    size = max(1, entries.count())
    turns = days.withColumn("entry_ord", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(min(batch, size) - 1)),
        lambda i: F.pmod(times.day_ordinal(F.col("day")) + i, F.lit(size)))))
    return turns.join(entries, "entry_ord")


def collection_candidates(candidates: DataFrame, only: Iterable[str] = ()) -> DataFrame:
    """Enabled ones; or those named, if enabled or in the rotation group."""
    enabled = F.coalesce(F.col("enabled"), F.lit(True))
    names = [n.lower() for n in only]
    if not names:
        return candidates.where(enabled)
    return candidates.where(F.lower("source").isin(names)
                            & (enabled | (F.col("audit_group") == "rotation")))


def complete_days(log: DataFrame, required: DataFrame, end_day: Column) -> DataFrame:
    """Finished days whose log covers every required source.

    Relational division by counting: required sources seen = required sources.
    """
    finished = log.where((F.col("day") <= end_day) & F.col("finished_at").isNotNull())
    wanted = required.select("source").distinct()
    covered = (finished.join(wanted, "source", "left_semi").groupBy("day")
               .agg(F.countDistinct("source").alias("covered")))
    size = wanted.agg(F.count("*").alias("needed"))
    return covered.join(F.broadcast(size), F.col("covered") == F.col("needed")).select("day")


def sample_days(complete: DataFrame, logged: DataFrame, end_day, count: int) -> DataFrame:
    """The newest complete days; an unfinished end day joins them while short."""
    chosen = materialize(complete.orderBy(F.col("day").desc()).limit(count))
    if chosen.count() >= count:
        return chosen
    today = logged.where(F.col("day") == end_day).select("day").distinct()
    return chosen.unionByName(today.join(chosen, "day", "left_anti"))


# --- community audit ----------------------------------------------------------
def fresh_counts(captures: DataFrame, items: DataFrame) -> DataFrame:
    """Items at most a day old at the time of each capture; failed captures count 0."""
    age = times.hours_between(times.parse_iso(F.col("fetched_at")),
                              times.parse_iso(F.col("published")))
    fresh = (items.withColumn("_age", age).where(F.col("_age").between(0, 24))
             .groupBy("source", "day").agg(F.count("*").alias("fresh")))
    return (captures.select("source", "day").join(fresh, ["source", "day"], "left")
            .withColumn("fresh", F.coalesce("fresh", F.lit(0))))


def newest_snapshots(captures: DataFrame, count: int) -> DataFrame:
    return newest(captures, ["source"], F.trunc("day", "month"), ["day"], count)


def unique_items(items: DataFrame, keys: Sequence[str] = ("source",)) -> DataFrame:
    """First version of every item, with its earliest time over all versions."""
    keys = [*keys, "item_key"]
    rest = [c for c in items.columns if c not in (*keys, "ts")]
    first = F.min_by(F.struct(*rest), F.struct("day", "item_ord"))
    return (items.groupBy(*keys).agg(first.alias("_row"), F.min("ts").alias("ts"))
            .select(*keys, "_row.*", "ts"))


def community_scores(entries: DataFrame, captures: DataFrame, items: DataFrame,
                     baseline: DataFrame, markers: Markers = Markers(),
                     duration: int = 14, width_days: int = 30) -> DataFrame:
    """One scored row per configured community.

    ``entries`` (source, category, role), ``captures`` (source, day, status,
    fetched_at), ``items`` with their capture's day and fetched_at, ``baseline``
    signal sightings (signal, source, ts).
    """
    rows = community_signals(community_features(items, markers), list(markers.domains))
    rows = computed(rows, {
        "ts": effective_time(F.col("published"), F.col("fetched_at")),
        "item_key": item_key(U.match_url(F.col("url")), F.col("title"))})
    flags = ["technical_proxy", "evidence_proxy", "direct_evidence", "noise_proxy"]
    # texts are read once; everything below works on this narrow table
    rows = materialize(rows, ["source", "day", "item_ord", "item_key", "ts", "signals", *flags])
    kept = newest_snapshots(captures, duration)
    recent = rows.join(kept.select("source", "day"), ["source", "day"], "left_semi")
    unique = materialize(unique_items(recent))
    matched = item_matches(signal_matches(unique, signal_points(rows), width_days=width_days))
    lead = materialize(baseline_lead(unique, baseline, width_days))
    rates = (unique.select("source", "item_key", *flags)
             .join(matched, ["source", "item_key"], "left")
             .join(lead, ["source", "item_key"], "left")
             .groupBy("source").agg(
                 F.count("*").alias("unique_posts"),
                 *[F.avg(F.col(f).cast("double")).alias(f) for f in flags],
                 F.avg(F.coalesce("duplicate", F.lit(0)).cast("double")).alias("duplicate_rate"),
                 F.count("lead_hours").alias("existing_matches")))
    lead_median = exact_median(lead, ["source"], "lead_hours", "lead_hours")
    fresh = exact_median(fresh_counts(kept, items), ["source"], "fresh", "fresh_median")
    days = kept.groupBy("source").agg(
        F.countDistinct("day").alias("attempt_days"),
        F.countDistinct(F.when(F.col("status") == "ok", F.col("day"))).alias("sample_days"))
    scored = entries
    for part in (days, rates, fresh, lead_median):
        scored = scored.join(part, "source", "left")
    zero = ["unique_posts", "attempt_days", "sample_days", "existing_matches", "fresh_median",
            "duplicate_rate", *flags]
    scored = scored.fillna(0, zero)
    lead_bonus = F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("lead_hours") / 24)),
                            F.lit(0.0))
    activity = F.least(F.lit(1.0), F.col("fresh_median") / 5.0)
    score = F.bround(100 * (
        0.30 * F.col("technical_proxy") + 0.22 * F.col("evidence_proxy")
        + 0.13 * F.col("direct_evidence") + 0.12 * (1 - F.col("duplicate_rate"))
        + 0.08 * lead_bonus + 0.15 * activity - 0.20 * F.col("noise_proxy")))
    scored = scored.withColumn(
        "score", F.when(F.col("unique_posts") > 0, score).otherwise(0).cast("int"))
    decision = (
        F.when(F.col("role") == "control", fixed.DECISION_CONTROL)
        .when(F.col("attempt_days") < duration, _collecting(duration))
        .when(F.col("unique_posts") == 0, fixed.DECISION_UNREACHABLE)
        .when((F.col("score") >= 60) & (F.col("technical_proxy") >= 0.35)
              & (F.col("fresh_median") >= 2), fixed.DECISION_CORE)
        .when((F.col("score") >= 42) & (F.col("technical_proxy") >= 0.22),
              fixed.DECISION_ROTATE)
        .otherwise(fixed.DECISION_OUT))
    return scored.withColumn("decision", decision)


def _collecting(duration: int) -> Column:
    return F.concat(F.lit(fixed.DECISION_COLLECTING + " "), F.col("attempt_days"),
                    F.lit(f"/{duration}"))


def community_order() -> list[Column]:
    return [F.col("role") == "control", F.col("score").desc(), F.lower("source")]


def audit_progress(scored: DataFrame, duration: int = 14) -> DataFrame:
    return scored.agg(
        F.count(F.when(F.col("attempt_days") > 0, 1)).alias("covered"),
        F.count(F.when(F.col("attempt_days") >= duration, 1)).alias("complete"),
        F.max("attempt_days").alias("most_attempts"))


# --- partition audit ----------------------------------------------------------
# weights: partition -> primary, quality, qualification, novelty, lag, noise, corroborated
WEIGHTS = {
    "release": (0.35, 0.25, 0.15, 0.15, 0.10, 0.25, 0.0),
    "field_test": (0.20, 0.35, 0.15, 0.20, 0.10, 0.20, 0.0),
    "research_synthesis": (0.0, 0.55, 0.15, 0.20, 0.10, 0.20, 0.0),
    "pricing": (0.40, 0.35, 0.10, 0.10, 0.05, 0.30, 0.0),
    "degradation": (0.30, 0.30, 0.0, 0.15, 0.10, 0.25, 0.15),
    "company": (0.40, 0.25, 0.10, 0.15, 0.10, 0.30, 0.0),
}


def _weight(position: int) -> Column:
    column = None
    for partition, weights in WEIGHTS.items():
        test = F.col("partition") == partition
        column = (F.when(test, weights[position]) if column is None
                  else column.when(test, weights[position]))
    return column


def partition_scores(sources: DataFrame, captures: DataFrame, items: DataFrame, rules: Rules,
                     duration: int = 14, width_days: int = 30) -> DataFrame:
    """One scored row per (partition, source); candidates without items stay visible.

    ``sources`` (source, name, tier, evidence_role, role, cadence, track, affiliation,
    partitions, enabled), ``captures`` (source, day, status), ``items`` as described in
    ``routing``.
    """
    raw = eligible_items(items)
    raw = computed(raw, {"item_key": audit_item_key(raw)})
    counts = (raw.groupBy("source").agg(
        F.countDistinct("item_key").alias("raw"),
        F.avg(F.col("readable").cast("double")).alias("readability")))
    routed = audit_signals(route_items(items, rules))
    routed = computed(routed, {
        "item_key": audit_item_key(routed),
        "ts": effective_time(F.col("published"), F.col("fetched_at"), times.parse_iso_first)})
    flags = ["primary", "quality", "noise", "conflict"]
    # texts are read once; everything below works on this narrow table
    routed = materialize(item_quality(routed), ["partition", "source", "day", "item_ord",
                                                "item_key", "ts", "signals", *flags])
    unique = materialize(unique_items(routed, ["partition", "source"]))
    matched = materialize(item_matches(signal_matches(unique, signal_points(routed, ["partition"]),
                                          ["partition"], width_days), ["partition"]))
    at = ["partition", "source"]
    rates = (unique.select(*at, "item_key", *flags)
             .join(matched.select(*at, "item_key", "duplicate"), [*at, "item_key"], "left")
             .groupBy(*at).agg(
                 F.count("*").alias("qualified"),
                 *[F.avg(F.col(f).cast("double")).alias(f) for f in flags],
                 F.avg(F.coalesce("duplicate", F.lit(0)).cast("double")).alias("duplicate")))
    lag = exact_median(matched, at, "lag_hours", "lag")
    days = captures.groupBy("source").agg(
        F.countDistinct("day").alias("attempt_days"),
        F.countDistinct(F.when(F.col("status") == "ok", F.col("day"))).alias("sample_days"))

    every = F.array(*[F.lit(p) for p in fixed.PARTITIONS])
    listed = F.coalesce(F.when(F.size("partitions") > 0, F.col("partitions")), every)
    placed = (sources.join(days, "source", "left")
              .where((F.col("role") == "candidate")
                     & (F.coalesce(F.col("enabled"), F.lit(True))
                        | F.col("attempt_days").isNotNull()))
              .select(F.explode(listed).alias("partition"), "source"))
    rows = rates.select(*at).unionByName(placed).distinct()
    rows = rows.join(sources.drop("partitions", "enabled"), "source", "left")
    for part, on in ((days, ["source"]), (counts, ["source"]), (rates, at), (lag, at)):
        rows = rows.join(part, on, "left")
    # sampled sources without readability probes count as readable; unsampled ones do not
    unprobed = F.when(F.col("attempt_days").isNotNull(), 1.0).otherwise(0.0)
    rows = (rows.withColumn("readability", F.coalesce("readability", unprobed))
            .fillna(0, ["attempt_days", "sample_days", "raw", "qualified", "duplicate", *flags]))
    return _scored(rows, duration)


def _scored(rows: DataFrame, duration: int) -> DataFrame:
    effective_quality = F.col("quality") * F.col("readability")
    effective_noise = F.greatest(F.col("noise"), 1 - F.col("readability"))
    lag_score = F.coalesce(F.greatest(F.lit(0.0), 1 - F.col("lag") / 72.0), F.lit(0.0))
    rows = (rows.withColumn("qualification",
                            F.col("qualified") / F.greatest(F.lit(1), F.col("raw")))
            .withColumn("novelty", F.when(F.col("qualified") > 0, 1 - F.col("duplicate"))
                        .otherwise(0.0)))
    score = 100 * (
        _weight(0) * F.col("primary") + _weight(1) * effective_quality
        + _weight(2) * F.col("qualification") + _weight(6) * F.col("duplicate")
        + _weight(3) * F.col("novelty") + _weight(4) * lag_score
        - _weight(5) * effective_noise)
    rows = rows.withColumn("_score", F.when(F.col("qualified") > 0, score).otherwise(0.0))
    low = F.col("cadence") == "low_frequency"
    decision = (
        F.when(F.col("role") == "incumbent", fixed.DECISION_INCUMBENT)
        .when(F.col("attempt_days") == 0, fixed.DECISION_NEVER_SAMPLED)
        .when(F.col("attempt_days") < duration, _collecting(duration))
        .when((F.col("_score") >= 60) & (F.col("quality") >= 0.30)
              & (F.col("readability") >= 0.80),
              F.when(low, fixed.DECISION_LOW_FREQUENCY).otherwise(fixed.DECISION_CORE))
        .when(F.col("_score") >= 42,
              F.when(low, fixed.DECISION_LOW_FREQUENCY).otherwise(fixed.DECISION_ROTATE))
        .otherwise(fixed.DECISION_REJECT))
    clamped = F.bround(F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.col("_score"))))
    return (rows.withColumn("decision", decision).withColumn("score", clamped.cast("int"))
            .drop("_score"))


def partition_order() -> list[Column]:
    places = F.array(*[F.lit(p) for p in fixed.PARTITIONS])
    return [F.array_position(places, F.col("partition")), F.col("role") == "incumbent",
            F.col("score").desc(), F.col("source")]


# --- coverage -----------------------------------------------------------------
def coverage_matrix(cells: DataFrame, surfaces: Sequence[str]) -> DataFrame:
    """Target by surface; ``cells`` has target, surface, kind and source or note."""
    entries = F.concat(F.col("kind"), F.lit(":"), F.col("entry"))
    return (cells.groupBy("target").pivot("surface", list(surfaces))
            .agg(F.array_join(F.array_sort(F.collect_set(entries)), "|")))


def coverage_errors(cells: DataFrame, formal: DataFrame, candidates: DataFrame) -> DataFrame:
    """Incumbents outside the formal pool and trials that are no candidates."""
    def missing(kind: str, known: DataFrame) -> DataFrame:
        return (cells.where(F.col("kind") == kind)
                .join(known.select(F.col("source").alias("entry")), "entry", "left_anti")
                .select("target", "surface", "kind", "entry"))
    return missing("incumbent", formal).unionByName(missing("trial", candidates))


def undeclared_keywords(keywords: DataFrame, aliases: DataFrame, targets: DataFrame) -> DataFrame:
    """Model keywords no target declares, and aliased targets that do not exist."""
    unknown = (aliases.select("target").distinct().join(targets, "target", "left_anti")
               .select(F.lit("target").alias("kind"), F.col("target").alias("name")))
    loose = (keywords.join(aliases.select(F.col("alias").alias("keyword")), "keyword", "left_anti")
             .select(F.lit("keyword").alias("kind"), F.col("keyword").alias("name")))
    return unknown.unionByName(loose.distinct())


def author_catalog(candidates: DataFrame) -> DataFrame:
    return (candidates.where(F.col("track") == "expert_author")
            .select("source", "name", "audit_group", "audit_status", "latest_seen",
                    "affiliation", "url"))
