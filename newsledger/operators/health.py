"""Source health, fetch status and streaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsledger.functions import times
from newsledger.operators.ordered import with_rank, with_running_max

STATUSES = {"success_days": "ok", "failure_days": "error", "partial_days": "partial",
            "skipped_days": "skipped", "cached_days": "cached", "stale_days": "stale",
            "deferred_days": "deferred", "gone_days": "gone"}
ATTEMPTS = ["ok", "partial", "error"]


def log_health(log: DataFrame) -> DataFrame:
    """Days by status per source; only ok, partial and error days are attempts."""
    counts = [F.count(F.when(F.col("status") == s, 1)).alias(n) for n, s in STATUSES.items()]
    return log.groupBy("source").agg(
        F.count(F.when(F.col("status").isin(ATTEMPTS), 1)).alias("attempt_days"), *counts,
        F.max_by("status", "day").alias("last_status"),
        F.max_by("fetched_at", F.when(F.col("status") == "ok", F.col("day")))
        .alias("last_success_at"))


def raw_health(items: DataFrame) -> DataFrame:
    return items.groupBy("source").agg(
        F.countDistinct("day").alias("raw_snapshot_days"),
        F.count("*").alias("raw_item_observations"))


def qualified_health(classified: DataFrame) -> DataFrame:
    return classified.groupBy(F.col("source_id").alias("source")).agg(
        F.count("*").alias("qualified_observations"),
        F.countDistinct("source_item_id").alias("unique_qualified_items"),
        F.countDistinct("source_item_id", "snapshot_hash").alias("unique_snapshot_versions"))


def story_health(stories: DataFrame, story_items: DataFrame) -> DataFrame:
    """Stories a source appears in, leads, or carries alone."""
    mentions = (story_items.select("story_id", F.col("source_id").alias("source")).distinct()
                .groupBy("source").agg(F.count("*").alias("story_mentions")))
    primary = (stories.select("story_id", F.col("primary_source_id").alias("source")).distinct()
               .groupBy("source").agg(F.count("*").alias("primary_stories")))
    alone = (stories.where(F.col("source_count") == 1)
             .select("story_id", F.col("primary_source_id").alias("source")).distinct()
             .groupBy("source").agg(F.count("*").alias("sole_source_stories")))
    return mentions.join(primary, "source", "left").join(alone, "source", "left")


def source_health(sources: DataFrame, *parts: DataFrame) -> DataFrame:
    """One row per configured source; rates are NULL when nothing was observable."""
    rows = sources
    for part in parts:
        rows = rows.join(part, "source", "left")
    numbers = [c for c, t in rows.dtypes if t == "bigint"]
    rows = rows.fillna(0, numbers)

    def rate(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.round(F.col(part) / F.col(whole), 4))

    return (rows.withColumn("success_rate", rate("success_days", "attempt_days"))
            .withColumn("qualification_rate",
                        rate("qualified_observations", "raw_item_observations")))


def rolling_health(log: DataFrame, days: int = 30) -> DataFrame:
    """Attempts and successes over the trailing days, for every end date at once.

    Days are aggregated first, so the window sees one row per (source, day).
    """
    daily = log.groupBy("source", "day").agg(
        F.count(F.when(F.col("status").isin(ATTEMPTS), 1)).alias("attempts"),
        F.count(F.when(F.col("status") == "ok", 1)).alias("successes"))
    trailing = (Window.partitionBy("source").orderBy(F.datediff("day", F.lit("1970-01-01")))
                .rangeBetween(-(days - 1), 0))
    rows = (daily.withColumn("attempt_days", F.sum("attempts").over(trailing))
            .withColumn("success_days", F.sum("successes").over(trailing)))
    return rows.withColumn("success_rate", F.when(
        F.col("attempt_days") > 0, F.round(F.col("success_days") / F.col("attempt_days"), 4)))


def snapshot_at(captures: DataFrame) -> DataFrame:
    """Latest capture time of a day; midnight when none is readable."""
    return captures.groupBy("day").agg(F.coalesce(
        F.max(times.parse_published(F.col("fetched_at"))),
        F.first(F.to_timestamp("day"))).alias("snapshot_at"))


# --- fetch status -------------------------------------------------------------
def fetch_rollup(events: DataFrame) -> DataFrame:
    """One status per (day, source) from request-level events, by precedence.

    Events have cache_status, network_attempts, terminal_status and
    last_network_success_at.
    """
    status = F.coalesce(F.when(F.col("cache_status") != "", F.col("cache_status")),
                        F.lit("unknown"))
    rows = events.withColumn("_status", status)
    pending = F.col("terminal_status").isNull()

    def number(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    is_ = {s: F.col("_status") == s for s in
           ("error", "deferred", "unknown", "stale_backoff")}
    facts = rows.groupBy("day", "source").agg(
        F.count("*").alias("events"), number(is_["error"]).alias("errors"),
        number(is_["deferred"]).alias("deferred"),
        number(F.col("terminal_status") == 410).alias("gone"),
        number(is_["error"] & pending).alias("open_errors"),
        number(is_["deferred"] & pending).alias("open_deferred"),
        number(is_["unknown"] & pending).alias("open_unknown"),
        number(~F.col("_status").isin("error", "deferred", "unknown")).alias("usable_responses"),
        number(is_["stale_backoff"]).alias("stale"),
        number((F.col("network_attempts") > 0) & ~is_["error"]).alias("network_successes"),
        F.coalesce(F.sum("network_attempts"), F.lit(0)).alias("network_attempts"),
        F.max("last_network_success_at").alias("last_network_success_at"))
    c = {name: F.col(name) > 0 for name in facts.columns[2:-1]}
    ladder = (F.when((c["errors"] | c["deferred"] | c["gone"]) & c["usable_responses"], "partial")
              .when(c["open_errors"] | c["open_unknown"], "error")
              .when(c["open_deferred"], "deferred").when(c["gone"], "gone")
              .when(c["errors"], "error").when(c["network_successes"], "ok")
              .when(c["stale"], "stale").when(c["deferred"], "deferred").otherwise("cached"))
    return facts.withColumn("source_status", ladder)


def cache_status_counts(events: DataFrame) -> DataFrame:
    """Events per (day, source) and cache status, long form."""
    status = F.coalesce(F.when(F.col("cache_status") != "", F.col("cache_status")),
                        F.lit("unknown"))
    return events.groupBy("day", "source", status.alias("cache_status")).agg(
        F.count("*").alias("events"))


def fetch_streaks(log: DataFrame) -> DataFrame:
    """Length of the run of failures, and of unchanged bodies, up to each fetch.

    A run is counted from the last row that broke it. ``log`` has source, ts,
    ``failed`` and ``unchanged``.
    """
    keys, bucket, order = ["source"], F.to_date("ts"), ["ts", "fetch_id"]
    rows = with_rank(log, keys, bucket, order, "_no")
    for flag, name in (("failed", "failure_streak"), ("unchanged", "unchanged_streak")):
        rows = with_running_max(rows, keys, F.to_date("ts"), order,
                                F.when(~F.col(flag), F.col("_no")), "_broke")
        rows = rows.withColumn(name, F.col("_no") - F.coalesce("_broke", F.lit(0))).drop("_broke")
    return rows.drop("_no")


def run_summary(log: DataFrame) -> DataFrame:
    """Sources by status per day, with the names of those that need a look."""
    def names(status: str) -> Column:
        return F.array_join(F.array_sort(F.collect_set(
            F.when(F.col("status") == status, F.col("source")))), "|")
    return log.groupBy("day").agg(
        *[F.count(F.when(F.col("status") == s, 1)).alias(s) for s in
          ("ok", "cached", "skipped", "error", "partial", "gone")],
        names("error").alias("failed_sources"), names("partial").alias("partial_sources"),
        names("gone").alias("gone_sources"))
