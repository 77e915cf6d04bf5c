"""Retention windows, protected samples and the long-lived compact baseline."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from newsledger import fixed_values as fixed
from newsledger.functions import text as T, times, urls as U
from newsledger.operators.barrier import computed
from newsledger.operators.ordered import newest, with_rank


def keep_recent(rows: DataFrame, today: Column, keep_days: int) -> DataFrame:
    """Partition filter: days not older than the retention."""
    return rows.where(F.col("day") >= F.date_sub(today, keep_days))


def keep_floor(captures: DataFrame, today: Column, keep_days: int, minimum: int) -> DataFrame:
    """Recent captures, and older ones while a source has fewer than ``minimum``.

    Same guarantee as deleting whole days oldest first, decided row by row.
    """
    protected = newest(captures, ["source"], F.trunc("day", "month"), ["day"], minimum)
    recent = captures.where(F.col("day") >= F.date_sub(today, keep_days))
    return recent.unionByName(protected.where(F.col("day") < F.date_sub(today, keep_days)))


def audit_window_days(sources: int, duration: int = 14, batch: int = 1) -> int:
    return duration * math.ceil(sources / batch) + 7


def retention_days(configured: int, sources: int, duration: int = 14) -> int:
    return max(configured, audit_window_days(sources, duration))


def baseline_cutoff(captures: DataFrame, items: DataFrame, end_day: Column, keep_days: int,
                    signal_days: int = 30, duration: int = 14) -> DataFrame:
    """One row: the oldest baseline day that still matters to scoring.

    Protected are the sample days and event days in each source's newest snapshots.
    """
    kept = newest(captures, ["source"], F.trunc("day", "month"), ["day"], duration)
    events = items.join(kept.select("source", "day"), ["source", "day"], "left_semi")
    when = F.coalesce(times.short_iso(F.col("published")), times.short_iso(F.col("fetched_at")))
    oldest = (kept.select(F.col("day").alias("d"))
              .unionByName(events.select(F.to_date(when).alias("d")))
              .agg(F.min("d").alias("oldest")))
    limit = F.date_sub(end_day, keep_days)
    return oldest.select(F.least(limit, F.date_sub("oldest", signal_days)).alias("cutoff"))


def compact_baseline(items: DataFrame, log: DataFrame) -> DataFrame:
    """Comparison columns only, from complete full runs whose snapshot hash matches.

    ``items`` has capture_hash; ``log`` has day, source, snapshot_hash, run_mode and
    completed_at. Neither article nor summary text survives.
    """
    runs = (log.where((F.col("run_mode") == "full") & F.col("completed_at").isNotNull())
            .select("day", F.col("source").alias("source_id"),
                    F.col("snapshot_hash").alias("capture_hash")))
    kept = items.join(runs, ["day", "source_id", "capture_hash"], "left_semi")
    pool = F.concat_ws(" ", T.text(F.col("url")), T.text(F.col("external_url")),
                       F.col("external_urls"), T.text(F.col("summary")))
    links = F.filter(F.transform(U.found_urls(pool), U.match_url), lambda u: u.isNotNull())
    rows = computed(kept, {"_links": F.array_distinct(links)})

    def first_fifty(values: Column) -> Column:
        return F.slice(F.array_sort(F.array_distinct(values)), 1, fixed.MAX_URLS_PER_ITEM)

    return rows.select(
        "day", F.col("source_id").alias("source"),
        F.substring(T.text(F.col("title")), 1, fixed.MAX_TITLE_CHARS).alias("title"),
        F.coalesce(times.short_iso(F.col("published")),
                   times.short_iso(F.col("fetched_at"))).alias("when"),
        first_fifty(F.transform("_links", lambda u: F.substring_index(u, "?", 1))).alias("urls"),
        first_fifty(F.transform("_links", lambda u: F.concat(
            F.lit("url-sha256:"), F.sha2(u, 256)))).alias("url_keys"))


def append_distinct(existing: DataFrame, added: DataFrame) -> DataFrame:
    """Append-only union; a full row counts once."""
    return existing.unionByName(added).distinct()


def baseline_sightings(baseline: DataFrame, end_day: Column) -> DataFrame:
    """Signals of retained compact rows up to a day: signal, source, ts."""
    from newsledger.operators.signals import titled
    title = titled(F.col("title"))
    signals = F.concat(F.col("url_keys"), F.when(title != "title:", F.array(title))
                       .otherwise(T.empty_strings()))
    return (baseline.where((F.col("day") <= end_day) & F.col("when").isNotNull())
            .select(F.explode(signals).alias("signal"), "source", F.col("when").alias("ts")))


def sample_numbers(captures: DataFrame) -> DataFrame:
    """Running number of every capture of a source."""
    return with_rank(captures, ["source"], F.trunc("day", "month"), ["day"], "sample_no")
