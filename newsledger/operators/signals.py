"""Signal keys: what makes two observations the same signal, and when they met."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from newsledger import fixed_values as fixed
from newsledger.functions import text as T, times, urls as U
from newsledger.operators.barrier import computed
from newsledger.operators.features import direct_links, link_host, outside_links
from newsledger.operators.intervals import interval_profile


def titled(title: Column) -> Column:
    return F.concat(F.lit("title:"), T.title_key(title))


def item_key(normalised: Column, title: Column) -> Column:
    """Identity of an item inside one source: its link, else its title."""
    return U.once(normalised, lambda link: F.when(
        F.coalesce(link, F.lit("")) != "", link).otherwise(titled(title)))


def community_signals(items: DataFrame, domains: Sequence[str]) -> DataFrame:
    """Add ``signals``: hashed direct links, else the title key."""
    rows = items if "direct_urls" in items.columns else direct_links(items, domains)
    hashed = F.transform("direct_urls", lambda u: F.concat(F.lit("url-sha256:"), F.sha2(u, 256)))
    title = titled(F.col("title"))
    return rows.withColumn("signals", F.when(F.size("direct_urls") > 0, hashed)
                           .when(title != "title:", F.array(title))
                           .otherwise(T.empty_strings()))


def audit_signals(items: DataFrame) -> DataFrame:
    """Add ``signals``: artifact links of author items, else outside links, else own."""
    pool = (F.col("summary"), F.col("match_text"), F.col("external_url"), outside_links())
    rows = computed(items, {"_own": U.audit_url(F.col("url")),
                            "_links": U.extract_audit_urls(*pool), "_title": titled(F.col("title"))})
    expert = F.col("expert_features")

    def as_keys(urls):
        return F.transform(urls, lambda u: F.concat(F.lit("url:"), u))

    outside = F.filter("_links", lambda u: ~link_host(u).isin(fixed.AGGREGATOR_HOSTS))
    artifacts = F.array_sort(F.array_distinct(F.filter(
        F.transform(F.coalesce(F.when(expert.isNotNull(), expert["artifact_urls"]),
                               T.empty_strings()), U.audit_url), U.names_artifact)))
    own = F.when(F.col("_own") != "", F.array(F.concat(F.lit("url:"), F.col("_own"))))
    title = F.array("_title")
    fallback = F.concat(F.coalesce(own, T.empty_strings()),
                        F.when(F.col("_title") != "title:", title).otherwise(T.empty_strings()))
    signals = (F.when(expert.isNotNull(),
                      F.when(F.size(artifacts) > 0, as_keys(artifacts)).otherwise(fallback))
               .when(F.size(outside) > 0, as_keys(outside))
               .otherwise(F.coalesce(own, title)))
    return computed(rows, {"signals": signals}).drop("_own", "_links", "_title")


def effective_time(published: Column, fetched: Column, parse=times.parse_iso) -> Column:
    """Publication time, else the time of the capture."""
    return F.coalesce(parse(published), parse(fetched))


def signal_points(items: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per signal sighting: keys, signal, source, ts."""
    return (items.where(F.col("ts").isNotNull())
            .select(*keys, F.explode("signals").alias("signal"), "source", "ts"))


def signal_matches(items: DataFrame, points: DataFrame, keys: Sequence[str] = (),
                   width_days: int = 30) -> DataFrame:
    """Per item and signal: sources and earliest time within the window.

    ``items`` has the keys, ``item_key``, ``source``, ``signals`` and ``ts``. Adds
    ``shared`` (more than one source near) and ``lag_hours`` behind the earliest
    sighting where the item's own sighting is among them.
    """
    keys = list(keys)
    probes = (items.where(F.col("ts").isNotNull())
              .select(*keys, "source", "item_key", F.explode("signals").alias("signal"), "ts"))
    profile = interval_profile(points, probes, [*keys, "signal"], width_days)
    own = (points.select(*keys, "signal", "source", "ts").distinct()
           .withColumn("own", F.lit(True)))
    rows = (probes.join(profile, [*keys, "signal", "ts"])
            .join(own, [*keys, "signal", "source", "ts"], "left"))
    shared = F.col("low") != F.col("high")
    return rows.select(
        *keys, "source", "item_key", "signal", "ts", shared.alias("shared"),
        F.when(shared & F.col("own"),
               times.hours_between(F.col("ts"), F.col("earliest"))).alias("lag_hours"))


def item_matches(matches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per item: is any signal shared, and the lag of smallest size over its signals."""
    return (matches.groupBy(*keys, "source", "item_key")
            .agg(F.max(F.col("shared").cast("int")).alias("duplicate"),
                 F.min_by("lag_hours", F.when(F.col("lag_hours").isNotNull(), F.struct(
                     F.abs("lag_hours"), "lag_hours"))).alias("lag_hours")))


def baseline_lead(items: DataFrame, baseline: DataFrame, width_days: int = 30) -> DataFrame:
    """Hours by which an item precedes the earliest baseline sighting in its window.

    ``baseline`` has signal, source and ts. Items without a match are left out.
    """
    probes = (items.where(F.col("ts").isNotNull())
              .select("source", "item_key", F.explode("signals").alias("signal"), "ts"))
    profile = interval_profile(baseline, probes, ["signal"], width_days)
    return (probes.join(profile, ["signal", "ts"])
            .groupBy("source", "item_key")
            .agg(F.min("earliest").alias("earliest"), F.min("ts").alias("ts"))
            .select("source", "item_key",
                    times.hours_between(F.col("earliest"), F.col("ts")).alias("lead_hours")))


def baseline_points(items: DataFrame, parse=times.parse_iso) -> DataFrame:
    """Sightings of an existing archive: every link of an item, and its title key."""
    pool = (F.col("url"), F.col("external_url"), F.col("summary"), outside_links())
    rows = computed(items, {"_links": U.extract_match_urls(*pool),
                            "_title": titled(F.col("title")),
                            "ts": effective_time(F.col("published"), F.col("fetched_at"), parse)})
    hashed = F.transform("_links", lambda u: F.concat(F.lit("url-sha256:"), F.sha2(u, 256)))
    title = F.when(F.col("_title") != "title:", F.array("_title")).otherwise(T.empty_strings())
    return (rows.where(F.col("ts").isNotNull())
            .select(F.explode(F.concat(hashed, title)).alias("signal"),
                    F.col("source_id").alias("source"), "ts"))
