"""The composite jobs. Each takes tables and returns the tables it derives.

Nothing runs until a result is written or read, except where a job writes an
intermediate table that several results share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsledger.operators import (audits, authors, backtest, changes, claims, health, lineage,
                                  retention, stories)
from newsledger.operators.classify import Rules, classify, digest_order
from newsledger.operators.features import Markers
from newsledger.operators.ordered import top_per_group, with_ranged_sum
from newsledger.session import materialize
from newsledger.sources import apis, sinks

Tables = dict[str, DataFrame]


def digest(items: DataFrame, rules: Rules, claim_table: DataFrame, log: DataFrame,
           seeds: DataFrame, manual: DataFrame, window_days: int = 3) -> Tables:
    """Sections in reading order, claim signals, author nominees and the run summary."""
    sections = classify(items, rules, window_days)
    words = materialize(claims.loose_claim_keywords(claims.active_claims(claim_table), rules))
    found = claims.keyword_sightings(sections, "source_item_id", words)
    signals = found.join(words, "keyword").select("claim_id", "source_item_id").distinct()
    picked = top_per_group(signals.join(sections, "source_item_id"), ["claim_id"],
                           [F.col("payload_ord"), F.col("item_ord")], 3)
    ledger = authors.author_ledger(authors.author_sightings(items, seeds),
                                   authors.manual_entries(manual))
    return {"sections": sections.orderBy("day", *digest_order(sections)),
            "claim_signals": picked, "nominees": authors.nominees(ledger),
            "run_summary": health.run_summary(log)}


def story_tables(items: DataFrame, rules: Rules, window_days: int = 3) -> Tables:
    """Stories of every day, their items and the merges."""
    placed = materialize(stories.cluster_items(classify(items, rules, window_days, False)))
    return {"story_items": placed, "stories": stories.stories(placed),
            "merge_events": stories.merge_events(placed)}


def independence(story_items: DataFrame) -> Tables:
    records = stories.origin_records(story_items)
    return {"origins": records, "independence": stories.independence(records)}


def source_health(sources: DataFrame, log: DataFrame, items: DataFrame, rules: Rules,
                  story: Tables, window_days: int = 3) -> Tables:
    """One row per source: fetch days, volumes, qualification and story roles."""
    kept = classify(items, rules, window_days, False)
    raw = items.withColumnRenamed("source_id", "source") if "source" not in items.columns else items
    ledger = health.source_health(
        sources, health.log_health(log), health.raw_health(raw), health.qualified_health(kept),
        health.story_health(story["stories"], story["story_items"]))
    return {"health": ledger, "rolling": health.rolling_health(log)}


def lineages(story: Tables, lookback: int = 7, threshold: float = 0.9) -> Tables:
    entries = materialize(lineage.build_lineages(story["stories"], story["story_items"],
                                                 lookback, threshold))
    return {"entries": entries, "groups": lineage.lineage_groups(entries)}


def rule_backtest(items: DataFrame, baseline, candidate, window_days: int = 3) -> Tables:
    compared = backtest.compare_rules(items, baseline, candidate, window_days)
    return {"diff": compared.where(F.col("change") != "kept"),
            "summary": backtest.change_summary(compared),
            "sections": backtest.section_deltas(compared),
            "sources": backtest.source_deltas(compared)}


def community_audit(entries: DataFrame, captures: DataFrame, items: DataFrame,
                    baseline: DataFrame, markers: Markers = Markers(),
                    duration: int = 14) -> Tables:
    scored = materialize(audits.community_scores(entries, captures, items, baseline, markers,
                                                 duration))
    return {"scores": scored.orderBy(*audits.community_order()),
            "progress": audits.audit_progress(scored, duration)}


def partition_audit(sources: DataFrame, captures: DataFrame, items: DataFrame, rules: Rules,
                    cells: DataFrame, formal: DataFrame, surfaces: list[str],
                    duration: int = 14) -> Tables:
    scored = audits.partition_scores(sources, captures, items, rules, duration)
    return {"scores": scored.orderBy(*audits.partition_order()),
            "coverage": audits.coverage_matrix(cells, surfaces),
            "coverage_errors": audits.coverage_errors(cells, formal, sources)}


def baseline_refresh(items: DataFrame, log: DataFrame, stored: DataFrame, captures: DataFrame,
                     sampled: DataFrame, end_day: Column, keep_days: int = 900,
                     signal_days: int = 30, duration: int = 14) -> Tables:
    """The compact baseline with the day's rows, without days that no scoring needs any more.

    ``captures`` and ``sampled`` are the audit's sample days and their items.
    """
    cutoff = retention.baseline_cutoff(captures, sampled, end_day, keep_days, signal_days,
                                       duration)
    oldest = cutoff.first()["cutoff"]  # one day: a literal prunes the stored days
    rows = retention.append_distinct(stored, retention.compact_baseline(items, log))
    return {"baseline": rows.where(F.col("day") >= F.lit(oldest)), "cutoff": cutoff}


def analysis_context(items: DataFrame, rules: Rules, claim_table: DataFrame,
                     evidence: DataFrame, day: Column, budget: int = 96 * 1024,
                     window_days: int = 3, collections: DataFrame | None = None) -> Tables:
    """Bounded context: strict signals, selected evidence, broad candidates and the identities
    of the captured collections (source, source_item_id, snapshot_hash, payload_ord).

    Rows count with their JSON; the directory of active claims is never trimmed.
    """
    key = "source_item_id"
    active = claims.active_claims(claim_table)
    kept = classify(items, rules, window_days)
    words = materialize(claims.claim_keywords(active, rules))
    seen = claims.keyword_sightings(kept, key, words)
    matches = materialize(claims.claim_matches(words, seen, key))
    signals = materialize(claims.context_rows(matches, kept, key)
                          .select("claim_id", key, "title", "signals", "payload_ord", "item_ord"))
    totals = signals.select("claim_id", F.col("signals").alias("total")).distinct()
    chosen = claims.select_evidence(evidence.join(totals, "claim_id", "left_semi"), day)
    newest = [F.col("lane"), F.col("date").desc_nulls_last(), F.col("ev_ord").desc()]
    first = [F.col("payload_ord"), F.col("item_ord")]

    def part(rows: DataFrame, kind: str, place: Column, ref: Column, text: Column) -> DataFrame:
        return rows.select(F.lit(kind).alias("kind"), F.col("claim_id"),
                           place.cast("long").alias("place"), F.col("total").cast("long"),
                           ref.alias("ref"), F.coalesce(text, F.lit("")).alias("text"))

    def nth(order: list[Column]) -> Column:  # within a claim's few chosen rows
        return F.row_number().over(Window.partitionBy("claim_id").orderBy(*order))

    parts = part(signals.withColumn("total", F.col("signals")), "signal", nth(first), F.col(key),
                 F.col("title"))
    parts = parts.unionByName(part(chosen.join(totals, "claim_id"), "evidence", nth(newest),
                                   F.col(key), F.col("verdict")))
    heads = active.withColumnRenamed("id", "claim_id").join(totals, "claim_id")
    parts = parts.unionByName(part(heads, "claim", F.lit(0), F.lit(""), F.col("claim")))
    parts = parts.unionByName(part(claims.broad_samples(matches, kept, key), "broad", F.lit(0),
                                   F.col(key), F.col("title")))
    if collections is not None:
        listed = collections.select(F.lit("").alias("claim_id"), F.lit(0).alias("total"), key,
                                    "payload_ord", F.concat_ws(" ", "source", "snapshot_hash")
                                    .alias("text"))
        listed = with_ranged_sum(listed, [F.asc("payload_ord"), F.asc(key)], F.lit(1), "place")
        parts = parts.unionByName(part(listed, "collection", F.col("place"), F.col(key),
                                       F.col("text")))
    size = F.octet_length(F.to_json(F.struct("kind", "claim_id", "ref", "text"))) + 1
    directory = active.select("id", "claim", "status", F.col("ledger_ref").isNotNull()
                              .alias("has_ledger_ref"))
    spent = directory.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))) + 1).alias("n")).first()
    packed = materialize(claims.trim_to_budget(parts.withColumn("bytes", size), budget,
                                               spent["n"] or 0))
    return {"directory": active, "rows": packed.where("kept"),
            "omitted": packed.where(~F.col("kept")).select("kind", "claim_id", "ref"),
            "stances": claims.stance_counts(evidence)}


def inbox_add(records: DataFrame, existing: DataFrame, items: DataFrame,
              collections: DataFrame, audit_urls: DataFrame) -> Tables:
    """Validate, bind to captures and dedupe; invalid rows are set apart."""
    checked = materialize(claims.record_errors(records))
    bound = materialize(claims.binding_check(
        checked.where(F.size("errors") == 0).drop("errors"), items, collections, audit_urls))
    valid = bound.where(F.col("binding") == "ok").drop("binding")
    return {"added": claims.inbox_additions(valid, existing),
            "invalid": checked.where(F.size("errors") > 0),
            "unbound": bound.where(F.col("binding") != "ok")}


def evidence_add(additions: DataFrame, evidence: DataFrame, claim_table: DataFrame,
                 items: DataFrame, collections: DataFrame, audit_urls: DataFrame) -> Tables:
    """Validate, bind to captures and dedupe; what no capture confirms is set apart."""
    checked = materialize(claims.addition_errors(additions))
    bound = materialize(claims.binding_check(
        checked.where(F.size("errors") == 0).drop("errors"), items, collections, audit_urls,
        "link"))
    valid = bound.where(F.col("binding") == "ok").drop("binding")
    return {"outcomes": claims.evidence_additions(valid, evidence, claim_table),
            "invalid": checked.where(F.size("errors") > 0),
            "unbound": bound.where(F.col("binding") != "ok")}


def month_review(inbox: DataFrame, claim_table: DataFrame, month_end: Column,
                 days: int = 60) -> Tables:
    if not 30 <= days <= 60:
        raise ValueError("the review window is 30 to 60 days")
    rows = claims.review_window(inbox, month_end, days)
    return {"matched": claims.month_review(rows, claim_table),
            "candidates": claims.candidate_gate(rows)}


def dossiers(claim_table: DataFrame, evidence: DataFrame) -> Tables:
    return {"rows": claims.dossier_rows(claim_table, evidence),
            "stances": claims.stance_counts(evidence), "types": claims.type_counts(evidence)}


def claim_quality(claim_table: DataFrame, evidence: DataFrame) -> Tables:
    return {"violations": claims.claim_violations(claim_table, evidence)}


def change_events(pages: DataFrame, prices: DataFrame, series: DataFrame, sightings: DataFrame,
                  points: DataFrame, status_bodies: DataFrame, quote_bodies: DataFrame,
                  threshold: float = 2.0) -> Tables:
    """Page, price and index changes, first sightings (key, day), best configurations (day, model,
    value, ord), incidents and quotes; a collapsed price snapshot is passed over."""
    good = changes.guarded_snapshots(prices).where("accepted").select("day")
    values = [c for c in prices.columns if c not in ("day", "key")]
    return {"pages": changes.page_changes(changes.page_probe(pages)),
            "prices": changes.snapshot_diff(prices.join(good, "day", "left_semi"), values),
            "series": changes.series_delta(series, threshold),
            "first_seen": changes.first_seen(sightings, "key", ["day"]),
            "best": changes.best_configuration(points),
            "incidents": apis.incidents(status_bodies), "quotes": apis.quotes(quote_bodies)}


def fetch_status(events: DataFrame, log: DataFrame) -> Tables:
    return {"status": health.fetch_rollup(events), "streaks": health.fetch_streaks(log),
            "cache_counts": health.cache_status_counts(events)}


def manifest_diff(source: DataFrame, target: DataFrame) -> Tables:
    return {"failures": sinks.manifest_diff(source, target),
            "fingerprint": sinks.manifest_fingerprint(source)}
