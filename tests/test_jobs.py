"""Composite jobs run end to end on the smallest tables."""

import datetime as dt

from pyspark.sql import functions as F

from newsledger.operators import retention as R
from newsledger.plans import jobs
from registry import audits as RA, changes as RC, claims as RL, partitions as RP, stories as RS, views as V

SMALL = "/root/testdata/sf0.001"


def test_jobs_run(spark):
    items = V.observations(spark, SMALL)
    claims, evidence = RL.claims(spark, SMALL), RL.evidence(spark, SMALL)
    log = RC.fetch_log(spark, SMALL)
    seeds = spark.createDataFrame([("nobody",)], "handle string")
    day = F.lit(V.LAST_DAY).cast("date")
    cited = items.withColumn("x_links", RL.U.status_links(F.col("summary")))
    results = {
        "digest": jobs.digest(cited, V.RULES, claims, log, seeds, RL.manual(spark, SMALL)),
        "context": jobs.analysis_context(items, V.RULES, claims, evidence, day),
        "review": jobs.month_review(RL.inbox(spark, SMALL), claims, F.lit(RL.MONTH_END).cast("date")),
        "dossiers": jobs.dossiers(claims, evidence), "quality": jobs.claim_quality(claims, evidence),
        "backtest": jobs.rule_backtest(items, V.RULES, V.CANDIDATE_RULES)}
    counts = {(job, name): table.count() for job, tables in results.items()
              for name, table in tables.items()}
    assert counts["digest", "sections"] > 0 and counts["digest", "run_summary"] > 0
    assert counts["context", "rows"] > 0 and counts["review", "candidates"] > 0
    assert counts["dossiers", "rows"] > 0 and counts["backtest", "sections"] == 5


def test_context_stays_within_its_budget(spark):
    items, day = V.observations(spark, SMALL), F.lit(V.LAST_DAY).cast("date")
    claims, evidence = RL.claims(spark, SMALL), RL.evidence(spark, SMALL)
    collections = items.groupBy("payload_ord").agg(
        F.max("name").alias("source"),
        F.concat("payload_ord", F.lit(":collection")).alias("source_item_id"),
        F.sha2(F.max("title"), 256).alias("snapshot_hash"))
    whole = jobs.analysis_context(items, V.RULES, claims, evidence, day, 1 << 30,
                                  collections=collections)
    assert whole["omitted"].count() == 0
    kinds = {r["kind"]: r["count"] for r in whole["rows"].groupBy("kind").count().collect()}
    assert kinds["collection"] == collections.count() and kinds["claim"] and kinds["signal"]
    used = whole["rows"].agg(F.sum("bytes")).first()[0]
    directory = whole["directory"].select("id", "claim", "status", F.col("ledger_ref").isNotNull()
                                          .alias("has_ledger_ref"))
    spent = directory.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))) + 1)).first()[0]
    budget = spent + used // 2
    cut = jobs.analysis_context(items, V.RULES, claims, evidence, day, budget,
                                collections=collections)
    kept = cut["rows"].agg(F.sum("bytes")).first()[0]
    assert spent + kept <= budget and cut["omitted"].count() > 0
    assert cut["rows"].count() + cut["omitted"].count() == whole["rows"].count()


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_baseline_refresh_drops_what_no_scoring_needs(spark):
    items = V.observations(spark, SMALL).withColumn("capture_hash", F.col("fetched_at"))
    captures = RP.captures(spark, SMALL)
    run = F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("T20:"),
                   F.lpad(F.regexp_extract("source", r"\d+", 0), 2, "0"), F.lit(":00Z"))
    log = (captures.withColumn("run_mode", F.when(F.col("status") == "ok", "full"))
           .withColumn("completed_at", F.col("at")).withColumn("snapshot_hash", run))
    compact = R.compact_baseline(items, log).cache()
    old = compact.limit(1).withColumn("day", F.lit(dt.date(2020, 1, 1)))
    made = jobs.baseline_refresh(items, log, compact.unionByName(old), captures,
                                 RP.community_items(spark, SMALL), RP.end_day(), 40)
    cutoff = made["cutoff"].first()[0]
    assert dt.date(2020, 1, 1) < cutoff
    assert compact.count() > 0
    assert rows(made["baseline"]) == rows(compact.distinct().where(F.col("day") >= F.lit(cutoff)))


def test_change_events_equal_their_queries(spark):
    events = V.table(spark, SMALL, "events")
    at = dt.datetime(2024, 1, 1)
    pages = spark.createDataFrame(
        [("s", "S", at + dt.timedelta(days=i), b, "html", ["the"])
         for i, b in enumerate(["the a", "the a", "x", "the b"])],
        "source_id string, name string, fetched_at timestamp, body string, "
        "content_format string, required_patterns array<string>")
    prices = RC.part_prices(spark, SMALL)
    points = events.select(F.to_date("ts").alias("day"), F.col("event_type").alias("model"),
                           F.col("user_id").alias("effort"), "value",
                           F.col("event_id").alias("ord"))
    sightings = events.select(F.col("user_id").alias("key"), F.col("ts").alias("day"))
    body = '{"status": {"indicator": "major", "description": "d"}, "incidents": []}'
    status = spark.createDataFrame([("s", "S", "https://s.com", "t", body)],
                                   "source_id string, name string, url string, "
                                   "fetched_at string, body string")
    quote = '{"symbol": "X", "price": 3.0, "timestamp": [0, 86400], "close": [2.0, 3.0]}'
    quotes = spark.createDataFrame([("q", quote)], "source_id string, body string")
    made = jobs.change_events(pages, prices, RC.index_series(spark, SMALL), sightings, points,
                              status, quotes)
    kinds = made["pages"].orderBy("fetched_at").select("kind").collect()
    assert [r.kind for r in kinds] == ["snapshot", "snapshot", "unreadable", "recovered"]
    good = jobs.changes.guarded_snapshots(prices).where("accepted").select("day").collect()
    if len(good) == prices.select("day").distinct().count():
        assert made["prices"].count() == RC.snapshot_diff(spark, SMALL).count()
    assert made["series"].count() == RC.series_delta(spark, SMALL).count()
    assert made["first_seen"].count() == RC.first_seen(spark, SMALL).count()
    best = made["best"].select(RC.day_text(), "model", "effort", "value")
    assert rows(best) == rows(RC.best_configuration(spark, SMALL).select(best.columns))
    assert made["incidents"].count() == 1
    assert made["quotes"].first()["change_pct"] == 50.0


def test_fetch_status_equals_its_queries(spark):
    log = V.table(spark, SMALL, "events").select(
        F.col("event_id").alias("fetch_id"),
        F.concat(F.lit("src"), F.col("user_id") % 20).alias("source"), "ts",
        (F.col("event_type") == "error").alias("failed"),
        F.col("event_type").isin("view", "click").alias("unchanged"))
    made = jobs.fetch_status(RC.http_events(spark, SMALL), log)
    streaks = made["streaks"].select(F.col("fetch_id").alias("event_id"), "source",
                                     "failure_streak", "unchanged_streak")
    assert rows(streaks) == rows(RC.fetch_streaks(spark, SMALL))
    assert made["status"].count() == RC.fetch_status_rollup(spark, SMALL).count()
    assert made["cache_counts"].count() == RC.cache_status_counts(spark, SMALL).count()


def test_story_jobs_equal_their_queries(spark):
    """Stories, independence and lineages of the jobs against the registered queries."""
    made = jobs.story_tables(V.observations(spark, SMALL), V.RULES)
    found = made["stories"].select("story_id", "item_count", "source_count", "title")
    assert rows(found) == rows(RS.stories(spark, SMALL).select(found.columns))
    spread = jobs.independence(made["story_items"])["independence"]
    assert spread.count() == found.count()
    told = jobs.lineages(made)
    assert told["entries"].count() == found.count()
    events = told["groups"].agg(F.sum("event_count")).first()[0]
    assert events == found.count()
