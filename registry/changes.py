"""Change detection, health, fetch status and backtest queries."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from newsledger.functions import text as T
from newsledger.operators import backtest as B, changes as C, health as H
from newsledger.operators.ordered import last_wins
from registry import register, views as V
from registry.audits import ENTRIES, captures, community_entries, community_items
from registry.digests import _VISIBLE, day_text


# --- pages --------------------------------------------------------------------
@register("page_change_events", f"""
WITH p AS (SELECT page_id, lower(regexp_extract(url, '^https?://([^/?#]*)', 1)) AS source_id,
    TIMESTAMP '2024-01-01' + to_hours(CAST(page_id AS INTEGER)) AS "at", {_VISIBLE} AS body FROM pages),
r AS (SELECT *, sha256(body) AS sha, regexp_matches(body, '(?i)the') AS readable FROM p),
l AS (SELECT *, lag(readable) OVER w AS was, lag(sha) OVER w AS old FROM r
  WINDOW w AS (PARTITION BY source_id ORDER BY "at")),
c AS (SELECT *, CASE WHEN was IS NULL THEN TRUE WHEN NOT readable THEN was WHEN NOT was THEN TRUE
  ELSE old <> sha END AS changed FROM l)
SELECT page_id, source_id, sha AS content_sha256, readable, changed,
  CASE WHEN NOT readable THEN 'unreadable' WHEN NOT was THEN 'recovered'
    WHEN changed AND was IS NOT NULL THEN 'updated' ELSE 'snapshot' END AS kind,
  strftime(max(CASE WHEN changed THEN "at" END) OVER (PARTITION BY source_id ORDER BY "at"),
    '%Y-%m-%d %H:%M:%S') AS published FROM c""")
def page_change_events(spark, sf_dir):
    from newsledger.functions.urls import raw_host
    pages = V.table(spark, sf_dir, "pages")
    captured = pages.select(
        "page_id", raw_host(F.col("url")).alias("source_id"), F.col("html").alias("body"),
        F.timestamp_add("HOUR", F.col("page_id").cast("int"),
                        F.lit("2024-01-01").cast("timestamp")).alias("fetched_at"),
        F.lit("html").alias("content_format"), F.array(F.lit("the")).alias("required_patterns"))
    rows = C.page_changes(C.page_probe(captured).drop("body", "content"))
    return rows.select("page_id", "source_id", "content_sha256", "readable", "changed", "kind",
                       F.date_format("published", "yyyy-MM-dd HH:mm:ss").alias("published"))


# --- snapshots ----------------------------------------------------------------
def index_series(spark, sf_dir):
    """Daily value per user: the last event of the day."""
    events = V.table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("day"), F.col("user_id").alias("key"), "value", "ts", "event_id")
    return last_wins(events, ["day", "key"], ["ts", "event_id"])


def part_prices(spark, sf_dir):
    """Monthly unit price per part and supplier: the highest of the month."""
    lines = V.table(spark, sf_dir, "lineitem")
    month = F.to_date(F.trunc("l_shipdate", "month")).alias("day")
    key = F.concat("l_partkey", F.lit("/"), "l_suppkey").alias("key")
    return (lines.select(month, key, "l_partkey", "l_discount",
                         (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
            .groupBy("day", "key", "l_partkey")
            .agg(F.max("price").alias("prompt"), F.max("l_discount").alias("completion")))


SERIES = """
series AS (SELECT CAST(ts AS DATE) AS day, user_id AS key, arg_max(value, (ts, event_id)) AS value
  FROM events GROUP BY ALL),
cal AS (SELECT day, lag(day) OVER (ORDER BY day) AS prev_day FROM (SELECT DISTINCT day FROM series))"""
PRICES = """
prices AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS day,
    l_partkey || '/' || l_suppkey AS key, l_partkey,
    max(l_extendedprice / l_quantity) AS prompt, max(l_discount) AS completion
  FROM lineitem GROUP BY ALL),
cal AS (SELECT day, lag(day) OVER (ORDER BY day) AS prev_day FROM (SELECT DISTINCT day FROM prices))"""


@register("series_delta", "WITH " + SERIES + """
SELECT strftime(s.day, '%Y-%m-%d') AS day, s.key, s.value, p.value AS prev_value,
  round(s.value - p.value, 6) AS delta FROM series s JOIN cal USING (day)
JOIN series p ON p.day = cal.prev_day AND p.key = s.key WHERE abs(s.value - p.value) >= 2.0""")
def series_delta(spark, sf_dir):
    return C.series_delta(index_series(spark, sf_dir)).select(
        day_text(), "key", "value", "prev_value", F.round("delta", 6).alias("delta"))


@register("snapshot_diff", "WITH " + PRICES + """
SELECT strftime(s.day, '%Y-%m-%d') AS day, s.key, s.prompt, s.completion, p.prompt AS prev_prompt,
  p.completion AS prev_completion, CASE WHEN p.key IS NULL THEN 'new' ELSE 'changed' END AS event
FROM prices s JOIN cal USING (day) LEFT JOIN prices p ON p.day = cal.prev_day AND p.key = s.key
WHERE cal.prev_day IS NOT NULL
  AND (p.key IS NULL OR p.prompt <> s.prompt OR p.completion <> s.completion)""")
def snapshot_diff(spark, sf_dir):
    return C.snapshot_diff(part_prices(spark, sf_dir), ["prompt", "completion"]).select(
        day_text(), "key", "prompt", "completion", "prev_prompt", "prev_completion", "event")


@register("snapshot_guard", "WITH RECURSIVE " + """
k AS (SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS day, l_partkey AS key
  FROM lineitem),
d AS (SELECT day, count(*) AS n, row_number() OVER (ORDER BY day) AS no FROM k GROUP BY day),
pairs AS (SELECT a.day, b.day AS earlier, count(*) AS retained FROM k a JOIN k b
  ON a.key = b.key AND b.day < a.day GROUP BY ALL),
walk(no, day, earlier, keys, ratio, accepted, state) AS (
  SELECT no, day, CAST(NULL AS DATE), n, CAST(NULL AS DOUBLE), TRUE, day FROM d WHERE no = 1
  UNION ALL
  SELECT d.no, d.day, w.state, d.n, coalesce(p.retained, 0) / s.n,
    coalesce(p.retained, 0) / s.n >= 0.5,
    CASE WHEN coalesce(p.retained, 0) / s.n >= 0.5 THEN d.day ELSE w.state END
  FROM walk w JOIN d ON d.no = w.no + 1 JOIN d s ON s.day = w.state
  LEFT JOIN pairs p ON p.day = d.day AND p.earlier = w.state)
SELECT strftime(day, '%Y-%m-%d') AS day, strftime(earlier, '%Y-%m-%d') AS earlier, keys,
  round(ratio, 6) AS ratio, accepted FROM walk""")
def snapshot_guard(spark, sf_dir):
    lines = V.table(spark, sf_dir, "lineitem").select(
        F.to_date(F.trunc("l_shipdate", "month")).alias("day"), F.col("l_partkey").alias("key"))
    return C.guarded_snapshots(lines).select(
        *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("day", "earlier")], "keys",
        F.round("ratio", 6).alias("ratio"), "accepted")


@register("first_seen", """
SELECT user_id, strftime(min(ts), '%Y-%m-%d') AS day,
  arg_min(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id""")
def first_seen(spark, sf_dir):
    events = V.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return C.first_seen(events, "user_id", ["ts", "event_id"]).select(
        "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type")


@register("best_configuration", """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, event_type AS model,
  arg_max(user_id, (value, -event_id)) AS effort, max(value) AS value FROM events GROUP BY ALL""")
def best_configuration(spark, sf_dir):
    points = V.table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("day"), F.col("event_type").alias("model"),
        F.col("user_id").alias("effort"), "value", F.col("event_id").alias("ord"))
    return C.best_configuration(points).select(day_text(), "model", "effort", "value")


@register("quote_changes", "WITH " + SERIES + """,
l AS (SELECT *, lag(value) OVER (PARTITION BY key ORDER BY day) AS prev_close FROM series)
SELECT key AS symbol, strftime(day, '%Y-%m-%d') AS day, value AS close, prev_close,
  round((value - prev_close) / prev_close * 100, 4) AS change_pct FROM l""")
def quote_changes(spark, sf_dir):
    quotes = index_series(spark, sf_dir).select(
        F.col("key").alias("symbol"), F.to_timestamp("day").alias("ts"), F.col("value").alias("close"))
    return C.quote_changes(quotes).select(
        "symbol", F.date_format("ts", "yyyy-MM-dd").alias("day"), "close", "prev_close",
        F.round("change_pct", 4).alias("change_pct"))


@register("flat_prices", """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name,
  round(CAST(CAST(p_retailprice AS VARCHAR) AS DOUBLE) * 1e6, 4) AS prompt,
  round(CAST(p_size AS DOUBLE) * 1e6, 4) AS completion FROM part
WHERE contains(lower(CAST(p_partkey AS VARCHAR)) || ' ' || lower(p_name), 'ring')
  OR contains(lower(CAST(p_partkey AS VARCHAR)) || ' ' || lower(p_name), '12')""")
def flat_prices(spark, sf_dir):
    models = V.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"),
        F.col("p_retailprice").cast("string").alias("prompt"),
        F.col("p_size").cast("string").alias("completion"))
    return C.flat_price_snapshot(models, ["ring", "12"])


# --- health -------------------------------------------------------------------
def fetch_log(spark, sf_dir):
    return captures(spark, sf_dir).withColumn("fetched_at", F.col("at"))


@register("source_health", V.STORY_INPUT + "," + ENTRIES + """,
l AS (SELECT source, count(*) FILTER (status IN ('ok', 'partial', 'error')) AS attempt_days,
  count(*) FILTER (status = 'ok') AS success_days, count(*) FILTER (status = 'error') AS failure_days,
  count(*) FILTER (status = 'partial') AS partial_days, count(*) FILTER (status = 'skipped') AS skipped_days,
  count(*) FILTER (status = 'cached') AS cached_days, arg_max(status, day) AS last_status,
  strftime(max(last_at) FILTER (status = 'ok'), '%Y-%m-%d %H:%M:%S') AS last_success_at FROM caps GROUP BY ALL),
r AS (SELECT source_id AS source, count(DISTINCT day) AS raw_snapshot_days,
  count(*) AS raw_item_observations FROM obs GROUP BY ALL),
q AS (SELECT source_id AS source, count(*) AS qualified_observations,
  count(DISTINCT source_item_id) AS unique_qualified_items,
  count(DISTINCT source_item_id || snapshot_hash) AS unique_snapshot_versions
  FROM classified GROUP BY ALL)
SELECT e.source, category AS tier, attempt_days, success_days, failure_days, partial_days, skipped_days,
  cached_days, last_status, last_success_at, coalesce(raw_snapshot_days, 0) AS raw_snapshot_days,
  coalesce(raw_item_observations, 0) AS raw_item_observations,
  coalesce(qualified_observations, 0) AS qualified_observations,
  coalesce(unique_qualified_items, 0) AS unique_qualified_items,
  coalesce(unique_snapshot_versions, 0) AS unique_snapshot_versions,
  CASE WHEN attempt_days > 0 THEN round(success_days / attempt_days, 4) END AS success_rate,
  CASE WHEN raw_item_observations > 0 THEN
    round(coalesce(qualified_observations, 0) / raw_item_observations, 4) END AS qualification_rate
FROM entries e LEFT JOIN l USING (source) LEFT JOIN r USING (source) LEFT JOIN q USING (source)""")
def source_health(spark, sf_dir):
    dim = community_entries(spark, sf_dir).select("source", F.col("category").alias("tier"))
    rows = H.source_health(
        dim, H.log_health(fetch_log(spark, sf_dir)), H.raw_health(community_items(spark, sf_dir)),
        H.qualified_health(V.classified(spark, sf_dir, first_url_wins=False)))
    return rows.drop("stale_days", "deferred_days", "gone_days").withColumn(
        "last_success_at", F.date_format("last_success_at", "yyyy-MM-dd HH:mm:ss"))


@register("source_health_rolling", "WITH " + ENTRIES + """,
w AS (SELECT source, day, CAST(sum(CASE WHEN status IN ('ok', 'partial', 'error') THEN 1 ELSE 0 END)
    OVER t AS BIGINT) AS attempt_days,
  CAST(sum(CASE WHEN status = 'ok' THEN 1 ELSE 0 END) OVER t AS BIGINT) AS success_days FROM caps
  WINDOW t AS (PARTITION BY source ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW))
SELECT source, strftime(day, '%Y-%m-%d') AS day, attempt_days, success_days,
  CASE WHEN attempt_days > 0 THEN round(success_days / attempt_days, 4) END AS success_rate FROM w""")
def source_health_rolling(spark, sf_dir):
    return H.rolling_health(fetch_log(spark, sf_dir)).select(
        "source", day_text(), "attempt_days", "success_days", "success_rate")


@register("snapshot_times", "WITH " + V.OBSERVATIONS + """
SELECT strftime(day, '%Y-%m-%d') AS day, strftime(max(fetched_ts), '%Y-%m-%d %H:%M:%S') AS snapshot_at
FROM obs GROUP BY day""")
def snapshot_times(spark, sf_dir):
    return H.snapshot_at(V.observations(spark, sf_dir)).select(
        day_text(), F.date_format("snapshot_at", "yyyy-MM-dd HH:mm:ss").alias("snapshot_at"))


def http_events(spark, sf_dir):
    kind = F.col("event_type")
    status = (F.when(kind == "purchase", "miss").when(kind == "error", "error")
              .when(kind == "view", "fresh").when(kind == "click", "stale_backoff")
              .when(F.col("value") > 200, "").otherwise("deferred"))
    return V.table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("day"),
        F.concat(F.lit("src"), "user_id").alias("source"), status.alias("cache_status"),
        F.when(kind == "purchase", 1).when(kind == "error", 2).otherwise(0).alias("network_attempts"),
        F.when((kind == "error") & (F.col("value") > 60), 410).alias("terminal_status"),
        F.when(kind == "purchase", F.col("ts")).alias("last_network_success_at"))


HTTP = """
h AS (SELECT CAST(ts AS DATE) AS day, 'src' || user_id AS source,
  CASE event_type WHEN 'purchase' THEN 'miss' WHEN 'error' THEN 'error' WHEN 'view' THEN 'fresh'
    WHEN 'click' THEN 'stale_backoff' ELSE CASE WHEN value > 200 THEN 'unknown' ELSE 'deferred' END END AS st,
  CASE event_type WHEN 'purchase' THEN 1 WHEN 'error' THEN 2 ELSE 0 END AS att,
  CASE WHEN event_type = 'error' AND value > 60 THEN 410 END AS term,
  CASE WHEN event_type = 'purchase' THEN ts END AS ok_at FROM events)"""


@register("fetch_status_rollup", "WITH " + HTTP + """,
f AS (SELECT day, source, count(*) FILTER (st = 'error') AS e, count(*) FILTER (st = 'deferred') AS d,
  count(*) FILTER (term = 410) AS g, count(*) FILTER (st = 'error' AND term IS NULL) AS oe,
  count(*) FILTER (st = 'deferred' AND term IS NULL) AS od, count(*) FILTER (st = 'unknown') AS ou,
  count(*) FILTER (st NOT IN ('error', 'deferred', 'unknown')) AS u,
  count(*) FILTER (st = 'stale_backoff') AS s, count(*) FILTER (att > 0 AND st <> 'error') AS ns,
  CAST(sum(att) AS BIGINT) AS network_attempts, max(ok_at) AS ok_at FROM h GROUP BY ALL)
SELECT strftime(day, '%Y-%m-%d') AS day, source, network_attempts, u AS usable_responses,
  strftime(ok_at, '%Y-%m-%d %H:%M:%S') AS last_network_success_at,
  CASE WHEN (e > 0 OR d > 0 OR g > 0) AND u > 0 THEN 'partial' WHEN oe > 0 OR ou > 0 THEN 'error'
    WHEN od > 0 THEN 'deferred' WHEN g > 0 THEN 'gone' WHEN e > 0 THEN 'error' WHEN ns > 0 THEN 'ok'
    WHEN s > 0 THEN 'stale' WHEN d > 0 THEN 'deferred' ELSE 'cached' END AS source_status FROM f""")
def fetch_status_rollup(spark, sf_dir):
    return H.fetch_rollup(http_events(spark, sf_dir)).select(
        day_text(), "source", "network_attempts", "usable_responses",
        F.date_format("last_network_success_at", "yyyy-MM-dd HH:mm:ss").alias("last_network_success_at"),
        "source_status")


@register("cache_status_counts", "WITH " + HTTP + """
SELECT strftime(day, '%Y-%m-%d') AS day, source, st AS cache_status, count(*) AS events
FROM h GROUP BY ALL""")
def cache_status_counts(spark, sf_dir):
    return H.cache_status_counts(http_events(spark, sf_dir)).select(
        day_text(), "source", "cache_status", "events")


@register("fetch_streaks", """
WITH e AS (SELECT event_id, 'src' || (user_id % 20) AS source, ts, event_type = 'error' AS failed,
    event_type IN ('view', 'click') AS unchanged,
    row_number() OVER (PARTITION BY user_id % 20 ORDER BY ts, event_id) AS no FROM events)
SELECT event_id, source,
  no - coalesce(max(CASE WHEN NOT failed THEN no END) OVER w, 0) AS failure_streak,
  no - coalesce(max(CASE WHEN NOT unchanged THEN no END) OVER w, 0) AS unchanged_streak
FROM e WINDOW w AS (PARTITION BY source ORDER BY no)""")
def fetch_streaks(spark, sf_dir):
    log = V.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("fetch_id"), F.concat(F.lit("src"), F.col("user_id") % 20).alias("source"),
        "ts", (F.col("event_type") == "error").alias("failed"),
        F.col("event_type").isin("view", "click").alias("unchanged"))
    return H.fetch_streaks(log).select(F.col("fetch_id").alias("event_id"), "source",
                                       "failure_streak", "unchanged_streak")


@register("run_summary", "WITH " + ENTRIES + """
SELECT strftime(day, '%Y-%m-%d') AS day, count(*) FILTER (status = 'ok') AS ok,
  count(*) FILTER (status = 'cached') AS cached, count(*) FILTER (status = 'skipped') AS skipped,
  count(*) FILTER (status = 'error') AS error, count(*) FILTER (status = 'partial') AS partial,
  count(*) FILTER (status = 'gone') AS gone,
  coalesce(string_agg(source, '|' ORDER BY source) FILTER (status = 'error'), '') AS failed_sources,
  coalesce(string_agg(source, '|' ORDER BY source) FILTER (status = 'partial'), '') AS partial_sources,
  coalesce(string_agg(source, '|' ORDER BY source) FILTER (status = 'gone'), '') AS gone_sources
FROM caps GROUP BY day""")
def run_summary(spark, sf_dir):
    return H.run_summary(fetch_log(spark, sf_dir)).withColumn(
        "day", F.date_format("day", "yyyy-MM-dd"))


# --- backtest -----------------------------------------------------------------
def _indexed(prefix):
    return f"""
{prefix}i AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY day, source_item_id
  ORDER BY section_ord DESC, source_id DESC, item_ord DESC) AS last FROM {prefix}classified)
  WHERE last = 1)"""


BACKTEST = ("WITH " + V.OBSERVATIONS + "," + V.sql_classified(prefix="a_") + ","
            + V.sql_classified(V.CANDIDATE_RULES, prefix="b_") + "," + _indexed("a_") + ","
            + _indexed("b_") + """,
cmp AS (SELECT coalesce(a.day, b.day) AS day, coalesce(a.source_item_id, b.source_item_id) AS item,
  coalesce(b.source_id, a.source_id) AS source_id, a.section AS baseline_section,
  b.section AS candidate_section, coalesce(b.item_ord, a.item_ord) AS item_ord,
  CASE WHEN a.section IS NULL THEN 'added' WHEN b.section IS NULL THEN 'removed'
    WHEN a.section <> b.section THEN 'moved' ELSE 'kept' END AS change
  FROM a_i a FULL JOIN b_i b ON a.day = b.day AND a.source_item_id = b.source_item_id)""")


def compared(spark, sf_dir):
    return B.compare_rules(V.observations(spark, sf_dir), V.RULES, V.CANDIDATE_RULES, V.WINDOW_DAYS)


@register("rule_backtest_diff", BACKTEST + """
SELECT strftime(day, '%Y-%m-%d') AS day, item, source_id, baseline_section, candidate_section, change
FROM cmp WHERE change <> 'kept'""")
def rule_backtest_diff(spark, sf_dir):
    return compared(spark, sf_dir).where(F.col("change") != "kept").select(
        day_text(), F.col("source_item_id").alias("item"), "source_id", "baseline_section",
        "candidate_section", "change")


@register("rule_backtest_summary", BACKTEST + """
SELECT count(baseline_section) AS baseline_kept, count(candidate_section) AS candidate_kept,
  count(*) FILTER (change = 'added') AS added, count(*) FILTER (change = 'removed') AS removed,
  count(*) FILTER (change = 'moved') AS moved FROM cmp""")
def rule_backtest_summary(spark, sf_dir):
    return B.change_summary(compared(spark, sf_dir))


@register("rule_backtest_deltas", BACKTEST + """,
s AS (SELECT unnest([""" + ", ".join(V.quote(s) for s in V.fixed.SECTIONS) + """]) AS section)
SELECT 'section' AS kind, section AS name, (SELECT count(*) FROM cmp WHERE baseline_section = section)
  AS baseline, (SELECT count(*) FROM cmp WHERE candidate_section = section) AS candidate,
  (SELECT count(*) FROM cmp WHERE candidate_section = section)
  - (SELECT count(*) FROM cmp WHERE baseline_section = section) AS delta FROM s
UNION ALL SELECT 'source', source_id, count(baseline_section), count(candidate_section),
  count(candidate_section) - count(baseline_section) FROM cmp GROUP BY source_id""")
def rule_backtest_deltas(spark, sf_dir):
    rows = compared(spark, sf_dir)
    sections = B.section_deltas(rows).select(
        F.lit("section").alias("kind"), F.col("section").alias("name"), "baseline", "candidate", "delta")
    sources = B.source_deltas(rows).select(
        F.lit("source").alias("kind"), F.col("source_id").alias("name"), "baseline", "candidate", "delta")
    return sections.unionByName(sources)


@register("rule_precision", V.STORY_INPUT + """,
hit AS (SELECT DISTINCT item_ord AS doc_id FROM classified)
SELECT l.quality, count(*) AS labelled, count(h.doc_id) AS kept,
  round(count(h.doc_id) / count(*), 6) AS share FROM labels l LEFT JOIN hit h USING (doc_id)
GROUP BY l.quality""")
def rule_precision(spark, sf_dir):
    hits = V.classified(spark, sf_dir, first_url_wins=False).select(
        F.col("item_ord").alias("doc_id"), F.lit(1).alias("hit"))
    labels = V.table(spark, sf_dir, "labels")
    return (labels.join(hits, "doc_id", "left").groupBy("quality")
            .agg(F.count("*").alias("labelled"), F.count("hit").alias("kept"))
            .withColumn("share", F.round(F.col("kept") / F.col("labelled"), 6)))
