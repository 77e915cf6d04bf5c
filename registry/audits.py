"""Audit queries: signals, features, routing, scores, sampling and retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsledger import fixed_values as fixed
from newsledger.functions import text as T, times, urls as U
from newsledger.operators import audits as A, retention as R, routing
from newsledger.operators.barrier import computed
from newsledger.operators.features import (Markers, community_features, expert_features,
                                           item_quality)
from newsledger.operators.ordered import with_ranged_sum
from newsledger.operators.signals import (
    audit_signals, baseline_lead, baseline_points, community_signals, effective_time, item_key,
    item_matches, signal_matches, signal_points)
from newsledger.session import materialize
from registry import SQL, register, views as V
from registry.digests import day_text, joined

def end_day():
    return F.lit(V.LAST_DAY).cast("date")

MARKERS = Markers(groups={"alpha": ["tion", "ment"], "beta": ["keit", "heit"],
                          "gamma": ["erly", "inble"]}, noise=["pour"])
PARTITION_SETS = [["release", "field_test"], ["pricing", "degradation", "company"],
                  ["field_test", "research_synthesis"], []]
EXPERT_TYPE = ("struct<technical_groups:array<string>,method_hits:array<string>,"
               "firsthand_hits:array<string>,synthesis_hits:array<string>,"
               "artifact_urls:array<string>,conflict_keywords:array<string>,"
               "fulltext_used:boolean,fulltext_chars:int,content_hash:string>")


def community_items(spark, sf_dir):
    return (V.observations(spark, sf_dir).withColumnRenamed("source_id", "source"))


# --- shared SQL ---------------------------------------------------------------
# links found in text end before an ampersand
_EXTERNAL = "regexp_extract(external_url, '^[^&]*')"
_PAGE = "regexp_extract(url, '^[^&]*')"
_LINKS = ("list_sort(list_distinct(list_filter([paper_link, post_link, CASE WHEN external_url "
          f"<> '' THEN {V.sql_match_url(_EXTERNAL)} END], lambda x: x IS NOT NULL)))")
_KEY = (r"array_to_string(list_filter(regexp_extract_all(lower({0}), '[a-z0-9][a-z0-9_+.\-]*'), "
        "lambda w: length(w) > 2)[1:20], ' ')")
_LOW = "lower(title || ' ' || replace(summary, '&amp;', '&'))"


def _any(body, words):
    return "(" + " OR ".join(f"contains({body}, {V.quote(w.lower())})" for w in words) + ")"


COMMUNITY = V.OBSERVATIONS + f""",
f0 AS (SELECT *, list_filter([paper_link, CASE WHEN external_url <> '' THEN
    {V.sql_match_url(_EXTERNAL)} END], lambda x: x IS NOT NULL AND
    regexp_matches(x, '^https://(www\\.github\\.com|github\\.com|arxiv\\.org)/')) AS direct_raw,
  list_filter([""" + ", ".join(
    f"CASE WHEN {_any(_LOW, words)} THEN '{name}' END" for name, words in MARKERS.groups.items()
) + f"""], lambda x: x IS NOT NULL) AS marker_groups,
  {_any(_LOW, MARKERS.noise)} AS noise_proxy,
  regexp_matches(title || ' ' || summary,
    '(?i)\\b\\d+(\\.\\d+)?\\s*(ms|gb|mb|%|tok(en)?s?/s|x)\\b') AS concrete FROM obs),
f1 AS (SELECT *, list_sort(direct_raw) AS direct_urls, len(direct_raw) > 0 AS direct_evidence,
  len(marker_groups) >= 2 OR (len(direct_raw) > 0 AND len(marker_groups) >= 1) AS technical_proxy
  FROM f0),
feat AS (SELECT *, direct_evidence OR (concrete AND technical_proxy) AS evidence_proxy,
  coalesce(CASE WHEN published LIKE '20%' THEN published_at END, fetched_ts) AS ts,
  CASE WHEN url <> '' THEN {V.sql_match_url('url')} END AS item_key,
  CASE WHEN len(direct_urls) > 0 THEN [('url-sha256:' || sha256(u)) FOR u IN direct_urls]
       WHEN {_KEY.format('title')} <> '' THEN ['title:' || {_KEY.format('title')}]
       ELSE [] END AS signals FROM f1)"""

UNIQUE = """,
uniq AS (SELECT * EXCLUDE (ts, rn), first_ts AS ts FROM (
  SELECT *, min(ts) OVER (PARTITION BY source_id, item_key) AS first_ts,
    row_number() OVER (PARTITION BY source_id, item_key ORDER BY day, item_ord) AS rn
  FROM {0}) WHERE rn = 1),
points AS (SELECT DISTINCT unnest(signals) AS signal, source_id, ts FROM feat WHERE ts IS NOT NULL),
probes AS (SELECT source_id, item_key, unnest(signals) AS signal, ts FROM uniq WHERE ts IS NOT NULL),
matches AS (
  SELECT p.source_id, p.item_key, p.signal, p.ts, count(DISTINCT q.source_id) > 1 AS shared,
    CASE WHEN count(DISTINCT q.source_id) > 1 AND bool_or(q.source_id = p.source_id AND q.ts = p.ts)
      THEN (epoch_us(p.ts) - epoch_us(min(q.ts))) / 3600000000.0 END AS lag_hours
  FROM probes p JOIN points q ON p.signal = q.signal
    AND q.ts BETWEEN p.ts - INTERVAL 30 DAY AND p.ts + INTERVAL 30 DAY GROUP BY p.source_id, p.item_key, p.signal, p.ts)"""

_BASE_LINKS = (f"list_filter([paper_link, post_link, CASE WHEN external_url <> '' THEN "
               f"{V.sql_match_url(_EXTERNAL)} END, {V.sql_match_url(_PAGE)}], "
               "lambda x: x IS NOT NULL)")
BASELINE = f""",
base0 AS (SELECT *, coalesce(CASE WHEN published LIKE '20%' THEN published_at END, fetched_ts)
    AS ts, list_concat([('url-sha256:' || sha256(u)) FOR u IN {_BASE_LINKS}],
    CASE WHEN {_KEY.format('title')} <> '' THEN ['title:' || {_KEY.format('title')}] ELSE [] END)
    AS base_signals FROM obs WHERE tier <> 'community'),
baseline AS (SELECT DISTINCT unnest(base_signals) AS signal, ts FROM base0),
leads AS (SELECT p.source_id, p.item_key,
    (epoch_us(min(b.ts)) - epoch_us(min(p.ts))) / 3600000000.0 AS lead_hours
  FROM probes p JOIN baseline b ON p.signal = b.signal
    AND b.ts BETWEEN p.ts - INTERVAL 30 DAY AND p.ts + INTERVAL 30 DAY GROUP BY ALL)"""


def _featured(spark, sf_dir):
    rows = community_signals(community_features(community_items(spark, sf_dir), MARKERS),
                             list(MARKERS.domains))
    rows = computed(rows, {
        "ts": effective_time(F.col("published"), F.col("fetched_at")),
        "item_key": item_key(U.match_url(F.col("url")), F.col("title"))})
    return materialize(rows, ["source", "day", "item_ord", "item_key", "ts", "signals"])


@register("item_features", "WITH " + COMMUNITY + """
SELECT item_ord, source_id AS source, technical_proxy, evidence_proxy, direct_evidence, noise_proxy,
  array_to_string(direct_urls, '|') AS direct_urls,
  array_to_string(marker_groups, '|') AS marker_groups FROM feat""")
def item_features_query(spark, sf_dir):
    rows = community_features(community_items(spark, sf_dir), MARKERS)
    return rows.select("item_ord", "source", "technical_proxy", "evidence_proxy",
                       "direct_evidence", "noise_proxy", joined("direct_urls"),
                       joined("marker_groups"))


@register("signal_duplicates", "WITH " + COMMUNITY + UNIQUE.format("feat") + """
SELECT source_id AS source, count(*) AS items,
  CAST(sum(CASE WHEN shared THEN 1 ELSE 0 END) AS BIGINT) AS shared FROM (
  SELECT source_id, item_key, bool_or(shared) AS shared FROM matches GROUP BY ALL) GROUP BY ALL""")
def signal_duplicates(spark, sf_dir):
    rows = _featured(spark, sf_dir)
    found = item_matches(signal_matches(A.unique_items(rows), signal_points(rows)))
    return found.groupBy("source").agg(F.count("*").alias("items"),
                                       F.sum("duplicate").alias("shared"))


@register("signal_lag", "WITH " + COMMUNITY + UNIQUE.format("feat") + """
SELECT source_id AS source, item_key, signal, shared, round(lag_hours, 6) AS lag_hours
FROM matches""")
def signal_lag(spark, sf_dir):
    rows = _featured(spark, sf_dir)
    return signal_matches(A.unique_items(rows), signal_points(rows)).select(
        "source", "item_key", "signal", "shared", F.round("lag_hours", 6).alias("lag_hours"))


def _baseline(spark, sf_dir):
    return baseline_points(V.observations(spark, sf_dir).where(F.col("tier") != "community"))


@register("baseline_lead", "WITH " + COMMUNITY + UNIQUE.format("feat") + BASELINE + """
SELECT source_id AS source, item_key, round(lead_hours, 6) AS lead_hours FROM leads""")
def baseline_lead_query(spark, sf_dir):
    unique = A.unique_items(_featured(spark, sf_dir))
    return baseline_lead(unique, _baseline(spark, sf_dir)).select(
        "source", "item_key", F.round("lead_hours", 6).alias("lead_hours"))


def community_entries(spark, sf_dir):
    """Configured communities: every source that occurs in the event log."""
    number = (F.col("user_id") % V.SOURCES).alias("number")
    users = V.table(spark, sf_dir, "events").select(number).distinct()
    return users.select(
        F.concat(F.lit("src"), "number").alias("source"), V.tier_of(F.col("number")).alias("category"),
        F.when(F.col("number") == 0, "control").otherwise("candidate").alias("role"),
        F.col("number").cast("int").alias("entry_ord"))


def captures(spark, sf_dir):
    """One row per source and day seen in the event log; the last event gives status."""
    events = V.table(spark, sf_dir, "events")
    status = (F.when(F.col("event_type") == "purchase", "ok").when(F.col("event_type") == "error", "error")
              .when(F.col("event_type") == "view", "cached").when(F.col("event_type") == "click", "partial")
              .otherwise("skipped"))
    return (events.select(F.concat(F.lit("src"), F.col("user_id") % V.SOURCES).alias("source"),
                          F.to_date("ts").alias("day"), "ts", "event_id", status.alias("status"))
            .groupBy("source", "day")
            .agg(F.max_by("status", F.struct("ts", "event_id")).alias("status"),
                 F.max("ts").alias("at")))


ENTRIES = f"""
entries AS (SELECT DISTINCT 'src' || (user_id % {V.SOURCES}) AS source,
  {V._TIER_LIST}[CAST(user_id % {V.SOURCES} % 6 AS INTEGER) + 1] AS category,
  CASE WHEN user_id % {V.SOURCES} = 0 THEN 'control' ELSE 'candidate' END AS role,
  CAST(user_id % {V.SOURCES} AS INTEGER) AS entry_ord FROM events),
caps AS (SELECT 'src' || (user_id % {V.SOURCES}) AS source, CAST(ts AS DATE) AS day,
  arg_max(CASE event_type WHEN 'purchase' THEN 'ok' WHEN 'error' THEN 'error' WHEN 'view' THEN
    'cached' WHEN 'click' THEN 'partial' ELSE 'skipped' END, (ts, event_id)) AS status,
  max(ts) AS last_at FROM events GROUP BY ALL)"""


@register("community_scores", "WITH " + ENTRIES + "," + COMMUNITY + """,
kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY day DESC) AS rn
  FROM caps) WHERE rn <= 14),
recent AS (SELECT f.* FROM feat f SEMI JOIN kept k ON f.source_id = k.source AND f.day = k.day)"""
          + UNIQUE.format("recent") + BASELINE + f""",
dup AS (SELECT source_id, item_key, bool_or(shared) AS shared FROM matches GROUP BY ALL),
rates AS (SELECT u.source_id AS source, count(*) AS unique_posts,
  avg(CAST(technical_proxy AS DOUBLE)) AS technical, avg(CAST(evidence_proxy AS DOUBLE)) AS evidence,
  avg(CAST(direct_evidence AS DOUBLE)) AS direct, avg(CAST(noise_proxy AS DOUBLE)) AS noise,
  avg(CASE WHEN d.shared THEN 1.0 ELSE 0.0 END) AS duplicate_rate,
  count(l.lead_hours) AS existing_matches, median(l.lead_hours) AS lead_hours
  FROM uniq u LEFT JOIN dup d USING (source_id, item_key)
  LEFT JOIN leads l USING (source_id, item_key) GROUP BY ALL),
fresh0 AS (SELECT source_id, day, count(*) AS fresh FROM obs WHERE published LIKE '20%'
  AND epoch_us(fetched_ts) - epoch_us(published_at) BETWEEN 0 AND 86400000000 GROUP BY ALL),
fresh AS (SELECT k.source, median(CAST(coalesce(f.fresh, 0) AS DOUBLE)) AS fresh_median
  FROM kept k LEFT JOIN fresh0 f ON f.source_id = k.source AND f.day = k.day GROUP BY ALL),
days AS (SELECT source, count(DISTINCT day) AS attempt_days,
  count(DISTINCT CASE WHEN status = 'ok' THEN day END) AS sample_days FROM kept GROUP BY ALL),
s AS (SELECT e.source, category, role, coalesce(attempt_days, 0) AS attempt_days,
  coalesce(sample_days, 0) AS sample_days, coalesce(unique_posts, 0) AS unique_posts,
  coalesce(fresh_median, 0) AS fresh_median, coalesce(technical, 0) AS technical,
  coalesce(evidence, 0) AS evidence, coalesce(direct, 0) AS direct, coalesce(noise, 0) AS noise,
  coalesce(duplicate_rate, 0) AS duplicate_rate, coalesce(existing_matches, 0) AS existing_matches,
  lead_hours FROM entries e LEFT JOIN days USING (source) LEFT JOIN rates USING (source)
  LEFT JOIN fresh USING (source)),
t AS (SELECT *, CASE WHEN unique_posts > 0 THEN CAST(round_even(100 * (0.30 * technical
  + 0.22 * evidence + 0.13 * direct + 0.12 * (1 - duplicate_rate)
  + 0.08 * coalesce(greatest(0.0, least(1.0, lead_hours / 24)), 0.0)
  + 0.15 * least(1.0, fresh_median / 5.0) - 0.20 * noise), 0) AS INTEGER) ELSE 0 END AS score FROM s)
SELECT source, category, role, attempt_days, sample_days, unique_posts, fresh_median,
  round(technical, 6) AS technical, round(evidence, 6) AS evidence, round(direct, 6) AS direct,
  round(noise, 6) AS noise, round(duplicate_rate, 6) AS duplicate_rate, existing_matches,
  round(lead_hours, 6) AS lead_hours, score,
  CASE WHEN role = 'control' THEN '{fixed.DECISION_CONTROL}'
    WHEN attempt_days < 14 THEN '{fixed.DECISION_COLLECTING} ' || attempt_days || '/14'
    WHEN unique_posts = 0 THEN '{fixed.DECISION_UNREACHABLE}'
    WHEN score >= 60 AND technical >= 0.35 AND fresh_median >= 2 THEN '{fixed.DECISION_CORE}'
    WHEN score >= 42 AND technical >= 0.22 THEN '{fixed.DECISION_ROTATE}'
    ELSE '{fixed.DECISION_OUT}' END AS decision FROM t""")
def community_scores(spark, sf_dir):
    scored = A.community_scores(
        community_entries(spark, sf_dir), captures(spark, sf_dir),
        community_items(spark, sf_dir), _baseline(spark, sf_dir), MARKERS)
    return scored.orderBy(*A.community_order()).select(
        "source", "category", "role", "attempt_days", "sample_days", "unique_posts",
        "fresh_median", F.round("technical_proxy", 6).alias("technical"),
        F.round("evidence_proxy", 6).alias("evidence"),
        F.round("direct_evidence", 6).alias("direct"), F.round("noise_proxy", 6).alias("noise"),
        F.round("duplicate_rate", 6).alias("duplicate_rate"), "existing_matches",
        F.round("lead_hours", 6).alias("lead_hours"), "score", "decision")


@register("community_places", f"""
SELECT source, score, row_number() OVER (
  ORDER BY role = 'control' NULLS FIRST, score DESC, lower(source)) AS place
FROM ({SQL["community_scores"]}) AS scored""")
def community_places(spark, sf_dir):
    """The place of every candidate in the report's order."""
    scored = materialize(community_scores(spark, sf_dir).select("source", "role", "score"))
    return with_ranged_sum(scored, A.community_order(), F.lit(1), "place").select(
        "source", "score", F.col("place").cast("bigint").alias("place"))
