"""Partition audit, sampling, coverage and retention queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsledger import fixed_values as fixed
from newsledger.functions import text as T
from newsledger.operators import audits as A, retention as R, routing
from newsledger.operators.barrier import computed
from newsledger.operators.features import EXPERT_METHODS, expert_features, item_quality
from newsledger.operators.skew import broadcast_if_small
from registry import register, views as V
from registry.audits import (COMMUNITY, ENTRIES, _any, _KEY, _EXTERNAL, captures, community_entries,
                             community_items, end_day)
from registry.digests import day_text, joined

ROUTINGS = ["classify", "forced", "forced_recent", "expert_author"]
ALLOWED = [[], ["pricing", "degradation", "company"], ["release", "field_test"],
           ["field_test", "research_synthesis"]]
DIM_SOURCES = 25


def _number(source: str = "source"):
    return F.regexp_extract(source, r"\d+", 0).cast("int")


def sources(spark, sf_dir):
    """Audited sources; the last five are configured but never sampled."""
    number = (F.col("user_id") % DIM_SOURCES).alias("number")
    n = F.col("number")
    sets = F.array(*[F.array(*[F.lit(x) for x in a]).cast("array<string>") for a in ALLOWED])
    return (V.table(spark, sf_dir, "events").select(number).distinct().select(
        F.concat(F.lit("src"), n).alias("source"), F.concat(F.lit("Source "), n).alias("name"),
        V.tier_of(n).alias("tier"),
        F.when(n % 5 == 0, "original_author").otherwise("").alias("evidence_role"),
        F.when(n % 5 == 4, "incumbent").otherwise("candidate").alias("role"),
        F.when(n % 7 == 3, "low_frequency").otherwise("daily").alias("cadence"),
        F.element_at(F.array(*[F.lit(r) for r in ROUTINGS]), (n % 4 + 1).cast("int")).alias("routing"),
        F.when(n % 4 == 3, "expert_author").otherwise("").alias("track"),
        F.when(n % 6 == 2, "vendor").otherwise("").alias("affiliation"),
        F.when(n % 4 == 2, 2).cast("int").alias("lookback_days"),
        F.element_at(sets, (n % 4 + 1).cast("int")).alias("partitions"),
        F.lit(True).alias("enabled")))


def audit_items(spark, sf_dir, ok_only=True):
    """Observations with the status of their capture and the settings of their source. All but
    ``expert_features`` drop items of captures that are not ok: that is done before their texts
    are read."""
    rows = community_items(spark, sf_dir)
    state = captures(spark, sf_dir).select("source", "day", "status")
    dim = sources(spark, sf_dir).select("source", "evidence_role", "role", "routing", "track",
                                        "lookback_days", "partitions")
    paper = F.regexp_extract("summary", "https://arxiv.org/abs/[0-9]+", 0)
    words = F.when(_number() % 3 == 0, F.array(F.lit("heit"), F.lit("ment")))
    # small beside the texts, which are not shuffled for it
    rows = rows.join(broadcast_if_small(state), ["source", "day"], "left")
    if ok_only:
        rows = rows.where(F.coalesce("status", F.lit("ok")) == "ok")
    rows = (rows.join(broadcast_if_small(dim), "source")
            .withColumn("external_urls", F.when(paper != "", F.array(paper))
                        .otherwise(T.empty_strings()))
            .withColumn("fulltext", F.col("summary"))
            .withColumn("conflict_words", words))
    rows = expert_features(rows, F.col("track") == "expert_author")
    return routing.with_defaults(rows, "candidate")


# --- the same in SQL ----------------------------------------------------------
def _list(values):
    return "[" + ", ".join(V.quote(v) for v in values) + "]"


_SETS = "CASE number % 4 " + " ".join(
    f"WHEN {i} THEN {_list(a or fixed.PARTITIONS)}" for i, a in enumerate(ALLOWED)) + " END"
_BODY = "lower(replace(title || ' ' || summary, '&amp;', '&'))"
_METHODS = "(" + " + ".join(
    f"CAST(contains({_BODY}, {V.quote(m)}) AS INTEGER)" for m in EXPERT_METHODS) + ")"
_GROUP_COUNT = "(" + " + ".join(
    f"CAST({_any(_BODY, w)} AS INTEGER)" for w in fixed.EXPERT_TECH_GROUPS.values()) + ")"

DIM = f"""
dims AS (SELECT DISTINCT user_id % {DIM_SOURCES} AS number FROM events),
srcs AS (SELECT 'src' || number AS source, number,
  {V._TIER_LIST}[CAST(number % 6 AS INTEGER) + 1] AS tier,
  CASE WHEN number % 5 = 0 THEN 'original_author' ELSE '' END AS evidence_role,
  CASE WHEN number % 5 = 4 THEN 'incumbent' ELSE 'candidate' END AS role,
  CASE WHEN number % 7 = 3 THEN 'low_frequency' ELSE 'daily' END AS cadence,
  {_list(ROUTINGS)}[CAST(number % 4 AS INTEGER) + 1] AS routing,
  CASE WHEN number % 4 = 3 THEN 'expert_author' ELSE '' END AS track,
  CASE WHEN number % 4 = 2 THEN 2 ELSE 14 END AS lookback_days, {_SETS} AS allowed FROM dims)"""

ITEMS = f"""
items AS (SELECT o.*, s.evidence_role, s.role, s.routing, s.track, s.lookback_days, s.allowed,
  coalesce(c.status, 'ok') AS status, o.title || ' ' || o.summary AS match_text
  FROM obs o JOIN srcs s ON s.source = o.source_id
  LEFT JOIN caps c ON c.source = o.source_id AND c.day = o.day),
eligible AS (SELECT * FROM items WHERE status = 'ok' AND (routing = 'forced' OR (
  (published_at IS NULL OR published_at >= CAST(day AS TIMESTAMP) - to_days(lookback_days))
  AND (routing <> 'classify' OR (url <> '' AND coalesce(changed, TRUE))))))"""

_RULES = V.RULES
_PART_OF = {s: p for p, s in fixed.PARTITION_SECTIONS.items()}
_TOPIC_HITS = ", ".join(
    f"CASE WHEN list_contains(allowed, '{_PART_OF[t.section]}') THEN "
    f"len({V.sql_hits('match_text', t.keywords)}) ELSE 0 END AS t{i}"
    for i, t in enumerate(_RULES.topics))
_TOTAL = " + ".join(f"t{i}" for i in range(len(_RULES.topics)))
_BEST = "greatest(" + ", ".join(f"t{i}" for i in range(len(_RULES.topics))) + ")"
_CHOSEN = "CASE " + " ".join(f"WHEN t{i} = {_BEST} THEN '{_PART_OF[t.section]}'"
                             for i, t in enumerate(_RULES.topics)) + " END"
_EXPERT_KEYS = ("CASE WHEN paper_link IS NOT NULL THEN ['url:' || paper_link] ELSE "
                f"list_concat(['url:' || {V.sql_match_url('url', fixed.AUDIT_DROP_KEYS)}], "
                f"CASE WHEN {_KEY.format('title')} <> '' THEN ['title:' || {_KEY.format('title')}] "
                "ELSE [] END) END")
_OUTSIDE = (f"list_filter([paper_link, post_link, CASE WHEN external_url <> '' THEN "
            f"{V.sql_match_url(_EXTERNAL, fixed.AUDIT_DROP_KEYS)} END], lambda x: x IS NOT NULL)")

ROUTED = f"""
h AS (SELECT *, len({V.sql_hits('match_text', _RULES.model_keywords)}) AS m, {_TOPIC_HITS}
  FROM eligible WHERE routing = 'classify'),
c0 AS (SELECT *, CASE WHEN {_TOTAL} > 0 THEN {_CHOSEN} WHEN tier = 'official' THEN 'release'
    ELSE 'field_test' END AS raw_part,
  row_number() OVER (PARTITION BY source_id, day, url ORDER BY item_ord) AS rn
  FROM h WHERE m > 0 OR {_TOTAL} > 0),
c1 AS (SELECT *, CASE WHEN raw_part = 'field_test' AND tier IN ('official', 'index')
  THEN 'release' ELSE raw_part END AS part FROM c0 WHERE rn = 1),
x0 AS (SELECT *, {_METHODS} AS methods, {_GROUP_COUNT} AS groups,
  {_any(_BODY, fixed.EXPERT_FIRSTHAND_MARKERS)} AS firsthand,
  {_any(_BODY, fixed.EXPERT_SYNTHESIS_MARKERS)} AS synthesis,
  number % 3 = 0 AND {_any(_BODY, ['heit', 'ment'])} AS conflict,
  paper_link IS NOT NULL AS artifacts FROM eligible WHERE routing = 'expert_author'),
x1 AS (SELECT *, CASE WHEN firsthand AND (methods >= 2 OR (methods >= 1 AND artifacts))
  THEN 'field_test' WHEN groups >= 2 OR (conflict AND groups >= 1) THEN 'research_synthesis' END
  AS part FROM x0),
routed AS (
  SELECT item_ord, source_id, day, tier, title, summary, url, published, published_at, fetched_ts,
    paper_link, post_link, external_url, evidence_role, role, allowed, CAST(NULL AS BOOLEAN) AS readable,
    part AS partition, FALSE AS expert, 0 AS groups, FALSE AS conflict, FALSE AS synthesis,
    FALSE AS tested FROM c1 WHERE list_contains(allowed, part)
  UNION ALL
  SELECT item_ord, source_id, day, tier, title, summary, url, published, published_at, fetched_ts,
    paper_link, post_link, external_url, evidence_role, role, allowed, readable, part, TRUE, groups,
    conflict, synthesis, firsthand AND (methods >= 2 OR (methods >= 1 AND artifacts))
  FROM x1 WHERE part IS NOT NULL
  UNION ALL
  SELECT item_ord, source_id, day, tier, title, summary, url, published, published_at, fetched_ts,
    paper_link, post_link, external_url, evidence_role, role, allowed, readable, unnest(allowed),
    FALSE, 0, FALSE, FALSE, FALSE FROM eligible WHERE routing IN ('forced', 'forced_recent'))"""

_PLAIN_METHODS = "(" + " + ".join(
    f"CAST(contains({_BODY}, {V.quote(m)}) AS INTEGER)" for m in fixed.METHOD_MARKERS) + ")"
QUALITY = f"""
q0 AS (SELECT *, {_any(_BODY, fixed.NOISE_MARKERS)} AS noisy, {_any(_BODY, fixed.RELEASE_MARKERS)} AS rel,
  {_any(_BODY, fixed.PRICE_MARKERS)} AS price, {_any(_BODY, fixed.DIAGNOSTIC_MARKERS)} AS diag,
  {_any(_BODY, fixed.CORPORATE_MARKERS)} AS corp, {_any(_BODY, fixed.TECH_MARKERS)} AS tech,
  {_PLAIN_METHODS} AS plain_methods, paper_link IS NOT NULL AS artifact,
  regexp_matches({_BODY}, '(?i)[$￥¥]|\\b(USD|CNY)\\b|\\d+(\\.\\d+)?\\s*元') AS currency,
  regexp_matches({_BODY}, '(?i)\\b\\d+(\\.\\d+)?\\s*(%|ms|s|minutes?|hours?)\\b') AS duration,
  tier IN ('official', 'finance', 'radar') AS trusted, coalesce(NOT readable, FALSE) AS unreadable
  FROM routed),
q1 AS (SELECT *, CASE WHEN expert THEN tested ELSE plain_methods >= 2 OR (plain_methods >= 1
  AND artifact) END AS test_ok, (noisy AND NOT trusted) OR unreadable AS base_noise FROM q0),
quality AS (SELECT *, CASE partition WHEN 'field_test' THEN test_ok AND (tier = 'radar'
    OR evidence_role = 'original_author') WHEN 'research_synthesis' THEN FALSE ELSE trusted END
    AS is_primary,
  NOT unreadable AND CASE partition WHEN 'release' THEN artifact OR rel WHEN 'field_test' THEN test_ok
    WHEN 'research_synthesis' THEN expert AND (groups >= 2 OR (conflict AND groups >= 1)) AND
      ((conflict AND groups >= 1) OR synthesis OR artifact OR length(summary) >= 300)
    WHEN 'pricing' THEN currency AND price WHEN 'degradation' THEN diag AND (trusted OR duration)
    ELSE corp OR tier = 'finance' END AS is_quality,
  CASE partition WHEN 'research_synthesis' THEN base_noise OR groups < 2
    WHEN 'company' THEN base_noise OR (tech AND NOT corp AND tier NOT IN ('official', 'finance'))
    ELSE base_noise END AS is_noise,
  CASE WHEN expert THEN {_EXPERT_KEYS} WHEN len({_OUTSIDE}) > 0 THEN
      [('url:' || u) FOR u IN {_OUTSIDE}]
    ELSE ['url:' || {V.sql_match_url('url', fixed.AUDIT_DROP_KEYS)}] END AS signals,
  {V.sql_match_url('url', fixed.AUDIT_DROP_KEYS)} AS item_key,
  coalesce(published_at, fetched_ts) AS ts FROM q1)"""

AUDIT = "WITH " + ENTRIES + "," + V.OBSERVATIONS + "," + DIM + "," + ITEMS + "," + ROUTED + "," + QUALITY


@register("eligible_items", AUDIT + """
SELECT item_ord, source_id AS source, routing FROM eligible""")
def eligible_items(spark, sf_dir):
    return routing.eligible_items(audit_items(spark, sf_dir)).select("item_ord", "source", "routing")


@register("routed_items", AUDIT + """
SELECT item_ord, source_id AS source, partition FROM routed""")
def routed_items(spark, sf_dir):
    return routing.route_items(audit_items(spark, sf_dir), V.RULES, ["item_ord", "source"])


@register("item_quality", AUDIT + """
SELECT item_ord, source_id AS source, partition, is_primary AS "primary", is_quality AS quality,
  is_noise AS noise, conflict FROM quality""")
def item_quality_query(spark, sf_dir):
    rows = routing.route_items(audit_items(spark, sf_dir), V.RULES)
    return item_quality(rows).select("item_ord", "source", "partition", "primary", "quality",
                                     "noise", "conflict")


@register("expert_features", AUDIT + f"""
SELECT item_ord, {_GROUP_COUNT} AS groups, {_METHODS} AS methods,
  {_any(_BODY, fixed.EXPERT_FIRSTHAND_MARKERS)} AS firsthand,
  {_any(_BODY, fixed.EXPERT_SYNTHESIS_MARKERS)} AS synthesis,
  coalesce(paper_link, '') AS artifacts, CAST(length(summary) AS INTEGER) AS fulltext_chars
FROM items WHERE routing = 'expert_author'""")
def expert_features_query(spark, sf_dir):
    rows = audit_items(spark, sf_dir, ok_only=False).where(F.col("expert_features").isNotNull())
    e = F.col("expert_features")
    return rows.select("item_ord", F.size(e["technical_groups"]).alias("groups"),
                       F.size(e["method_hits"]).alias("methods"),
                       (F.size(e["firsthand_hits"]) > 0).alias("firsthand"),
                       (F.size(e["synthesis_hits"]) > 0).alias("synthesis"),
                       joined("artifacts", e["artifact_urls"]),
                       e["fulltext_chars"].alias("fulltext_chars"))


@register("partition_scores", AUDIT + f""",
uniq AS (SELECT * EXCLUDE (ts, rn), first_ts AS ts FROM (
  SELECT *, min(ts) OVER (PARTITION BY partition, source_id, item_key) AS first_ts,
    row_number() OVER (PARTITION BY partition, source_id, item_key ORDER BY day, item_ord) AS rn
  FROM quality) WHERE rn = 1),
points AS (SELECT DISTINCT partition, unnest(signals) AS signal, source_id, ts FROM quality),
probes AS (SELECT partition, source_id, item_key, unnest(signals) AS signal, ts FROM uniq),
pairs AS (SELECT p.partition, p.source_id, p.item_key, p.signal, p.ts,
    count(DISTINCT q.source_id) > 1 AS shared,
    CASE WHEN count(DISTINCT q.source_id) > 1 AND bool_or(q.source_id = p.source_id AND q.ts = p.ts)
      THEN (epoch_us(p.ts) - epoch_us(min(q.ts))) / 3600000000.0 END AS lag_hours
  FROM probes p JOIN points q ON p.partition = q.partition AND p.signal = q.signal
    AND q.ts BETWEEN p.ts - INTERVAL 30 DAY AND p.ts + INTERVAL 30 DAY
  GROUP BY p.partition, p.source_id, p.item_key, p.signal, p.ts),
matched AS (SELECT partition, source_id, item_key, bool_or(shared) AS dup, min(lag_hours) AS lag_hours
  FROM pairs GROUP BY ALL),
rates AS (SELECT u.partition, u.source_id AS source, count(*) AS qualified,
  avg(CAST(is_primary AS DOUBLE)) AS p, avg(CAST(is_quality AS DOUBLE)) AS q,
  avg(CAST(is_noise AS DOUBLE)) AS n, avg(CAST(conflict AS DOUBLE)) AS c,
  avg(CASE WHEN dup THEN 1.0 ELSE 0.0 END) AS d, median(lag_hours) AS lag
  FROM uniq u LEFT JOIN matched USING (partition, source_id, item_key) GROUP BY ALL),
raws AS (SELECT source_id AS source, count(DISTINCT {V.sql_match_url('url', fixed.AUDIT_DROP_KEYS)})
  AS raw, avg(CAST(readable AS DOUBLE)) AS readability FROM eligible GROUP BY ALL),
days AS (SELECT source, count(DISTINCT day) AS attempt_days,
  count(DISTINCT CASE WHEN status = 'ok' THEN day END) AS sample_days FROM caps GROUP BY ALL),
places AS (SELECT partition, source FROM rates UNION
  SELECT unnest(allowed), source FROM srcs WHERE role = 'candidate'),
j AS (SELECT p.partition, p.source, s.role, s.cadence, coalesce(attempt_days, 0) AS attempt_days,
  coalesce(sample_days, 0) AS sample_days, coalesce(raw, 0) AS raw, coalesce(qualified, 0) AS qualified,
  coalesce(p, 0) AS p, coalesce(q, 0) AS q, coalesce(n, 0) AS n, coalesce(c, 0) AS c,
  coalesce(d, 0) AS d, lag, coalesce(readability, CASE WHEN attempt_days IS NULL THEN 0.0 ELSE 1.0 END)
  AS readability FROM places p JOIN srcs s USING (source) LEFT JOIN rates USING (partition, source)
  LEFT JOIN raws USING (source) LEFT JOIN days USING (source)),
k AS (SELECT *, qualified / greatest(1, raw) AS qual, CASE WHEN qualified > 0 THEN 1 - d ELSE 0 END AS nov,
  q * readability AS eq, greatest(n, 1 - readability) AS en,
  coalesce(greatest(0.0, 1 - lag / 72.0), 0.0) AS ls FROM j),
s AS (SELECT *, CASE WHEN qualified = 0 THEN 0.0 ELSE 100 * (CASE partition
  WHEN 'field_test' THEN 0.35 * eq + 0.20 * p + 0.15 * qual + 0.20 * nov + 0.10 * ls - 0.20 * en
  WHEN 'research_synthesis' THEN 0.55 * eq + 0.15 * qual + 0.20 * nov + 0.10 * ls - 0.20 * en
  WHEN 'pricing' THEN 0.40 * p + 0.35 * eq + 0.10 * qual + 0.10 * nov + 0.05 * ls - 0.30 * en
  WHEN 'degradation' THEN 0.30 * p + 0.30 * eq + 0.15 * d + 0.15 * nov + 0.10 * ls - 0.25 * en
  WHEN 'company' THEN 0.40 * p + 0.25 * eq + 0.10 * qual + 0.15 * nov + 0.10 * ls - 0.30 * en
  ELSE 0.35 * p + 0.25 * eq + 0.15 * qual + 0.15 * nov + 0.10 * ls - 0.25 * en END) END AS raw_score FROM k)
SELECT partition, source, role, cadence, attempt_days, sample_days, raw, qualified,
  round(qual, 6) AS qualification, round(p, 6) AS "primary", round(q, 6) AS quality,
  round(n, 6) AS noise, round(c, 6) AS conflict, round(d, 6) AS duplicate,
  round(readability, 6) AS readability, round(lag, 6) AS lag,
  CAST(round_even(greatest(0.0, least(100.0, raw_score)), 0) AS INTEGER) AS score,
  CASE WHEN role = 'incumbent' THEN '{fixed.DECISION_INCUMBENT}'
    WHEN attempt_days = 0 THEN '{fixed.DECISION_NEVER_SAMPLED}'
    WHEN attempt_days < 14 THEN '{fixed.DECISION_COLLECTING} ' || attempt_days || '/14'
    WHEN raw_score >= 60 AND q >= 0.30 AND readability >= 0.80 THEN
      CASE cadence WHEN 'low_frequency' THEN '{fixed.DECISION_LOW_FREQUENCY}'
      ELSE '{fixed.DECISION_CORE}' END
    WHEN raw_score >= 42 THEN CASE cadence WHEN 'low_frequency' THEN
      '{fixed.DECISION_LOW_FREQUENCY}' ELSE '{fixed.DECISION_ROTATE}' END
    ELSE '{fixed.DECISION_REJECT}' END AS decision FROM s""")
def partition_scores(spark, sf_dir):
    scored = A.partition_scores(sources(spark, sf_dir), captures(spark, sf_dir),
                                audit_items(spark, sf_dir), V.RULES)
    six = ["qualification", "primary", "quality", "noise", "conflict", "duplicate",
           "readability", "lag"]
    return scored.orderBy(*A.partition_order()).select(
        "partition", "source", "role", "cadence", "attempt_days", "sample_days", "raw",
        "qualified", *[F.round(c, 6).alias(c) for c in six], "score", "decision")


@register("zero_routed_candidates", AUDIT + """,
placed AS (SELECT unnest(allowed) AS partition, source FROM srcs WHERE role = 'candidate')
SELECT p.partition, p.source FROM placed p ANTI JOIN routed r
  ON r.partition = p.partition AND r.source_id = p.source""")
def zero_routed_candidates(spark, sf_dir):
    every = F.array(*[F.lit(p) for p in fixed.PARTITIONS])
    listed = F.when(F.size("partitions") > 0, F.col("partitions")).otherwise(every)
    placed = (sources(spark, sf_dir).where(F.col("role") == "candidate")
              .select(F.explode(listed).alias("partition"), "source"))
    routed = routing.route_items(audit_items(spark, sf_dir), V.RULES, ["source"]).distinct()
    return placed.join(routed, ["partition", "source"], "left_anti").select("partition", "source")


# --- sampling -----------------------------------------------------------------
@register("sample_rotation", "WITH " + ENTRIES + f""",
hist AS (SELECT source, count(*) AS attempts, max(day) AS latest FROM caps
  WHERE day <= DATE '{V.LAST_DAY}' GROUP BY ALL)
SELECT e.source, coalesce(attempts, 0) AS attempts, strftime(latest, '%Y-%m-%d') AS latest
FROM entries e LEFT JOIN hist USING (source)
ORDER BY coalesce(attempts, 0), latest NULLS FIRST, entry_ord LIMIT 5""")
def sample_rotation(spark, sf_dir):
    history = A.attempt_history(captures(spark, sf_dir), end_day())
    return A.rotating_batch(community_entries(spark, sf_dir), history, 5).select(
        "source", "attempts", day_text("latest"))


@register("daily_slot", "WITH " + ENTRIES + """,
d AS (SELECT DISTINCT day FROM caps), n AS (SELECT count(*) AS n FROM entries)
SELECT strftime(day, '%Y-%m-%d') AS day, e.source FROM d, n, (SELECT unnest([0, 1]) AS i) b
JOIN entries e ON e.entry_ord = (datediff('day', DATE '0001-01-01', day) + 1 + i) % n""")
def daily_slot(spark, sf_dir):
    days = captures(spark, sf_dir).select("day").distinct()
    return A.daily_slot(community_entries(spark, sf_dir), days, 2).select(day_text(), "source")


COMPLETE = ENTRIES + f""",
req AS (SELECT DISTINCT source FROM caps),
complete AS (SELECT day FROM caps WHERE day <= DATE '{V.LAST_DAY}' AND status <> 'skipped'
  GROUP BY day HAVING count(DISTINCT source) >= 12),
strict AS (SELECT day FROM caps WHERE day <= DATE '{V.LAST_DAY}' GROUP BY day
  HAVING count(DISTINCT source) = (SELECT count(*) FROM req))"""


@register("complete_sample_days", "WITH " + COMPLETE + f""",
top AS (SELECT day FROM strict ORDER BY day DESC LIMIT 14)
SELECT strftime(day, '%Y-%m-%d') AS day FROM (SELECT day FROM top UNION
  SELECT DISTINCT day FROM caps WHERE day = DATE '{V.LAST_DAY}'
    AND (SELECT count(*) FROM top) < 14)""")
def complete_sample_days(spark, sf_dir):
    log = captures(spark, sf_dir).withColumn("finished_at", F.col("at"))
    required = log.select("source").distinct()
    complete = A.complete_days(log, required, end_day())
    return A.sample_days(complete, log, end_day(), 14).select(day_text())


@register("sample_numbers", "WITH " + ENTRIES + """
SELECT source, strftime(day, '%Y-%m-%d') AS day,
  row_number() OVER (PARTITION BY source ORDER BY day) AS sample_no FROM caps""")
def sample_numbers(spark, sf_dir):
    return R.sample_numbers(captures(spark, sf_dir)).select("source", day_text(), "sample_no")


# --- coverage -----------------------------------------------------------------
def coverage_cells(spark, sf_dir):
    """Target = language, surface = page host family; entries are sources."""
    rows = V.observations(spark, sf_dir)
    surface = F.regexp_extract("url", r"example\.([a-z]+)", 1)
    target = F.regexp_extract("url", r"^https?://[^/]+/([a-z]{2})/", 1)
    kind = F.when(F.col("tier") == "community", "trial").otherwise("incumbent")
    return (rows.select(target.alias("target"), surface.alias("surface"), kind.alias("kind"),
                        F.concat(F.lit("src"), (_number("source_id") * 3) % 30).alias("entry"))
            .distinct())


CELLS = "WITH " + V.OBSERVATIONS + "," + DIM + r""",
cells AS (SELECT DISTINCT regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1) AS target,
  regexp_extract(url, 'example\.([a-z]+)', 1) AS surface,
  CASE WHEN tier = 'community' THEN 'trial' ELSE 'incumbent' END AS kind,
  'src' || ((number * 3) % 30) AS entry FROM obs)"""


@register("coverage_matrix", CELLS + """,
p AS (SELECT target, surface, string_agg(kind || ':' || entry, '|' ORDER BY kind || ':' || entry) AS e
  FROM cells GROUP BY ALL)
SELECT target, max(e) FILTER (surface = 'com') AS com, max(e) FILTER (surface = 'net') AS net,
  max(e) FILTER (surface = 'org') AS org FROM p GROUP BY target""")
def coverage_matrix(spark, sf_dir):
    cells = coverage_cells(spark, sf_dir)
    return A.coverage_matrix(cells, ["com", "net", "org"])


@register("coverage_gaps", CELLS + """
SELECT target, surface, kind, entry FROM cells c ANTI JOIN srcs s
  ON s.source = c.entry AND s.role = CASE c.kind WHEN 'trial' THEN 'candidate' ELSE 'incumbent' END""")
def coverage_gaps(spark, sf_dir):
    dim = sources(spark, sf_dir)
    return A.coverage_errors(coverage_cells(spark, sf_dir), dim.where(F.col("role") == "incumbent"),
                             dim.where(F.col("role") == "candidate"))


@register("undeclared_keywords", """
WITH a AS (SELECT DISTINCT 'word ' || s_nationkey AS alias, 'target ' || (s_suppkey % 7) AS target
  FROM supplier WHERE s_suppkey % 3 = 0)
SELECT DISTINCT 'target' AS kind, target AS name FROM a
  WHERE target NOT IN (SELECT 'target ' || r_regionkey FROM region)
UNION ALL SELECT DISTINCT 'keyword', 'word ' || c_nationkey FROM customer
  WHERE 'word ' || c_nationkey NOT IN (SELECT alias FROM a)""")
def undeclared_keywords(spark, sf_dir):
    supplier = V.table(spark, sf_dir, "supplier").where(F.col("s_suppkey") % 3 == 0)
    aliases = supplier.select(F.concat(F.lit("word "), "s_nationkey").alias("alias"),
                              F.concat(F.lit("target "), F.col("s_suppkey") % 7).alias("target"))
    words = V.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("word "), "c_nationkey").alias("keyword"))
    targets = V.table(spark, sf_dir, "region").select(
        F.concat(F.lit("target "), "r_regionkey").alias("target"))
    return A.undeclared_keywords(words, aliases, targets)


@register("audit_progress", "WITH " + ENTRIES + """,
a AS (SELECT source, count(DISTINCT day) AS attempt_days FROM caps GROUP BY source)
SELECT count(*) FILTER (attempt_days > 0) AS covered,
  count(*) FILTER (attempt_days >= 14) AS complete, max(attempt_days) AS most_attempts FROM a""")
def audit_progress(spark, sf_dir):
    attempts = captures(spark, sf_dir).groupBy("source").agg(
        F.countDistinct("day").alias("attempt_days"))
    return A.audit_progress(attempts)


@register("collection_candidates", "WITH " + DIM + """,
c AS (SELECT *, number % 3 <> 0 AS enabled, CASE WHEN number % 2 = 0 THEN 'rotation' ELSE 'fixed' END
  AS audit_group FROM srcs)
SELECT 'all' AS asked, source FROM c WHERE enabled
UNION ALL SELECT 'named', source FROM c WHERE source IN ('src3', 'src4', 'src6', 'src99')
  AND (enabled OR audit_group = 'rotation')""")
def collection_candidates(spark, sf_dir):
    n = _number()
    dim = (sources(spark, sf_dir).withColumn("enabled", n % 3 != 0)
           .withColumn("audit_group", F.when(n % 2 == 0, "rotation").otherwise("fixed")))
    named = A.collection_candidates(dim, ["SRC3", "src4", "src6", "src99"])
    return (A.collection_candidates(dim).select(F.lit("all").alias("asked"), "source")
            .unionByName(named.select(F.lit("named").alias("asked"), "source")))


@register("author_catalog", "WITH " + DIM + """
SELECT source, 'Source ' || number AS name, tier AS audit_group FROM srcs
WHERE track = 'expert_author'""")
def author_catalog(spark, sf_dir):
    dim = (sources(spark, sf_dir).withColumn("audit_group", F.col("tier"))
           .withColumn("audit_status", F.lit("")).withColumn("latest_seen", F.lit(""))
           .withColumn("url", F.lit("")))
    return A.author_catalog(dim).select("source", "name", "audit_group")


# --- retention ----------------------------------------------------------------
@register("retention_recent", "WITH " + ENTRIES + f"""
SELECT source, strftime(day, '%Y-%m-%d') AS day, status FROM caps
WHERE day >= DATE '{V.LAST_DAY}' - INTERVAL 10 DAY""")
def retention_recent(spark, sf_dir):
    return R.keep_recent(captures(spark, sf_dir), end_day(), 10).select(
        "source", day_text(), "status")


@register("retention_floor", "WITH " + ENTRIES + f""",
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY day DESC) AS rn FROM caps)
SELECT source, strftime(day, '%Y-%m-%d') AS day, status FROM r
WHERE day >= DATE '{V.LAST_DAY}' - INTERVAL 5 DAY OR rn <= 9""")
def retention_floor(spark, sf_dir):
    return R.keep_floor(captures(spark, sf_dir), end_day(), 5, 9).select(
        "source", day_text(), "status")


@register("retention_protected", "WITH " + ENTRIES + "," + V.OBSERVATIONS + f""",
kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY day DESC) AS rn
  FROM caps) WHERE rn <= 14),
days AS (SELECT day AS d FROM kept UNION ALL
  SELECT CAST(coalesce(CASE WHEN published LIKE '20%' THEN published_at END, fetched_ts) AS DATE)
  FROM obs o SEMI JOIN kept k ON k.source = o.source_id AND k.day = o.day)
SELECT strftime(least(DATE '{V.LAST_DAY}' - INTERVAL 40 DAY, min(d) - INTERVAL 30 DAY), '%Y-%m-%d')
  AS cutoff FROM days""")
def retention_protected(spark, sf_dir):
    return R.baseline_cutoff(captures(spark, sf_dir), community_items(spark, sf_dir), end_day(),
                             40).select(day_text("cutoff"))


_BASE_PAGE = "regexp_extract(url, '^[^&]*')"


@register("baseline_compact", "WITH " + ENTRIES + "," + V.OBSERVATIONS + f""",
k AS (SELECT o.*, list_filter([{V.sql_match_url(_BASE_PAGE)}, paper_link, post_link,
    CASE WHEN external_url <> '' THEN {V.sql_match_url(_EXTERNAL)} END], lambda x: x IS NOT NULL) AS links
  FROM obs o JOIN caps c ON c.source = o.source_id AND c.day = o.day AND c.status = 'ok')
SELECT DISTINCT strftime(day, '%Y-%m-%d') AS day, source_id AS source, left(title, 500) AS title,
  strftime(coalesce(CASE WHEN published LIKE '20%' THEN published_at END, fetched_ts),
    '%Y-%m-%d %H:%M:%S') AS "when",
  array_to_string(list_sort(list_distinct([regexp_extract(u, '^[^?]*') FOR u IN links])), '|') AS urls,
  array_to_string(list_sort(list_distinct([('url-sha256:' || sha256(u)) FOR u IN links])), '|')
    AS url_keys FROM k""")
def baseline_compact(spark, sf_dir):
    items = V.observations(spark, sf_dir).withColumn("capture_hash", F.col("fetched_at"))
    log = captures(spark, sf_dir)
    run = F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("T20:"),
                   F.lpad(F.regexp_extract("source", r"\d+", 0), 2, "0"), F.lit(":00Z"))
    log = (log.withColumn("run_mode", F.when(F.col("status") == "ok", "full"))
           .withColumn("completed_at", F.col("at")).withColumn("snapshot_hash", run))
    compact = R.compact_baseline(items, log)
    stored = R.append_distinct(compact.limit(0), compact)
    return stored.select(day_text(), "source", "title",
                         F.date_format("when", "yyyy-MM-dd HH:mm:ss").alias("when"),
                         joined("urls"), joined("url_keys"))
