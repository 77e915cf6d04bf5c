"""Claim, evidence, inbox and author queries."""

from __future__ import annotations

import uuid

from pyspark.sql import Window, functions as F

from newsledger import fixed_values as fixed
from newsledger.functions import text as T, urls as U
from newsledger.operators import authors as A, claims as C
from newsledger.operators.barrier import computed
from newsledger.operators.classify import with_identity
from newsledger.session import materialize, shared_folder
from newsledger.sources import captures
from registry import register, views as V
from registry.digests import day_text, joined

MONTH_END = "2024-02-29"
TYPES = fixed.SOURCE_TYPES
STANCES = [*fixed.EVIDENCE_STANCES, None]


def _at(values, index):
    cases = F.lit(None).cast("string")
    for i, value in enumerate(values):
        if value is not None:
            cases = F.when(index == i, value).otherwise(cases)
    return cases


def _sql_at(values, index):
    return f"CASE {index} " + " ".join(
        f"WHEN {i} THEN {V.quote(v)}" for i, v in enumerate(values) if v is not None) + " END"


def claims(spark, sf_dir):
    n = F.col("item_id")
    return V.table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("claim-"), n).alias("id"), F.col("text").alias("claim"),
        _at(["open", "leaning-yes", "resolved", "open"], n % 4).alias("status"),
        F.lit("").alias("watch"),
        F.when(n % 5 == 0, F.array(F.lit("heit"), F.lit("of the"), F.lit("ß"))).alias("watch_keywords"),
        F.when(n % 7 == 0, "ledger").alias("ledger_ref"),
        F.when(n % 14 == 0, F.array(F.lit("inference: x"), F.lit("guess: y")))
        .alias("career_implication"))


def evidence(spark, sf_dir):
    n = V.table(spark, sf_dir, "benchmark").count()
    c, t = F.col("conv_id"), F.col("turn")
    return V.table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("claim-"), c % n).alias("claim_id"),
        (c * 100 + t).cast("int").alias("ev_ord"), F.col("role").alias("src"),
        _at(TYPES, c % 6).alias("type"), _at(STANCES, t % 5).alias("stance"),
        F.col("text").alias("verdict"),
        F.concat(F.lit("https://www.example.com/"), c % 30, F.lit("?utm_source="), t).alias("link"),
        F.date_add(F.lit("2024-01-01").cast("date"), (c % 60).cast("int")).alias("date"),
        F.concat(F.lit("src"), c % 20, F.lit(":item"), c % 30).alias("source_item_id"),
        F.sha2(F.concat(F.col("role"), F.lit("-"), c % 30), 256).alias("snapshot_hash"))


CLAIMS = f"""
claims AS (SELECT 'claim-' || item_id AS id, item_id, text AS claim,
  {_sql_at(['open', 'leaning-yes', 'resolved', 'open'], 'item_id % 4')} AS status,
  item_id % 5 = 0 AS watched, CASE WHEN item_id % 7 = 0 THEN 'ledger' END AS ledger_ref FROM benchmark),
nb AS (SELECT count(*) AS n FROM benchmark),
evidence AS (SELECT 'claim-' || (conv_id % n) AS claim_id, CAST(conv_id * 100 + turn AS INTEGER) AS ev_ord,
  conv_id, turn, role AS src, {_sql_at(TYPES, 'conv_id % 6')} AS type,
  {_sql_at(STANCES, 'turn % 5')} AS stance, text AS verdict,
  'https://www.example.com/' || (conv_id % 30) || '?utm_source=' || turn AS link,
  DATE '2024-01-01' + CAST(conv_id % 60 AS INTEGER) AS date,
  'src' || (conv_id % 20) || ':item' || (conv_id % 30) AS source_item_id,
  sha256(role || '-' || (conv_id % 30)) AS snapshot_hash FROM conversations, nb)"""

_ENTITY = list(dict.fromkeys([*V.RULES.model_keywords, *V.RULES.keywords("company")]))
_CONCEPT = V.RULES.keywords(*[t.name for t in V.RULES.topics if t.name != "company"])
_WATCH = ["heit", "of the", "ß"]
MATCHES = V.CLASSIFIED + "," + CLAIMS + f""",
act AS (SELECT *, {V.sql_hits("(claim || ' ')", _ENTITY)} AS ents,
  {V.sql_hits("(claim || ' ')", _CONCEPT)} AS cons FROM claims WHERE status <> 'resolved'),
itm AS (SELECT item_ord, {V.sql_hits('match_text', _ENTITY)} AS ie,
  {V.sql_hits('match_text', _CONCEPT)} AS ic, len({V.sql_hits('match_text', _WATCH)}) > 0 AS iw
  FROM classified),
mm AS (SELECT id AS claim_id, item_ord, watched, len(ents) > 0 AS he, len(cons) > 0 AS hc,
    iw, list_has_any(ents, ie) AS e, list_has_any(cons, ic) AS c FROM act, itm),
ml AS (SELECT claim_id, item_ord, CASE WHEN CASE WHEN watched THEN iw WHEN he AND hc THEN e AND c
    ELSE e OR c END THEN 'strict' WHEN NOT watched AND e THEN 'broad' END AS lane FROM mm)"""


def matches(spark, sf_dir):
    items = V.classified(spark, sf_dir).select("item_ord", "payload_ord", "match_text")
    active = C.active_claims(claims(spark, sf_dir))
    words = materialize(C.claim_keywords(active, V.RULES))
    sightings = C.keyword_sightings(items, "item_ord", words)
    return C.claim_matches(words, sightings, "item_ord")


@register("claim_signals", MATCHES + """
SELECT claim_id, item_ord FROM ml WHERE lane = 'strict'""")
def claim_signals(spark, sf_dir):
    return matches(spark, sf_dir).where(F.col("lane") == "strict").select("claim_id", "item_ord")


@register("claim_broad", MATCHES + """
SELECT claim_id, item_ord FROM ml WHERE lane = 'broad'
  AND claim_id NOT IN (SELECT claim_id FROM ml WHERE lane = 'strict')""")
def claim_broad(spark, sf_dir):
    return C.broad_candidates(materialize(matches(spark, sf_dir))).select("claim_id", "item_ord")


_PROBE = list(dict.fromkeys([*V.RULES.model_keywords, *V.RULES.keywords("company"),
                             *V.RULES.keywords("degradation"), *V.RULES.keywords("pricing")]))


@register("digest_claim_signals", V.CLASSIFIED + "," + CLAIMS + f""",
act AS (SELECT *, list_filter([{', '.join(f"CASE WHEN contains(lower(claim), {V.quote(p)}) THEN {V.quote(p)} END" for p in _PROBE)}],
    lambda x: x IS NOT NULL) AS ks FROM claims WHERE status <> 'resolved'),
itm AS (SELECT item_ord, {V.sql_hits('match_text', _PROBE)} AS ih,
  len({V.sql_hits('match_text', _WATCH)}) > 0 AS iw FROM classified)
SELECT id AS claim_id, count(*) AS signals FROM act, itm
WHERE CASE WHEN watched THEN iw ELSE list_has_any(ks, ih) END GROUP BY id""")
def digest_claim_signals(spark, sf_dir):
    items = V.classified(spark, sf_dir).select("item_ord", "match_text")
    words = materialize(C.loose_claim_keywords(C.active_claims(claims(spark, sf_dir)), V.RULES))
    found = C.keyword_sightings(items, "item_ord", words).join(words, "keyword")
    return (found.select("claim_id", "item_ord").distinct().groupBy("claim_id")
            .agg(F.count("*").alias("signals")))


@register("claim_context", MATCHES + """,
r AS (SELECT m.claim_id, c.item_ord, c.source_item_id, count(*) OVER (PARTITION BY m.claim_id) AS signals,
  row_number() OVER (PARTITION BY m.claim_id ORDER BY c.source_id, c.item_ord) AS rn
  FROM ml m JOIN classified c USING (item_ord) WHERE lane = 'strict')
SELECT claim_id, item_ord, source_item_id, signals FROM r WHERE rn <= 3""")
def claim_context(spark, sf_dir):
    items = V.classified(spark, sf_dir).select("item_ord", "payload_ord", "source_item_id")
    return C.context_rows(matches(spark, sf_dir), items, "item_ord").select(
        "claim_id", "item_ord", "source_item_id", "signals")


@register("evidence_selection", "WITH " + CLAIMS + """,
n AS (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY date DESC, ev_ord DESC) AS nr,
  date = DATE '2024-01-31' AS today, coalesce(stance IN ('counter', 'confounder'), FALSE) AS rev FROM evidence),
h AS (SELECT *, min(CASE WHEN today THEN nr END) OVER w AS t1, min(CASE WHEN rev THEN nr END) OVER w AS r1
  FROM n WINDOW w AS (PARTITION BY claim_id)),
l AS (SELECT *, CASE WHEN nr = t1 THEN 1 WHEN nr = r1 THEN 2 WHEN stance = 'counter' THEN 3
  WHEN stance = 'confounder' THEN 4 WHEN stance = 'support' THEN 5 WHEN stance = 'neutral' THEN 6
  WHEN type = 'controlled' THEN 7 WHEN type = 'n1-user' THEN 8 WHEN type = 'vendor' THEN 9
  WHEN type = 'index' THEN 10 WHEN type = 'forum' THEN 11 WHEN type = 'report' THEN 12
  WHEN today THEN 13 ELSE 14 END AS lane FROM h),
s AS (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY lane, nr) AS pick FROM l)
SELECT claim_id, ev_ord, lane, strftime(date, '%Y-%m-%d') AS date FROM s WHERE pick <= 8""")
def evidence_selection(spark, sf_dir):
    day = F.lit("2024-01-31").cast("date")
    return C.select_evidence(evidence(spark, sf_dir), day).select(
        "claim_id", "ev_ord", "lane", day_text("date"))


@register("stance_counts", "WITH " + CLAIMS + """
SELECT claim_id, count(*) FILTER (stance = 'counter') AS counter,
  count(*) FILTER (stance = 'confounder') AS confounder, count(*) FILTER (stance = 'support') AS support,
  count(*) FILTER (stance = 'neutral') AS neutral,
  count(*) FILTER (stance IS NULL) AS "legacy-unspecified" FROM evidence GROUP BY claim_id""")
def stance_counts(spark, sf_dir):
    return C.stance_counts(evidence(spark, sf_dir))


@register("type_counts", "WITH " + CLAIMS + """
SELECT claim_id, type, count(*) AS records FROM evidence GROUP BY ALL""")
def type_counts(spark, sf_dir):
    return C.type_counts(evidence(spark, sf_dir))


@register("dossiers", "WITH " + CLAIMS + f"""
SELECT claim_id, ev_ord, CAST(list_position([{', '.join(V.quote(t) for t in TYPES)}], type)
  AS INTEGER) AS type_place, strftime(date, '%Y-%m-%d') AS date, src, link AS linked
FROM evidence e SEMI JOIN (SELECT id FROM claims WHERE ledger_ref IS NULL) c ON c.id = e.claim_id""")
def dossiers(spark, sf_dir):
    rows = C.dossier_rows(claims(spark, sf_dir), evidence(spark, sf_dir))
    return rows.orderBy("claim_id", "type_place", "date", "src").select(
        "claim_id", "ev_ord", "type_place", day_text("date"), "src", "linked")


@register("context_budget", "WITH " + CLAIMS + """,
r AS (SELECT conv_id, turn, ev_ord, octet_length(encode('{"lane":' || turn || ',"ev_ord":' || ev_ord ||
    ',"claim_id":"' || claim_id || '","link":"' || link || '"}')) + 1 AS bytes FROM evidence),
s AS (SELECT *, sum(bytes) OVER (ORDER BY turn, ev_ord) AS upto FROM r)
SELECT ev_ord, CAST(bytes AS INTEGER) AS bytes, CAST(upto AS BIGINT) AS upto, upto <= 20000 AS kept FROM s""")
def context_budget(spark, sf_dir):
    rows = evidence(spark, sf_dir).select(
        F.expr("ev_ord % 100").alias("lane"), "ev_ord", "claim_id", "link")
    packed = C.pack_to_budget(rows, ["lane", "ev_ord"], F.struct(
        "lane", F.floor(F.col("ev_ord") / 1000)), 20000)
    return packed.select("ev_ord", "bytes", F.col("upto").cast("bigint").alias("upto"), "kept")


@register("context_trimmed", "WITH " + CLAIMS + """,
k AS (SELECT *, CASE WHEN turn % 3 = 0 THEN 'signal' ELSE 'evidence' END AS kind,
  octet_length(encode(verdict)) AS bytes FROM evidence),
r AS (SELECT *, row_number() OVER (PARTITION BY claim_id, kind ORDER BY ev_ord) AS place FROM k),
t AS (SELECT claim_id, count(*) FILTER (turn % 3 = 0) AS total, count(*) AS records
  FROM evidence WHERE turn < 1 + conv_id % 4 OR turn % 3 > 0 GROUP BY claim_id),
p AS (
  SELECT 'claim' AS kind, claim_id, 0 AS place, total, 50 AS bytes FROM t WHERE total > 0
  UNION ALL SELECT 'broad', claim_id, 0, records, 20 + length(claim_id) FROM t WHERE total = 0
  UNION ALL SELECT kind, claim_id, place, total, bytes FROM r JOIN t USING (claim_id)
    WHERE total > 0 AND place <= CASE kind WHEN 'signal' THEN least(3, total) ELSE 8 END
  UNION ALL SELECT 'collection', '', page_id, 0, octet_length(encode(url)) FROM pages),
h AS (SELECT *, count(*) FILTER (kind = 'signal') OVER (PARTITION BY claim_id) AS s,
  count(*) FILTER (kind = 'evidence') OVER (PARTITION BY claim_id) AS e FROM p),
m AS (SELECT *, CASE kind WHEN 'broad' THEN 1 WHEN 'collection' THEN 2 ELSE 3 END AS phase,
  CASE WHEN kind = 'broad' THEN -total WHEN kind = 'collection' THEN place
    WHEN kind = 'signal' AND place > 1 THEN place ELSE least(s, 1) END AS a,
  CASE WHEN kind IN ('broad', 'collection') THEN 0 WHEN kind = 'signal' AND place > 1 THEN e
    WHEN kind = 'evidence' AND place > 1 THEN place ELSE least(e, 1) END AS b,
  CASE WHEN kind IN ('broad', 'collection') THEN 0 ELSE total END AS c,
  CASE WHEN kind = 'broad' THEN claim_id ELSE '' END AS down,
  CASE WHEN kind IN ('broad', 'collection') THEN '' ELSE claim_id END AS up FROM h),
u AS (SELECT *, sum(bytes) OVER (ORDER BY phase, a DESC, b DESC, c DESC, down DESC, up) AS upto,
  sum(bytes) OVER (PARTITION BY phase, a, b, c, down, up) AS step, sum(bytes) OVER () AS whole FROM m)
SELECT kind, claim_id, CAST(place AS BIGINT) AS place, CAST(bytes AS BIGINT) AS bytes,
  upto - step >= whole - whole // 3 AS kept FROM u""")
def context_trimmed(spark, sf_dir):
    """What a third of the bytes keeps of signals, evidence, candidates and collections."""
    turn = F.col("ev_ord") % 100
    rows = evidence(spark, sf_dir).select(
        "claim_id", "ev_ord", F.when(turn % 3 == 0, "signal").otherwise("evidence").alias("kind"),
        F.octet_length("verdict").alias("bytes"),
        ((turn < 1 + F.floor(F.col("ev_ord") / 100) % 4) | (turn % 3 > 0)).alias("counts"))
    totals = materialize(rows.groupBy("claim_id").agg(
        F.count_if(F.col("counts") & (F.col("kind") == "signal")).alias("total"),
        F.count_if("counts").alias("records")).where("records > 0"))
    few = F.when(F.col("kind") == "signal", F.least(F.lit(3), F.col("total"))).otherwise(8)
    top = Window.partitionBy("claim_id", "kind").orderBy("ev_ord")
    shown = (rows.withColumn("place", F.row_number().over(top)).where(F.col("place") <= 8)
             .join(totals.where("total > 0"), "claim_id").where(F.col("place") <= few))
    columns = ["kind", "claim_id", "place", "total", "bytes"]
    parts = (totals.where("total > 0").select(F.lit("claim").alias("kind"), "claim_id",
                                              F.lit(0).alias("place"), "total", F.lit(50).alias("bytes"))
             .unionByName(totals.where("total = 0").select(
                 F.lit("broad").alias("kind"), "claim_id", F.lit(0).alias("place"),
                 F.col("records").alias("total"), (20 + F.length("claim_id")).alias("bytes")))
             .unionByName(shown.select(*columns))
             .unionByName(V.table(spark, sf_dir, "pages").select(
                 F.lit("collection").alias("kind"), F.lit("").alias("claim_id"),
                 F.col("page_id").alias("place"), F.lit(0).alias("total"),
                 F.octet_length("url").alias("bytes"))))
    parts = materialize(parts)
    budget = (parts.agg(F.sum("bytes").alias("n")).first()["n"] or 0) // 3
    return C.trim_to_budget(parts, budget).select(
        "kind", "claim_id", F.col("place").cast("bigint").alias("place"),
        F.col("bytes").cast("bigint").alias("bytes"), "kept")


# --- inbox -----------------------------------------------------------------------
def inbox(spark, sf_dir):
    c, t = F.col("conv_id"), F.col("turn")
    n = V.table(spark, sf_dir, "benchmark").count()
    text = F.regexp_extract("text", "^[^.\n]*", 0)
    return V.table(spark, sf_dir, "conversations").select(
        (c * 100 + t).alias("batch_ord"),
        F.date_add(F.lit("2024-01-01").cast("date"), (c % 60).cast("int")).alias("date"),
        text.alias("title"),
        F.concat(F.when(t % 3 == 0, "https://www.").otherwise("https://"), F.lit("example"), c % 3,
                 F.lit(".com/"), c % 30, F.lit("?utm_source="), t).alias("url"),
        _at(TYPES, (c + t) % 6).alias("source_type"),
        F.when(t % 2 == 0, F.concat(F.lit("claim-"), c % (n + 3))).alias("matched_claim"),
        F.when(t % 2 == 1, F.concat(F.lit("cand-"), c % 25)).alias("candidate_key"),
        F.lit("it matters").alias("why_it_matters"), F.lit("other reading").alias("main_alternative"),
        F.when(c % 11 == 0, "").otherwise("check again").alias("next_check"),
        F.when(t % 2 == 0, "watch_signal").otherwise("claim_candidate").alias("action"),
        F.concat(F.lit("src"), c % 20, F.lit(":item"), c % 30).alias("source_item_id"),
        F.sha2(F.concat(F.lit("shot"), c % 30), 256).alias("snapshot_hash"))


INBOX = CLAIMS + f""",
inbox AS (SELECT conv_id * 100 + turn AS batch_ord, conv_id, turn,
  DATE '2024-01-01' + CAST(conv_id % 60 AS INTEGER) AS date, regexp_extract(text, '^[^.\\n]*') AS title,
  CASE WHEN turn % 3 = 0 THEN 'https://www.' ELSE 'https://' END || 'example' || (conv_id % 3) || '.com/'
    || (conv_id % 30) || '?utm_source=' || turn AS url,
  {_sql_at(TYPES, '(conv_id + turn) % 6')} AS source_type,
  CASE WHEN turn % 2 = 0 THEN 'claim-' || (conv_id % (n + 3)) END AS matched_claim,
  CASE WHEN turn % 2 = 1 THEN 'cand-' || (conv_id % 25) END AS candidate_key,
  CASE WHEN conv_id % 11 = 0 THEN '' ELSE 'check again' END AS next_check,
  CASE WHEN turn % 2 = 0 THEN 'watch_signal' ELSE 'claim_candidate' END AS action,
  'src' || (conv_id % 20) || ':item' || (conv_id % 30) AS source_item_id,
  sha256('shot' || (conv_id % 30)) AS snapshot_hash FROM conversations, nb)"""


@register("record_errors", "WITH " + INBOX + """
SELECT batch_ord, array_to_string(list_filter([
  CASE WHEN trim(title) = '' THEN 'title: empty' END,
  CASE WHEN length(trim(title)) > 300 THEN 'title: longer than 300' END,
  CASE WHEN next_check = '' THEN 'next_check: empty' END], lambda x: x IS NOT NULL), '|') AS errors
FROM inbox""")
def record_errors(spark, sf_dir):
    return C.record_errors(inbox(spark, sf_dir)).select("batch_ord", joined("errors"))


_IDENTITY = (f"sha256(CAST(to_json(struct_pack(action := action, candidate_key := candidate_key, "
             f"matched_claim := matched_claim, snapshot_hash := snapshot_hash, source_item_id := "
             f"source_item_id, url := {V.sql_canonical('url')})) AS VARCHAR))")


@register("inbox_dedupe", "WITH " + INBOX + f""",
i AS (SELECT *, {_IDENTITY} AS identity FROM inbox),
old AS (SELECT identity FROM i WHERE date < DATE '2024-01-08'),
f AS (SELECT * FROM i WHERE date >= DATE '2024-01-08' AND identity NOT IN (SELECT identity FROM old))
SELECT min(batch_ord) AS batch_ord, left(identity, 20) AS id FROM f GROUP BY identity""")
def inbox_dedupe(spark, sf_dir):
    rows = inbox(spark, sf_dir)
    start = F.lit("2024-01-08").cast("date")
    return C.inbox_additions(rows.where(F.col("date") >= start),
                             rows.where(F.col("date") < start)).select("batch_ord", "id")


@register("review_inbox", "WITH " + INBOX + """
SELECT strftime(date, '%Y-%m-%d') AS day, title, url, matched_claim, candidate_key, action,
  source_item_id, snapshot_hash FROM inbox
WHERE date BETWEEN DATE '2024-01-20' AND DATE '2024-02-10'""")
def review_inbox(spark, sf_dir):
    """The inbox landed as JSON lines in month shards, and a window of it read back."""
    rows = inbox(spark, sf_dir).withColumn("month", F.date_format("date", "yyyy-MM"))
    root = f"{shared_folder(spark).rstrip('/')}/inbox-{uuid.uuid4().hex}"
    rows.write.partitionBy("month").json(root)
    return captures.read_inbox(spark, root, "2024-01-20", "2024-02-10").select(
        F.date_format("date", "yyyy-MM-dd").alias("day"), "title", "url", "matched_claim",
        "candidate_key", "action", "source_item_id", "snapshot_hash")


@register("month_review", "WITH " + INBOX + f""",
w AS (SELECT * FROM inbox WHERE date BETWEEN DATE '{MONTH_END}' - INTERVAL 39 DAY AND DATE '{MONTH_END}'),
s AS (SELECT matched_claim, count(*) AS signals FROM w WHERE matched_claim IS NOT NULL GROUP BY ALL)
SELECT matched_claim, signals, status, coalesce(id IS NOT NULL AND ledger_ref IS NOT NULL, FALSE) AS guarded,
  id IS NULL AS missing FROM s LEFT JOIN claims c ON c.id = s.matched_claim""")
def month_review(spark, sf_dir):
    rows = C.review_window(inbox(spark, sf_dir), F.lit(MONTH_END).cast("date"), 40)
    return C.month_review(rows, claims(spark, sf_dir))


@register("candidate_gate", "WITH " + INBOX + """,
s AS (SELECT candidate_key, count(*) AS signals, count(DISTINCT date) AS days,
  count(DISTINCT regexp_replace(regexp_extract(url, '^https?://([^/?#]*)', 1), '^www\\.', '')) AS domains,
  count(DISTINCT source_type) AS source_types,
  bool_or(source_type IN ('controlled', 'n1-user', 'forum', 'report')) AS independent
  FROM inbox WHERE matched_claim IS NULL GROUP BY ALL)
SELECT *, days >= 3 AND domains >= 2 AND source_types >= 2 AND independent AS passed FROM s""")
def candidate_gate(spark, sf_dir):
    return C.candidate_gate(inbox(spark, sf_dir))


@register("binding_check", "WITH " + V.OBSERVATIONS + f""",
c AS (SELECT *, {V.sql_canonical('url')} AS cu FROM obs),
i AS (SELECT DISTINCT day, cu, source_id || ':' || left(sha256(source_id || chr(0) || cu), 20) AS sid,
  sha256(CAST(to_json(struct_pack(content_sha256 := content_sha256, published := published,
  summary := summary, title := title, url := cu)) AS VARCHAR)) AS h FROM c),
r AS (SELECT item_ord, day AS date, CASE WHEN item_ord % 3 = 0 THEN url || '/other' ELSE url END AS url,
  source_id || ':' || left(sha256(source_id || chr(0) || cu), 20) AS sid,
  CASE WHEN item_ord % 5 = 0 THEN repeat('0', 64) ELSE sha256(CAST(to_json(struct_pack(
  content_sha256 := content_sha256, published := published, summary := summary, title := title,
  url := cu)) AS VARCHAR)) END AS h FROM c)
SELECT item_ord, CASE WHEN i.sid IS NULL THEN 'not captured'
  WHEN i.cu IS DISTINCT FROM {V.sql_canonical('r.url')} THEN 'url differs from item' ELSE 'ok' END AS binding
FROM r LEFT JOIN i ON i.day = r.date AND i.sid = r.sid AND i.h = r.h""")
def binding_check(spark, sf_dir):
    items = materialize(with_identity(V.observations(spark, sf_dir)).select(
        "day", "item_ord", "url", "source_id", "source_item_id", "snapshot_hash", "canonical_url"))
    n = F.col("item_ord")
    records = items.select(
        "item_ord", F.col("day").alias("date"), "source_item_id",
        F.when(n % 3 == 0, F.concat("url", F.lit("/other"))).otherwise(F.col("url")).alias("url"),
        F.when(n % 5 == 0, "0" * 64).otherwise(F.col("snapshot_hash")).alias("snapshot_hash"))
    collections = items.select("day", F.concat("source_id", F.lit(":collection")).alias("source_item_id"),
                               "snapshot_hash", "source_id")
    audit_urls = items.select("source_id", F.col("url").alias("audit_url"))
    return C.binding_check(records, items, collections, audit_urls).select("item_ord", "binding")


@register("claim_violations", "WITH " + CLAIMS + """
SELECT id AS claim_id, 'implication missing' AS rule, '' AS detail FROM claims
  WHERE ledger_ref IS NOT NULL AND item_id % 14 <> 0
UNION ALL SELECT id, 'implication tag', 'guess: y' FROM claims WHERE item_id % 14 = 0
UNION ALL SELECT id, 'committed without source', status FROM claims
  WHERE status IN ('leaning-yes', 'leaning-no', 'resolved') AND id NOT IN (SELECT claim_id FROM evidence)
UNION ALL SELECT claim_id, 'identity incomplete', 'evidence ' || ev_ord FROM evidence WHERE stance IS NULL""")
def claim_violations(spark, sf_dir):
    return C.claim_violations(claims(spark, sf_dir), evidence(spark, sf_dir))


@register("evidence_dedupe")
def evidence_dedupe(spark, sf_dir):
    rows = evidence(spark, sf_dir).withColumn("batch_ord", F.col("ev_ord"))
    start = F.lit("2024-01-08").cast("date")
    return C.evidence_additions(
        rows.where(F.col("date") >= start), rows.where(F.col("date") < start),
        claims(spark, sf_dir)).select("claim_id", "batch_ord", "outcome")


# --- authors ---------------------------------------------------------------------
def _cited(spark, sf_dir):
    return V.observations(spark, sf_dir).select(
        "day", U.status_links(F.col("summary")).alias("x_links"))


def manual(spark, sf_dir):
    n = F.col("s_suppkey")
    return V.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("AUTHOR"), n).alias("handle"), (n % 4).cast("int").alias("score"),
        (n % 2 == 0).alias("has_test_signal"), F.lit("").alias("provenance"))


AUTHORS = "WITH " + V.OBSERVATIONS + """,
st AS (SELECT DISTINCT day, lower(regexp_extract(post_link, 'x\\.com/([^/]+)', 1)) AS author,
  regexp_extract(post_link, 'x\\.com/([^/]+)', 1) AS handle,
  regexp_extract(post_link, '(\\d+)$', 1) AS status_id FROM obs WHERE post_link IS NOT NULL),
m AS (SELECT 'author' || s_suppkey AS author, CAST(greatest(0, s_suppkey % 4) AS INTEGER) AS manual_count,
  s_suppkey % 2 = 0 AS has_test_signal FROM supplier),
a AS (SELECT author, count(DISTINCT status_id) AS posts, count(DISTINCT day) AS day_count, max(day) AS last_day
  FROM st GROUP BY ALL),
led AS (SELECT author, coalesce(posts, 0) + coalesce(manual_count, 0) AS count, posts, day_count, last_day,
  coalesce(has_test_signal, FALSE) AS has_test_signal FROM a FULL JOIN m USING (author))"""


@register("author_ledger", AUTHORS + """
SELECT author, CAST(count AS BIGINT) AS count, coalesce(posts, 0) AS posts, coalesce(day_count, 0) AS day_count, strftime(last_day, '%Y-%m-%d') AS last_day,
  has_test_signal FROM led""")
def author_ledger(spark, sf_dir):
    rows = A.author_ledger(A.author_sightings(_cited(spark, sf_dir)),
                           A.manual_entries(manual(spark, sf_dir)))
    return rows.select("author", F.col("count").cast("bigint").alias("count"), "posts", "day_count",
                       day_text("last_day"), "has_test_signal")


@register("author_nominees", AUTHORS + """
SELECT author, CAST(count AS BIGINT) AS count,
  CASE WHEN has_test_signal THEN 'nominated' ELSE 'review' END AS list FROM led WHERE count >= 3""")
def author_nominees(spark, sf_dir):
    ledger = A.author_ledger(A.author_sightings(_cited(spark, sf_dir)),
                             A.manual_entries(manual(spark, sf_dir)))
    return A.nominees(ledger).orderBy(F.col("count").desc()).select(
        "author", F.col("count").cast("bigint").alias("count"), "list")


def _current(sightings: str, manual: str, as_of: str) -> str:
    """CTEs ending in ``kept``: what ``current_sightings`` keeps at a day."""
    return f""",
dd AS (SELECT DISTINCT author, day FROM {sightings} WHERE day <= {as_of}),
br AS (SELECT *, CASE WHEN day - lag(day) OVER (PARTITION BY author ORDER BY day) > {A.FORGET_DAYS}
    THEN 1 ELSE 0 END AS gap FROM dd),
sr AS (SELECT author, day, sum(gap) OVER (PARTITION BY author ORDER BY day) AS stretch FROM br),
rr AS (SELECT DISTINCT s.author, s.status_id, s.day, sr.stretch FROM {sightings} s
  JOIN sr ON s.author = sr.author AND s.day = sr.day),
cc AS (SELECT author, stretch, count(DISTINCT status_id) AS n FROM rr GROUP BY ALL),
bb AS (SELECT cc.author, max(stretch) AS last,
    min(CASE WHEN n + coalesce(mc, 0) >= 2 THEN stretch END) AS firm
  FROM cc LEFT JOIN (SELECT author, max(manual_count) AS mc FROM {manual} GROUP BY author) x
    ON cc.author = x.author GROUP BY cc.author),
tt AS (SELECT rr.*, firm, max(day) OVER (PARTITION BY rr.author) AS seen FROM rr
  JOIN bb ON rr.author = bb.author AND stretch >= coalesce(firm, last)),
kept AS (SELECT * FROM tt WHERE firm IS NOT NULL OR {as_of} - seen <= {A.FORGET_DAYS})
SELECT author, status_id, strftime(day, '%Y-%m-%d') AS day FROM kept"""


@register("author_current", AUTHORS + _current("st", "m", f"DATE '{V.LAST_DAY}'"))
def author_current(spark, sf_dir):
    kept = A.current_sightings(A.author_sightings(_cited(spark, sf_dir)),
                               A.manual_entries(manual(spark, sf_dir)), F.lit(V.LAST_DAY).cast("date"))
    return kept.select("author", "status_id", day_text())


# One author a post, seen every 40 days at most: most are forgotten in between.
_SPACING = 40
_LAST_SPARSE = 29 * _SPACING


@register("author_sparse", AUTHORS + f""",
sp AS (SELECT author || 'n' || status_id AS author, status_id,
  CAST(DATE '{V.FIRST_DAY}' + CAST((day - DATE '{V.FIRST_DAY}') * {_SPACING} AS INTEGER) AS DATE) AS day
  FROM st),
sm AS (SELECT 'author' || (s_suppkey % 23) || 'n' || (1000 + s_suppkey % 97) AS author,
  s_suppkey % 4 AS manual_count FROM supplier)"""
          + _current("sp", "sm", f"(DATE '{V.FIRST_DAY}' + {_LAST_SPARSE})"))
def author_sparse(spark, sf_dir):
    first, n = F.lit(V.FIRST_DAY).cast("date"), F.col("s_suppkey")
    cited = _cited(spark, sf_dir).select(
        F.date_add(first, F.datediff("day", first) * _SPACING).alias("day"),
        F.transform("x_links", lambda link: F.regexp_replace(
            link, r"/status/(\d+)", r"n$1/status/$1")).alias("x_links"))
    by_hand = V.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("Author"), n % 23, F.lit("n"), 1000 + n % 97).alias("handle"),
        (n % 4).cast("int").alias("score"), F.lit(False).alias("has_test_signal"),
        F.lit("").alias("provenance"))
    kept = A.current_sightings(A.author_sightings(cited), A.manual_entries(by_hand),
                               F.date_add(first, _LAST_SPARSE))
    return kept.select("author", "status_id", day_text())
