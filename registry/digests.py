"""Classification, URL, text and identity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsledger import fixed_values as fixed
from newsledger.functions import ids, text as T, times, urls as U
from newsledger.operators.barrier import computed
from newsledger.operators.classify import digest_order, rejected_urls, with_identity
from newsledger.operators.ordered import first_wins, with_ranged_sum
from newsledger.session import materialize
from registry import register, views as V


def joined(name: str, column=None):
    return F.array_join(F.col(name) if column is None else column, "|").alias(name)


def day_text(name: str = "day"):
    return F.date_format(name, "yyyy-MM-dd").alias(name)


@register("digest_sections", V.CLASSIFIED + """
SELECT strftime(day, '%Y-%m-%d') AS day, section, section_ord, title, url, source_id, tier,
  tier_label, array_to_string(model_hits, '|') AS model_hits,
  array_to_string(topic_hits, '|') AS topic_hits, source_item_id, snapshot_hash, summary
FROM classified""")
def digest_sections(spark, sf_dir):
    rows = V.classified(spark, sf_dir)
    return rows.orderBy("day", *digest_order(rows)).select(
        day_text(), "section", "section_ord", "title", "url", "source_id", "tier", "tier_label",
        joined("model_hits"), joined("topic_hits"), "source_item_id", "snapshot_hash", "summary")


@register("digest_places", V.CLASSIFIED + """
SELECT strftime(day, '%Y-%m-%d') AS day, section, source_id, item_ord, row_number() OVER (
  PARTITION BY day ORDER BY section_ord, tier <> 'official', -len(topic_hits), source_id, item_ord)
  AS place FROM classified""")
def digest_places(spark, sf_dir):
    """The place of every item in its day's reading order, by one distributed sort."""
    rows = V.classified(spark, sf_dir)
    narrow = materialize(rows.select("day", "section", "section_ord", "source_id", "tier",
                                     "topic_hits", "payload_ord", "item_ord"))
    placed = with_ranged_sum(narrow, [F.col("day"), *digest_order(narrow)], F.lit(1), "nth")
    heads = placed.groupBy("day").agg(F.min("nth").alias("head"))
    return placed.join(heads, "day").select(
        day_text(), "section", "source_id", "item_ord",
        (F.col("nth") - F.col("head") + 1).alias("place"))


@register("section_counts", V.CLASSIFIED + """
SELECT strftime(day, '%Y-%m-%d') AS day, section, tier, count(*) AS items,
  count(DISTINCT source_id) AS sources FROM classified GROUP BY ALL""")
def section_counts(spark, sf_dir):
    return (V.classified(spark, sf_dir).groupBy(day_text(), "section", "tier")
            .agg(F.count("*").alias("items"), F.countDistinct("source_id").alias("sources")))


@register("topic_hit_counts", V.STORY_INPUT + """,
h AS (SELECT source_id, unnest(topic_hits || model_hits) AS keyword FROM classified)
SELECT source_id, keyword, count(*) AS hits FROM h GROUP BY ALL""")
def topic_hit_counts(spark, sf_dir):
    rows = V.classified(spark, sf_dir, first_url_wins=False)
    return (rows.select("source_id", F.explode(F.concat("topic_hits", "model_hits")).alias("keyword"))
            .groupBy("source_id", "keyword").agg(F.count("*").alias("hits")))


@register("first_wins_dedupe", "WITH " + V.OBSERVATIONS + """,
r AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY day, source_id, item_ord) AS rn FROM obs)
SELECT url, strftime(day, '%Y-%m-%d') AS day, source_id, item_ord, title, content_sha256
FROM r WHERE rn = 1""")
def first_wins_dedupe(spark, sf_dir):
    rows = V.observations(spark, sf_dir).select(
        "url", "day", "source_id", "item_ord", "title", "content_sha256")
    return first_wins(rows, ["url"], ["day", "source_id", "item_ord"]).select(
        "url", day_text(), "source_id", "item_ord", "title", "content_sha256")


# every thirteenth item has lost the web address in its URL
@register("rejected_items", "WITH " + V.OBSERVATIONS + """,
odd AS (SELECT * REPLACE (CASE WHEN item_ord % 13 = 0 THEN 'mailto:item' || item_ord ELSE url END
  AS url) FROM obs),""" + V.sql_classified(first_url_wins=False, source="odd") + """
SELECT source_id, url FROM classified WHERE canonical_url IS NULL""")
def rejected_items(spark, sf_dir):
    odd = V.observations(spark, sf_dir).withColumn("url", F.when(
        F.col("item_ord") % 13 == 0, F.concat(F.lit("mailto:item"), "item_ord"))
        .otherwise(F.col("url")))
    return rejected_urls(odd, V.RULES, V.WINDOW_DAYS).select("source_id", "url")


# --- URLs ---------------------------------------------------------------------
@register("url_canonical", f"SELECT page_id, url, {V.sql_canonical('url')} AS canonical FROM pages")
def url_canonical(spark, sf_dir):
    return V.table(spark, sf_dir, "pages").select(
        "page_id", "url", U.canonical_url(F.col("url")).alias("canonical"))


@register("url_match_key", f"""
SELECT page_id, {V.sql_match_url('url')} AS match_url,
  'url-sha256:' || sha256({V.sql_match_url('url')}) AS signal_key,
  regexp_extract({V.sql_match_url('url')}, '^[^?]*') AS safe_url FROM pages""")
def url_match_key(spark, sf_dir):
    pages = V.table(spark, sf_dir, "pages")
    rows = computed(pages.select("page_id", "url"), {"match_url": U.match_url(F.col("url"))})
    return rows.select(
        "page_id", "match_url",
        F.concat(F.lit("url-sha256:"), F.sha2("match_url", 256)).alias("signal_key"),
        F.substring_index("match_url", "?", 1).alias("safe_url"))


@register("url_audit_norm", f"""
SELECT page_id, {V.sql_match_url('url', fixed.AUDIT_DROP_KEYS)} AS audit_url FROM pages""")
def url_audit_norm(spark, sf_dir):
    return V.table(spark, sf_dir, "pages").select(
        "page_id", U.audit_url(F.col("url")).alias("audit_url"))


@register("url_hosts", r"""
WITH h AS (SELECT lower(regexp_extract(url, '^https?://([^/?#]*)', 1)) AS raw FROM pages)
SELECT regexp_replace(raw, '^www\.', '') AS host,
  raw = 'example.com' OR ends_with(raw, '.example.com') OR ends_with(raw, '.example.org')
    OR raw = 'example.org' AS configured,
  count(*) AS pages FROM h GROUP BY ALL""")
def url_hosts(spark, sf_dir):
    pages = V.table(spark, sf_dir, "pages")
    host = U.raw_host(F.col("url"))
    return (pages.select(U.url_host(F.col("url")).alias("host"),
                         U.host_matches(host, ["example.com", "example.org"]).alias("configured"))
            .groupBy("host", "configured").agg(F.count("*").alias("pages")))


@register("item_links", "WITH " + V.OBSERVATIONS + f"""
SELECT item_ord, coalesce(paper_link, '') || CASE WHEN paper_link IS NOT NULL AND
    post_link IS NOT NULL THEN '|' ELSE '' END || coalesce(post_link, '') AS links,
  coalesce(replace(post_link, 'https://', ''), '') AS posts FROM obs""")
def item_links(spark, sf_dir):
    return V.observations(spark, sf_dir).select(
        "item_ord", joined("links", U.extract_match_urls(F.col("summary"))),
        joined("posts", U.status_links(F.col("summary"))))


@register("artifact_links", "WITH " + V.OBSERVATIONS + f"""
SELECT source_id, count(*) FILTER (paper_link IS NOT NULL) AS papers,
  count(*) FILTER (external_url LIKE 'http://github.com/%/%') AS repositories FROM obs GROUP BY ALL""")
def artifact_links(spark, sf_dir):
    rows = V.observations(spark, sf_dir)
    paper = F.exists(U.extract_audit_urls(F.col("summary")), U.names_artifact)
    return (rows.select("source_id", paper.cast("int").alias("paper"),
                        U.is_artifact_url(F.col("external_url")).cast("int").alias("repository"))
            .groupBy("source_id").agg(F.sum("paper").alias("papers"),
                                      F.sum("repository").alias("repositories")))


@register("link_targets", r"""
WITH l AS (SELECT page_id, regexp_extract(url, '^https?://(.*)$', 1) AS bare,
    'notes/' || page_id || '.md' AS local FROM pages)
SELECT page_id, 'https://' || bare AS linked,
  CAST(NULL AS VARCHAR) AS local FROM l""")
def link_targets(spark, sf_dir):
    pages = V.table(spark, sf_dir, "pages")
    bare = F.regexp_extract("url", "^https?://(.*)$", 1)
    local = F.concat(F.lit("notes/"), F.col("page_id"), F.lit(".md"))
    return pages.select("page_id", U.linkify(bare).alias("linked"),
                        U.linkify(local).alias("local"))


# --- text ---------------------------------------------------------------------
_VISIBLE = (r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, "
            r"'<script\b[^>]*>.*?</script>', ' ', 'gis'), '<style\b[^>]*>.*?</style>', ' ', "
            r"'gis'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))")


@register("page_text", f"SELECT page_id, {_VISIBLE} AS body FROM pages")
def page_text(spark, sf_dir):
    return V.table(spark, sf_dir, "pages").select(
        "page_id", T.visible_text(F.col("html")).alias("body"))


@register("page_fingerprint", f"""
SELECT page_id, sha256({_VISIBLE}) AS content_sha256, sha256(html) AS response_sha256,
  CAST(length({_VISIBLE}) AS INTEGER) AS visible_chars FROM pages""")
def page_fingerprint(spark, sf_dir):
    pages = computed(V.table(spark, sf_dir, "pages").select("page_id", "html"),
                     {"body": T.visible_text(F.col("html"))})
    return pages.select("page_id", F.sha2("body", 256).alias("content_sha256"),
                        F.sha2("html", 256).alias("response_sha256"),
                        F.length("body").alias("visible_chars"))


_TOKENS = ("list_sort(list_distinct(list_filter(regexp_extract_all(lower({0}), "
           r"'[a-z0-9][a-z0-9_.\-]*'), lambda w: length(w) >= 2 AND NOT list_contains("
           "['a','an','and','for','in','is','its','new','of','on','the','to','with'], w))))")


@register("title_tokens", "WITH " + V.OBSERVATIONS + f""",
t AS (SELECT item_ord, trim(regexp_replace(lower(title), '\\s+', ' ', 'g')) AS title FROM obs)
SELECT item_ord, title, array_to_string({_TOKENS.format('title')}, '|') AS tokens,
  length(title) >= 18 AND len({_TOKENS.format('title')}) >= 4 AS mergeable FROM t""")
def title_tokens(spark, sf_dir):
    rows = V.observations(spark, sf_dir).select(
        "item_ord", T.normalized_title(F.col("title")).alias("title"))
    rows = computed(rows, {"tokens": T.title_tokens(F.col("title"))})
    return rows.select("item_ord", "title", joined("tokens", F.array_sort("tokens")),
                       T.title_is_mergeable(F.col("title"), F.col("tokens")).alias("mergeable"))


# An item's title against the first sentence of its text, both with a vendor from the id.
_NAMED = (["", " openai", " anthropic"], ["", " openai", " anthropic", " openai anthropic"])


def _sql_vendors(title: str) -> str:
    hits = ", ".join(f"CASE WHEN contains({title}, {V.quote(alias)}) THEN {V.quote(name)} END"
                     for alias, name in fixed.VENDOR_ALIASES.items())
    return f"list_distinct(list_filter([{hits}], lambda v: v IS NOT NULL))"


def _sql_ending(names: list[str]) -> str:
    listed = ", ".join(V.quote(n) for n in names)
    return f"[{listed}][CAST(item_ord % {len(names)} AS INTEGER) + 1]"


@register("title_pairs_jaccard", "WITH " + V.OBSERVATIONS + f""",
p0 AS (SELECT item_ord, title || {_sql_ending(_NAMED[0])} AS x,
  regexp_extract(summary, '^[^.\n]*') || {_sql_ending(_NAMED[1])} AS y FROM obs),
p1 AS (SELECT item_ord, trim(regexp_replace(lower(x), '\\s+', ' ', 'g')) AS x,
  trim(regexp_replace(lower(y), '\\s+', ' ', 'g')) AS y FROM p0),
p2 AS (SELECT item_ord, {_TOKENS.format('x')} AS a, {_TOKENS.format('y')} AS b,
  {_sql_vendors('x')} AS v, {_sql_vendors('y')} AS w FROM p1)
SELECT item_ord, CASE WHEN len(a) > 0 AND len(b) > 0
    THEN len(list_intersect(a, b)) / len(list_distinct(a || b)) ELSE 0.0 END AS jaccard,
  len(v) = 0 OR len(w) = 0 OR list_has_any(v, w) AS compatible FROM p2""")
def title_pairs_jaccard(spark, sf_dir):
    def ending(names):
        return F.element_at(F.array(*[F.lit(n) for n in names]),
                            (F.col("item_ord") % len(names) + 1).cast("int"))

    first = F.regexp_extract("summary", r"^[^.\n]*", 0)
    rows = V.observations(spark, sf_dir).select(
        "item_ord", T.normalized_title(F.concat("title", ending(_NAMED[0]))).alias("x"),
        T.normalized_title(F.concat(first, ending(_NAMED[1]))).alias("y"))
    rows = computed(rows, {"a": T.title_tokens(F.col("x")), "b": T.title_tokens(F.col("y"))})
    return rows.select("item_ord", T.jaccard(F.col("a"), F.col("b")).alias("jaccard"),
                       T.titles_compatible(T.title_vendors(F.col("x")), T.title_models(F.col("x")),
                                           T.title_vendors(F.col("y")), T.title_models(F.col("y")))
                       .alias("compatible"))


@register("title_keys", "WITH " + V.OBSERVATIONS + r"""
SELECT item_ord, array_to_string(list_filter(regexp_extract_all(lower(title),
  '[a-z0-9][a-z0-9_+.\-]*'), lambda w: length(w) > 2)[1:20], ' ') AS title_key FROM obs""")
def title_keys(spark, sf_dir):
    return V.observations(spark, sf_dir).select(
        "item_ord", T.title_key(F.col("title")).alias("title_key"))


@register("published_times", "WITH " + V.OBSERVATIONS + """
SELECT item_ord, strftime(published_at, '%Y-%m-%dT%H:%M:%S+00:00') AS published_at,
  strftime(CAST(date_trunc('month', day) AS DATE) - INTERVAL 1 DAY, '%Y-%m') AS last_month,
  CAST(datediff('day', DATE '0001-01-01', day) + 1 AS INTEGER) AS day_number FROM obs""")
def published_times(spark, sf_dir):
    utc = F.date_format(times.parse_published(F.col("published")), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    return V.observations(spark, sf_dir).select(
        "item_ord", utc.alias("published_at"),
        times.previous_month(F.col("day")).alias("last_month"),
        times.day_ordinal(F.col("day")).alias("day_number"))


@register("text_patterns", r"""
SELECT doc_id, regexp_matches(text, '(?i)\b\d+(\.\d+)?\s*(ms|gb|mb|%|tok(en)?s?/s|x)\b') AS quantity,
  regexp_matches(text, '(?i)[$￥¥]|\b(USD|CNY)\b|\d+(\.\d+)?\s*元') AS currency,
  regexp_matches(text, '(?i)\b\d+(\.\d+)?\s*(%|ms|s|minutes?|hours?)\b') AS duration,
  regexp_matches(text, '(?i)the') AND regexp_matches(text, '(?i)tion') AS required
FROM documents""")
def text_patterns(spark, sf_dir):
    body = F.col("text")
    return V.table(spark, sf_dir, "documents").select(
        "doc_id", body.rlike(fixed.QUANTITY_PATTERN).alias("quantity"),
        body.rlike(fixed.CURRENCY_PATTERN).alias("currency"),
        body.rlike(fixed.DURATION_PATTERN).alias("duration"),
        T.all_patterns(body, F.array(F.lit("the"), F.lit("tion"))).alias("required"))


_GROUPS = {"alpha": ["tion", "ment"], "beta": ["keit", "ung"], "gamma": ["é", "ñ"]}


@register("marker_groups", "SELECT doc_id, array_to_string(list_filter([" + ", ".join(
    f"CASE WHEN {' OR '.join(f'contains(lower(text), {V.quote(m)})' for m in _GROUPS[g])} "
    f"THEN '{g}' END" for g in sorted(_GROUPS)) + """], lambda x: x IS NOT NULL), '|') AS groups,
  array_to_string(list_filter([CASE WHEN contains(lower(text), 'erly') THEN 'erly' END,
    CASE WHEN contains(lower(text), 'pour') THEN 'pour' END], lambda x: x IS NOT NULL), '|') AS hits
FROM documents""")
def marker_groups(spark, sf_dir):
    rows = V.table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("low"))
    return rows.select("doc_id", joined("groups", T.marker_groups(F.col("low"), _GROUPS)),
                       joined("hits", T.matched_markers(F.col("low"), ["pour", "erly"])))


@register("community_ids", """
SELECT page_id, 'r_' || trim(regexp_replace(lower(regexp_extract(html, '<title>([^<]*)', 1)),
  '[^a-z0-9]+', '_', 'g'), '_') AS community FROM pages""")
def community_ids(spark, sf_dir):
    title = F.regexp_extract("html", "<title>([^<]*)", 1)
    return V.table(spark, sf_dir, "pages").select(
        "page_id", T.community_id(title).alias("community"))


# --- identities ---------------------------------------------------------------
@register("item_identity", "WITH " + V.OBSERVATIONS + f""",
c AS (SELECT *, {V.sql_canonical('url')} AS canonical FROM obs),
i AS (SELECT *, source_id || ':' || left(sha256(source_id || chr(0) || canonical), 20) AS item_id
  FROM c)
SELECT item_ord, item_id, sha256(CAST(to_json(struct_pack(content_sha256 := content_sha256,
    published := published, summary := summary, title := title, url := canonical)) AS VARCHAR))
    AS snapshot_hash,
  regexp_extract(item_id, '^(.*):[^:]*$', 1) AS source_id,
  'story-' || left(sha256(canonical || chr(0) || trim(regexp_replace(lower(title), '\\s+', ' ',
    'g'))), 16) AS story_id FROM i""")
def item_identity(spark, sf_dir):
    rows = with_identity(V.observations(spark, sf_dir))
    return rows.select(
        "item_ord", F.col("source_item_id").alias("item_id"), "snapshot_hash",
        ids.source_of_item(F.col("source_item_id")).alias("source_id"),
        ids.story_id(F.col("canonical_url"), T.normalized_title(F.col("title"))).alias("story_id"))
