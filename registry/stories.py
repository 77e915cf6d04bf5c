"""Story, origin and lineage queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsledger.operators import health as H, lineage as L, stories as S
from newsledger.session import materialize, small_broadcasts
from registry import register, views as V
from registry.digests import day_text
from registry.audits import community_entries


def story_items(spark, sf_dir):
    with small_broadcasts(spark):
        return materialize(S.cluster_items(V.classified(spark, sf_dir, first_url_wins=False)))


def story_table(spark, sf_dir, items=None):
    return S.stories(story_items(spark, sf_dir) if items is None else items)


def lineage_table(spark, sf_dir):
    items = story_items(spark, sf_dir)
    with small_broadcasts(spark):
        return materialize(L.build_lineages(materialize(story_table(spark, sf_dir, items)), items))


@register("stories")
def stories(spark, sf_dir):
    rows = story_table(spark, sf_dir).orderBy("day", *S.story_order())
    return rows.select(
        day_text(), "story_id", "title", "primary_url", "primary_source_item_id", "item_count",
        "source_count", "evidence_tiers", "sections",
        *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("earliest_at", "latest_at")])


@register("story_items")
def story_items_query(spark, sf_dir):
    return story_items(spark, sf_dir).select(
        day_text(), "story_id", "source_item_id", "snapshot_hash", "title", "url", "external_url",
        "source_id", "tier", "section", "published", "summary")


@register("merge_events")
def merge_events(spark, sf_dir):
    rows = S.merge_events(story_items(spark, sf_dir))
    return rows.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


ORIGIN = V.STORY_INPUT + f""",
o0 AS (SELECT *, canonical_url AS observed_url,
  coalesce(CASE WHEN external_url <> '' THEN {V.sql_canonical('external_url')} END, '') AS ext
  FROM classified),
origins AS (SELECT *, CASE WHEN ext <> '' THEN ext ELSE observed_url END AS origin_url,
  CASE WHEN tier IN ('aggregator', 'index', 'radar', 'finance') THEN tier ELSE 'direct' END AS carrier
  FROM o0)"""
_DOMAIN = r"regexp_replace(regexp_extract(origin_url, '^https?://([^/?#:]*)', 1), '^www\.', '')"


@register("origin_records", ORIGIN + f"""
SELECT item_ord, source_item_id, observed_url, carrier, origin_url, {_DOMAIN} AS origin_domain,
  'origin-' || left(sha256(origin_url), 20) AS independence_group,
  CASE WHEN ext <> '' THEN 'external_url' ELSE 'observed_url' END AS classification_basis
FROM origins""")
def origin_records(spark, sf_dir):
    rows = S.origin_records(V.classified(spark, sf_dir, first_url_wins=False))
    return rows.select("item_ord", "source_item_id", "observed_url", "carrier", "origin_url",
                       "origin_domain", "independence_group", "classification_basis")


@register("url_independence", ORIGIN + f"""
SELECT strftime(day, '%Y-%m-%d') AS day, canonical_url AS story, count(*) AS observation_count,
  count(DISTINCT source_id) AS coverage_count, count(DISTINCT carrier) AS carrier_type_count,
  count(DISTINCT origin_url) AS estimated_independent_origin_count,
  CAST(0 AS BIGINT) AS unknown_origin_count, count(DISTINCT {_DOMAIN}) AS origin_domain_count
FROM origins GROUP BY day, canonical_url""")
def url_independence(spark, sf_dir):
    rows = S.origin_records(V.classified(spark, sf_dir, first_url_wins=False))
    rows = rows.withColumn("story", F.col("canonical_url")).withColumn(
        "day", F.date_format("day", "yyyy-MM-dd"))
    return S.independence(rows, ("day", "story"))


@register("story_independence")
def story_independence(spark, sf_dir):
    rows = S.independence(S.origin_records(story_items(spark, sf_dir)))
    return rows.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@register("story_health")
def story_health(spark, sf_dir):
    dim = community_entries(spark, sf_dir).select("source")
    items = story_items(spark, sf_dir)
    return dim.join(H.story_health(story_table(spark, sf_dir, items), items),
                    "source", "left").fillna(0)


@register("lineage_entries")
def lineage_entries(spark, sf_dir):
    rows = lineage_table(spark, sf_dir)
    return rows.select(day_text(), "story_id", "lineage_id", "title", "update_type", "link_reason",
                       "similarity", "prior_story_id", day_text("prior_day"))


@register("lineage_groups")
def lineage_groups(spark, sf_dir):
    rows = L.lineage_groups(lineage_table(spark, sf_dir))
    return rows.orderBy(F.col("window_latest_seen").desc(), F.col("event_count").desc(),
                        F.col("lineage_id").desc()).select(
        "lineage_id", day_text("window_first_seen"), day_text("window_latest_seen"),
        "event_count", "day_count", "latest_title")


@register("lineage_by_item", V.STORY_INPUT + """,
i AS (SELECT DISTINCT day, canonical_url AS story_id, source_item_id FROM classified),
pairs AS (SELECT a.day, a.story_id, max((b.day, b.story_id)) AS prior FROM i a JOIN i b
  ON a.source_item_id = b.source_item_id AND b.day BETWEEN a.day - INTERVAL 7 DAY
    AND a.day - INTERVAL 1 DAY GROUP BY a.day, a.story_id)
SELECT strftime(day, '%Y-%m-%d') AS day, story_id, strftime(prior[1], '%Y-%m-%d') AS prior_day,
  prior[2] AS prior_story_id FROM pairs""")
def lineage_by_item(spark, sf_dir):
    rows = V.classified(spark, sf_dir, first_url_wins=False).select(
        "day", F.col("canonical_url").alias("story_id"), "source_item_id").distinct()
    return L.shared_item_parents(rows).select(day_text(), "story_id", day_text("prior_day"),
                                              "prior_story_id")
