"""Parsing of landed bodies; the bodies are built row by row from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsledger.sources import apis, captures, feeds
from registry import register, views as V
from registry.digests import joined


@register("search_hits", """
WITH h AS (SELECT user_id, event_type, event_id, value, ts, row_number() OVER (PARTITION BY user_id
  ORDER BY event_type, event_id) AS rn FROM events)
SELECT 'https://news.ycombinator.com/item?id=' || user_id AS url, event_type AS matched_query,
  CAST(floor(value) AS BIGINT) || ' points, ' || event_id || ' comments' AS summary
FROM h WHERE rn = 1""")
def search_hits(spark, sf_dir):
    events = V.table(spark, sf_dir, "events")
    hit = F.struct(F.col("user_id").cast("string").alias("objectID"),
                   F.floor("value").alias("points"), F.col("event_id").alias("num_comments"))
    bodies = events.select(
        F.lit("hn").alias("source_id"), F.col("event_type").alias("query"),
        F.struct("event_type", "event_id").alias("query_ord"),
        F.to_json(F.struct(F.array(hit).alias("hits"))).alias("body"))
    return apis.search_hits(bodies).select("url", "matched_query", "summary")


@register("hub_models", """
SELECT 'hub' || p_partkey AS source_id, p_name AS title, 'https://huggingface.co/' || p_name AS url,
  'likes=' || p_size || ' downloads=None trending=' || p_brand AS summary FROM part""")
def hub_models(spark, sf_dir):
    model = F.struct(F.lit("").alias("id"), F.col("p_name").alias("modelId"),
                     F.col("p_size").alias("likes"), F.col("p_brand").alias("trendingScore"))
    bodies = V.table(spark, sf_dir, "part").select(
        F.concat(F.lit("hub"), "p_partkey").alias("source_id"),
        F.to_json(F.array(model)).alias("body"))
    return apis.hub_models(bodies).select("source_id", "title", "url", "summary")


@register("incidents", """
SELECT event_id, '[服务事故] S' || user_id || ': ' || CASE WHEN value > 100 THEN 'slow（' || event_type || '/open）'
    ELSE 'trouble ' || event_type END AS title,
  CASE WHEN value > 100 THEN 'body' ELSE 'indicator=' || event_type END AS summary
FROM events WHERE value > 100 OR event_type <> 'view'""")
def incidents(spark, sf_dir):
    kind = F.col("event_type")
    one = F.struct(F.lit("slow").alias("name"), kind.alias("impact"), F.lit("open").alias("status"),
                   F.array(F.struct(F.lit("<p>body</p>").alias("body"))).alias("incident_updates"))
    status = F.struct(F.when(kind == "view", "none").otherwise(kind).alias("indicator"),
                      F.concat(F.lit("trouble "), kind).alias("description"))
    body = F.to_json(F.struct(status.alias("status"),
                              F.when(F.col("value") > 100, F.array(one)).alias("incidents")))
    bodies = V.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("source_id"), F.concat(F.lit("S"), "user_id").alias("name"),
        F.lit("https://status.example.com").alias("url"), F.lit("t").alias("fetched_at"),
        body.alias("body"))
    return apis.incidents(bodies).select(F.col("source_id").alias("event_id"), "title", "summary")


@register("price_catalog", """
SELECT p_brand || '/' || p_partkey AS key, p_name AS model_name, 'https://p.com' AS pricing_url
FROM part WHERE contains(trim(regexp_replace(lower(p_brand || ' ' || p_brand || ' ' || p_partkey || ' ' ||
  p_name), '[^a-z0-9]+', ' ', 'g')), 'brand 1')""")
def price_catalog(spark, sf_dir):
    model = F.struct(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"),
                     F.struct(F.col("p_retailprice").alias("input_mtok")).alias("prices"))
    provider = F.struct(F.col("p_brand").alias("id"),
                        F.array(F.lit(""), F.lit("https://p.com")).alias("pricing_urls"),
                        F.array(model).alias("models"))
    bodies = V.table(spark, sf_dir, "part").select(
        F.lit("prices").alias("source_id"), F.to_json(F.array(provider)).alias("body"))
    return apis.price_catalog(bodies, ["Brand#1"]).select("key", "model_name", "pricing_url")


@register("quotes", """
SELECT o_orderkey, round((o_totalprice - c_acctbal) / nullif(c_acctbal, 0) * 100, 4) AS change_pct,
  strftime(CAST(o_orderdate AS TIMESTAMP), '%Y-%m-%d') AS day FROM orders
JOIN customer ON c_custkey = o_custkey""")
def quotes(spark, sf_dir):
    orders, customers = V.table(spark, sf_dir, "orders"), V.table(spark, sf_dir, "customer")
    rows = orders.join(customers, orders.o_custkey == customers.c_custkey)
    at = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    body = F.to_json(F.struct(
        F.lit("X").alias("symbol"), F.col("o_totalprice").alias("price"),
        F.array(at - 86400, at - 100, at).alias("timestamp"),
        F.array(F.col("c_acctbal"), F.lit(None).cast("double"), F.col("o_totalprice")).alias("close")),
        {"ignoreNullFields": "false"})
    found = apis.quotes(rows.select(F.col("o_orderkey").alias("source_id"), body.alias("body")))
    return found.select(F.col("source_id").alias("o_orderkey"),
                        F.round("change_pct", 4).alias("change_pct"),
                        F.regexp_extract("closes", r"(\d{4}-\d{2}-\d{2}): [0-9.\-]+$", 1).alias("day"))


@register("feed_items", """
SELECT page_id, 'Page ' || page_id AS title, url,
  -- found twice: as a link, and in plain text, where an ampersand ends it
  CASE WHEN contains(url, '&') THEN regexp_extract(url, '^[^&]*') || '|' ELSE '' END || url AS external,
  strftime(DATE '2024-01-01' + CAST(page_id % 30 AS INTEGER), '%Y-%m-%d') AS published
FROM pages""")
def feed_items(spark, sf_dir):
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 30).cast("int")),
                        "yyyy-MM-dd")
    safe = F.replace("url", F.lit("&"), F.lit("&amp;"))
    body = F.concat(
        F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Page '), "page_id",
        F.lit('</title><link href="'), safe, F.lit('"/><updated>'), day,
        F.lit("</updated><content>&lt;a href='"), F.replace(safe, F.lit("&"), F.lit("&amp;")),
        F.lit("'&gt;x&lt;/a&gt;</content></entry></feed>"))
    bodies = V.table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("source_id"), F.lit("t").alias("fetched_at"),
        F.encode(body, "utf-8").alias("body"))
    items = feeds.feed_items(feeds.parse_feeds(bodies))
    return items.select(F.col("source_id").cast("bigint").alias("page_id"), "title", "url",
                        joined("external", F.col("external_urls")), "published")


@register("collection_identity", f"""
SELECT doc_id, 'src' || doc_id || ':collection' AS collection_id,
  sha256('{{"items":[' || to_json(struct_pack(content_sha256 := '', external_url := '', published := '',
    summary := text, title := lang, url := 'https://example.com/' || doc_id, x_links := CAST([] AS VARCHAR[])))
    || '],"source":"src' || doc_id || '"}}') AS collection_hash FROM documents""")
def collection_identity(spark, sf_dir):
    none = F.lit(None).cast("string")
    item = F.struct(
        F.col("lang").alias("title"),
        F.concat(F.lit("https://www.example.com/"), "doc_id", F.lit("/?utm_source=x")).alias("url"),
        none.alias("published"), F.col("text").alias("summary"), none.alias("external_url"),
        none.alias("content_sha256"), F.array().cast("array<string>").alias("x_links"))
    landed = V.table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("src"), "doc_id").alias("source"), F.lit("n").alias("name"),
        F.array(item).alias("items"))
    return captures.collection_identity(landed).select("doc_id", "collection_id", "collection_hash")
