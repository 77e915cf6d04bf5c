"""Landed API bodies to items. Every body is JSON text with an explicit schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from newsledger.functions import text as T
from newsledger.operators.barrier import computed
from newsledger.operators.changes import flat_price_snapshot
from newsledger.operators.ordered import first_wins

HITS = ("hits ARRAY<STRUCT<objectID STRING, title STRING, url STRING, created_at STRING, "
        "points BIGINT, num_comments BIGINT>>")
MODELS = ("ARRAY<STRUCT<id STRING, modelId STRING, lastModified STRING, createdAt STRING, "
          "likes BIGINT, downloads BIGINT, trendingScore STRING>>")
PAPERS = ("ARRAY<STRUCT<id STRING, title STRING, summary STRING, publishedAt STRING, "
          "paper STRUCT<id STRING, title STRING, summary STRING, publishedAt STRING>>>")
REPOSITORIES = ("ARRAY<STRUCT<full_name STRING, html_url STRING, pushed_at STRING, "
                "created_at STRING, description STRING, stargazers_count BIGINT>>")
SEARCH = f"items {REPOSITORIES}"
STATUS = ("page STRUCT<url STRING>, status STRUCT<indicator STRING, description STRING>, "
          "incidents ARRAY<STRUCT<name STRING, impact STRING, status STRING, shortlink STRING, "
          "started_at STRING, created_at STRING, incident_updates ARRAY<STRUCT<body STRING>>>>")
CHART = ("symbol STRING, price DOUBLE, timestamp ARRAY<BIGINT>, close ARRAY<DOUBLE>")
FLAT_PRICES = ("data ARRAY<STRUCT<id STRING, name STRING, "
               "pricing STRUCT<prompt STRING, completion STRING>>>")
CATALOG = ("ARRAY<STRUCT<id STRING, name STRING, pricing_urls ARRAY<STRING>, models "
           "ARRAY<STRUCT<id STRING, name STRING, context_window BIGINT, prices STRING>>>>")


def _rows(bodies: DataFrame, schema: str, path: str | None = None) -> DataFrame:
    """One row per element, with ``ord`` as its position; other columns are kept."""
    parsed = computed(bodies, {"_b": F.from_json("body", schema)}).drop("body")
    element = F.col(f"_b.{path}") if path else F.col("_b")
    kept = [c for c in parsed.columns if c != "_b"]
    return parsed.select(*kept, F.posexplode(element).alias("ord", "e"))


def _or_empty(*values: Column) -> Column:
    return F.coalesce(*[F.when(v != "", v) for v in values], F.lit(""))


def search_hits(bodies: DataFrame) -> DataFrame:
    """Story hits of several queries (source_id, query, query_ord, body): first hit wins."""
    rows = _rows(bodies, HITS, "hits").withColumn("_id", F.col("e.objectID"))
    rows = first_wins(rows, ["source_id", "_id"], ["query_ord", "ord"])
    count = F.concat(F.coalesce("e.points", F.lit(0)), F.lit(" points, "),
                     F.coalesce("e.num_comments", F.lit(0)), F.lit(" comments"))
    return rows.select(
        "source_id", T.text(F.col("e.title")).alias("title"),
        F.concat(F.lit("https://news.ycombinator.com/item?id="), "_id").alias("url"),
        T.text(F.col("e.url")).alias("external_url"),
        T.text(F.col("e.created_at")).alias("published"), count.alias("summary"),
        F.col("query").alias("matched_query"))


def hub_models(bodies: DataFrame) -> DataFrame:
    rows = _rows(bodies, MODELS)
    name = _or_empty(F.col("e.id"), F.col("e.modelId"))
    text = [F.coalesce(F.col(f"e.{c}").cast("string"), F.lit("None"))
            for c in ("likes", "downloads", "trendingScore")]
    return rows.select(
        "source_id", "ord", name.alias("title"),
        F.concat(F.lit("https://huggingface.co/"), name).alias("url"),
        _or_empty(F.col("e.lastModified"), F.col("e.createdAt")).alias("published"),
        F.format_string("likes=%s downloads=%s trending=%s", *text).alias("summary"))


def hub_papers(bodies: DataFrame) -> DataFrame:
    rows = _rows(bodies, PAPERS)

    def field(name: str) -> Column:
        return F.when(F.col("e.paper").isNotNull(), F.col(f"e.paper.{name}")).otherwise(
            F.col(f"e.{name}"))

    return rows.select(
        "source_id", "ord", T.text(field("title")).alias("title"),
        F.concat(F.lit("https://huggingface.co/papers/"), T.text(field("id"))).alias("url"),
        _or_empty(F.col("e.publishedAt"), field("publishedAt")).alias("published"),
        F.substring(T.strip_tags(field("summary")), 1, 1000).alias("summary"))


def repositories(bodies: DataFrame) -> DataFrame:
    rows = _rows(bodies, REPOSITORIES)
    names = {"title": "full_name", "url": "html_url", "published": "pushed_at",
             "summary": "description"}
    return rows.select("source_id", "ord", *[T.text(F.col(f"e.{c}")).alias(n)
                                             for n, c in names.items()])


def repository_search(bodies: DataFrame, reported: DataFrame) -> DataFrame:
    """New repositories of several queries; each is reported once, ever."""
    rows = _rows(bodies, SEARCH, "items").withColumn("full_name", F.col("e.full_name"))
    rows = first_wins(rows, ["full_name"], ["query_ord", "ord"])
    rows = rows.join(reported.select("full_name"), "full_name", "left_anti")
    title = F.concat(F.lit("[新审计/基准项目] "), "full_name", F.lit("（★"),
                     F.col("e.stargazers_count"), F.lit("）"))
    summary = F.concat(F.substring(T.text(F.col("e.description")), 1, 300), F.lit("（检索词："),
                       "query", F.lit("）"))
    return rows.select("source_id", "full_name", title.alias("title"),
                       F.col("e.html_url").alias("url"),
                       T.text(F.col("e.created_at")).alias("published"), summary.alias("summary"))


def incidents(bodies: DataFrame) -> DataFrame:
    """One row per incident; without any, one row while the indicator shows trouble.

    ``bodies`` has source_id, name, url, fetched_at and body.
    """
    rows = computed(bodies, {"_b": F.from_json("body", STATUS)})
    head = F.concat(F.lit("[服务事故] "), "name", F.lit(": "))
    page = F.coalesce(F.col("_b.page.url"), F.col("url"))
    indicator = F.col("_b.status.indicator")
    none = F.size(F.coalesce("_b.incidents", F.array())) == 0
    each = F.transform("_b.incidents", lambda i: F.struct(
        F.concat(head, T.text(i["name"]), F.lit("（"), T.text(i["impact"]), F.lit("/"),
                 T.text(i["status"]), F.lit("）")).alias("title"),
        F.coalesce(F.when(i["shortlink"] != "", i["shortlink"]), page).alias("url"),
        _or_empty(i["started_at"], i["created_at"]).alias("published"),
        F.substring(T.strip_tags(F.get(i["incident_updates"], F.lit(0))["body"]), 1, 500)
        .alias("summary")))
    alone = F.when(indicator != "none", F.array(F.struct(
        F.concat(head, F.coalesce("_b.status.description", indicator)).alias("title"),
        page.alias("url"), F.col("fetched_at").alias("published"),
        F.concat(F.lit("indicator="), indicator).alias("summary"))))
    return rows.select("source_id", F.inline(F.when(none, alone).otherwise(each)))


def quotes(bodies: DataFrame) -> DataFrame:
    """Landed charts: last price, change of the last two closes (NULL after a close of zero),
    and the closes as text."""
    rows = computed(bodies, {"_b": F.from_json("body", CHART)})
    days = F.filter(F.arrays_zip(F.col("_b.timestamp").alias("t"), F.col("_b.close").alias("c")),
                    lambda x: x["c"].isNotNull() & x["t"].isNotNull())
    closes = F.filter("_b.close", lambda c: c.isNotNull())
    last, before = F.try_element_at(closes, F.lit(-1)), F.try_element_at(closes, F.lit(-2))
    listed = F.array_join(F.transform(days, lambda x: F.concat(
        F.date_format(F.timestamp_seconds(x["t"]), "yyyy-MM-dd"), F.lit(": "),
        F.format_string("%.2f", x["c"]))), "，")
    return rows.select("source_id", F.col("_b.symbol").alias("symbol"),
                       F.col("_b.price").alias("price"),
                       F.when(F.size(closes) >= 2,
                              F.try_divide(last - before, before) * 100)
                       .alias("change_pct"), listed.alias("closes"))


def listed_prices(bodies: DataFrame, keywords: Sequence[str]) -> DataFrame:
    rows = _rows(bodies, FLAT_PRICES, "data")
    models = rows.select("source_id", F.col("e.id").alias("id"), F.col("e.name").alias("name"),
                         F.col("e.pricing.prompt").alias("prompt"),
                         F.col("e.pricing.completion").alias("completion"))
    return flat_price_snapshot(models, keywords)


def price_catalog(bodies: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """Nested price records; ``prices`` stays as the JSON text it came with."""
    wanted = [" ".join("".join(c if c.isascii() and c.isalnum() else " " for c in k.lower()).split())
              for k in keywords if k.strip()]
    rows = _rows(bodies, CATALOG)
    provider = T.text(F.trim("e.id"))
    rows = rows.where(provider != "").select(
        "source_id", provider.alias("provider_id"),
        F.coalesce(F.when(F.trim("e.name") != "", F.trim("e.name")), provider).alias("provider_name"),
        F.coalesce(F.get(F.filter("e.pricing_urls", lambda u: u != ""), F.lit(0)), F.lit(""))
        .alias("pricing_url"), F.explode("e.models").alias("m"))
    model = T.text(F.trim("m.id"))
    rows = rows.where((model != "") & F.col("m.prices").isNotNull()).select(
        "source_id", "provider_id", "provider_name", "pricing_url", model.alias("model_id"),
        F.coalesce(F.when(F.trim("m.name") != "", F.trim("m.name")), model).alias("model_name"),
        F.col("m.context_window").alias("context_window"), F.col("m.prices").alias("prices"))
    hay = T.price_match_text(F.concat_ws(" ", "provider_id", "provider_name", "model_id",
                                         "model_name"))
    rows = rows.withColumn("key", F.concat_ws("/", "provider_id", "model_id"))
    return rows.where(T.contains_any(hay, wanted)) if wanted else rows


def keep_if_contains(items: DataFrame, markers: Column) -> DataFrame:
    """Capture filter: any marker occurs in title or summary; no markers keep all."""
    low = F.lower(F.concat_ws(" ", T.text(F.col("title")), T.text(F.col("summary"))))
    return items.where((F.size(F.coalesce(markers, T.empty_strings())) == 0)
                       | F.exists(markers, lambda m: F.contains(low, F.lower(m))))
