"""Landed feed bodies to items: RSS or Atom, one row per entry, read by Spark's XML parser."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsledger.functions import similarity, text as T, urls as U
from newsledger.operators.barrier import computed

#: Characters of an item's summary that the record format keeps.
SUMMARY_CHARS = 2000

# fixed values: elements of an entry, by feed format; a repeated element is an array
_TEXTS = "array<string>"
RSS_ENTRY = (f"struct<title:{_TEXTS},link:{_TEXTS},pubDate:{_TEXTS},`dc:date`:{_TEXTS},"
             f"description:{_TEXTS},`content:encoded`:{_TEXTS}>")
ATOM_ENTRY = (f"struct<title:{_TEXTS},link:array<struct<_href:string>>,updated:{_TEXTS},"
              f"published:{_TEXTS},summary:{_TEXTS},content:{_TEXTS}>")
#: RSS lists its items in a channel, RDF beside it.
FEED = (f"channel struct<item:array<{RSS_ENTRY}>>, item array<{RSS_ENTRY}>, "
        f"entry array<{ATOM_ENTRY}>, _broken string")
_FIELDS = ["title", "url", "published", "summary", "fulltext"]


def _filled(*values: Column) -> Column:
    """The first text that is not blank, trimmed; empty if there is none."""
    tidy = F.array(*[U.strip(T.text(F.get(value, F.lit(0)))) for value in values])
    return F.coalesce(F.get(F.filter(tidy, lambda t: t != ""), F.lit(0)), F.lit(""))


def _item(title: Column, url: Column, date: Column, bodies: list[Column]) -> Column:
    written = F.filter(F.array(*[_filled(b) for b in bodies]), lambda t: t != "")
    return F.struct(_filled(title).alias("title"), url.alias("url"), date.alias("published"),
                    F.coalesce(F.get(written, F.lit(0)), F.lit("")).alias("summary"),
                    F.array_join(written, " ").alias("fulltext"))


def _rss_item(e: Column) -> Column:
    return _item(e["title"], _filled(e["link"]), _filled(e["pubDate"], e["dc:date"]),
                 [e["description"], e["content:encoded"]])


def _atom_item(e: Column) -> Column:
    """An entry's own link is its first; the date of its update counts before the first one."""
    return _item(e["title"], T.text(F.get(e["link"]["_href"], F.lit(0))),
                 _filled(e["updated"], e["published"]), [e["summary"], e["content"]])


def parse_feeds(bodies: DataFrame) -> DataFrame:
    """Entries of landed bodies (source_id, fetched_at, body); a broken body gives one
    row with ``error``."""
    read = F.from_xml(F.decode("body", "utf-8"), FEED,
                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    rows = bodies.select("source_id", "fetched_at", read.alias("_x"))
    rss = F.coalesce("_x.channel.item", "_x.item")
    items = F.when(F.size(F.coalesce(rss, F.array())) > 0, F.transform(rss, _rss_item)).otherwise(
        F.transform("_x.entry", _atom_item))
    broken = F.col("_x").isNull() | F.col("_x._broken").isNotNull()
    found = rows.where(~broken).select(
        "source_id", "fetched_at", F.posexplode(items).alias("item_ord", "_e"))
    failed = rows.where(broken).select(
        "source_id", "fetched_at", F.lit(-1).alias("item_ord"),
        *[F.lit(None).cast("string").alias(c) for c in _FIELDS],
        F.lit("not well-formed XML").alias("error"))
    return found.select("source_id", "fetched_at", "item_ord", *[f"_e.{c}" for c in _FIELDS],
                        F.lit(None).cast("string").alias("error")).unionByName(failed)


def feed_items(entries: DataFrame, summary_chars: int = SUMMARY_CHARS) -> DataFrame:
    """Capture items: links are mined from the full text before tags go."""
    full = F.when(F.col("fulltext") != "", F.col("fulltext")).otherwise(F.col("summary"))
    rows = entries.where(F.col("error").isNull()).withColumn("_full", full)
    rows = rows.withColumn("external_urls", similarity.extract_links(F.col("_full"), F.col("url")))
    rows = computed(rows, {
        "x_links": U.status_links(F.col("_full")), "fulltext": T.strip_tags(F.col("_full")),
        "summary": F.substring(T.strip_tags(F.col("summary")), 1, summary_chars)})
    return rows.drop("_full", "error")
