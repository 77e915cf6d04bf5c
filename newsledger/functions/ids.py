"""Stable identities: SHA-256 over canonical text, with byte 0 as separator."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from newsledger.functions.text import empty_strings, text
from newsledger.functions.urls import canonical_url

SEPARATOR = "\x00"


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts joined by byte 0; NULL when a part is NULL."""
    joined = parts[0]
    for part in parts[1:]:
        joined = F.concat(joined, F.lit(SEPARATOR), part)
    return F.sha2(joined, 256)


def short_id(prefix: str, length: int, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), F.substring(digest(*parts), 1, length))


def fallback_source_id(source: Column, name: Column) -> Column:
    """The source id, or one derived from the display name."""
    named = short_id("source-", 12, F.coalesce(name, F.lit("unknown")))
    return F.coalesce(F.when(source != "", source), named)


def source_item_id(source_id: Column, canonical: Column) -> Column:
    item = F.substring(digest(source_id, canonical), 1, 20)
    return F.concat(source_id, F.lit(":"), item)


def snapshot_hash(title: Column, canonical: Column, published: Column, summary: Column,
                  content_sha256: Column) -> Column:
    """Hash of what was captured; the fetch time is left out on purpose.

    ``to_json`` keeps struct order and drops nulls, so fields are declared in
    alphabetical order and missing text becomes empty text.
    """
    return F.sha2(F.to_json(F.struct(
        text(content_sha256).alias("content_sha256"), text(published).alias("published"),
        text(summary).alias("summary"), text(title).alias("title"),
        canonical.alias("url"))), 256)


def collection_item(title: Column, url: Column, published: Column, summary: Column,
                    content_sha256: Column, external_url: Column, links: Column) -> Column:
    """One captured item as canonical JSON, the unit of a collection hash."""
    ordered = F.array_sort(F.array_distinct(F.coalesce(links, empty_strings())))
    return F.to_json(F.struct(
        text(content_sha256).alias("content_sha256"),
        text(external_url).alias("external_url"), text(published).alias("published"),
        text(summary).alias("summary"), text(title).alias("title"),
        canonical_url(url).alias("url"), ordered.alias("x_links")))


def source_of_item(item_id: Column) -> Column:
    """Source part of an item id: everything before the last colon."""
    return F.regexp_replace(item_id, "(?s):[^:]*$", "")


def story_id(url: Column, title: Column) -> Column:
    return short_id("story-", 16, url, title)
