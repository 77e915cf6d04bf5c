"""Change detection on pages, prices and index series.

A snapshot table has one row per (snapshot day, key). "Previous" always means the
immediately preceding snapshot of the whole series, so a key that vanished and came
back counts as new.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsledger.functions import similarity, text as T
from newsledger.operators.barrier import computed
from newsledger.operators.ordered import with_lag, with_running_max
from newsledger.session import materialize

# fixed values: title prefixes of page captures
PAGE_PREFIX = {"snapshot": "[页面快照] ", "updated": "[页面有更新] ",
               "unreadable": "[页面不可读] ", "recovered": "[页面恢复可读] "}
UNREADABLE_NOTE = "抓取正文未命中必要内容模式；本条只表示探针盲区，不表示页面内容发生变化。 "


# --- pages --------------------------------------------------------------------
def page_probe(captures: DataFrame) -> DataFrame:
    """Visible text, hashes and readability of landed page bodies."""
    plain = T.collapse_space(T.text(F.col("body")))
    body = F.when(F.col("content_format") == "markdown", plain).otherwise(
        T.visible_text(F.col("body")))
    rows = computed(captures, {"content": body})
    return (rows.withColumn("content_sha256", F.sha2("content", 256))
            .withColumn("response_sha256", F.sha2("body", 256))
            .withColumn("readable", T.all_patterns(F.col("content"), F.col("required_patterns"))))


def page_changes(probes: DataFrame) -> DataFrame:
    """Add changed, kind and published to every capture of a page.

    Comparing with the directly preceding capture equals keeping a state per page: an
    unchanged capture has the same text, or both are unreadable.
    """
    keys, order, bucket = ["source_id"], ["fetched_at"], F.to_date("fetched_at")
    rows = with_lag(probes, keys, bucket, order, ["readable", "content_sha256"])
    was, now = F.col("prev_readable"), F.col("readable")
    changed = (F.when(F.col("is_first"), True).when(~now, was)
               .when(~was, True).otherwise(F.col("prev_content_sha256")
                                           != F.col("content_sha256")))
    kind = (F.when(~now, "unreadable").when(~was, "recovered")
            .when(changed & ~F.col("is_first"), "updated").otherwise("snapshot"))
    rows = rows.withColumn("changed", changed).withColumn("kind", kind)
    rows = with_running_max(rows, keys, bucket, order,
                            F.when(F.col("changed"), F.col("fetched_at")), "published")
    return rows.drop("prev_readable", "prev_content_sha256", "is_first")


def page_items(changes: DataFrame, limit: int = 5000) -> DataFrame:
    """Capture items of pages: prefixed title and a summary around the key passages."""
    prefixes = F.create_map(*[F.lit(x) for pair in PAGE_PREFIX.items() for x in pair])
    note = F.when(F.col("kind") == "unreadable", UNREADABLE_NOTE).otherwise("")
    patterns = F.coalesce(F.col("required_patterns"), T.empty_strings())
    return (changes.withColumn("title", F.concat(prefixes[F.col("kind")], F.col("name")))
            .withColumn("summary", similarity.excerpt(F.concat(note, F.col("content")),
                                                      patterns, limit)))


# --- snapshots ----------------------------------------------------------------
def _with_previous_day(snapshots: DataFrame) -> DataFrame:
    """Every snapshot day with the one before it: a calendar, one short row a day."""
    days = snapshots.select("day").distinct()
    return days.withColumn("prev_day", F.lag("day").over(Window.orderBy("day")))


def _against_previous(snapshots: DataFrame, values: Sequence[str]) -> DataFrame:
    calendar = _with_previous_day(snapshots)
    before = snapshots.select(
        F.col("day").alias("prev_day"), "key", *[F.col(v).alias(f"prev_{v}") for v in values],
        F.lit(True).alias("known"))
    return snapshots.join(calendar, "day").join(before, ["prev_day", "key"], "left")


def snapshot_diff(snapshots: DataFrame, values: Sequence[str]) -> DataFrame:
    """New keys and keys with other values; the first snapshot yields nothing.

    Only ``values`` are compared, other columns are metadata.
    """
    rows = _against_previous(snapshots, values).where(F.col("prev_day").isNotNull())
    same = F.lit(True)
    for value in values:
        same = same & F.col(value).eqNullSafe(F.col(f"prev_{value}"))
    event = F.when(F.col("known").isNull(), "new").when(~same, "changed")
    return computed(rows, {"event": event}).where(F.col("event").isNotNull()).drop("known")


def series_delta(snapshots: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Moves of at least ``threshold`` against the previous snapshot's ``value``."""
    rows = _against_previous(snapshots, ["value"])
    return (rows.where(F.abs(F.col("value") - F.col("prev_value")) >= threshold)
            .withColumn("delta", F.col("value") - F.col("prev_value")).drop("known"))


def retained_counts(keys: DataFrame, pairs: DataFrame) -> DataFrame:
    """For each (day, earlier) of ``pairs``: keys of the earlier snapshot still present."""
    earlier = keys.withColumnRenamed("day", "earlier")
    return (earlier.join(pairs, "earlier").join(keys, ["day", "key"], "left_semi")
            .groupBy("day", "earlier").agg(F.count("*").alias("retained")))


def guarded_snapshots(snapshots: DataFrame, ratio: float = 0.5) -> DataFrame:
    """(day, earlier, keys, ratio, accepted): which snapshots may replace the state.

    A snapshot is compared with the last accepted one, and a collapsed one is rejected. All
    days are compared at once, first with the day before; where that was rejected the
    comparison moves to the last day accepted so far, until no comparison moves. The days
    before the first wrong comparison are right in every round, so the end is what a walk
    over the days in order gives. A whole rejected run moves in one round.
    """
    keys = materialize(snapshots.select("day", "key").distinct())
    sizes = materialize(keys.groupBy("day").agg(F.count("*").alias("keys")))
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    judged = sizes.withColumn("accepted", F.lit(True))
    counted = materialize(retained_counts(keys, sizes.select(
        "day", F.lit(None).cast("date").alias("earlier")).limit(0)))
    mark = None
    while True:
        against = materialize(judged.select("day", "keys", F.last(
            F.when(F.col("accepted"), F.col("day")), True).over(before).alias("earlier")))
        moved = against.agg(F.bit_xor(F.xxhash64("day", F.coalesce(
            "earlier", F.lit("0001-01-01").cast("date")))), F.count("*")).first()
        if moved == mark:
            return judged.select("day", "earlier", "keys", "ratio", "accepted")
        mark = moved
        asked = against.where(F.col("earlier").isNotNull()).select("day", "earlier")
        fresh = asked.join(counted.select("day", "earlier"), ["day", "earlier"], "left_anti")
        found = (fresh.join(retained_counts(keys, fresh), ["day", "earlier"], "left")
                 .withColumn("retained", F.coalesce("retained", F.lit(0))))
        counted = materialize(counted.unionByName(found))
        state = sizes.select(F.col("day").alias("earlier"), F.col("keys").alias("before"))
        share = F.col("retained") / F.col("before")
        judged = materialize(
            against.join(counted, ["day", "earlier"], "left").join(state, "earlier", "left")
            .select("day", "earlier", "keys", share.alias("ratio"),
                    F.coalesce(share >= ratio, F.lit(True)).alias("accepted")))


def first_seen(sightings: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Every key once, as first sighted."""
    from newsledger.operators.ordered import first_wins
    return first_wins(sightings, [key], order)


def best_configuration(points: DataFrame) -> DataFrame:
    """Per snapshot and model: the configuration with the highest value.

    Equal values go to the configuration listed first.
    """
    rest = [c for c in points.columns if c not in ("day", "model")]
    top = F.max_by(F.struct(*rest), F.struct("value", -F.col("ord")))
    return (points.where(F.col("value").isNotNull()).groupBy("day", "model")
            .agg(top.alias("best")).select("day", "model", "best.*"))


def quote_changes(quotes: DataFrame) -> DataFrame:
    """Percent change of each close against the symbol's preceding non-null close; NULL where
    that close is zero."""
    rows = quotes.where(F.col("close").isNotNull())
    rows = with_lag(rows, ["symbol"], F.trunc("ts", "month"), ["ts"], ["close"])
    return rows.withColumn("change_pct", F.try_divide(
        F.col("close") - F.col("prev_close"), F.col("prev_close")) * 100).drop("is_first")


def flat_price_snapshot(models: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """Prices per million of the listed models that match a keyword.

    ``prompt`` and ``completion`` are texts; a row with an unreadable price is skipped.
    """
    name = F.when(T.text(F.col("name")) != "", F.col("name")).otherwise(F.col("id"))
    hay = F.concat(F.lower("id"), F.lit(" "), F.lower(name))

    def per_million(column: str) -> Column:
        value = F.when(T.text(F.col(column)) == "", F.lit("0")).otherwise(F.col(column))
        return F.round(value.try_cast("double") * 1e6, 4)

    rows = models.withColumn("name", name).where(T.contains_any(hay, keywords))
    rows = computed(rows, {"prompt": per_million("prompt"),
                           "completion": per_million("completion")})
    return rows.where(F.col("prompt").isNotNull() & F.col("completion").isNotNull())
