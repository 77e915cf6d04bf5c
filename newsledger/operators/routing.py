"""Which items of an audited source count, and for which partitions.

Audit items carry the item columns plus, from their capture and source: ``source``,
``day``, ``status``, ``routing``, ``track``, ``tier``, ``evidence_role``,
``partitions``, ``lookback_days`` and ``fetched_at``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from newsledger import fixed_values as fixed
from newsledger.functions import text as T, times, urls as U
from newsledger.operators.barrier import computed
from newsledger.operators.classify import Rules, cutoff, qualified
from newsledger.operators.features import expert_route
from newsledger.operators.ordered import first_wins

DURATION_DAYS = 14


def with_defaults(items: DataFrame, origin: str, duration_days: int = DURATION_DAYS) -> DataFrame:
    """Fill what captures may leave out."""
    role = "incumbent" if origin == "incumbent" else "candidate"
    every = F.array(*[F.lit(p) for p in fixed.PARTITIONS])
    given = F.col("partitions")
    return (items.withColumn("origin", F.lit(origin))
            .withColumn("status", F.coalesce("status", F.lit("ok")))
            .withColumn("role", F.coalesce("role", F.lit(role)))
            .withColumn("routing", F.coalesce("routing", F.lit("classify")))
            .withColumn("allowed", F.when(F.size(F.coalesce(given, T.empty_strings())) > 0,
                                          given).otherwise(every))
            .withColumn("lookback_days", F.when(F.col("lookback_days") > 0,
                                                F.col("lookback_days")).otherwise(duration_days)))


def _in_lookback(published: Column) -> Column:
    return published.isNull() | (published >= cutoff(F.col("day"), F.col("lookback_days")))


def eligible_items(items: DataFrame) -> DataFrame:
    """The denominator: the same date and change limits the router applies."""
    routing = F.col("routing")
    rows = computed(items, {"published_at": times.parse_published(F.col("published"))})
    usable = (T.text(F.col("url")) != "") & F.coalesce(F.col("changed"), F.lit(True))
    return rows.where((F.col("status") == "ok") & (
        (routing == "forced")
        | (_in_lookback(F.col("published_at")) & ((routing != "classify") | usable))))


def _is_expert() -> Column:
    return (F.col("routing") == "expert_author") | (F.coalesce(F.col("track"), F.lit(""))
                                                    == "expert_author")


def _expert_rows(rows: DataFrame) -> DataFrame:
    picked = computed(eligible_items(rows.where(_is_expert())),
                      {"_route": expert_route(F.col("expert_features"))})
    allowed = F.col("allowed")
    part = (F.when(F.col("_route.tested") & F.array_contains(allowed, "field_test"), "field_test")
            .when(F.col("_route.deep") & F.array_contains(allowed, "research_synthesis"),
                  "research_synthesis"))
    return computed(picked, {"partition": part}).where(F.col("partition").isNotNull()).drop("_route")


def _forced_rows(rows: DataFrame) -> DataFrame:
    forced = rows.where(~_is_expert() & F.col("routing").isin("forced", "forced_recent"))
    forced = computed(forced, {"published_at": times.parse_published(F.col("published"))})
    return (forced.where((F.col("routing") == "forced") | _in_lookback(F.col("published_at")))
            .withColumn("partition", F.explode("allowed")))


def _classified_rows(rows: DataFrame, rules: Rules, columns: Sequence[str]) -> DataFrame:
    plain = rows.where(~_is_expert() & ~F.col("routing").isin("forced", "forced_recent"))
    names = F.create_map(*[F.lit(x) for p, s in fixed.PARTITION_SECTIONS.items() for x in (p, s)])
    keys = F.create_map(*[F.lit(x) for p, s in fixed.PARTITION_SECTIONS.items() for x in (s, p)])
    plain = plain.withColumn("_sections", F.transform("allowed", lambda p: names[p]))
    found = qualified(plain, rules, F.col("lookback_days"), F.col("_sections"))
    found = found.withColumn("partition", keys[F.col("section")])
    found = (found.withColumn("summary", F.substring(T.text(F.col("summary")), 1, 300))
             .withColumn("title", F.when(T.strip(T.text(F.col("title"))) != "",
                                         T.strip(F.col("title"))).otherwise(F.col("url")))
             .withColumn("readable", F.lit(None).cast("boolean"))
             .withColumn("expert_features", F.lit(None).cast(
                 rows.schema["expert_features"].dataType)))
    # what nobody reads, whole texts above all, does not pass through the aggregate
    found = found.select(*dict.fromkeys(
        [*columns, "partition", "allowed", "source", "day", "url", "item_ord"]))
    found = first_wins(found, ["source", "day", "url"], ["item_ord"])
    return found.where(F.array_contains("allowed", F.col("partition")))


def route_items(items: DataFrame, rules: Rules, columns: Sequence[str] | None = None
                ) -> DataFrame:
    """Add ``partition``: one row per item and partition it counts for. ``columns`` names what to
    keep of an item, else all is kept.

    Author sources route by first-hand evidence or depth; forced sources fill all
    their partitions; all others are classified, with the topics narrowed to the
    allowed sections first.
    """
    rows = items.where(F.col("status") == "ok")
    if "match_text" not in rows.columns:
        rows = rows.withColumn("match_text", F.lit(None).cast("string"))
    columns = [*(rows.columns if columns is None else columns), "partition"]
    return (_expert_rows(rows).select(*columns)
            .unionByName(_forced_rows(rows).select(*columns))
            .unionByName(_classified_rows(rows, rules, columns).select(*columns)))


def audit_item_key(items: DataFrame) -> Column:
    from newsledger.operators.signals import item_key
    return item_key(U.audit_url(F.col("url")), F.col("title"))
