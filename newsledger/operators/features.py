"""Item features and quality flags used to score candidate sources."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from newsledger import fixed_values as fixed
from newsledger.functions import text as T, urls as U
from newsledger.operators.barrier import computed

EXPERT_METHODS = list(dict.fromkeys(fixed.METHOD_MARKERS + fixed.EXPERT_EXTRA_METHOD_MARKERS))


@dataclass(frozen=True)
class Markers:
    """Configured word lists of a community audit."""
    groups: Mapping[str, Iterable[str]] = field(
        default_factory=lambda: fixed.COMMUNITY_MARKER_GROUPS)
    noise: Iterable[str] = field(default_factory=lambda: fixed.COMMUNITY_NOISE_MARKERS)
    domains: Iterable[str] = field(default_factory=lambda: fixed.DIRECT_EVIDENCE_DOMAINS)


def link_host(url: Column) -> Column:
    """Host of an already normalised link."""
    return F.regexp_extract(url, "^https://([^/?#:]*)", 1)


def spaced(*values: Column) -> Column:
    return F.concat_ws(" ", *[T.text(v) for v in values])


def outside_links() -> Column:
    return F.array_join("external_urls", " ")


def direct_links(items: DataFrame, domains: Iterable[str]) -> DataFrame:
    """Add ``direct_urls``: links to configured domains that are not social sites."""
    domains = list(domains)

    def direct(url: Column) -> Column:
        return U.once(link_host(url), lambda host: (
            ~host.isin(fixed.SOCIAL_HOSTS) & ~host.endswith(".reddit.com")
            & U.host_matches(host, domains)))

    rows = computed(items, {"_links": U.extract_match_urls(
        F.col("summary"), F.col("external_url"), outside_links())})
    return rows.withColumn("direct_urls", F.filter("_links", direct)).drop("_links")


def community_features(items: DataFrame, markers: Markers = Markers()) -> DataFrame:
    """Add direct_urls, marker_groups and the four proxies."""
    rows = direct_links(items, markers.domains)
    body = F.concat(T.text(F.col("title")), F.lit(" "), U.unescape_html(T.text(F.col("summary"))))
    rows = computed(computed(rows, {"_body": body}), {"_low": F.lower("_body")})
    rows = computed(rows, {
        "marker_groups": T.marker_groups(F.col("_low"), markers.groups),
        "noise_proxy": T.contains_any(F.col("_low"), markers.noise),
        "direct_evidence": F.size("direct_urls") > 0,
        "_concrete": F.col("_body").rlike(fixed.QUANTITY_PATTERN)})
    technical = ((F.size("marker_groups") >= 2)
                 | (F.col("direct_evidence") & (F.size("marker_groups") >= 1)))
    return (rows.withColumn("technical_proxy", technical)
            .withColumn("evidence_proxy", F.col("direct_evidence")
                        | (F.col("_concrete") & F.col("technical_proxy")))
            .drop("_body", "_low", "_concrete"))


def expert_features(items: DataFrame, author: Column | None = None) -> DataFrame:
    """Replace the full text of author feeds by features computed from it.

    Reads ``fulltext`` and ``conflict_words`` (the source's configured words); the
    text itself does not leave this operator. Where ``author`` is given, other rows have no
    features, and their texts are not read for any.
    """
    body = U.unescape_html(spaced(F.col("title"), F.col("summary"), F.col("fulltext")))
    items = items if author is None else items.withColumn("_author", F.coalesce(author, F.lit(False)))
    if author is not None:
        body = F.when(F.col("_author"), body)
    rows = computed(computed(items, {"_body": body}), {
        "_low": F.lower("_body"),
        "_links": U.extract_audit_urls(F.col("url"), outside_links())})
    low = F.col("_low")
    words = F.array_sort(F.array_distinct(F.coalesce(F.col("conflict_words"), T.empty_strings())))
    features = F.struct(
        T.marker_groups(low, fixed.EXPERT_TECH_GROUPS).alias("technical_groups"),
        T.matched_markers(low, EXPERT_METHODS).alias("method_hits"),
        T.matched_markers(low, fixed.EXPERT_FIRSTHAND_MARKERS).alias("firsthand_hits"),
        T.matched_markers(low, fixed.EXPERT_SYNTHESIS_MARKERS).alias("synthesis_hits"),
        F.filter("_links", U.names_artifact).alias("artifact_urls"),
        F.filter(words, lambda w: F.contains(low, F.lower(w))).alias("conflict_keywords"),
        (T.text(F.col("fulltext")) != "").alias("fulltext_used"),
        F.length(T.text(F.col("fulltext"))).alias("fulltext_chars"),
        F.sha2("_body", 256).alias("content_hash"))
    features = features if author is None else F.when(F.col("_author"), features)
    return computed(rows, {"expert_features": features}).drop(
        "_body", "_low", "_links", "_author", "fulltext", "conflict_words")


def _many(expert: Column, name: str) -> Column:
    return F.coalesce(F.when(expert.isNotNull(), F.size(expert[name])), F.lit(0))


def expert_route(expert: Column) -> Column:
    """field_test for first-hand work with method, research_synthesis for depth."""
    methods, artifacts = _many(expert, "method_hits"), _many(expert, "artifact_urls")
    groups = _many(expert, "technical_groups")
    tested = (_many(expert, "firsthand_hits") > 0) & (
        (methods >= 2) | ((methods >= 1) & (artifacts >= 1)))
    deep = (groups >= 2) | ((_many(expert, "conflict_keywords") > 0) & (groups >= 1))
    return F.struct(tested.alias("tested"), deep.alias("deep"))


def item_quality(items: DataFrame) -> DataFrame:
    """Add primary, quality, noise and conflict flags of an item in its ``partition``."""
    body = U.unescape_html(spaced(F.col("title"), F.col("summary"), F.col("match_text")))
    rows = computed(computed(items, {"_body": body}), {"_low": F.lower("_body")})
    pool = (F.col("_body"), F.col("url"), F.col("external_url"), outside_links())
    rows = computed(rows, {
        "_hosts": F.transform(U.extract_audit_urls(*pool), link_host),
        "_own": link_host(U.audit_url(F.col("url")))})
    low, tier, expert = F.col("_low"), F.col("tier"), F.col("expert_features")
    has = {name: T.contains_any(low, words) for name, words in {
        "noise": fixed.NOISE_MARKERS, "release": fixed.RELEASE_MARKERS,
        "price": fixed.PRICE_MARKERS, "diagnostic": fixed.DIAGNOSTIC_MARKERS,
        "corporate": fixed.CORPORATE_MARKERS, "tech": fixed.TECH_MARKERS}.items()}
    methods = sum((low.contains(m).cast("int") for m in fixed.METHOD_MARKERS), F.lit(0))
    rows = computed(rows, {
        **{f"_{name}": column for name, column in has.items()}, "_methods": methods,
        "_artifact": F.arrays_overlap("_hosts", F.array(*map(F.lit, fixed.ARTIFACT_HOSTS))),
        "_currency": F.col("_body").rlike(fixed.CURRENCY_PATTERN),
        "_duration": F.col("_body").rlike(fixed.DURATION_PATTERN)})
    c = {name: F.col(f"_{name}") for name in
         [*has, "methods", "artifact", "currency", "duration", "own"]}

    unreadable = F.coalesce(~F.col("readable"), F.lit(False))
    trusted = tier.isin("official", "finance", "radar")
    is_expert = expert.isNotNull()
    groups = _many(expert, "technical_groups")
    conflict = _many(expert, "conflict_keywords") > 0
    conflicted = conflict & (groups >= 1)
    tested = F.when(is_expert, expert_route(expert)["tested"]).otherwise(
        (c["methods"] >= 2) | ((c["methods"] >= 1) & c["artifact"]))
    chars = F.coalesce(F.when(is_expert, expert["fulltext_chars"]), F.lit(0))
    reviewed = ((groups >= 2) | conflicted) & (
        conflicted | (_many(expert, "synthesis_hits") > 0)
        | (_many(expert, "artifact_urls") > 0) | (chars >= 300))
    original = (c["own"].isin(fixed.ARTIFACT_HOSTS) | (tier == "radar")
                | F.col("evidence_role").isin("original_author", "independent_test"))
    where = F.col("partition")
    quality = (F.when(where == "release", c["artifact"] | c["release"])
               .when(where == "field_test", tested)
               .when(where == "research_synthesis", reviewed)
               .when(where == "pricing", c["currency"] & c["price"])
               .when(where == "degradation", c["diagnostic"] & (trusted | c["duration"]))
               .otherwise(c["corporate"] | (tier == "finance")))
    noisy = (c["noise"] & ~trusted) | unreadable
    noise = (F.when(where == "release", noisy
                    | T.text(F.col("title")).startswith(fixed.UNREADABLE_PREFIX))
             .when(where == "research_synthesis", noisy | (groups < 2))
             .when(where.isin("field_test", "pricing", "degradation"), noisy)
             .otherwise(noisy | (c["tech"] & ~c["corporate"] & ~tier.isin("official", "finance"))))
    primary = (F.when(where == "field_test", tested & original)
               .when(where == "research_synthesis", F.lit(False)).otherwise(trusted))
    rows = computed(rows, {
        "primary": F.coalesce(primary, F.lit(False)),
        "quality": F.coalesce(quality & ~unreadable, F.lit(False)),
        "noise": F.coalesce(noise, F.lit(False)), "conflict": conflict})
    return rows.drop(*[x for x in rows.columns if x.startswith("_")])
