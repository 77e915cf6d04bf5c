"""Keyword rules: which items qualify, and into which section."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, functions as F

from newsledger import fixed_values as fixed
from newsledger.functions import ids, text as T, times
from newsledger.functions.urls import canonical_url
from newsledger.operators.barrier import computed
from newsledger.operators.ordered import first_wins
from newsledger.operators.skew import collect_bounded


@dataclass(frozen=True)
class Topic:
    name: str
    section: str
    keywords: tuple[str, ...]


@dataclass(frozen=True)
class Rules:
    """Topic rules in configuration order; the order breaks ties."""
    model_keywords: tuple[str, ...] = ()
    topics: tuple[Topic, ...] = field(default=())

    @classmethod
    def of(cls, model_keywords, topics) -> "Rules":
        return cls(tuple(model_keywords),
                   tuple(Topic(n, s, tuple(k)) for n, s, k in topics))

    @classmethod
    def default(cls) -> "Rules":
        return cls.of(fixed.DEFAULT_MODEL_KEYWORDS, fixed.DEFAULT_TOPICS)

    @classmethod
    def from_table(cls, rules: DataFrame) -> "Rules":
        """From rows (topic_ord, topic, section, kw_ord, keyword); topic NULL = model."""
        rows = sorted(collect_bounded(rules),
                      key=lambda r: (r["topic_ord"] if r["topic"] else -1, r["kw_ord"]))
        topics: dict[str, tuple[str, list[str]]] = {}
        for row in rows:
            if row["topic"]:
                topics.setdefault(row["topic"], (row["section"], []))[1].append(row["keyword"])
        return cls.of([r["keyword"] for r in rows if not r["topic"]],
                      [(name, section, kws) for name, (section, kws) in topics.items()])

    def with_models(self, extra) -> "Rules":
        """Widen the model keywords, ordered and distinct."""
        return replace(self, model_keywords=tuple(dict.fromkeys([*self.model_keywords, *extra])))

    def only_sections(self, sections) -> "Rules":
        """Narrow to topics of some sections, before any scoring."""
        return replace(self, topics=tuple(t for t in self.topics if t.section in sections))

    def keywords(self, *names: str) -> list[str]:
        return list(dict.fromkeys(
            k for t in self.topics if not names or t.name in names for k in t.keywords))


def cutoff(day: Column, window_days: int | Column) -> Column:
    """Midnight UTC of the day, minus the window."""
    days = F.lit(window_days) if isinstance(window_days, int) else window_days
    return F.to_timestamp(F.date_sub(day, days.cast("int")))


def eligible(items: DataFrame, window_days: int | Column) -> DataFrame:
    """Cheap tests first: a URL, not unchanged, not older than the window."""
    published = times.parse_published(F.col("published"))
    rows = (items.where(F.coalesce(F.col("url"), F.lit("")) != "")
            .where(F.coalesce(F.col("changed"), F.lit(True))))
    return (computed(rows, {"published_at": published})
            .where(F.col("published_at").isNull()
                   | (F.col("published_at") >= cutoff(F.col("day"), window_days))))


def section_column(rules: Rules, tier: Column, hits: dict[str, Column]) -> Column:
    """Section of the topic with most hits; ties go to configuration order."""
    fallback = F.when(tier == "official", fixed.SECTION_RELEASE).otherwise(
        fixed.SECTION_FIELD_TEST)
    if rules.topics:
        best = F.array_max(F.array(*[
            F.struct(F.size(hits[t.name]).alias("n"), F.lit(-i).alias("o"),
                     F.lit(t.section).alias("s")) for i, t in enumerate(rules.topics)]))
        chosen = F.when((best["n"] > 0) & best["s"].isin(fixed.SECTIONS),
                        best["s"]).otherwise(fallback)
    else:
        chosen = fallback
    stays_out = (chosen == fixed.SECTION_FIELD_TEST) & tier.isin("official", "index")
    return F.when(stays_out, fixed.SECTION_RELEASE).otherwise(chosen)


def _narrowed(hits: Column, topic: Topic, allowed: Column | None) -> Column:
    if allowed is None:
        return hits
    return F.when(F.array_contains(allowed, topic.section), hits).otherwise(T.empty_strings())


def with_hits(items: DataFrame, rules: Rules, allowed: Column | None = None) -> DataFrame:
    """Add match_text, model_hits, topic_hits and section.

    ``allowed`` (an array of sections) narrows the topics per row before scoring.
    """
    rows = items.withColumn(
        "match_text", F.concat(T.text(F.col("title")), F.lit(" "), T.text(F.col("summary"))))
    rows = computed(rows, {"match_text": F.col("match_text"),
                           "_folded": T.fold_case(F.col("match_text"))})
    everything = [*rules.model_keywords, *rules.keywords()]
    rows = computed(rows, {"_present": T.words_present(F.col("_folded"), everything)})
    body, folded, present = F.col("match_text"), F.col("_folded"), F.col("_present")
    names = {t.name: f"_t{i}" for i, t in enumerate(rules.topics)}
    rows = computed(rows, {
        "model_hits": T.keyword_hits(body, folded, rules.model_keywords, present),
        **{names[t.name]: _narrowed(T.keyword_hits(body, folded, t.keywords, present), t,
                                allowed)
           for t in rules.topics}})
    hits = {name: F.col(column) for name, column in names.items()}
    merged = F.flatten(F.array(*hits.values())) if hits else T.empty_strings()
    rows = rows.withColumn("topic_hits", F.array_sort(F.array_distinct(merged)))
    return (rows.withColumn("section", section_column(rules, F.col("tier"), hits))
            .drop("_folded", "_present", *names.values()))


def qualified(items: DataFrame, rules: Rules, window_days: int | Column = 3,
              allowed: Column | None = None) -> DataFrame:
    """Eligible items with at least one hit."""
    rows = with_hits(eligible(items, window_days), rules, allowed)
    return rows.where((F.size("model_hits") > 0) | (F.size("topic_hits") > 0))


def with_identity(items: DataFrame) -> DataFrame:
    """Add canonical_url, source_item_id and snapshot_hash."""
    return (computed(items, {"canonical_url": canonical_url(F.col("url"))})
            .withColumn("source_item_id",
                        ids.source_item_id(F.col("source_id"), F.col("canonical_url")))
            .withColumn("snapshot_hash", ids.snapshot_hash(
                F.col("title"), F.col("canonical_url"), F.col("published"),
                F.col("summary"), F.col("content_sha256"))))


def section_ord(section: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in fixed.SECTIONS]), section).cast("int")


def classify(items: DataFrame, rules: Rules, window_days: int | Column = 3,
             first_url_wins: bool = True) -> DataFrame:
    """Sectioned items with their identities.

    Rows without a web URL are left out here; ``rejected_urls`` lists them. The first
    qualifying row of a (day, url) wins; story views keep all rows.
    """
    rows = qualified(items, rules, window_days)
    if first_url_wins:
        rows = first_wins(rows, ["day", "url"], ["payload_ord", "item_ord"])
    labels = F.create_map(*[F.lit(x) for pair in fixed.TIER_LABELS.items() for x in pair])
    rows = with_identity(rows).where(F.col("canonical_url").isNotNull())
    return (rows
            .withColumn("title", F.when(T.strip(T.text(F.col("title"))) != "",
                                        T.strip(F.col("title"))).otherwise(F.col("url")))
            .withColumn("summary", F.substring(T.text(F.col("summary")), 1, 300))
            .withColumn("tier_label", F.coalesce(labels[F.col("tier")], F.col("tier")))
            .withColumn("section_ord", section_ord(F.col("section"))))


def rejected_urls(items: DataFrame, rules: Rules, window_days: int = 3) -> DataFrame:
    """Qualifying rows whose URL is not a web address."""
    return qualified(items, rules, window_days).where(canonical_url(F.col("url")).isNull())


def digest_order(classified: DataFrame) -> list[Column]:
    """Reading order: section, official first, more topic hits first, capture order."""
    return [F.col("section_ord"), F.col("tier") != "official",
            -F.size("topic_hits"), F.col("payload_ord"), F.col("item_ord")]
