"""Claims and evidence: matching, selection, validation and deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsledger import fixed_values as fixed
from newsledger.functions import text as T, urls as U
from newsledger.operators.barrier import computed
from newsledger.operators.classify import Rules
from newsledger.operators.ordered import (first_wins, top_per_group, with_ranged_sum,
                                          with_running_sum)
from newsledger.operators.skew import broadcast_if_small, small_enough
from newsledger.session import materialize


def active_claims(claims: DataFrame) -> DataFrame:
    return claims.where(F.coalesce("status", F.lit("open")) != "resolved")


# --- keyword sightings -----------------------------------------------------------
def _anchor(keyword: Column) -> Column:
    """A token or character every text with the keyword must contain on its own."""
    word = F.regexp_extract(F.lower(keyword), "[0-9a-z_]+", 0)
    odd = F.regexp_extract(F.lower(keyword), r"[^0-9a-z_\s]", 0)
    ascii_only = ~keyword.rlike(r"[^\x00-\x7f]")
    return F.when(ascii_only & (word != ""), word).otherwise(odd)


#: Anchors that are searched for one by one; more are met by cutting texts into tokens.
SEARCHED_ANCHORS = 100


def _anchors_present(folded: Column, low: Column, anchors: list[str]) -> Column:
    """Which anchors are tokens of a text, without cutting it into tokens."""
    words = [a for a in anchors if a.isascii() and a.replace("_", "a").isalnum()]
    odd = [F.when(low.contains(a), F.lit(a)) for a in anchors if a and a not in words]
    found = T.words_present(folded, words)
    return F.concat(found, F.array_compact(F.array(*odd))) if odd else found


def keyword_sightings(items: DataFrame, key: str, keywords: DataFrame) -> DataFrame:
    """(key, keyword) for every keyword that occurs in an item's ``match_text``.

    An inverted join: texts meet keywords on an anchor token, then the keyword rule is
    checked on the few candidates. The work grows with the hits, not with items times
    keywords.
    """
    words = keywords.select("keyword").distinct().withColumn("anchor", _anchor(F.col("keyword")))
    body = F.col("match_text")
    tokens = F.array_distinct(F.concat(
        F.regexp_extract_all(T.fold_case(body), F.lit("[0-9a-z_]+"), 0),
        F.regexp_extract_all(F.lower(body), F.lit(r"[^0-9A-Za-z_\s]"), 0)))
    if small_enough(words, 5000):
        anchors = sorted({r["anchor"] for r in words.select("anchor").collect()})
        if not anchors:
            return items.select(key, F.lit("").alias("keyword")).limit(0)
        if len(anchors) <= SEARCHED_ANCHORS:
            items = computed(items.select(key, "match_text"), {
                "match_text": body, "_folded": T.fold_case(body), "_low": F.lower(body)})
            tokens = _anchors_present(F.col("_folded"), F.col("_low"), anchors)
        else:
            tokens = F.array_intersect(tokens, F.array(*[F.lit(a) for a in anchors]))
    rows = items.select(key, "match_text", F.explode(tokens).alias("anchor"))
    rows = rows.join(broadcast_if_small(words, 5000), "anchor")
    flank = F.concat(F.lit(r"(?iu)(?<![0-9A-Za-z_])\Q"), "keyword", F.lit(r"\E(?![0-9A-Za-z_])"))
    plain = F.col("keyword").rlike(r"[^\x00-\x7f]")
    # a keyword of word characters is its own anchor: a token that met it is a sighting
    found = (F.when(plain, F.contains(F.lower(body), F.lower("keyword")))
             .when(F.col("keyword").rlike("^[0-9A-Za-z_]+$"), True)
             .otherwise(F.regexp_like(body, flank)))
    return rows.where(found).select(key, "keyword").distinct()


def _split(axis: str, hits: Column) -> Column:
    return F.transform(hits, lambda k: F.struct(F.lit(axis).alias("axis"), k.alias("keyword")))


def claim_keywords(claims: DataFrame, rules: Rules) -> DataFrame:
    """(claim_id, axis, keyword): watch words, else entity and concept words it names."""
    body = F.concat(T.text(F.col("claim")), F.lit(" "), T.text(F.col("watch")))
    rows = computed(claims, {"_body": body, "_folded": T.fold_case(body)})
    entity = list(dict.fromkeys([*rules.model_keywords, *rules.keywords("company")]))
    others = [t.name for t in rules.topics if t.name != "company"]
    concept = rules.keywords(*others) if others else []
    found = F.concat(
        _split("entity", T.keyword_hits(F.col("_body"), F.col("_folded"), entity)),
        _split("concept", T.keyword_hits(F.col("_body"), F.col("_folded"), concept)))
    explicit = F.size(F.coalesce("watch_keywords", T.empty_strings())) > 0
    words = F.when(explicit, _split("explicit", F.col("watch_keywords"))).otherwise(found)
    return (rows.select(F.col("id").alias("claim_id"), F.explode(words).alias("_w"))
            .select("claim_id", "_w.*").distinct())


def loose_claim_keywords(claims: DataFrame, rules: Rules) -> DataFrame:
    """(claim_id, keyword) for the digest: probe words that are substrings of the claim."""
    probes = list(dict.fromkeys([*rules.model_keywords, *rules.keywords("company"),
                                 *rules.keywords("degradation"), *rules.keywords("pricing")]))
    low = F.lower("claim")
    hits = F.array_compact(F.array(*[F.when(low.contains(p.lower()), F.lit(p)) for p in probes]))
    explicit = F.size(F.coalesce("watch_keywords", T.empty_strings())) > 0
    words = F.when(explicit, F.col("watch_keywords")).otherwise(hits)
    return claims.select(F.col("id").alias("claim_id"), F.explode(words).alias("keyword")).distinct()


def claim_matches(keywords: DataFrame, sightings: DataFrame, key: str) -> DataFrame:
    """Per claim and item: ``lane`` strict, or broad for an entity hit alone.

    Strict means a watch word; or, without watch words, an entity and a concept where
    the claim has both, else either.
    """
    axes = keywords.groupBy("claim_id").agg(
        *[F.max((F.col("axis") == a).cast("int")).alias(f"has_{a}")
          for a in ("explicit", "entity", "concept")])
    hits = (sightings.join(broadcast_if_small(keywords), "keyword")
            .groupBy("claim_id", key).agg(
                *[F.max((F.col("axis") == a).cast("int")).alias(a)
                  for a in ("explicit", "entity", "concept")]))
    rows = hits.join(broadcast_if_small(axes), "claim_id")
    both = (F.col("has_entity") == 1) & (F.col("has_concept") == 1)
    strict = (F.when(F.col("has_explicit") == 1, F.col("explicit") == 1)
              .when(both, (F.col("entity") == 1) & (F.col("concept") == 1))
              .otherwise((F.col("entity") == 1) | (F.col("concept") == 1)))
    broad = (F.col("has_explicit") == 0) & (F.col("entity") == 1)
    return (rows.withColumn("lane", F.when(strict, "strict").when(broad, "broad"))
            .where(F.col("lane").isNotNull()).select("claim_id", key, "lane"))


def broad_candidates(matches: DataFrame) -> DataFrame:
    """Broad hits of claims without any strict match."""
    strict = matches.where(F.col("lane") == "strict").select("claim_id").distinct()
    return matches.where(F.col("lane") == "broad").join(strict, "claim_id", "left_anti")


def broad_samples(matches: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """Per claim without strict match: its number of broad hits and the first, by capture order."""
    rows = broad_candidates(matches).join(items, key)
    return rows.groupBy("claim_id").agg(
        F.count("*").alias("total"),
        F.min_by(F.struct(key, "title"), F.struct("payload_ord", "item_ord")).alias("_first")
    ).select("claim_id", "total", "_first.*")


# --- evidence --------------------------------------------------------------------
def select_evidence(evidence: DataFrame, target_day: Column, limit: int = 8) -> DataFrame:
    """Up to ``limit`` anchors per claim, in lanes.

    Newest row of the day; newest reversal; then every stance, every type, the other
    rows of the day, the rest; newest first in each lane.
    """
    newest = F.struct(F.coalesce("date", F.lit("0001-01-01").cast("date")), "ev_ord")
    today = F.col("date") == target_day
    marked = F.lit(False)
    for marker in fixed.REVERSAL_MARKERS:
        marked = marked | F.coalesce(F.col("verdict").contains(marker), F.lit(False))
    reversal = F.coalesce(F.col("stance").isin("counter", "confounder"), F.lit(False)) | marked
    heads = evidence.groupBy("claim_id").agg(
        F.max(F.when(today, newest)).alias("_today"),
        F.max(F.when(reversal, newest)).alias("_reversal"))
    rows = evidence.join(heads, "claim_id")
    lane = F.when(newest == F.col("_today"), 1).when(newest == F.col("_reversal"), 2)
    for i, stance in enumerate(fixed.EVIDENCE_STANCES):
        lane = lane.when(F.col("stance") == stance, 3 + i)
    for i, kind in enumerate(fixed.SOURCE_TYPES):
        lane = lane.when(F.col("type") == kind, 7 + i)
    rows = rows.withColumn("lane", lane.when(today, 13).otherwise(14))
    return top_per_group(rows, ["claim_id"],
                         [F.col("lane"), F.col("date").desc_nulls_last(), F.col("ev_ord").desc()],
                         limit).drop("_today", "_reversal")


def stance_counts(evidence: DataFrame) -> DataFrame:
    stance = F.coalesce("stance", F.lit("legacy-unspecified"))
    return (evidence.withColumn("stance", stance).groupBy("claim_id")
            .pivot("stance", [*fixed.EVIDENCE_STANCES, "legacy-unspecified"])
            .agg(F.count(F.lit(1))).fillna(0))


def type_counts(evidence: DataFrame) -> DataFrame:
    return evidence.groupBy("claim_id", F.coalesce("type", F.lit("unknown")).alias("type")).agg(
        F.count("*").alias("records"))


def dossier_rows(claims: DataFrame, evidence: DataFrame) -> DataFrame:
    """Evidence per unguarded claim in dossier order, with a clickable link if any."""
    open_ = claims.where(F.col("ledger_ref").isNull()).select(F.col("id").alias("claim_id"))
    kinds = F.array(*[F.lit(t) for t in fixed.SOURCE_TYPES])
    place = F.array_position(kinds, F.col("type"))
    return (evidence.join(open_, "claim_id", "left_semi")
            .withColumn("linked", U.linkify(F.col("link")))
            .withColumn("type_place", F.when(place == 0, 99).otherwise(place).cast("int")))


def context_rows(matches: DataFrame, items: DataFrame, key: str, top: int = 3) -> DataFrame:
    """The first ``top`` strict signals per claim with the total, by capture order."""
    strict = matches.where(F.col("lane") == "strict").select("claim_id", key)
    totals = strict.groupBy("claim_id").agg(F.count("*").alias("signals"))
    rows = strict.join(items, key)
    return (top_per_group(rows, ["claim_id"], [F.col("payload_ord"), F.col("item_ord")], top)
            .join(totals, "claim_id"))


def pack_to_budget(rows: DataFrame, order: list[str], bucket: Column, budget: int) -> DataFrame:
    """Mark the rows that fit: running JSON size within ``budget`` bytes, in order."""
    size = F.octet_length(F.to_json(F.struct(*rows.columns))) + 1
    sized = materialize(rows.withColumn("bytes", size))
    summed = with_running_sum(sized, bucket, order, F.col("bytes"), "upto")
    return summed.withColumn("kept", F.col("upto") <= budget)


#: Kinds of context rows in the order in which a budget takes them away; the three kinds that
#: make up a claim's details go together in one phase.
TRIM_PHASES = {"broad": 1, "collection": 2, "signal": 3, "evidence": 3, "claim": 3}


def trim_to_budget(parts: DataFrame, budget: int, spent: int = 0) -> DataFrame:
    """Mark with ``kept`` what remains of a context when it is trimmed to ``budget`` bytes.

    ``parts`` has kind, claim_id, place, total and bytes: one row per broad candidate and
    collection, and per claim with details one row ``claim`` and one per signal and evidence,
    whose ``place`` counts from 1 in each claim and kind; ``total`` is the claim's number of
    signals before any limit. ``spent`` bytes are never trimmed.

    One part at a time goes until the rest fits: broad candidates from the end of their order
    (total descending, claim), then collections by ``place`` from the end, then details of the
    claim that has most signals left, then most evidence, then the largest total, then the first
    id: its last signal while it has several, then its last evidence while it has several, then
    the claim as a whole. A claim's standing falls with each loss, so the order in which the
    parts of all claims go is one sort by the standing at which each part goes, and what has gone
    is a running sum along it.
    """
    if spent > budget:
        raise ValueError(f"the directory alone takes {spent} of {budget} bytes")
    kind, place, total = F.col("kind"), F.col("place").cast("long"), F.col("total").cast("long")
    parts = materialize(parts.withColumn("claim_id", F.coalesce("claim_id", F.lit(""))))
    held = (parts.where(kind.isin("signal", "evidence")).groupBy("claim_id").agg(
        F.count_if(kind == "signal").alias("_s"), F.count_if(kind == "evidence").alias("_e")))
    last_signal, last_evidence = F.least("_s", F.lit(1)), F.least("_e", F.lit(1))
    signals = F.when((kind == "signal") & (place > 1), place).otherwise(last_signal)
    left = (F.when((kind == "signal") & (place > 1), F.col("_e"))
            .when((kind == "evidence") & (place > 1), place).otherwise(last_evidence))
    zero, phase = F.lit(0).cast("long"), F.lit(None).cast("int")
    for name, number in TRIM_PHASES.items():
        phase = F.when(kind == name, number).otherwise(phase)
    details = F.col("_phase") == 3
    rows = (parts.join(held, "claim_id", "left").fillna(0, ["_s", "_e"])
            .withColumn("_phase", phase)
            .withColumn("_a", F.when(details, signals).when(F.col("_phase") == 1, -total)
                        .otherwise(place))
            .withColumn("_b", F.when(details, left).otherwise(zero))
            .withColumn("_c", F.when(details, total).otherwise(zero))
            .withColumn("_down", F.when(F.col("_phase") == 1, F.col("claim_id")).otherwise(""))
            .withColumn("_up", F.when(details, F.col("claim_id")).otherwise("")))
    rows = materialize(rows.drop("_s", "_e"))
    step = ["_phase", "_a", "_b", "_c", "_down", "_up"]
    steps = rows.groupBy(*step).agg(F.sum("bytes").alias("_bytes"))
    order = [F.asc("_phase"), F.desc("_a"), F.desc("_b"), F.desc("_c"), F.desc("_down"),
             F.asc("_up")]
    excess = (rows.agg(F.sum("bytes").alias("n")).first()["n"] or 0) + spent - budget
    gone = (with_ranged_sum(steps, order, F.col("_bytes"), "_upto")
            .where(F.col("_upto") - F.col("_bytes") < F.lit(excess))
            .select(*step, F.lit(True).alias("_gone")))
    return (rows.join(gone, step, "left").withColumn("kept", F.col("_gone").isNull())
            .drop(*step, "_gone"))



# --- validation ------------------------------------------------------------------
def _errors(tests: list[tuple[str, Column]]) -> Column:
    return F.array_compact(F.array(*[
        F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in tests]))


def _text_errors(name: str, limit: int, required: bool = True) -> list[tuple[str, Column]]:
    value = U.strip(T.text(F.col(name)))
    tests = [(f"{name}: control character", value.rlike(r"[\x00-\x08\x0b-\x1f]")),
             (f"{name}: longer than {limit}", F.length(value) > limit)]
    return ([(f"{name}: empty", value == "")] if required else []) + tests


def _capture_errors() -> list[tuple[str, Column]]:
    return [("source_item_id: malformed",
             ~U.strip(T.text(F.col("source_item_id"))).rlike(fixed.SOURCE_ITEM_ID_PATTERN)),
            ("snapshot_hash: malformed",
             ~F.lower(U.strip(T.text(F.col("snapshot_hash")))).rlike(fixed.SNAPSHOT_HASH_PATTERN))]


def record_errors(records: DataFrame) -> DataFrame:
    """Add ``errors`` to inbox rows; callers split valid rows from quarantine."""
    matched = U.strip(T.text(F.col("matched_claim")))
    candidate = U.strip(T.text(F.col("candidate_key")))
    tests = [
        ("date: not a day", F.col("date").isNull()),
        ("source_type: unknown", ~F.col("source_type").isin(fixed.SOURCE_TYPES)),
        ("action: unknown", ~F.col("action").isin(fixed.INBOX_ACTIONS)),
        *_text_errors("matched_claim", 100, False), *_text_errors("candidate_key", 80, False),
        ("target: both given", (matched != "") & (candidate != "")),
        ("target: candidate missing",
         (F.col("action") == "claim_candidate") & (candidate == "")),
        ("candidate_key: malformed",
         (candidate != "") & ~candidate.rlike(fixed.CANDIDATE_KEY_PATTERN)),
        ("target: none given",
         (F.col("action") == "watch_signal") & (matched == "") & (candidate == "")),
        *_capture_errors(), ("url: not a web address", U.canonical_url(F.col("url")).isNull()),
        *_text_errors("title", 300), *_text_errors("why_it_matters", 1000),
        *_text_errors("main_alternative", 1000), *_text_errors("next_check", 1000)]
    return computed(records, {"errors": _errors(tests)})


def addition_errors(additions: DataFrame) -> DataFrame:
    """Add ``errors`` to proposed evidence."""
    tests = [
        *_text_errors("claim_id", 100), *_text_errors("src", 300), *_text_errors("verdict", 3000),
        ("type: unknown", ~F.col("type").isin(fixed.SOURCE_TYPES)),
        ("stance: unknown", ~F.col("stance").isin(fixed.EVIDENCE_STANCES)),
        *_capture_errors(), ("date: not a day", F.col("date").isNull()),
        ("link: not a web address", U.canonical_url(F.col("link")).isNull())]
    return computed(additions, {"errors": _errors(tests)})


def claim_violations(claims: DataFrame, evidence: DataFrame) -> DataFrame:
    """(claim_id, rule, detail) for every broken rule of the claim file."""
    linked = (evidence.where(U.linkify(F.col("link")).isNotNull())
              .select(F.col("claim_id").alias("id")).distinct())
    unsourced = (claims.where(F.col("status").isin(fixed.COMMITTED_STATUSES))
                 .join(linked, "id", "left_anti")
                 .select("id", F.lit("committed without source").alias("rule"),
                         F.col("status").alias("detail")))
    guarded = claims.where(F.col("ledger_ref").isNotNull())
    lines = F.coalesce("career_implication", T.empty_strings())
    bare = guarded.where(F.size(lines) == 0).select(
        "id", F.lit("implication missing").alias("rule"), F.lit("").alias("detail"))
    tag = U.strip(F.element_at(F.split(F.col("line"), "[：:]", 2), 1))
    wrong = (guarded.select("id", F.explode(lines).alias("line"))
             .where(~tag.isin(fixed.IMPLICATION_TAGS))
             .select("id", F.lit("implication tag").alias("rule"),
                     F.substring("line", 1, 30).alias("detail")))
    body = F.concat(F.array_join(lines, " "), F.lit(" "), T.text(F.col("watch")))
    spoken = F.regexp_replace(body, fixed.QUOTED_SPAN_PATTERN, "\x01")
    words = F.array_compact(F.array(*[F.when(spoken.contains(w), F.lit(w))
                                      for w in fixed.HARD_GATE_WORDS]))
    gates = (claims.where(F.col("status") == "open")
             .select("id", F.explode(words).alias("detail"))
             .select("id", F.lit("hard gate on open claim").alias("rule"), "detail"))
    return (unsourced.unionByName(bare).unionByName(wrong).unionByName(gates)
            .unionByName(_identity_violations(evidence)).withColumnRenamed("id", "claim_id"))


def _identity_violations(evidence: DataFrame) -> DataFrame:
    fields = ["stance", "source_item_id", "snapshot_hash"]
    given = sum((F.col(f).isNotNull().cast("int") for f in fields), F.lit(0))
    complete = given == 3
    tests = [
        ("new row without identity", (given == 0) & (
            F.col("date") >= F.lit(fixed.CAPTURE_SCHEMA_START).cast("date"))),
        ("identity incomplete", (given > 0) & (given < 3)),
        ("stance unknown", complete & ~F.col("stance").isin(fixed.EVIDENCE_STANCES)),
        ("snapshot_hash malformed",
         complete & ~F.col("snapshot_hash").rlike(fixed.SNAPSHOT_HASH_PATTERN)),
        ("source_item_id malformed",
         complete & ~F.col("source_item_id").rlike(fixed.SOURCE_ITEM_ID_PATTERN)),
        ("link not clickable", complete & ~T.text(F.col("link")).rlike("^https?://"))]
    found = F.array_compact(F.array(*[
        F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in tests]))
    return (evidence.select(F.col("claim_id").alias("id"), "ev_ord", F.explode(found).alias("rule"))
            .select("id", "rule", F.concat(F.lit("evidence "), "ev_ord").alias("detail")))


# --- capture bindings ------------------------------------------------------------
def binding_check(records: DataFrame, items: DataFrame, collections: DataFrame,
                  audit_urls: DataFrame, url: str = "url") -> DataFrame:
    """Add ``binding``: ok, or why the asserted capture cannot be confirmed.

    ``items`` has day, source_item_id, snapshot_hash and canonical_url; ``collections``
    the same identity and source_id; ``audit_urls`` source_id and audit_url.
    """
    on = ["date", "source_item_id", "snapshot_hash"]
    captured = items.select(F.col("day").alias("date"), "source_item_id", "snapshot_hash",
                            F.col("canonical_url").alias("item_url")).distinct()
    whole = collections.select(F.col("day").alias("date"), "source_item_id", "snapshot_hash",
                               F.col("source_id").alias("collection")).distinct()
    allowed = audit_urls.select(F.col("source_id").alias("collection"),
                                U.canonical_url(F.col("audit_url")).alias("_url"),
                                F.lit(True).alias("allowed")).distinct()
    named = audit_urls.select(F.col("source_id").alias("collection"),
                              F.lit(True).alias("configured")).distinct()
    rows = computed(records, {"_url": U.canonical_url(F.col(url))})
    rows = (rows.join(captured, on, "left").join(whole, on, "left")
            .join(named, "collection", "left").join(allowed, ["collection", "_url"], "left"))
    verdict = (F.when(F.col("item_url").isNull() & F.col("collection").isNull(), "not captured")
               .when(F.col("item_url").isNotNull() & ~F.col("item_url").eqNullSafe(F.col("_url")),
                     "url differs from item")
               .when(F.col("collection").isNotNull() & F.col("configured").isNull(),
                     "no audit url configured")
               .when(F.col("collection").isNotNull() & F.col("allowed").isNull(),
                     "url is no audit url").otherwise("ok"))
    return rows.withColumn("binding", verdict).drop(
        "_url", "item_url", "collection", "allowed", "configured")


# --- deduplication ---------------------------------------------------------------
def observation_identity(records: DataFrame) -> DataFrame:
    """Add ``identity`` and the short ``id`` of inbox rows; wording does not count."""
    parts = [F.col("action"), F.col("candidate_key"), F.col("matched_claim"),
             F.col("snapshot_hash"), F.col("source_item_id"), U.canonical_url(F.col("url"))]
    names = ["action", "candidate_key", "matched_claim", "snapshot_hash", "source_item_id", "url"]
    body = F.to_json(F.struct(*[p.alias(n) for p, n in zip(parts, names)]),
                     {"ignoreNullFields": "false"})
    rows = computed(records, {"identity": F.sha2(body, 256)})
    return rows.withColumn("id", F.substring("identity", 1, 20))


def inbox_additions(records: DataFrame, existing: DataFrame) -> DataFrame:
    """New rows only: unknown to the inbox, the first of its kind in the batch."""
    fresh = observation_identity(records).join(
        observation_identity(existing).select("identity"), "identity", "left_anti")
    return first_wins(fresh, ["identity"], ["batch_ord"])


def evidence_identities(rows: DataFrame) -> DataFrame:
    """Add the capture identity (NULL without one) and the wording identity."""
    item, shot = U.strip(T.text(F.col("source_item_id"))), F.lower(
        U.strip(T.text(F.col("snapshot_hash"))))
    captured = F.when((item != "") & shot.rlike(fixed.SNAPSHOT_HASH_PATTERN), F.sha2(F.to_json(
        F.struct(shot.alias("snapshot_hash"), item.alias("source_item_id"))), 256))
    words = F.sha2(F.to_json(F.struct(
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        U.canonical_url(F.col("link")).alias("link"), U.strip(T.text(F.col("src"))).alias("src"),
        U.strip(T.text(F.col("type"))).alias("type"),
        U.strip(T.text(F.col("verdict"))).alias("verdict"))), 256)
    return computed(rows, {"by_capture": captured, "by_words": words})


def evidence_additions(additions: DataFrame, evidence: DataFrame, claims: DataFrame) -> DataFrame:
    """Add ``outcome`` to proposed evidence: added, duplicate, or a rejection.

    ``evidence`` holds the rows that exist, or their identities.

    In batch order a row is a duplicate when either identity is taken, by existing
    evidence or by a row added before it. Each round adds the rows without an open row before
    them in either identity. A row behind exactly one open row has the opposite fate of that
    one, so whole chains of such rows settle with their first row, found by pointer doubling;
    rows behind several wait. No claim's rows ever have to meet in one task.
    """
    named = claims.select(F.col("id").alias("claim_id"), F.lit(True).alias("known"),
                          F.col("ledger_ref").isNotNull().alias("guarded"))
    rows = evidence_identities(additions).join(broadcast_if_small(named), "claim_id", "left")
    refused = (F.when(F.col("known").isNull(), "unknown claim")
               .when(F.col("guarded"), "guarded claim"))
    rows = materialize(rows.withColumn("refused", refused).drop("known", "guarded"))
    open_ = rows.where(F.col("refused").isNull()).select(
        "claim_id", "batch_ord", "by_capture", "by_words")
    # copies with both identities equal follow the first of them
    open_ = open_.groupBy("claim_id", "by_capture", "by_words").agg(
        F.min("batch_ord").alias("batch_ord"))
    if "by_words" not in evidence.columns:
        evidence = evidence_identities(evidence)
    open_ = materialize(_unless_taken(open_, evidence))
    new = rows.select("claim_id", "batch_ord").limit(0)
    while not open_.isEmpty():
        fate = _chain_fates(open_)
        added = materialize(open_.join(fate.where("added").select("claim_id", "batch_ord"),
                                       ["claim_id", "batch_ord"], "left_semi"))
        new = new.unionByName(added.select("claim_id", "batch_ord"))
        rest = open_.join(fate.select("claim_id", "batch_ord"), ["claim_id", "batch_ord"],
                          "left_anti")
        open_ = materialize(_unless_taken(rest, added))
    new = new.withColumn("new", F.lit(True))
    outcome = F.coalesce("refused", F.when(F.col("new"), "added").otherwise("duplicate"))
    return (rows.join(new, ["claim_id", "batch_ord"], "left").withColumn("outcome", outcome)
            .drop("refused", "new", "by_capture", "by_words"))


def _open_before(open_: DataFrame, identity: str) -> DataFrame:
    """Add, per identity, the open row before this one, and whether there are more than one.

    The two first rows of an identity are two aggregates; no row is ranked within it.
    """
    key = ["claim_id", identity]
    held = open_.where(F.col(identity).isNotNull())
    first = held.groupBy(*key).agg(F.min("batch_ord").alias("_first"))
    second = (held.join(first, key).where(F.col("batch_ord") > F.col("_first"))
              .groupBy(*key, "_first").agg(F.min("batch_ord").alias("_second")))
    rows = open_.join(second, key, "left")
    later = F.col("batch_ord") > F.col("_first")
    return (rows.withColumn(f"{identity}_prior", F.when(later, F.col("_first")))
            .withColumn(f"{identity}_many", F.coalesce(
                F.col("batch_ord") > F.col("_second"), F.lit(False))).drop("_first", "_second"))


def _chain_fates(open_: DataFrame) -> DataFrame:
    """(claim_id, batch_ord, added) of the rows this round settles.

    Every row points to the one open row before it and flips its fate; rows behind none or
    several point to themselves. Doubling the pointers leads each chain to its start.
    """
    rows = _open_before(_open_before(open_, "by_capture"), "by_words")
    priors = F.array_distinct(F.array_compact(F.array("by_capture_prior", "by_words_prior")))
    stuck = F.col("by_capture_many") | F.col("by_words_many") | (F.size(priors) > 1)
    free = F.size(priors) == 0
    rows = materialize(rows.select(
        "claim_id", "batch_ord", F.when(~stuck & ~free, priors[0]).otherwise(F.col("batch_ord"))
        .alias("to"), (~stuck & ~free).alias("flips"), stuck.alias("stuck")))
    while True:
        ahead = rows.select("claim_id", F.col("batch_ord").alias("to"), F.col("to").alias("_to"),
                            F.col("flips").alias("_flips"), F.col("stuck").alias("_stuck"))
        # a start points to itself, so following it changes nothing
        after = materialize(rows.join(ahead, ["claim_id", "to"]).select(
            "claim_id", "batch_ord", F.col("_to").alias("to"),
            (F.col("flips") != F.col("_flips")).alias("flips"),
            (F.col("stuck") | F.col("_stuck")).alias("stuck"),
            (F.col("to") != F.col("_to")).alias("moved")))
        rows = after.drop("moved")
        if after.where("moved").isEmpty():
            return rows.where("not stuck").select("claim_id", "batch_ord",
                                                  (~F.col("flips")).alias("added"))


def _unless_taken(rows: DataFrame, taken: DataFrame) -> DataFrame:
    for identity in ("by_capture", "by_words"):
        seen = taken.where(F.col(identity).isNotNull()).select("claim_id", identity).distinct()
        rows = rows.join(seen, ["claim_id", identity], "left_anti")
    return rows


# --- review ----------------------------------------------------------------------
def review_window(inbox: DataFrame, month_end: Column, days: int = 60) -> DataFrame:
    return inbox.where((F.col("date") <= month_end)
                       & (F.col("date") >= F.date_sub(month_end, days - 1)))


def month_review(inbox: DataFrame, claims: DataFrame) -> DataFrame:
    """Signals per claim in the window; claims missing from the file are flagged."""
    signals = inbox.where(F.col("matched_claim").isNotNull()).groupBy("matched_claim").agg(
        F.count("*").alias("signals"))
    known = claims.select(F.col("id").alias("matched_claim"), "status",
                          F.col("ledger_ref").isNotNull().alias("guarded"),
                          F.lit(True).alias("known"))
    return (signals.join(broadcast_if_small(known), "matched_claim", "left")
            .withColumn("missing", F.col("known").isNull()).drop("known")
            .fillna(False, ["guarded"]))


def candidate_gate(inbox: DataFrame) -> DataFrame:
    """Candidates with enough days, domains and types, one of them independent."""
    rows = inbox.where(F.col("matched_claim").isNull()).withColumn(
        "candidate_key", F.coalesce("candidate_key", F.lit("unclassified")))
    host = U.url_host(F.col("url"))
    rows = computed(rows, {"_host": F.when(host != "", host)})
    stats = rows.groupBy("candidate_key").agg(
        F.count("*").alias("signals"), F.countDistinct("date").alias("days"),
        F.countDistinct("_host").alias("domains"),
        F.countDistinct("source_type").alias("source_types"),
        F.bool_or(F.col("source_type").isin(fixed.INDEPENDENT_TYPES)).alias("independent"))
    return stats.withColumn("passed", (F.col("days") >= 3) & (F.col("domains") >= 2)
                            & (F.col("source_types") >= 2) & F.col("independent"))
