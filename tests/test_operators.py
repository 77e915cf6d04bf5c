"""Operators against brute force and against the listed scenarios."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from newsledger.operators import (authors as A, claims as C, classify as K, lineage as L,
                                  ordered as O, skew)
from newsledger.operators.intervals import interval_profile

DAY = dt.date(2026, 8, 5)


def series(spark, seed=1, rows=200):
    rng = random.Random(seed)
    data = [(f"k{rng.randrange(3)}", dt.datetime(2026, 8, 1) + dt.timedelta(hours=rng.randrange(200)),
             i, rng.randrange(50), rng.random() < 0.5) for i in range(rows)]
    return spark.createDataFrame(data, "k string, ts timestamp, i int, v int, f boolean").cache()


def test_two_level_windows_equal_plain_windows(spark):
    df = series(spark)
    plain = Window.partitionBy("k").orderBy("ts", "i")
    upto = plain.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("k", "i", F.lag("v").over(plain).alias("prev_v"),
                     F.row_number().over(plain).alias("rank"), F.max("v").over(upto).alias("top"))
    got = O.with_lag(df, ["k"], F.to_date("ts"), ["ts", "i"], ["v"])
    got = O.with_rank(got, ["k"], F.to_date("ts"), ["ts", "i"])
    got = O.with_running_max(got, ["k"], F.to_date("ts"), ["ts", "i"], F.col("v"), "top")
    columns = ["k", "i", "prev_v", "rank", "top"]
    assert sorted(map(str, got.select(columns).collect())) == sorted(
        map(str, want.select(columns).collect()))


def test_first_wins_newest_and_median(spark):
    df = series(spark, 2)
    rows = df.collect()
    first = {r["k"]: r["i"] for r in O.first_wins(df, ["k"], ["ts", "i"]).collect()}
    recent = {}
    for r in O.newest(df, ["k"], F.to_date("ts"), ["ts", "i"], 5).collect():
        recent.setdefault(r["k"], set()).add(r["i"])
    medians = {r["k"]: r["m"] for r in O.exact_median(df, ["k"], "v", "m", 7).collect()}
    import statistics
    for k in {r["k"] for r in rows}:
        own = sorted((r["ts"], r["i"]) for r in rows if r["k"] == k)
        assert first[k] == own[0][1] and recent[k] == {i for _, i in own[-5:]}
        assert medians[k] == statistics.median(r["v"] for r in rows if r["k"] == k)


def test_salted_join_equals_join(spark):
    left, right = series(spark, 3), series(spark, 4, 30).select("k", F.col("v").alias("w"))
    for how in ("inner", "left"):
        a = skew.salted_join(left, right, ["k"], how, hot_rows=20)
        b = left.join(right, "k", how)
        columns = ["k", "i", "w"]
        assert sorted(map(str, a.select(columns).collect())) == sorted(
            map(str, b.select(columns).collect()))


def test_interval_profile_equals_pairs(spark):
    rng = random.Random(7)
    base = dt.datetime(2026, 1, 1)

    def rows(n):
        return [(rng.choice("xy"), rng.choice("abc"), base + dt.timedelta(
            hours=rng.choice([rng.randrange(24 * 200), rng.randrange(10) * 720]))) for _ in range(n)]
    points, probes = rows(60), rows(60)
    schema = "signal string, source string, ts timestamp"
    got = {(r["signal"], r["ts"]): (r["earliest"], r["low"], r["high"]) for r in interval_profile(
        spark.createDataFrame(points, schema), spark.createDataFrame(probes, schema), ["signal"]).collect()}
    for signal, _, at in probes:
        near = [(t, s) for k, s, t in points if k == signal and abs(t - at) <= dt.timedelta(days=30)]
        want = (min(t for t, _ in near), min(s for _, s in near), max(s for _, s in near)) if near else None
        assert got.get((signal, at)) == want


# --- classification ---------------------------------------------------------------
ITEM = ("day date, source_id string, name string, tier string, payload_ord string, item_ord int, "
        "title string, url string, published string, summary string, changed boolean, "
        "content_sha256 string, external_url string")


def item(i, title, tier="community", url=None, published="", summary="", changed=None, source="s"):
    return (DAY, source, source, tier, source, i, title, url or f"https://a.com/{i}", published,
            summary, changed, None, "")


def test_classify_rules(spark):
    rules = K.Rules.of(["GLM"], [("a", "今日发布", ["launch", "weights"]), ("b", "一线实测", ["tested"]),
                                 ("c", "unknown", ["odd"])])
    rows = [item(0, "launch and tested"), item(1, "tested", "official"), item(2, "GLM only"),
            item(3, "GLM only", "index"), item(4, "nothing"), item(5, "tested", changed=False),
            item(6, "tested", published="2026-08-01"), item(7, "tested", published="2026-08-02"),
            item(8, "odd"), item(9, "x", summary="y" * 400 + " tested"), item(10, "tested", url="note"),
            item(11, "tested", url="https://a.com/0"), item(12, "tested", published="2027-01-01")]
    df = spark.createDataFrame(rows, ITEM)
    got = {r["item_ord"]: r["section"] for r in K.classify(df, rules).collect()}
    assert got == {0: "今日发布", 1: "今日发布", 2: "一线实测", 3: "今日发布", 7: "一线实测",
                   8: "一线实测", 9: "一线实测", 12: "一线实测"}
    assert {r["item_ord"] for r in K.rejected_urls(df, rules).collect()} == {10}
    kept = K.classify(df, rules, first_url_wins=False).collect()
    assert 11 in {r["item_ord"] for r in kept}
    long = next(r for r in kept if r["item_ord"] == 9)
    assert len(long["summary"]) == 300 and long["match_text"].endswith("tested")


# --- claims -----------------------------------------------------------------------
def test_two_axis_matching(spark):
    rules = K.Rules.of(["GLM"], [("pricing", "x", ["price"]), ("company", "x", ["Zhipu"])])
    claims = spark.createDataFrame(
        [("c1", "GLM price rises", "open", "", None, None), ("c2", "other", "open", "", ["C++", "涨价"], None),
         ("c3", "Zhipu news", "resolved", "", None, None)],
        "id string, claim string, status string, watch string, watch_keywords array<string>, ledger_ref string")
    items = spark.createDataFrame(
        [(1, "GLM only"), (2, "price only"), (3, "glm PRICE"), (4, "about C++ here"), (5, "又涨价了")],
        "k int, match_text string")
    words = C.claim_keywords(C.active_claims(claims), rules)
    found = C.claim_matches(words, C.keyword_sightings(items, "k", words), "k").collect()
    assert {(r["claim_id"], r["k"], r["lane"]) for r in found} == {
        ("c1", 1, "broad"), ("c1", 3, "strict"), ("c2", 4, "strict"), ("c2", 5, "strict")}


def pick(rows, day, limit=8):
    """Lanes filled one after the other."""
    from newsledger import fixed_values as fixed
    order = sorted(rows, key=lambda r: (r["date"], r["ev_ord"]), reverse=True)
    today = [r for r in order if r["date"] == day]
    turned = [r for r in order if r["stance"] in ("counter", "confounder") or "反证" in r["verdict"]]
    lanes = [today[:1], turned[:1]]
    lanes += [[r for r in order if r["stance"] == s] for s in fixed.EVIDENCE_STANCES]
    lanes += [[r for r in order if r["type"] == t] for t in fixed.SOURCE_TYPES]
    chosen = []
    for lane in [*lanes, today, order]:
        for r in lane:
            if r["ev_ord"] not in chosen and len(chosen) < limit:
                chosen.append(r["ev_ord"])
    return chosen


def test_evidence_selection(spark):
    rng = random.Random(3)
    rows = [dict(claim_id=f"c{rng.randrange(4)}", ev_ord=i, date=DAY - dt.timedelta(days=rng.randrange(4)),
                 stance=rng.choice(["counter", "confounder", "support", "neutral", None]),
                 type=rng.choice(["controlled", "vendor", "odd"]),
                 verdict=rng.choice(["反证", "x"])) for i in range(60)]
    df = spark.createDataFrame(rows, "claim_id string, ev_ord int, date date, stance string, type string, verdict string")
    got = C.select_evidence(df, F.lit(DAY)).collect()
    for claim in {r["claim_id"] for r in rows}:
        want = pick([r for r in rows if r["claim_id"] == claim], DAY)
        assert {r["ev_ord"] for r in got if r["claim_id"] == claim} == set(want)


EVIDENCE = ("claim_id string, batch_ord int, src string, type string, stance string, verdict string, "
            "link string, date date, source_item_id string, snapshot_hash string")


def test_evidence_additions_follow_batch_order(spark):
    rng = random.Random(11)

    def row(i):
        has = rng.random() < 0.8
        return (f"c{rng.randrange(3)}", i, "src", "forum", "support", f"v{rng.randrange(5)}",
                "https://a.com/x", DAY, f"s:item{rng.randrange(4)}" if has else None,
                "0" * 64 if has else None)
    old, new = [row(i) for i in range(4)], [row(i) for i in range(60)]
    new.append(("zz", 60, *new[0][2:]))
    new.append(("g", 61, *new[0][2:]))
    claims = spark.createDataFrame([("c0", None), ("c1", None), ("c2", None), ("g", "x")],
                                   "id string, ledger_ref string")
    got = {r["batch_ord"]: r["outcome"] for r in C.evidence_additions(
        spark.createDataFrame(new, EVIDENCE), spark.createDataFrame(old, EVIDENCE), claims).collect()}

    def identities(r):
        return {("w", r[0], r[5])} | ({("c", r[0], r[8])} if r[8] else set())
    taken = set().union(*[identities(r) for r in old])
    for r in new[:60]:
        want = "duplicate" if identities(r) & taken else "added"
        if want == "added":
            taken |= identities(r)
        assert got[r[1]] == want
    assert got[60] == "unknown claim" and got[61] == "guarded claim"


def test_a_long_chain_of_evidence_takes_few_rounds(spark, monkeypatch):
    """Each row shares its capture with one neighbour and its words with the other."""
    steps, write = [], C.materialize
    monkeypatch.setattr(C, "materialize", lambda df: steps.append(1) or write(df))
    new = [("c", i, "src", "forum", "support", f"v{(i + 1) // 2}", "https://a.com/x", DAY,
            f"s:item{i // 2}", "0" * 64) for i in range(10_000)]
    got = C.evidence_additions(
        spark.createDataFrame(new, EVIDENCE), spark.createDataFrame([], EVIDENCE),
        spark.createDataFrame([("c", None)], "id string, ledger_ref string"))
    added = got.where("outcome = 'added'").select("batch_ord").collect()
    assert sorted(r[0] for r in added) == list(range(0, 10_000, 2))
    assert len(steps) < 24


def test_claim_rules_positive_and_negative(spark):
    schema = ("id string, status string, watch string, ledger_ref string, career_implication array<string>")
    claims = spark.createDataFrame([
        ("fine", "leaning-yes", "", "x", ["inference：ok", "confirmed fact: ok"]),
        ("quoted", "open", "不得写「不投某类岗位」", None, None),
        ("unsourced", "resolved", "", None, None), ("untagged", "open", "", "x", ["opinion: no"]),
        ("gate", "open", "「不投」是禁语，但建议不投该公司", None, None)], schema)
    evidence = spark.createDataFrame([
        ("fine", 0, "support", "s:item1", "a" * 64, "https://a.com", dt.date(2026, 8, 6)),
        ("fine", 1, None, None, None, "a.com", dt.date(2026, 8, 1)),
        ("late", 0, None, None, None, "a.com", dt.date(2026, 8, 6)),
        ("half", 0, "support", None, None, "https://a.com", dt.date(2026, 8, 6)),
        ("bad", 0, "odd", "x", "zz", "a.com", dt.date(2026, 8, 6))],
        "claim_id string, ev_ord int, stance string, source_item_id string, snapshot_hash string, link string, date date")
    got = {(r["claim_id"], r["rule"]) for r in C.claim_violations(claims, evidence).collect()}
    assert got == {("unsourced", "committed without source"), ("untagged", "implication tag"),
                   ("gate", "hard gate on open claim"), ("late", "new row without identity"),
                   ("half", "identity incomplete"), ("bad", "stance unknown"),
                   ("bad", "snapshot_hash malformed"), ("bad", "source_item_id malformed"),
                   ("bad", "link not clickable")}


def test_binding_check(spark):
    key = ("s:1", "a" * 64)
    items = spark.createDataFrame([(DAY, *key, "https://a.com/x")],
                                  "day date, source_item_id string, snapshot_hash string, canonical_url string")
    whole = spark.createDataFrame([(DAY, "s:collection", "b" * 64, "s"), (DAY, "t:collection", "c" * 64, "t")],
                                  "day date, source_item_id string, snapshot_hash string, source_id string")
    urls = spark.createDataFrame([("s", "https://www.a.com/list/")], "source_id string, audit_url string")
    records = spark.createDataFrame([
        (1, DAY, *key, "https://www.a.com/x?utm_source=1"), (2, DAY, *key, "https://a.com/y"),
        (3, DAY, "s:1", "d" * 64, "https://a.com/x"), (4, DAY, "s:collection", "b" * 64, "https://a.com/list"),
        (5, DAY, "s:collection", "b" * 64, "https://a.com/z"), (6, DAY, "t:collection", "c" * 64, "https://a.com/z")],
        "i int, date date, source_item_id string, snapshot_hash string, url string")
    got = {r["i"]: r["binding"] for r in C.binding_check(records, items, whole, urls).collect()}
    assert got == {1: "ok", 2: "url differs from item", 3: "not captured", 4: "ok",
                   5: "url is no audit url", 6: "no audit url configured"}


# --- authors ----------------------------------------------------------------------
def remembered(days, as_of, manual=0):
    """Day-by-day bookkeeping of one author: {day: posts} -> posts kept."""
    kept, last = set(), None
    for day in sorted(days):
        if last and len(kept) + manual <= 1 and (day - last).days > 60:
            kept = set()
        kept, last = kept | days[day], day
    return set() if len(kept) + manual <= 1 and (as_of - last).days > 60 else kept


def test_forgotten_authors(spark):
    rng = random.Random(9)
    rows, want = [], {}
    for a in range(25):
        days, day = {}, dt.date(2025, 1, 1)
        for _ in range(rng.randint(1, 6)):
            day += dt.timedelta(days=rng.choice([5, 30, 60, 61, 90]))
            days[day] = {str(rng.randrange(3))}
        rows += [(f"a{a}", s, d, f"A{a}") for d, posts in days.items() for s in posts]
        want[f"a{a}"] = remembered(days, dt.date(2026, 1, 1))
    sightings = spark.createDataFrame(rows, "author string, status_id string, day date, handle string")
    manual = spark.createDataFrame([], "author string, manual_count int, has_test_signal boolean")
    got = {}
    for r in A.current_sightings(sightings, manual, F.lit(dt.date(2026, 1, 1))).collect():
        got.setdefault(r["author"], set()).add(r["status_id"])
    assert got == {a: posts for a, posts in want.items() if posts}


def test_author_ledger(spark):
    items = spark.createDataFrame([
        (DAY, ["x.com/Ann/status/1", "x.com/ann/status/1", "x.com/i/status/5"]),
        (DAY + dt.timedelta(days=1), ["x.com/ANN/status/1", "x.com/ann/status/2", "x.com/Seed/status/3"])],
        "day date, x_links array<string>")
    seeds = spark.createDataFrame([("SEED",)], "handle string")
    manual = spark.createDataFrame([("Ann", 2, True, "https://x.com/ann/status/2")],
                                   "handle string, score int, has_test_signal boolean, provenance string")
    ledger = A.author_ledger(A.author_sightings(items, seeds), A.manual_entries(manual)).collect()
    assert [(r["author"], r["count"], r["posts"], r["day_count"]) for r in ledger] == [("ann", 3, 2, 2)]
    spark_ledger = A.author_ledger(A.author_sightings(items, seeds), A.manual_entries(manual))
    assert [r["list"] for r in A.nominees(spark_ledger).collect()] == ["nominated"]


# --- lineage ----------------------------------------------------------------------
def story(day, sid, title, items, sources=1):
    return (day, sid, title, sources, None), [
        (day, sid, i, h, f"https://site{n}.com/{n}", e, "community", i.split(":")[0], title)
        for n, (i, h, e) in enumerate(items, hash(sid) % 1000)]


def run_lineage(spark, stories, **options):
    heads = spark.createDataFrame([s[0] for s in stories], "day date, story_id string, title string, "
                                  "source_count long, latest_at timestamp")
    rows = spark.createDataFrame([i for s in stories for i in s[1]], (
        "day date, story_id string, source_item_id string, snapshot_hash string, url string, "
        "external_url string, tier string, source_id string, title string"))
    return {(r["day"], r["story_id"]): r for r in L.build_lineages(heads, rows, **options).collect()}


def days_on(n):
    return DAY + dt.timedelta(days=n)


def test_lineage_links(spark):
    got = run_lineage(spark, [
        story(days_on(0), "a", "Alpha first title", [("s:1", "h1", "")]),
        story(days_on(1), "b", "Alpha first title", [("s:1", "h1", "")]),
        story(days_on(2), "c", "Alpha other title", [("s:1", "h2", "")]),
        story(days_on(1), "p", "DeepSeek model post on carrier", [("r:5", "x", "https://o.com/page")]),
        story(days_on(2), "q", "DeepSeek model post at origin", [("o:6", "y", "https://www.o.com/page?utm_source=1")]),
        story(days_on(0), "t", "OpenAI ships coding agent update today", [("u:7", "z", "")]),
        story(days_on(4), "v", "OpenAI ships coding agent update todays", [("w:8", "z", "")]),
        story(days_on(0), "g1", "weekly market summary of regional prices", [("m:1", "1", "")]),
        story(days_on(1), "g2", "weekly market summary of regional prices", [("m:2", "2", "")])])
    kinds = {k[1]: (r["update_type"], r["link_reason"]) for k, r in got.items()}
    assert kinds == {"a": ("new", "new"), "b": ("repeat", "shared_source_item"),
                     "c": ("updated-capture", "shared_source_item"), "p": ("new", "new"),
                     "q": ("follow-up", "shared_origin_url"), "t": ("new", "new"),
                     "v": ("follow-up", "title_similarity"), "g1": ("new", "new"), "g2": ("new", "new")}
    lines = {k[1]: r["lineage_id"] for k, r in got.items()}
    assert lines["a"] == lines["b"] == lines["c"] and lines["p"] == lines["q"] and lines["t"] == lines["v"]
    assert len(set(lines.values())) == 5


def test_lineage_lookback(spark):
    pair = [story(days_on(0), "t", "OpenAI ships coding agent update today", [("u:7", "z", "")]),
            story(days_on(4), "v", "OpenAI ships coding agent update today", [("w:8", "z", "")])]
    assert run_lineage(spark, pair, lookback=7)[(days_on(4), "v")]["link_reason"] == "title_similarity"
    assert run_lineage(spark, pair, lookback=3)[(days_on(4), "v")]["link_reason"] == "new"


def test_running_sum_packs_a_budget(spark):
    df = spark.createDataFrame([(i % 3, i, "x" * (i % 7)) for i in range(60)], "lane int, i int, body string")
    rows = C.pack_to_budget(df, ["lane", "i"], F.struct("lane", F.floor(F.col("i") / 10)), 600)
    upto = 0
    for r in sorted(rows.collect(), key=lambda r: (r["lane"], r["i"])):
        upto += r["bytes"]
        assert r["upto"] == upto and r["kept"] == (upto <= 600)


def trimmed(parts, budget, spent):
    """The sequential rule: one part at a time, from the claim that has most left."""
    broad = sorted((p for p in parts if p["kind"] == "broad"), key=lambda p: (-p["total"], p["claim_id"]))
    listed = sorted((p for p in parts if p["kind"] == "collection"), key=lambda p: p["place"])
    claims = sorted((p for p in parts if p["kind"] == "claim"), key=lambda p: (-p["total"], p["claim_id"]))
    own = {k: {c["claim_id"]: sorted((p for p in parts if p["kind"] == k and p["claim_id"] == c["claim_id"]),
                                     key=lambda p: p["place"]) for c in claims} for k in ("signal", "evidence")}
    size = lambda: spent + sum(p["bytes"] for p in [
        *broad, *listed, *claims, *[p for k in own for rows in own[k].values() for p in rows]])
    while size() > budget:
        if broad or listed:
            (broad or listed).pop()
            continue
        target = max(claims, key=lambda c: (len(own["signal"][c["claim_id"]]),
                                            len(own["evidence"][c["claim_id"]]), c["total"]))
        rest = [own[k][target["claim_id"]] for k in ("signal", "evidence")]
        if many := [rows for rows in rest if len(rows) > 1]:
            many[0].pop()
        else:
            claims.remove(target)
            [rows.clear() for rows in rest]
    return {p["n"] for p in [*broad, *listed, *claims,
                             *[p for k in own for rows in own[k].values() for p in rows]]}


@pytest.mark.parametrize("seed", [1, 2])
def test_budget_trims_the_largest_claim_first(spark, seed):
    rng, parts = random.Random(seed), []

    def add(kind, claim, place, total):
        parts.append(dict(n=len(parts), kind=kind, claim_id=claim, place=place, total=total,
                          bytes=rng.randrange(1, 60)))
    for i in range(40):
        total = rng.choice([0, 1, 2, 3, 3, 9])
        if total:
            add("claim", f"c{i}", 0, total)
            [add("signal", f"c{i}", j + 1, total) for j in range(min(total, 3))]
            [add("evidence", f"c{i}", j + 1, total) for j in range(rng.randrange(9))]
        elif rng.random() < 0.8:
            add("broad", f"c{i}", 0, rng.randrange(1, 4))
    [add("collection", None, i, 0) for i in range(10)]
    df = C.materialize(spark.createDataFrame(
        parts, "n int, kind string, claim_id string, place int, total int, bytes int"))
    whole = sum(p["bytes"] for p in parts)
    for budget in (100, 100 + whole // 7, 100 + whole // 2, 100 + whole - 1, 100 + whole):
        kept = C.trim_to_budget(df, budget, 100).where("kept").collect()
        assert {r["n"] for r in kept} == trimmed(parts, budget, 100)
    with pytest.raises(ValueError, match="directory"):
        C.trim_to_budget(df, 99, 100)


def test_expert_routes_and_quality(spark):
    from newsledger.operators.features import expert_features, item_quality
    from newsledger.operators.routing import route_items, with_defaults
    base = dict(source="s", day=DAY, status="ok", role="candidate", routing="expert_author", track="expert_author",
                tier="community", evidence_role="", partitions=["field_test", "research_synthesis"],
                lookback_days=30, published="", changed=None, readable=None, external_url="", name="s")
    rows = [
        {**base, "item_ord": 1, "title": "We tested it", "url": "https://a.com/1", "summary": "",
         "fulltext": "we ran a benchmark and an ablation", "external_urls": ["https://github.com/a/b"], "conflict_words": []},
        {**base, "item_ord": 2, "title": "A guide", "url": "https://a.com/2", "summary": "",
         "fulltext": "transformer inference and gradient optimization", "external_urls": [], "conflict_words": []},
        {**base, "item_ord": 3, "title": "Our product", "url": "https://a.com/3", "summary": "",
         "fulltext": "acme serving " + "x" * 500, "external_urls": [], "conflict_words": ["Acme"]},
        {**base, "item_ord": 4, "title": "Nothing", "url": "https://a.com/4", "summary": "", "fulltext": "hello",
         "external_urls": [], "conflict_words": []}]
    schema = ("source string, day date, status string, role string, routing string, track string, tier string, "
              "evidence_role string, partitions array<string>, lookback_days int, published string, changed boolean, "
              "readable boolean, external_url string, name string, item_ord int, title string, url string, "
              "summary string, fulltext string, external_urls array<string>, conflict_words array<string>")
    items = with_defaults(expert_features(spark.createDataFrame(rows, schema)), "candidate")
    assert "fulltext" not in items.columns
    routed = item_quality(route_items(items, K.Rules.default()))
    got = {r["item_ord"]: (r["partition"], r["quality"], r["conflict"], r["noise"]) for r in routed.collect()}
    assert got == {1: ("field_test", True, False, False), 2: ("research_synthesis", True, False, False),
                   3: ("research_synthesis", True, True, True)}


def test_routing_keeps_what_is_asked(spark):
    from newsledger.operators.features import expert_features
    from newsledger.operators.routing import route_items, with_defaults
    base = ("field_test", DAY, "ok", "community", "", None, "")
    rows = [("s", 1, "classify", "", "codex benchmark", "https://a.com/1", *base),
            ("s", 2, "classify", "", "codex benchmark", "https://a.com/1", *base),
            ("t", 3, "forced", "", "hello", "https://a.com/3", *base),
            ("u", 4, "expert_author", "expert_author", "we tested a benchmark and an ablation",
             "https://a.com/4", *base)]
    df = spark.createDataFrame(
        rows, "source string, item_ord int, routing string, track string, title string, url string, "
        "p string, day date, status string, tier string, published string, changed boolean, "
        "external_url string")
    df = (df.withColumn("partitions", F.array("p")).withColumn("summary", F.repeat(F.lit("word "), 200))
          .withColumn("fulltext", F.col("title")).withColumn("role", F.lit("candidate"))
          .withColumn("lookback_days", F.lit(30)).withColumn("conflict_words", F.array(F.lit("x")))
          .withColumn("external_urls", F.array().cast("array<string>"))
          .withColumn("readable", F.lit(True)))
    items = with_defaults(expert_features(df, F.col("track") == "expert_author"), "candidate")
    assert {r[0] for r in items.where("expert_features is not null").select("item_ord").collect()} == {4}
    wide = route_items(items, K.Rules.default())
    narrow = route_items(items, K.Rules.default(), ["item_ord", "source"])
    assert narrow.columns == ["item_ord", "source", "partition"]
    found = sorted(map(tuple, narrow.collect()))
    assert found == sorted(map(tuple, wide.select(*narrow.columns).collect()))
    assert found == [(1, "s", "field_test"), (3, "t", "field_test"), (4, "u", "field_test")]
    # no text passes through the aggregate of the first rows
    plan = narrow._jdf.queryExecution().optimizedPlan().toString()
    firsts = [x for x in plan.splitlines() if "min_by" in x]
    assert firsts and not any("summary" in x or "match_text" in x for x in firsts)


def test_late_items(spark):
    from newsledger.streaming.jobs import timely_items
    rows = [(1, DAY, "2026-08-01", "2026-08-05T01:00:00Z"), (2, DAY, "", "2026-08-05T01:00:00Z"),
            (3, DAY, "2026-08-02", "x"), (4, DAY, "2027-01-01", "x")]
    df = spark.createDataFrame(rows, "i int, day date, published string, fetched_at string")
    kept = {r["i"]: r["ts"] for r in timely_items(df).collect()}
    assert set(kept) == {2, 3, 4} and kept[2] == dt.datetime(2026, 8, 5, 1)


def test_guard_equals_a_walk_over_the_days(spark):

    from newsledger.operators import changes
    rng = random.Random(11)
    day0, rows, sizes = dt.date(2026, 1, 1), [], {}
    for i in range(40):  # runs of collapsed snapshots, and states that drift
        low = 3 * (i // 9)
        keys = range(low, low + 20) if rng.random() < 0.6 else range(90, 90 + rng.randrange(1, 6))
        sizes[day0 + dt.timedelta(i)] = set(keys)
        rows += [(day0 + dt.timedelta(i), f"k{k}") for k in keys]
    want, state = [], None
    for day, keys in sorted(sizes.items()):
        share = len(sizes[state] & keys) / len(sizes[state]) if state else None
        good = share is None or share >= 0.5
        want.append((day, state, len(keys), share, good))
        state = day if good else state
    got = changes.guarded_snapshots(spark.createDataFrame(rows, "day date, key string"))
    assert [tuple(r) for r in got.orderBy("day").collect()] == want
    assert sum(not w[4] for w in want) > 8
    assert changes.guarded_snapshots(got.select("day", F.lit("x").alias("key")).limit(0)).count() == 0


def test_written_tables_leave_no_shuffle_files(spark):
    """The files of a step go when its table is written, not when the driver collects garbage."""
    import time
    from newsledger.session import materialize
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        listed = disk.getAllFiles()
        return {listed.apply(i).getName() for i in range(listed.size())
                if listed.apply(i).getName().startswith("shuffle_")}
    before = files()
    rows = spark.range(5000).groupBy((F.col("id") % 1000).alias("k")).agg(F.count("*").alias("n"))
    table = materialize(rows)
    until = time.time() + 5
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before
    assert table.count() == 1000 and rows.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_small_broadcasts_hold_inside_only(spark):
    """A table above the bound is not sent through the driver by joins that run inside."""
    from newsledger.session import BROADCAST, SMALL_BROADCAST, small_broadcasts
    rows = spark.range(100_000).withColumn("k", F.sha2(F.col("id").cast("string"), 256)).cache()
    rows.count()

    def joined():
        return rows.join(rows.select("id", F.col("k").alias("k2")), "id").select("k2")
    before = [spark.conf.get(key, None) for key in BROADCAST]
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan(joined())
    with small_broadcasts(spark):
        assert "Broadcast" not in plan(joined())
        assert int(spark.conf.get(BROADCAST[0])) == SMALL_BROADCAST
    assert [spark.conf.get(key, None) for key in BROADCAST] == before
    spark.conf.set(BROADCAST[0], "-1")
    try:
        with small_broadcasts(spark):
            assert spark.conf.get(BROADCAST[0]) == "-1"
    finally:
        spark.conf.unset(BROADCAST[0])
    rows.unpersist()
