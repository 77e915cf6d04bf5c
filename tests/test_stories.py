"""Clustering against an independent reading of each day in order."""

import datetime as dt
import itertools
import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from newsledger.operators import lineage as L, stories as S, titles
from newsledger.operators.classify import with_identity

SCHEMA = ("day date, section_ord int, payload_ord string, item_ord long, title string, "
          "url string, external_url string, source_id string, tier string, section string, "
          "published string, published_at timestamp, summary string, content_sha256 string")
WORDS = ["openai", "launches", "coding", "model", "deepseek", "claude", "update", "market",
         "report", "quarter", "regional", "weather", "gpt-5", "qwen3", "benchmark"]


def make_rows(seed, items, days=2, urls=6):
    rng = random.Random(seed)
    titles = [" ".join(rng.choices(WORDS, k=rng.randint(4, 7))) for _ in range(5)]
    rows = []
    for i in range(items):
        title = rng.choice(titles)
        if rng.random() < 0.5:
            words = title.split()
            words[rng.randrange(len(words))] = rng.choice(WORDS)
            title = " ".join(words)
        if rng.random() < 0.2:
            title += "s"
        day = dt.date(2026, 8, 1 + rng.randrange(days))
        at = None if rng.random() < 0.15 else dt.datetime(2026, 8, day.day, rng.randrange(24),
                                                          rng.choice([0, 30]))
        source = f"s{rng.randrange(4)}"
        url = f"https://www.example.com/{rng.randrange(urls)}?utm_source={rng.randrange(3)}"
        rows.append((day, rng.randrange(1, 4), source, i, title, url, "", source,
                     rng.choice(["official", "community"]), "x", "", at, "", ""))
    return rows


def tokens(title):
    import re
    from newsledger import fixed_values as fixed
    return {w for w in re.findall(r"[a-z0-9][a-z0-9_.-]*", title)
            if len(w) > 1 and w not in fixed.TITLE_STOPWORDS}


def entities(title):
    import re
    from newsledger import fixed_values as fixed
    vendors = {v for k, v in fixed.VENDOR_ALIASES.items() if k in title}
    families = "|".join(rf"{f}[-\s]?[\w.]+" for f in fixed.MODEL_FAMILIES)
    return vendors, {re.sub(r"\s+", "-", m) for m in re.findall(rf"\b(?:{families})\b", title)}


def likeness(a, b):
    x, y = tokens(a), tokens(b)
    ratio = SequenceMatcher(None, a, b).ratio()
    jaccard = len(x & y) / len(x | y) if x and y else 0.0
    return max(ratio, 0.6 * ratio + 0.4 * jaccard)


def compatible(a, b):
    return all(not p or not q or p & q for p, q in zip(entities(a), entities(b)))


def read_in_order(items):
    """Plain whole-day reading: item -> (founder item, reason)."""
    far_past = dt.datetime(1, 1, 1)
    order = sorted(items, key=lambda r: (r["published_at"] or far_past, r["source_item_id"],
                                         r["section_ord"], r["payload_ord"], r["item_ord"]))
    founders, known, result = [], {}, {}
    for row in order:
        title, url, when = row["title"].lower(), row["canonical_url"], row["published_at"]
        choice = None
        for f in known.get(url, []):
            if compatible(title, f["title"].lower()) and not (
                    f["source_id"] == row["source_id"] and f["title"].lower() != title
                    and likeness(title, f["title"].lower()) < 0.86):
                choice = (f, "canonical_url")
                break
        if choice is None and len(title) >= 18 and len(tokens(title)) >= 4 and when:
            for f in founders:
                if (f["published_at"]
                        and abs((when - f["published_at"]).total_seconds()) <= 6 * 3600
                        and likeness(title, f["title"].lower()) >= 0.86
                        and compatible(title, f["title"].lower())):
                    choice = (f, "title_similarity")
                    break
        if choice is None:
            founders.append(row)
            choice = (row, "founder")
        bucket = known.setdefault(url, [])
        if all(f["item_ord"] != choice[0]["item_ord"] for f in bucket):
            bucket.append(choice[0])
        result[row["item_ord"]] = (choice[0]["source_item_id"], choice[0]["title"].lower(),
                                   choice[1])
    return result


def check(spark, rows, **options):
    items = with_identity(spark.createDataFrame(rows, SCHEMA)).cache()
    got = {r["item_ord"]: (r["founder_item_id"], r["reason"], r["day"], r["story_id"])
           for r in S.cluster_items(items, **options).collect()}
    by_day = {}
    for row in items.collect():
        by_day.setdefault(row["day"], []).append(row.asDict())
    stories = {}
    for day, group in by_day.items():
        for item, (founder, title, reason) in read_in_order(group).items():
            assert got[item][:2] == (founder, reason), (item, got[item], founder, reason)
            stories.setdefault((day, founder, title), set()).add(got[item][3])
    assert all(len(s) == 1 for s in stories.values())
    assert len(got) == len(rows)


def test_random_days_match_the_ordered_reading(spark):
    check(spark, make_rows(1, 100, days=2, urls=40))


def test_shared_urls(spark):
    check(spark, make_rows(2, 120, days=2, urls=5))


def test_crowded_blocks_stay_exact(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_ROWS", 6)
    monkeypatch.setattr(S, "FRONT_ROWS", 3)
    check(spark, make_rows(3, 50, days=1, urls=40))


def test_one_url_of_one_source_with_many_titles(spark):
    """Later titles under a generic URL compare with founders, also with guests from elsewhere."""
    rows = [r[:2] + ("s0",) + r[3:7] + ("s0" if i % 3 else "s1",) + r[8:]
            for i, r in enumerate(make_rows(5, 120, days=1, urls=2))]
    check(spark, rows)


def story_rows(spark, rows):
    base = [(dt.date(2026, 8, 5), 1, s, i, title, url, "", s, tier, "x", "", at, "", "")
            for i, (s, tier, title, url, at) in enumerate(rows)]
    return S.cluster_items(with_identity(spark.createDataFrame(base, SCHEMA)))


AT = dt.datetime(2026, 8, 5, 10)


def test_tracking_variants_of_one_url_are_one_story(spark):
    rows = story_rows(spark, [
        ("a", "official", "Release notes of the week", "https://www.example.com/x?utm_source=a", AT),
        ("b", "community", "Other words entirely here", "https://example.com/x", AT)])
    found = S.stories(rows).collect()
    assert len(found) == 1 and found[0]["item_count"] == 2 and found[0]["source_count"] == 2
    assert [r["reason"] for r in S.merge_events(rows).collect()] == ["canonical_url"]


def test_similar_titles_merge_but_other_vendors_and_undated_do_not(spark):
    later = AT + dt.timedelta(hours=2)
    rows = story_rows(spark, [
        ("a", "official", "OpenAI launches new GPT coding model", "https://a.com/1", AT),
        ("b", "community", "OpenAI launches its new GPT coding model", "https://b.com/2", later),
        ("c", "community", "Anthropic launches new GPT coding model", "https://c.com/3", later),
        ("d", "community", "OpenAI launches new GPT coding model", "https://d.com/4", None)])
    events = S.merge_events(rows).collect()
    assert len(events) == 1 and events[0]["reason"] == "title_similarity"
    assert events[0]["similarity"] >= 0.86


def test_same_source_generic_url_with_other_titles_stays_apart(spark):
    rows = story_rows(spark, [
        ("a", "official", "First entirely different subject", "https://a.com/", AT),
        ("a", "official", "Second thing without any relation", "https://a.com/", AT)])
    assert S.stories(rows).count() == 2


def test_independence_counts_origins(spark):
    base = [("direct", "official", "https://www.origin.com/post?utm_source=x", ""),
            ("hn", "aggregator", "https://news.ycombinator.com/item?id=1", "https://origin.com/post")]
    rows = spark.createDataFrame(
        [(dt.date(2026, 8, 5), "s1", s, t, u, e) for s, t, u, e in base],
        "day date, story_id string, source_id string, tier string, url string, external_url string")
    records = S.origin_records(rows)
    assert {r["carrier"] for r in records.collect()} == {"direct", "hn"}
    found = S.independence(records).first()
    assert found["coverage_count"] == 2 and found["estimated_independent_origin_count"] == 1


def day_rows(titles):
    at = dt.datetime(2026, 8, 1, 9, 0)
    return [(at.date(), 1, "p", i, title, f"https://h{i}.com/{i}", "", f"s{i}", "official", "x", "",
             at + dt.timedelta(minutes=30 * i), "", "") for i, title in enumerate(titles)]


def reasons(spark, titles):
    rows = with_identity(spark.createDataFrame(day_rows(titles), SCHEMA))
    return [r["reason"] for r in
            S.cluster_items(rows).orderBy("item_ord").select("reason").collect()]


def test_short_founder_is_found(spark):
    """12 characters against 18: ratio 0.80, equal words, similarity 0.88."""
    got = reasons(spark, ["ab cd ef gh!", "ab cd ef gh!!!!!!!"])
    assert got[0] == "founder" and got[1] == "title_similarity"


def test_lost_share_is_exact(spark):
    """At 57 characters a partner may lack 28 bigrams, so 29 keys are needed."""
    title = "".join(chr(0x4E00 + i) for i in range(57))
    frame = spark.createDataFrame([(title, ["x"])], "title_n string, tokens array<string>")
    keys = titles.with_block_keys(frame).first()["_keys"]
    assert sum(k["key"].startswith("g") for k in keys) == 29


def test_title_parents_are_the_best_of_all_pairs(spark):
    from newsledger.functions import text as T
    rng = random.Random(11)
    rows = []
    for i in range(140):
        words = rng.choices(WORDS, k=rng.randint(4, 7))
        if i > 20 and rng.random() < 0.7:
            words = rows[rng.randrange(len(rows))][2].split()
            words[rng.randrange(len(words))] += rng.choice(["", "s", "er"])
        rows.append((dt.date(2026, 8, 1 + rng.randrange(12)), f"story-{i:03}", " ".join(words)))
    df = spark.createDataFrame(rows, "day date, story_id string, title_n string")
    tokens_ = T.title_tokens(F.col("title_n"))
    df = (df.withColumn("tokens", tokens_).withColumn("vendors", T.title_vendors(F.col("title_n")))
          .withColumn("models", T.title_models(F.col("title_n")))
          .withColumn("mergeable", T.title_is_mergeable(F.col("title_n"), tokens_)))
    got = {r["story_id"]: (r["prior_day"], r["prior_story_id"]) for r in
           L.title_parents(df, {"stories": df}).collect()}
    want = {}
    for day, story, title in rows:
        best = None
        vendors, models = entities(title)
        for other_day, other, text in rows:
            v, m = entities(text)
            clash = (vendors and v and not vendors & v) or (models and m and not models & m)
            if (clash or not (vendors & v or models & m) or not 1 <= (day - other_day).days <= 7
                    or min(len(title), len(text)) < 18
                    or min(len(tokens(title)), len(tokens(text))) < 4):
                continue
            value = likeness(title, text)
            if value >= 0.9:
                best = max(best or (0.0,), (value, other_day, other))
        if best:
            want[story] = best[1:]
    assert len(want) > 20 and got == want


def test_title_join_equals_all_pairs(spark, monkeypatch):
    """Pairs of the blocks, whole or split, hold every pair at the threshold."""
    from newsledger.functions import text as T
    rng, rows = random.Random(8), []
    letters = "abcdefgh "
    for i in range(160):
        if i > 30 and rng.random() < 0.8:
            title = list(rng.choice(rows)[1])
            for _ in range(rng.randint(1, 2)):
                title[rng.randrange(len(title))] = rng.choice(letters)
            title = "".join(title)
        elif rng.random() < 0.5:
            title = " ".join(rng.choices(WORDS, k=rng.randint(2, 7)))
        else:
            title = "".join(rng.choices(letters, k=rng.randint(1, 30)))
        rows.append((f"r{i:03}", " ".join(title.split()) or "x"))
    df = spark.createDataFrame(rows, "rep string, title_n string")
    df = df.withColumn("tokens", T.title_tokens(F.col("title_n"))).cache()
    order = titles.corpus_order(df)
    keys = titles.with_block_keys(df, order).select(
        "rep", F.lit("b").alias("block"), F.length("title_n").alias("length"), "title_n", "tokens",
        F.inline("_keys")).cache()
    earlier = F.col("x_rep") > F.col("y_rep")

    def pairs(found):
        return {(r.x_rep, r.y_rep) for r in titles.meet(found, found, ["block", "key"], earlier)
                .select("x_rep", "y_rep").distinct().collect()}
    met = pairs(keys.drop("title_n", "tokens"))
    split = pairs(titles.split_keys(keys, order))
    text = dict(rows)
    want = {(b, a) for a, b in itertools.combinations(sorted(text), 2)
            if likeness(text[b], text[a]) >= 0.86}
    assert len(want) > 60 and want <= met and want <= split
    assert len(met) < 160 * 159 / 4


def test_a_day_of_near_equal_titles_takes_few_rounds(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_ROWS", 50)
    monkeypatch.setattr(S, "FRONT_ROWS", 10)
    rounds, settle = [], S._settle
    monkeypatch.setattr(S, "_settle", lambda *a: rounds.append(1) or settle(*a))
    titles_ = [f"openai launches another coding model benchmark {i % 7}{i % 3}" for i in range(600)]
    at = dt.datetime(2026, 8, 1, 9, 0)
    rows = [(at.date(), 1, "p", i, t, f"https://h{i}.com/{i}", "", f"s{i}", "official", "x", "",
             at + dt.timedelta(seconds=10 * i), "", "") for i, t in enumerate(titles_)]
    found = S.cluster_items(with_identity(spark.createDataFrame(rows, SCHEMA)))
    assert found.select("story_id").distinct().count() == 1 and len(rounds) <= 4


def test_plans_do_not_grow_with_the_rounds(spark, monkeypatch):
    """Titles that each resemble the next only settle one a round; a late round reads as many
    tables as an early one, else the driver holds ever larger plans."""
    leaves, settle = [], S._settle

    def counted(open_, facts):
        leaves.append(facts._jdf.queryExecution().analyzed().collectLeaves().size())
        return settle(open_, facts)
    monkeypatch.setattr(S, "_settle", counted)
    words = [[c * 6 for c in letters] for letters in ("abcdefgh", "ijklmnop")]
    chain = [" ".join(words[1][:i] + words[0][i:]) for i in range(7)]
    at = dt.datetime(2026, 8, 1, 9, 0)
    check(spark, [(at.date(), 1, "p", i, t, f"https://h{i // 2}.com/", "", f"s{i}", "official", "x",
                   "", at + dt.timedelta(minutes=i), "", "") for i, t in enumerate(chain)])
    assert len(leaves) >= 5 and max(leaves[2:]) <= leaves[1] and leaves[-1] < 10, leaves


def test_direct_comparison_equals_all_pairs(spark):
    """Bit sets and common subsequences lose no pair at the threshold, long titles included."""
    from newsledger.functions import text as T
    rng, rows = random.Random(21), []
    for i in range(120):
        size = rng.choice([3, 7, 25, 60, 61, 62, 63, 64, 90])
        title = list("".join(rng.choices("abcdefgh é", k=size)))
        if i > 20 and rng.random() < 0.8:
            title = list(rng.choice(rows)[1])
            for _ in range(rng.randint(1, max(1, len(title) // 8))):
                title[rng.randrange(len(title))] = rng.choice("abcdefgh")
        rows.append((f"r{i:03}", " ".join("".join(title).split()) or "x"))
    df = spark.createDataFrame(rows, "rep string, title_n string")
    df = titles.signed(df.withColumn("tokens", T.title_tokens(F.col("title_n")))).cache()
    x, y = (df.select(*[F.col(c).alias(f"{name}_{c}") for c in df.columns]) for name in "xy")
    left = titles.in_order(x.join(y, F.col("x_rep") > F.col("y_rep")).where(titles.may_match()))
    got, text = {(r.x_rep, r.y_rep) for r in left.collect()}, dict(rows)
    want = {(b, a) for a, b in itertools.combinations(sorted(text), 2)
            if likeness(text[b], text[a]) >= 0.86}
    assert len(want) > 60 and want <= got and len(got) < 3 * len(want)


def test_story_tables_hold_no_keys_and_no_texts(spark, monkeypatch):
    """Whole texts and candidate keys are not written: tables grow with items and edges."""
    written, write = [], S.materialize
    monkeypatch.setattr(S, "materialize", lambda df: written.append(write(df)) or written[-1])
    rng = random.Random(4)
    rows = day_rows([" ".join(rng.choices(WORDS, k=8)) for _ in range(60)])
    items = with_identity(spark.createDataFrame(rows, SCHEMA)).withColumn("match_text", F.lit("t"))
    S.cluster_items(items)
    assert all("match_text" not in df.columns for df in written)
    assert max(df.count() for df in written) <= 60 * 5


def test_edges_and_facts_are_numbers(spark, monkeypatch):
    """What grows with pairs holds numbers in reading order, no hashes and no texts."""
    edges, known = [], S._known
    monkeypatch.setattr(S, "_known", lambda open_, e, *a: edges.append(e) or known(open_, e, *a))
    check(spark, make_rows(9, 40, days=1, urls=20))
    for name, kind in edges[0].dtypes:
        assert kind in ("date", "bigint", "double", "boolean"), (name, kind)
    assert not edges[0].isEmpty() and edges[0].where("x <= y").isEmpty()


def test_trigrams_after_the_join_keep_the_same_pairs(spark):
    rng = random.Random(12)
    rows = [(i, " ".join(rng.choices(WORDS, k=rng.randint(2, 4)))) for i in range(60)]
    from newsledger.functions import text as T
    df = spark.createDataFrame(rows, "rep long, title_n string")
    df = titles.signed(df.withColumn("tokens", T.title_tokens(F.col("title_n")))).cache()
    x, y = (df.select(*[F.col(c).alias(f"{name}_{c}") for c in df.columns]) for name in "xy")
    pairs = x.join(y, F.col("x_rep") > F.col("y_rep"))

    def ids_(found):
        return sorted((r.x_rep, r.y_rep) for r in found.select("x_rep", "y_rep").collect())
    whole = ids_(pairs.where(titles.may_match()))
    assert whole and ids_(titles.matching(pairs.where(titles.may_meet()))) == whole


def test_only_near_pairs_wait_for_python(spark, monkeypatch):
    """Rows that wait for Python are queued on disk. Titles with the same letters and pairs of
    letters in another order pass the bit sets; the edit distance keeps them from the queue."""
    from pyspark.sql.types import IntegerType
    from newsledger.functions import similarity, text as T
    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf(IntegerType())
    def counted(left, right):
        seen.add(len(left))
        return similarity.common_in_order.func(left, right)
    monkeypatch.setattr(similarity, "common_in_order", counted)
    rng = random.Random(8)
    rows = []
    for i in range(60):
        words = ["abcdefghij", "klmnopqrst", "uvwxyz0123", "456789acegik"]
        rng.shuffle(words)
        rows.append((i, "".join(words) + "s" * (i % 2)))
    df = spark.createDataFrame(rows, "rep long, title_n string")
    df = titles.signed(df.withColumn("tokens", T.title_tokens(F.col("title_n")))).cache()
    x, y = (df.select(*[F.col(c).alias(f"{name}_{c}") for c in df.columns]) for name in "xy")
    pairs = titles.matching(x.join(y, F.col("x_rep") > F.col("y_rep")).where(titles.may_meet()))
    got = {(r.x_rep, r.y_rep) for r in titles.in_order(pairs).collect()}
    want = {(b, a) for a, b in itertools.combinations(range(len(rows)), 2)
            if likeness(rows[b][1], rows[a][1]) >= 0.86}
    assert want and want <= got
    assert pairs.count() > 10 * len(want) and seen.value <= 3 * len(want)


def test_lineage_entries_join_written_tables(spark):
    """The last join plans over few written tables, not over all steps behind them."""
    items = S.cluster_items(with_identity(spark.createDataFrame(make_rows(5, 12, days=2), SCHEMA)))
    items = S.materialize(items)
    entries = L.build_lineages(S.stories(items), items)
    assert entries._jdf.queryExecution().analyzed().collectLeaves().size() <= 6
    assert entries.count() == items.select("day", "story_id").distinct().count()
