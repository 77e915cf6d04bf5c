"""Stories: leader clustering of one day's items by URL, then by title.

Items are read in time order. An item joins the first story that knows its URL and is
compatible, else the first story whose founder has a similar title within six hours,
else it founds a story. The outcome depends on the order, yet an item only waits for the few
earlier ones that might still take it:

1. Copies (same day, URL, title and source) collapse to their first item: all later
   copies provably follow it. A flood of copies is one aggregate. The first items are numbered
   in reading order, so an edge or a fact of a round is a few numbers.
2. Similar titles are joined exactly (``titles``), within six hours or within one URL and
   source, and tested where they meet: only edges are written. Titles that nearly equal more
   than ``BLOCK_ROWS`` others meet among each other by shared bigrams and words instead; of
   blocks that stay crowded only the first open members are compared.
3. Rounds settle items of all days at once. An item settles when the first story that
   would take it lies before every open item that could still found or enter such a story.
   Stories of another source under one URL are found by an index of named vendors and models,
   so no pairs form within a URL. The earliest open item always settles; a day of near-equal
   titles takes a few rounds, since all that a founder takes settle together.

The result equals reading the whole day in order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsledger import fixed_values as fixed
from newsledger.functions import ids, text as T
from newsledger.functions.urls import story_url, url_host, safe_canonical
from newsledger.operators import titles
from newsledger.operators.barrier import computed
from newsledger.operators.ordered import with_ranged_sum
from newsledger.operators.skew import salted_join
from newsledger.session import materialize

WINDOW_HOURS = 6
SLOT = WINDOW_HOURS * 3_600_000_000
#: Nearly equal titles of an item, or members of a block, that are compared in pairs, and first open
#: members of a larger block.
BLOCK_ROWS, FRONT_ROWS = 200, 64
#: Later items of one time slot that a task compares with the earlier ones.
SLICE_ROWS = 8192
COPY = ["day", "canon", "title_n", "source_id"]
REP = ["day", "rep"]
BLOCK = ["day", "block", "key"]
#: What two items that meet are compared by.
CLOSE = ["rep", "t", "title_n", "tokens", "vendors", "models", "dense"]


def story_features(items: DataFrame) -> DataFrame:
    """Add the columns clustering works with; ``t`` is the time, NULL when unknown."""
    rows = computed(items, {"title_n": T.normalized_title(F.col("title")),
                            "canon": story_url(F.col("url")),
                            "t": F.unix_micros("published_at")})
    return rows.withColumn("ord", F.struct(
        F.coalesce("t", F.lit(-(2 ** 62))).alias("o1"), F.col("source_item_id").alias("o2"),
        F.col("section_ord").alias("o3"), F.col("payload_ord").alias("o4"),
        F.col("item_ord").alias("o5")))


def _representatives(rows: DataFrame) -> DataFrame:
    """The first of each set of copies, numbered in reading order by ``rep``; ``shared`` tells
    whether others have its URL."""
    reps = (rows.groupBy(*COPY).agg(F.min("ord").alias("ord"))
            .withColumn("t", F.when(F.col("ord.o1") > -(2 ** 62), F.col("ord.o1"))))
    reps = with_ranged_sum(reps, [F.col(c) for c in ("day", "ord", *COPY[1:])], F.lit(1), "rep")
    tokens = T.title_tokens(F.col("title_n"))
    reps = computed(reps, {"tokens": tokens, "vendors": T.title_vendors(F.col("title_n")),
                           "models": T.title_models(F.col("title_n"))})
    pages = (reps.groupBy("day", "canon").agg((F.count("*") > 1).alias("shared")))
    return reps.join(pages, ["day", "canon"]).withColumn(
        "mergeable", T.title_is_mergeable(F.col("title_n"), F.col("tokens")))


# --- candidates ------------------------------------------------------------------
def _block_keys(reps: DataFrame, order: Column) -> DataFrame:
    """Rows (day, rep, block, key, ...) of titles that may be similar. A ``block`` is two time
    slots, or a URL and source. Blocks of time need both titles dated and one of them mergeable,
    with 18 characters at least, so the other has 12 or more."""
    slot = F.floor(F.col("t") / SLOT)
    dated = F.col("t").isNotNull() & (F.length("title_n") >= 12)
    slots = F.when(dated, F.array(F.concat(F.lit("t"), slot), F.concat(F.lit("t"), slot + 1)))
    page = F.when(F.col("shared"), F.array(
        F.concat(F.lit("u"), F.sha2(F.concat_ws("\x00", "canon", "source_id"), 256))))
    blocks = F.concat(F.coalesce(slots, T.empty_strings()), F.coalesce(page, T.empty_strings()))
    rows = titles.with_block_keys(reps, order)
    return (rows.select(*REP, F.length("title_n").alias("length"), "_keys",
                        F.explode(blocks).alias("block"))
            .select(*REP, "length", "block", F.inline("_keys")))


def _met(x: DataFrame, y: DataFrame) -> DataFrame:
    """Distinct pairs (day, x, y) of members that share a block, ``x`` later than ``y``."""
    pairs = titles.meet(x, y, BLOCK, F.col("x_rep") > F.col("y_rep"))
    return pairs.select("day", F.col("x_rep").alias("x"), F.col("y_rep").alias("y")).distinct()


def _edges(met: DataFrame, reps: DataFrame) -> DataFrame:
    """(day, x, y, similarity, by_title, by_url): ``x`` may join the story that the earlier ``y``
    founds, by its title or as one of their URL and source. Further columns of ``met`` stay."""
    what = F.struct("t", "canon", "source_id", "title_n", "tokens", "vendors", "models",
                    "mergeable")
    pairs = (met.join(reps.select("day", F.col("rep").alias("x"), what.alias("_l")), ["day", "x"])
             .join(reps.select("day", F.col("rep").alias("y"), what.alias("_e")), ["day", "y"]))
    near = F.abs(F.col("_l.t") - F.col("_e.t")) <= SLOT
    fits = T.titles_compatible(F.col("_l.vendors"), F.col("_l.models"),
                               F.col("_e.vendors"), F.col("_e.models"))
    pairs = pairs.where(fits).select(
        *met.columns, "_l", "_e",
        F.coalesce(F.col("_l.mergeable") & near, F.lit(False)).alias("by_title"),
        ((F.col("_l.canon") == F.col("_e.canon"))
         & (F.col("_l.source_id") == F.col("_e.source_id"))).alias("by_url"))
    return titles.similar(pairs.where("by_title or by_url"), "_l", "_e").drop("_l", "_e")


def _crowded(keys: DataFrame) -> DataFrame:
    return materialize(keys.groupBy(*BLOCK).agg(F.count("*").alias("n"))
                       .where(F.col("n") > BLOCK_ROWS).select(*BLOCK))


def _together(rows: DataFrame, test: Column) -> DataFrame:
    """Pairs of ``signed`` representatives that pass the test, ``x`` later than ``y``. The test
    runs inside the join and has to stay short, else it is never compiled. They meet
    once in the time slot of ``x``, with items of that slot and the one before, and once under
    their URL and source."""
    slot = F.floor(F.col("t") / SLOT)
    dated = F.col("t").isNotNull() & (F.col("length") >= 12)
    page = F.when(F.col("shared"), F.array(
        F.concat(F.lit("u"), F.sha2(F.concat_ws("\x00", "canon", "source_id"), 256))))

    def side(name: str, slots: Column) -> DataFrame:
        blocks = F.concat(F.coalesce(slots, T.empty_strings()),
                          F.coalesce(page, T.empty_strings()))
        return rows.select("day", F.explode(blocks).alias("block"), *[
            F.col(c).alias(f"{name}_{c}") for c in (*CLOSE, *titles.SIGNED)])
    x = side("x", F.when(dated & F.col("mergeable"), F.array(F.concat(F.lit("t"), slot))))
    y = side("y", F.when(dated, F.array(F.concat(F.lit("t"), slot),
                                        F.concat(F.lit("t"), slot + 1))))
    near = F.col("block").startswith("u") | (F.col("x_t") - F.col("y_t") <= SLOT)
    fits = T.titles_compatible(F.col("x_vendors"), F.col("x_models"),
                               F.col("y_vendors"), F.col("y_models"))
    apart = ~(F.col("x_dense") & F.col("y_dense"))
    pairs = salted_join(x, y, ["day", "block"], hot_rows=SLICE_ROWS)
    return computed(pairs.where((F.col("x_rep") > F.col("y_rep")) & near & apart & test),
                    {"_fits": fits}).where("_fits").drop("_fits")


def _dense(rows: DataFrame) -> DataFrame:
    """Representatives with more than ``BLOCK_ROWS`` nearly equal titles."""
    return materialize(
        _together(rows, titles.nearly_equal()).select("day", F.explode(F.array("x_rep", "y_rep")).alias("rep"))
        .groupBy(*REP).agg(F.count("*").alias("n")).where(F.col("n") > BLOCK_ROWS).select(*REP))


def candidates(reps: DataFrame, order: Column) -> tuple[DataFrame, DataFrame | None]:
    """Edges of similar titles, and the members of blocks too large for pairs, or None."""
    rows = materialize(titles.signed(reps.select("day", *[c for c in CLOSE if c != "dense"], "canon",
                                                 "source_id", "shared", "mergeable"))
                       .withColumn("dense", F.lit(False)))
    dense = _dense(rows)
    if dense.isEmpty():
        return materialize(_close_edges(rows)), None
    marked = dense.withColumn("dense", F.lit(True))
    rows = rows.drop("dense").join(marked, REP, "left").withColumn(
        "dense", F.coalesce("dense", F.lit(False)))
    edges, full = _crowd_candidates(reps.join(dense, REP, "left_semi"), order)
    return materialize(_close_edges(rows)).unionByName(edges), full


def _close_edges(rows: DataFrame) -> DataFrame:
    def title(name: str) -> Column:
        return F.struct(F.col(f"{name}_title_n").alias("title_n"),
                        F.col(f"{name}_tokens").alias("tokens"))
    by_url = F.col("block").startswith("u")
    pairs = titles.in_order(titles.matching(_together(rows, titles.may_meet()))).select(
        "day", F.col("x_rep").alias("x"), F.col("y_rep").alias("y"),
        (~by_url).alias("by_title"), by_url.alias("by_url"), title("x").alias("_l"),
        title("y").alias("_e"))
    return titles.similar(pairs, "_l", "_e").drop("_l", "_e")


def _crowd_candidates(reps: DataFrame, order: Column) -> tuple[DataFrame, DataFrame | None]:
    """The same among titles that have many close ones, by shared bigrams and words."""
    keys = materialize(_block_keys(reps, order))
    crowd = _crowded(keys)
    if crowd.isEmpty():
        return materialize(_edges(_met(keys, keys), reps)), None
    small = keys.join(crowd, BLOCK, "left_anti")
    full = keys.join(crowd, BLOCK, "left_semi")
    split = materialize(titles.split_keys(
        full.join(reps.select(*REP, "title_n", "tokens"), REP), order))
    crowd = _crowded(split)
    small = small.unionByName(split.join(crowd, BLOCK, "left_anti"))
    full = materialize(split.join(crowd, BLOCK, "left_semi"))
    edges = materialize(_edges(_met(small, small), reps))
    return edges, (None if full.isEmpty() else full)


def _front(members: DataFrame, open_: DataFrame, news: DataFrame | None, reps: DataFrame
           ) -> tuple[DataFrame, DataFrame]:
    """Of crowded blocks: edges among their first open members, and of all open members to the
    founders of the last round; and, as facts, the first open member for each hidden one."""
    live = materialize(members.join(open_.select(*REP), REP, "left_semi").withColumn(
        "place", F.row_number().over(Window.partitionBy(*BLOCK).orderBy("rep"))))
    front = live.where(F.col("place") <= FRONT_ROWS).drop("place")
    met = _met(front, front).withColumn("waits", F.lit(True))
    if news is not None:
        founders = members.join(news.where(F.col("reason") == "founder").select(*REP), REP,
                                "left_semi")
        met = met.unionByName(_met(live.drop("place"), founders).withColumn("waits", F.lit(False)))
    first = live.where(F.col("place") == 1).select(*BLOCK, F.col("rep").alias("ord"))
    hidden = live.where(F.col("place") > FRONT_ROWS).select(*REP, "block", "key")
    return (materialize(_edges(met, reps)),
            materialize(_facts(hidden.join(first, BLOCK), F.lit("hidden"))))


# --- rounds ----------------------------------------------------------------------
def _facts(rows: DataFrame, kind: Column, founder: str | None = None,
           similarity: str | None = None) -> DataFrame:
    """What a round knows of an open item: a story that may take it, or an open item that may
    still found or enter one, at ``ord``."""
    return rows.select(
        *REP, kind.alias("kind"), "ord",
        (F.col(founder) if founder else F.lit(None).cast("long")).alias("founder"),
        (F.col(similarity) if similarity else F.lit(None).cast("double")).alias("similarity"))


def _named(names: Column, asked: bool) -> Column:
    """Keys under which compatible names meet: ``*`` is anything, ``-`` names nothing."""
    if asked:
        return F.when(F.size(names) == 0, F.array(F.lit("*"))).otherwise(
            F.concat(F.array(F.lit("-")), names))
    return F.concat(F.array(F.lit("*")), F.when(F.size(names) == 0, F.array(F.lit("-")))
                    .otherwise(names))


def _other_sources(open_: DataFrame, entries: DataFrame | None) -> DataFrame:
    """First compatible story, and first open item, of another source under the same URL.

    Per URL and pair of names the firsts of the two earliest sources are kept: one of the two
    is of another source.
    """
    columns = ["day", "canon", "source_id", "vendors", "models", "ord"]
    rows = open_.select(*columns, F.lit(None).cast("long").alias("founder"))
    if entries is not None:
        rows = rows.unionByName(entries.select(*columns, "founder"))
    key = ["day", "canon", "v", "m", "kind"]
    rows = (rows.withColumn("v", F.explode(_named(F.col("vendors"), False)))
            .withColumn("m", F.explode(_named(F.col("models"), False)))
            .withColumn("kind", F.when(F.col("founder").isNull(), "page_open").otherwise("page"))
            .groupBy(*key, F.col("source_id").alias("other"))
            .agg(F.min(F.struct("ord", "founder")).alias("_first")))
    place = F.row_number().over(Window.partitionBy(*key).orderBy("_first.ord"))
    index = rows.withColumn("_place", place).where(F.col("_place") <= 2).select(
        *key, "other", "_first.*")
    asking = (open_.select(*REP, "canon", "source_id", F.col("ord").alias("own"), "models",
                           F.explode(_named(F.col("vendors"), True)).alias("v"))
              .withColumn("m", F.explode(_named(F.col("models"), True))).drop("models"))
    found = asking.join(index, ["day", "canon", "v", "m"]).where(
        (F.col("source_id") != F.col("other")) & (F.col("ord") < F.col("own")))
    return _facts(found, F.col("kind"), "founder")


def _guests(open_: DataFrame, entries: DataFrame, reps: DataFrame, order: Column) -> DataFrame:
    """Similar stories of the same source that entered the URL from another one."""
    page = ["day", "canon", "source_id"]
    founders = reps.select("day", F.col("rep").alias("founder"), "title_n", "tokens")
    guests = entries.where("guest").join(founders, ["day", "founder"])
    what = F.struct("title_n", "tokens", "vendors", "models")

    def keyed(rows: DataFrame, name: str, *more: str) -> DataFrame:
        rows = titles.with_block_keys(rows, order).select(*page, *more, what.alias(name), "_keys")
        return rows.withColumn("key", F.explode("_keys.key")).drop("_keys")
    hosts = (open_.join(guests.select(*page).distinct(), page, "left_semi")
             .join(reps.select(*REP, "title_n", "tokens"), REP))
    pairs = (keyed(hosts.withColumn("own", F.col("ord")), "_l", "rep", "own")
             .join(keyed(guests, "_e", "founder", "ord"), [*page, "key"])
             .where(F.col("ord") < F.col("own")).dropDuplicates([*REP, "founder"]))
    fits = T.titles_compatible(F.col("_l.vendors"), F.col("_l.models"),
                               F.col("_e.vendors"), F.col("_e.models"))
    return _facts(titles.similar(pairs.where(fits), "_l", "_e"), F.lit("page"), "founder")


def _known(open_: DataFrame, edges: DataFrame, entries: DataFrame | None, reps: DataFrame,
           order: Column) -> DataFrame:
    """All facts on open items."""
    near = edges.withColumnRenamed("x", "rep").withColumn("ord", F.col("y"))
    waits = F.col("waits")
    facts = (_facts(near.where("by_title"), F.when(waits, "title_open").otherwise("title"),
                    "y", "similarity")
             .unionByName(_facts(near.where("by_url"), F.when(waits, "page_open")
                                 .otherwise("page"), "y")))
    shared = open_.where("shared")
    facts = facts.unionByName(_other_sources(shared, entries))
    # a guest came to the URL by the title of an item there; most rounds have none
    if entries is None or shared.join(entries.where("guest"), ["day", "canon", "source_id"],
                                      "left_semi").isEmpty():
        return facts
    return facts.unionByName(materialize(_guests(shared, entries, reps, order)))


# What rounds know is one table each, brought up to date by the last round alone. A plan that reads
# the tables of all rounds so far grows with them, and with it the memory of the driver.
def _asked(edges: DataFrame, step: DataFrame) -> DataFrame:
    """Edges of items still open; ``waits`` tells that the earlier item is open, else it founded a
    story. One that joined another story takes no item."""
    left = step.where(F.col("reason").isNull()).select("day", F.col("rep").alias("x"))
    now = step.select("day", F.col("rep").alias("y"), F.coalesce("reason", F.lit("open")).alias("_now"))
    rows = edges.join(left, ["day", "x"], "left_semi").join(now, ["day", "y"], "left")
    waits = F.coalesce(F.col("_now") == "open", F.lit(False))
    return materialize(rows.where(F.coalesce("_now", F.lit("founder")).isin("open", "founder"))
                       .withColumn("waits", waits).drop("_now"))


def _entered(entries: DataFrame | None, step: DataFrame, reps: DataFrame) -> DataFrame:
    """Where each story first entered a URL that open items share, with its founder's source and
    names; a ``guest`` was founded under another URL."""
    who = reps.select("day", F.col("rep").alias("founder"), "source_id", "vendors", "models",
                      F.col("canon").alias("home"))
    rows = (step.where(F.col("shared") & F.col("reason").isin("founder", "title_similarity"))
            .select("day", "canon", "founder", "ord").join(who, ["day", "founder"])
            .withColumn("guest", F.col("home") != F.col("canon")).drop("home"))
    if entries is not None:
        rows = rows.unionByName(entries)
    pages = step.where(F.col("shared") & F.col("reason").isNull()).select("day", "canon").distinct()
    return materialize(rows.join(pages, ["day", "canon"], "left_semi")
                       .groupBy("day", "canon", "founder", "source_id", "vendors", "models", "guest")
                       .agg(F.min("ord").alias("ord")))


def _settle(open_: DataFrame, facts: DataFrame) -> DataFrame:
    """``open_`` with founder, reason and similarity; an item that has to wait has no reason."""
    def first(kind: str) -> Column:
        return F.min(F.when(F.col("kind") == kind, F.struct("ord", "founder", "similarity")))
    known = facts.groupBy(*REP).agg(*[first(k).alias(k) for k in (
        "title", "title_open", "page", "page_open", "hidden")])
    rows = materialize(open_.join(known, REP, "left"))
    # an open item that may join a story by title can bring any story to its URL
    roams = (F.col("title").isNotNull() | F.col("title_open").isNotNull()
             | F.col("hidden").isNotNull())
    roaming = (rows.where(F.col("shared") & roams).groupBy("day", "canon")
               .agg(F.min("ord").alias("_roaming")))
    rows = rows.join(roaming, ["day", "canon"], "left")
    page_wait = F.least("page_open.ord", F.when(F.col("_roaming") < F.col("ord"),
                                                F.col("_roaming")))
    title_wait = F.least("title_open.ord", "hidden.ord")
    rows = rows.withColumn("_page_wait", page_wait).withColumn("_title_wait", title_wait)

    def sure(story: str, wait: str) -> Column:
        return F.col(story).isNotNull() & (F.col(wait).isNull()
                                           | (F.col(f"{story}.ord") < F.col(wait)))
    reason = (F.when(sure("page", "_page_wait"), "canonical_url")
              .when(F.col("_page_wait").isNotNull(), F.lit(None))
              .when(sure("title", "_title_wait"), "title_similarity")
              .when(F.col("_title_wait").isNotNull(), F.lit(None)).otherwise("founder"))
    rows = rows.withColumn("reason", reason)
    by = F.col("reason")
    return rows.select(
        *open_.columns, "reason",
        F.when(by == "canonical_url", F.col("page.founder"))
        .when(by == "title_similarity", F.col("title.founder"))
        .when(by == "founder", F.col("rep")).alias("founder"),
        F.when(by == "canonical_url", 1.0)
        .when(by == "title_similarity", F.col("title.similarity")).otherwise(0.0)
        .alias("similarity"))


def _assign(reps: DataFrame) -> DataFrame:
    """(day, rep, founder, reason, similarity) for every representative."""
    reps = reps.withColumn("ord", F.col("rep"))
    order = titles.corpus_order(reps)
    edges, crowd = candidates(reps, order)
    edges = edges.withColumn("waits", F.lit(True))
    columns = [*REP, "ord", "canon", "source_id", "vendors", "models", "shared"]
    open_, entries, news, done = reps.select(*columns), None, None, []
    while True:
        hidden = None
        if crowd is not None:
            more, hidden = _front(crowd, open_, news, reps)
            edges = edges.unionByName(more)
        facts = _known(open_, edges, entries, reps, order)
        step = materialize(_settle(open_, facts if hidden is None else facts.unionByName(hidden)))
        news = step.where(F.col("reason").isNotNull())
        done.append(news.select(*REP, "founder", "reason", "similarity"))
        open_ = step.where(F.col("reason").isNull()).select(*columns)
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, done)
        edges, entries = _asked(edges, step), _entered(entries, step, reps)


def cluster_items(items: DataFrame) -> DataFrame:
    """Items with their story: story_id, reason, similarity and the founder's item id.

    ``items`` is classified without URL dedupe. ``reason`` is ``founder`` for the item
    that opened its story. The whole text that rules were matched against stays behind.
    """
    rows = materialize(story_features(items.drop("match_text")))
    reps = materialize(_representatives(rows))
    assigned = materialize(_assign(reps))
    founder = reps.select(
        "day", F.col("rep").alias("founder"), F.col("ord.o2").alias("founder_item_id"),
        ids.story_id(F.col("canon"), F.col("title_n")).alias("story_id"))
    placed = (reps.select(*COPY, "rep", F.col("ord").alias("_first"))
              .join(assigned, REP).join(founder, ["day", "founder"]))
    rows = rows.join(placed, COPY)
    first = F.col("ord") == F.col("_first")
    return (rows.withColumn("reason", F.when(first, F.col("reason")).otherwise("canonical_url"))
            .withColumn("similarity", F.when(first, F.col("similarity")).otherwise(1.0))
            .drop("rep", "founder", "_first"))


def merge_events(story_items: DataFrame) -> DataFrame:
    return (story_items.where(F.col("reason") != "founder")
            .select("day", "story_id", "source_item_id",
                    F.col("founder_item_id").alias("merged_into_source_item_id"), "reason",
                    F.round("similarity", 4).alias("similarity")))


# --- aggregates over stories ----------------------------------------------------
def _counted(rows: DataFrame, column: str, name: str) -> DataFrame:
    """Counts by a small vocabulary, as text ``value:count`` sorted by value."""
    counts = rows.groupBy("day", "story_id", F.coalesce(column, F.lit("unknown")).alias("_v")).agg(
        F.count("*").alias("_n"))
    return counts.groupBy("day", "story_id").agg(F.array_join(F.array_sort(F.collect_list(
        F.concat("_v", F.lit(":"), "_n"))), "|").alias(name))


def tier_rank(tier: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for pair in fixed.TIER_RANK.items() for x in pair])
    return F.coalesce(ranks[tier], F.lit(99))


def stories(story_items: DataFrame) -> DataFrame:
    """One row per story; the primary item is the best tier, newest, then by title."""
    order = F.struct(tier_rank(F.col("tier")), F.coalesce(-F.col("t"), F.lit(0)), "title", "ord")
    primary = F.min_by(F.struct(
        F.col("title").alias("title"), F.col("url").alias("primary_url"),
        F.col("source_item_id").alias("primary_source_item_id"),
        F.col("source_id").alias("primary_source_id")), order)
    base = story_items.groupBy("day", "story_id").agg(
        primary.alias("_p"), F.count("*").alias("item_count"),
        F.countDistinct("source_id").alias("source_count"),
        F.min("published_at").alias("earliest_at"), F.max("published_at").alias("latest_at"))
    # all three lie by story already: no broadcast, which would pass through the driver
    return (base.select("day", "story_id", "_p.*", "item_count", "source_count",
                        "earliest_at", "latest_at")
            .join(_counted(story_items, "tier", "evidence_tiers").hint("merge"), ["day", "story_id"])
            .join(_counted(story_items, "section", "sections").hint("merge"), ["day", "story_id"]))


def story_order() -> list[Column]:
    return [F.col("source_count").desc(), F.col("latest_at").desc_nulls_last(), F.col("title")]


def origin_records(items: DataFrame) -> DataFrame:
    """Where an item points: origin, carrier and independence group."""
    rows = computed(items, {"observed_url": safe_canonical(F.col("url")),
                            "external": safe_canonical(F.col("external_url"))})
    carriers = F.create_map(*[F.lit(x) for p in fixed.PLATFORM_CARRIERS.items() for x in p])
    host = url_host(F.col("observed_url"))
    carrier = F.coalesce(carriers[host], F.when(
        F.col("tier").isin("aggregator", "index", "radar", "finance"), F.col("tier")),
        F.lit("direct"))
    origin = F.when(F.col("external") != "", F.col("external")).otherwise(F.col("observed_url"))
    rows = computed(rows, {"carrier": carrier, "origin_url": origin})
    return (rows.withColumn("origin_domain", url_host(F.col("origin_url")))
            .withColumn("independence_group", F.when(
                F.col("origin_url") != "", ids.short_id("origin-", 20, F.col("origin_url")))
                .otherwise("unknown"))
            .withColumn("classification_basis", F.when(F.col("external") != "", "external_url")
                        .otherwise("observed_url")))


def independence(records: DataFrame, keys: tuple[str, ...] = ("day", "story_id")) -> DataFrame:
    """Distinct sources, carriers, domains and estimated independent origins."""
    unknown = F.col("independence_group") == "unknown"
    return records.groupBy(*keys).agg(
        F.count("*").alias("observation_count"),
        F.countDistinct("source_id").alias("coverage_count"),
        F.countDistinct("carrier").alias("carrier_type_count"),
        F.countDistinct(F.when(~unknown, F.col("independence_group")))
        .alias("estimated_independent_origin_count"),
        F.count(F.when(unknown, 1)).alias("unknown_origin_count"),
        F.countDistinct(F.when(F.col("origin_domain") != "", F.col("origin_domain")))
        .alias("origin_domain_count"))
