"""Replaying an archive day by day gives the tables of the batch operators."""

import datetime as dt
import random

from pyspark.sql import functions as F

from newsledger.operators import authors as A, changes as C, claims
from newsledger.streaming import jobs as J, state as ST


def stream_of(spark, rows, folder, days):
    """A file stream that delivers one day per micro-batch."""
    for day in days:
        rows.where(F.to_date("at") == day).coalesce(1).write.mode("append").parquet(folder)
    return (spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
            .parquet(folder))


def days(n):
    return [dt.date(2026, 8, 1) + dt.timedelta(days=i) for i in range(n)]


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def run(frame, name, folder):
    query = (frame.writeStream.format("memory").queryName(name).outputMode("append")
             .option("checkpointLocation", folder).trigger(availableNow=True).start())
    query.awaitTermination(240)
    return query


def test_page_changes(spark, tmp_path):
    rng = random.Random(4)
    rows = [(f"s{s}", dt.datetime.combine(d, dt.time(hour=h)), rng.choice("ab"),
             rng.random() < 0.7) for s in range(3) for d in days(5) for h in (1, 13)]
    probes = spark.createDataFrame(
        rows, "source_id string, fetched_at timestamp, content_sha256 string, readable boolean")
    probes = probes.withColumn("at", F.col("fetched_at"))
    stream = stream_of(spark, probes, f"{tmp_path}/in", days(5))
    run(ST.page_change_stream(stream), "pages", f"{tmp_path}/ck")
    events = spark.table("pages")
    same(events, C.page_changes(probes.drop("at")).select(events.columns))


def test_author_ledger_with_eviction(spark, tmp_path):
    """Sightings over five months: after each day the state's ledger equals the batch ledger, and
    the timer takes forgotten authors out of the state."""
    rng, start = random.Random(7), dt.date(2026, 1, 1)
    rows = []
    for n in sorted(rng.sample(range(150), 12)) + [149]:
        day = start + dt.timedelta(days=n)
        rows += [(day, [f"x.com/A{rng.randrange(7)}/status/{rng.randrange(9)}"],
                  dt.datetime.combine(day, dt.time(2))) for _ in range(2)]
    rows += [(start, ["x.com/gone/status/1"], dt.datetime.combine(start, dt.time(2)))]
    items = spark.createDataFrame(rows, "day date, x_links array<string>, at timestamp")
    manual = A.manual_entries(spark.createDataFrame(
        [("a1", "", 1, False)], "handle string, provenance string, score int, "
                                "has_test_signal boolean"))
    seeds = spark.createDataFrame([("a3",)], "handle string")
    seen = sorted({r[0] for r in rows})
    stream = stream_of(spark, items, f"{tmp_path}/in", seen)
    query = run(ST.author_ledger_stream(stream, manual, seeds), "ledger", f"{tmp_path}/ck")
    events = spark.table("ledger").cache()
    sightings = A.author_sightings(items, seeds).cache()
    for day in seen:
        as_of = F.lit(day)
        batch = A.author_ledger(A.current_sightings(sightings, manual, as_of), manual)
        same(ST.ledger_at(events, as_of),
             batch.where("posts > 0").select("author", "posts", F.col("last_day")))
    gone = {r.author for r in events.where("evicted").collect()}
    assert "gone" in gone
    operator = query.lastProgress["stateOperators"][0]
    alive = ST.ledger_at(events, F.lit(seen[-1])).count()
    assert operator["numRowsTotal"] <= 40 and alive < 7 + 1


def test_snapshots_with_guard(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for i, d in enumerate(days(6)):
        keys = range(10) if i != 3 else range(2)
        rows += [(d, f"k{k}", float(rng.randrange(3)), dt.datetime.combine(d, dt.time(1)))
                 for k in keys if rng.random() < 0.95]
    snaps = spark.createDataFrame(rows, "day date, key string, price double, at timestamp")
    stream = stream_of(spark, snaps, f"{tmp_path}/in", days(6))
    query, events, rejected = J.snapshot_stream(
        spark, stream, ["price"], f"{tmp_path}/out", f"{tmp_path}/ck")
    query.awaitTermination(240)
    good = [r["day"] for r in C.guarded_snapshots(snaps).where("accepted").collect()]
    assert [r["day"] for r in rejected.read().collect()] == [days(6)[3]]
    names = [f.name for f in events.empty().schema]
    batch = C.snapshot_diff(snaps.where(F.col("day").isin(good)), ["price"]).select(names)
    same(events.read().select(names), batch)


def test_authors(spark, tmp_path):
    rng = random.Random(6)
    rows = [(d, [f"x.com/A{rng.randrange(4)}/status/{rng.randrange(6)}"],
             dt.datetime.combine(d, dt.time(2))) for d in days(4) for _ in range(5)]
    items = spark.createDataFrame(rows, "day date, x_links array<string>, at timestamp")
    seeds = spark.createDataFrame([("a3",)], "handle string")
    stream = stream_of(spark, items, f"{tmp_path}/in", days(4))
    query, table = J.author_stream(spark, stream, seeds, f"{tmp_path}/out", f"{tmp_path}/ck")
    query.awaitTermination(240)
    columns = ["author", "status_id", "day", "handle"]
    same(table.read().select(columns), A.author_sightings(items, seeds).select(columns))


def test_status_counts_and_first_seen(spark, tmp_path):
    rows = [(dt.datetime.combine(d, dt.time(h)), f"s{h % 2}", "ok" if h % 3 else "error", f"k{h}")
            for d in days(4) for h in range(0, 24, 5)]
    log = spark.createDataFrame(rows, "ts timestamp, source string, status string, key string")
    log = log.withColumn("at", F.col("ts"))
    stream = stream_of(spark, log, f"{tmp_path}/in", days(4))
    counts = J.status_counts_stream(stream)
    (counts.writeStream.format("memory").queryName("counts").outputMode("append")
     .option("checkpointLocation", f"{tmp_path}/c1").trigger(availableNow=True).start()
     .awaitTermination(240))
    got = spark.table("counts")
    closed = got.agg(F.max("day")).first()[0]
    batch = (log.groupBy(F.to_date("ts").alias("day"), "source", "status")
             .agg(F.count("*").alias("n")).where(F.col("day") <= closed))
    same(got, batch)
    (J.first_seen_stream(stream, "key").writeStream.format("memory").queryName("seen")
     .option("checkpointLocation", f"{tmp_path}/c2").trigger(availableNow=True).start()
     .awaitTermination(240))
    assert spark.table("seen").count() == log.select("key").distinct().count()


def test_signal_match_stream(spark, tmp_path):
    def side(name, rows):
        frame = spark.createDataFrame(rows, "signal string, source string, ts timestamp")
        frame.coalesce(1).write.parquet(f"{tmp_path}/{name}")
        return spark.readStream.schema(frame.schema).parquet(f"{tmp_path}/{name}")
    at = dt.datetime(2026, 8, 1)
    left = side("l", [("x", "a", at), ("y", "a", at)])
    right = side("r", [("x", "b", at + dt.timedelta(days=29)), ("y", "b", at + dt.timedelta(days=31)),
                       ("x", "a", at)])
    (J.signal_match_stream(left, right).writeStream.format("memory").queryName("near")
     .option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
     .awaitTermination(240))
    assert [(r["signal"], r["source_b"]) for r in spark.table("near").collect()] == [("x", "b")]


def test_inbox(spark, tmp_path):
    base = dict(date=dt.date(2026, 8, 1), source_type="forum", why_it_matters="w",
                main_alternative="m", next_check="n", action="watch_signal",
                source_item_id="src:item1", candidate_key=None, matched_claim="c1", title="t")
    rows = []
    for i, d in enumerate(days(3)):
        for j, url in enumerate(["https://a.com/x?utm_source=1", "https://a.com/x", "nope"]):
            rows.append({**base, "url": url, "batch_ord": i * 10 + j, "snapshot_hash": str(i % 2) * 64,
                         "at": dt.datetime.combine(d, dt.time(3))})
    schema = ("batch_ord int, date date, title string, url string, source_type string, "
              "matched_claim string, candidate_key string, why_it_matters string, "
              "main_alternative string, next_check string, action string, "
              "source_item_id string, snapshot_hash string, at timestamp")
    records = spark.createDataFrame(rows, schema)
    stream = stream_of(spark, records, f"{tmp_path}/in", days(3))
    query, table, refused = J.inbox_stream(spark, stream, f"{tmp_path}/out", f"{tmp_path}/ck")
    query.awaitTermination(240)
    assert sorted(r["batch_ord"] for r in table.read().collect()) == [0, 10]
    assert refused.read().count() == 3


def test_evidence(spark, tmp_path):
    """Three days of proposals end as one batch in their order would; a batch reads only the
    folders of its own identities."""
    rng, rows = random.Random(12), []
    for i, d in enumerate(days(3)):
        for j in range(40):
            has = rng.random() < 0.8
            rows.append((f"c{rng.randrange(4)}", i * 100 + j, "src", "forum", "support",
                         f"v{rng.randrange(15)}", "https://a.com/x", d,
                         f"s:item{rng.randrange(20)}" if has else None, "0" * 64 if has else None,
                         dt.datetime.combine(d, dt.time(3))))
    frame = spark.createDataFrame(rows, (
        "claim_id string, batch_ord int, src string, type string, stance string, verdict string, "
        "link string, date date, source_item_id string, snapshot_hash string, at timestamp"))
    # wording carries the date: equal words of another day are another identity
    frame = frame.withColumn("date", F.lit(days(1)[0]))
    known = spark.createDataFrame([("c0", None), ("c1", None), ("c2", "guard")],
                                  "id string, ledger_ref string")
    stream = stream_of(spark, frame, f"{tmp_path}/in", days(3))
    query, outcomes, taken = J.evidence_stream(spark, stream, known, f"{tmp_path}/out",
                                               f"{tmp_path}/ck")
    query.awaitTermination(300)
    empty = frame.limit(0)
    batch = claims.evidence_additions(frame, empty, known).select("batch_ord", "outcome")
    same(outcomes.read().select("batch_ord", "outcome"), batch)
    assert {r.outcome for r in batch.select("outcome").distinct().collect()} == {
        "added", "duplicate", "unknown claim", "guarded claim"}
    some = [r.bucket for r in taken.read().select("bucket").distinct().limit(2).collect()]
    read = taken.before(3, "bucket", some)
    paths = [r[0] for r in read.select("_metadata.file_path").distinct().collect()]
    assert paths and all(any(f"bucket={b}/" in p for b in some) for p in paths)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
