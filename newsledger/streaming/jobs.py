"""Streaming forms of the operators with memory.

Replaying the archive, one day per micro-batch, yields the same tables as the batch
operators; the micro-batch jobs call those operators on (state + new rows). Pages and the author
ledger keep keyed state with timers (``state``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from newsledger.functions import times
from newsledger.operators import authors, changes, claims
from newsledger.session import materialize
from newsledger.streaming.tables import BatchTable, run_batches

#: Folders of evidence identities.
IDENTITY_BUCKETS = 64


# --- snapshots -------------------------------------------------------------------
def snapshot_stream(spark: SparkSession, snapshots: DataFrame, values: Sequence[str],
                    folder: str, checkpoint: str, ratio: float = 0.5
                    ) -> tuple[StreamingQuery, BatchTable, BatchTable]:
    """New and changed keys per snapshot; a collapsed snapshot never becomes the state.

    Returns the query, the events and the rejected snapshot days.
    """
    columns = dict(snapshots.dtypes)
    row = ", ".join(f"{c} {columns[c]}" for c in ["day", "key", *values])
    event = row + ", " + ", ".join(f"prev_{v} {columns[v]}" for v in values) + ", event string"
    events = BatchTable(spark, f"{folder}/events", event)
    rejected = BatchTable(spark, f"{folder}/rejected", "day date, ratio double")
    state = BatchTable(spark, f"{folder}/state", row)

    def step(batch: DataFrame, number: int) -> None:
        known = materialize(state.previous(number))
        rows = materialize(known.unionByName(batch.select("day", "key", *values)))
        report = materialize(changes.guarded_snapshots(rows, ratio))
        good = report.where("accepted").select("day")
        accepted = rows.join(good, "day", "left_semi")
        found = changes.snapshot_diff(accepted, list(values))
        events.write(found.select(*[f.name for f in events.empty().schema]), number)
        rejected.write(report.where("not accepted").select("day", "ratio"), number)
        last = good.agg(F.max("day").alias("day"))
        state.write(accepted.join(last, "day", "left_semi"), number)

    return run_batches(snapshots, step, checkpoint), events, rejected


# --- ledgers ---------------------------------------------------------------------
def author_stream(spark: SparkSession, items: DataFrame, seeds: DataFrame | None, folder: str,
                  checkpoint: str) -> tuple[StreamingQuery, BatchTable]:
    """Author sightings, each post once per day; ledgers are views of this table."""
    table = BatchTable(spark, folder, "author STRING, status_id STRING, day DATE, handle STRING")

    def step(batch: DataFrame, number: int) -> None:
        new = authors.author_sightings(batch, seeds)
        seen = table.before(number).select("author", "status_id", "day")
        table.write(new.join(seen, ["author", "status_id", "day"], "left_anti")
                    .select("author", "status_id", "day", "handle"), number)

    return run_batches(items, step, checkpoint), table


def inbox_stream(spark: SparkSession, records: DataFrame, folder: str,
                 checkpoint: str) -> tuple[StreamingQuery, BatchTable, BatchTable]:
    """Valid new inbox rows, and the quarantine of invalid ones."""
    columns = ", ".join(f"{c} {t}" for c, t in records.dtypes if c != "id")
    table = BatchTable(spark, f"{folder}/rows", f"{columns}, identity string, id string")
    refused = BatchTable(spark, f"{folder}/refused", f"{columns}, errors array<string>")

    def step(batch: DataFrame, number: int) -> None:
        checked = materialize(claims.record_errors(batch.drop("id")))
        refused.write(checked.where(F.size("errors") > 0), number)
        valid = checked.where(F.size("errors") == 0).drop("errors")
        existing = table.before(number).drop("identity", "id")
        new = claims.inbox_additions(valid, existing)
        table.write(new.select(*[f.name for f in table.empty().schema]), number)

    return run_batches(records, step, checkpoint), table, refused


def identity_rows(rows: DataFrame, buckets: int) -> DataFrame:
    """Both identities of evidence as rows of their own (claim_id, by_capture, by_words, bucket)."""
    none = F.lit(None).cast("string")
    each = rows.select("claim_id", F.explode(F.array(
        F.struct(F.col("by_capture").alias("by_capture"), none.alias("by_words")),
        F.struct(none.alias("by_capture"), F.col("by_words").alias("by_words")))).alias("i"))
    each = each.select("claim_id", "i.*").where("by_capture is not null or by_words is not null")
    return each.withColumn("bucket", F.pmod(
        F.xxhash64("claim_id", "by_capture", "by_words"), F.lit(buckets)).cast("int"))


def evidence_stream(spark: SparkSession, additions: DataFrame, known: DataFrame, folder: str,
                    checkpoint: str, buckets: int = IDENTITY_BUCKETS
                    ) -> tuple[StreamingQuery, BatchTable, BatchTable]:
    """Outcomes of proposed evidence, and the identities that are taken.

    Taken identities lie in folders by a hash; a batch reads those of its own identities only.
    ``known`` are the claims.
    """
    columns = ", ".join(f"{c} {t}" for c, t in additions.dtypes)
    outcomes = BatchTable(spark, f"{folder}/outcomes", f"{columns}, outcome string")
    taken = BatchTable(spark, f"{folder}/identities",
                       "claim_id string, by_capture string, by_words string, bucket int")

    def step(batch: DataFrame, number: int) -> None:
        rows = materialize(claims.evidence_identities(batch))
        wanted = identity_rows(rows, buckets).select("bucket").distinct()
        only = [r.bucket for r in wanted.collect()]  # at most ``buckets``
        seen = taken.before(number, "bucket", only)
        found = materialize(claims.evidence_additions(rows.select(*batch.columns), seen, known))
        outcomes.write(found, number)
        added = claims.evidence_identities(found.where(F.col("outcome") == "added"))
        taken.write(identity_rows(added, buckets), number, "bucket")

    return run_batches(additions, step, checkpoint), outcomes, taken


# --- native state ----------------------------------------------------------------
def first_seen_stream(sightings: DataFrame, key: str, within: str | None = None) -> DataFrame:
    """Each key once. ``within`` bounds the state by the watermark of ``ts``."""
    if within is None:
        return sightings.dropDuplicates([key])
    return sightings.withWatermark("ts", within).dropDuplicatesWithinWatermark([key])


def status_counts_stream(log: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Daily tumbling counts of fetch status per source, final once a day is closed."""
    return (log.withWatermark("ts", lateness)
            .groupBy(F.window("ts", "1 day"), "source", "status").agg(F.count("*").alias("n"))
            .select(F.to_date("window.start").alias("day"), "source", "status", "n"))


def timely_items(items: DataFrame, window_days: int = 3) -> DataFrame:
    """Event time for a stream of items: undated ones count at their capture.

    Items older than the window at capture are dropped, as in the batch rule; future
    dates stay.
    """
    published = times.parse_published(F.col("published"))
    fetched = times.parse_published(F.col("fetched_at"))
    rows = items.withColumn("published_at", published)
    keep = F.col("published_at").isNull() | (
        F.col("published_at") >= F.to_timestamp(F.date_sub(F.col("day"), window_days)))
    return (rows.where(keep).withColumn("ts", F.coalesce("published_at", fetched))
            .withWatermark("ts", f"{window_days} days"))


def signal_match_stream(left: DataFrame, right: DataFrame, width_days: int = 30) -> DataFrame:
    """Sightings of a signal in two streams at most ``width_days`` apart.

    Both sides have signal, source and ts; watermarks and time bounds let Spark drop
    state that can no longer match.
    """
    wide = f"INTERVAL {width_days} DAYS"
    a = left.withWatermark("ts", "1 day").select(
        F.col("signal"), F.col("source").alias("source_a"), F.col("ts").alias("ts_a"))
    b = right.withWatermark("ts", "1 day").select(
        F.col("signal").alias("signal_b"), F.col("source").alias("source_b"),
        F.col("ts").alias("ts_b"))
    near = F.expr(f"signal = signal_b AND ts_b BETWEEN ts_a - {wide} AND ts_a + {wide} "
                  "AND source_a <> source_b")
    return a.join(b, near).drop("signal_b")
