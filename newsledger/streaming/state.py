"""Keyed state with timers: pages and the author ledger as running streams.

State lies in Spark's RocksDB store, which writes what a micro-batch changed, so a batch costs
its own rows and not the size of the state. Event time is the day of a sighting or the time of a
capture; rows may come late by ``lateness``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from newsledger.operators import authors

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PAGE_EVENT = ("source_id string, fetched_at timestamp, content_sha256 string, readable boolean, "
              "changed boolean, kind string, published timestamp")
LEDGER_EVENT = ("author string, day date, posts long, last_day date, firm boolean, "
                "evicted boolean")
DAY_MS = 86_400_000


def keyed_state(spark: SparkSession) -> SparkSession:
    """Choose the state store that keyed state with timers needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    return spark


class Pages(StatefulProcessor):
    """Per page: the last capture, and when the page last changed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState(
            "last", "content_sha256 string, readable boolean, published timestamp")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.last.get() if self.last.exists() else None
        for row in sorted(rows, key=lambda r: r.fetched_at):
            if held is None:
                changed, kind = True, "snapshot" if row.readable else "unreadable"
            else:
                text, was, published = held
                changed = (was if not row.readable else
                           not was or text != row.content_sha256)
                kind = ("unreadable" if not row.readable else "recovered" if not was
                        else "updated" if changed else "snapshot")
            held = (row.content_sha256, row.readable, row.fetched_at if changed else published)
            yield Row(source_id=key[0], fetched_at=row.fetched_at,
                      content_sha256=row.content_sha256, readable=row.readable, changed=changed,
                      kind=kind, published=held[2])
        if held is not None:
            self.last.update(held)

    def close(self) -> None:
        pass


def page_change_stream(probes: DataFrame) -> DataFrame:
    """One event per capture (source_id, fetched_at, content_sha256, readable) with changed, kind
    and published, as ``changes.page_changes`` has them."""
    keyed_state(probes.sparkSession)
    return (probes.select("source_id", "fetched_at", "content_sha256", "readable")
            .groupBy("source_id").transformWithState(Pages(), PAGE_EVENT, "Append", "None"))


class Ledger(StatefulProcessor):
    """Per author: distinct posts of the running stretch, the last day, and whether the entry
    is firm. A timer forgets an author with one post after ``FORGET_DAYS`` unseen days."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", "posts long, last_day date, firm boolean")
        self.posts = handle.getMapState("posts", "status_id string", "day date")

    def _forget(self) -> None:
        self.entry.clear()
        self.posts.clear()

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        count, last, firm = self.entry.get() if self.entry.exists() else (0, None, False)
        for row in sorted(rows, key=lambda r: (r.day, r.status_id)):
            if last and not firm and (row.day - last).days > authors.FORGET_DAYS:
                self._forget()
                count, last = 0, None
            if not self.posts.containsKey((row.status_id,)):
                self.posts.updateValue((row.status_id,), (row.day,))
                count += 1
            last = max(last or row.day, row.day)
            firm = firm or count + row.manual_count >= 2
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.entry.update((count, last, firm))
        if not firm:
            due = last + dt.timedelta(days=authors.FORGET_DAYS + 1)
            self.handle.registerTimer(
                (due - dt.date(1970, 1, 1)).days * DAY_MS)
        yield Row(author=key[0], day=last, posts=count, last_day=last, firm=firm, evicted=False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.entry.exists():
            count, last, firm = self.entry.get()
            if not firm:
                self._forget()
                yield Row(author=key[0], day=last + dt.timedelta(days=authors.FORGET_DAYS + 1),
                          posts=count, last_day=last, firm=False, evicted=True)

    def close(self) -> None:
        pass


def author_ledger_stream(items: DataFrame, manual: DataFrame, seeds: DataFrame | None = None,
                         lateness: str = "0 seconds") -> DataFrame:
    """Changes of the author ledger (author, posts, last_day, firm, evicted).

    ``items`` has day and x_links; ``manual`` is what ``authors.manual_entries`` returns.
    """
    keyed_state(items.sparkSession)
    rows = authors.cited_posts(items, seeds)
    base = manual.select("author", F.col("manual_count").cast("long"))
    rows = (rows.join(base, "author", "left").fillna(0, ["manual_count"])
            .withColumn("ts", F.col("day").cast("timestamp")).withWatermark("ts", lateness))
    return rows.groupBy("author").transformWithState(Ledger(), LEDGER_EVENT, "Append",
                                                     "EventTime")


def ledger_at(events: DataFrame, as_of) -> DataFrame:
    """(author, posts, last_day): the ledger at a day, from the changes up to it."""
    newest = events.where(F.col("day") <= as_of).groupBy("author").agg(
        F.max_by(F.struct("posts", "last_day", "firm", "evicted"),
                 F.struct("day", ~F.col("evicted"), "posts")).alias("e")).select("author", "e.*")
    # the timer fires with the next rows; until then the same rule reads the entry as gone
    seen = F.datediff(as_of, "last_day") <= authors.FORGET_DAYS
    return newest.where(~F.col("evicted") & (F.col("firm") | seen)).select(
        "author", "posts", "last_day")
