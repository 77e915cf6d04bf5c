"""Readers, parsers and writers on small landed files."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from newsledger.operators import changes as C, health as H
from newsledger.sources import apis, captures, feeds, sinks


def archive(tmp_path):
    root = tmp_path / "raw"
    for day in ("2026-08-01", "2026-08-02"):
        folder = root / f"day={day}"
        folder.mkdir(parents=True)
        for source in ("beta", "alpha"):
            items = [{"title": f"{source} {i}", "url": f"https://a.com/{source}/{i}"} for i in range(2)]
            (folder / f"{source}.json").write_text(json.dumps(
                {"source": source, "name": source, "tier": "official",
                 "fetched_at": f"{day}T10:00:00Z", "items": items}))
        (folder / "fetch_log.json").write_text(json.dumps(
            {"date": day, "run_mode": "full", "fetched_at": f"{day}T10:00:00Z",
             "sources": {"alpha": {"status": "ok", "items": 2}, "beta": {"status": "error"}}}))
    return str(root)


def test_captures_and_log(spark, tmp_path):
    root = archive(tmp_path)
    rows = captures.read_captures(spark, root, first="2026-08-02")
    assert {(str(r["day"]), r["source"]) for r in rows.collect()} == {
        ("2026-08-02", "alpha"), ("2026-08-02", "beta")}
    items = captures.observations(captures.read_captures(spark, root))
    assert items.count() == 8
    order = [r["title"] for r in items.where("day = '2026-08-01'").orderBy("payload_ord", "item_ord").collect()]
    assert order == ["alpha 0", "alpha 1", "beta 0", "beta 1"]
    log = captures.read_fetch_log(spark, root, last="2026-08-01").collect()
    assert {(r["source"], r["status"]) for r in log} == {("alpha", "ok"), ("beta", "error")}


def test_broken_files(spark, tmp_path):
    root = archive(tmp_path)
    (tmp_path / "raw" / "day=2026-08-02" / "broken.json").write_text('{"source": "x", "items": [')
    assert captures.read_audit_samples(spark, root, "2026-08-02").count() == 4
    with pytest.raises(Exception):
        captures.read_captures(spark, root).collect()


def test_collection_hash_follows_content_not_time(spark, tmp_path):
    root = archive(tmp_path)
    rows = captures.collection_identity(captures.read_captures(spark, root)).collect()
    by_source = {}
    for r in rows:
        by_source.setdefault(r["collection_id"], set()).add(r["collection_hash"])
    assert set(by_source) == {"alpha:collection", "beta:collection"}
    assert all(len(h) == 1 for h in by_source.values())
    import hashlib
    body = json.dumps({"source": "alpha", "items": [
        {"title": f"alpha {i}", "url": f"https://a.com/alpha/{i}", "published": "", "summary": "",
         "content_sha256": "", "external_url": "", "x_links": []} for i in range(2)]},
        sort_keys=True, separators=(",", ":"))
    assert by_source["alpha:collection"] == {hashlib.sha256(body.encode()).hexdigest()}


RSS = b"""<?xml version="1.0"?><rss xmlns="http://x" xmlns:content="http://purl.org/rss/1.0/modules/content/"
 xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><item><title>One</title><link>https://a.com/1</link>
<dc:date>2026-08-01</dc:date><description>&lt;p&gt;short&lt;/p&gt;</description>
<content:encoded>&lt;a href="/p"&gt;x&lt;/a&gt; https://x.com/Ann/status/5</content:encoded></item></channel></rss>"""
ATOM = b"""<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Two</title><link href="https://b.com/2"/>
<link href="https://b.com/other"/><published>2026-01-01</published><updated>2026-08-02</updated>
<content>body</content></entry></feed>"""


def test_feeds(spark):
    bodies = spark.createDataFrame([("r", "t", bytearray(RSS)), ("a", "t", bytearray(ATOM)),
                                    ("z", "t", bytearray(b"<rss"))],
                                   "source_id string, fetched_at string, body binary")
    entries = feeds.parse_feeds(bodies)
    assert entries.where("error is not null").count() == 1
    rows = {r["source_id"]: r for r in feeds.feed_items(entries).collect()}
    assert rows["r"]["published"] == "2026-08-01" and rows["r"]["summary"] == "short"
    assert rows["r"]["external_urls"] == ["https://a.com/p", "https://x.com/Ann/status/5"]
    assert rows["r"]["x_links"] == ["x.com/Ann/status/5"]
    assert (rows["a"]["url"], rows["a"]["published"]) == ("https://b.com/2", "2026-08-02")


def body(spark, value, **columns):
    row = {"source_id": "s", **columns, "body": json.dumps(value)}
    return spark.createDataFrame([row])


def test_api_bodies(spark):
    hit = {"objectID": "7", "title": "t", "points": 3, "num_comments": 1}
    rows = body(spark, {"hits": [hit, {**hit, "objectID": "8"}]}, query="q1", query_ord=0).unionByName(
        body(spark, {"hits": [hit]}, query="q2", query_ord=1))
    found = apis.search_hits(rows).collect()
    assert {(r["url"][-1], r["matched_query"], r["summary"]) for r in found} == {
        ("7", "q1", "3 points, 1 comments"), ("8", "q1", "3 points, 1 comments")}
    assert apis.hub_models(body(spark, [{"modelId": "a/b", "likes": 2}])).first()["summary"] == (
        "likes=2 downloads=None trending=None")
    paper = apis.hub_papers(body(spark, [{"publishedAt": "d", "paper": {"id": "1", "title": "p",
                                                                        "summary": "<b>x</b>"}}])).first()
    assert (paper["url"], paper["published"], paper["summary"]) == ("https://huggingface.co/papers/1", "d", "x")
    repo = {"full_name": "a/b", "html_url": "u", "stargazers_count": 5, "description": "d"}
    assert apis.repositories(body(spark, [repo])).first()["title"] == "a/b"
    searched = body(spark, {"items": [repo, {**repo, "full_name": "old"}]}, query="q", query_ord=0)
    known = spark.createDataFrame([("old",)], "full_name string")
    assert [r["full_name"] for r in apis.repository_search(searched, known).collect()] == ["a/b"]


def test_incidents_and_quotes(spark):
    def status(value):
        return apis.incidents(body(spark, value, name="N", url="https://s.com", fetched_at="t")).collect()
    assert status({"status": {"indicator": "none"}, "incidents": []}) == []
    assert status({"status": {"indicator": "minor", "description": "slow"}})[0]["title"] == "[服务事故] N: slow"
    one = status({"incidents": [{"name": "x", "impact": "major", "status": "open",
                                 "incident_updates": [{"body": "<p>hi</p>"}]}]})[0]
    assert (one["title"], one["summary"], one["url"]) == ("[服务事故] N: x（major/open）", "hi", "https://s.com")
    quote = apis.quotes(body(spark, {"symbol": "X", "price": 2.0, "timestamp": [0, 86400, 172800],
                                     "close": [1.0, None, 1.5]})).first()
    assert quote["change_pct"] == pytest.approx(50.0) and quote["closes"] == "1970-01-01: 1.00，1970-01-03: 1.50"


def test_price_catalog_and_filter(spark):
    catalog = [{"id": "deepseek", "name": "DeepSeek", "pricing_urls": ["", "https://p.com"], "models": [
        {"id": "v4", "name": "DeepSeek V4", "prices": [{"prices": {"input_mtok": 1}},
                                                       {"constraint": {"a": 1}, "prices": {"input_mtok": 2}}]},
        {"id": "none", "prices": None}, {"id": "", "prices": {}}]},
        {"id": "other", "models": [{"id": "x", "prices": {"input_mtok": 1}}]}]
    rows = apis.price_catalog(body(spark, catalog), ["DeepSeek-V4"]).collect()
    assert [(r["key"], r["pricing_url"], len(json.loads(r["prices"]))) for r in rows] == [
        ("deepseek/v4", "https://p.com", 2)]
    listed = apis.listed_prices(body(spark, {"data": [
        {"id": "glm", "pricing": {"prompt": "0.0000012", "completion": None}},
        {"id": "glm-x", "pricing": {"prompt": "abc"}}, {"id": "zzz", "pricing": {}}]}), ["GLM"])
    assert [(r["id"], r["prompt"], r["completion"]) for r in listed.collect()] == [("glm", 1.2, 0.0)]
    items = spark.createDataFrame([("a GLM", "x"), ("b", "y")], "title string, summary string")
    assert apis.keep_if_contains(items, F.array(F.lit("glm"))).count() == 1
    assert apis.keep_if_contains(items, F.array().cast("array<string>")).count() == 2


def test_write_if_changed_and_manifest(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([(dt.date(2026, 8, d), v) for d in (1, 2) for v in (1, 2)], "day date, v int")
    assert sinks.write_if_changed(rows, path) == 2
    assert sinks.write_if_changed(rows, path) == 0
    files = sinks.manifest(spark, path, "*.parquet")
    before = spark.createDataFrame(files.collect(), files.schema)
    changed = rows.withColumn("v", F.when((F.col("day") == "2026-08-02") & (F.col("v") == 2), 9)
                              .otherwise(F.col("v")))
    assert sinks.write_if_changed(changed, path) == 1
    assert spark.read.parquet(path).agg(F.sum("v")).first()[0] == 13
    after = sinks.manifest(spark, path, "*.parquet")
    failures = {r["failure"] for r in sinks.manifest_diff(before, after).collect()}
    assert failures == {"missing", "extra"}
    assert sinks.manifest_diff(after, after).count() == 0


def test_unchanged_days_are_not_read_again(spark, tmp_path):
    path = tmp_path / "table"
    rows = spark.createDataFrame([(dt.date(2026, 8, d), v) for d in (1, 2) for v in (1, 2)],
                                 "day date, v int")
    assert sinks.write_if_changed(rows, str(path)) == 2
    for file in (path / "day=2026-08-01").glob("*.parquet"):
        file.write_bytes(b"no parquet file")  # reading it would fail
    for crc in (path / "day=2026-08-01").glob(".*.crc"):
        crc.write_bytes(b"")
    changed = rows.where("day = date'2026-08-02'").withColumn("v", F.lit(5)).unionByName(
        rows.where("day = date'2026-08-01'"))
    assert sinks.write_if_changed(changed, str(path)) == 1
    kept = spark.read.parquet(f"{path}/day=2026-08-02")
    assert [r[0] for r in kept.collect()] == [5, 5]
    # a run that broke off after taking its fingerprints back is made good
    marks = spark.read.parquet(f"{path}.fingerprints").where("day = date'2026-08-02'")
    sinks._store(sinks.materialize(marks.withColumn("rows", F.lit(-1).cast("long"))),
                 f"{path}.fingerprints", "day")
    assert sinks.write_if_changed(changed, str(path)) == 1
    assert sinks.write_if_changed(changed, str(path)) == 0


def test_malformed_inbox_line_is_named(spark, tmp_path):
    good = '{"id": "%d", "date": "2026-0%d-02", "title": "t"}'
    for month in (7, 8):
        folder = tmp_path / f"month=2026-0{month}"
        folder.mkdir()
        lines = [good % (i, month) for i in range(3000)]
        if month == 8:
            lines[1700] = '{"id": "x", "date": '
            lines[2900] = "[1]"
        (folder / "rows.json").write_text("\n".join(lines) + "\n\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # several blocks a file
    try:
        assert captures.read_inbox(spark, str(tmp_path), last="2026-07-31").count() == 3000
        with pytest.raises(ValueError, match=r"month=2026-08/rows\.json:1701$"):
            captures.read_inbox(spark, str(tmp_path), first="2026-08-01")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_page_changes(spark):
    at = dt.datetime(2026, 8, 1)
    bodies = ["<p>price $5</p><script>1</script>", "<p>price $5</p><script>2</script>", "<p>login</p>",
              "<p>login again</p>", "<p>price $6</p>", "<p>price $7</p>"]
    pages = spark.createDataFrame(
        [("s", "S", at + dt.timedelta(days=i), b, "html", ["\\$\\d"]) for i, b in enumerate(bodies)],
        "source_id string, name string, fetched_at timestamp, body string, content_format string, "
        "required_patterns array<string>")
    rows = C.page_items(C.page_changes(C.page_probe(pages))).orderBy("fetched_at").collect()
    assert [(r["kind"], r["changed"]) for r in rows] == [
        ("snapshot", True), ("snapshot", False), ("unreadable", True), ("unreadable", False),
        ("recovered", True), ("updated", True)]
    assert rows[1]["published"] == at and rows[3]["published"] == at + dt.timedelta(days=2)
    assert rows[2]["title"].startswith("[页面不可读]") and "探针盲区" in rows[2]["summary"]


def test_source_health_attempts(spark):
    days = [dt.date(2026, 8, d) for d in (1, 2, 3)]
    log = spark.createDataFrame([("a", days[0], "ok", "t1"), ("a", days[1], "error", "t2"), ("b", days[0], "skipped", "t1"),
                                 ("b", days[1], "cached", "t2"), ("c", days[0], "deferred", "t1"), ("c", days[1], "gone", "t2"),
                                 ("c", days[2], "partial", "t3")],
                                "source string, day date, status string, fetched_at string")
    rows = {r["source"]: r for r in H.source_health(log.select("source").distinct(), H.log_health(log), H.raw_health(
        spark.createDataFrame([], "source string, day date")), spark.createDataFrame(
        [], "source string, qualified_observations long")).collect()}
    assert (rows["a"]["attempt_days"], rows["a"]["success_rate"], rows["a"]["last_success_at"]) == (2, 0.5, "t1")
    assert (rows["b"]["attempt_days"], rows["b"]["success_rate"]) == (0, None)
    assert (rows["c"]["attempt_days"], rows["c"]["success_rate"]) == (1, 0.0)


def test_nulls_keep_their_place_in_fingerprints(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "day string, a long, b long"
    first = spark.createDataFrame([("d", 1, None)], schema)
    second = spark.createDataFrame([("d", None, 1)], schema)
    assert sinks.write_if_changed(first, path) == 1
    assert sinks.write_if_changed(first, path) == 0
    assert sinks.write_if_changed(second, path) == 1
    assert [tuple(r) for r in spark.read.schema(schema).parquet(path).select(
        "day", "a", "b").collect()] == [("d", None, 1)]


def test_feed_forms(spark):
    rdf = (b'<rdf:RDF xmlns:rdf="r"><channel><title>c</title></channel><item><title> A </title>'
           b"<link>https://a.com/</link><pubDate> </pubDate></item><item/></rdf:RDF>")
    atom = (b'<feed><entry><title type="html">T</title><summary>s</summary><content type="html">'
            b"&lt;b&gt;c&lt;/b&gt;</content></entry></feed>")
    bodies = spark.createDataFrame(
        [("r", "t", bytearray(rdf)), ("a", "t", bytearray(atom)), ("n", "t", None),
         ("e", "t", bytearray(b"<rss><channel/></rss>"))],
        "source_id string, fetched_at string, body binary")
    rows = feeds.parse_feeds(bodies).collect()
    got = {(r["source_id"], r["item_ord"]): r for r in rows}
    assert (got["r", 0]["title"], got["r", 0]["url"], got["r", 0]["published"]) == (
        "A", "https://a.com/", "")
    assert got["r", 1]["title"] == "" and got["a", 0]["fulltext"] == "s <b>c</b>"
    assert got["n", -1]["error"] and not any(k[0] == "e" for k in got)
