"""WARC derivatives: metadata and plain-text conversion records for response records.

``responses`` frames pages as WARC response records. ``derive`` turns each response into two
records that refer to it: a metadata record with what the source's headers and markup say
(title, language, links, digests of the source) and a conversion record with its plain
text. Record ids are digests of content, so a rerun or a repeated task writes the same ones.
``write`` and ``read`` keep records as WARC/1.1 text, one file a partition.

Defined results: null url leaves out the target headers, null html is an empty payload, a null
page_id stays null. Repeated rows give repeated records with equal ids. Empty tables give
empty results.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Capture time of pages that state none.
DATE = "1970-01-01T00:00:00Z"
VERSION = "WARC/1.1"
END = "\r\n\r\n"

_OPENED = re.compile(r"<!--|<(script|style|noscript|template|head)\b", re.I)
_BREAK = re.compile(r"<(?:/?(?:p|div|article|section|header|footer|nav|ul|ol|li|table|tr|h[1-6]|"
                    r"blockquote|pre|form|main|aside)|br|hr)\b[^>]*>", re.I)
_TAG = re.compile(r"<[^>]*>")
_TITLE, _TITLE_END = re.compile(r"<title[^>]*>", re.I), re.compile(r"</title\s*>", re.I)
_HTML, _LANG = (re.compile(r"<html\b", re.I),
                re.compile(r"\b(?=lang\s*=\s*[\"']?([A-Za-z-]+))", re.I))
_META, _CHARSET = (re.compile(r"<meta\b", re.I),
                   re.compile(r"\b(?=charset\s*=\s*[\"']?([\w-]+))", re.I))
_ANCHOR, _HREF = re.compile(r"<a\b", re.I), re.compile(r"\bhref\s*=\s*", re.I)
_BARE = re.compile(r"[^\s>]+")

RECORD = ("page_id long, record_type string, record_id string, refers_to string, "
          "target_uri string, content_type string, payload_digest string, block_digest string, "
          "content_length long, headers string, block string")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    made = hashlib.md5("\x00".join(parts).encode("utf-8", "surrogatepass")).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=made, version=3)}>"


def _without_hidden(page: str) -> str:
    """Comments and elements that are not shown become a space. A kind whose end was once not
    found has none further on, so the text is read once."""
    out, at, look, endless = [], 0, 0, set()
    while opened := _OPENED.search(page, look):
        kind = (opened[1] or "").lower()
        end = -1
        if kind not in endless:
            if kind:
                closed = re.compile(rf"</{kind}\s*>", re.I).search(page, opened.end())
                end = closed.end() if closed else -1
            else:
                end = page.find("-->", opened.end())
                end += 3 if end >= 0 else 0
        if end < 0:
            endless.add(kind)
            look = opened.end()
            continue
        out += [page[at:opened.start()], " "]
        at = look = end
    return "".join([*out, page[at:]])


def plain_text(page: str) -> str:
    """The visible text: blocks on lines of their own, runs of white space as one space."""
    shown = _without_hidden(page)
    last = shown.rfind(">") + 1  # every tag in front of it ends: no search runs to the end
    text = _TAG.sub("", _BREAK.sub("\n", shown[:last])) + shown[last:]
    lines = (" ".join(line.split()) for line in html.unescape(text).split("\n"))
    return "\n".join(line for line in lines if line)


def _title(page: str) -> str | None:
    opened = _TITLE.search(page, 0, page.rfind(">") + 1)
    closed = _TITLE_END.search(page, opened.end()) if opened else None
    return page[opened.end():closed.start()] if closed else None


def _attribute(page: str, tag: re.Pattern, value: re.Pattern) -> str | None:
    """The last value of an attribute in the first tag that has it."""
    at = 0
    while opened := tag.search(page, at):
        end = page.find(">", opened.end())
        end = len(page) if end < 0 else end
        if found := list(value.finditer(page, opened.end(), end)):
            return found[-1][1]
        at = end
    return None


def _links(page: str) -> Iterator[str]:
    """The last href of every anchor; a quoted one may hold the end of a tag."""
    at, last = 0, {q: page.rfind(q) for q in "\"'"}
    while opened := _ANCHOR.search(page, at):
        end = page.find(">", opened.end())
        end = len(page) if end < 0 else end
        at = end
        for place in reversed([m.end() for m in _HREF.finditer(page, opened.end(), end)]):
            quote = page[place:place + 1]
            if quote in last and last[quote] > place:
                at = page.index(quote, place + 1) + 1
                yield page[place + 1:at - 1]
                break
            if bare := _BARE.match(page, place):
                at = bare.end()
                yield bare[0]
                break


def warc_fields(page: str, url: str | None, http: str, source_digest: str) -> str:
    """The body of a metadata record."""
    out = []
    for name, found in (("title", _title(page)), ("language", _attribute(page, _HTML, _LANG)),
                        ("charset", _attribute(page, _META, _CHARSET))):
        if found is not None:
            out.append((name, " ".join(html.unescape(found).split())))
    out += [("http-" + k.lower(), v) for k, _, v in
            (line.partition(": ") for line in http.split("\r\n")[1:]) if v]
    out.append(("source-payload-digest", source_digest))
    for link in _links(page):
        href = html.unescape(link).strip()
        try:
            target = urljoin(url or "", href)
        except ValueError:
            target = href
        out.append(("outlink", "".join(target.split())))
    return "".join(f"{k}: {v}\r\n" for k, v in out)


def record(page_id, kind: str, own_id: str, refers_to: str | None, url: str | None, date: str,
           content_type: str, payload: bytes, block: str, block_bytes: bytes) -> tuple:
    named = [("WARC-Type", kind), ("WARC-Record-ID", own_id), ("WARC-Date", date),
             ("WARC-Target-URI", url)]
    if refers_to:
        named += [("WARC-Refers-To", refers_to), ("WARC-Refers-To-Target-URI", url),
                  ("WARC-Refers-To-Date", date)]
    payload_digest, block_digest = digest(payload), digest(block_bytes)
    named += [("Content-Type", content_type), ("WARC-Payload-Digest", payload_digest),
              ("WARC-Block-Digest", block_digest), ("Content-Length", str(len(block_bytes)))]
    headers = VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in named if v is not None)
    return (page_id, kind, own_id, refers_to, url, content_type, payload_digest, block_digest,
            len(block_bytes), headers, block)


def _one_line(value: str | None) -> str | None:
    return None if value is None else "".join(value.split())


def _response(page_id, url, page) -> tuple:
    body = (page or "").encode("utf-8", "surrogatepass")
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(body)}")
    block = f"{http}\r\n\r\n{page or ''}"
    url = _one_line(url)
    return record(page_id, "response", record_id("response", url or "", page or "",
                                                 str(page_id)),
                  None, url, DATE, "application/http; msgtype=response", body, block,
                  block.encode("utf-8", "surrogatepass"))


def _derived(row: dict) -> Iterator[tuple]:
    http, _, page = row["block"].partition("\r\n\r\n")
    source, url = row["record_id"], row["target_uri"]
    date = re.search(r"^WARC-Date: (.*?)\r?$", row["headers"], re.M)
    date = date[1] if date else DATE
    fields = warc_fields(page, url, http, row["payload_digest"])
    text = plain_text(page)
    for kind, body, content_type in (("metadata", fields, "application/warc-fields"),
                                     ("conversion", text, "text/plain; charset=utf-8")):
        data = body.encode("utf-8", "surrogatepass")
        yield record(row["page_id"], kind, record_id(kind, source), source, url, date,
                     content_type, data, body, data)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


SCHEMA = pa.schema([
    (part.split()[0], {"long": pa.int64(), "string": pa.string()}[part.split()[1]])
    for part in RECORD.split(", ")])


def responses(pages: DataFrame) -> DataFrame:
    """Pages (page_id, url, html) as response records."""
    def run(batches):
        for batch in batches:
            yield _batch([_response(*row) for row in zip(*(c.to_pylist() for c in batch))],
                         SCHEMA)
    return pages.select(pages["page_id"], pages["url"], pages["html"]).mapInArrow(run, RECORD)


def derive(records: DataFrame) -> DataFrame:
    """A metadata and a conversion record for each response among ``records``."""
    def run(batches):
        for batch in batches:
            yield _batch([made for row in batch.to_pylist() for made in _derived(row)], SCHEMA)
    chosen = records.where(records["record_type"] == "response")
    return chosen.select(*[chosen[f.name] for f in SCHEMA]).mapInArrow(run, RECORD)


def write(records: DataFrame, path: str) -> None:
    """Records as WARC text; every record ends with two line ends."""
    (records.select(F.concat("headers", F.lit("\r\n"), "block").alias("value"))
     .write.option("lineSep", END).text(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC text: page_id is null; ``complete`` tells whether the length is right.

    Files are cut at the start line of a record, so large ones are read in parallel. A block
    that itself holds an end of record and a start line comes in pieces that are not complete.
    """
    rows = spark.read.option("lineSep", f"{END}{VERSION}\r\n").text(path)
    # The first record of a file keeps its start line, the last one the end of record.
    cut = rows.select(F.regexp_replace("value", rf"^{VERSION}\r\n", "").alias("v"))
    cut = cut.where(~F.col("v").isin("", END))
    head = F.concat(F.lit(f"{VERSION}\r\n"), F.substring_index("v", END, 1), F.lit("\r\n"))
    rest = F.expr(r"substr(v, length(substring_index(v, '\r\n\r\n', 1)) + 5)")

    def field(name: str):
        found = F.regexp_extract("headers", rf"(?m)^{name}: (.*)$", 1)
        return F.when(found != "", found)
    made = cut.select(head.alias("headers"), rest.alias("rest"))
    length = field("Content-Length").cast("long")
    closed = (F.octet_length("rest") == length + len(END)) & F.endswith("rest", F.lit(END))
    made = made.withColumn("block", F.when(closed, F.expr("left(rest, length(rest) - 4)"))
                           .otherwise(F.col("rest")))
    return made.select(
        F.lit(None).cast("long").alias("page_id"), field("WARC-Type").alias("record_type"),
        field("WARC-Record-ID").alias("record_id"), field("WARC-Refers-To").alias("refers_to"),
        field("WARC-Target-URI").alias("target_uri"), field("Content-Type").alias("content_type"),
        field("WARC-Payload-Digest").alias("payload_digest"),
        field("WARC-Block-Digest").alias("block_digest"),
        field("Content-Length").cast("long").alias("content_length"), "headers", "block",
        field("Content-Length").cast("long").eqNullSafe(F.octet_length("block").cast("long"))
        .alias("complete"))
