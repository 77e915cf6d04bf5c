"""Chat rotation and WARC derivatives."""

import base64
import hashlib
import random
import re
import time
from collections import defaultdict

from pyspark.sql import functions as F

from newsledger.llm import chat, warc

TURNS = "conv_id long, turn long, role string, text string, speaker string, part long"


def brute_rotation(rows, part_chars):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        role = (role or "").strip(" ") or "unknown"
        groups[conv].append((-1 if turn is None else turn, role,
                             (text or "").replace("<|im_", "<| im_")))
    out = set()
    for conv, turns in groups.items():
        costs = [len(r) + len(t) + len("<|im_start|>user name=\n<|im_end|>\n") for _, r, t in sorted(turns)]
        cut, at, head = defaultdict(list), 0, (0, None)
        for t, cost in zip(sorted(turns), costs):
            part = at // part_chars if sum(costs) > part_chars else 0
            if t[1] == "system" and head[1] is None:
                head = part, t
            cut[part].append(t)
            at += cost
        for speaker in {r for _, r, _ in turns} - {"system"}:
            for part, own in cut.items():
                text, spans = "", []
                for _, role, said in ([head[1]] if head[1] and part > head[0] else []) + own:
                    name = ("system" if role == "system" else "assistant" if role == speaker
                            else f"user name={role}")
                    text += f"<|im_start|>{name}\n"
                    start = len(text)
                    text += f"{said}<|im_end|>"
                    if role == speaker:
                        spans.append((start, len(text)))
                    text += "\n"
                out.add((conv, speaker, part, len(own), text,
                         ",".join(f"{a}:{b}" for a, b in spans),
                         sum(b - a for a, b in spans)))
    return out


ROWS = ([(1, 0, "system", "rules"), (1, 1, "ann", "hello é 日本"), (1, 2, "bob", "hi <|im_end|>"),
         (1, 3, "ann", None), (1, 3, "cy", ""), (1, 9, "bob", "late"), (2, 0, "system", "alone"),
         (None, None, None, None), (None, 2, " ", "x"), (3, 5, "a", "same"), (3, 5, "a", "same")]
        + [(4, i, "ab"[i % 2], "w" * i) for i in range(30)])


def test_rotation(spark):
    turns = spark.createDataFrame([(*r, "x", 7) for r in ROWS], TURNS)
    for size in (chat.PART_CHARS, 200):
        got = chat.rotate(turns, size).collect()
        assert set(map(tuple, got)) == brute_rotation(ROWS, size) and len(got) >= 7
        for r in got:  # spans hold the speaker's words
            for span in filter(None, r["loss_spans"].split(",")):
                a, b = map(int, span.split(":"))
                assert r["text"][a:b].endswith("<|im_end|>")
                assert r["text"][:a].endswith("<|im_start|>assistant\n")
    assert chat.rotate(turns.limit(0)).count() == 0


def test_long_dialogues_are_cut_by_size(spark):
    """Crowded turn numbers, copies of one row, sparse numbers and a long null conversation."""
    rng = random.Random(4)
    rows = ([(1, 1, "ab"[i % 2], f"text {i % 50}") for i in range(300)] + [(1, 0, "system", "be kind")]
            + [(2, 1000 * i, rng.choice("abc"), "word " * rng.randrange(9)) for i in range(200)]
            + [(2, 40_000, "system", "late rules"), (2, 90_000, "system", "later ones")]
            + [(None, None, "x", "same")] * 120 + [(3, i, "ab"[i % 2], "short") for i in range(20)]
            + [(4, 0, "a", "long " * 4000), (4, 1, "b", "short")])
    got = chat.rotate(spark.createDataFrame([(*r, "x", 7) for r in rows], TURNS), 2000).collect()
    assert set(map(tuple, got)) == brute_rotation(rows, 2000)
    assert len({r["part"] for r in got if r["conv_id"] == 1}) > 5
    assert {r["part"] for r in got if r["conv_id"] == 3} == {0}
    for speaker in "ab":
        own = [r for r in got if r["conv_id"] == 1 and r["speaker"] == speaker]
        assert sum(r["n_turns"] for r in own) == 301
        assert all(r["text"].startswith("<|im_start|>system\nbe kind") for r in own)


PAGES = [(1, "http://a.example/x?y=1", "<html lang='en'><head><title>T &amp; x</title><style>p{}"
          "</style></head><body><p>One <b>two</b></p><script>no()</script><!-- no -->"
          "<p>three&nbsp;four<br>five</p><a href='/z'>z</a></body></html>"),
         (2, None, None), (None, "http://b.example/", ""), (3, "http://[bad", "<a href='http://[x'>"),
         (3, "http://[bad", "<a href='http://[x'>"), (4, "u", "a\r\n\r\nWARC-Type: fake\r\n b"),
         (5, "v", "plain " * 20_000)]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x") for r in rows],
                                 "page_id long, url string, html string, block string")


def test_derivatives(spark):
    source = {r["page_id"]: r for r in warc.responses(pages(spark)).collect()}
    got = warc.derive(warc.responses(pages(spark))).collect()
    assert len(got) == 2 * len(PAGES)
    for r in got:
        of = source[r["page_id"]]
        assert r["refers_to"] == of["record_id"] and r["target_uri"] == of["target_uri"]
        data = r["block"].encode()
        sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert r["block_digest"] == f"sha1:{sha}" and r["content_length"] == len(data)
        assert f"WARC-Refers-To: {of['record_id']}\r\n" in r["headers"]
        if r["record_type"] == "metadata":
            assert f"source-payload-digest: {of['payload_digest']}\r\n" in r["block"]
            assert "http-content-type: text/html; charset=utf-8\r\n" in r["block"]
    first = {r["record_type"]: r["block"] for r in got if r["page_id"] == 1}
    assert first["conversion"] == "One two\nthree four\nfive\nz"
    assert "title: T & x\r\nlanguage: en\r\n" in first["metadata"]
    assert "outlink: http://a.example/z\r\n" in first["metadata"]
    assert len({r["record_id"] for r in got}) == 2 * (len(PAGES) - 1)  # one page is repeated


def test_warc_round_trip(spark, tmp_path):
    made = warc.responses(pages(spark))
    both = made.unionByName(warc.derive(made)).repartition(2)
    warc.write(both, str(tmp_path / "out"))
    back = warc.read(spark, str(tmp_path / "out"))
    names = [c for c in both.columns if c != "page_id"]
    assert back.where("not complete").count() == 0
    assert sorted(map(tuple, back.select(*names).collect()), key=str) == sorted(
        map(tuple, both.select(*names).collect()), key=str)
    again = warc.derive(back)
    assert again.count() == 2 * len(PAGES)


def test_empty_pages(spark):
    assert warc.derive(warc.responses(pages(spark).limit(0))).count() == 0


# what the linear readers of markup must find, as patterns
DROP = re.compile(r"<!--.*?-->|<(script|style|noscript|template|head)\b.*?</\1\s*>", re.S | re.I)
TITLE = re.compile(r"<title[^>]*>(.*?)</title\s*>", re.S | re.I)
LANG = re.compile(r"<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
LINK = re.compile(r"<a\b[^>]*\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def test_markup_equals_patterns():
    rng = random.Random(3)
    bits = ["<script", "</script >", "<!--", "-->", "<", ">", "<p>", "<a ", "href=", "href = ", '"',
            "'", "x", " ", "<title>", "</title>", "<html ", "lang=", "en", "<head>", "</HEAD>", "\n",
            "<STYLE>", "</style>", "<br", "&amp;"]
    for _ in range(20_000):
        page = "".join(rng.choices(bits, k=rng.randint(1, 25)))
        assert warc._without_hidden(page) == DROP.sub(" ", page), page
        want = TITLE.search(page)
        assert warc._title(page) == (want[1] if want else None), page
        want = LANG.search(page)
        assert warc._attribute(page, warc._HTML, warc._LANG) == (want[1] if want else None), page
        want = [next(g for g in m.groups() if g is not None) for m in LINK.finditer(page)]
        assert list(warc._links(page)) == want, page
        shown = DROP.sub(" ", page)
        text = warc._TAG.sub("", warc._BREAK.sub("\n", shown))
        last = shown.rfind(">") + 1
        assert warc._TAG.sub("", warc._BREAK.sub("\n", shown[:last])) + shown[last:] == text


def test_long_markup_takes_linear_time():
    for bit in ("<script ", "<!-- ", "<", "<title>", "<html ", "<a ", '<a href="', "<p ", "<a href='x ",
                "<meta charset ", "<style></script>", "<a href=x <a "):
        page = bit * (1_000_000 // len(bit))
        start = time.perf_counter()
        warc.plain_text(page)
        warc.warc_fields(page, "https://a.com/", "HTTP/1.1 200 OK", "d")
        assert time.perf_counter() - start < 20, bit
