"""Column functions on hand-written cases."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from newsledger.functions import ids, similarity as S, text as T, times, urls as U


def apply(spark, function, values, schema="v string"):
    rows = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in rows.coalesce(1).select(function(F.col("v"))).collect()]


URLS = {
    U.canonical_url: {
        "https://www.Example.com/a/?utm_source=x#top": "https://example.com/a",
        "HTTP://user:pw@WWW.example.com:8080/": "http://example.com:8080/",
        "https://a.com?b=2&a=1&b=1&c": "https://a.com/?a=1&b=1&b=2&c=",
        "https://a.com/p?q=a+b%7E*%C3%A9&fbclid=1&GCLID=2": "https://a.com/p?q=a+b~%2A%C3%A9",
        "https://a_b.com//x//": "https://a_b.com//x",
        "https://a.com/?x=100%zz": "https://a.com/?x=100%25zz",
        "ftp://a.com/": None, "note.md": None, "https:///x": None, "": None,
        "  https://a.com/x  ": "https://a.com/x", "https://a.com:99999/": None},
    U.match_url: {
        "http://GitHub.com/org/repo/?utm_source=x&v=1#readme": "https://github.com/org/repo?v=1",
        "https://www.a.com./x).": "https://www.a.com/x",
        "https://a.com/?b=2&amp;a=1": "https://a.com/?b=2&a=1",
        "https://a.com/?b=2&ampa=1": "https://a.com/?b=2&a=1",
        "https://u@a.com/": None, "https://a.com:444/": None, "https://a.com:443/x": "https://a.com/x",
        "http://a.com:80/": "https://a.com/", "mailto:x": None},
    U.audit_url: {
        "http://a.com:444/x/?ref=1&fbclid=2": "https://a.com/x?fbclid=2", "HTTP://a.com/": "",
        "https://a.com": "https://a.com/"},
    U.linkify: {
        "https://a.com/x": "https://a.com/x", "codexradar.com": "https://codexradar.com",
        "linux.do/t/1": "https://linux.do/t/1", "data/state/x.json": None, "note.md": None,
        "D:\\work\\x.md": None, "arxiv 2606.19348": None, "": None, "localhost/x": None},
}


@pytest.mark.parametrize("function", list(URLS))
def test_url_rules(spark, function):
    cases = URLS[function]
    assert dict(zip(cases, apply(spark, function, list(cases)))) == cases


def test_html_references(spark):
    cases = {"a &amp; b": "a & b", "&lt;b&gt;": "<b>", "&#65;&#x42;": "AB", "&#65 ": "A ",
             "&copy 1": "© 1", "&apos;": "'", "&notin;": "∉", "plain": "plain"}
    assert dict(zip(cases, apply(spark, U.unescape_html, list(cases)))) == cases


def test_links_in_text(spark):
    body = ('see https://github.com/a/b). <a href="https://arxiv.org/abs/1?utm_source=z">x</a> '
            "http://x.com/Some_One/status/12 https://twitter.com/i/status/9")
    assert apply(spark, U.extract_match_urls, [body])[0] == [
        "https://arxiv.org/abs/1", "https://github.com/a/b", "https://twitter.com/i/status/9",
        "https://x.com/Some_One/status/12"]
    assert apply(spark, U.status_links, [body])[0] == ["x.com/Some_One/status/12"]
    rows = spark.createDataFrame([('<a href="/p/1">x</a> https://b.org/z.', "https://a.com/q/")],
                                 "b string, u string")
    assert rows.select(S.extract_links(F.col("b"), F.col("u"))).first()[0] == [
        "https://a.com/p/1", "https://b.org/z"]
    assert apply(spark, U.extract_absolute_links, ['<a href="https://a.com/p">'])[0] == ["https://a.com/p"]


def test_artifacts_and_hosts(spark):
    cases = {"https://github.com/a/b": True, "https://github.com/a": False,
             "https://huggingface.co/blog/x": False, "https://huggingface.co/a/b": True,
             "https://arxiv.org/abs/1": True, "https://arxiv.org/list": False,
             "https://openreview.net/forum?id=1": True, "https://a.com/x/y": False}
    assert dict(zip(cases, apply(spark, U.is_artifact_url, list(cases)))) == cases
    hosts = ["a.com", "b.a.com", "ba.com"]
    assert apply(spark, lambda c: U.host_matches(c, ["A.com"]), hosts) == [True, True, False]
    assert apply(spark, U.is_community_url, ["https://old.reddit.com/r/x", "https://areddit.com"]
                 ) == [True, False]


def test_keywords(spark):
    cases = {"the GA is out": ["GA"], "game": [], "planning": [], "Plan 涨价": ["plan", "涨价"],
             "K30": [], "_plan": [], "coding plan, now": ["plan"], "ERDŐS": ["Erdős"]}
    words = ["GA", "plan", "涨价", "K3", "Erdős"]
    got = apply(spark, lambda c: T.keyword_hits(c, T.fold_case(c), words), list(cases))
    assert dict(zip(cases, got)) == cases


def test_titles(spark):
    title = "The new GPT-5.6 and 智谱清言 of a x 今 上线"
    assert sorted(apply(spark, T.title_tokens, [title.lower()])[0]) == sorted(
        ["gpt-5.6", "智谱", "谱清", "清言", "上线"])
    assert apply(spark, T.title_vendors, [title]) == [["zhipu"]]
    assert apply(spark, T.title_models, ["OpenAI GPT 5 and gpt-5.6, qwen3"])[0] == [
        "gpt-5", "gpt-5.6", "qwen3"]
    assert apply(spark, T.title_key, ["A big C++ and rust-lang API is up"]) == ["big c++ and rust-lang api"]
    assert apply(spark, T.normalized_title, ["  A\u00a0 b\n C "]) == ["a b c"]


def test_html_text(spark):
    html = "<style>p{}</style><SCRIPT a='1'>var x='</p>';</script><p>One&nbsp;<b>two</b>\n three</p>"
    assert apply(spark, T.visible_text, [html]) == ["One&nbsp; two three"]


def test_dates(spark):
    cases = {"Mon, 05 Aug 2026 10:00:00 GMT": "2026-08-05T10:00:00+00:00",
             "05 Aug 2026 10:00:00 +0800": "2026-08-05T02:00:00+00:00",
             "Wed, 5 Aug 2026 10:00 -0000": "2026-08-05T10:00:00+00:00",
             "2026-08-05T12:30:00+00:00": "2026-08-05T12:30:00+00:00",
             "2026-08-05T10:00:00Z": "2026-08-05T10:00:00+00:00",
             "2026-08-05": "2026-08-05T00:00:00+00:00", "yesterday": None, "": None, "2026": None}
    parse = lambda c: F.date_format(times.parse_published(c), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    assert dict(zip(cases, apply(spark, parse, list(cases)))) == cases
    days = [dt.date(2026, 8, 1), dt.date(2026, 1, 31)]
    assert apply(spark, times.previous_month, days, "v date") == ["2026-07", "2025-12"]
    assert apply(spark, times.day_ordinal, days, "v date") == [d.toordinal() for d in days]


def test_identities(spark):
    row = spark.createDataFrame([("s:1", "https://a.com/")], "s string, u string")
    item = row.select(ids.source_item_id(F.col("s"), F.col("u"))).first()[0]
    assert item == "s:1:" + hashlib.sha256(b"s:1\0https://a.com/").hexdigest()[:20]
    assert apply(spark, ids.source_of_item, [item, "plain"]) == ["s:1", "plain"]
    body = '{"content_sha256":"","published":"","summary":"s\\"é","title":"t","url":"u"}'
    got = spark.range(1).select(ids.snapshot_hash(
        F.lit("t"), F.lit("u"), F.lit(None).cast("string"), F.lit('s"é'), F.lit(None).cast("string")))
    assert got.first()[0] == hashlib.sha256(body.encode()).hexdigest()


def test_excerpt_and_prices(spark):
    words = "navigation " * 700
    rows = spark.createDataFrame([(words + "Pro plan $20 per month " + words, ["\\$\\d+"]),
                                  ("short", ["x"]), (words, [])], "b string, p array<string>")
    got = [r[0] for r in rows.coalesce(1).select(S.excerpt(F.col("b"), F.col("p"))).collect()]
    assert "$20" in got[0] and len(got[0]) <= 5000 and got[1] == "short" and len(got[2]) == 5000
    flat = spark.createDataFrame([({"z": "1", "output_mtok": "2", "input_mtok": "3"},)],
                                 "p map<string,string>")
    assert flat.select(T.compact_prices(F.col("p"))).first()[0] == "input_mtok=$3/M, output_mtok=$2/M, z=1"
    nested = '[{"prices":{"input_mtok":3}},{"constraint":{"a":1},"prices":{"x":2}}]'
    assert apply(spark, S.compact_prices_json, [nested]) == ['default: input_mtok=$3/M | {"a":1}: x=2']


def test_excerpt_windows(spark):
    gap = "\n… [必要内容片段] …\n"
    line = "".join(f"{i:05d} " for i in range(1500))
    body = line[:3000] + "PRICE one" + line[3000:3100] + "price two " + line[3100:]
    far = body.index("01400")
    rows = spark.createDataFrame([(body, ["price \\w+", "01400"])], "b string, p array<string>")
    got = rows.select(S.excerpt(F.col("b"), F.col("p"), 4000)).first()[0].split(gap)
    second = body.index("price two") + len("price two")
    assert got == [body[:600].rstrip(), body[3000 - 320:second + 560].strip(),
                   body[far - 320:far + 5 + 560].strip()]
    cut = rows.select(S.excerpt(F.col("b"), F.col("p"), 700)).first()[0]
    assert len(cut) == 700 and cut.startswith(body[:599])


def test_price_forms(spark):
    nested = ('[{"constraint":{"b":1,"a":{"z":2}},"prices":{"output_mtok":0.5,"k":null}},'
              '{"constraint":null,"prices":{}}]')
    assert apply(spark, S.compact_prices_json, [nested, "3", None]) == [
        '{"a":{"z":2},"b":1}: output_mtok=$0.5/M, k=null | default: ', "3", None]


def test_words_are_searched_not_cut_out(spark):
    import random
    import re
    from newsledger.operators import claims as C
    from pyspark.sql import functions as F
    rng = random.Random(3)
    parts = ["las", "Las", "lass", "clas", "la_s", "_las", "é", "lasé", " ", "-", ".", "\n", "heit", "ß", "İ"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 7)))) for i in range(400)]
    rows += [(400, "las"), (401, ""), (402, "x las las"), (403, None)]
    df = spark.createDataFrame(rows, "id long, match_text string")
    words = ["las", "heit", "LASS"]
    found = df.where("match_text is not null").select(
        "match_text", T.fold_case(F.col("match_text")).alias("f")).withColumn(
        "p", T.words_present(F.col("f"), words))
    for row in found.collect():
        assert row.p == sorted({"las", "heit", "lass"} & set(re.split("[^0-9a-z_]+", row.f))), row
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan
    keywords = spark.createDataFrame([("las",), ("ß",), ("la_s",)], "keyword string")
    seen = C.keyword_sightings(df, "id", keywords)
    plan = seen._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all(" not in plan
    got = {(r.id, r.keyword) for r in seen.collect()}
    flank = "(?i)(?<![0-9A-Za-z_]){}(?![0-9A-Za-z_])"
    want = {(i, k) for i, t in rows if t for k in ("las", "la_s") if re.search(flank.format(k), t)}
    assert want and got == want | {(i, "ß") for i, t in rows if t and "ß" in t}


def test_url_rules_work_their_input_out_once(spark):
    for rule in (U.match_url, U.audit_url, U.canonical_url, U.url_host):
        assert str(rule(F.col("given_url"))).count("given_url") <= 2, rule.__name__


def test_links_of_several_texts(spark):
    rows = spark.createDataFrame(
        [("See HTTPS://A.org/x?a=1&amp;b=2 or https&#58;//c.org/y", "http://d.org/?k=1&v=2"),
         ("no link, but R&D", None), ("plain", "https://d.org/z"), (None, None)],
        "t string, u string")
    both = F.col("t"), F.col("u")
    found = rows.coalesce(1).select(U.extract_match_urls(*both), U.unescaped(*both)).collect()
    assert found[0][0] == ["https://a.org/x?a=1", "https://c.org/y", "https://d.org/?k=1"]
    assert found[1][0] == [] and found[2][0] == ["https://d.org/z"] and found[3][0] == []
    # a text without a link is not looked through for the sake of another
    assert found[2][1] == "https://d.org/z" and found[3][1] == ""
