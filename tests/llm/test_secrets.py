"""Secret scans: what teaches the formats, and what is scored by them."""

import random
import re

from pyspark.sql import functions as F

from newsledger.llm import common, secret_scan

WORDS = ("information government international development understand something community "
         "experience production department university management environment performance").split()


def prose(rng, n=60):
    return " ".join(rng.choices(WORDS, k=n))


def test_credentials_of_all_documents_teach(make_docs):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        key = "zq" + "".join(rng.choices("0123456789", k=20))
        rows.append((i, prose(rng) + (f" token={key}" if i % 40 == 0 else "")))
    docs = make_docs(rows)
    all_, thinned = secret_scan.learn(docs), secret_scan.learn(docs, max_docs=4)
    assert thinned is not None and thinned.moves == all_.moves
    one = secret_scan.learn(docs, max_credentials=3)
    first = secret_scan._first_by_hash(
        {t.split("token=")[1]: 0 for _, t in rows if "token=" in t}, 3)
    assert one.moves == secret_scan.build(list(first), []).moves
    text = "found zq01234567899876543210 here"
    assert secret_scan.all_spans(text, thinned)[1] == [("format", 6, 28)]


def test_short_and_dotted_formats_are_scored(make_docs):
    rng = random.Random(6)

    def digits(n):
        return "".join(rng.choices("0123456789", k=n))
    for form in (lambda: "zq" + digits(9),
                 lambda: f"hd{digits(6)}.py{digits(6)}.sg{digits(6)}"):
        docs = make_docs([(i, f"{prose(rng)}. password: {form()} {prose(rng)}")
                          for i in range(60)])
        model = secret_scan.learn(docs)
        key = form()
        for text in (f"see {key} now", f"see {key}.", f"see {key}... now"):
            assert secret_scan.all_spans(text, model)[1] == [("format", 4, 4 + len(key))]
        for text in (prose(rng), "Say something. Nothing... www.example.com/department.html"):
            assert secret_scan.all_spans(text, model)[1] == []


def test_pieces_between_dots_are_scored():
    found = list(secret_scan.format_spans("a.b ..host1234.zq123456789.. x",
                                          lambda t: float(t == "zq123456789")))
    assert found == [(15, 26)]


def test_samples_do_not_vanish(spark):
    """The share of sampled rows holds at any number of rows."""
    ids = spark.range(200_000).select(F.xxhash64("id").alias("h"))
    half = ids.where(common.sampled(F.col("h"), 10, 20)).count()
    assert 98_000 < half < 102_000
    for total in (10**10, 5 * 10**10, 10**13):
        rows = 200_000 * total // 200_000
        share = common.sampled(F.col("h"), rows // 100, total)
        assert 1_700 < ids.where(share).count() < 2_300
        literal = str(common.sampled(F.col("h"), 20_000, total))
        assert int(re.findall(r"\d{6,}", literal)[-1]) >= common.HASHES * 20_000 // total - 1
    assert ids.where(common.sampled(F.col("h"), 5, 0)).count() == 200_000
