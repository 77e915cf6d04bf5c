"""Language identification: held-out accuracy, and rows that have no language."""

from newsledger.llm import common, langid
from tests.llm.conftest import ODD

MEDIUM = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = common.read(spark, MEDIUM, "documents")
    got = langid.identify(docs)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.where("held_out").join(docs.where("lang is not null"), "doc_id").select(
        "lang_pred", "lang").collect()
    assert len(rows) > 150 and sum(a == b for a, b in rows) / len(rows) > 0.98


def test_rows_without_letters_and_without_languages(spark, make_docs):
    texts = [(i, t, None) for i, t in ODD] + [(50, "12 34 !?", "en"), (51, "the house is old", "en"),
                                             (52, "das Haus ist alt", "de"), (53, "the old house", "en")]
    rows = langid.identify(make_docs(texts), held_out=9).collect()
    assert len(rows) == len(texts)
    blank = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert blank >= {1, 2, 3, 50} and not blank & {51, 52, 53}
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert all(0 <= r.score <= 1 for r in rows)
    assert next(r.lang_pred for r in rows if r.doc_id == 52) == "de"
    untaught = langid.identify(make_docs([(i, t, None) for i, t in ODD])).collect()
    assert {r.lang_pred for r in untaught} == {"und"}
    assert langid.identify(make_docs(texts).limit(0)).count() == 0


def test_the_bound_on_rows_holds(spark, make_docs):
    """Beyond ``max_rows`` a share of the rows teaches, and copies of one id are cut as well."""
    docs = make_docs([(i, "the house is old", "en") for i in range(400)]
                     + [(7, "das Haus ist alt", "de")] * 300)
    assert set(langid.learn(docs, max_rows=50)) <= {"de", "en"} and langid.learn(docs, max_rows=50)
