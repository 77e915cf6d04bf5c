import pytest
from pyspark.sql import types as T

from newsledger.llm.common import prepare

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that operators might use themselves
    T.StructField("kept", T.StringType()), T.StructField("size", T.StringType()),
    T.StructField("score", T.StringType()), T.StructField("a.b", T.StringType())])
LABELS = "doc_id long, quality int, toxic int"
BENCHMARK = "item_id long, text string"


@pytest.fixture
def make_docs(spark):
    prepare(spark)

    def make(rows):
        """Rows of (doc_id, text[, lang[, source]])."""
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, None, None, None)[:4]
            full.append((doc_id, text, lang, source, len(text or ""), "k", "s", "x", "d"))
        return spark.createDataFrame(full, DOCS).repartition(3)
    return make


#: Nulls, empty and blank texts, ties, repeated rows, one very long text.
ODD = [
    (None, None), (None, None), (1, None), (2, ""), (2, ""), (3, " \n\t "), (4, "one"),
    (5, "ONE"), (5, "ONE"), (6, "é É ß"), (7, "word " * 30_000), (7, "other text here"),
    (None, "other text here"), (8, "\u0000 nul inside"), (9, "日本語のテキスト です"),
]
