"""The registered queries of the numbered operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from newsledger.llm import (chat, decontaminate, exact_dedup, langid, license_scan, mixing,
                            prefix_trie, ranked_search, secret_scan, simhash, suffix_dedup,
                            toxicity, warc)
from newsledger.llm.common import read


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.assign(read(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read(spark, sf_dir, "documents"))


def op4_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(read(spark, sf_dir, "conversations"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.group_fingerprints(read(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read(spark, sf_dir, "documents"),
                                    read(spark, sf_dir, "labels"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op8_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.responses(read(spark, sf_dir, "pages")))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"),
                                    read(spark, sf_dir, "benchmark"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank(read(spark, sf_dir, "documents"),
                              read(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_language_id, op3_secret_scan, op4_chat_rotation, op5_simhash,
    op6_toxicity, op7_mixing, op8_warc_derivatives, op9_suffix_dedup, op10_decontamination,
    op11_license_scan, op12_ranked_search, op13_prefix_trie, pipeline)}

#: Same rows as the query of that name. Fitted models, fingerprints, records of bytes and
#: suffix order have no SQL form; tests hold those operators against brute force.
SQL = {
    "op1_exact_dedup": """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
""",
    "op4_chat_rotation": chat.ORACLE,
    "op7_mixing": mixing.ORACLE,
    "op12_ranked_search": ranked_search.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
