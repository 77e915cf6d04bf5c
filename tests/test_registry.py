"""The driver contract."""

import __spark_entry__ as entry

#: Order-dependent readings without an SQL form; tests hold them against other readings.
NO_SQL = {"evidence_dedupe", "stories", "story_items", "merge_events", "story_independence",
          "story_health", "lineage_entries", "lineage_groups"}
SMALL = "/root/testdata/sf0.001"


def test_contract(spark):
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    unchecked = {n for n in queries if n not in sql and not n.startswith("op") and n != "pipeline"}
    assert unchecked <= NO_SQL
    assert entry.entry(spark).count() > 0


def test_stable_schemas(spark):
    for name in ("url_canonical", "fetch_status_rollup", "evidence_selection"):
        plan = entry.queries()[name]
        assert plan(spark, SMALL).schema == plan(spark, SMALL).schema
