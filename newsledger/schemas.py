"""Explicit schemas. Landed JSON is never read with an inferred schema."""

from __future__ import annotations

ITEM = ("title STRING, url STRING, published STRING, summary STRING, external_url STRING, "
        "external_urls ARRAY<STRING>, x_links ARRAY<STRING>, matched_query STRING, "
        "content_sha256 STRING, response_sha256 STRING, changed BOOLEAN, readable BOOLEAN")
EXPERT = ("technical_groups ARRAY<STRING>, method_hits ARRAY<STRING>, "
          "firsthand_hits ARRAY<STRING>, synthesis_hits ARRAY<STRING>, "
          "artifact_urls ARRAY<STRING>, conflict_keywords ARRAY<STRING>, "
          "fulltext_used BOOLEAN, fulltext_chars INT, content_hash STRING")
CAPTURE = (f"source STRING, name STRING, tier STRING, injection_warning BOOLEAN, "
           f"fetched_at STRING, items ARRAY<STRUCT<{ITEM}>>")
AUDIT_CAPTURE = (
    "source STRING, name STRING, tier STRING, subreddit STRING, category STRING, "
    "track STRING, evidence_role STRING, role STRING, routing STRING, "
    "partitions ARRAY<STRING>, cadence STRING, status STRING, fetched_at STRING, "
    f"lookback_days INT, affiliation STRING, "
    f"items ARRAY<STRUCT<{ITEM}, expert_features STRUCT<{EXPERT}>>>")
FETCH_LOG = ("date STRING, run_mode STRING, fetched_at STRING, completed_at STRING, "
             "finished_at STRING, sources MAP<STRING, STRUCT<status STRING, items INT, "
             "snapshot_hash STRING, error STRING, reason STRING>>")
INBOX = ("id STRING, version INT, date DATE, title STRING, url STRING, source_type STRING, "
         "matched_claim STRING, candidate_key STRING, why_it_matters STRING, "
         "main_alternative STRING, next_check STRING, action STRING, "
         "source_item_id STRING, snapshot_hash STRING")
CLAIMS = ("id STRING, claim STRING, status STRING, opened DATE, watch STRING, "
          "watch_keywords ARRAY<STRING>, ledger_ref STRING, career_implication ARRAY<STRING>")
EVIDENCE = ("claim_id STRING, ev_ord INT, src STRING, type STRING, stance STRING, "
            "verdict STRING, link STRING, date DATE, source_item_id STRING, "
            "snapshot_hash STRING")
BASELINE = ("day DATE, source STRING, title STRING, when TIMESTAMP, urls ARRAY<STRING>, "
            "url_keys ARRAY<STRING>")
