"""Explicit schemas of the corpus files and tables."""

from __future__ import annotations

ALIAS = "bill_id string, congress int, type string, number string, short_title string, version string, status string, format string"
SECTION_ALIAS = ALIAS + ", section_enum string, section_header string"
BILL_DATA = "bill_id string, short_title string, official_title string, status string, _corrupt_record string"
SIDECAR = "bill_id string, congress int, type string, number string, version string, format string, source_url string, short_title string, official_title string, status string, bytes int"
SECTION = "enum string, header string, body_text string, sub_texts array<string>"
DOCUMENT = f"bill_id string, congress int, type string, number string, short_title string, version string, status string, format string, full_text string, document_text_hash string, sections array<struct<{', '.join(x.replace(' ', ': ', 1) for x in SECTION.split(', '))}>>"
CHUNK = (
    "bill_id string, canonical_bill_id string, congress int, type string, number string, short_title string, version string, status string, section_enum string, "
    "section_header string, chunk_index int, text string, tokens int, document_text_hash string, document_text_hashes array<string>, section_text_hash string, original_chunk_index int, source_hash string"
)
EMBEDDED_CHUNK = CHUNK + ", embedding array<float>"
VOTE_DATA = (
    "vote_id string, chamber string, congress string, session string, number string, date string, category string, type string, question string, subject string, result string, "
    "requires string, source_url string, bill struct<congress: string, number: string, type: string>, _corrupt_record string"
)
VOTE = (
    "vote_id string, chamber string, congress int, session string, number int, date string, category string, type string, question string, subject string, result string, "
    "requires string, source_url string, bill_id string"
)
VOTE_CHUNK = (
    "source_hash string, vote_id string, congress int, chamber string, session string, number int, date string, category string, type string, question string, subject string, "
    "result string, bill_id string, text string, token_count int, chunk_index int, content_hash string"
)
EVAL_QUERY = "id string, category string, query string, expected_bill_ids array<string>, unacceptable_bill_ids array<string>, fixture boolean, note string"
AUDIT = "run_id string, model string, dimensions int, status string, at timestamp, counts map<string, bigint>, shard_checksums map<string, string>, error string"
CHANGE_SUMMARY = "congress int, changed_bill_ids array<string>, changed_count bigint, unchanged_count bigint, total_count bigint, missing_embedding_count bigint, processed_chunk_count bigint"
