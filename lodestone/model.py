"""Fixed vocabularies, limits and record schemas of the engine."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values.
SECTION_STATUSES = ("pending", "in_progress", "ingested", "qa_required", "skipped", "stale")
TERMINAL_STATUSES = ("ingested", "skipped")
TRANSITIONS = {
    "pending": ("pending", "in_progress", "qa_required", "skipped"),
    "in_progress": ("in_progress", "pending", "ingested", "qa_required", "skipped"),
    "qa_required": ("qa_required", "in_progress", "skipped"),
    "ingested": ("ingested", "qa_required", "stale"),
    "skipped": ("skipped", "pending", "in_progress"),
    "stale": ("stale", "in_progress", "qa_required", "skipped"),
}
QUALITY = {"pass": 0, "warn": 1, "fail": 2}
TRACE_STATUSES = ("completed", "failed", "incomplete")
EVIDENCE_LEVELS = ("clear", "source-backed", "needs-qa", "gap")
CLAIM_STATUSES = ("supported", "qualified", "disputed", "gap")
ASSET_STATUSES = ("verified", "not-required", "not-checked", "failed")
INACTIVE_ROUTES = ("disabled", "unavailable", "skipped", "failed")
CHUNK_TYPES = ("normal", "backlink", "navigation", "index", "metadata")
IGNORED_CHUNK_TYPES = ("navigation", "backlink")
AUXILIARY_BLOCKS = ("header", "footer", "page_number", "aside_text", "page_footnote")
LINT_PROFILES = ("post-ingest", "query-ready", "strict", "qa-review")
IMAGE_SUFFIXES = (".png", ".jpg", ".jpeg", ".webp")
MAX_INSPECTIONS, MAX_SUPPLEMENTS, EVENT_CANDIDATES = 2, 1, 20

RANGE = T.StructType([T.StructField("start_line", T.IntegerType()), T.StructField("end_line", T.IntegerType())])
RANGES = "array<struct<start_line:int,end_line:int>>"

CHUNK = "id string, chunk_no int, chunk_type string, text string, parent_id string, parent_text string, source string, source_sha256 string, start_line int, end_line int, heading string, tokens int"
CANDIDATE = "query_id long, vault_path string, line_start int, line_end int, heading string, snippet string, context string, score double, score_type string, provider_ref string, source_sha256 string"
ISSUE = "code string, severity string, path string, message string, hint string, details map<string,string>"
SECTION = f"document_path string, section_id string, title string, level int, parent string, path_titles array<string>, start_line int, end_line int, content_ranges {RANGES}, quality string, ingest_status string, content_hash string"
