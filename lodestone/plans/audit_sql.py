"""SQL for the queries of ``audits``, written apart from the operators, in DuckDB's dialect."""

from __future__ import annotations

from .oracle import ALLOWED, BM25, ORACLE, ORDER_STATUS, TERMS, TURNS

SQL: dict[str, str] = {
    "lint_ledgers": f"""
WITH s AS (SELECT 'ledger-' || o_custkey AS path, o_orderkey AS k, CASE WHEN o_orderkey % 50 = 0 THEN 'lost' WHEN o_orderkey % 7 = 0 THEN 'stale' ELSE {ORDER_STATUS} END AS status FROM orders),
c AS (SELECT path, status, count(*) AS n FROM s GROUP BY ALL), o AS (SELECT path, unnest(['out-' || (k % 9), 'out-x']) AS output FROM s WHERE k % 4 = 0)
SELECT CASE status WHEN 'lost' THEN 'ledger.unknown_status' WHEN 'qa_required' THEN 'ledger.qa_open' ELSE 'ledger.' || status END AS code, 'error' AS severity, path, CASE status WHEN 'lost' THEN 'status=lost' ELSE 'count=' || n END AS details
FROM c WHERE status <> 'ingested'
UNION ALL SELECT 'ledger.output_missing', 'error', path, 'output=' || output FROM o WHERE output NOT IN ('out-0', 'out-1', 'out-2', 'out-3', 'out-4', 'out-5')""",
    "lint_source_maps": """
SELECT 'source_map.missing' AS code, 'error' AS severity, 'ledger-' || c_custkey AS path, '' AS details FROM customer WHERE c_custkey % 11 = 0
UNION ALL SELECT 'source_map.mismatch', 'error', 'map-' || c_custkey, 'field=revision;actual=' || (c_custkey % 5) || ';expected=' || (c_custkey % 4) FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 5 <> c_custkey % 4
UNION ALL SELECT 'source_map.mismatch', 'error', 'map-' || c_custkey, 'field=source_sha256;actual=' || c_name || ';expected=x' FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 6 = 0""",
    "lint_notes": """
WITH p AS (SELECT page_id, page_id % 4 = 0 AS is_map, 'n/' || page_id || CASE WHEN page_id % 4 = 0 THEN '.source-map.md' ELSE '.md' END AS path FROM pages),
l AS (SELECT path, unnest([page_id + 1, page_id + 2]) AS x FROM p WHERE page_id % 5 <> 0)
SELECT 'frontmatter.missing' AS code, CASE WHEN is_map THEN 'error' ELSE 'warning' END AS severity, path, '' AS details FROM p WHERE page_id % 9 = 0
UNION ALL SELECT 'frontmatter.missing_field', 'warning', path, 'field=type' FROM p WHERE page_id % 9 <> 0 AND page_id % 2 <> 0
UNION ALL SELECT 'frontmatter.missing_field', 'warning', path, 'field=status' FROM p WHERE page_id % 9 <> 0 AND page_id % 3 <> 0
UNION ALL SELECT 'relationship.unresolved', 'error', path, 'target=N/' || x || CASE WHEN x % 4 = 0 THEN '.source-map' ELSE '' END FROM l WHERE x NOT IN (SELECT page_id FROM pages)
UNION ALL SELECT 'relationship.missing', 'error', path, '' FROM p WHERE page_id % 5 = 0
UNION ALL SELECT 'vault.missing_required_dir', 'error', unnest(['40_Concepts', '50_Projects', '90_Dataview', '_system/metadata', '_system/reports']), ''
UNION ALL SELECT 'vault.missing_governance_file', 'warning', 'AGENTS.md', ''""",
    "lint_artifacts": """
WITH a AS (SELECT doc_id AS d, 'c/' || doc_id AS path, CASE WHEN doc_id % 3 = 0 THEN 'knowledge-card' ELSE 'report' END AS kind, CASE WHEN doc_id % 2 <> 0 THEN '' WHEN doc_id % 4 = 0 THEN 'index' ELSE 'direct' END AS mode,
  CASE WHEN doc_id % 5 <> 0 THEN doc_id % 40 END AS b, CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 8 = 0 THEN 'multiple-sections' ELSE 's' || (doc_id % 6) END AS sec, CASE WHEN doc_id % 11 = 0 THEN '' WHEN doc_id % 13 = 0 THEN 'other' ELSE 'sha' END AS sha,
  doc_id % 24 = 0 AS has_row FROM documents),
s AS (SELECT *, b % 10 <> 3 AS held, sec = 'multiple-sections' AS whole FROM a WHERE b IS NOT NULL),
f AS (SELECT path, kind, unnest(list_concat(CASE WHEN sha = '' THEN ['source_sha256'] ELSE [] END, CASE WHEN sec = '' THEN ['source_section_id'] ELSE [] END, CASE WHEN d % 2 <> 0 THEN ['source_lines'] ELSE [] END, CASE WHEN whole THEN [] ELSE ['source_pages', 'source_assets'] END)) AS field FROM s)
SELECT 'evidence.unknown_bundle' AS code, 'error' AS severity, path, '' AS details FROM s WHERE NOT held OR (sha <> '' AND sha <> 'sha')
UNION ALL SELECT 'evidence.unknown_section', 'error', path, '' FROM a WHERE has_row AND (d % 40) % 10 <> 3 AND d % 10 > 4
UNION ALL SELECT 'evidence.unknown_section', 'error', path, '' FROM s WHERE held AND sec <> '' AND NOT whole AND sec = 's5'
UNION ALL SELECT 'evidence.not_recorded_in_ledger', 'warning', path, '' FROM s WHERE held AND sec <> '' AND NOT whole AND sec <> 's5' AND path NOT IN ('c/17', 'c/22')
UNION ALL SELECT 'evidence.missing_field', CASE WHEN kind = 'knowledge-card' THEN 'error' ELSE 'warning' END, path, 'field=' || field FROM f
UNION ALL SELECT 'evidence.mode_missing', 'warning', path, '' FROM a WHERE kind = 'knowledge-card' AND mode = ''
UNION ALL SELECT 'evidence.direct_contract', 'warning', path, '' FROM a WHERE kind = 'knowledge-card' AND mode = 'direct' AND b IS NULL
UNION ALL SELECT 'evidence.index_contract', 'warning', path, 'missing=' || array_to_string(list_concat(CASE WHEN d % 12 <> 0 THEN ['evidence_scope'] ELSE [] END, ['evidence_coverage', 'evidence_authority', 'source_reports'], CASE WHEN has_row THEN [] ELSE ['evidence table'] END), ', ') FROM a WHERE kind = 'knowledge-card' AND mode = 'index'""",
    "ledger_apply": f"""
WITH allowed(a, b) AS (VALUES {ALLOWED}), o AS (SELECT o_orderkey AS id, {ORDER_STATUS} AS status, CASE WHEN o_orderkey % 3 = 0 THEN 'in_progress' WHEN o_orderkey % 5 = 0 THEN 'skipped' ELSE 'ingested' END AS to_status FROM orders),
v AS (SELECT *, id % 2 = 0 AND NOT (id % 9 = 0 AND id % 3 <> 1) AND EXISTS (SELECT 1 FROM allowed WHERE a = status AND b = to_status) AND NOT (to_status = 'ingested' AND id % 7 = 0) AND NOT (to_status = 'skipped' AND id % 4 <> 0) AS ok FROM o)
SELECT id, CASE WHEN ok THEN to_status ELSE status END AS status, CASE WHEN ok THEN status END AS previous_status, CASE WHEN ok AND id % 7 <> 0 THEN 'a,b' ELSE 'a' END AS outputs, CASE WHEN ok AND id % 4 = 0 THEN 'n' ELSE '' END AS notes,
  CASE WHEN ok AND to_status = 'in_progress' THEN 2024 END AS started, CASE WHEN ok AND to_status <> 'in_progress' THEN 2024 ELSE 2020 END AS completed, CASE WHEN ok THEN 2024 ELSE 2020 END AS updated FROM v""",
    "trace_checks": """
WITH e AS (SELECT user_id AS trace_id, event_id AS k, (event_id % 400)::VARCHAR AS eid, event_type FROM events), n AS (SELECT *, count(*) OVER (PARTITION BY trace_id, eid) AS n FROM e),
c AS (SELECT trace_id, k::VARCHAR AS id, unnest([(k % 400)::VARCHAR, (k % 401)::VARCHAR]) AS ref FROM e WHERE k % 5 <> 0)
SELECT trace_id, 'evidence' AS kind, eid AS id, 'duplicate-evidence-id' AS violation FROM n WHERE n > 1
UNION ALL SELECT trace_id, 'evidence', eid, 'version-required' FROM e WHERE k % 8 = 0
UNION ALL SELECT trace_id, 'evidence', eid, 'unknown-asset-status' FROM e WHERE event_type = 'error'
UNION ALL SELECT trace_id, 'evidence', eid, 'verified-needs-asset' FROM e WHERE event_type = 'view' AND k % 3 = 0
UNION ALL SELECT trace_id, 'evidence', eid, 'path-missing' FROM e WHERE k % 50 >= 45
UNION ALL SELECT DISTINCT trace_id, 'claim', id, 'unknown-evidence' FROM c WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.trace_id = c.trace_id AND e.eid = c.ref)
UNION ALL SELECT trace_id, 'claim', k::VARCHAR, 'supported-needs-evidence' FROM e WHERE k % 2 = 0 AND k % 5 = 0""",
    "stage_timers": """
WITH g AS (SELECT user_id, event_id % 30 AS stage_id, epoch_us(min(ts) FILTER (event_type IN ('view', 'click'))) AS started, epoch_us(max(ts) FILTER (event_type NOT IN ('view', 'click'))) AS ended FROM events GROUP BY ALL)
SELECT *, round((ended - started) / 1000.0::DOUBLE, 3) AS duration_ms FROM g""",
    "trace_finish": """
WITH g AS (SELECT user_id AS t, count(*) FILTER (event_type = 'error') AS o, count(*) FILTER (event_type = 'purchase') AS e, count(*) FILTER (event_type = 'signup') AS c,
  list(DISTINCT event_type || '-' || (event_id % 40)) AS seen FROM events GROUP BY user_id),
s AS (SELECT *, CASE WHEN t % 7 = 0 THEN 'odd' WHEN t % 3 = 0 THEN 'failed' ELSE 'completed' END AS status, CASE WHEN t % 11 = 0 THEN 'none' WHEN t % 4 = 0 THEN 'gap' ELSE 'clear' END AS level FROM g)
SELECT t AS trace_id, 'unknown-status' AS violation FROM s WHERE status = 'odd' UNION ALL SELECT t, 'unknown-evidence-level' FROM s WHERE level = 'none' UNION ALL SELECT t, 'open-stages' FROM s WHERE o > 0
UNION ALL SELECT t, 'evidence-required' FROM s WHERE status = 'completed' AND level <> 'gap' AND e = 0 UNION ALL SELECT t, 'claims-required' FROM s WHERE status = 'completed' AND c = 0
UNION ALL SELECT t, 'missing-stages:' || array_to_string([x for x in ['click-3', 'error-7', 'view-11'] if NOT list_contains(seen, x)], ',') FROM s WHERE seen IS NOT NULL AND NOT list_has_all(seen, ['click-3', 'error-7', 'view-11'])""",
    "trace_tables": r"""
WITH e AS (SELECT user_id, event_id AS k, '| ' || event_id || ' | ' || event_type || ' | r\|' || (event_id % 3) || ' | ' || CASE WHEN event_id % 2 = 0 THEN 'ok' ELSE '' END || ' | ' || CASE WHEN event_id % 7 <> 0 THEN (event_id % 1000)::VARCHAR ELSE '' END || ' |' AS line FROM events)
SELECT user_id, sha256('| # | stage | route | status | ms |' || chr(10) || '| --- | --- | --- | --- | --- |' || chr(10) || string_agg(line, chr(10) ORDER BY k)) AS markdown_sha256, (count(*) + 2)::INT AS n_lines FROM e GROUP BY user_id""",
    "trace_append": """
WITH o AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ordinal FROM events WHERE event_id % 3 = 0), m AS (SELECT user_id, max(ordinal) AS m FROM o GROUP BY user_id),
n AS (SELECT e.user_id, event_id, coalesce(m, 0) + row_number() OVER (PARTITION BY e.user_id ORDER BY ts, event_id) AS ordinal FROM events e LEFT JOIN m USING (user_id) WHERE event_id % 3 <> 0)
SELECT user_id, event_id, ordinal, least(20, event_id % 40 + 1)::INT AS n_candidates, NULL::VARCHAR AS violation FROM o
UNION ALL SELECT user_id, event_id, CASE WHEN user_id % 10 <> 0 THEN ordinal END, least(20, event_id % 40 + 1)::INT, CASE WHEN user_id % 10 = 0 THEN 'trace-not-started' END FROM n""",
    "newest_fusion": "SELECT user_id, max(event_id) AS ordinal, arg_max(value, event_id) AS value FROM events WHERE event_type = 'purchase' GROUP BY user_id",
    "catalog_handles": """
WITH p AS (SELECT conv_id AS trace_id, role AS document_path, (turn % 4)::VARCHAR AS section_id, min(turn) AS rank FROM conversations GROUP BY ALL),
h AS (SELECT *, rank < 3 AS held, rank > 0 AS seen, 'v' || (rank % 8) AS v FROM p),
n AS (SELECT *, coalesce(max(CASE WHEN held THEN rank + 1 END) OVER (PARTITION BY trace_id), 0) + row_number() OVER (PARTITION BY trace_id, held ORDER BY rank, document_path, section_id) AS k FROM h)
SELECT trace_id, document_path, section_id, CASE WHEN held THEN rank + 1 ELSE k END::INT AS handle_no, CASE WHEN held AND NOT seen AND trace_id % 3 = 0 THEN 'old' ELSE v END AS document_version, CASE WHEN held AND seen AND trace_id % 3 = 0 THEN 'document-version-changed' END AS violation FROM n""",
    "decision_audit": """
WITH c AS (SELECT conv_id AS trace_id, turn AS claim_no, role, turn % 5 = 0 OR trim(coalesce(text, '')) = '' AS blank, turn % 4 = 0 AS bare FROM conversations)
SELECT trace_id, claim_no, 'unknown-ref' AS violation FROM c WHERE NOT bare AND NOT EXISTS (SELECT 1 FROM conversations x WHERE x.conv_id = c.trace_id AND x.turn < 3 AND x.turn + 1 = c.claim_no)
UNION ALL SELECT trace_id, claim_no, 'unknown-claim-status' FROM c WHERE role = 'system' UNION ALL SELECT trace_id, claim_no, 'blank-claim' FROM c WHERE blank UNION ALL SELECT trace_id, claim_no, 'supported-needs-ref' FROM c WHERE role = 'user' AND bare""",
    "question_guards": r"""
WITH c AS (SELECT conv_id, turn, CASE WHEN turn % 6 = 0 THEN ' ' WHEN turn % 4 = 0 THEN text || '? and why?' ELSE text END AS text FROM conversations),
n AS (SELECT *, greatest(len(regexp_extract_all(text, '[?？]')), len(regexp_extract_all(text, '(?m)^\s*\d+[.)、．]\s*\S')))::INT AS n_questions FROM c)
SELECT conv_id, turn, n_questions, CASE WHEN trim(coalesce(text, '')) = '' THEN 'empty-question' WHEN n_questions >= 2 THEN 'several-questions' END AS violation FROM n""",
    "candidate_choice": """
WITH f AS (SELECT conv_id AS query_id, role AS document_path, (turn % 4)::VARCHAR AS section_id, min(turn) + 1 AS rank FROM conversations GROUP BY ALL)
SELECT * FROM f WHERE rank = 2 OR section_id = '2' OR document_path || '::' || section_id = CASE WHEN query_id % 2 = 0 THEN 'user::1' ELSE 'assistant::2' END""",
    "supplement_order": """
WITH c AS (SELECT conv_id AS query_id, role AS document_path, (turn % 4)::VARCHAR AS section_id, turn AS rank FROM conversations),
b AS (SELECT *, 0 AS part FROM c WHERE rank % 3 = 1 UNION ALL SELECT *, 1 FROM c WHERE rank % 2 = 0), f AS (SELECT *, row_number() OVER (PARTITION BY query_id, document_path, section_id ORDER BY part, rank) AS n FROM b)
SELECT query_id, document_path, section_id, row_number() OVER (PARTITION BY query_id ORDER BY part, rank, document_path, section_id) AS rank FROM f WHERE n = 1""",
    "candidate_names": "SELECT page_id, 'a/b/' || page_id AS vault_path, (page_id % 9)::INT AS line_start, (page_id % 9 + 3)::INT AS line_end, CASE WHEN page_id % 2 = 0 THEN 0.5 WHEN page_id % 3 = 0 THEN 0.25 END::DOUBLE AS score, CASE WHEN page_id % 2 = 0 THEN 'rerank' WHEN page_id % 3 = 0 THEN 'rrf' ELSE 'score' END AS score_type FROM pages",
    "verification_carriers": "SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'evidence-image' WHEN page_id % 3 = 0 THEN 'viewer' WHEN page_id % 2 = 0 AND page_id % 7 <> 0 THEN 'page-render' ELSE 'unavailable' END AS carrier FROM pages",
    "rerank_topk": f"""
WITH {BM25}, w AS (SELECT query_id, doc_id, rank, {TERMS} AS a FROM bm25 JOIN documents USING (doc_id)), v AS (SELECT item_id AS query_id, {TERMS} AS b FROM benchmark),
j AS (SELECT query_id, doc_id, rank, len(list_intersect(a, b)) AS n, len(a) AS x, len(b) AS y FROM w JOIN v USING (query_id)), z AS (SELECT query_id, doc_id, rank, CASE WHEN x > 0 AND y > 0 THEN round(n / (x + y - n), 6) ELSE 0 END::DOUBLE AS rerank_score FROM j)
SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, rank) AS rerank FROM z""",
    "hybrid_topk": ORACLE["near_dup_greedy"].replace("SELECT nb.query_id, nb.rank, nb.doc_id FROM nb", "SELECT * FROM (SELECT nb.query_id, nb.doc_id AS id, nb.rank AS was, row_number() OVER (PARTITION BY nb.query_id, lang, nb.doc_id % 50 ORDER BY nb.rank) AS n FROM nb JOIN documents ON documents.doc_id = nb.doc_id")
    .join(["WITH RECURSIVE z AS (", ") WHERE n = 1), r AS (SELECT query_id, id, round(1 / (60 + was), 8)::DOUBLE AS score, row_number() OVER (PARTITION BY query_id ORDER BY was) AS rank FROM z) SELECT * FROM r WHERE rank <= 6"]),
    "deepest_section": f"""
WITH {TURNS}, d AS (SELECT document_path, max(total_lines) AS n FROM turns GROUP BY document_path), p AS (SELECT document_path, unnest(generate_series(1, n, 3))::INT AS line FROM d),
m AS (SELECT p.document_path, p.line, s.section_id, row_number() OVER (PARTITION BY p.document_path, p.line ORDER BY s.level DESC NULLS LAST, s.start_line, s.section_id) AS k FROM p LEFT JOIN scopes s ON s.document_path = p.document_path AND p.line BETWEEN s.start_line AND s.end_line)
SELECT document_path, line AS block_id, line, section_id FROM m WHERE k = 1""",
    "routing_terms": """
WITH g AS (SELECT source, lang, min(doc_id) AS k FROM documents GROUP BY ALL) SELECT source, string_agg(CASE WHEN k % 2 = 0 THEN upper(lang) ELSE lang END, ',' ORDER BY k) AS terms FROM g GROUP BY source""",
    "projection": f"""
WITH {TURNS}, p AS (SELECT u.document_path AS d, u.turn, string_agg('t' || x, '>' ORDER BY x::INT) AS titles FROM (SELECT document_path, turn, unnest(string_split(path, '>')) AS x FROM up) u GROUP BY ALL),
s AS (SELECT s.*, titles, s.section_id::INT % 3 <> 0 AND s.document_path::INT % 5 <> 0 AS held FROM scopes s JOIN p ON p.d = s.document_path AND p.turn = s.turn WHERE s.document_path::INT % 7 <> 0)
SELECT document_path || '/document.md' AS document_path, document_path || '.pdf' AS source_filename, section_id, titles, CASE WHEN held THEN 1 ELSE end_line - start_line + 1 END::INT AS owned, CASE WHEN NOT held THEN 'untracked' WHEN level = 2 THEN 'ingested' ELSE 'pending' END AS ingest_status FROM s""",
    "dashboards": """
WITH n AS (SELECT CASE WHEN doc_id % 4 = 0 THEN '10_Raw/a' WHEN doc_id % 3 = 0 THEN '30_Cards' WHEN doc_id % 5 = 0 THEN '40_Concepts' ELSE '.obsidian' END AS folder, doc_id, n_chars % 1000 AS mtime, lang, doc_id % 2 = 0 AS card FROM documents),
p AS (SELECT *, folder || '/' || doc_id || '.md' AS path FROM n)
SELECT 'raw_sources' AS dashboard, path, folder AS value FROM p WHERE folder = '10_Raw/a' UNION ALL SELECT 'knowledge_cards', path, 'open, ' || lang FROM p WHERE folder = '30_Cards' AND card
UNION ALL SELECT * FROM (SELECT 'recent_changes', path, folder FROM p WHERE folder <> '.obsidian' ORDER BY mtime DESC, path LIMIT 20) UNION ALL SELECT 'concepts', path, 'open, ' || lang FROM p WHERE folder = '40_Concepts' AND NOT card""",
    "scalar_functions": r"""
SELECT page_id, regexp_replace(regexp_replace(url, '[^A-Za-z0-9._-]+', '-', 'g'), '^[-.]+|[-.]+$', '', 'g')[1:30] AS safe, page_id % 5 = 0 OR page_id % 3 = 0 AS flag, page_id::VARCHAR AS reason_path, CASE WHEN page_id % 2 = 0 THEN 'r::s' ELSE 'not selected' END AS reason,
  CASE WHEN page_id % 4 = 0 THEN 1 ELSE page_id % 30 + 1 END::INT AS page, CASE WHEN page_id % 4 = 0 THEN '7' ELSE (page_id % 4) || ',7' END AS pages,
  sha256(CASE WHEN contains(lower(html), '<table') THEN regexp_replace(html, '>\s*<', '>' || chr(10) || '<', 'g') ELSE html END) AS pretty_sha256,
  greatest(len(regexp_extract_all(url, '[?？]')), len(regexp_extract_all(url, '(?m)^\s*\d+[.)、．]\s*\S')))::INT AS n_questions FROM pages""",
    "path_functions": r"""
WITH r AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '\30_Cards\' WHEN page_id % 7 = 0 THEN 'C:/' ELSE '../' END || page_id || CASE WHEN page_id % 3 = 0 THEN '.MD' WHEN page_id % 4 = 0 THEN '.source-map.md' WHEN page_id % 5 = 0 THEN '/.hidden/x.md' ELSE '/' END AS raw FROM pages),
n AS (SELECT *, replace(raw, '\', '/') AS slashed, string_split(raw, '/')[-1] AS name FROM r)
SELECT page_id, regexp_replace(slashed, '^/+|/+$', '', 'g') AS normalised, NOT regexp_matches(slashed, '^/|^[A-Za-z]:') AND NOT list_contains(string_split(slashed, '/'), '..') AS relative, name,
  CASE WHEN regexp_matches(name, '.\.[^.]*$') THEN regexp_replace(name, '\.[^.]*$', '') ELSE name END AS stem, lower(regexp_extract(name, '.(\.[^.]*)$', 1)) AS suffix,
  ends_with(lower(raw), '.md') AND len([x for x in string_split(raw, '/') if starts_with(x, '.') OR starts_with(x, '~')]) = 0 AS visible, starts_with(regexp_replace(slashed, '^/+|/+$', '', 'g'), '30_Cards/') AS below FROM n""",
    "range_functions": """
WITH r AS (SELECT l_orderkey, l_linenumber, [x for x in [{'a': (l_partkey % 7)::INT, 'b': (l_suppkey % 9)::INT}, {'a': 3, 'b': (l_partkey % 5)::INT}] if x.a >= 1 AND x.b >= x.a] AS g, (l_suppkey % 4)::INT AS s FROM lineitem),
v AS (SELECT l_orderkey, l_linenumber, CASE WHEN len(g) > 0 THEN g WHEN s >= 1 AND s <= 3 THEN [{'a': s, 'b': 3}] ELSE [] END AS g FROM r)
SELECT l_orderkey, l_linenumber, 'lines-' || array_to_string([x.a || '-' || x.b for x in g], '+') AS block_id, coalesce(list_sum([x.b - x.a + 1 for x in g]), 0)::INT AS n_lines FROM v""",
}

MARKDOWN = r"""
b AS (SELECT conv_id, turn, CASE role WHEN 'system' THEN '#' WHEN 'user' THEN '##' ELSE '###' END || ' T' || turn || chr(10) || 'See [[n' || (turn % 3) || '|label]].' || chr(10) ||
  CASE WHEN turn % 5 = 1 THEN chr(10) || '| a | b |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || turn || ' | x |' || chr(10) || '| y |' || chr(10) ELSE '' END ||
  CASE WHEN turn % 2 <> 0 THEN '' WHEN turn % 4 = 0 THEN chr(10) || '- [x] do ' || turn ELSE chr(10) || '- [ ] do ' || turn END AS body FROM conversations),
m AS (SELECT conv_id, string_agg(body, chr(10) ORDER BY turn) AS text FROM b GROUP BY conv_id),
h AS (SELECT array_to_string(['---', 'type: card', 'tags: [a, ''b'']', 'list:', '  - x', '  - "y"', '# note', '---', ''], chr(10)) AS head),
d AS (SELECT conv_id::VARCHAR AS source, conv_id % 2 = 0 AS headed, text, CASE WHEN conv_id % 2 = 0 THEN head || text ELSE text END AS content FROM m, h),
l AS (SELECT source, generate_subscripts(a, 1) AS i, unnest(a) AS line, len(a) AS n FROM (SELECT source, string_split(content, chr(10)) AS a FROM d)),
hl AS (SELECT *, length(regexp_extract(line, '^(#{1,6})\s+(.*)$', 1)) AS level, trim(regexp_extract(line, '^(#{1,6})\s+(.*)$', 2)) AS title FROM l)
"""

SQL |= {
    "markdown_scan": f"""
WITH {MARKDOWN} SELECT d.source AS path, CASE WHEN headed THEN 'list=x+y;tags=a+b;type=card' END AS fields, sha256(regexp_replace(d.text, CASE WHEN headed THEN '\\n$' ELSE 'a^' END, '')) AS body_sha256, k.links
FROM d JOIN (SELECT conv_id::VARCHAR AS source, string_agg('n' || x, ',' ORDER BY low) AS links FROM (SELECT conv_id, turn % 3 AS x, min(turn) AS low FROM conversations GROUP BY ALL) GROUP BY conv_id) k ON k.source = d.source""",
    "markdown_tables": "SELECT conv_id::VARCHAR AS source, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS table_no, 'a,b' AS headers, turn || ',x' AS rows FROM conversations WHERE turn % 5 = 1",
    "markdown_tasks": f"WITH {MARKDOWN} SELECT source, i::INT AS line, starts_with(line, '- [x]') AS completed, line[7:] AS task FROM l WHERE starts_with(line, '- [')",
    "heading_outline": f"WITH {MARKDOWN} SELECT l.source AS document_path, i::INT AS start_line, level::INT AS level, title, (n - CASE WHEN ends_with(d.content, chr(10)) THEN 1 ELSE 0 END)::INT AS total_lines FROM hl l JOIN d USING (source) WHERE level > 0",
    "heading_sections": rf"""
WITH RECURSIVE {MARKDOWN}, s AS (SELECT source, i, level, title, n, row_number() OVER (PARTITION BY source ORDER BY i) AS k FROM hl WHERE level > 0),
f AS (SELECT source, k, i, [title][1:1] AS path FROM s WHERE k = 1 UNION ALL SELECT s.source, s.k, s.i, list_append(f.path[1:greatest(0, s.level - 1)], s.title) FROM f JOIN s ON s.source = f.source AND s.k = f.k + 1),
o AS (SELECT source, min(i) AS first FROM s GROUP BY source),
a AS (SELECT f.source, f.k - 1 + CASE WHEN o.first > 1 THEN 1 ELSE 0 END AS no, f.i AS a, coalesce((SELECT min(x.i) FROM s x WHERE x.source = f.source AND x.k = f.k + 1) - 1, (SELECT max(n) FROM l WHERE l.source = f.source)) AS b, array_to_string(f.path, ' > ') AS heading FROM f JOIN o ON o.source = f.source
  UNION ALL SELECT source, 0, 1, first - 1, '' FROM o WHERE first > 1),
t AS (SELECT a.*, trim((SELECT string_agg(line, chr(10) ORDER BY i) FROM l WHERE l.source = a.source AND l.i BETWEEN a.a AND a.b), chr(10) || ' ') AS text FROM a)
SELECT source, no::INT AS parent_number, a::INT AS start_line, b::INT AS end_line, heading, sha256(text) AS text_sha256, sha256(source || '|' || a || '|' || b || '|' || heading || '|' || text) AS parent_id FROM t WHERE text <> ''""",
    "casefold_words": f"WITH c AS (SELECT conv_id, turn, text || ' Straße ÄÖ ĲŁ' AS text FROM conversations) SELECT conv_id, turn, sha256(replace(lower(text), 'ß', 'ss')) AS folded_sha256, len({TERMS})::INT AS n_terms FROM c",
}

SQL["lint_summary"] = f"WITH u AS (SELECT * FROM ({SQL['lint_ledgers']}) UNION ALL SELECT * FROM ({SQL['lint_source_maps']}) UNION ALL SELECT * FROM ({SQL['lint_notes']})) SELECT severity, count(*) AS n, count(DISTINCT code) AS n_codes FROM u GROUP BY severity"

VALIDATED = """
p AS (SELECT 'b' || page_id AS d, page_id AS k FROM pages), c AS (SELECT 'c' || conv_id AS d, conv_id, turn AS t, CASE role WHEN 'user' THEN 'images' ELSE 'tables' END AS label FROM conversations),
e AS (SELECT *, CASE WHEN t % 6 = 5 THEN '' WHEN t % 4 = 3 THEN 'same' ELSE 'i' || t END AS id FROM c WHERE NOT (conv_id % 31 = 0 AND t = 0)),
r AS (SELECT *, CASE WHEN t % 7 = 6 THEN '' WHEN t % 5 = 4 THEN 'again' ELSE 's' || t END AS id, CASE WHEN t % 9 <> 4 THEN t * 3 - CASE WHEN t % 5 = 3 THEN 10 ELSE 0 END END AS a FROM c WHERE t % 8 <> 7),
g AS (SELECT *, lag(a, 1, 0) OVER (PARTITION BY d ORDER BY t) AS before FROM r WHERE a IS NOT NULL),
v AS (
SELECT d AS directory, 'missing-bundle' AS code, 'fail' AS severity, '' AS subject FROM p WHERE k % 29 = 0 UNION ALL SELECT d, 'missing-manifest', 'fail', '' FROM p WHERE k % 29 <> 0 AND k % 13 = 0
UNION ALL SELECT d, 'missing-document', 'fail', '' FROM p WHERE k % 29 <> 0 AND k % 11 = 0 UNION ALL SELECT d, 'invalid-json', 'fail', '' FROM p WHERE k % 29 <> 0 AND k % 13 <> 0 AND k % 17 = 0
UNION ALL SELECT d, 'invalid-json-shape', 'fail', '' FROM p WHERE k % 29 <> 0 AND k % 13 <> 0 AND k % 17 <> 0 AND k % 19 = 0
UNION ALL SELECT d, 'legacy-bundle-limited-evidence', 'warn', '' FROM p WHERE k % 7 = 0 UNION ALL SELECT d, 'invalid-profile', 'fail', '' FROM p WHERE k % 7 <> 0 AND k % 5 = 0
UNION ALL SELECT d, 'missing-outline', 'fail', '' FROM p WHERE k % 7 <> 0 AND k % 8 = 0 UNION ALL SELECT d, 'missing-outline-path', 'fail', '' FROM p WHERE k % 7 <> 0 AND k % 8 <> 0 AND k % 9 = 0
UNION ALL SELECT d, 'evidence-default-ingest-enabled', 'fail', '' FROM p WHERE k % 7 <> 0 AND k % 4 = 0 AND k % 12 = 0 UNION ALL SELECT d, 'missing-page-anchors', 'warn', '' FROM p WHERE k % 7 <> 0 AND k % 5 <> 0 AND k % 3 = 0 AND k % 2 <> 0
UNION ALL SELECT d, 'invalid-' || label || '-list', 'fail', '' FROM c WHERE conv_id % 31 = 0 AND t = 0 UNION ALL SELECT d, 'invalid-' || label || '-entry', 'fail', t::VARCHAR FROM e WHERE t % 10 = 9
UNION ALL SELECT d, 'missing-' || label || '-id', 'fail', t::VARCHAR FROM e WHERE t % 10 <> 9 AND id = '' UNION ALL SELECT d, 'duplicate-' || label || '-id', 'fail', id FROM (SELECT *, row_number() OVER (PARTITION BY d, label, id ORDER BY t) AS n FROM e WHERE t % 10 <> 9 AND id <> '') WHERE n > 1
UNION ALL SELECT d, 'missing-' || label || '-asset', 'fail', 'p' || t FROM e WHERE t % 10 <> 9 AND t % 5 = 0 UNION ALL SELECT d, 'missing-' || label || '-asset', 'fail', 'e' || t FROM e WHERE t % 10 <> 9 AND t % 2 = 0 AND t % 3 <> 0
UNION ALL SELECT d, 'empty-outline', 'warn', '' FROM p WHERE k % 10 = 0 UNION ALL SELECT d, 'invalid-section', 'fail', t::VARCHAR FROM c WHERE t % 8 = 7 UNION ALL SELECT d, 'missing-section-id', 'fail', t::VARCHAR FROM r WHERE id = ''
UNION ALL SELECT d, 'duplicate-section-id', 'fail', id FROM (SELECT *, row_number() OVER (PARTITION BY d, id ORDER BY t) AS n FROM r WHERE id <> '') WHERE n > 1
UNION ALL SELECT d, 'invalid-section-range', 'fail', CASE WHEN id = '' THEN t::VARCHAR ELSE id END FROM r WHERE a IS NULL OR a < 1 OR a + 2 > 14 UNION ALL SELECT d, 'unordered-sections', 'fail', '' FROM g WHERE a < before)
"""
SQL["bundle_validator"] = f"WITH {VALIDATED} SELECT * FROM v"
SQL["bundle_status"] = f"""WITH {VALIDATED}, n AS (SELECT directory, max(CASE severity WHEN 'fail' THEN 2 ELSE 1 END) AS worst, count(*) AS n FROM (SELECT DISTINCT * FROM v) GROUP BY directory)
SELECT a.d AS directory, CASE worst WHEN 2 THEN 'fail' WHEN 1 THEN 'warn' ELSE 'pass' END AS status, coalesce(n, 0) AS n_issues FROM (SELECT d FROM p UNION SELECT d FROM c) a LEFT JOIN n ON n.directory = a.d"""

LEDGERS = f"""
c AS (SELECT c_custkey AS k, c_custkey::VARCHAR AS directory, sha256(c_name) AS sha FROM customer),
h AS (SELECT *, k % 4 <> 0 AS known, k % 4 <> 0 AND k % 10 = 0 AS conflict FROM c WHERE k % 23 <> 0 AND k % 19 <> 0 AND k % 17 <> 0),
o AS (SELECT o_custkey::VARCHAR AS directory, o_custkey AS k, o_orderkey AS i, o_orderkey::VARCHAR AS id, o_totalprice::DECIMAL(18,2)::VARCHAR AS price, {ORDER_STATUS} AS held FROM orders),
b AS (SELECT o.*, i % 11 <> 0 AS is_new, i % 13 <> 0 AND o.k % 4 <> 0 AS is_old, i % 3 = 0 AS edited FROM o JOIN h ON h.directory = o.directory WHERE NOT conflict),
s AS (SELECT *, is_new AND is_old AND edited AS changed FROM b WHERE is_new OR is_old)
"""
SQL["ledger_heads"] = f"""
WITH {LEDGERS}, n AS (SELECT directory, count(*) AS n FROM s WHERE changed GROUP BY directory)
SELECT h.directory, CASE WHEN conflict THEN 'bundle-v2-other' ELSE 'bundle-v2-' || sha[1:16] END AS bundle_id, CASE WHEN conflict THEN k % 6 WHEN known THEN k % 6 + 1 ELSE 1 END AS revision, CASE WHEN known THEN 2020 ELSE 2022 END AS created,
  CASE WHEN known THEN 'reconciled' ELSE 'initialized' END AS action, CASE WHEN conflict THEN 'bundle-id-conflict' END AS violation, coalesce(n, 0) AS n_changed FROM h LEFT JOIN n ON n.directory = h.directory"""
SQL["ledger_documents"] = f"""
WITH {LEDGERS} SELECT directory, id, sha256(CASE WHEN is_new AND edited THEN price || '*' ELSE price END) AS content_sha256,
  CASE WHEN NOT is_old THEN CASE WHEN i % 8 = 0 OR i % 5 = 0 THEN 'qa_required' ELSE 'pending' END WHEN NOT is_new THEN 'stale' WHEN NOT changed THEN held WHEN held = 'qa_required' THEN 'qa_required' ELSE 'stale' END AS status,
  CASE WHEN NOT is_old THEN NULL WHEN changed THEN held WHEN i % 2 = 0 THEN 'pending' END AS previous_status, CASE WHEN is_old THEN 'out' ELSE '' END AS outputs, CASE WHEN is_old AND i % 6 = 0 THEN 'qa' ELSE '' END AS qa_items, CASE WHEN changed THEN 1 ELSE 0 END AS n_notes,
  CASE WHEN is_old AND NOT changed THEN 2021 END AS started, CASE WHEN NOT is_old THEN NULL WHEN changed THEN 2022 ELSE 2021 END AS updated, NOT is_new AS orphaned, CASE WHEN NOT is_new THEN 2022 END AS removed FROM s"""

SQL |= {
    "source_resolution": """
WITH w AS (SELECT page_id AS k, CASE WHEN page_id % 4 = 0 THEN '' ELSE 'sha' || (page_id % 3) END AS sha, page_id % 11 <> 0 AS named FROM pages),
f AS (SELECT k, 'docs/' || k || '.pdf' AS path, 0 AS place, 'sha' || (k % 3) AS h FROM w WHERE k % 2 = 0 AND k % 4 <> 2 UNION ALL SELECT k, '10_Raw/a/' || k || '.pdf', 1, 'sha' || (k % 3) FROM w WHERE k % 5 = 0 AND k % 7 < 3
  UNION ALL SELECT k, '10_Raw/' || k || '.pdf', 2, 'sha' || (k % 2) FROM w WHERE named AND k % 6 = 1),
d AS (SELECT f.k, arg_min(path, place) AS path FROM f JOIN w ON w.k = f.k WHERE sha = '' OR sha = h GROUP BY f.k),
r AS (SELECT k, '10_Raw/' || k || '.pdf' AS path, 'sha' || (k % 2) AS h FROM w WHERE k % 6 = 1 UNION ALL SELECT k, '10_Raw/a/' || k || '.pdf', 'sha' || (k % 3) FROM w WHERE k % 7 < 3 UNION ALL SELECT k, '10_Raw/b/' || k || '.pdf', 'sha' || (k % 3) FROM w WHERE k % 7 < 1),
l AS (SELECT r.k, min(path) AS path FROM r JOIN w ON w.k = r.k WHERE named AND (sha = '' OR sha = h) GROUP BY r.k HAVING count(*) = 1)
SELECT w.k AS page_id, coalesce(d.path, l.path) AS source_path, CASE WHEN d.path IS NOT NULL THEN 'path' WHEN l.path IS NOT NULL THEN 'name' ELSE 'unresolved' END AS found_by FROM w LEFT JOIN d ON d.k = w.k LEFT JOIN l ON l.k = w.k""",
    "asset_resolution": """
SELECT page_id AS asset_id, CASE WHEN page_id % 10 = 0 THEN NULL WHEN page_id % 3 = 0 AND page_id % 6 = 0 THEN '/abs/' || page_id || '.png' WHEN page_id % 3 <> 0 AND page_id % 5 = 0 THEN 'r1/img/' || page_id || '.png'
  WHEN page_id % 3 <> 0 AND page_id % 4 = 0 THEN 'r2/img/' || page_id || '.png' WHEN page_id % 5 = 0 THEN 'r1/img/' || page_id || '.png' WHEN page_id % 7 = 0 THEN 'r1/z/' || page_id || '.png'
  WHEN page_id % 2 = 0 THEN 'r2/deep/er/' || page_id || '.png' WHEN page_id % 4 = 0 THEN 'r2/img/' || page_id || '.png' END AS found FROM pages""",
    "output_choice": """
WITH p AS (SELECT page_id, (page_id / 4)::BIGINT AS x, page_id // 4 AS g FROM pages),
f AS (SELECT g, CASE WHEN page_id % 3 = 0 THEN 'Out/' ELSE 'out/deep/' END || CASE WHEN page_id % 2 = 0 THEN 'Stem' || g ELSE 'x' END || '-' || page_id || CASE WHEN page_id % 5 = 0 THEN '_Content.JSON' ELSE '.md' END AS path FROM p),
s AS (SELECT *, CASE WHEN contains(lower(path), 'stem' || g || '-') THEN 10 ELSE 0 END + CASE WHEN ends_with(lower(path), '_content.json') THEN 5 ELSE 0 END AS score FROM f)
SELECT g, path, score FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY score DESC, len(string_split(path, '/')), path) AS n FROM s) WHERE n = 1""",
    "sidecar_texts": """
WITH i AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations WHERE role = 'user'),
t AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations WHERE role = 'assistant' AND conv_id % 5 <> 0), c AS (SELECT DISTINCT conv_id, n FROM t)
SELECT i.conv_id, i.turn AS ordinal, 'i' || i.turn AS path, CASE WHEN c.n = i.n THEN 't' || t.turn END AS text, CASE WHEN c.n <> i.n THEN 'sidecar-count' END AS violation FROM i LEFT JOIN c ON c.conv_id = i.conv_id LEFT JOIN t ON t.conv_id = i.conv_id AND t.k = i.k""",
    "packet_provenance": """
WITH s AS (SELECT page_id, sha256(html) AS file_sha256, CASE WHEN page_id % 4 <> 0 AND page_id % 5 <> 0 THEN 'source' END AS source_sha256 FROM pages)
SELECT *, CASE WHEN page_id % 3 = 0 AND page_id % 2 <> 0 THEN 'ledger' ELSE coalesce(source_sha256, file_sha256) END AS document_version, page_id % 3 = 0 AS has_ledger, page_id % 4 <> 0 AS has_manifest FROM s""",
    "packet_outputs": """
WITH f AS (SELECT CASE WHEN doc_id % 2 = 0 THEN '30_Cards/' ELSE '50_Projects/' END || doc_id || '.md' AS path, text FROM documents),
o AS (SELECT doc_id AS section_id, unnest(['30_Cards/' || (doc_id % 90) || '.md', '50_Projects/' || (doc_id % 70) || '.md']) AS path FROM documents)
SELECT section_id, path, sha256(text[1:12000]) AS content_sha256, length(text) > 12000 AS content_truncated FROM o JOIN f USING (path)""",
    "block_features": """
WITH g AS (SELECT l_orderkey, """ + ", ".join(f"count(*) FILTER (l_partkey % 8 = {i}) AS n_{k}" for i, k in enumerate(("text", "image", "chart", "table", "equation", "list", "code"))) + """ FROM lineitem GROUP BY l_orderkey)
SELECT *, array_to_string(list_concat(CASE WHEN n_equation > 0 THEN ['formula-semantics'] ELSE [] END, CASE WHEN n_table > 0 THEN ['table-and-cross-page-structure'] ELSE [] END, CASE WHEN n_image + n_chart > 0 THEN ['figure-internals-when-used-as-evidence'] ELSE [] END), ',') AS review_required FROM g""",
    "spec_indexes": """
WITH e AS (SELECT o_custkey, o_orderkey AS k, unnest([0, 2]) AS pos, unnest([(o_orderkey % 4) || '.spec-index.md', (o_orderkey % 3) || 'x.spec-index.md']) AS path FROM orders), f AS (SELECT o_custkey, path, min(k * 10 + pos) AS first FROM e GROUP BY ALL)
SELECT o_custkey, string_agg(path, ',' ORDER BY first) AS paths FROM f GROUP BY o_custkey""",
    "request_guards": """
WITH s AS (SELECT conv_id AS r, turn + 1 AS i, conv_id % 5 = 0 AND turn = 2 AS open, CASE WHEN conv_id % 4 = 0 THEN 4 + CASE WHEN conv_id % 8 = 0 THEN turn % 2 ELSE 0 END END AS c FROM conversations WHERE turn < 3 AND NOT (conv_id % 9 = 4 AND turn = 1)),
g AS (SELECT r, bool_or(open) AS open, list(DISTINCT i) AS taken, count(DISTINCT c) AS counts, max(c) AS c FROM s GROUP BY r),
q AS (SELECT conv_id AS k, CASE WHEN conv_id % 10 <> 1 THEN conv_id END AS r, CASE WHEN conv_id % 6 <> 5 THEN turn + 2 END AS i, CASE WHEN conv_id % 2 = 0 THEN 5 - CASE WHEN conv_id % 7 = 0 THEN 5 ELSE 0 END END AS n FROM conversations)
SELECT k, i AS question_index, n AS question_count, CASE WHEN n < 1 THEN 'count-invalid' WHEN n IS NOT NULL AND q.r IS NULL THEN 'count-needs-request' WHEN n IS NOT NULL AND i IS NULL THEN 'count-needs-index' WHEN i > n THEN 'index-over-count'
  WHEN open THEN 'open-trace' WHEN list_contains(taken, i) THEN 'index-taken' WHEN len([x for x in generate_series(1, i - 1) if NOT list_contains(coalesce(taken, []), x)]) > 0 THEN 'index-not-sequential' WHEN counts > 1 THEN 'counts-inconsistent' WHEN counts = 1 AND n <> g.c THEN 'count-conflict' END AS violation
FROM q LEFT JOIN g ON g.r = q.r""",
    "trace_starts": """
WITH d AS (SELECT event_id, event_id - CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS trace_id FROM events), e AS (SELECT *, count(*) OVER (PARTITION BY trace_id) AS n FROM d)
SELECT event_id, trace_id, CASE WHEN trace_id IN (SELECT trace_id FROM d WHERE event_id % 7 = 0) THEN 'trace-exists' WHEN n > 1 THEN 'trace-id-repeated' END AS violation FROM e""",
}
