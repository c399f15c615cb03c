"""SQL for the driver queries, written apart from the operators, in DuckDB's dialect."""

from __future__ import annotations

TOKENS = r"regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[a-z0-9_]+|[\x{3400}-\x{9fff}]')"
TERMS = r"list_distinct(regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[\p{L}\p{M}\p{N}_]+'))"
QUERY_TOKEN = r"[A-Za-z]+\d*[A-Za-z0-9._/-]*|\d+[A-Za-z][A-Za-z0-9._/-]*|\d+(?:\.\d+)?"

BM25 = f"""
d AS (SELECT doc_id, {TOKENS} AS a FROM documents),
p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(a) AS term FROM d) GROUP BY doc_id, term),
l AS (SELECT doc_id, len(a) AS dl FROM d WHERE len(a) > 0),
n AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM l),
f AS (SELECT term, count(*) AS df, ln((SELECT n FROM n) - count(*) + 0.5) - ln(count(*) + 0.5) AS plain FROM p GROUP BY term),
i AS (SELECT term, CASE WHEN plain < 0 THEN 0.25 * (SELECT round(avg(plain), 9) FROM f) ELSE plain END AS idf FROM f),
q AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT item_id AS query_id, unnest({TOKENS}) AS term FROM benchmark) GROUP BY query_id, term),
s AS (SELECT query_id, p.doc_id, round(sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 6) AS score
  FROM p JOIN q ON p.term = q.term JOIN i ON p.term = i.term JOIN l ON p.doc_id = l.doc_id CROSS JOIN n GROUP BY query_id, p.doc_id),
bm25 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s) WHERE rank <= 20 AND score > 0)
"""

OVERLAP = f"""
dt AS (SELECT doc_id, unnest(list_distinct({TOKENS})) AS term FROM documents),
qt AS (SELECT item_id AS query_id, unnest(list_distinct({TOKENS})) AS term FROM benchmark),
sh AS (SELECT query_id, doc_id, count(*) AS shared FROM dt JOIN qt ON dt.term = qt.term GROUP BY query_id, doc_id),
overlap AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY shared DESC, doc_id) AS rank FROM sh) WHERE rank <= 20)
"""

TURNS = """
c AS (SELECT conv_id, turn, role, text, len(string_split(regexp_replace(text, '\\r\\n|\\r', chr(10), 'g'), chr(10))) AS n FROM conversations),
turns AS (SELECT conv_id::VARCHAR AS document_path, turn::VARCHAR AS section_id, turn, text, (sum(n) OVER (PARTITION BY conv_id ORDER BY turn) - n + 1)::INT AS start_line,
  CASE role WHEN 'system' THEN 1 WHEN 'user' THEN 2 ELSE 3 END AS level, (sum(n) OVER (PARTITION BY conv_id))::INT AS total_lines FROM c),
scopes AS (SELECT t.*, coalesce((SELECT min(x.start_line) FROM turns x WHERE x.document_path = t.document_path AND x.turn > t.turn AND x.level <= t.level) - 1, t.total_lines)::INT AS end_line,
  (SELECT max(x.turn) FROM turns x WHERE x.document_path = t.document_path AND x.turn < t.turn AND x.level < t.level) AS parent_turn FROM turns t),
up AS (SELECT s.document_path, s.turn, s.parent_turn, string_agg(a.section_id, '>' ORDER BY a.turn) AS path, count(*) AS depth FROM scopes s JOIN scopes a
  ON a.document_path = s.document_path AND a.turn <= s.turn AND a.end_line >= s.start_line AND NOT EXISTS
  (SELECT 1 FROM scopes z WHERE z.document_path = s.document_path AND z.turn > a.turn AND z.turn <= s.turn AND z.level <= a.level) GROUP BY ALL),
kids AS (SELECT k.document_path, k.parent_turn AS turn, k.start_line, k.end_line, max(k.end_line) OVER (PARTITION BY k.document_path, k.parent_turn ORDER BY k.start_line, k.end_line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM scopes k WHERE parent_turn IS NOT NULL),
gaps AS (SELECT s.document_path, s.turn, coalesce(k.before + 1, s.start_line) AS a, k.start_line - 1 AS b FROM scopes s JOIN kids k ON k.document_path = s.document_path AND k.turn = s.turn
  UNION ALL SELECT s.document_path, s.turn, coalesce(max(k.end_line) + 1, s.start_line), s.end_line FROM scopes s LEFT JOIN kids k ON k.document_path = s.document_path AND k.turn = s.turn GROUP BY s.document_path, s.turn, s.start_line, s.end_line),
own AS (SELECT document_path, turn, a::INT AS a, b::INT AS b FROM gaps WHERE a <= b)
"""

LOCATE = f"""
q AS (SELECT item_id AS query_id, list_distinct(regexp_extract_all(replace(lower(text), 'ß', 'ss'), '{QUERY_TOKEN}')) AS terms FROM benchmark),
r AS (SELECT source, source || ' ' || string_agg(DISTINCT lang, ' ' ORDER BY lang) AS routing FROM documents GROUP BY source),
ds AS (SELECT query_id, terms, source, [t for t in terms if contains(replace(lower(routing), 'ß', 'ss'), t)] AS m FROM q CROSS JOIN r),
dd AS (SELECT *, 5 * coalesce(list_sum([greatest(1, length(t) - 1) for t in m]), 0) AS document_score FROM ds),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY document_score DESC, source) AS n FROM dd) WHERE n <= 8),
x AS (SELECT query_id, source AS document_path, lpad(doc_id::VARCHAR, 12, '0') AS section_id, doc_id, document_score,
  [t for t in terms if contains(replace(lower(string_split(text, chr(10))[1]), 'ß', 'ss'), t)] AS tt, [t for t in terms if contains(lower(lang), t)] AS pt, [t for t in terms if contains(replace(lower(text), 'ß', 'ss'), t)] AS ct FROM top JOIN documents USING (source)),
y AS (SELECT *, document_score + 9 * coalesce(list_sum([greatest(1, length(t) - 1) for t in tt]), 0) + 4 * coalesce(list_sum([greatest(1, length(t) - 1) for t in pt]), 0) + 2 * coalesce(list_sum([greatest(1, length(t) - 1) for t in ct]), 0) AS plain FROM x),
z AS (SELECT *, plain - CASE WHEN doc_id % 5 = 0 THEN 3 ELSE 0 END AS score FROM y WHERE plain > 0),
located AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, document_path, section_id) AS rank FROM z)
"""

ORDER_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'ingested' WHEN 'O' THEN 'in_progress' ELSE 'qa_required' END"
SPANS = "s AS (SELECT user_id, event_id AS trace_id, epoch_us(ts) AS a, epoch_us(ts) + round(value * 3600000000)::BIGINT AS b FROM events), o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY a, b, trace_id) AS n FROM s), m AS (SELECT *, max({'e': b, 'n': -n, 'id': trace_id}) OVER (PARTITION BY user_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM o), v AS (SELECT user_id, trace_id, a, b, p.id AS previous_id, CASE WHEN a < p.e THEN least(b, p.e) - a ELSE 0 END AS overlap FROM m)"

TRANSITIONS = {
    "pending": "pending in_progress qa_required skipped", "in_progress": "in_progress pending ingested qa_required skipped", "qa_required": "qa_required in_progress skipped",
    "ingested": "ingested qa_required stale", "skipped": "skipped pending in_progress", "stale": "stale in_progress qa_required skipped",
}
ALLOWED = ", ".join(f"('{a}', '{b}')" for a, to in TRANSITIONS.items() for b in to.split())

ORACLE: dict[str, str] = {
    "bm25_topk": f"WITH {BM25} SELECT query_id, doc_id, score, rank FROM bm25",
    "knn_topk": """
WITH s AS (SELECT q.vec_id AS query_id, v.vec_id, round(list_cosine_similarity(v.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS similarity FROM embeddings v JOIN embeddings q ON q.vec_id % 20 = 0 AND v.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS rank FROM s)
SELECT query_id, vec_id, similarity, round(1 / (1 + (1 - similarity)), 6) AS score, rank FROM r WHERE rank <= 10""",
    "rrf_fusion": f"""
WITH {BM25}, {OVERLAP}, u AS (SELECT query_id, doc_id, rank, 'bm25' AS route, 0 AS place FROM bm25 UNION ALL SELECT query_id, doc_id, rank, 'overlap', 1 FROM overlap),
fused AS (SELECT query_id, doc_id, round(sum(1 / (60 + rank)), 8) AS score, string_agg(route, '+' ORDER BY route) AS routes, min(place * 1000000 + rank) AS seen FROM u GROUP BY query_id, doc_id)
SELECT query_id, doc_id, score, routes, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, seen, doc_id) AS rank FROM fused""",
    "near_dup_greedy": f"""
WITH RECURSIVE {BM25}, b AS (SELECT query_id, rank, doc_id, sha256(text) AS h, {TERMS} AS w FROM bm25 JOIN documents USING (doc_id)),
near AS (SELECT x.query_id, x.rank, y.rank AS other FROM b x JOIN b y ON x.query_id = y.query_id AND y.rank < x.rank
  WHERE x.h = y.h OR (len(x.w) > 0 AND len(y.w) > 0 AND len(list_intersect(x.w, y.w)) / (len(x.w) + len(y.w) - len(list_intersect(x.w, y.w))) >= 0.7)),
nb AS (SELECT b.query_id, b.rank, b.doc_id, coalesce(list(near.other) FILTER (near.other IS NOT NULL), []) AS others FROM b LEFT JOIN near ON b.query_id = near.query_id AND b.rank = near.rank GROUP BY ALL),
g AS (SELECT query_id, 0::BIGINT AS rank, []::BIGINT[] AS kept FROM (SELECT DISTINCT query_id FROM b)
  UNION ALL SELECT g.query_id, nb.rank, CASE WHEN len(list_intersect(nb.others, g.kept)) = 0 THEN list_append(g.kept, nb.rank) ELSE g.kept END FROM g JOIN nb ON nb.query_id = g.query_id AND nb.rank = g.rank + 1)
SELECT nb.query_id, nb.rank, nb.doc_id FROM nb JOIN g ON g.query_id = nb.query_id AND g.rank = nb.rank WHERE list_contains(g.kept, nb.rank)""",
    "exact_dup": "SELECT sha256(text) AS sha256, min(doc_id) AS kept_id, count(*) AS copies FROM documents GROUP BY 1 HAVING count(*) > 1",
    "chunk_windows": f"""
WITH d AS (SELECT doc_id, {TOKENS} AS a FROM documents), w AS (SELECT doc_id, a, unnest(generate_series(0, len(a) - 1, 170)) AS s FROM d WHERE len(a) > 0)
SELECT doc_id, (s // 170)::INT AS chunk_no, len(a[s + 1:s + 200]) AS n_tokens, sha256(array_to_string(a[s + 1:s + 200], ' ')) AS chunk_sha256 FROM w""",
    "section_outline": f"WITH {TURNS} SELECT s.document_path, s.section_id, s.level, s.start_line, s.end_line, s.parent_turn::VARCHAR AS parent, u.path FROM scopes s JOIN up u USING (document_path, turn)",
    "owned_ranges": f"""
WITH {TURNS} SELECT s.document_path, s.section_id, count(o.a) AS n_ranges, coalesce(sum(o.b - o.a + 1), 0) AS owned_lines, 'lines-' || coalesce(string_agg(o.a || '-' || o.b, '+' ORDER BY o.a), '') AS ranges, 0 AS n_misplaced
FROM scopes s LEFT JOIN own o USING (document_path, turn) GROUP BY s.document_path, s.section_id""",
    "chunk_to_section": f"""
WITH {TURNS}, k AS (SELECT document_path, unnest(generate_series(1, max(total_lines), 3)) AS chunk_id, max(total_lines) AS n FROM turns GROUP BY document_path),
r AS (SELECT document_path, turn, a, b FROM own UNION ALL SELECT document_path, turn, start_line, end_line FROM scopes s WHERE NOT EXISTS (SELECT 1 FROM own o WHERE o.document_path = s.document_path AND o.turn = s.turn)),
t AS (SELECT document_path, turn, sum(b - a + 1) AS owned_span FROM r GROUP BY ALL),
h AS (SELECT k.document_path, k.chunk_id, least(k.chunk_id + 3, k.n) AS line_end, s.section_id, t.owned_span, u.depth,
  row_number() OVER (PARTITION BY k.document_path, k.chunk_id ORDER BY t.owned_span, u.depth DESC, s.section_id) AS n
  FROM k JOIN r ON r.document_path = k.document_path AND k.chunk_id <= r.b AND least(k.chunk_id + 3, k.n) >= r.a JOIN scopes s ON s.document_path = r.document_path AND s.turn = r.turn JOIN t ON t.document_path = r.document_path AND t.turn = r.turn JOIN up u ON u.document_path = r.document_path AND u.turn = r.turn)
SELECT document_path, chunk_id, line_end, section_id, owned_span, depth FROM h WHERE n = 1""",
    "hierarchical_locate": f"""
WITH RECURSIVE {LOCATE}, so AS (SELECT query_id, section_id, document_path, score, document_score, ct, tt, rank, list_sort([(-length(t), t) for t in list_distinct(tt)]) AS st FROM located),
fold AS (SELECT query_id, section_id, 0::BIGINT AS i, []::VARCHAR[] AS kept FROM so
  UNION ALL SELECT f.query_id, f.section_id, f.i + 1, CASE WHEN len([k for k in f.kept if contains(k, s.st[f.i + 1][2])]) > 0 THEN f.kept ELSE list_append(f.kept, s.st[f.i + 1][2]) END FROM fold f JOIN so s ON s.query_id = f.query_id AND s.section_id = f.section_id WHERE f.i < len(s.st))
SELECT s.query_id, s.document_path, s.section_id, s.score, s.document_score, len(s.ct) AS n_content_terms, array_to_string(f.kept[1:8], ' ') AS title_terms, s.rank
FROM so s JOIN fold f ON f.query_id = s.query_id AND f.section_id = s.section_id AND f.i = len(s.st)""",
    "diversified_topk": f"""
WITH {LOCATE}, a AS (SELECT *, row_number() OVER (PARTITION BY query_id, document_path ORDER BY rank) AS in_doc FROM located),
b AS (SELECT *, in_doc = 1 AND sum(CASE WHEN in_doc = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY query_id ORDER BY rank) <= 3 AS lead FROM a),
p AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY lead DESC, rank) AS position FROM b)
SELECT query_id, document_path, section_id, rank, position FROM p WHERE position <= 10""",
    "scope_fusion": """
WITH c AS (SELECT conv_id AS query_id, role AS document_path, (turn % 4)::VARCHAR AS section_id, turn, length(text) AS n FROM conversations),
r AS (SELECT *, 'hierarchical' AS route, row_number() OVER (PARTITION BY query_id ORDER BY turn) AS rank FROM c UNION ALL SELECT *, 'coarse', row_number() OVER (PARTITION BY query_id ORDER BY n DESC, turn) FROM c),
l AS (SELECT query_id, document_path, section_id, route, max(rank) AS rank FROM r GROUP BY ALL),
f AS (SELECT query_id, document_path, section_id, string_agg(route, '+' ORDER BY route) AS routes, string_agg(route || '=' || rank, ',' ORDER BY route) AS route_ranks, round(sum(1 / (60 + rank)), 8) AS fusion_score, min(rank) AS best FROM l GROUP BY ALL)
SELECT query_id, document_path, section_id, routes, route_ranks, fusion_score, row_number() OVER (PARTITION BY query_id ORDER BY fusion_score DESC, best, document_path, section_id) AS rank FROM f""",
    "parent_cap": """
WITH r AS (SELECT lang AS query_id, source AS parent_id, doc_id, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS rank FROM documents)
SELECT query_id, parent_id, doc_id, n_chars, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id, parent_id ORDER BY rank) AS n FROM r) WHERE n <= 2""",
    "evidence_packet": f"""
WITH {TURNS}, d AS (SELECT document_path, string_agg(text, chr(10) ORDER BY turn) AS text FROM turns GROUP BY document_path),
k AS (SELECT s.document_path, s.section_id, 'lines-' || coalesce(string_agg(o.a || '-' || o.b, '+' ORDER BY o.a), '') AS block_id, coalesce(list(o.a ORDER BY o.a) FILTER (o.a IS NOT NULL), []) AS a, coalesce(list(o.b ORDER BY o.a) FILTER (o.a IS NOT NULL), []) AS b FROM scopes s LEFT JOIN own o USING (document_path, turn) GROUP BY s.document_path, s.section_id),
t AS (SELECT k.*, d.text, string_split(regexp_replace(regexp_replace(d.text, '\\r\\n|\\r', chr(10), 'g'), '\\n$', ''), chr(10)) AS ls FROM k JOIN d USING (document_path)),
u AS (SELECT document_path, section_id, block_id, text, array_to_string(flatten([ls[a[i]:b[i]] for i in range(1, len(a) + 1)]), chr(10)) AS content FROM t)
SELECT document_path, section_id, block_id, sha256(coalesce(content[1:12000], '')) AS content_sha256, length(coalesce(content, '')) > 12000 AS content_truncated, sha256(text) AS document_version FROM u""",
    "incremental_diff": """
WITH n AS (SELECT doc_id::VARCHAR AS source_id, sha256(text) AS new_sha256 FROM documents),
o AS (SELECT doc_id::VARCHAR AS source_id, sha256(CASE WHEN doc_id % 7 = 0 THEN 'x' || text ELSE text END) AS old_sha256 FROM documents WHERE doc_id % 10 <> 0 UNION ALL SELECT 'gone-' || doc_id, sha256(text) FROM documents WHERE doc_id % 13 = 0)
SELECT source_id, CASE WHEN old_sha256 IS NULL THEN 'added' WHEN new_sha256 IS NULL THEN 'removed' WHEN old_sha256 = new_sha256 THEN 'same' ELSE 'changed' END AS change, old_sha256, new_sha256 FROM n FULL JOIN o USING (source_id)""",
    "ledger_reconcile": f"""
WITH p AS (SELECT *, o_totalprice::DECIMAL(18,2)::VARCHAR AS price FROM orders), n AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN price || '*' ELSE price END AS new_hash FROM p WHERE o_orderkey % 11 <> 0),
o AS (SELECT o_orderkey AS id, price AS old_hash, {ORDER_STATUS} AS previous_status FROM p WHERE o_orderkey % 13 <> 0)
SELECT id, CASE WHEN old_hash IS NULL THEN 'added' WHEN new_hash IS NULL THEN 'removed' WHEN old_hash <> new_hash THEN 'changed' ELSE 'unchanged' END AS change, previous_status,
  CASE WHEN old_hash IS NULL THEN 'pending' WHEN new_hash IS NULL THEN 'stale' WHEN old_hash = new_hash THEN previous_status WHEN previous_status = 'qa_required' THEN 'qa_required' WHEN previous_status = 'pending' THEN 'pending' ELSE 'stale' END AS status, coalesce(new_hash, old_hash) AS content_hash FROM n FULL JOIN o USING (id)""",
    "ledger_summary": f"""
WITH s AS (SELECT o_custkey, {ORDER_STATUS} AS status, o_totalprice > 50000 AS unit, o_orderkey % 97 = 0 AS failed FROM orders),
g AS (SELECT o_custkey, {', '.join(f"count(*) FILTER (status = '{x}') AS {x}" for x in ("in_progress", "ingested", "pending", "qa_required", "skipped", "stale"))}, count(*) FILTER (unit) AS ingest_units_total, count(*) FILTER (unit AND status NOT IN ('ingested', 'skipped')) AS ingest_units_remaining, bool_or(failed) AS failed FROM s GROUP BY o_custkey)
SELECT * EXCLUDE (failed), CASE WHEN failed THEN 'blocked' WHEN ingest_units_total > 0 AND ingest_units_remaining = 0 THEN 'complete' ELSE 'active' END AS state FROM g""",
    "transition_audit": f"""
WITH allowed(a, b) AS (VALUES {ALLOWED}), e AS (SELECT event_id, user_id, CASE event_type WHEN 'view' THEN 'pending' WHEN 'click' THEN 'in_progress' WHEN 'purchase' THEN 'ingested' WHEN 'error' THEN 'stale' ELSE 'qa_required' END AS to_status, ts FROM events),
l AS (SELECT *, lag(to_status) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS from_status FROM e)
SELECT event_id, user_id, from_status, to_status, CASE WHEN NOT EXISTS (SELECT 1 FROM allowed WHERE a = from_status AND b = to_status) THEN 'invalid-transition' WHEN event_id % 2 = 0 THEN NULL WHEN to_status = 'ingested' THEN 'output-required'
  WHEN to_status = 'skipped' THEN 'note-required' WHEN to_status = 'qa_required' THEN 'qa-item-or-note-required' END AS violation FROM l WHERE from_status IS NOT NULL""",
    "stage_gap_audit": """
SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS observed, array_to_string([x for x in ['click', 'error', 'view'] if NOT list_contains(list(event_type), x)], ',') AS missing FROM events GROUP BY 1, 2""",
    "time_accounting": """
WITH g AS (SELECT user_id, round(coalesce(sum(value) FILTER (event_type IN ('view', 'click')), 0), 3) AS primary_ms, round(coalesce(sum(value) FILTER (event_type NOT IN ('view', 'click')), 0), 3) AS diagnostic_ms, count(*) AS n_events FROM events GROUP BY user_id)
SELECT *, 2000.0::DOUBLE AS total_ms, round(greatest(0, 2000 - primary_ms), 3)::DOUBLE AS unaccounted_ms FROM g""",
    "routes_in_order": """
WITH r AS (SELECT user_id, event_type AS route, min(event_id) AS a, min(event_id) FILTER (event_type <> 'error' AND floor(value) > 0) AS b FROM events GROUP BY ALL)
SELECT user_id, string_agg(route, ',' ORDER BY a) AS attempted, coalesce(string_agg(route, ',' ORDER BY b) FILTER (b IS NOT NULL), '') AS effective FROM r GROUP BY user_id""",
    "interval_overlap": f"WITH {SPANS} SELECT user_id, trace_id, previous_id, overlap FROM v",
    "request_metrics": f"WITH {SPANS} SELECT user_id, count(*) AS n_traces, max(b) - min(a) AS wall, count(*) FILTER (overlap > 0) AS n_overlaps, sum(overlap)::BIGINT AS overlap_total FROM v GROUP BY user_id",
    "contiguity_check": """
WITH g AS (SELECT conv_id, count(*) AS n_rows, min(turn) AS low, max(turn) AS high, count(DISTINCT turn) AS n_distinct FROM conversations GROUP BY conv_id)
SELECT *, low = 0 AND n_distinct = high + 1 AND n_rows = n_distinct AS contiguous FROM g""",
    "json_extensions": "SELECT event_id, json_extract(props, '$.k')::INT AS k, array_to_string(list_sort(json_keys(props)), ',') AS keys, len([x for x in json_keys(props) if x <> 'k']) AS n_unknown FROM events",
    "response_filter": """
WITH p AS (SELECT page_id, url, regexp_replace(url, '^https?://', '') AS rest FROM pages),
v AS (SELECT page_id, CASE WHEN page_id % 17 = 0 THEN url WHEN page_id % 19 = 0 THEN '../' || rest WHEN page_id % 23 = 0 THEN '/' || rest ELSE rest END AS vault_path, page_id % 5 AS a, page_id % 7 AS b FROM p)
SELECT page_id, vault_path, CASE WHEN vault_path IN ('', '.') OR regexp_matches(vault_path, '^/|^[A-Za-z]:') OR list_contains(string_split(vault_path, '/'), '..') THEN 'candidate-path-rejected' WHEN a < 1 OR b < a THEN 'candidate-lines-invalid' END AS reason FROM v""",
    "rule_audit": r"""
WITH s AS (SELECT doc_id, doc_id % 3 = 0 AS high, doc_id % 5 = 0 AS open_level, quality = 0 OR toxic = 1 AS qa, text, lower(text) AS low FROM labels JOIN documents USING (doc_id)),
p AS (SELECT *, len([x for x in ['needs-qa', 'qa_required', 'qa required', 'manual qa', '人工 qa', '人工复核', '待复核', '需复核', '不提升为权威', '暂不提升为权威', 'not authoritative', 'do not promote'] if contains(low, x)]) > 0 AS phrase FROM s)
SELECT 'qa.authority_overpromoted' AS code, 'error' AS severity, doc_id::VARCHAR AS path FROM p WHERE qa AND high
UNION ALL SELECT 'qa.boundary_weak', 'error', doc_id::VARCHAR FROM p WHERE qa AND NOT high AND NOT open_level AND NOT phrase
UNION ALL SELECT 'artifact.generator_placeholder', 'error', doc_id::VARCHAR FROM p WHERE regexp_matches(text, '\{[^{}\r\n]*\.join\([^{}\r\n]*\)[^{}\r\n]*\}')
UNION ALL SELECT 'evidence.coverage_ambiguous', 'error', doc_id::VARCHAR FROM p WHERE regexp_matches(text, '(?m)^\s*\|\s*(?:…|\.\.\.)\s*\|')""",
    "link_degree": """WITH e AS (SELECT page_id, unnest(list_distinct(regexp_extract_all(html, 'href="([^"]*)"', 1))) AS target FROM pages) SELECT target, count(*) AS inlinks, min(page_id) AS first_page FROM e GROUP BY target""",
    "capsule_render": r"""
WITH c AS (SELECT conv_id, turn, regexp_replace(replace(CASE WHEN length(trim(text)) > 80 THEN trim(text)[1:79] || '…' ELSE trim(text) END, '|', '\|'), '\s*\n\s*', ' ', 'g') AS body, CASE WHEN role <> 'user' THEN role || '-' || (turn % 3) END AS source FROM conversations),
h AS (SELECT conv_id, source, 'S' || row_number() OVER (PARTITION BY conv_id ORDER BY min(turn), source) AS handle FROM c WHERE source IS NOT NULL GROUP BY conv_id, source)
SELECT c.conv_id, count(*) AS n_claims, count(DISTINCT c.source) AS n_sources, sha256(string_agg('- ' || body || coalesce(' [' || handle || ']', ''), chr(10) ORDER BY turn)) AS body_sha256 FROM c LEFT JOIN h ON c.conv_id = h.conv_id AND c.source = h.source GROUP BY c.conv_id""",
    "governed_join_star": """
SELECT coalesce(r_name, 'untracked') AS region, count(*) AS n_lines, sum(l_extendedprice::DECIMAL(18,2))::DECIMAL(28,2) AS amount, count(*) FILTER (s_nationkey = c_nationkey) AS n_domestic, count(*) FILTER (l_returnflag = 'R') AS n_returned
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1""",
    "text_functions": rf"""
SELECT doc_id, len({TOKENS}) AS n_tokens, len({TERMS}) AS n_terms, regexp_replace(replace(lower(string_split(text, chr(10))[1]), 'ß', 'ss'), '\s+', '', 'g') AS title_key,
  CASE WHEN contains(lower(text), 'backlinks') THEN 'backlink' WHEN (length(text) - length(replace(text, '[[', ''))) / 2 > 5 AND length(text) < 300 THEN 'navigation' WHEN starts_with(text, '---') THEN 'metadata' ELSE 'normal' END AS chunk_type,
  CASE WHEN length(trim(text)) > 40 THEN trim(text)[1:39] || '…' ELSE trim(text) END AS short, sha256(text) AS sha256, len(string_split(text, chr(10))) AS n_lines FROM documents""",
    "question_terms": f"""
WITH RECURSIVE q AS (SELECT item_id AS query_id, list_sort([(-length(t), t) for t in list_distinct(regexp_extract_all(replace(lower(text), 'ß', 'ss'), '{QUERY_TOKEN}'))]) AS st FROM benchmark),
fold AS (SELECT query_id, 0::BIGINT AS i, []::VARCHAR[] AS kept FROM q UNION ALL SELECT f.query_id, f.i + 1, CASE WHEN len([k for k in f.kept if contains(k, q.st[f.i + 1][2])]) > 0 THEN f.kept ELSE list_append(f.kept, q.st[f.i + 1][2]) END FROM fold f JOIN q USING (query_id) WHERE f.i < len(q.st))
SELECT q.query_id, array_to_string([x[2] for x in q.st], ' ') AS terms, array_to_string(f.kept[1:12], ' ') AS compact, 2 * coalesce(list_sum([greatest(1, length(x[2]) - 1) for x in q.st]), 0) AS full_score FROM q JOIN fold f ON f.query_id = q.query_id AND f.i = len(q.st)""",
    "corpus_state": "SELECT o_custkey, count(DISTINCT o_orderpriority) <= 1 AS consistent FROM orders GROUP BY o_custkey",
    "section_slices": "WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents) SELECT doc_id, sha256(array_to_string(list_concat(ls[1:2], ls[4:5]), chr(10))) AS slice_sha256 FROM d",
}
