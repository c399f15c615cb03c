"""Golden cases of operators: the order-dependent ones against plain Python, the others by hand."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lodestone.config import Settings, collection_name, vault_id
from lodestone.functions import paths, text
from lodestone.model import SECTION_STATUSES, TRANSITIONS
from lodestone.operators import catalog, chunking, evidence, fusion, headings, hierarchy, ledger, lint, render, retrieval, session, source_map, sync, trace


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f("x").alias("y")).first().y


@pytest.mark.parametrize(("value", "want"), [("Straße AB_1 é漢字", ["strasse", "ab_1", "漢", "字"]), ("", []), ("x-y", ["x", "y"])])
def test_tokens(spark, value, want):
    assert one(spark, value, text.tokens) == want


@pytest.mark.parametrize(("value", "want"), [
    ("Which DN150 valve?", ["dn150", "valve", "which"]), ("浓", []), ("浓缩器", ["浓缩器", "浓缩", "缩器"]), ("pump 3.5 a", ["pump", "3.5", "a"]), ("甲乙丙丁戊", ["丙丁戊", "乙丙丁", "甲乙丙", "乙丙丁戊", "甲乙丙丁", "丁戊", "丙丁", "乙丙", "甲乙"]),
])
def test_query_terms(spark, value, want):
    assert one(spark, value, text.query_terms) == sorted(want, key=lambda t: (-len(t), t))


def test_compact_terms_and_scores(spark):
    row = spark.createDataFrame([(["60", "160", "k160", "b", "k160"],)], "t array<string>").select(text.compact_terms(F.col("t")).alias("c"), text.compact_terms(F.col("t"), 1).alias("d"), text.match_score(text.matched(F.col("t"), F.lit("k160b")), 2).alias("s")).first()
    assert row.c == ["k160", "b"] and row.d == ["k160"] and row.s == 2 * (1 + 2 + 3 + 1 + 3)


@pytest.mark.parametrize(("body", "path", "want"), [("see BACKLINKS", "a.md", "backlink"), ("[[a]]" * 6, "a.md", "navigation"), ("[[a]]" * 5, "a.md", "normal"), ("x", "b/c.Source-Map.md", "index"), ("---\na", "a.md", "metadata"), ("[[a]]" * 6 + "x" * 300, "a.md", "normal")])
def test_chunk_type(spark, body, path, want):
    assert spark.createDataFrame([(body, path)], "b string, p string").select(text.chunk_type("b", "p")).first()[0] == want


@pytest.mark.parametrize(("path", "good"), [("a/b.md", True), ("/a", False), ("..", False), ("a/../b", False), ("", False), (".", False), ("C:\\x", False), ("a\\b", True), (None, False)])
def test_relative_paths(spark, path, good):
    assert one(spark, path, paths.is_relative) is good


def test_lines_and_ranges(spark):
    df = spark.createDataFrame([("a\r\nb\rc\n", [(1, 2), (3, 9)])], "x string, r array<struct<start_line:int,end_line:int>>")
    row = df.select(text.lines("x").alias("a"), text.content_lines("x").alias("b"), text.read_ranges(text.content_lines("x"), F.col("r")).alias("c"), text.ranges_id(F.col("r")).alias("d"), text.read_ranges(text.content_lines("x"), F.col("r"), marks=True).alias("e")).first()
    assert row.a == ["a", "b", "c", ""] and row.b == ["a", "b", "c"] and row.c == "a\nb\nc" and row.d == "lines-1-2+3-9"
    assert row.e.startswith("<!-- lines 1-2 -->\na\nb\n<!-- lines 3-9 -->\nc")


def sections_reference(body):
    out, current, start, path = [], [], 1, []
    all_lines = body.replace("\r\n", "\n").split("\n")
    for n, line in enumerate([*all_lines, None], 1):
        m = re.match(r"^(#{1,6})\s+(.*)", line) if line is not None else None
        if (m or line is None) and current:
            content = "\n".join(current).strip()
            if content:
                out.append((start, n - 1, " > ".join(path), content))
            current = []
        if m:
            path = [*path[: len(m[1]) - 1], m[2].strip()]
            start = n
        if line is not None:
            current.append(line)
    return out


@pytest.mark.parametrize("body", ["", "plain", "# A\n\n## B\nx\n### C\n# D\ny\n", "pre\n# A\n### B1\n### B2\nz", "#\n# \n#x\n", "\n\n# A\n\n", "```\n# in code\n```\n# A"])
def test_parent_sections(spark, body):
    docs = spark.createDataFrame([("s.md", body)], "source string, content string")
    got = [(r.start_line, r.end_line, r.heading, r.parent_text) for r in chunking.parent_sections(docs).orderBy("start_line").collect()]
    assert got == sections_reference(body)


def test_fenced_headings_can_be_skipped(spark):
    docs = spark.createDataFrame([("s.md", "```\n# in code\n```\n# A\nx")], "source string, content string")
    assert [r.heading for r in chunking.parent_sections(docs, skip_fences=True).orderBy("start_line").collect()] == ["", "A"]


def test_child_chunks(spark):
    long = "浓缩条件。" * 200
    docs = spark.createDataFrame([("s.md", "# T\n" + long), ("t.md", "short")], "source string, content string")
    rows = chunking.chunk_documents(docs, size=80, overlap=0.1).orderBy("source", "chunk_no").collect()
    assert [r.text for r in rows if r.source == "t.md"] == ["short"]
    mine = [r for r in rows if r.source == "s.md"]
    assert len(mine) > 5 and all(r.tokens <= 80 and r.heading == "T" for r in mine) and len({r.parent_id for r in mine}) == 1
    assert len({r.id for r in rows}) <= len(rows) and all(len(r.id) == 64 for r in rows)


def greedy_reference(items, threshold=0.7):
    kept, seen = [], set()
    terms = lambda t: set(re.findall(r"\w+", t.lower()))
    for rank, kind, t in items:
        if kind in ("navigation", "backlink") or not t or t in seen:
            continue
        seen.add(t)
        if any(terms(t) and terms(k) and len(terms(t) & terms(k)) / len(terms(t) | terms(k)) >= threshold for _, k in kept):
            continue
        kept.append((rank, t))
    return [r for r, _ in kept]


def test_near_duplicates_in_rank_order(spark):
    rng = random.Random(2)
    for trial in range(3):
        items = [(i + 1, rng.choice(["normal", "normal", "backlink"]), " ".join(sorted(rng.sample("abcdefgh", rng.randint(0, 7))))) for i in range(25)]
        df = spark.createDataFrame([(trial, *x) for x in items], "query_id long, rank int, chunk_type string, text string")
        assert sorted(r["rank"] for r in fusion.drop_near_duplicates(df).collect()) == greedy_reference(items)


def test_a_dropped_row_suppresses_none(spark):
    a, b, c = "a b c d e f g h i j", "a b c d e f g h i z", "z b c d e f y h i x"
    df = spark.createDataFrame([(1, 1, a), (1, 2, b), (1, 3, c)], "query_id long, rank int, text string")
    assert [r["rank"] for r in fusion.drop_near_duplicates(df).orderBy("rank").collect()] == [1, 3]


def diversify_reference(docs, limit):
    selected, covered = [], set()
    for i, d in enumerate(docs):
        if d in covered:
            continue
        selected.append(i)
        covered.add(d)
        if len(covered) >= min(3, max(1, limit)):
            break
    for i, _ in enumerate(docs):
        if i in selected:
            continue
        selected.append(i)
        if len(selected) >= max(1, limit):
            break
    return selected


@pytest.mark.parametrize("limit", [1, 2, 3, 4, 6, 30])
def test_diversify(spark, limit):
    docs = list("aaabacaaadbb")
    df = spark.createDataFrame([(1, i + 1, d, str(i)) for i, d in enumerate(docs)], "query_id long, rank int, document_path string, section_id string")
    got = [r["rank"] - 1 for r in fusion.diversify(df, limit).orderBy("position").collect()]
    assert got == diversify_reference(docs, limit)
    assert len(fusion.diversify(df, limit, strict_limit=True).collect()) == min(limit, len(docs))


def test_scope_fold(spark):
    rows = [
        (1, 1, "h", 1, 9.0, "d", "s1", "Title", [(1, 5)]), (1, 2, "h", 2, 8.0, "d", "s2", "Other", [(6, 9)]),
        (1, 3, "c", 1, 0.9, "d", "s1", None, [(4, 7)]), (1, 4, "c", 2, 0.8, "d", None, "ti tle", [(2, 3)]), (1, 5, "c", 3, 0.7, "d", None, None, [(20, 21)]), (1, 6, "c", 4, 0.6, "d", None, None, [(21, 25)]), (1, 7, "c", 5, 0.5, "e", "s1", "Title", [(1, 5)]),
    ]
    df = spark.createDataFrame(rows, "query_id long, ordinal int, route string, rank int, score double, document_path string, section_id string, title string, content_ranges array<struct<start_line:int,end_line:int>>")
    got = {(r.document_path, r.section_id): r for r in fusion.fuse_scopes(df).collect()}
    assert set(got) == {("d", "s1"), ("d", "s2"), ("d", None), ("e", "s1")}
    assert got["d", "s1"].route_ranks == {"h": 1, "c": 2} and got["d", "s1"].fusion_score == round(1 / 61 + 1 / 62, 8)
    assert [tuple(x) for x in got["d", None].content_ranges] == [(20, 21), (21, 25)]
    best = {(r.document_path, r.section_id): r for r in fusion.fuse_scopes(df, rank_policy="best").collect()}
    assert best["d", "s1"].route_ranks == {"h": 1, "c": 1}


def test_outline_and_owned_ranges(spark):
    heads = [("d", "a", 1, 1, 20), ("d", "b", 3, 3, 20), ("d", "c", 5, 3, 20), ("d", "e", 9, 2, 20), ("d", "f", 15, 1, 20), ("d", "g", 15, 2, 20)]
    df = spark.createDataFrame(heads, "document_path string, section_id string, start_line int, level int, total_lines int")
    got = {r.section_id: r for r in hierarchy.owned_ranges(hierarchy.outline(df)).collect()}
    assert {k: (r.end_line, r.parent, r.path) for k, r in got.items()} == {"a": (14, None, ["a"]), "b": (4, "a", ["a", "b"]), "c": (8, "a", ["a", "c"]), "e": (14, "a", ["a", "e"]), "f": (20, None, ["f"]), "g": (20, "f", ["f", "g"])}
    assert [tuple(x) for x in got["a"].content_ranges] == [(1, 2)] and got["f"].content_ranges == [] and not got["f"].ingest_unit
    out = spark.createDataFrame([("d", "p", None, 1, 5), ("d", "q", "p", 4, 8)], "document_path string, section_id string, parent string, start_line int, end_line int")
    assert {r.section_id: r.misplaced for r in hierarchy.owned_ranges(out).collect()} == {"p": ["q"], "q": []}


def test_chunks_go_to_the_smallest_owner(spark):
    sections = spark.createDataFrame([("d", "root", ["r"], 1, 10, [(1, 2)]), ("d", "deep", ["r", "d"], 3, 4, [(3, 4)]), ("d", "wide", ["w"], 3, 10, [])], "document_path string, section_id string, path_titles array<string>, start_line int, end_line int, content_ranges array<struct<start_line:int,end_line:int>>")
    chunks = spark.createDataFrame([("d", "1", 2, 3), ("d", "2", 5, 6), ("d", "3", 11, 12), ("x", "4", 1, 1)], "document_path string, chunk_id string, line_start int, line_end int")
    assert {r.chunk_id: r.section_id for r in hierarchy.chunk_sections(chunks, sections).collect()} == {"1": "deep", "2": "wide", "3": None, "4": None}


def test_locate(spark):
    queries = spark.createDataFrame([(1, "spray K160")], "query_id long, text string")
    docs = spark.createDataFrame([("a.md", "a.pdf spray", "# A\nK=160 spray\nx"), ("b.md", "b.pdf", "nothing")], "document_path string, routing string, text string")
    secs = spark.createDataFrame([("a.md", "s", "Spray", ["A", "Spray"], [(1, 2)], "pending", "a.pdf"), ("a.md", "t", "T", ["A"], [(3, 3)], "ingested", "a.pdf"), ("b.md", "u", "U", [], [(1, 1)], "ingested", "b.pdf")], "document_path string, section_id string, title string, path_titles array<string>, content_ranges array<struct<start_line:int,end_line:int>>, ingest_status string, source_filename string")
    got = {r.section_id: r.score for r in hierarchy.locate(queries, docs, secs).collect()}
    assert got == {"s": 5 * 4 + 9 * 4 + 4 * 4 + 2 * 4 - 3, "t": 20}


@pytest.mark.parametrize("status", SECTION_STATUSES)
def test_reconcile_all_statuses(spark, status):
    old = spark.createDataFrame([(1, "h", status), (2, "h", status), (3, "h", status)], "id long, content_hash string, status string")
    new = spark.createDataFrame([(1, "h", "pending"), (2, "x", "pending"), (4, "y", "qa_required")], "id long, content_hash string, initial_status string")
    got = {r.id: (r.change, r.status) for r in ledger.reconcile(new, old, ["id"]).collect()}
    changed = {"qa_required": "qa_required", "pending": "pending"}.get(status, "stale")
    assert got == {1: ("unchanged", status), 2: ("changed", changed), 3: ("removed", "stale"), 4: ("added", "qa_required")}


def test_all_transitions(spark):
    pairs = [(a, b) for a in SECTION_STATUSES for b in SECTION_STATUSES]
    df = spark.createDataFrame([(a, b, ["o"], ["n"]) for a, b in pairs], "from_status string, to_status string, outputs array<string>, notes array<string>")
    for r in ledger.audit_transitions(df).collect():
        assert (r.violation is None) == (r.to_status in TRANSITIONS[r.from_status])
    bad = spark.createDataFrame([("pending", "odd", 1, 1, True, False), ("in_progress", "ingested", 1, 2, True, False), ("pending", "in_progress", 1, 1, False, False), ("pending", "ingested", 1, 1, False, True)], "from_status string, to_status string, expected_revision int, revision int, ingest_unit boolean, force boolean")
    assert [r.violation for r in ledger.audit_transitions(bad).collect()] == ["unknown-status", "revision-conflict", "no-owned-lines", "output-required"]


def test_apply_changes(spark):
    sections = spark.sql("SELECT 'a' AS id, 'pending' AS status, CAST(NULL AS STRING) AS previous_status, array('n0') AS notes, CAST(NULL AS TIMESTAMP) AS started_at, CAST(NULL AS TIMESTAMP) AS completed_at, CAST(NULL AS TIMESTAMP) AS updated_at")
    changes = spark.createDataFrame([("a", "pending", "skipped", ["n1", "n0"])], "id string, from_status string, to_status string, notes array<string>")
    r = ledger.apply_changes(sections, changes, ["id"]).first()
    assert (r.status, r.previous_status, r.notes, r.started_at) == ("skipped", "pending", ["n0", "n1"], None) and r.completed_at == r.updated_at is not None


def test_summary_states(spark):
    rows = [("a", "ingested", True), ("a", "skipped", True), ("b", "pending", True), ("c", "stale", False), ("d", "stale", True)]
    got = {r.k: (r.state, r.ingest_units_total, r.ingest_units_remaining) for r in ledger.summarise(spark.createDataFrame(rows, "k string, status string, ingest_unit boolean"), ["k"]).collect()}
    assert got == {"a": ("complete", 2, 0), "b": ("active", 1, 1), "c": ("active", 0, 0), "d": ("stale", 1, 1)}


def test_overlaps_by_running_maximum(spark):
    rows = [("r", 1, 0, 10), ("r", 2, 5, 8), ("r", 3, 9, 12), ("r", 4, 12, 13), ("r", 5, 12, 12)]
    got = {r.trace_id: (r.previous_id, r.overlap) for r in trace.interval_overlaps(spark.createDataFrame(rows, "g string, trace_id long, start_at long, end_at long"), ["g"]).collect()}
    assert got == {1: (None, 0), 2: (1, 3), 3: (1, 1), 5: (3, 0), 4: (3, 0)}


def test_trace_constraints(spark):
    ev = spark.createDataFrame([("t", "E1", "a.md", "v", "verified", ""), ("t", "E1", "b.md", "", "odd", "x")], "trace_id string, evidence_id string, path string, document_version string, original_asset_status string, original_asset_path string")
    files = spark.createDataFrame([("a.md",)], "path string")
    assert sorted({r.violation for r in trace.evidence_violations(ev, files).collect()}) == ["duplicate-evidence-id", "path-missing", "unknown-asset-status", "verified-needs-asset", "version-required"]
    claims = spark.createDataFrame([("t", "C1", "supported", []), ("t", "C2", "qualified", ["E9", "E1"])], "trace_id string, claim_id string, status string, evidence_ids array<string>")
    assert sorted(map(tuple, trace.claim_violations(claims, ev).collect())) == [("t", "C1", "supported-needs-evidence"), ("t", "C2", "unknown-evidence")]
    done = spark.createDataFrame([("t", "completed", "clear", 1, 0, 0)], "trace_id string, status string, evidence_level string, n_open_stages int, n_evidence int, n_claims int")
    assert sorted(r.violation for r in trace.finish_violations(done).collect()) == ["claims-required", "evidence-required", "open-stages"]


def test_session_limits_and_guards(spark):
    s = session.Session("t")
    assert [s.supplement(), s.inspect(), s.supplement(), s.evidence_dirty, s.supplement(), s.inspect(), s.inspect()] == [False, True, True, True, False, True, False]
    rows = spark.createDataFrame([("a? b? c?",), ("1. one\n2. two",), ("plain",), (" ",), (None,)], "text string")
    assert [r.violation for r in session.question_guard(rows).collect()] == ["several-questions", "several-questions", None, "empty-question", "empty-question"]
    cat = spark.createDataFrame([("t", 1, "d", "s", "v1")], "trace_id string, handle_no int, document_path string, section_id string, document_version string")
    got = session.upsert_catalog(cat, spark.createDataFrame([("t", "d", "s", "v2", 1), ("t", "d", "n", "v1", 2)], "trace_id string, document_path string, section_id string, document_version string, rank int"))
    assert sorted((r.handle_no, r.section_id, r.violation) for r in got.collect()) == [(1, "s", "document-version-changed"), (2, "n", None)]


def test_packets_and_candidates(spark):
    rows = spark.createDataFrame([("a.md", 1, 2, "h"), ("../x", 1, 1, None), ("a.md", 3, 2, "h"), ("b.md", 1, 1, None), ("a.md", 1, 9, "g")], "vault_path string, line_start int, line_end int, source_sha256 string")
    files = spark.createDataFrame([("a.md", "g", 5)], "path string, sha256 string, n_lines int")
    got = sorted(((r.vault_path, r.line_start, r.line_end), r.reason, r.warning) for r in evidence.validate_candidates(rows, files).collect())
    assert [x[1] for x in got] == ["candidate-path-rejected", None, "candidate-lines-invalid", "candidate-lines-invalid", "candidate-missing"]
    assert got[1][2] == "candidate-source-changed"
    fused = spark.createDataFrame([(1, i, "d", f"s{i}") for i in range(1, 6)], "query_id long, rank int, document_path string, section_id string")
    assert [r["rank"] for r in evidence.select_candidates(fused).orderBy("rank").collect()] == [1, 2, 3]
    wanted = spark.createDataFrame([(1, "2"), (1, "s4"), (1, "d::s5"), (1, "s2")], "query_id long, selector string")
    assert [r["rank"] for r in evidence.select_candidates(fused, wanted).orderBy("rank").collect()] == [2, 4, 5]


def test_sync(spark):
    docs = spark.createDataFrame([("a", "# A\nx"), ("b", "new")], "source string, content string")
    old = spark.createDataFrame([("a", "# A\nx"), ("b", "old"), ("c", "gone")], "source string, content string")
    changes = sync.difference(sync.fingerprints(docs), sync.fingerprints(old))
    assert {r.source_id: r.change for r in changes.collect()} == {"a": "same", "b": "changed", "c": "removed"}
    chunks = sync.refresh_chunks(chunking.chunk_documents(old), docs, changes)
    assert sorted((r.source, r.text) for r in chunks.collect()) == [("a", "# A\nx"), ("b", "new")]
    state = sync.index_state(sync.fingerprints(docs), chunks, {"k": 1}, "v").first().asDict()
    assert sync.recall_gate(state, {"k": 1}) is None and sync.recall_gate(state, {"k": 2}) == "configuration-changed" and sync.recall_gate(sync.absent_state(spark, "v").first().asDict(), {}) == "index-not-ready"
    again = sync.index_state(sync.fingerprints(docs.repartition(3).orderBy(F.desc("source"))), chunks, {"k": 1}, "v").first()
    assert again.corpus_fingerprint == state["corpus_fingerprint"]


def test_hybrid_recall_and_scope(spark):
    body = "# Pumps\nspray pump with a nozzle K160\n## Valves\nthe valve DN150 closes slowly\n# Other\nnothing of note\n"
    docs = spark.createDataFrame([("a.md", body), ("b.md", "# Doors\na door opens\n# Windows\nglass and frames\n# Roof\ntiles\n")], "source string, content string")
    chunks, settings = chunking.chunk_documents(docs), Settings(use_reranker=True)
    queries = spark.createDataFrame([(1, "which spray pump nozzle"), (2, "valve DN150")], "query_id long, text string")
    want = {"settings": settings.fingerprint(), "models": settings.model_fingerprint()}
    state = sync.index_state(sync.fingerprints(docs), chunks, want, "v").first().asDict()
    vectors = chunks.select("id", F.array(F.length("text").cast("float"), F.lit(1.0).cast("float")).alias("embedding"))
    asked = queries.select("query_id", F.array(F.lit(30.0).cast("float"), F.lit(1.0).cast("float")).alias("embedding"))
    found, warnings = retrieval.recall(chunks, queries, settings, state, vectors=vectors, query_vectors=asked)
    assert not warnings and {r.query_id: r.heading for r in found.filter("rank = 1").collect()} == {1: "Pumps", 2: "Pumps > Valves"}
    none, warnings = retrieval.recall(chunks, queries, Settings(chunk_size=9), state)
    assert none.count() == 0 and warnings == ["configuration-changed"]
    md = docs.select(F.col("source").alias("document_path"), F.col("content").alias("markdown"))
    sections = hierarchy.owned_ranges(hierarchy.outline(render.headings(md))).withColumn("path_titles", F.array("title")).withColumn("ingest_status", F.lit("ingested")).withColumn("source_filename", F.col("document_path"))
    located = hierarchy.locate(queries, md.select("document_path", F.col("document_path").alias("routing"), F.col("markdown").alias("text")), sections)
    fused = retrieval.scope(located, found, sections)
    top = {r.query_id: r for r in fused.filter("rank = 1").collect()}
    assert top[1].title == "Pumps" and top[1].retrieval_routes == ["coarse", "hierarchical"] and top[2].title == "Valves"


def test_rendering(spark):
    schema = "file string, ordinal int, type string, text string, text_level int, page_idx string, img_path string, image_caption array<string>, table_caption array<string>, table_body string, list_items array<string>, code_body string"
    rows = [("f", 0, "text", "Title", 1, "0", *[None] * 6), ("f", 1, "header", "skip", None, "0", *[None] * 6), ("f", 2, "table", None, None, "1", None, None, ["T1"], "<table><tr></tr></table>", None, None), ("f", 3, "table", None, None, "2", None, None, [], "<table></table>", None, None), ("f", 4, "list", None, None, "bad", None, None, None, None, ["a", "b"], None)]
    df = spark.createDataFrame(rows, schema)
    out = render.render(df).first()
    assert out.markdown.startswith("<!-- source-page: 1 -->\n\n# Title\n") and "- a\n- b" in out.markdown and "skip" not in out.markdown and out.max_page == 3
    assert {r.ordinal: r.table_no for r in render.continued_tables(df).collect() if r.type == "table"} == {2: 1, 3: 1}
    md = spark.createDataFrame([("f", out.markdown)], "document_path string, markdown string")
    secs = hierarchy.outline(render.headings(md))
    assert render.section_pages(md, secs).first().pages == [1, 2, 3]
    rows = spark.createDataFrame([("b", "s1", "A|B", 1, 1, [(1, 2)], [1, 2], "pass", "pending", ["x.md"])], "bundle_id string, id string, title string, level int, start_line int, content_ranges array<struct<start_line:int,end_line:int>>, pages array<int>, quality string, status string, outputs array<string>")
    assert "| s1 | A\\|B | 1-2 | 1, 2 | pass | pending | x.md |" in source_map.render(rows).first().markdown


def test_lint_rules(spark):
    schema = "path string, frontmatter map<string,array<string>>, body string"
    b = "bundle-v2-0123456789abcdef"
    cards = spark.createDataFrame([
        ("30_Cards/a.md", {"type": ["knowledge-card"], "source_bundle_id": [b], "source_section_id": ["s1"], "source_sha256": ["h"], "evidence_mode": ["direct"]}, "x"),
        ("30_Cards/b.md", {"type": ["knowledge-card"], "evidence_mode": ["index"]}, f"{b} bundle-v2-ffffffffffffffff"),
        ("30_Cards/c.md", {"type": ["knowledge-card"]}, "x"),
    ], schema)
    rows = spark.createDataFrame([], "path string, bundle string, section string")
    ledgers = spark.createDataFrame([(b, "other")], "bundle_id string, source_sha256 string")
    secs = spark.createDataFrame([(b, "s1", ["30_Cards/z.md"])], "bundle_id string, section_id string, outputs array<string>")
    found = lint.artifact_rules(cards, rows, ledgers, secs, "strict")
    codes = sorted({(r.code, r.path[-4]) for r in found.collect()})
    assert codes == [("evidence.index_contract", "b"), ("evidence.missing_field", "a"), ("evidence.mode_missing", "c"), ("evidence.not_recorded_in_ledger", "a"), ("evidence.unknown_bundle", "a"), ("evidence.unknown_bundle", "b"), ("synthesis.multi_source_unstructured", "b")]
    assert {r.severity for r in found.filter("code = 'evidence.index_contract'").collect()} == {"error"}
    led = spark.createDataFrame([("l", "1", "qa_required", ["gone.md"]), ("l", "2", "odd", []), ("l", "3", "stale", [])], "path string, id string, status string, outputs array<string>")
    files = spark.createDataFrame([("here.md",)], "path string")
    for profile, severity in (("strict", "error"), ("qa-review", "info"), ("post-ingest", "warning")):
        got = {r.code: r.severity for r in lint.ledger_rules(led, files, profile).collect()}
        assert got == {"ledger.qa_open": severity, "ledger.unknown_status": "error", "ledger.stale": "error", "ledger.output_missing": "error"}
    bundles = spark.createDataFrame([("p", True, True, False, "2.0", "warn"), ("q", True, True, True, "2.0", "pass")], "path string, manifest boolean, outline boolean, document boolean, schema_version string, status string")
    outlines = spark.createDataFrame([("p", "a", 0, 1, 4, 9), ("p", "a", 1, 5, 4, 9), ("p", "", 2, 2, 3, 9)], "path string, id string, ordinal int, start_line int, end_line int, total_lines int")
    assert sorted({r.code for r in lint.bundle_rules(bundles, outlines).collect()}) == ["bundle.missing_control_file", "bundle.validation_warning", "duplicate-section-id", "empty-outline", "invalid-section-range", "missing-section-id", "unordered-sections"]
    assert lint.report(found).count() == found.count() and sum(r.n for r in lint.severities(found).collect()) == found.count()


def test_dashboards(spark):
    notes = spark.createDataFrame([("30_Cards/a.md", 3, {"type": ["knowledge-card"], "domains": ["x", "y"]}, [], ["b"]), ("30_Cards/b.md", 5, {"type": ["concept"]}, ["a"], []), (".obsidian/c.md", 9, None, [], []), ("40_Concepts/d.md", 1, {"type": ["concept"]}, ["a", "b"], []), ("40_Concepts/e.md", 1, {"type": ["concept"]}, ["a"], [])], "path string, mtime int, frontmatter map<string,array<string>>, inlinks array<string>, outlinks array<string>")
    assert [(r.path, r.Domains) for r in catalog.run(catalog.SAVED["knowledge_cards"], notes).collect()] == [("30_Cards/a.md", "x, y")]
    assert [r.Modified for r in catalog.run(catalog.SAVED["recent_changes"], notes).collect()] == [5, 3, 1, 1]
    assert [r.path[-4:] for r in catalog.run(catalog.SAVED["concepts"], notes).collect()] == ["d.md", "e.md"]
    tasks = spark.createDataFrame([("a.md", 1, True, "x"), ("b.md", 2, False, "y")], "path string, line int, completed boolean, task string")
    assert [r.task for r in catalog.run(catalog.SAVED["open_tasks"], notes, tasks).collect()] == ["y"]
    for bad in ("group by x", "table f(x) as y"):
        with pytest.raises(ValueError, match="can't read"):
            catalog.run(bad, notes)


def test_settings():
    assert Settings().fingerprint() == Settings().fingerprint() != Settings(top_k=5).fingerprint()
    for bad in ({"chunk_overlap": 1}, {"device": "tpu"}, {"top_k": 0}, {"immutable_models": True}, {"embedding_dimension": 0}):
        with pytest.raises(ValueError):
            Settings(**bad)
    assert vault_id("/a/My Vault/").startswith("my-vault-") and collection_name("!") == "vault-default" and len(collection_name("x" * 99)) == 63


def test_heading_levels_and_ids(spark):
    texts = [("Title", 0), ("目 录", 1), ("1 Scope", 1), ("1.2.3 Deep", 1), ("1. item", 1), ("(2) item", 1), ("附录 二", 1), ("Plain", 1), ("no heading", 0), ("1.1.1.1.1.1.1.1", 0)]
    df = spark.createDataFrame([("f", i, t, r) for i, (t, r) in enumerate(texts)], "file string, ordinal int, text string, text_level int")
    assert [r.level for r in headings.structural_levels(df).orderBy("ordinal").collect()] == [1, 2, 2, 4, 0, 0, 2, 3, 0, 6]
    md = spark.createDataFrame([("d", "# Intro\n## 1 A\n## 1 B\n## 1-2\n## 目录\n## 附录 3\n# Intro")], "document_path string, markdown string")
    assert [r.section_id for r in render.headings(md).orderBy("start_line").collect()] == ["section-0001", "1", "1-2", "1-3", "toc", "appendix-3", "section-0007"]
    assets = spark.createDataFrame([("f", 0, "Figure 2.1 x", "fig", 1, 1), ("f", 1, "图2-1", "fig", 1, 2), ("f", 2, "Table 3", "table", 2, 1), ("f", 3, "Figure 9", "table", 2, 2), ("f", 4, None, "fig", 3, 1), ("f", 5, "Fig. 2.1", "fig", 3, 2)], "file string, ordinal int, caption string, kind string, page int, sequence int")
    assert [r.id for r in headings.asset_ids(assets).orderBy("ordinal").collect()] == ["fig_2_1", "fig_2_1_2", "table_3", "table_p2_n2", "fig_p3_n1", "fig_2_1_3"]
    names = spark.createDataFrame([("a b_document_bundle",), ("x_image_document_bundle",), ("!!",)], "d string")
    assert [r[0] for r in names.select(headings.projection_name(F.col("d"))).collect()] == ["a-b.section-query-index.json", "x.section-query-index.json", "document.section-query-index.json"]


def test_evidence_rows(spark):
    from lodestone.sources import markdown

    b = "bundle-v2-0123456789abcdef"
    body = f"| Source_Bundle-ID | `Section` | Pages | Owned lines |\n| --- | --- | --- | --- |\n| see {b} | `s1` | 1 | 2-3 |\n| none | s2 | 1 | 1 |\n\n| Bundle | Section |\n| --- | --- |\n| {b} | s |\n"
    rows = markdown.evidence_rows(markdown.tables(spark.createDataFrame([("a.md", body)], "source string, content string"))).collect()
    assert [(r.bundle, r.section, r.pages, r.lines) for r in rows] == [(b, "s1", "1", "2-3")]


def test_casefold_is_that_of_unicode(spark):
    from lodestone.functions.text import FOLDS, casefold

    texts = ["Straße", "ΣΑΣ ς", "ﬁn ﬀ ﬆ", "İI ı", "ſoß", "ᾀ ʼN ŉ", "Ꭰ ꭰ", "plain", "", None, *FOLDS]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(casefold("t", full=True)).collect()]
    assert got == [t if t is None else t.casefold() for t in texts]
    assert len(FOLDS) > 150
