"""Tables that change by revisions, the indexes and ledgers kept in them, and rendered blocks."""

import random
import re
import threading

import pytest
from pyspark.sql import functions as F

from lodestone.operators import commits, decisions, dense, lexical, lexical_store, observed, render, sync, vector_store
from lodestone.sources.revisions import Conflict, Store


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def put(store, name, values, base=None):
    change = store.change(base)
    change.put(name, store.spark.createDataFrame([(v,) for v in values], "x int"))
    return change.publish()


def test_a_revision_is_seen_whole_or_not_at_all(store):
    assert store.head() == 0 and store.manifest() == {}
    assert put(store, "a", [1, 2]) == 1
    change = store.change()
    change.put("a", store.spark.createDataFrame([(3,)], "x int"))
    change.put("b", store.spark.createDataFrame([(4,)], "x int"))
    assert rows_of(store.read("a")) == [(1,), (2,)] and "b" not in store.manifest() and rows_of(change.staged("b")) == [(4,)]
    assert change.publish() == 2
    assert rows_of(store.read("a")) == [(3,)] and rows_of(store.read("b")) == [(4,)] and rows_of(store.read("a", 1)) == [(1,), (2,)]
    with pytest.raises(Conflict):
        put(store, "a", [9], base=1)
    assert rows_of(store.read("a")) == [(3,)] and store.head() == 2


def test_of_writers_that_race_one_wins(store):
    put(store, "a", [0])
    ready, won, lost = threading.Barrier(4), [], []

    def write(v):
        change = store.change(1)
        change.put("a", store.spark.createDataFrame([(v,)], "x int"))
        change.put("b", store.spark.createDataFrame([(v,)], "x int"))
        ready.wait()
        try:
            won.append((change.publish(), v))
        except Conflict:
            lost.append(v)

    writers = [threading.Thread(target=write, args=(v,)) for v in range(1, 5)]
    [w.start() for w in writers]
    [w.join() for w in writers]
    assert len(won) == 1 and len(lost) == 3 and store.head() == 2
    assert rows_of(store.read("a")) == rows_of(store.read("b")) == [(won[0][1],)]


def test_parts_and_sweeping(store):
    df = lambda rows: store.spark.createDataFrame(rows, "k int, x int")
    change = store.change()
    change.put_parts("t", df([(1, 10), (2, 20), (3, 30)]), "k")
    change.publish()
    change = store.change()
    change.put_parts("t", df([(2, 21)]), "k", ["2", "3"])
    change.publish()
    assert rows_of(store.read("t")) == [(10,), (21,)] and rows_of(store.read("t", parts=["1", "7"])) == [(10,)] and rows_of(store.read("t", parts=[])) == []
    change = store.change()
    change.put("t", store.spark.createDataFrame([(5,)], "x int"), "d", keep=True)
    change.publish()
    assert rows_of(store.read("t")) == [(5,), (10,), (21,)]
    store.sweep(keep=1)
    assert rows_of(store.read("t")) == [(5,), (10,), (21,)] and store.head() == 3
    assert put(store, "u", [1]) == 4


TEXTS = "pump valve pump", "valve rest", "Straße rest pump 漢", "", None, "seal seal seal pump"


def test_a_maintained_index_is_a_rebuilt_one(spark, store, monkeypatch):
    monkeypatch.setattr(lexical_store, "MOST_DELTAS", 3)
    rng = random.Random(1)
    frame = lambda rows: spark.createDataFrame(sorted(rows.items()), "doc_id long, text string")
    held = {i: rng.choice(TEXTS) for i in range(40)}
    lexical_store.create(store, frame(held), buckets=4)
    for turn in range(6):
        gone = rng.sample(sorted(held), 5) + [999]
        fresh = {rng.randrange(60): " ".join(rng.choice(TEXTS) or "x" for _ in range(3)) for _ in range(8)} | {gone[0]: "back again"}
        lexical_store.update(store, frame(fresh), spark.createDataFrame([(g,) for g in gone], "doc_id long"))
        held = {k: v for k, v in held.items() if k not in gone} | fresh
        index, anew = lexical_store.load(store), lexical.build(frame(held))
        assert rows_of(index.stats.fillna("\0", "term")) == rows_of(anew.stats.select("term", "df", "n_tokens").fillna("\0", "term"))
        asked = spark.createDataFrame([(1, "pump rest"), (2, "seal back 漢"), (3, "")], "query_id long, text string")
        assert rows_of(lexical.search(index, asked)) == rows_of(lexical.search(anew, asked))
    assert len(store.manifest()["lexical_stats"]["parts"]) <= 3
    with pytest.raises(Conflict):
        lexical_store.update(store, frame({1: "late"}), base=1)
    lexical_store.update(store, frame({}), spark.createDataFrame([(k,) for k in held], "doc_id long"))
    assert lexical_store.load(store).stats.count() == 0 and lexical.search(lexical_store.load(store), asked).count() == 0


def test_a_vector_index_has_the_neighbours_of_all_vectors(spark, store):
    rng = random.Random(2)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    near = lambda c: [x + rng.gauss(0, 0.05) for x in c]
    rows = [(i, near(centres[i % 12])) for i in range(600)] + [(700, [0.0] * 8), (701, centres[0]), (702, centres[0]), (703, centres[0])]
    schema = "vec_id long, embedding array<float>"
    vectors = spark.createDataFrame(rows, schema)
    queries = spark.createDataFrame([(i, v) for i, v in rows if i % 50 == 0], schema).withColumnRenamed("vec_id", "query_id")
    vector_store.create(store, spark.createDataFrame(rows[:400] + [(9000, centres[1])], schema), 8, cells=12)
    assert vector_store.count(store) == 401
    vector_store.delete(store, spark.createDataFrame([(9000,), (12345,)], "vec_id long"))
    vector_store.upsert(store, spark.createDataFrame(rows[300:], schema))
    assert vector_store.count(store) == len(rows)
    got, read = vector_store.search(store, queries, 7)
    assert rows_of(got) == rows_of(dense.knn(vectors, queries, 7))
    share = {r.query_id: r.n_read / r.n_held for r in read.collect()}
    assert max(v for k, v in share.items() if k != 700) < 0.5 and share[700] == 1.0
    assert rows_of(vector_store.search(store, queries, 7, block_bytes=300)[0]) == rows_of(got)
    assert rows_of(vector_store.search(store, queries, 1000)[0]) == rows_of(dense.knn(vectors, queries, 1000))
    with pytest.raises(Exception, match="8 elements"):
        vector_store.upsert(store, spark.createDataFrame([(1, [1.0])], schema))
    vector_store.create(store, spark.createDataFrame([], schema), 8)
    assert vector_store.count(store) == 0 and vector_store.search(store, queries)[0].count() == 0


def test_ledgers_are_written_together_and_only_by_one(spark, store):
    manifests = spark.createDataFrame([("a", "2.0", "sha-a"), ("b", "1.0", "sha-b"), ("c", "2", "")], "directory string, schema_version string, source_sha256 string")
    sections = lambda text: spark.createDataFrame([("a", "1", text, "pass", "pass"), ("a", "2", "y", "warn", "pass"), ("b", "1", "z", "pass", "pass")], "directory string, id string, content string, quality string, validation_status string")
    revision, refused = commits.init_ledgers(store, manifests, sections("x"))
    assert revision == 1 and rows_of(refused) == [("b", "bundle-v2-required"), ("c", "source-sha-required")]
    assert rows_of(store.read("ledger_heads").select("directory", "revision")) == [("a", 1)]
    asked = spark.createDataFrame([("a", "1", "in_progress", 1, None), ("a", "2", "ingested", 1, None), ("q", "1", "skipped", 1, ["n"])], "directory string, id string, to_status string, expected_revision int, notes array<string>")
    revision, refused = commits.change_sections(store, asked)
    assert {(r.directory, r.id): r.violation for r in refused.collect()} == {("a", "2"): "invalid-transition", ("q", "1"): "unknown-ledger"}
    assert rows_of(store.read("ledger_sections").select("id", "status")) == [("1", "in_progress"), ("2", "qa_required")] and store.read("ledger_heads").first().revision == 2
    with pytest.raises(Conflict):
        commits.init_ledgers(store, manifests, sections("late"), base=1)
    commits.init_ledgers(store, manifests, sections("changed"))
    state = {r.id: (r.status, r.previous_status) for r in store.read("ledger_sections").collect()}
    assert state["1"] == ("stale", "in_progress") and store.read("ledger_heads").first().revision == 3
    other = manifests.withColumn("source_sha256", F.lit("other"))
    assert ("a", "bundle-id-conflict") in rows_of(commits.init_ledgers(store, other, sections("x"))[1])
    assert {r.id: (r.status, r.previous_status) for r in store.read("ledger_sections").collect()} == state
    commits.init_ledgers(store, other, sections("x"), replace=True)
    assert store.read("ledger_heads").filter("directory = 'a'").first().revision == 1


def test_traces_finish_when_nothing_stands_against_them(spark, store):
    traces = spark.createDataFrame([("t1", "completed", "clear", 0), ("t2", "completed", "clear", 1), ("t3", "completed", "clear", 0)], "trace_id string, status string, evidence_level string, n_open_stages int")
    evidence = spark.createDataFrame([(t, "E1", "v", "not-checked", None) for t in ("t1", "t2")], "trace_id string, evidence_id string, document_version string, original_asset_status string, original_asset_path string")
    claims = spark.createDataFrame([("t1", "C1", "supported", ["E1"], 1, "It holds."), ("t2", "C1", "supported", ["E1"], 1, "x"), ("t3", "C1", "supported", ["E9"], 1, "y")], "trace_id string, claim_id string, status string, evidence_ids array<string>, ordinal int, text string")
    revision, refused = commits.finish_traces(store, traces, evidence, claims)
    assert rows_of(refused) == [("t2", "open-stages"), ("t3", "evidence-required"), ("t3", "unknown-evidence")]
    assert rows_of(store.read("traces").select("trace_id", "n_claims")) == [("t1", 1)] and rows_of(store.read("trace_claims").select("trace_id")) == [("t1",)]
    asked = spark.createDataFrame([("r1", 1, "t1"), ("r2", 1, "t1"), ("r2", 2, "t2"), ("r3", 2, "t1")], "request_id string, question_index int, trace_id string")
    answers, against = commits.close_request(store, asked)
    assert rows_of(answers) == [("r1", 1, "## Question 1\n\n- It holds. [S1]")] and rows_of(against) == [("r2", "unfinished-questions"), ("r3", "questions-not-contiguous")]
    assert rows_of(commits.finish_traces(store, traces.filter("trace_id = 't1'"), evidence, claims)[1]) == [("t1", "already-finished")]
    assert store.read("traces").count() == 1


BLOCK = "file string, ordinal int, type string, text string, text_level int, page_idx string, img_path string, image_caption array<string>, table_caption array<string>, table_body string, list_items array<string>, code_body string, latex string"


def block(ordinal, kind, page, **more):
    return {"file": "f", "ordinal": ordinal, "type": kind, "page_idx": str(page), **more}


def frame(spark, blocks):
    names = re.findall(r"(\w+) (?:string|int|array<string>)", BLOCK)
    return spark.createDataFrame([tuple(b.get(n) for n in names) for b in blocks], BLOCK)


def test_the_whole_renderer(spark):
    blocks = frame(spark, [
        block(0, "text", 0, text=" Manual ", text_level=1), block(1, "header", 0, text="skip"), block(2, "text", 0, text="2 Scope", text_level=1), block(3, "text", 0, text="(1) item", text_level=1),
        block(4, "image", 1, img_path="x/a.PNG", image_caption=[" Figure 3 ", ""]), block(5, "chart", 1, img_path="b.svg"), block(6, "image", 1, image_caption=["图 3"]),
        block(7, "table", 1, table_caption=["Table 2"], table_body="<TABLE><tr> <td>1</td></tr></TABLE>", img_path="x/a.PNG"), block(8, "table", 2), block(9, "table", 3), block(10, "table", 6),
        block(11, "equation", 6, latex="a=b"), block(12, "equation", 6, text=" "), block(13, "list", 6, list_items=["x ", " ", "y"]), block(14, "list", 6, text="flat"), block(15, "code", 6, code_body="run\n"),
        block(16, "odd", 7, text="kept"), block(17, "text", 8, text="  "), block(18, "text", 8, text="Sub", text_level=1),
    ])
    assets = spark.createDataFrame([("f", "x/a.PNG")], "file string, img_path string")
    laid = render.laid_out(blocks, assets).cache()
    text = render.documents(laid).first()
    assert text.markdown == "\n".join([
        "<!-- source-page: 1 -->", "", "# Manual", "", "## 2 Scope", "", "**(1) item**", "", "<!-- source-page: 2 -->", "", "![Figure 3](images/fig_3.png)", "", "![Chart p2-2](images/fig_p2_n2.png)", "", "![图 3](images/fig_3_2.png)", "",
        "**Table 2**", "", "[查看表格](tables/table_2.md)", "", "<!-- table-id: table_2; source-page: 2; qa: pass -->", "", "<!-- source-page: 3 -->", "", "<!-- table-continuation: table_2; source-page: 3; qa: warn -->", "",
        "<!-- source-page: 4 -->", "", "<!-- table-continuation: table_2; source-page: 4; qa: warn -->", "", "<!-- source-page: 7 -->", "", "**Table p7-4**", "", "[查看表格](tables/table_p7_4.md)", "", "<!-- table-id: table_p7_4; source-page: 7; qa: warn -->", "",
        "<!-- block-id: eq_p7_n1; source-page: 7; qa: review -->", "", "a=b", "", "- x", "- y", "", "flat", "", "```", "run", "```", "", "<!-- source-page: 8 -->", "", "kept", "", "<!-- source-page: 9 -->", "", "### Sub"]) + "\n"
    assert text.max_page == 9 and text.n_blocks == 18
    lines = text.markdown.split("\n")
    shown = {r.id: r for r in render.images(laid).collect()}
    assert {k: (r.quality, r.section_path) for k, r in shown.items()} == {"fig_3": ("pass", ["Manual", "2 Scope"]), "fig_p2_n2": ("fail", ["Manual", "2 Scope"]), "fig_3_2": ("fail", ["Manual", "2 Scope"])}
    assert all(lines[r.line - 1].startswith("![") for r in shown.values())
    held = {r.id: r for r in render.tables(laid).collect()}
    assert (held["table_2"].page_start, held["table_2"].page_end, held["table_2"].quality, held["table_2"].evidence_path) == (2, 4, "warn", "tables/table_2_source.png")
    assert held["table_2"].markdown == "# Table 2\n\n<!-- table-id: table_2; source-page: 2 -->\n\n<TABLE>\n<tr>\n<td>1</td>\n</tr>\n</TABLE>\n\n## 页面证据\n\n![Table 2](table_2_source.png)\n"
    assert held["table_p7_4"].quality == "warn" and "<!-- table-body-unavailable -->" in held["table_p7_4"].markdown
    assert sorted((r.code, r.page, r.id) for r in render.issues(laid).collect()) == [("cross-page-table-continuation-unresolved", 3, "table_2"), ("cross-page-table-continuation-unresolved", 4, "table_2"), ("missing-image-asset", 2, "fig_3_2"), ("missing-image-asset", 2, "fig_p2_n2"), ("table-body-unavailable", 7, "table_p7_4")]


def test_repeated_heading_levels_are_told(spark):
    blocks = frame(spark, [block(i, "text", 0, text=f"{i + 1} Part", text_level=2) for i in range(11)])
    assert [r.code for r in render.issues(render.laid_out(blocks)).collect()] == ["heading-levels-reconstructed"]
    assert render.issues(render.laid_out(blocks.filter("ordinal < 10"))).count() == 0
    assert [r.level for r in render.laid_out(blocks).orderBy("ordinal").collect()] == [1] + [2] * 10


def test_decisions_fold_or_are_recorded(spark, store):
    rows = {
        "ok": '{"claims":[{"claim":" x ","text":"","evidence_refs":["P1",2],"status":"gap"}],"unresolved":["a"],"unresolved_items":["a"],"events":[{"stage":"s","more":1,"extensions":{"more":1}}],"conclusion":"c"}',
        "empty": "{}", "null": None, "cut": "{", "list": "[]", "two": '{"b":1,"a":2}', "claims": '{"claims":null}', "claim": '{"claims":[{"text":"t","x":1}]}', "open": '{"unresolved_items":[" "]}', "events": '{"events":{}}', "event": '{"events":[1]}',
        "extra": '{"events":[{"extensions":[]}]}', "clash": '{"events":[{"more":1,"extensions":{"more":2}}]}', "paths": '{"events":[{"inspected_paths":"p"}]}', "verified": '{"verified_evidence_refs":"P1"}',
    }
    decisions.record_decisions(store, spark.createDataFrame(list(rows.items()), "trace_id string, decision string"))
    good = {r.trace_id: r for r in store.read("decisions", parts=["folded"]).collect()}
    bad = {r.trace_id: (r.reason, r.recommendation) for r in store.read("decisions", parts=["failed"]).collect()}
    assert len(good) + len(bad) == len(rows) and set(good) == {"ok", "empty"}
    ok = good["ok"]
    assert [tuple(c) for c in ok.claims] == [(1, "x", "gap", ["P1", "2"], None)] and ok.unresolved == ["a"] and ok.n_events == 1 and ok.conclusion == "c" and good["empty"].claims == []
    again, change, correct = "send-the-decision-again", "drop-or-rename-fields", "correct-and-finalize-again"
    assert bad == {
        "null": ("broken-json", again), "cut": ("broken-json", again), "list": ("not-an-object", again), "two": ("unsupported-fields:a,b", change), "claims": ("claims-not-a-list", correct), "claim": ("claim-1-unsupported-fields:x", correct),
        "open": ("unresolved-not-texts", correct), "events": ("events-not-a-list", correct), "event": ("event-1-not-an-object", correct), "extra": ("event-1-extensions-not-an-object", correct), "clash": ("event-1-extension-conflicts:more", correct),
        "paths": ("event-1-inspected_paths-not-a-list", correct), "verified": ("verified-not-a-list", correct),
    }


def test_a_run_tells_its_counts_and_outlives_its_trace(spark):
    events = []
    rows = spark.range(10)
    with observed.Run("recall", "bm25", events.append, {"odd": F.count_if(F.expr("id % 2 = 1"))}) as run:
        assert run.rows(rows).filter("id > 3").count() == 6
    assert (events[0]["status"], events[0]["hit_count"], events[0]["odd"]) == ("ok", 10, 5) and events[0]["duration_ms"] > 0

    def broken(_):
        raise OSError("disk full")

    with pytest.warns(UserWarning, match="disk full"), observed.Run("recall", "bm25", broken) as run:
        assert run.rows(rows).count() == 10
    with observed.Run("recall", "bm25", events.append, keep_going=True) as run:
        run.rows(rows.select(F.raise_error(F.lit("no provider")))).collect()
    assert events[1]["status"] == "unavailable" and "no provider" in events[1]["warnings"][0] and events[1]["hit_count"] == 0
    with pytest.raises(ValueError), observed.Run("recall", "bm25", events.append):
        raise ValueError("mine")
    assert events[2]["status"] == "unavailable"


def odd_vectors():
    """Vectors and copies of them, zeros, nulls, numbers that aren't finite, other lengths, norms at both ends of the range."""
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 340)] + [(i, [0.0] * 4) for i in range(340, 350)]
    rows += [(350, None), (351, [1.0, None, 0.0, 2.0]), (352, [float("nan"), 1.0, 1.0, 1.0]), (353, [float("inf"), 1.0, 0.0, 0.0]), (354, [1.0, 2.0]), (355, [])]
    return rows + [(356, [1e-200, 0.0, 0.0, 0.0]), (357, [1e200, 1e200, 0.0, 0.0]), (358, [1e-160, 1e-160, 0.0, 0.0])]


def test_neighbours_are_those_of_the_plain_formula(spark):
    """Odd values too; the pairs of vectors and queries are no rows of the plan."""
    schema = "vec_id long, embedding array<double>"
    vectors = spark.createDataFrame(odd_vectors(), schema)
    queries = vectors.filter("vec_id % 20 = 7 OR vec_id >= 339").withColumnRenamed("vec_id", "query_id")
    pairs = vectors.crossJoin(queries.withColumnRenamed("embedding", "q")).filter("vec_id <> query_id")
    plain = pairs.withColumn("similarity", F.round(dense.cosine(F.col("embedding"), F.col("q")), 6))
    want = sorted(map(str, dense.ranked(plain, 12).collect()))
    got = dense.knn(vectors, queries, 12)
    assert sorted(map(str, got.collect())) == want and sorted(map(str, dense.knn(vectors, queries, 12, block_bytes=500).collect())) == want
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    with_self = dense.knn(vectors.filter("vec_id < 340").repartition(3), queries, 1, include_self=True).filter("query_id < 300").collect()
    assert {(r.query_id, r.vec_id, r.similarity) for r in with_self} == {(i, i, 1.0) for i in range(7, 300, 20)}


def test_an_index_sends_each_query_once(spark, store):
    """However many cells a query needs: no join of queries with cells or vectors, and cells of few files."""
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(900)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(8)
    queries = vectors.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    vector_store.create(store, vectors, 16)
    assert len(store.read("vectors").inputFiles()) <= 2 * store.read("vector_cells").count()
    got, read = vector_store.search(store, queries, 5)
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows_of(got) == rows_of(dense.knn(vectors, queries, 5)) and read.filter("n_read > n_held").count() == 0


def test_a_sync_takes_touched_buckets_in_groups(spark, store, monkeypatch):
    """Few touched ids at once, and one bucket of more than that, by key: the index is the rebuilt one."""
    monkeypatch.setattr(lexical_store, "MOST_SENT", 5)
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    before, after = frame([(i, f"old w{i % 7}") for i in range(40)]), frame([(i, f"{'new' if i % 3 else 'old'} w{i % 7}") for i in range(5, 60)])
    lexical_store.create(store, before, buckets=8)
    prints = lambda rows: sync.fingerprints(rows, "doc_id", "text")
    lexical_store.sync(store, after, sync.difference(prints(after), prints(before)))
    stats = lambda index: rows_of(index.stats.select("term", "df", "n_tokens").fillna("\0", "term"))
    assert stats(lexical_store.load(store)) == stats(lexical.build(after)) and lexical_store.load(store).documents.count() == 55
