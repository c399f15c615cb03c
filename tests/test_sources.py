"""Readers, connectors and streams over files that the tests write."""

import json
import sys

import pytest
from pyspark.sql import functions as F

from lodestone.operators import hierarchy
from lodestone.sources import bundles, connectors, markdown
from lodestone.streaming import arrivals

NOTE = '---\ntype: "knowledge-card"\nstatus: active\n# note\ndomains:\n  - x\n  - \'y z\'\ntags: [a, b]\nempty:\n---\nBody [[Other|label]] and [[sub/Third#h]].\n\n| A | B |\n| --- | :---: |\n| 1 | 2 |\n| odd |\n| 3 | 4 |\n\n- [ ] open\n- [x] done\n'


@pytest.fixture
def vault(tmp_path):
    for path, body in {"30_Cards/a.md": NOTE, "30_Cards/Other.MD": "no matter", "30_Cards/other.md": "plain", ".hidden/b.md": "x", "30_Cards/~tmp/c.md": "x", "30_Cards/d.txt": "x", "_system/reports/r.md": "plain", "40/open.md": "---\ntype: a\nnever closed"}.items():
        file = tmp_path / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(body)
    return tmp_path


def test_scan_and_parse(spark, vault):
    docs = markdown.scan(spark, str(vault))
    assert sorted(r.source for r in docs.collect()) == ["30_Cards/a.md", "30_Cards/other.md", "40/open.md", "_system/reports/r.md"]
    notes = {r.path: r for r in markdown.governed(docs).collect()}
    assert notes["30_Cards/a.md"].frontmatter == {"type": ["knowledge-card"], "status": ["active"], "domains": ["x", "y z"], "tags": ["a", "b"], "empty": []}
    assert notes["30_Cards/a.md"].body.startswith("Body [[Other") and notes["30_Cards/a.md"].links == ["Other", "sub/Third"]
    assert notes["30_Cards/other.md"].frontmatter is None and notes["30_Cards/other.md"].body == "plain"
    assert notes["40/open.md"].frontmatter is None and notes["40/open.md"].body == ""
    table = markdown.tables(docs).first()
    assert table.headers == ["A", "B"] and table.rows == [["1", "2"], ["3", "4"]]
    assert [(r.completed, r.task) for r in markdown.tasks(docs).orderBy("line").collect()] == [(False, "open"), (True, "done")]
    governed = markdown.governed(docs)
    assert [r.target for r in markdown.unresolved_links(governed).collect()] == ["sub/Third"]
    assert {r.path: r.inlinks for r in markdown.stem_links(governed).collect()}["30_Cards/other.md"] == 1


@pytest.fixture
def bundle(tmp_path):
    folder = tmp_path / "10_Raw" / "converted" / "x_document_bundle"
    folder.mkdir(parents=True)
    (folder / "manifest.json").write_text(json.dumps({"schema_version": "2.1", "source": {"filename": "x.pdf", "sha256": "s" * 64}, "validation": {"status": "pass"}}))
    sections = [{"id": "root", "title": "Root", "level": 1, "parent": None, "path": ["root"], "start_line": 1, "end_line": 4, "pages": [1], "assets": [], "quality": "pass"}, {"id": "spray", "title": "Spray", "level": 2, "parent": "root", "path": ["root", "spray", "unknown"], "start_line": 3, "end_line": 4, "pages": [1, 2], "assets": ["t1"], "quality": "warn"}]
    (folder / "outline.json").write_text(json.dumps({"sections": sections}))
    (folder / "document.md").write_text("# Root\n\n## Spray\nK=60\n")
    (tmp_path / "half_document_bundle").mkdir()
    (tmp_path / "half_document_bundle" / "manifest.json").write_text("{broken")
    ledgers = tmp_path / "_system" / "x_document_bundle"
    ledgers.mkdir(parents=True)
    (ledgers / "x.section-ledger.json").write_text(json.dumps({"bundle_id": "bundle-v2-1", "revision": 2, "sections": [{"id": "root", "status": "ingested", "content_ranges": [{"start_line": 1, "end_line": 2}], "content_sha256": "h"}]}))
    (ledgers / "bad.section-ledger.json").write_text("{oops")
    return tmp_path


def test_bundles(spark, bundle):
    assert [r.directory for r in bundles.discover_bundles(spark, str(bundle)).collect()] == ["x_document_bundle"]
    flat = {r.directory: (r.manifest, r.document) for r in bundles.discover_bundles(spark, str(bundle), flat=True).collect()}
    assert flat == {"half_document_bundle": (True, False)}
    manifests, outlines, ledgers = bundles.read_manifests(spark, str(bundle)), bundles.read_outlines(spark, str(bundle)), bundles.read_ledgers(spark, str(bundle))
    assert manifests.count() == 1 and ledgers.count() == 1 and bundles.read_ledgers(spark, str(bundle), keep_broken=True).filter("_corrupt_record IS NOT NULL").count() == 1
    got = {r.section_id: r for r in bundles.build_projection(manifests, outlines, ledgers).collect()}
    assert got["root"].ingest_status == "ingested" and [tuple(x) for x in got["root"].content_ranges] == [(1, 2)]
    assert got["spray"].ingest_status == "untracked" and [tuple(x) for x in got["spray"].content_ranges] == [(3, 4)] and got["spray"].path_titles == ["Root", "Spray"]
    owned = hierarchy.owned_ranges(outlines.withColumnRenamed("id", "section_id").withColumnRenamed("directory", "document_path"))
    assert {r.section_id: len(r.content_ranges) for r in owned.collect()} == {"root": 1, "spray": 1}


def test_projections_and_blocks(spark, tmp_path):
    for name, title in (("a", "old"), ("b", "new")):
        (tmp_path / f"{name}.section-query-index.json").write_text(json.dumps({"document": {"document_path": "/d.md"}, "sections": [{"section_id": "s", "title": title}]}))
    assert [(r.document_path, r.title) for r in bundles.read_projections(spark, str(tmp_path)).collect()] == [("d.md", "new")]
    blocks = [{"type": "text", "text": "a", "page_idx": 0}, {"type": "list", "list_items": ["x"]}]
    for name, value in (("list", blocks), ("held", {"items": blocks})):
        (tmp_path / f"{name}.json").write_text(json.dumps(value))
        assert [(r.ordinal, r.type) for r in bundles.read_blocks(spark, str(tmp_path / f"{name}.json")).collect()] == [(0, "text"), (1, "list")]
    terms = spark.createDataFrame([("d", 1, "Pump"), ("d", 2, "pump"), ("d", 3, "Valve")], "k string, ordinal int, term string")
    assert bundles.routing_terms(terms, "k").first().routing_terms == ["Pump", "Valve"]


def test_connectors(spark, tmp_path):
    code = "import json,sys; q=json.load(sys.stdin); print(json.dumps({'candidates':[{'source':q['p'],'start_line':2,'end_line':3,'rrf_score':0.5}]}))"
    answer = connectors.call_command([sys.executable, "-c", code], {"p": "a.md"})
    row = connectors.candidates(spark, [(7, answer)]).first()
    assert (row.query_id, row["rank"], row.source, row.rrf_score) == (7, 1, "a.md", 0.5)
    for bad in ("raise SystemExit(1)", "print([])"):
        with pytest.raises((RuntimeError, ValueError)):
            connectors.call_command([sys.executable, "-c", bad], {})
    (tmp_path / "x.bin").write_bytes(b"abc")
    (tmp_path / "y.bin").write_bytes(b"a")
    got = {r.path[-5:]: (r.markdown, r.error) for r in connectors.convert_files(spark, str(tmp_path), "*.bin", lambda path, raw: f"# {len(raw)} {1 // (len(raw) - 1)}").collect()}
    assert got["x.bin"] == ("# 3 0", None) and got["y.bin"][1].startswith("ZeroDivisionError")
    kept = connectors.portable_manifest({"status": "failed", "secret": 1, "last_success": None}, {"last_success": "then"})
    assert kept == {"status": "failed", "last_success": "then"}


def test_sync_stream(spark, tmp_path):
    root, table = tmp_path / "in", str(tmp_path / "table")
    root.mkdir()
    version = [0]

    def read():
        return spark.read.parquet(f"{table}/{version[0]}")

    def write(df):
        df.write.parquet(f"{table}/{version[0] + 1}")
        version[0] += 1

    spark.createDataFrame([], "source string, content string, sha256 string").write.parquet(f"{table}/0")
    seen = []
    for name, body in (("a.md", "one"), ("b.md", "two")):
        (root / name).write_text(body)
        q = arrivals.sync_stream(arrivals.markdown_stream(spark, str(root)), read, write, str(tmp_path / "check"), lambda fresh, _: seen.append(fresh.count())).trigger(availableNow=True).start()
        q.awaitTermination()
    assert sorted(r.content for r in read().collect()) == ["one", "two"] and seen == [1, 1]


def test_event_streams(spark, tmp_path):
    rows = [("t", 1, "begin", "2024-01-01 00:00:00"), ("t", 1, "begin", "2024-01-01 00:00:00"), ("t", 2, "end", "2024-01-01 00:30:00"), ("t", 3, "end", "2024-01-01 09:00:00")]
    df = spark.createDataFrame(rows, "trace_id string, ordinal int, stage string, at string").withColumn("at", F.to_timestamp("at")).withColumn("duration_ms", F.lit(1.5))
    df.write.parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "events"))
    for name, out in (("unique_events_out", arrivals.unique_events(stream)), ("activity_out", arrivals.stage_activity(stream))):
        q = out.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
    assert spark.table("unique_events_out").count() == 3
    assert [(r.stage, r.n) for r in spark.table("activity_out").orderBy("since").collect()] == [("begin", 2), ("end", 1)]
    late = arrivals.newer_revisions(spark.createDataFrame([("b", 1), ("c", 5)], "bundle_id string, expected_revision int"), spark.createDataFrame([("b", 1), ("c", 6)], "bundle_id string, revision int"))
    assert [r.bundle_id for r in late.collect()] == ["b"]


@pytest.mark.parametrize("text", ['[[{"type": "text"}], []]', "[[]]", '{"other": []}', "3"])
def test_block_lists_of_other_shapes_raise(spark, tmp_path, text):
    (tmp_path / "content_list.json").write_text(text)
    with pytest.raises(Exception, match="content list"):
        bundles.read_blocks(spark, str(tmp_path)).collect()
