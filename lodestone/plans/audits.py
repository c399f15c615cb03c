"""Driver queries over rules, ledgers, traces, sessions and functions: each operator on rows made of the test tables.
``audit_sql.py`` has SQL for the same rows. Nested results are flattened to columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import paths
from ..functions.text import casefold, clean_pages, empty, page_number, prettify_tables, questions, ranges_id, reason_split, safe_id, sha256, span, terms, truthy, valid_ranges
from ..operators import catalog, chunking, evidence, fusion, hierarchy, ledger, lint, render, resolve, retrieval, session, trace, validate
from ..sources import bundles, markdown
from .queries import asked, bm25_topk, line_chunks, order_status, query, t, turns


def mod(column: str, n: int) -> Column:
    return F.col(column) % n == 0


def told(issues: DataFrame) -> DataFrame:
    """Issues with their details as text."""
    pairs = F.transform(F.map_entries("details"), lambda e: F.concat_ws("=", e.key, e.value))
    return issues.select("code", "severity", "path", F.array_join(pairs, ";").alias("details"))


def words(*pairs: tuple[str, Column]) -> Column:
    """A map of lists that has only the keys whose test holds."""
    full = F.create_map(*[x for k, test in pairs for x in (F.lit(k), F.when(test, F.array(F.lit("x"))))])
    return F.map_filter(full, lambda k, v: v.isNotNull())


# ---- rules


@query
def lint_ledgers(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(mod("o_orderkey", 50), "lost").when(mod("o_orderkey", 7), "stale").otherwise(order_status("o_orderstatus"))
    outputs = F.when(mod("o_orderkey", 4), F.array(F.concat(F.lit("out-"), (F.col("o_orderkey") % 9).cast("string")), F.lit("out-x"))).otherwise(empty())
    sections = t(spark, sf_dir, "orders").select(F.concat(F.lit("ledger-"), F.col("o_custkey").cast("string")).alias("path"), status.alias("status"), outputs.alias("outputs"))
    files = spark.range(6).select(F.concat(F.lit("out-"), F.col("id").cast("string")).alias("path"))
    return told(lint.ledger_rules(sections, files, "strict"))


@query
def lint_source_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "customer")
    name = lambda kind: F.concat(F.lit(kind), F.col("c_custkey").cast("string")).alias("path")
    maps = c.filter("c_custkey % 11 <> 0").select(name("map-"), F.col("c_custkey").alias("bundle_id"), (F.col("c_custkey") % 5).alias("revision"), F.col("c_mktsegment").alias("state"), F.col("c_name").alias("source_sha256"))
    held = c.select(name("ledger-"), F.col("c_custkey").alias("bundle_id"), (F.col("c_custkey") % 4).alias("revision"), F.col("c_mktsegment").alias("state"), F.when(mod("c_custkey", 6), "x").otherwise(F.col("c_name")).alias("source_sha256"))
    return told(lint.source_map_rules(maps, held))


@query
def lint_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "pages")
    path = F.concat(F.lit("n/"), F.col("page_id").cast("string"), F.when(mod("page_id", 4), ".source-map.md").otherwise(".md"))
    matter = F.when(~mod("page_id", 9), words(("type", mod("page_id", 2)), ("status", mod("page_id", 3))))
    links = F.when(mod("page_id", 5), empty()).otherwise(F.transform(F.array(F.col("page_id") + 1, F.col("page_id") + 2), lambda x: F.concat(F.lit("N/"), x.cast("string"), F.when(x % 4 == 0, ".source-map").otherwise(""))))
    notes = p.select(path.alias("path"), matter.alias("frontmatter"), links.alias("links"))
    present = spark.createDataFrame([("10_Raw",), ("30_Cards",), ("_system",)], "path string")
    parts = [lint.front_matter_rules(notes), lint.relationship_rules(notes, markdown.unresolved_links(notes), 2, "strict"), lint.layout_rules(present)]
    return told(lint.union(parts))


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = t(spark, sf_dir, "documents")
    one = lambda key, test, value: (key, test, value)
    bundle = F.concat(F.lit("bundle-v2-"), F.lpad((F.col("doc_id") % 40).cast("string"), 16, "0"))
    fields = [
        one("type", F.lit(True), F.when(mod("doc_id", 3), "knowledge-card").otherwise("report")), one("evidence_mode", mod("doc_id", 2), F.when(mod("doc_id", 4), "index").otherwise("direct")),
        one("source_bundle_id", ~mod("doc_id", 5), bundle), one("source_section_id", ~mod("doc_id", 7), F.when(mod("doc_id", 8), "multiple-sections").otherwise(F.concat(F.lit("s"), (F.col("doc_id") % 6).cast("string")))),
        one("source_sha256", ~mod("doc_id", 11), F.when(mod("doc_id", 13), "other").otherwise("sha")), one("source_lines", mod("doc_id", 2), F.lit("1-2")),
        one("evidence_scope", mod("doc_id", 12), F.lit("multi-source")),
    ]
    full = F.create_map(*[x for k, test, value in fields for x in (F.lit(k), F.when(test, F.array(value)))])
    return d.select("doc_id", F.concat(F.lit("c/"), F.col("doc_id").cast("string")).alias("path"), F.map_filter(full, lambda k, v: v.isNotNull()).alias("frontmatter"), F.lit("").alias("body"))


@query
def lint_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = artifacts(spark, sf_dir)
    bundle = lambda c: F.concat(F.lit("bundle-v2-"), F.lpad(c.cast("string"), 16, "0"))
    rows = found.filter("doc_id % 24 = 0").select("path", bundle(F.col("doc_id") % 40).alias("bundle"), F.concat(F.lit("s"), (F.col("doc_id") % 10).cast("string")).alias("section"))
    held = spark.range(0, 40, 1).filter("id % 10 <> 3").select(bundle(F.col("id")).alias("bundle_id"), F.lit("sha").alias("source_sha256"))
    sections = held.join(spark.range(5).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("section_id"))).select("bundle_id", "section_id", F.array(F.lit("c/17"), F.lit("c/22")).alias("outputs"))
    return told(lint.artifact_rules(found.drop("doc_id"), rows, held, sections, "query-ready"))


def graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lint.union([lint_ledgers(spark, sf_dir), lint_source_maps(spark, sf_dir), lint_notes(spark, sf_dir)])


@query
def lint_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = graded(spark, sf_dir)
    return lint.severities(found).join(found.groupBy("severity").agg(F.count_distinct("code").alias("n_codes")), "severity")


def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "pages").withColumn("directory", F.concat(F.lit("b"), F.col("page_id").cast("string")))
    manifest = F.when(mod("page_id", 13), None).when(mod("page_id", 17), "{broken").when(mod("page_id", 19), "[1]").otherwise('{"a":1}')
    controls = validate.control_issues(p.select("directory", (~mod("page_id", 29)).alias("there"), manifest.alias("manifest"), F.when(mod("page_id", 11), "").otherwise("text").alias("document")))
    manifests = p.select("directory", F.when(mod("page_id", 7), "1.0").otherwise("2.1").alias("schema_version"), F.when(mod("page_id", 5), "other").when(mod("page_id", 3), "engineering").otherwise("basic").alias("profile"), (~mod("page_id", 8)).alias("has_outline"), F.when(mod("page_id", 9), "").otherwise("outline.json").alias("outline_path"), mod("page_id", 4).alias("has_evidence"), mod("page_id", 12).alias("default_ingest"), F.when(mod("page_id", 2), "<!-- source-page: 1 -->").otherwise("x").alias("document"))
    c = t(spark, sf_dir, "conversations").withColumn("directory", F.concat(F.lit("c"), F.col("conv_id").cast("string")))
    lists = c.select("directory", F.when(F.col("role") == "user", "images").otherwise("tables").alias("label"), F.when(~(mod("conv_id", 31) & (F.col("turn") == 0)), F.col("turn")).alias("ordinal"), (F.col("turn") % 10 != 9).alias("is_object"), F.when(F.col("turn") % 6 == 5, "").when(F.col("turn") % 4 == 3, "same").otherwise(F.concat(F.lit("i"), F.col("turn").cast("string"))).alias("id"), F.concat(F.lit("p"), F.col("turn").cast("string")).alias("path"), F.when(mod("turn", 2), F.concat(F.lit("e"), F.col("turn").cast("string"))).alias("evidence_path"))
    files = c.filter("turn % 5 <> 0").select("directory", F.concat(F.lit("p"), F.col("turn").cast("string")).alias("path")).unionByName(c.filter("turn % 3 = 0").select("directory", F.concat(F.lit("e"), F.col("turn").cast("string")).alias("path")))
    start = F.when(F.col("turn") % 9 != 4, F.col("turn") * 3 - F.when(F.col("turn") % 5 == 3, 10).otherwise(0))
    sections = c.select("directory", F.col("turn").alias("ordinal"), (F.col("turn") % 8 != 7).alias("is_object"), F.when(F.col("turn") % 7 == 6, "").when(F.col("turn") % 5 == 4, "again").otherwise(F.concat(F.lit("s"), F.col("turn").cast("string"))).alias("id"), start.alias("start_line"), (start + 2).alias("end_line"), F.lit(14).alias("total_lines"))
    outlines = c.select("directory").unionByName(p.filter("page_id % 10 = 0").select("directory")).distinct()
    return lint.union([controls, validate.manifest_issues(manifests), validate.asset_issues(lists, files), validate.outline_issues(outlines, sections)])


@query
def bundle_validator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked(spark, sf_dir).select("directory", "code", "severity", "subject")


@query
def bundle_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = t(spark, sf_dir, "pages").select(F.concat(F.lit("b"), F.col("page_id").cast("string")).alias("directory")).unionByName(t(spark, sf_dir, "conversations").select(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("directory")))
    return validate.status(every, checked(spark, sf_dir)).select("directory", "status", "n_issues")


# ---- ledgers


def ledger_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    c, o = t(spark, sf_dir, "customer"), t(spark, sf_dir, "orders")
    key = F.col("c_custkey").cast("string").alias("directory")
    sha = sha256("c_name")
    manifests = c.filter("c_custkey % 23 <> 0").select(key, F.when(mod("c_custkey", 19), "1.0").otherwise("2.0").alias("schema_version"), F.when(mod("c_custkey", 17), "").otherwise(sha).alias("source_sha256"))
    own = F.col("o_custkey").cast("string").alias("directory")
    text = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    sections = o.filter("o_orderkey % 11 <> 0").select(own, F.concat(F.lit(" "), F.col("o_orderkey").cast("string")).alias("id"), F.when(mod("o_orderkey", 3), F.concat(text, F.lit("*"))).otherwise(text).alias("content"), F.when(mod("o_orderkey", 5), "warn").otherwise("pass").alias("quality"), F.when(mod("o_orderkey", 8), "fail").otherwise("pass").alias("validation_status"))
    held = c.filter("c_custkey % 4 <> 0").select(key, F.when(mod("c_custkey", 10), "bundle-v2-other").otherwise(ledger.bundle_id(sha)).alias("bundle_id"), (F.col("c_custkey") % 6).alias("revision"), F.lit("2020-01-01").cast("timestamp").alias("created_at"))
    none = F.lit(None).cast("string")
    old = o.filter("o_orderkey % 13 <> 0 AND o_custkey % 4 <> 0").select(own, F.col("o_orderkey").cast("string").alias("id"), sha256(text).alias("content_sha256"), order_status("o_orderstatus").alias("status"), F.when(mod("o_orderkey", 2), "pending").otherwise(none).alias("previous_status"), F.array(F.lit("out")).alias("outputs"), F.when(mod("o_orderkey", 6), F.array(F.lit("qa"))).alias("qa_items"), empty().alias("notes"), F.lit("2021-01-01").cast("timestamp").alias("started_at"), F.lit(None).cast("timestamp").alias("completed_at"), F.lit("2021-02-01").cast("timestamp").alias("updated_at"))
    return manifests, sections, held, old


def merged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    manifests, sections, held, old = ledger_rows(spark, sf_dir)
    return ledger.merge_ledgers(*ledger.snapshot(manifests, sections), held, old, at=F.lit("2022-01-01").cast("timestamp"))


@query
def ledger_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged(spark, sf_dir)[0].select("directory", "bundle_id", "revision", F.year("created_at").alias("created"), "action", "violation", "n_changed")


@query
def ledger_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merged(spark, sf_dir)[1]
    return found.select("directory", "id", "content_sha256", "status", "previous_status", F.array_join("outputs", ",").alias("outputs"), F.array_join("qa_items", ",").alias("qa_items"), F.size("notes").alias("n_notes"), F.year("started_at").alias("started"), F.year("updated_at").alias("updated"), "orphaned", F.year("removed_at").alias("removed"))


@query
def ledger_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders")
    stamp = lambda x: F.lit(x).cast("timestamp")
    sections = o.select(F.col("o_orderkey").alias("id"), order_status("o_orderstatus").alias("status"), F.lit(None).cast("string").alias("previous_status"), F.array(F.lit("a")).alias("outputs"), F.lit(None).cast("array<string>").alias("notes"), F.lit(None).cast("timestamp").alias("started_at"), stamp("2020-01-01").alias("completed_at"), stamp("2020-01-01").alias("updated_at"))
    to = F.when(mod("o_orderkey", 3), "in_progress").when(mod("o_orderkey", 5), "skipped").otherwise("ingested")
    changes = o.filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("id"), order_status("o_orderstatus").alias("from_status"), to.alias("to_status"), F.when(~mod("o_orderkey", 7), F.array(F.lit("b"), F.lit("a"))).alias("outputs"), F.when(mod("o_orderkey", 4), F.array(F.lit("n"))).alias("notes"), (F.col("o_orderkey") % 3).alias("expected_revision"), F.when(mod("o_orderkey", 9), 1).otherwise(F.col("o_orderkey") % 3).alias("revision"))
    out = ledger.apply_changes(sections, changes, ["id"], stamp("2024-01-01"))
    return out.select("id", "status", "previous_status", F.array_join("outputs", ",").alias("outputs"), F.array_join("notes", ",").alias("notes"), F.year("started_at").alias("started"), F.year("completed_at").alias("completed"), F.year("updated_at").alias("updated"))


# ---- traces


@query
def trace_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t(spark, sf_dir, "events")
    asset = F.when(F.col("event_type") == "view", "verified").when(F.col("event_type") == "error", "bogus").otherwise("not-required")
    rows = e.select(F.col("user_id").alias("trace_id"), (F.col("event_id") % 400).cast("string").alias("evidence_id"), F.concat(F.lit("p"), (F.col("event_id") % 50).cast("string")).alias("path"), F.when(mod("event_id", 8), "").otherwise("v1").alias("document_version"), asset.alias("original_asset_status"), F.when(~mod("event_id", 3), "a").alias("original_asset_path"))
    files = spark.range(45).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("path"))
    cited = F.when(mod("event_id", 5), empty()).otherwise(F.array((F.col("event_id") % 400).cast("string"), (F.col("event_id") % 401).cast("string")))
    claims = e.select(F.col("user_id").alias("trace_id"), F.col("event_id").cast("string").alias("claim_id"), F.when(mod("event_id", 2), "supported").otherwise("gap").alias("status"), cited.alias("evidence_ids"))
    of = lambda df, id_, kind: df.select("trace_id", F.lit(kind).alias("kind"), F.col(id_).alias("id"), "violation")
    return of(trace.evidence_violations(rows, files), "evidence_id", "evidence").unionByName(of(trace.claim_violations(claims, rows), "claim_id", "claim"))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t(spark, sf_dir, "events").select("user_id", (F.col("event_id") % 30).alias("stage_id"), F.when(F.col("event_type").isin("view", "click"), "begin").otherwise("end").alias("kind"), F.col("ts").cast("timestamp").alias("at"))
    return trace.pair_stages(e, ["user_id"])


@query
def stage_timers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir).select("user_id", "stage_id", F.unix_micros("started_at").alias("started"), F.unix_micros("ended_at").alias("ended"), "duration_ms")


@query
def trace_finish(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t(spark, sf_dir, "events")
    sums = e.groupBy(F.col("user_id").alias("trace_id")).agg(F.count_if(F.col("event_type") == "error").alias("n_open_stages"), F.count_if(F.col("event_type") == "purchase").alias("n_evidence"), F.count_if(F.col("event_type") == "signup").alias("n_claims"))
    status = F.when(mod("trace_id", 7), "odd").when(mod("trace_id", 3), "failed").otherwise("completed")
    level = F.when(mod("trace_id", 11), "none").when(mod("trace_id", 4), "gap").otherwise("clear")
    gaps = trace.stage_gaps(e.select(F.col("user_id").alias("trace_id"), F.concat_ws("-", "event_type", (F.col("event_id") % 40).cast("string")).alias("stage")), ["trace_id"], ("click-3", "error-7", "view-11"))
    return trace.finish_violations(sums.withColumns({"status": status, "evidence_level": level}), gaps)


@query
def trace_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("ordinal"), F.col("event_type").alias("stage"), F.concat(F.lit("r|"), (F.col("event_id") % 3).cast("string")).alias("route"), F.when(mod("event_id", 2), "ok").alias("status"), F.when(~mod("event_id", 7), (F.col("event_id") % 1000).cast("int")).alias("duration_ms"))
    return trace.render_events(e, ["user_id"]).select("user_id", sha256("markdown").alias("markdown_sha256"), F.size(F.split("markdown", "\n")).alias("n_lines"))


@query
def trace_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = F.transform(F.sequence(F.lit(1), (F.col("event_id") % 40 + 1).cast("int")), lambda i: i.cast("string"))
    e = t(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("at"), F.col("event_type").alias("stage"), numbers.alias("candidates"))
    old = e.filter("event_id % 3 = 0").withColumn("ordinal", F.row_number().over(trace.in_order("user_id", "at", "event_id")))
    heads = e.groupBy(F.col("user_id")).agg(F.min("at").alias("started_at")).filter("user_id % 10 <> 0")
    out = trace.append_events(heads, old, e.filter("event_id % 3 <> 0"), "user_id", "at", "event_id")
    return out.select("user_id", "event_id", "ordinal", F.size("candidates").alias("n_candidates"), "violation")


@query
def newest_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("ordinal"), F.col("event_type").alias("stage"), F.col("value"))
    return trace.newest(e, ["user_id"], "purchase").select("user_id", "ordinal", "value")


# ---- sessions


def packet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("trace_id"), F.col("role").alias("document_path"), (F.col("turn") % 4).cast("string").alias("section_id"), F.col("turn").alias("rank"), F.concat(F.lit("v"), (F.col("turn") % 8).cast("string")).alias("document_version"))


@query
def catalog_handles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fusion.first_of(packet_rows(spark, sf_dir), ["trace_id", "document_path", "section_id"], "rank")
    held = rows.filter("rank < 3").select("trace_id", (F.col("rank") + 1).cast("int").alias("handle_no"), "document_path", "section_id", F.when(mod("trace_id", 3), "old").otherwise(F.col("document_version")).alias("document_version"))
    out = session.upsert_catalog(held, rows.filter("rank > 0"))
    return out.select("trace_id", "document_path", "section_id", "handle_no", "document_version", "violation")


@query
def decision_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "conversations")
    held = c.filter("turn < 3").select(F.col("conv_id").alias("trace_id"), (F.col("turn") + 1).alias("handle_no"))
    status = F.when(F.col("role") == "system", "odd").when(F.col("role") == "user", "supported").otherwise("gap")
    refs = F.when(mod("turn", 4), empty()).otherwise(F.array(F.concat(F.lit("P"), F.col("turn").cast("string"))))
    claims = c.select(F.col("conv_id").alias("trace_id"), F.col("turn").alias("claim_no"), F.when(mod("turn", 5), " ").otherwise(F.col("text")).alias("text"), status.alias("status"), refs.alias("refs"))
    return session.decision_violations(claims, held)


@query
def question_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(mod("turn", 6), " ").when(mod("turn", 4), F.concat("text", F.lit("? and why?"))).otherwise(F.col("text")).alias("text"))
    return session.question_guard(c).select("conv_id", "turn", questions("text").alias("n_questions"), "violation")


@query
def candidate_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    fused = packet_rows(spark, sf_dir).select(F.col("trace_id").alias("query_id"), "document_path", "section_id", (F.col("rank") + 1).alias("rank"))
    fused = fusion.first_of(fused, ["query_id", "document_path", "section_id"], "rank")
    q = fused.select("query_id").distinct()
    wanted = q.select("query_id", F.explode(F.array(F.lit("2"), F.when(mod("query_id", 2), "user::1").otherwise("assistant::2"))).alias("selector"))
    return evidence.select_candidates(fused, wanted).select("query_id", "document_path", "section_id", "rank")


@query
def supplement_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packet_rows(spark, sf_dir).select(F.col("trace_id").alias("query_id"), "document_path", "section_id", "rank")
    out = evidence.merge_supplement(rows.filter("rank % 2 = 0"), rows.filter("rank % 3 = 1"))
    return out.select("query_id", "document_path", "section_id", "rank")


@query
def candidate_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "pages")
    rows = p.select("page_id", F.concat(F.lit("/a\\b/"), F.col("page_id").cast("string"), F.lit("/")).alias("source"), (F.col("page_id") % 9).alias("start_line"), (F.col("page_id") % 9 + 3).cast("string").alias("end_line"), F.when(mod("page_id", 2), F.lit(0.5)).alias("rerank_score"), F.when(mod("page_id", 3), F.lit(0.25)).alias("rrf_score"))
    return evidence.normalise_candidates(rows).select("page_id", "vault_path", "line_start", "line_end", "score", "score_type")


@query
def verification_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "pages")
    rows = p.select("page_id", F.when(mod("page_id", 5), 2).otherwise(0).alias("n_images"), F.when(mod("page_id", 3), "http://viewer").alias("viewer_url"), F.when(mod("page_id", 2), "a.pdf").otherwise("").alias("source_path"), F.when(~mod("page_id", 7), F.array(F.lit(1))).otherwise(empty("int")).alias("pages"))
    return evidence.verification_carrier(rows).select("page_id", "carrier")


# ---- retrieval


@query
def rerank_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = t(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("context")).join(F.broadcast(bm25_topk(spark, sf_dir)), "doc_id")
    rows = full.join(F.broadcast(asked(spark, sf_dir).select("query_id", F.col("text").alias("query"))), "query_id")
    return fusion.rerank(rows).select("query_id", "doc_id", "rank", "rerank_score", "rerank")


@query
def hybrid_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = t(spark, sf_dir, "documents")
    chunks = d.select(F.col("doc_id").alias("id"), "text", F.col("text").alias("parent_text"), F.concat_ws("-", "lang", (F.col("doc_id") % 50).cast("string")).alias("parent_id"))
    found = retrieval.hybrid_search(chunks, asked(spark, sf_dir), Settings(max_same_parent=1, rerank_top_k=6))
    return found.select("query_id", "id", "score", "rank")


@query
def deepest_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = line_chunks(spark, sf_dir).select("document_path", F.col("chunk_id").alias("block_id"), F.col("line_start").alias("line"))
    return hierarchy.deepest_container(points, hierarchy.outline(turns(spark, sf_dir))).select("document_path", "block_id", "line", "section_id")


@query
def routing_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t(spark, sf_dir, "documents").select("source", F.col("doc_id").alias("ordinal"), F.when(mod("doc_id", 2), F.upper("lang")).otherwise(F.col("lang")).alias("term"))
    return bundles.routing_terms(rows, "source").select("source", F.array_join("routing_terms", ",").alias("terms"))


@query
def projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hierarchy.outline(turns(spark, sf_dir))
    sections = found.select(F.col("document_path").alias("directory"), F.col("section_id").alias("id"), F.concat(F.lit("t"), "section_id").alias("title"), "level", "parent", "path", "start_line", "end_line", F.array(F.lit(1)).alias("pages"), empty().alias("assets"), F.lit("pass").alias("quality"))
    heads = sections.select("directory").distinct().filter("directory % 7 <> 0").select("directory", F.struct(F.concat("directory", F.lit(".pdf")).alias("filename"), sha256("directory").alias("sha256")).alias("source"))
    one = F.array(F.struct(F.col("start_line").alias("start_line"), F.col("start_line").alias("end_line")))
    entry = F.struct(F.col("id"), F.when(F.col("level") == 2, "ingested").otherwise("pending").alias("status"), one.alias("content_ranges"), sha256("id").alias("content_sha256"))
    held = sections.filter("id % 3 <> 0 AND directory % 5 <> 0").groupBy("directory").agg(F.collect_list(entry).alias("sections"))
    out = bundles.build_projection(heads, sections, held)
    return out.select("document_path", "source_filename", "section_id", F.array_join("path_titles", ">").alias("titles"), span(F.col("content_ranges")).alias("owned"), "ingest_status")


@query
def dashboards(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = t(spark, sf_dir, "documents")
    folder = F.when(mod("doc_id", 4), "10_Raw/a").when(mod("doc_id", 3), "30_Cards").when(mod("doc_id", 5), "40_Concepts").otherwise(".obsidian")
    kind = F.when(mod("doc_id", 2), "knowledge-card").otherwise("concept")
    notes = d.select(F.concat(folder, F.lit("/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("path"), (F.col("n_chars") % 1000).alias("mtime"), F.create_map(F.lit("type"), F.array(kind), F.lit("status"), F.array(F.lit("open"), F.col("lang"))).alias("frontmatter"), F.sequence(F.lit(1), F.greatest(F.lit(1), (F.col("doc_id") % 6).cast("int"))).alias("inlinks"), F.array(F.lit(1)).alias("outlinks"))
    rows = []
    for name, columns in (("raw_sources", ("Folder",)), ("knowledge_cards", ("Status",)), ("recent_changes", ("Folder",)), ("concepts", ("Status",))):
        rows.append(catalog.run(catalog.SAVED[name], notes).select(F.lit(name).alias("dashboard"), "path", F.col(columns[0]).cast("string").alias("value")))
    return lint.union(rows)


# ---- functions


@query
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "pages")
    path, why = reason_split(F.concat(F.col("page_id").cast("string"), F.when(mod("page_id", 2), "::r::s").when(mod("page_id", 3), "::").otherwise("")))
    flag = F.when(mod("page_id", 5), " Yes ").when(mod("page_id", 3), "on").otherwise("no")
    index = F.when(mod("page_id", 4), "x").otherwise((F.col("page_id") % 30).cast("string"))
    pages = clean_pages(F.array((F.col("page_id") % 4).cast("int"), F.lit(0), F.lit(7), (F.col("page_id") % 4).cast("int")))
    return p.select("page_id", safe_id("url", 30).alias("safe"), truthy(flag).alias("flag"), path.alias("reason_path"), why.alias("reason"), page_number(index).alias("page"), F.array_join(F.transform(pages, lambda x: x.cast("string")), ",").alias("pages"), sha256(prettify_tables("html")).alias("pretty_sha256"), questions("url").alias("n_questions"))


@query
def path_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "pages")
    end = F.when(mod("page_id", 3), ".MD").when(mod("page_id", 4), ".source-map.md").when(mod("page_id", 5), "/.hidden/x.md").otherwise("/")
    raw = p.select("page_id", F.concat(F.when(mod("page_id", 2), "\\30_Cards\\").when(mod("page_id", 7), "C:/").otherwise("../"), F.col("page_id").cast("string"), end).alias("raw"))
    return raw.select("page_id", paths.normalised("raw").alias("normalised"), paths.is_relative("raw").alias("relative"), paths.name("raw").alias("name"), paths.stem("raw").alias("stem"), paths.suffix("raw").alias("suffix"), paths.is_visible_markdown("raw").alias("visible"), paths.below(paths.normalised("raw"), ("30_Cards",)).alias("below"))


@query
def range_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = t(spark, sf_dir, "lineitem")
    one = F.struct((F.col("l_partkey") % 7).cast("int").alias("start_line"), (F.col("l_suppkey") % 9).cast("int").alias("end_line"))
    two = F.struct(F.lit(3).alias("start_line"), (F.col("l_partkey") % 5).cast("int").alias("end_line"))
    found = li.select("l_orderkey", "l_linenumber", valid_ranges(F.array(one, two), (F.col("l_suppkey") % 4).cast("int"), F.lit(3)).alias("r"))
    return found.select("l_orderkey", "l_linenumber", ranges_id(F.col("r")).alias("block_id"), span(F.col("r")).alias("n_lines"))


MARKDOWN_HEAD = "---\ntype: card\ntags: [a, 'b']\nlist:\n  - x\n  - \"y\"\n# note\n---\n"


def markdown_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as Markdown: front matter of some, headings, tables, tasks and links by turn."""
    c = t(spark, sf_dir, "conversations")
    level = F.when(F.col("role") == "system", "#").when(F.col("role") == "user", "##").otherwise("###")
    number = F.col("turn").cast("string")
    table = F.concat(F.lit("\n| a | b |\n| --- | --- |\n| "), number, F.lit(" | x |\n| y |\n"))
    task = F.concat(F.when(mod("turn", 4), "\n- [x] do ").otherwise("\n- [ ] do "), number)
    body = F.concat(level, F.lit(" T"), number, F.lit("\nSee [[n"), (F.col("turn") % 3).cast("string"), F.lit("|label]].\n"), F.when(F.col("turn") % 5 == 1, table).otherwise(""), F.when(mod("turn", 2), task).otherwise(""))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", body.alias("body")))), lambda x: x["body"]), "\n")
    each = c.groupBy("conv_id").agg(text.alias("text"))
    return each.select(F.col("conv_id").cast("string").alias("source"), F.concat(F.when(mod("conv_id", 2), MARKDOWN_HEAD).otherwise(""), "text").alias("content"))


@query
def markdown_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = markdown.governed(markdown_rows(spark, sf_dir))
    pairs = F.transform(F.array_sort(F.map_entries("frontmatter")), lambda e: F.concat_ws("=", e.key, F.array_join(e.value, "+")))
    return found.select("path", F.array_join(pairs, ";").alias("fields"), sha256("body").alias("body_sha256"), F.array_join("links", ",").alias("links"))


@query
def markdown_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = markdown.tables(markdown_rows(spark, sf_dir))
    cells = F.array_join(F.transform("rows", lambda r: F.array_join(r, ",")), ";")
    return found.select("source", "table_no", F.array_join("headers", ",").alias("headers"), cells.alias("rows"))


@query
def markdown_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markdown.tasks(markdown_rows(spark, sf_dir)).select("source", "line", "completed", "task")


@query
def heading_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunking.parent_sections(markdown_rows(spark, sf_dir))
    return found.select("source", "parent_number", "start_line", "end_line", "heading", sha256("parent_text").alias("text_sha256"), "parent_id")


@query
def heading_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = render.headings(markdown_rows(spark, sf_dir).withColumn("markdown", F.col("content")).select(F.col("source").alias("document_path"), "markdown"))
    return found.select("document_path", "start_line", "level", "title", "total_lines")


@query
def casefold_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat("text", F.lit(" Straße ÄÖ ĲŁ")).alias("text"))
    return c.select("conv_id", "turn", sha256(casefold("text")).alias("folded_sha256"), F.size(terms("text")).alias("n_terms"))


# ---- resolution


@query
def source_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "pages")
    file = F.concat(F.col("page_id").cast("string"), F.lit(".pdf"))
    recorded = F.when(mod("page_id", 2), F.concat(F.lit("docs/"), file)).when(mod("page_id", 3), "../x.pdf")
    wanted = p.select("page_id", recorded.alias("recorded_path"), F.when(mod("page_id", 5), F.concat(F.lit("10_Raw/a/"), file)).alias("manifest_path"), F.when(~mod("page_id", 11), file).otherwise("").alias("source_filename"), F.when(mod("page_id", 4), "").otherwise(F.concat(F.lit("SHA"), (F.col("page_id") % 3).cast("string"))).alias("source_sha256"))
    places = (("docs/", F.col("page_id") % 4 != 2, 3), ("10_Raw/", F.col("page_id") % 6 == 1, 2), ("10_Raw/a/", F.col("page_id") % 7 < 3, 3), ("10_Raw/b/", F.col("page_id") % 7 < 1, 3), ("10_Raw/Converted/", F.lit(True), 3))
    files = lint.union([p.filter(test).select(F.concat(F.lit(folder), file).alias("path"), F.concat(F.lit("sha"), (F.col("page_id") % n).cast("string")).alias("sha256")) for folder, test, n in places])
    return resolve.resolve_sources(wanted, files, "page_id")


@query
def asset_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "pages")
    file = F.concat(F.col("page_id").cast("string"), F.lit(".png"))
    assets = p.select(F.col("page_id").alias("asset_id"), F.when(mod("page_id", 10), "").otherwise(F.concat(F.when(mod("page_id", 3), "/abs/").otherwise("img/"), file)).alias("path"))
    places = (("/abs/", 6), ("r1/img/", 5), ("r2/img/", 4), ("r2/deep/er/", 2), ("r1/z/", 7), ("other/", 1))
    files = lint.union([p.filter(mod("page_id", n)).select(F.concat(F.lit(folder), file).alias("path")) for folder, n in places])
    return resolve.resolve_assets(assets, files, ["r1", "r2"])


@query
def output_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "pages").withColumn("g", (F.col("page_id") / 4).cast("long"))
    path = F.concat(F.when(mod("page_id", 3), "Out/").otherwise("out/deep/"), F.when(mod("page_id", 2), F.concat(F.lit("Stem"), F.col("g").cast("string"))).otherwise("x"), F.lit("-"), F.col("page_id").cast("string"), F.when(mod("page_id", 5), "_Content.JSON").otherwise(".md"))
    rows = p.select("g", path.alias("path"), F.concat(F.lit("stem"), F.col("g").cast("string"), F.lit("-")).alias("stem"), F.lit("_content.json").alias("suffix"))
    return resolve.choose_outputs(rows, ["g"])


@query
def sidecar_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "conversations")
    images = c.filter("role = 'user'").select("conv_id", F.col("turn").alias("ordinal"), F.concat(F.lit("i"), F.col("turn").cast("string")).alias("path"))
    texts = c.filter("role = 'assistant' AND conv_id % 5 <> 0").select("conv_id", F.col("turn").alias("ordinal"), F.concat(F.lit("t"), F.col("turn").cast("string")).alias("text"))
    return resolve.sidecars(images, texts, ["conv_id"])


@query
def packet_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "pages")
    packets = p.select("page_id", sha256("html").alias("file_sha256"))
    ledgers = p.filter("page_id % 3 = 0").select("page_id", F.when(mod("page_id", 2), "").otherwise("ledger").alias("document_hash"))
    manifests = p.filter("page_id % 4 <> 0").select("page_id", F.when(~mod("page_id", 5), "source").alias("source_sha256"))
    return resolve.provenance(packets, ledgers, manifests, "page_id")


@query
def packet_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = t(spark, sf_dir, "documents")
    file = lambda folder, n: F.concat(F.lit(folder), (F.col("doc_id") % n).cast("string"), F.lit(".md"))
    sections = d.select(F.col("doc_id").alias("section_id"), F.array(file("30_Cards/", 90), file("_system/", 3), file("50_Projects/", 70)).alias("outputs"))
    files = d.select(F.concat(F.when(mod("doc_id", 2), "30_Cards/").otherwise("50_Projects/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("path"), "text")
    out = resolve.governed_outputs(sections, files, ["section_id"])
    return out.select("section_id", "path", sha256("content").alias("content_sha256"), "content_truncated")


@query
def block_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = ("text", "image", "chart", "table", "equation", "list", "code", "header")
    kind = F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("l_partkey") % 8 + 1).cast("int"))
    found = resolve.block_counts(t(spark, sf_dir, "lineitem").select("l_orderkey", kind.alias("type")), ["l_orderkey"])
    return found.withColumn("review_required", F.array_join("review_required", ","))


@query
def spec_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders")
    outputs = F.array(F.concat((F.col("o_orderkey") % 4).cast("string"), F.lit(".spec-index.md")), F.lit("card.md"), F.concat((F.col("o_orderkey") % 3).cast("string"), F.lit("x.spec-index.md")))
    found = resolve.spec_index_paths(o.select("o_custkey", F.col("o_orderkey").alias("ordinal"), outputs.alias("outputs")), ["o_custkey"])
    return found.select("o_custkey", F.array_join("paths", ",").alias("paths"))


@query
def request_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "conversations")
    states = c.filter("turn < 3 AND NOT (conv_id % 9 = 4 AND turn = 1)").select(F.col("conv_id").alias("request_id"), F.when(mod("conv_id", 5) & (F.col("turn") == 2), "in_progress").otherwise("completed").alias("status"), (F.col("turn") + 1).alias("question_index"), F.when(mod("conv_id", 4), F.lit(4) + F.when(mod("conv_id", 8), F.col("turn") % 2).otherwise(0)).alias("expected_count"))
    rows = c.select(F.when(F.col("conv_id") % 10 != 1, F.col("conv_id")).alias("request_id"), F.col("conv_id").alias("k"), F.when(F.col("conv_id") % 6 != 5, F.col("turn") + 2).alias("question_index"), F.when(mod("conv_id", 2), F.lit(5) - F.when(mod("conv_id", 7), 5).otherwise(0)).alias("question_count"))
    return resolve.request_guard(rows, states).select("k", "question_index", "question_count", "violation")


@query
def trace_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t(spark, sf_dir, "events").select("event_id", (F.col("event_id") - F.when(mod("event_id", 5), 1).otherwise(0)).alias("trace_id"))
    started = e.filter("event_id % 7 = 0").select("trace_id")
    return trace.start_traces(started, e).select("event_id", "trace_id", "violation")
