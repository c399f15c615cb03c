"""Driver queries: the engine's operators over the test tables, by name. ``oracle.py`` has SQL for the same rows.

The tables have no Markdown, so conversations stand in for outlines (a turn is a section, its role the level),
orders for ledgers, events for traces and documents for sources. Nested results are flattened to columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import chunk_type, compact_terms, empty, lines, match_score, query_terms, ranges_id, read_ranges, sha256, shorten, span, terms, title_key, tokens
from ..operators import chunking, dense, evidence, fusion, hierarchy, ledger, lexical, lint, sync, trace
from ..session import ship
from ..sources.files import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows) if name in ("documents", "embeddings", "pages") else rows


def asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


@query
def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(lexical.build(t(spark, sf_dir, "documents")), asked(spark, sf_dir)).select("query_id", "doc_id", "score", "rank")


@query
def knn_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = t(spark, sf_dir, "embeddings")
    queries = vectors.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return dense.knn(vectors, queries)


def overlap_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = t(spark, sf_dir, "documents").select("doc_id", F.explode(F.array_distinct(tokens("text"))).alias("term"))
    words = asked(spark, sf_dir).select("query_id", F.explode(F.array_distinct(tokens("text"))).alias("term"))
    shared = docs.join(F.broadcast(words), "term").groupBy("query_id", "doc_id").agg(F.count("*").alias("shared"))
    return fusion.rank_within(shared, ["query_id"], F.desc("shared"), "doc_id").filter("rank <= 20")


@query
def rrf_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    lexical_route = bm25_topk(spark, sf_dir).select("query_id", "doc_id", "rank", F.lit("bm25").alias("route"))
    other = overlap_route(spark, sf_dir).select("query_id", "doc_id", "rank", F.lit("overlap").alias("route"))
    fused = fusion.reciprocal_rank_fusion(lexical_route.unionByName(other), ["doc_id"], route_order={"bm25": 0, "overlap": 1})
    return fused.select("query_id", "doc_id", "score", F.array_join("routes", "+").alias("routes"), "rank")


@query
def near_dup_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = t(spark, sf_dir, "documents").select("doc_id", "text").join(F.broadcast(bm25_topk(spark, sf_dir)), "doc_id")  # 20 rows a question
    return fusion.drop_near_duplicates(ranked, keep_text=False).select("query_id", "rank", "doc_id")


@query
def exact_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = t(spark, sf_dir, "documents").select("doc_id", sha256("text").alias("sha256"))
    return hashed.groupBy("sha256").agg(F.min("doc_id").alias("kept_id"), F.count("*").alias("copies")).filter("copies > 1")


@query
def chunk_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = t(spark, sf_dir, "documents").select("doc_id", F.posexplode(chunking.windows(tokens("text"), 200, 0.15)).alias("chunk_no", "w"))
    return docs.select("doc_id", "chunk_no", F.size("w").alias("n_tokens"), sha256(F.array_join("w", " ")).alias("chunk_sha256"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as documents: a turn's role is its level, its lines follow those of the turns before."""
    c = t(spark, sf_dir, "conversations").withColumn("n", F.size(lines("text")))
    order = Window.partitionBy("conv_id").orderBy("turn")
    level = F.when(F.col("role") == "system", 1).when(F.col("role") == "user", 2).otherwise(3)
    whole = Window.partitionBy("conv_id")
    return c.select(F.col("conv_id").cast("string").alias("document_path"), F.col("turn").cast("string").alias("section_id"), (F.sum("n").over(order) - F.col("n") + 1).cast("int").alias("start_line"), level.alias("level"), F.sum("n").over(whole).cast("int").alias("total_lines"), F.col("role").alias("title"), "turn", "text")


@query
def section_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hierarchy.outline(turns(spark, sf_dir))
    return found.select("document_path", "section_id", "level", "start_line", "end_line", "parent", F.array_join("path", ">").alias("path"))


def owned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.owned_ranges(hierarchy.outline(turns(spark, sf_dir)))


@query
def owned_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return owned(spark, sf_dir).select("document_path", "section_id", F.size("content_ranges").alias("n_ranges"), span(F.col("content_ranges")).alias("owned_lines"), ranges_id(F.col("content_ranges")).alias("ranges"), F.size("misplaced").alias("n_misplaced"))


def line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = turns(spark, sf_dir).groupBy("document_path").agg(F.max("total_lines").alias("n"))
    each = totals.select("document_path", "n", F.explode(F.sequence(F.lit(1), F.col("n"), F.lit(3))).alias("line_start"))
    return each.select("document_path", F.col("line_start").alias("chunk_id"), "line_start", F.least(F.col("line_start") + 3, F.col("n")).alias("line_end"))


@query
def chunk_to_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections = owned(spark, sf_dir).withColumnRenamed("path", "path_titles")
    found = hierarchy.chunk_sections(line_chunks(spark, sf_dir), sections)
    return found.select("document_path", "chunk_id", "line_end", "section_id", "owned_span", "depth")


def located(spark: SparkSession, sf_dir: str, questions: DataFrame | None = None, terms: bool = True) -> DataFrame:
    docs = t(spark, sf_dir, "documents")
    routes = docs.groupBy("source").agg(F.array_join(F.array_sort(F.collect_set("lang")), " ").alias("langs"))
    routes = routes.select(F.col("source").alias("document_path"), F.concat_ws(" ", "source", "langs").alias("routing"))
    sections = docs.select(F.col("source").alias("document_path"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("section_id"), F.substring_index("text", "\n", 1).alias("title"), F.array(F.col("lang")).alias("path_titles"), F.col("text").alias("content"), F.when(F.col("doc_id") % 5 == 0, "stale").otherwise("ingested").alias("ingest_status"), F.col("source").alias("source_filename"))
    return hierarchy.locate(asked(spark, sf_dir) if questions is None else questions, routes, sections, terms=terms)


@query
def hierarchical_locate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return located(spark, sf_dir).select("query_id", "document_path", "section_id", "score", "document_score", F.size("content_terms").alias("n_content_terms"), F.array_join(compact_terms(F.col("title_terms")), " ").alias("title_terms"), "rank")


@query
def diversified_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fusion.diversify(located(spark, sf_dir, terms=False).select("query_id", "document_path", "section_id", "rank"), limit=10).select("query_id", "document_path", "section_id", "rank", "position")


@query
def scope_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("query_id"), F.col("role").alias("document_path"), (F.col("turn") % 4).cast("string").alias("section_id"), "turn", F.length("text").alias("n"))
    a = fusion.rank_within(c, ["query_id"], "turn").withColumn("route", F.lit("hierarchical")).withColumn("ordinal", F.col("rank"))
    b = fusion.rank_within(c, ["query_id"], F.desc("n"), "turn").withColumn("route", F.lit("coarse")).withColumn("ordinal", F.col("rank") + 1000000)
    fused = fusion.fuse_same_sections(a.unionByName(b))
    ranks = F.array_join(F.transform(F.map_entries("route_ranks"), lambda e: F.concat_ws("=", e.key, e.value.cast("string"))), ",")
    return fused.select("query_id", "document_path", "section_id", F.array_join("retrieval_routes", "+").alias("routes"), ranks.alias("route_ranks"), "fusion_score", "rank")


@query
def parent_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = t(spark, sf_dir, "documents").select(F.col("lang").alias("query_id"), F.col("source").alias("parent_id"), "doc_id", "n_chars")
    return fusion.cap_by_parent(fusion.rank_within(docs, ["query_id"], F.desc("n_chars"), "doc_id"), 2)


@query
def evidence_packet(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections = owned(spark, sf_dir)
    texts = turns(spark, sf_dir).groupBy("document_path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x.text), "\n").alias("text"))
    found = evidence.packets(sections.select("document_path", "section_id", "content_ranges"), texts)
    return found.select("document_path", "section_id", "block_id", sha256("content").alias("content_sha256"), "content_truncated", "document_version")


def prints(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = t(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("source"), F.col("text").alias("content"), "doc_id")
    old = docs.filter("doc_id % 10 <> 0").withColumn("content", F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("x"), F.col("content"))).otherwise(F.col("content")))
    gone = docs.filter("doc_id % 13 = 0").withColumn("source", F.concat(F.lit("gone-"), F.col("source")))
    return sync.fingerprints(docs), sync.fingerprints(old.unionByName(gone))


@query
def incremental_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sync.difference(*prints(spark, sf_dir))


STATUS = {"F": "ingested", "O": "in_progress", "P": "qa_required"}


def order_status(column: str) -> F.Column:
    return F.when(F.col(column) == "F", STATUS["F"]).when(F.col(column) == "O", STATUS["O"]).otherwise(STATUS["P"])


@query
def ledger_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    new = o.filter("o_orderkey % 11 <> 0").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 3 == 0, F.concat(price, F.lit("*"))).otherwise(price).alias("content_hash"), F.lit("pending").alias("initial_status"))
    old = o.filter("o_orderkey % 13 <> 0").select(F.col("o_orderkey").alias("id"), price.alias("content_hash"), order_status("o_orderstatus").alias("status"))
    return ledger.reconcile(new, old, ["id"])


@query
def ledger_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select("o_custkey", order_status("o_orderstatus").alias("status"), (F.col("o_totalprice") > 50000).alias("ingest_unit"), F.when(F.col("o_orderkey") % 97 == 0, "fail").otherwise("pass").alias("validation_status"))
    return ledger.summarise(o, ["o_custkey"])


@query
def transition_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = F.when(F.col("event_type") == "view", "pending").when(F.col("event_type") == "click", "in_progress").when(F.col("event_type") == "purchase", "ingested").when(F.col("event_type") == "error", "stale").otherwise("qa_required")
    e = t(spark, sf_dir, "events").select("event_id", "user_id", "ts", named.alias("to_status"))
    changes = e.withColumn("from_status", F.lag("to_status").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))).filter("from_status IS NOT NULL")
    evidence_of = F.when(F.col("event_id") % 2 == 0, F.array(F.lit("note"))).otherwise(empty())
    audited = ledger.audit_transitions(changes.withColumn("outputs", evidence_of).withColumn("notes", evidence_of))
    return audited.select("event_id", "user_id", "from_status", "to_status", "violation")


@query
def stage_gap_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t(spark, sf_dir, "events").select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("event_type").alias("stage"))
    return trace.stage_gaps(e, ["user_id", "day"], ("click", "error", "view")).select("user_id", "day", F.array_join("observed", ",").alias("observed"), F.array_join("missing", ",").alias("missing"))


@query
def time_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t(spark, sf_dir, "events").select("user_id", F.col("value").alias("duration_ms"), F.when(F.col("event_type").isin("view", "click"), "primary").otherwise("diagnostic").alias("accounting"), F.lit(2000.0).alias("total"))
    return trace.account_time(e, ["user_id"], "total")


@query
def routes_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("ordinal"), F.col("event_type").alias("route"), F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("status"), F.floor("value").cast("int").alias("hit_count"))
    return trace.routes_in_order(e, ["user_id"]).select("user_id", F.array_join("attempted", ",").alias("attempted"), F.array_join("effective", ",").alias("effective"))


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    return t(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("trace_id"), start.alias("start_at"), (start + F.round(F.col("value") * 3600000000).cast("long")).alias("end_at"))


@query
def interval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trace.interval_overlaps(spans(spark, sf_dir), ["user_id"]).select("user_id", "trace_id", "previous_id", "overlap")


@query
def request_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trace.request_metrics(spans(spark, sf_dir), ["user_id"])


@query
def contiguity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trace.contiguity(t(spark, sf_dir, "conversations"), ["conv_id"], "turn", first=0)


@query
def json_extensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t(spark, sf_dir, "events").select("event_id", F.from_json("props", "map<string,int>").alias("m"))
    return e.select("event_id", F.col("m")["k"].alias("k"), F.array_join(F.array_sort(F.map_keys("m")), ",").alias("keys"), F.size(F.array_except(F.map_keys("m"), F.array(F.lit("k")))).alias("n_unknown"))


@query
def response_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", r"^https?://", "").alias("rest"), "url")
    path = F.when(F.col("page_id") % 17 == 0, F.col("url")).when(F.col("page_id") % 19 == 0, F.concat(F.lit("../"), F.col("rest"))).when(F.col("page_id") % 23 == 0, F.concat(F.lit("/"), F.col("rest"))).otherwise(F.col("rest"))
    rows = p.select("page_id", path.alias("vault_path"), (F.col("page_id") % 5).cast("int").alias("line_start"), (F.col("page_id") % 7).cast("int").alias("line_end"))
    return evidence.validate_candidates(rows).select("page_id", "vault_path", "reason")


@query
def rule_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t(spark, sf_dir, "labels").join(t(spark, sf_dir, "documents"), "doc_id")
    sections = rows.select(F.col("doc_id").cast("string").alias("path"), F.col("source").alias("bundle_id"), F.when(F.col("quality") == 0, "warn").otherwise("pass").alias("quality"), F.when(F.col("toxic") == 1, "qa_required").otherwise("ingested").alias("status"), F.when(F.col("doc_id") % 3 == 0, "verified").otherwise("draft").alias("artifact_status"), F.when(F.col("doc_id") % 5 == 0, "needs-qa").otherwise("gap").alias("evidence_level"), F.col("text").alias("body"))
    return lint.section_rules(sections, profile="strict").select("code", "severity", "path")


@query
def link_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = t(spark, sf_dir, "pages").select("page_id", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), F.lit(1)))).alias("target"))
    return edges.groupBy("target").agg(F.count("*").alias("inlinks"), F.min("page_id").alias("first_page"))


@query
def capsule_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("ordinal"), shorten("text", 80).alias("text"), F.when(F.col("role") != "user", F.concat_ws("-", "role", (F.col("turn") % 3).cast("string"))).alias("source"))
    out = trace.render_capsules(c, ["conv_id"])
    return out.select("conv_id", "n_claims", "n_sources", sha256("body").alias("body_sha256"))


@query
def governed_join_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, o, c, n, r, s = (t(spark, sf_dir, x) for x in ("lineitem", "orders", "customer", "nation", "region", "supplier"))
    home = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    met = li.join(o, li.l_orderkey == o.o_orderkey, "left").join(c, o.o_custkey == c.c_custkey, "left").join(home, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(s.select("s_suppkey", F.col("s_nationkey")), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    amount = F.col("l_extendedprice").cast("decimal(18,2)")
    return met.groupBy(F.coalesce("r_name", F.lit("untracked")).alias("region")).agg(F.count("*").alias("n_lines"), F.sum(amount).cast("decimal(28,2)").alias("amount"), F.count_if(F.col("s_nationkey") == F.col("c_nationkey")).alias("n_domestic"), F.count_if(F.col("l_returnflag") == "R").alias("n_returned"))


@query
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = t(spark, sf_dir, "documents")
    return d.select("doc_id", F.size(tokens("text")).alias("n_tokens"), F.size(terms("text")).alias("n_terms"), title_key(F.get(F.split("text", "\n"), F.lit(0))).alias("title_key"), chunk_type("text", "source").alias("chunk_type"), shorten("text", 40).alias("short"), sha256("text").alias("sha256"), F.size(lines("text")).alias("n_lines"))


@query
def question_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = asked(spark, sf_dir).withColumn("terms", query_terms("text"))
    return q.select("query_id", F.array_join("terms", " ").alias("terms"), F.array_join(compact_terms(F.col("terms"), 12), " ").alias("compact"), match_score(F.col("terms"), 2).alias("full_score"))


@query
def corpus_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority")
    return trace.consistent(o, ["o_custkey"], "o_orderpriority")


@query
def section_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = F.array(F.struct(F.lit(1).alias("start_line"), F.lit(2).alias("end_line")), F.struct(F.lit(4).alias("start_line"), F.lit(5).alias("end_line")))
    d = t(spark, sf_dir, "documents").select("doc_id", lines("text").alias("ls"))
    return d.select("doc_id", sha256(read_ranges(F.col("ls"), one)).alias("slice_sha256"))
