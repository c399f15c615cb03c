"""Writes that become visible together, after all checks: ledgers of a snapshot, finished traces.

Both work on a ``Store``: they read one revision, check, write what follows from it, and publish the next. What a check
refuses isn't written and is returned with its codes; the rest of the batch goes on. A writer that raced with another one
gets ``Conflict``, and its tables are never seen; it may read again and repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.revisions import Store
from .ledger import apply_changes, audit_transitions, merge_ledgers, snapshot, summarise
from .trace import claim_violations, evidence_violations, finish_violations, render_capsules

HEADS = "directory string, bundle_id string, source_sha256 string, revision long, created_at timestamp"
SECTIONS = "directory string, id string, content_sha256 string, status string, previous_status string, outputs array<string>, qa_items array<string>, notes array<string>, started_at timestamp, completed_at timestamp, updated_at timestamp, orphaned boolean, removed_at timestamp"
REFUSED = "key string, violation string"


def table_of(store: Store, name: str, schema: str, revision: int) -> DataFrame:
    """A table of a revision, or no rows where the store hasn't got it yet."""
    return store.read(name, revision) if name in store.manifest(revision) else store.spark.createDataFrame([], schema)


def init_ledgers(store: Store, manifests: DataFrame, sections: DataFrame, at: Column | None = None, base: int | None = None, replace: bool = False) -> tuple[int, DataFrame]:
    """Ledgers of a snapshot of bundles, reconciled with those there are (with ``replace``, made anew), in one revision:
    heads, sections and a summary of each ledger. Returns the revision, and (key, violation) of the refused bundles,
    whose ledgers stay as they were, as do those of bundles that the snapshot hasn't got.

    manifests: directory, schema_version, source_sha256. sections: directory, id, content, quality, validation_status."""
    change = store.change(base)
    old_heads, old_sections = table_of(store, "ledger_heads", HEADS, change.base), table_of(store, "ledger_sections", SECTIONS, change.base)
    heads, entries = snapshot(manifests, sections)
    early = heads.filter("violation IS NOT NULL").select(F.col("directory").alias("key"), "violation")
    none = old_heads.limit(0), old_sections.limit(0)
    new_heads, new_sections = merge_ledgers(heads, entries, *(none if replace else (old_heads, old_sections)), at=at)
    good = new_heads.filter("violation IS NULL")
    refused = early.unionByName(new_heads.filter("violation IS NOT NULL").select(F.col("directory").alias("key"), "violation"))
    kept = lambda rows: rows.join(good.select("directory"), "directory", "left_anti")
    names = [c.split()[0] for c in HEADS.split(", ")], [c.split()[0] for c in SECTIONS.split(", ")]
    change.put("ledger_heads", _as(good.select(*names[0]).unionByName(kept(old_heads)), HEADS))
    change.put("ledger_sections", _as(new_sections.select(*names[1]).unionByName(kept(old_sections)), SECTIONS))
    change.put("ledger_refused", _as(refused, REFUSED))
    change.put("ledger_summary", summarise(change.staged("ledger_sections").filter("NOT orphaned").withColumn("ingest_unit", F.lit(True)), ["directory"]))
    revision = change.publish()
    return revision, store.read("ledger_refused", revision)


def change_sections(store: Store, changes: DataFrame, at: Column | None = None, base: int | None = None) -> tuple[int, DataFrame]:
    """Status changes of sections, all allowed ones in one revision; the ledgers they belong to get their next number.
    Returns the revision, and the changes that were refused, with violation; of several changes of one section none is
    made. changes: directory, id, to_status, expected_revision (of the ledger), and what ``audit_transitions`` reads."""
    change = store.change(base)
    heads, sections = store.read("ledger_heads", change.base), store.read("ledger_sections", change.base)
    met = changes.join(heads.select("directory", "revision"), "directory", "left").join(sections.select("directory", "id", F.col("status").alias("from_status")), ["directory", "id"], "left")
    several = F.count("*").over(Window.partitionBy("directory", "id")) > 1
    unknown = F.when(F.col("revision").isNull(), "unknown-ledger").when(F.col("from_status").isNull(), "unknown-section")
    audited = audit_transitions(met.withColumn("__several", several)).withColumn("violation", F.coalesce(unknown, F.when(F.col("__several"), "several-changes"), "violation")).drop("__several")
    change.put("ledger_audit", audited)
    audited = change.staged("ledger_audit")
    good = audited.filter("violation IS NULL").drop("violation")
    moved = good.select("directory").distinct().withColumn("__moved", F.lit(1))
    next_heads = heads.join(moved, "directory", "left").withColumn("revision", F.col("revision") + F.coalesce("__moved", F.lit(0))).drop("__moved")
    change.put("ledger_heads", _as(next_heads.select(*heads.columns), HEADS))
    change.put("ledger_sections", _as(apply_changes(sections, good, ["directory", "id"], at).select(*sections.columns), SECTIONS))
    change.put("ledger_summary", summarise(change.staged("ledger_sections").filter("NOT orphaned").withColumn("ingest_unit", F.lit(True)), ["directory"]))
    revision = change.publish()
    return revision, store.read("ledger_audit", revision).filter("violation IS NOT NULL")


TRACES = "trace_id string, status string, evidence_level string, n_evidence long, n_claims long, finished_at timestamp"


def finish_traces(store: Store, traces: DataFrame, evidence: DataFrame, claims: DataFrame, at: Column | None = None, base: int | None = None) -> tuple[int, DataFrame]:
    """Traces that are done: state, evidence, claims and capsules in one revision. Returns the revision, and (key,
    violation) of the traces that anything stands against; nothing is written of those.

    traces: trace_id, status, evidence_level, n_open_stages. evidence and claims: as ``evidence_violations`` and
    ``claim_violations`` read them, claims with ordinal and text too."""
    change = store.change(base)
    held = table_of(store, "traces", TRACES, change.base)
    counted = traces.join(evidence.groupBy("trace_id").agg(F.count("*").alias("n_evidence")), "trace_id", "left").join(claims.groupBy("trace_id").agg(F.count("*").alias("n_claims")), "trace_id", "left").fillna(0, ["n_evidence", "n_claims"])
    twice = traces.groupBy("trace_id").agg(F.count("*").alias("n")).filter("n > 1").select("trace_id", F.lit("trace-id-repeated").alias("violation"))
    done = traces.join(held.select("trace_id"), "trace_id", "left_semi").select("trace_id", F.lit("already-finished").alias("violation"))
    against = [finish_violations(counted), evidence_violations(evidence).select("trace_id", "violation"), claim_violations(claims, evidence).select("trace_id", "violation"), twice, done]
    found = against[0]
    for more in against[1:]:
        found = found.unionByName(more)
    ours = found.join(traces.select("trace_id").distinct(), "trace_id", "left_semi")
    change.put("trace_refused", _as(ours.select(F.col("trace_id").cast("string").alias("key"), "violation").distinct(), REFUSED))
    bad = change.staged("trace_refused").select(F.col("key").alias("trace_id")).distinct()
    passed = lambda rows: rows.join(bad, "trace_id", "left_anti").join(traces.select("trace_id").distinct(), "trace_id", "left_semi")
    at = at if at is not None else F.current_timestamp()
    fresh = passed(counted).select(F.col("trace_id").cast("string").alias("trace_id"), "status", "evidence_level", F.col("n_evidence").cast("long").alias("n_evidence"), F.col("n_claims").cast("long").alias("n_claims"), at.alias("finished_at"))
    part = f"{change.base + 1}"
    change.put("traces", _as(fresh, TRACES), part, keep=True)
    change.put("trace_evidence", passed(evidence), part, keep=True)
    change.put("trace_claims", passed(claims), part, keep=True)
    change.put("trace_capsules", capsules(passed(claims)), part, keep=True)
    revision = change.publish()
    return revision, store.read("trace_refused", revision)


def capsules(claims: DataFrame) -> DataFrame:
    """trace_id, n_claims, n_sources, body; a claim's source is the first evidence that it names."""
    cited = claims.select("trace_id", "ordinal", "text", F.get("evidence_ids", F.lit(0)).alias("source"))
    return render_capsules(cited, ["trace_id"])


def close_request(store: Store, asked: DataFrame, revision: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Answers of requests whose questions are all finished: request_id, n_questions, answer (the capsules as headed
    parts, by question); and of the others (key, violation). asked: request_id, question_index, trace_id."""
    revision = store.head() if revision is None else revision
    held = store.read("trace_capsules", revision).select("trace_id", "body")
    met = asked.withColumn("trace_id", F.col("trace_id").cast("string")).join(held.withColumn("trace_id", F.col("trace_id").cast("string")), "trace_id", "left")
    numbered = F.count_distinct("question_index") == F.count("*")
    part = F.concat(F.lit("## Question "), F.col("question_index").cast("string"), F.lit("\n\n"), "body")
    sums = met.groupBy("request_id").agg(F.count("*").alias("n_questions"), F.count_if(F.col("body").isNull()).alias("open"), numbered.alias("numbered"), (F.max("question_index") == F.count("*")).alias("full"), F.array_sort(F.collect_list(F.struct("question_index", part.alias("part")))).alias("parts"))
    violation = F.when(F.col("open") > 0, "unfinished-questions").when(~F.col("numbered") | ~F.col("full"), "questions-not-contiguous")
    judged = sums.withColumn("violation", violation)
    answers = judged.filter("violation IS NULL").select("request_id", "n_questions", F.array_join(F.transform("parts", lambda p: p.part), "\n\n").alias("answer"))
    return answers, judged.filter("violation IS NOT NULL").select(F.col("request_id").cast("string").alias("key"), "violation")


def _as(rows: DataFrame, schema: str) -> DataFrame:
    return rows.select(*[F.col(n).cast(t).alias(n) for n, t in (c.split(" ", 1) for c in schema.split(", "))])

