"""Section ledgers: entries, reconciliation with a new snapshot, the status machine, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import SECTION_STATUSES, TERMINAL_STATUSES, TRANSITIONS


def first_status(validation: Column, quality: Column) -> Column:
    """What a new section starts as."""
    return F.when((validation == "fail") | (quality != "pass"), "qa_required").otherwise("pending")


def carried_status(status: Column, changed: Column) -> Column:
    """What a known section's status becomes when its content did or didn't change."""
    return F.when(~changed, status).when(status.isin("ingested", "skipped", "in_progress", "stale"), "stale").when(status == "qa_required", "qa_required").otherwise("pending")


def reconcile(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Merges a snapshot with the ledger: keys, change (added, unchanged, changed, removed), previous_status, status.

    new: keys, content_hash, initial_status. old: keys, content_hash, status. One full outer join on the keys."""
    a = new.select(*keys, F.col("content_hash").alias("__new"), F.col("initial_status").alias("__initial"))
    b = old.select(*keys, F.col("content_hash").alias("__old"), F.col("status").alias("previous_status"))
    both = a.withColumn("__in_new", F.lit(True)).join(b.withColumn("__in_old", F.lit(True)), keys, "full_outer")
    changed = ~F.col("__new").eqNullSafe(F.col("__old"))
    kind = F.when(F.col("__in_old").isNull(), "added").when(F.col("__in_new").isNull(), "removed").when(changed, "changed").otherwise("unchanged")
    status = F.when(F.col("__in_old").isNull(), F.col("__initial")).when(F.col("__in_new").isNull(), "stale").otherwise(carried_status(F.col("previous_status"), changed))
    return both.select(*keys, kind.alias("change"), "previous_status", status.alias("status"), F.coalesce("__new", "__old").alias("content_hash"))


def summarise(sections: DataFrame, by: list[str]) -> DataFrame:
    """Counts of each status over all sections, of ingest units in all and remaining, and the ledger's state.

    sections: by, status, ingest_unit and, if there, validation_status."""
    unit = F.coalesce(F.col("ingest_unit"), F.lit(True)) if "ingest_unit" in sections.columns else F.lit(True)
    failed = F.bool_or(F.col("validation_status") == "fail") if "validation_status" in sections.columns else F.lit(False)
    settled = F.col("status").isin(*TERMINAL_STATUSES)
    counts = [F.count_if(F.col("status") == s).alias(s) for s in sorted(SECTION_STATUSES)]
    sums = sections.groupBy(*by).agg(*counts, F.count_if(unit).alias("ingest_units_total"), F.count_if(unit & ~settled).alias("ingest_units_remaining"), F.count_if(unit & (F.col("status") == "stale")).alias("__stale"), failed.alias("__failed"))
    state = F.when(F.coalesce("__failed", F.lit(False)), "blocked").when(F.col("__stale") > 0, "stale").when((F.col("ingest_units_total") > 0) & (F.col("ingest_units_remaining") == 0), "complete").otherwise("active")
    return sums.withColumn("state", state).drop("__stale", "__failed")


def transition_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(a, b) for a, to in TRANSITIONS.items() for b in to], "from_status string, to_status string")


def audit_transitions(changes: DataFrame) -> DataFrame:
    """Adds violation to a batch of changes, null where a change is allowed.

    changes: from_status, to_status and, where there, expected_revision, revision, ingest_unit, outputs, notes,
    qa_items, force; what isn't there counts as not given. Checked in the order in which a single change would be refused."""
    has = set(changes.columns)
    force = F.coalesce(F.col("force"), F.lit(False)) if "force" in has else F.lit(False)
    filled = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0 if c in has else F.lit(False)
    allowed = F.lit(False)
    for a, to in TRANSITIONS.items():
        allowed = allowed | ((F.col("from_status") == a) & F.col("to_status").isin(*to))
    rules = []
    if {"expected_revision", "revision"} <= has:
        rules.append((F.col("expected_revision") != F.col("revision"), "revision-conflict"))
    rules.append((~F.col("to_status").isin(*SECTION_STATUSES), "unknown-status"))
    if "ingest_unit" in has:
        rules.append((~F.col("ingest_unit") & ~force, "no-owned-lines"))
    rules += [(~allowed & ~force, "invalid-transition"), ((F.col("to_status") == "ingested") & ~filled("outputs"), "output-required"), ((F.col("to_status") == "skipped") & ~filled("notes"), "note-required"), ((F.col("to_status") == "qa_required") & ~filled("notes") & ~filled("qa_items"), "qa-item-or-note-required")]
    violation = F.lit(None).cast("string")
    for test, code in reversed(rules):
        violation = F.when(test, code).otherwise(violation)
    return changes.withColumn("violation", violation)


def apply_changes(sections: DataFrame, changes: DataFrame, keys: list[str], at: Column | None = None) -> DataFrame:
    """The ledger after the allowed changes of a batch, one for each section: status, previous_status, merged outputs,
    qa_items and notes, and the times."""
    at = at if at is not None else F.current_timestamp()
    good = audit_transitions(changes).filter("violation IS NULL").select(*keys, F.col("to_status").alias("__to"), *[F.col(c).alias(f"__{c}") for c in ("outputs", "qa_items", "notes") if c in changes.columns])
    out = sections.join(good, keys, "left").withColumn("previous_status", F.when(F.col("__to").isNotNull(), F.col("status")).otherwise(F.col("previous_status"))).withColumn("status", F.coalesce("__to", "status"))
    for c in ("outputs", "qa_items", "notes"):
        if f"__{c}" in good.columns:
            none = F.array().cast("array<string>")
            out = out.withColumn(c, F.array_distinct(F.concat(F.coalesce(c, none), F.coalesce(f"__{c}", none)))).drop(f"__{c}")
    moved = F.col("__to").isNotNull()
    out = out.withColumn("started_at", F.when(moved & (F.col("status") == "in_progress"), F.coalesce("started_at", at)).otherwise(F.col("started_at")))
    out = out.withColumn("completed_at", F.when(moved & F.col("status").isin(*TERMINAL_STATUSES), at).otherwise(F.col("completed_at")))
    return out.withColumn("updated_at", F.when(moved, at).otherwise(F.col("updated_at"))).drop("__to")


CHANGED_NOTE = "Section content changed since the previous ledger revision."


def bundle_id(source_sha256: Column | str) -> Column:
    return F.concat(F.lit("bundle-v2-"), F.substring(source_sha256, 1, 16))


def snapshot(manifests: DataFrame, sections: DataFrame, key: str = "directory") -> tuple[DataFrame, DataFrame]:
    """What a ledger is made of, of all bundles at once: heads (key, bundle_id, source_sha256, violation) and section
    entries (key, id, content_sha256, status).

    manifests: key, schema_version, source_sha256. sections: key, id, content, quality, validation_status."""
    old = ~F.startswith(F.coalesce("schema_version", F.lit("")), F.lit("2"))
    violation = F.when(old, "bundle-v2-required").when(F.coalesce("source_sha256", F.lit("")) == "", "source-sha-required")
    heads = manifests.select(key, bundle_id("source_sha256").alias("bundle_id"), "source_sha256", violation.alias("violation"))
    entries = sections.select(key, F.trim("id").alias("id"), F.sha2(F.coalesce("content", F.lit("")).cast("binary"), 256).alias("content_sha256"), first_status(F.col("validation_status"), F.col("quality")).alias("status"))
    return heads, entries.filter("id <> ''")


def merge_ledgers(heads: DataFrame, entries: DataFrame, old_heads: DataFrame, old_sections: DataFrame, key: str = "directory", at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Ledgers after a new snapshot: heads (key, bundle_id, revision, created_at, action, violation, n_changed) and
    sections (all kept state, previous_status, orphaned, removed_at).

    heads and entries are of ``snapshot``. old_heads: key, bundle_id, revision, created_at. old_sections: key, id,
    content_sha256, status, previous_status, outputs, qa_items, notes, started_at, completed_at, updated_at. A ledger of
    another source keeps its sections, and its head says so. Unchanged sections keep all that they had; changed ones
    keep outputs, checks and notes, with one note more; sections that went are orphaned and stale."""
    at = at if at is not None else F.current_timestamp()
    before = old_heads.select(key, F.col("bundle_id").alias("__bundle"), F.col("revision").alias("__revision"), F.col("created_at").alias("__created"))
    met = heads.filter("violation IS NULL").drop("violation").join(before, key, "left")
    known = F.col("__bundle").isNotNull()
    conflict = known & (F.col("__bundle") != F.col("bundle_id"))
    met = met.withColumn("violation", F.when(conflict, "bundle-id-conflict")).withColumn("action", F.when(known, "reconciled").otherwise("initialized"))
    new_heads = met.select(key, "source_sha256", F.when(conflict, F.col("__bundle")).otherwise(F.col("bundle_id")).alias("bundle_id"), F.when(conflict, F.col("__revision")).otherwise(F.coalesce("__revision", F.lit(0)) + 1).alias("revision"), F.coalesce("__created", at).alias("created_at"), "action", "violation")
    good = met.filter("violation IS NULL").select(key)
    state = ("status", "previous_status", "outputs", "qa_items", "notes", "started_at", "completed_at", "updated_at")
    fresh = entries.join(good, key, "left_semi").select(key, "id", F.col("content_sha256").alias("__new"), F.col("status").alias("__first"))
    # A ledger of another source isn't touched, and neither is one without a new snapshot.
    held = old_sections.select(key, "id", F.col("content_sha256").alias("__old"), *[F.col(c).alias(f"__{c}") for c in state]).join(good, key, "left_semi")
    both = fresh.withColumn("__in", F.lit(True)).join(held.withColumn("__was", F.lit(True)), [key, "id"], "full_outer")
    added, gone = F.col("__was").isNull(), F.col("__in").isNull()
    changed = ~added & ~gone & ~F.col("__new").eqNullSafe(F.col("__old"))
    none = F.array().cast("array<string>")
    kept = {c: F.coalesce(f"__{c}", none) for c in ("outputs", "qa_items", "notes")}
    kept["notes"] = F.when(changed, F.concat(kept["notes"], F.array(F.lit(CHANGED_NOTE)))).otherwise(kept["notes"])
    times = {c: F.when(changed, F.lit(None)).otherwise(F.col(f"__{c}")) for c in ("started_at", "completed_at")}
    sections = both.select(
        key, "id", F.coalesce("__new", "__old").alias("content_sha256"), F.when(added, F.col("__first")).when(gone, "stale").otherwise(carried_status(F.col("__status"), changed)).alias("status"),
        F.when(changed, F.col("__status")).otherwise(F.col("__previous_status")).alias("previous_status"), *[x.alias(c) for c, x in kept.items()], *[x.alias(c) for c, x in times.items()],
        F.when(changed, at).otherwise(F.col("__updated_at")).alias("updated_at"), gone.alias("orphaned"), F.when(gone, at).alias("removed_at"), changed.alias("changed"))
    counted = sections.filter("changed").groupBy(key).agg(F.count("*").alias("n_changed"))
    return new_heads.join(counted, key, "left").withColumn("n_changed", F.coalesce("n_changed", F.lit(0))), sections.drop("changed")
