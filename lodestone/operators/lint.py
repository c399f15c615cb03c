"""Rules over governed folders: each is a query that returns issues, and an audit is their union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..model import SECTION_STATUSES

# Phrases that mark an open check in a text; names of authority; patterns; folders.
QA_PHRASES = ("needs-qa", "qa_required", "qa required", "manual qa", "人工 qa", "人工复核", "待复核", "需复核", "不提升为权威", "暂不提升为权威", "not authoritative", "do not promote")
HIGH_STATUSES = ("approved", "authoritative", "final", "published", "verified")
HIGH_LEVELS = ("clear", "source-backed")
BUNDLE_ID = r"bundle-v2-[0-9a-fA-F]{16,64}"
PLACEHOLDER = r"\{[^{}\r\n]*\.join\([^{}\r\n]*\)[^{}\r\n]*\}"
AMBIGUOUS = r"(?m)^\s*\|\s*(?:…|\.\.\.)\s*\|"
REQUIRED_DIRS = ("10_Raw", "30_Cards", "40_Concepts", "50_Projects", "90_Dataview", "_system", "_system/metadata", "_system/reports")
GOVERNED_DIRS = ("30_Cards", "40_Concepts", "50_Projects", "_system/reports")
CITATION_FIELDS = ("source_sha256", "source_section_id", "source_lines", "source_pages", "source_assets")
WHOLE_DOCUMENT = ("multiple-pass-sections", "multiple-sections")


def severity(kind: str, profile: str) -> str:
    """error, warning or info of a rule's kind under a profile."""
    if kind == "strict":
        return "error" if profile == "strict" else "warning"
    if kind == "qa":
        return "error" if profile == "strict" else "info" if profile == "qa-review" else "warning"
    if kind == "ready":
        return "error" if profile in ("query-ready", "strict") else "warning"
    return kind


def issues(rows: DataFrame, code: str, kind: str, profile: str, path: Column | str = "path", message: Column | str = "", details: Column | None = None) -> DataFrame:
    where = F.col(path) if isinstance(path, str) else path
    text = F.lit(message) if isinstance(message, str) else message
    return rows.select(F.lit(code).alias("code"), F.lit(severity(kind, profile)).alias("severity"), where.cast("string").alias("path"), text.alias("message"), F.lit("").alias("hint"), (details if details is not None else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))).alias("details"))


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def is_qa(status: Column, quality: Column) -> Column:
    return (status == "qa_required") | quality.isin("warn", "fail")


def has_boundary(level: Column, body: Column) -> Column:
    """Whether a text says that it is open to check, by its level or by a phrase."""
    low = F.lower(F.coalesce(body, F.lit("")))
    return (F.lower(F.coalesce(level, F.lit(""))) == "needs-qa") | F.exists(F.array(*[F.lit(p) for p in QA_PHRASES]), lambda p: F.contains(low, p))


def section_rules(cited: DataFrame, profile: str = "post-ingest") -> DataFrame:
    """Rules over artifacts and the sections that they cite: path, status and quality of the section, artifact_status,
    evidence_level and body of the artifact. An artifact is told once, however many of its sections are open."""
    open_ = cited.filter(is_qa(F.col("status"), F.col("quality"))).dropDuplicates(["path"])
    high = F.lower(F.coalesce("artifact_status", F.lit(""))).isin(*HIGH_STATUSES) | F.lower(F.coalesce("evidence_level", F.lit(""))).isin(*HIGH_LEVELS)
    each = cited.dropDuplicates(["path"])
    return union([
        issues(open_.filter(high), "qa.authority_overpromoted", "error", profile),
        issues(open_.filter(~high & ~has_boundary(F.col("evidence_level"), F.col("body"))), "qa.boundary_weak", "strict", profile),
        issues(each.filter(F.col("body").rlike(PLACEHOLDER)), "artifact.generator_placeholder", "strict", profile),
        issues(each.filter(F.col("body").rlike(AMBIGUOUS)), "evidence.coverage_ambiguous", "strict", profile),
    ])


def ledger_rules(sections: DataFrame, files: DataFrame, profile: str = "post-ingest") -> DataFrame:
    """Rules over ledgers: path (of the ledger), id, status, outputs. files: path, of what exists."""
    counted = sections.groupBy("path", "status").agg(F.count("*").alias("n"))
    count = F.create_map(F.lit("count"), F.col("n").cast("string"))
    outputs = sections.select("path", F.explode("outputs").alias("output"))
    return union([
        issues(counted.filter(~F.col("status").isin(*SECTION_STATUSES)), "ledger.unknown_status", "error", profile, details=F.create_map(F.lit("status"), F.col("status"))),
        issues(counted.filter("status = 'in_progress'"), "ledger.in_progress", "error", profile, details=count),
        issues(counted.filter("status = 'stale'"), "ledger.stale", "error", profile, details=count),
        issues(counted.filter("status = 'pending'"), "ledger.pending", "strict", profile, details=count),
        issues(counted.filter("status = 'qa_required'"), "ledger.qa_open", "qa", profile, details=count),
        issues(outputs.join(files.select(F.col("path").alias("output")).distinct(), "output", "left_anti"), "ledger.output_missing", "error", profile, details=F.create_map(F.lit("output"), F.col("output"))),
    ])


def broken_ledgers(ledgers: DataFrame, profile: str = "post-ingest") -> DataFrame:
    return issues(ledgers.filter("_corrupt_record IS NOT NULL"), "ledger.invalid_json", "error", profile, path="file")


def source_map_rules(maps: DataFrame, ledgers: DataFrame, profile: str = "post-ingest") -> DataFrame:
    """Source maps against ledgers. maps: path, bundle_id, revision, state, source_sha256. ledgers: the same names
    and path. Each field that differs is one issue."""
    names = ("revision", "state", "source_sha256")
    a = maps.select(F.col("path").alias("map_path"), "bundle_id", *[F.col(n).cast("string").alias(f"actual_{n}") for n in names])
    b = ledgers.select("path", "bundle_id", *[F.col(n).cast("string").alias(f"expected_{n}") for n in names])
    both = b.join(a, "bundle_id", "left")
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), F.col(f"actual_{n}").alias("actual"), F.col(f"expected_{n}").alias("expected")) for n in names])
    differ = both.filter("map_path IS NOT NULL").select("map_path", F.explode(F.filter(pairs, lambda p: ~p.actual.eqNullSafe(p.expected))).alias("d"))
    return union([
        issues(both.filter("map_path IS NULL"), "source_map.missing", "error", profile),
        issues(differ, "source_map.mismatch", "error", profile, path="map_path", details=F.create_map(F.lit("field"), F.col("d.field"), F.lit("actual"), F.coalesce("d.actual", F.lit("")), F.lit("expected"), F.coalesce("d.expected", F.lit("")))),
    ])


def front_matter_rules(notes: DataFrame, profile: str = "post-ingest") -> DataFrame:
    """notes: path, frontmatter (map)."""
    bare = notes.filter("frontmatter IS NULL")
    is_map = F.endswith(F.col("path"), F.lit(".source-map.md"))
    lacking = notes.filter("frontmatter IS NOT NULL").select("path", F.explode(F.array_except(F.array(F.lit("type"), F.lit("status")), F.map_keys("frontmatter"))).alias("field"))
    return union([
        issues(bare.filter(is_map), "frontmatter.missing", "error", profile), issues(bare.filter(~is_map), "frontmatter.missing", "warning", profile),
        issues(lacking, "frontmatter.missing_field", "warning", profile, details=F.create_map(F.lit("field"), F.col("field"))),
    ])


def relationship_rules(notes: DataFrame, unresolved: DataFrame, cards: int, profile: str = "post-ingest") -> DataFrame:
    """notes: path, links. unresolved: path, target."""
    return union([
        issues(unresolved, "relationship.unresolved", "strict", profile, details=F.create_map(F.lit("target"), F.col("target"))),
        issues(notes.filter((F.size("links") == 0) & F.lit(cards > 1)), "relationship.missing", "strict", profile),
    ])


def one(frontmatter: Column, key: str) -> Column:
    """The first value of a front matter field, trimmed and without quotes; empty where there is none."""
    return F.coalesce(F.regexp_replace(F.trim(F.get(frontmatter[key], F.lit(0))), '^"|"$', ""), F.lit(""))


def filled(frontmatter: Column, key: str) -> Column:
    return F.coalesce(F.size(F.filter(frontmatter[key], lambda v: F.trim(v) != "")), F.lit(0)) > 0


def bundle_ids(frontmatter: Column, body: Column) -> tuple[Column, Column]:
    """Bundles that the front matter names, and those with the ones that the text names."""
    own = F.coalesce(F.filter(F.transform(frontmatter["source_bundle_id"], lambda x: F.trim(x)), lambda v: v != ""), F.array().cast("array<string>"))
    return own, F.array_distinct(F.concat(own, F.regexp_extract_all(body, F.lit(BUNDLE_ID), F.lit(0))))


def artifact_rules(artifacts: DataFrame, rows: DataFrame, ledgers: DataFrame, sections: DataFrame, profile: str = "post-ingest") -> DataFrame:
    """Rules over governed artifacts: provenance, evidence tables, contracts of cards.

    artifacts: path, frontmatter, body. rows: path, bundle, section (of structured evidence tables). ledgers:
    bundle_id, source_sha256. sections: bundle_id, section_id, outputs."""
    fm = F.col("frontmatter")
    own, every = bundle_ids(fm, F.col("body"))
    counted = rows.groupBy("path").agg(F.count("*").alias("n_rows"))
    a = artifacts.join(counted, "path", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0))).withColumn("own", own).withColumn("every", every)
    a = a.withColumns({"kind": F.lower(one(fm, "type")), "mode": F.lower(one(fm, "evidence_mode")), "section_id": one(fm, "source_section_id"), "sha": one(fm, "source_sha256")})
    cards, single, multi = a.filter("kind = 'knowledge-card'"), a.filter("size(own) = 1").withColumn("bundle_id", F.get("own", F.lit(0))), a.filter("size(every) > 1")
    whole = F.col("section_id").isin(*WHOLE_DOCUMENT)
    lacking = single.select("path", "kind", F.explode(F.array_compact(F.array(*[F.when(~filled(fm, f) & ~(whole & F.lit(f in ("source_pages", "source_assets"))), F.lit(f)) for f in CITATION_FIELDS]))).alias("field"))
    strong = F.col("kind").isin("knowledge-card", "spec-index")
    held = single.join(ledgers.select("bundle_id", F.col("source_sha256").alias("known_sha"), F.lit(True).alias("held")), "bundle_id", "left")
    cites = held.filter(F.col("held") & (F.col("section_id") != "") & ~whole).join(sections.select("bundle_id", "section_id", "outputs", F.lit(True).alias("known")), ["bundle_id", "section_id"], "left")
    table_rows = rows.select("path", F.col("bundle").alias("bundle_id"), F.col("section").alias("section_id")).join(ledgers.select("bundle_id"), "bundle_id", "left_semi")
    contract = F.array_compact(F.array(
        F.when(F.lower(one(fm, "evidence_scope")) != "multi-source", "evidence_scope"), F.when(~F.lower(one(fm, "evidence_coverage")).isin("complete", "representative"), "evidence_coverage"),
        F.when(F.lower(one(fm, "evidence_authority")) != "navigation", "evidence_authority"), F.when(~filled(fm, "source_reports"), "source_reports"), F.when(F.col("n_rows") == 0, "evidence table")))
    unmet = cards.filter("mode = 'index'").withColumn("missing", contract).filter(F.size("missing") > 0)
    field = F.create_map(F.lit("field"), F.col("field"))
    return union([
        issues(multi.filter("n_rows = 0"), "synthesis.multi_source_unstructured", "strict", profile),
        issues(multi.select("path", F.explode("every").alias("bundle_id")).join(ledgers, "bundle_id", "left_anti").select("path").distinct(), "evidence.unknown_bundle", "error", profile),
        issues(held.filter("held IS NULL OR (sha <> '' AND known_sha <> '' AND sha <> known_sha)"), "evidence.unknown_bundle", "error", profile),
        issues(table_rows.join(sections, ["bundle_id", "section_id"], "left_anti"), "evidence.unknown_section", "error", profile),
        issues(cites.filter("known IS NULL"), "evidence.unknown_section", "error", profile),
        issues(cites.filter(F.col("known") & (F.size("outputs") > 0) & ~F.array_contains("outputs", F.col("path"))), "evidence.not_recorded_in_ledger", "warning", profile),
        issues(lacking.filter(strong), "evidence.missing_field", "ready", profile, details=field), issues(lacking.filter(~strong), "evidence.missing_field", "warning", profile, details=field),
        issues(cards.filter("mode = ''"), "evidence.mode_missing", "strict", profile), issues(cards.filter("mode = 'direct' AND size(own) = 0"), "evidence.direct_contract", "strict", profile),
        issues(unmet, "evidence.index_contract", "strict", profile, details=F.create_map(F.lit("missing"), F.array_join("missing", ", "))),
    ])


def layout_rules(present: DataFrame, governance: tuple[str, ...] = ("AGENTS.md",), required_dirs: tuple[str, ...] = REQUIRED_DIRS, profile: str = "post-ingest") -> DataFrame:
    """present: path, of folders and files that are there."""
    spark = present.sparkSession
    need = lambda names: spark.createDataFrame([(n,) for n in names], "path string").join(present.select("path").distinct(), "path", "left_anti")
    return union([issues(need(required_dirs), "vault.missing_required_dir", "error", profile), issues(need(governance), "vault.missing_governance_file", "warning", profile)])


def bundle_rules(bundles: DataFrame, outlines: DataFrame, profile: str = "post-ingest") -> DataFrame:
    """Validates bundles: path, manifest, outline, document (whether there), schema_version, status. outlines: path,
    id, ordinal, start_line, end_line, total_lines."""
    lacking = bundles.select("path", F.explode(F.array_compact(F.array(*[F.when(~F.col(n), F.lit(n)) for n in ("manifest", "outline", "document")]))).alias("name"))
    order = Window.partitionBy("path").orderBy("ordinal")
    each = outlines.withColumn("again", F.row_number().over(Window.partitionBy("path", "id").orderBy("ordinal")) > 1).withColumn("before", F.lag("start_line").over(order))
    return union([
        issues(lacking, "bundle.missing_control_file", "error", profile, details=F.create_map(F.lit("file"), F.col("name"))),
        issues(bundles.filter("status = 'fail'"), "bundle.validation_failed", "error", profile), issues(bundles.filter("status = 'warn'"), "bundle.validation_warning", "warning", profile),
        issues(each.filter("id IS NULL OR trim(id) = ''"), "missing-section-id", "error", profile), issues(each.filter("again AND id IS NOT NULL"), "duplicate-section-id", "error", profile),
        issues(each.filter("start_line IS NULL OR start_line < 1 OR end_line < start_line OR end_line > total_lines"), "invalid-section-range", "error", profile),
        issues(each.filter("before > start_line"), "unordered-sections", "error", profile),
        issues(bundles.filter("outline").join(outlines.select("path").distinct(), "path", "left_anti"), "empty-outline", "warning", profile),
    ])


def severities(found: DataFrame) -> DataFrame:
    return found.groupBy("severity").agg(F.count("*").alias("n"))


def metrics() -> dict[str, Column]:
    """What a lint run counts of governed files, for an aggregate, or for a job that observes itself as it checks them.

    Over path, frontmatter (map of arrays) and links (array): files; files in a folder of cards; and of what says that it
    is a card (and has front matter, and is no source map) those with a link."""
    parts = F.split("path", "/")
    card = F.get(F.col("frontmatter")["type"], F.lit(0)) == "knowledge-card"
    governed = ~F.endswith("path", F.lit(".source-map.md")) & F.col("frontmatter").isNotNull()
    return {
        "governed_markdown_files": F.count("path"), "knowledge_cards": F.count_if(F.get(parts, F.size(parts) - 2) == "30_Cards"),
        "linked_knowledge_cards": F.count_if(governed & F.coalesce(card, F.lit(False)) & (F.size("links") > 0)),
    }


def report(found: DataFrame) -> DataFrame:
    """One Markdown line for each issue, in order of severity, code and path, for a sink to write."""
    rank = F.when(F.col("severity") == "error", 0).when(F.col("severity") == "warning", 1).otherwise(2)
    return found.orderBy(rank, "code", "path").select(F.format_string("- **%s** `%s` %s %s", "severity", "code", F.coalesce("path", F.lit("")), F.coalesce("message", F.lit(""))).alias("value"))
