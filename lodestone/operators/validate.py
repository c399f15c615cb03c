"""Validating document bundles: each rule is a query that returns issues, and a bundle's status is its worst one.

Codes and severities are fixed values of the format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lint import union

PROFILES = ("basic", "engineering")
PAGE_MARK = "<!-- source-page:"


def found(rows: DataFrame, key: str, code: str | Column, severity: str, subject: Column | None = None) -> DataFrame:
    return rows.select(key, (F.lit(code) if isinstance(code, str) else code).alias("code"), F.lit(severity).alias("severity"), (subject if subject is not None else F.lit("")).cast("string").alias("subject"))


def control_issues(bundles: DataFrame, key: str = "directory") -> DataFrame:
    """What stops further checks of a bundle. bundles: key, there (whether the folder is), manifest (its text, null where
    there is none), document (text)."""
    there, shape = F.col("there"), F.ltrim(F.regexp_replace("manifest", "^﻿", ""))
    broken = F.try_parse_json(shape).isNull()
    return union([
        found(bundles.filter(~there), key, "missing-bundle", "fail"), found(bundles.filter(there & F.col("manifest").isNull()), key, "missing-manifest", "fail"),
        found(bundles.filter(there & (F.coalesce("document", F.lit("")) == "")), key, "missing-document", "fail"),
        found(bundles.filter(there & F.col("manifest").isNotNull() & broken), key, "invalid-json", "fail"),
        found(bundles.filter(there & ~broken & ~shape.startswith("{")), key, "invalid-json-shape", "fail"),
    ])


def manifest_issues(manifests: DataFrame, key: str = "directory") -> DataFrame:
    """manifests: key, schema_version, profile, has_outline (whether an outline object is declared), outline_path,
    has_evidence, default_ingest, document (text)."""
    two = F.startswith(F.coalesce("schema_version", F.lit("1.0")), F.lit("2"))
    rows, old = manifests.filter(two), manifests.filter(~two)
    path = F.coalesce("outline_path", F.lit(""))
    return union([
        found(rows.filter(~F.coalesce(F.col("profile").isin(*PROFILES), F.lit(False))), key, "invalid-profile", "fail"),
        found(rows.filter(~F.col("has_outline")), key, "missing-outline", "fail"), found(rows.filter(F.col("has_outline") & (path == "")), key, "missing-outline-path", "fail"),
        found(rows.filter(F.col("has_evidence") & ~F.col("default_ingest").eqNullSafe(F.lit(False))), key, "evidence-default-ingest-enabled", "fail"),
        found(rows.filter((F.col("profile") == "engineering") & ~F.contains("document", F.lit(PAGE_MARK))), key, "missing-page-anchors", "warn"),
        found(old, key, "legacy-bundle-limited-evidence", "warn"),
    ])


def asset_issues(assets: DataFrame, files: DataFrame, key: str = "directory") -> DataFrame:
    """Rules over the lists of images and tables. assets: key, label (images or tables), ordinal (null where the list
    itself is no list), is_object, id, path, evidence_path. files: key, path, of files that aren't empty."""
    code = lambda prefix, suffix: F.concat(F.lit(prefix), F.col("label"), F.lit(suffix))
    entries = assets.filter("ordinal IS NOT NULL AND is_object")
    named = entries.filter("coalesce(id, '') <> ''").withColumn("__n", F.row_number().over(Window.partitionBy(key, "label", "id").orderBy("ordinal")))
    paths = entries.select(key, "label", "id", F.explode(F.array_compact(F.array("path", "evidence_path"))).alias("path")).filter("path <> ''")
    return union([
        found(assets.filter("ordinal IS NULL"), key, code("invalid-", "-list"), "fail"), found(assets.filter("ordinal IS NOT NULL AND NOT is_object"), key, code("invalid-", "-entry"), "fail", F.col("ordinal")),
        found(entries.filter("coalesce(id, '') = ''"), key, code("missing-", "-id"), "fail", F.col("ordinal")), found(named.filter("__n > 1"), key, code("duplicate-", "-id"), "fail", F.col("id")),
        found(paths.join(files.select(key, "path").distinct(), [key, "path"], "left_anti"), key, code("missing-", "-asset"), "fail", F.col("path")),
    ])


def outline_issues(outlines: DataFrame, sections: DataFrame, key: str = "directory") -> DataFrame:
    """outlines: key, of bundles whose outline could be read. sections: key, ordinal, is_object, id, start_line, end_line
    (null where they are no numbers), total_lines."""
    entries = sections.filter("is_object")
    numbered = entries.filter("start_line IS NOT NULL AND end_line IS NOT NULL").withColumn("__before", F.lag("start_line", 1, 0).over(Window.partitionBy(key).orderBy("ordinal")))
    named = entries.filter("coalesce(id, '') <> ''").withColumn("__n", F.row_number().over(Window.partitionBy(key, "id").orderBy("ordinal")))
    subject = F.coalesce(F.nullif("id", F.lit("")), F.col("ordinal").cast("string"))
    bad = "start_line IS NULL OR end_line IS NULL OR start_line < 1 OR end_line < start_line OR end_line > total_lines"
    return union([
        found(outlines.join(sections.select(key).distinct(), key, "left_anti"), key, "empty-outline", "warn"), found(sections.filter("NOT is_object"), key, "invalid-section", "fail", F.col("ordinal")),
        found(entries.filter("coalesce(id, '') = ''"), key, "missing-section-id", "fail", F.col("ordinal")), found(named.filter("__n > 1"), key, "duplicate-section-id", "fail", F.col("id")),
        found(entries.filter(bad), key, "invalid-section-range", "fail", subject), found(numbered.filter("start_line < __before"), key, "unordered-sections", "fail"),
    ])


def status(bundles: DataFrame, issues: DataFrame, key: str = "directory") -> DataFrame:
    """key, status, n_issues: pass, warn or fail, of issues that are told once each."""
    worst = F.max(F.when(F.col("severity") == "fail", 2).when(F.col("severity") == "warn", 1).otherwise(0))
    sums = issues.distinct().groupBy(key).agg(worst.alias("worst"), F.count("*").alias("n_issues"))
    grade = F.when(F.col("worst") == 2, "fail").when(F.col("worst") == 1, "warn").otherwise("pass")
    return bundles.select(key).distinct().join(sums, key, "left").select(key, grade.alias("status"), F.coalesce("n_issues", F.lit(0)).alias("n_issues"))
