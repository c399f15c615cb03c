"""Candidates and evidence: normalisation, validation with reasons, packets with content and provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import is_relative, normalised, suffix
from ..functions.text import clean_pages, content_lines, empty, ranges_id, read_ranges
from ..model import IMAGE_SUFFIXES


def normalise_candidates(rows: DataFrame) -> DataFrame:
    """One set of names for what providers call differently: vault_path, line_start, line_end, score, score_type."""
    pick = lambda *names: F.coalesce(*[F.col(n) for n in names if n in rows.columns], F.lit(None))
    kind = F.lit("score")
    for name in ("rrf_score", "rerank_score"):
        if name in rows.columns:
            kind = F.when(F.col(name).isNotNull(), name.removesuffix("_score")).otherwise(kind)
    named = {"vault_path": normalised(pick("vault_path", "source")), "line_start": pick("line_start", "start_line").cast("int"), "line_end": pick("line_end", "end_line").cast("int"), "score": pick("rerank_score", "rrf_score", "score").cast("double"), "score_type": pick("score_type") if "score_type" in rows.columns else kind}
    return rows.withColumns(named)


def validate_candidates(rows: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Adds reason: null for a good row, else why it is rejected. A differing hash is only told in ``warning``.

    rows: vault_path, line_start, line_end and, where there, source_sha256. files: path, sha256, n_lines."""
    known = rows
    if files is not None:
        known = rows.join(files.select(F.col("path").alias("vault_path"), F.col("sha256").alias("__sha256"), F.col("n_lines").alias("__n")), "vault_path", "left")
    missing = F.col("__n").isNull() if files is not None else F.lit(False)
    late = (F.col("line_end") > F.col("__n")) if files is not None else F.lit(False)
    reason = (
        F.when(~is_relative("vault_path"), "candidate-path-rejected").when(missing, "candidate-missing")
        .when(F.col("line_start").isNull() | (F.col("line_start") < 1) | (F.col("line_end") < F.col("line_start")) | late, "candidate-lines-invalid")
    )
    warning = F.when(F.col("source_sha256") != F.col("__sha256"), "candidate-source-changed") if files is not None and "source_sha256" in rows.columns else F.lit(None).cast("string")
    return known.withColumn("reason", reason).withColumn("warning", warning).drop("__sha256", "__n")


def select_candidates(fused: DataFrame, wanted: DataFrame | None = None, default: int = 3) -> DataFrame:
    """The rows that a question asks to inspect: by rank, section id or ``document::section``; else the first few.

    wanted: query_id, selector."""
    if wanted is None:
        return fused.filter(F.col("rank") <= default)
    keyed = fused.withColumn("__s", F.explode(F.array(F.col("rank").cast("string"), F.col("section_id"), F.concat_ws("::", "document_path", "section_id"))))
    return keyed.join(wanted.select("query_id", F.col("selector").alias("__s")).distinct(), ["query_id", "__s"], "left_semi").drop("__s").dropDuplicates(["query_id", "document_path", "section_id"])


def packets(selected: DataFrame, documents: DataFrame, assets: DataFrame | None = None, most_chars: int = 12000) -> DataFrame:
    """Evidence packets: each selected section with its content, pages, locator, version and assets.

    selected: query_id, document_path, section_id, content_ranges and any others. documents: document_path, text,
    and document_version where there. assets: document_path, id, section_id, path, caption."""
    texts = documents.select("document_path", content_lines("text").alias("__lines"), *(["document_version"] if "document_version" in documents.columns else [F.sha2(F.col("text").cast("binary"), 256).alias("document_version")]))
    full = selected.join(texts, "document_path", "left").withColumn("content", read_ranges(F.coalesce("__lines", empty()), F.col("content_ranges"))).drop("__lines")
    out = full.withColumn("content_truncated", F.length("content") > most_chars).withColumn("content", F.substring("content", 1, most_chars)).withColumn("block_id", ranges_id(F.col("content_ranges")))
    if "pages" in selected.columns:
        out = out.withColumn("pages", clean_pages(F.col("pages")))
    if assets is not None:
        own = assets.groupBy("document_path", "section_id").agg(F.array_sort(F.collect_list(F.struct("id", "path", "caption"))).alias("assets"))
        out = out.drop("assets").join(own, ["document_path", "section_id"], "left")
    return out


def visual_assets(assets: DataFrame) -> DataFrame:
    """Assets that are images, by their evidence path if there is one."""
    path = F.coalesce("evidence_path", "path")
    return assets.withColumn("shown_path", path).filter(suffix("shown_path").isin(*IMAGE_SUFFIXES)).dropDuplicates(["document_path", "shown_path"])


def merge_supplement(previous: DataFrame, new: DataFrame) -> DataFrame:
    """New rows first, then previous ones, one for each section of a question."""
    both = new.withColumn("__at", F.struct(F.lit(0).alias("part"), "rank")).unionByName(previous.withColumn("__at", F.struct(F.lit(1).alias("part"), "rank")))
    first = both.withColumn("__n", F.row_number().over(Window.partitionBy("query_id", "document_path", "section_id").orderBy("__at"))).filter("__n = 1")
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("__at", "document_path", "section_id"))).drop("__n", "__at")


def verification_carrier(rows: DataFrame) -> DataFrame:
    """How a packet can be checked by eye: existing images, a viewer, rendered pages, or not at all.

    rows: n_images, viewer_url, source_path, pages."""
    return rows.withColumn("carrier", F.when(F.col("n_images") > 0, "evidence-image").when(F.coalesce(F.col("viewer_url"), F.lit("")) != "", "viewer").when((F.coalesce(F.col("source_path"), F.lit("")) != "") & (F.size(F.col("pages")) > 0), "page-render").otherwise("unavailable"))
