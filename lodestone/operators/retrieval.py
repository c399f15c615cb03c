"""Whole retrieval routes: hybrid search over chunks, recall behind its gate, and fusion with the hierarchical route."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from . import dense, fusion, hierarchy, lexical
from .evidence import normalise_candidates
from .sync import recall_gate


def hybrid_search(chunks: DataFrame, queries: DataFrame, settings: Settings, vectors: DataFrame | None = None, query_vectors: DataFrame | None = None, index: lexical.LexicalIndex | None = None, top_k: int | None = None) -> DataFrame:
    """The best chunks of each query by words and, where there are vectors, by meaning: fused by reciprocal ranks, near
    duplicates and surplus siblings removed, with the parent's text as context.

    chunks: the engine's chunk columns, id unique. queries: query_id, text. vectors: id, embedding. query_vectors:
    query_id, embedding."""
    most = max(settings.top_k, top_k or 0)
    words = lexical.search(index or lexical.build(chunks, "id", "text"), queries, most)
    routes = words.select("query_id", F.col("doc_id").alias("id"), "rank", F.lit("lexical").alias("route"))
    if vectors is not None and query_vectors is not None:
        near = dense.knn(vectors, query_vectors, most, id_column="id", include_self=True).select("query_id", F.col("vec_id").alias("id"), "rank", F.lit("dense").alias("route"))
        routes = near.unionByName(routes)
    fused = fusion.reciprocal_rank_fusion(routes, ["id"], settings.rrf_k, {"dense": 0, "lexical": 1}).select("query_id", "id", "score", "rank")
    full = fused.join(chunks, "id")
    kept = fusion.cap_by_parent(fusion.drop_near_duplicates(full, settings.dedup_threshold, settings.ignored_chunk_types), settings.max_same_parent)
    placed = fusion.rank_within(kept.withColumnRenamed("rank", "fused_rank"), ["query_id"], "fused_rank")
    return placed.filter(F.col("rank") <= max(1, top_k or settings.rerank_top_k)).withColumn("context", F.col("parent_text")).withColumn("score_type", F.lit("rrf"))


def recall(chunks: DataFrame, queries: DataFrame, settings: Settings, state: dict[str, Any], top_k: int | None = None, scorer: Callable[[pd.Series, pd.Series], pd.Series] | None = None, **search: Any) -> tuple[DataFrame, list[str]]:
    """Candidates under their common names, and warnings; no candidate where the index isn't ready or was built with
    other settings. A scorer reranks (question, context) pairs."""
    warning = recall_gate(state, {"settings": settings.fingerprint(), "models": settings.model_fingerprint()})
    found = hybrid_search(chunks if warning is None else chunks.limit(0), queries, settings, top_k=top_k, **search)
    if settings.use_reranker:
        asked = found.join(queries.select("query_id", F.col("text").alias("query")), "query_id")
        found = fusion.rerank(asked, scorer).withColumn("rank", F.col("rerank")).withColumn("score_type", F.lit("rerank")).withColumn("score", F.col("rerank_score")).drop("rerank", "rerank_score", "query")
    named = normalise_candidates(found.withColumnRenamed("source", "vault_path").withColumnRenamed("start_line", "line_start").withColumnRenamed("end_line", "line_end"))
    return named.select("query_id", "vault_path", "line_start", "line_end", "heading", F.substring("text", 1, 400).alias("snippet"), "context", "score", "score_type", F.col("id").alias("provider_ref"), "source_sha256", "rank"), [warning] if warning else []


def scope(hierarchical: DataFrame, candidates: DataFrame, sections: DataFrame, rank_policy: str = "last") -> DataFrame:
    """Fuses located sections with recalled chunks, which are mapped to the sections that own their lines; a chunk
    without a section keeps its own range.

    hierarchical: query_id, rank, score, document_path, section_id. candidates: query_id, rank, score, vault_path,
    line_start, line_end, heading. sections: document_path, section_id, title, path_titles, start_line, end_line,
    content_ranges."""
    known = sections.select("document_path", "section_id", "title", "content_ranges")
    a = hierarchical.select("query_id", "rank", F.col("score").cast("double").alias("score"), "document_path", "section_id").join(known, ["document_path", "section_id"]).withColumn("route", F.lit("hierarchical"))
    chunks = candidates.withColumn("document_path", F.col("vault_path"))
    met = hierarchy.chunk_sections(chunks, sections, keys=("query_id", "rank")).join(known, ["document_path", "section_id"], "left")
    own = F.array(F.struct(F.col("line_start").cast("int").alias("start_line"), F.col("line_end").cast("int").alias("end_line")))
    b = met.select("query_id", "rank", "score", "document_path", "section_id", F.coalesce("title", "heading").alias("title"), F.coalesce("content_ranges", own).alias("content_ranges"), F.lit("coarse").alias("route"))
    rows = a.unionByName(b).withColumn("ordinal", F.when(F.col("route") == "hierarchical", 0).otherwise(1) * 1_000_000 + F.col("rank"))
    return fusion.fuse_scopes(rows, rank_policy=rank_policy)
