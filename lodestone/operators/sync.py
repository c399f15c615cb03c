"""Incremental maintenance: fingerprints, differences between snapshots, upserts, index state."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import sha256
from .chunking import chunk_documents


def fingerprints(docs: DataFrame, source: str = "source", body: str = "content") -> DataFrame:
    return docs.select(F.col(source).alias("source_id"), sha256(body).alias("sha256"))


def difference(current: DataFrame, stored: DataFrame) -> DataFrame:
    """source_id, change (added, changed, removed, same), old and new sha256; one full outer join."""
    both = current.select("source_id", F.col("sha256").alias("new_sha256"), F.lit(True).alias("__new")).join(stored.select("source_id", F.col("sha256").alias("old_sha256"), F.lit(True).alias("__old")), "source_id", "full_outer")
    kind = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "removed").when(F.col("new_sha256").eqNullSafe(F.col("old_sha256")), "same").otherwise("changed")
    return both.select("source_id", kind.alias("change"), "old_sha256", "new_sha256")


def upsert(table: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """new's rows, and those of table whose key new doesn't have."""
    return table.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def delete(table: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    return table.join(gone.select(key).distinct(), key, "left_anti")


def refresh_chunks(chunks: DataFrame, docs: DataFrame, changes: DataFrame, size: int = 800, overlap: float = 0.15) -> DataFrame:
    """The chunk table after a sync: chunks of removed and changed sources go, those of added and changed ones come.
    Only changed documents are chunked."""
    touched = changes.filter("change <> 'same'").select(F.col("source_id").alias("source"))
    fresh = docs.join(changes.filter("change IN ('added', 'changed')").select(F.col("source_id").alias("source")), "source", "left_semi")
    return delete(chunks, touched, "source").unionByName(chunk_documents(fresh, size=size, overlap=overlap))


def corpus_fingerprint(prints: DataFrame) -> DataFrame:
    """One row: a hash over all sources' hashes, whatever their order. Sources' own hashes are summed, not collected."""
    part = F.conv(F.substring(F.sha2(F.concat_ws("|", "source_id", "sha256").cast("binary"), 256), 1, 15), 16, 10).cast("decimal(38,0)")
    return prints.agg(F.count("*").alias("n_sources"), F.sha2(F.coalesce(F.sum(part), F.lit(0).cast("decimal(38,0)")).cast("string").cast("binary"), 256).alias("corpus_fingerprint"))


def settings_fingerprint(settings: dict[str, Any]) -> str:
    return "sha256:" + hashlib.sha256(json.dumps(settings, sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()


def index_state(prints: DataFrame, chunks: DataFrame, settings: dict[str, Any], vault_id: str) -> DataFrame:
    """One row: status, counts, fingerprints and configuration of an index."""
    counts = chunks.agg(F.count("*").alias("n_chunks"))
    return corpus_fingerprint(prints).join(counts).select(F.lit(vault_id).alias("vault_id"), F.lit("ready").alias("status"), "n_sources", "n_chunks", "corpus_fingerprint", F.lit(settings_fingerprint(settings)).alias("config_fingerprint"), F.current_timestamp().alias("indexed_at"))


def absent_state(spark, vault_id: str) -> DataFrame:
    return spark.sql("SELECT CAST(NULL AS STRING) AS corpus_fingerprint").select(F.lit(vault_id).alias("vault_id"), F.lit("absent").alias("status"), F.lit(0).cast("long").alias("n_sources"), F.lit(0).cast("long").alias("n_chunks"), "corpus_fingerprint")


def recall_gate(state: dict[str, Any], settings: dict[str, Any]) -> str | None:
    """The warning with which a recall returns nothing, or None where it may go on."""
    if state.get("status") != "ready":
        return "index-not-ready"
    return "configuration-changed" if state.get("config_fingerprint") != settings_fingerprint(settings) else None
