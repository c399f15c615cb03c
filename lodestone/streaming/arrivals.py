"""Streaming forms of maintenance: files as they arrive, trace events as they are appended."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import sha256
from ..operators.sync import difference, fingerprints, upsert
from ..sources.revisions import Store

EVENT = "trace_id string, ordinal int, stage string, route string, status string, at timestamp, duration_ms double, accounting string"


def markdown_stream(spark: SparkSession, root: str, glob: str = "*.md") -> DataFrame:
    """source, content, sha256, seen_at of Markdown files as they come."""
    rows = spark.readStream.format("text").option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    return rows.select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("content"), sha256("value").alias("sha256"), F.col("_metadata.file_modification_time").alias("seen_at"))


def sync_stream(stream: DataFrame, read: Callable[[], DataFrame], write: Callable[[DataFrame], None], checkpoint: str, on_changes: Callable[[DataFrame, DataFrame], None] | None = None):
    """Keeps a table of documents (source, content, sha256) up to date with a stream of files. Each batch is compared
    with the table by hash; only what is new or changed is passed on and written. A batch that is run again finds
    nothing changed."""

    def batch(rows: DataFrame, _: int) -> None:
        new = rows.groupBy("source").agg(F.max_by("content", "seen_at").alias("content")).withColumn("sha256", sha256("content")).persist()
        table = read()
        changes = difference(fingerprints(new), table.select(F.col("source").alias("source_id"), "sha256")).filter("change IN ('added', 'changed')").persist()
        fresh = new.join(changes.select(F.col("source_id").alias("source")), "source", "left_semi")
        if not changes.isEmpty():
            write(upsert(table, fresh, "source"))
            if on_changes:
                on_changes(fresh, changes)
        changes.unpersist()
        new.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)


def sync_store(stream: DataFrame, store: Store, checkpoint: str, buckets: int = 64, on_changes: Callable[[DataFrame, DataFrame], None] | None = None):
    """``sync_stream`` into a store: the table ``documents`` lies in buckets by source, and a batch reads and writes only
    those of the files that it has, to a new revision beside the one that it read. Removed files are found by a
    comparison with a full listing, not by a stream."""

    def batch(rows: DataFrame, _: int) -> None:
        new = rows.groupBy("source").agg(F.max_by("content", "seen_at").alias("content")).withColumn("sha256", sha256("content")).persist()
        marked = new.withColumn("bucket", F.pmod(F.xxhash64("source"), F.lit(buckets)).cast("int"))
        hit = sorted(str(r.bucket) for r in marked.select("bucket").distinct().collect())  # as many as there are buckets
        change = store.change()
        there = "documents" in change.tables
        held = store.read("documents", change.base, hit) if there else new.limit(0)
        changes = difference(fingerprints(new), held.select(F.col("source").alias("source_id"), "sha256")).filter("change IN ('added', 'changed')").persist()
        if not changes.isEmpty():
            fresh = new.join(changes.select(F.col("source_id").alias("source")), "source", "left_semi")
            after = upsert(held, fresh, "source").withColumn("bucket", F.pmod(F.xxhash64("source"), F.lit(buckets)).cast("int"))
            change.put_parts("documents", after.select("source", "content", "sha256", "bucket").repartition("bucket"), "bucket", hit)
            change.publish()
            if on_changes:
                on_changes(fresh, changes)
        changes.unpersist()
        new.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)


def unique_events(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """An append-only stream of trace events without what is sent again within the watermark."""
    return events.withWatermark("at", late).dropDuplicatesWithinWatermark(["trace_id", "ordinal"])


def stage_activity(events: DataFrame, width: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Events and milliseconds of each stage in windows of time; a window is final once the watermark has passed it."""
    return events.withWatermark("at", late).groupBy(F.window("at", width), "stage").agg(F.count("*").alias("n"), F.sum(F.coalesce("duration_ms", F.lit(0.0))).alias("total_ms")).select(F.col("window.start").alias("since"), "stage", "n", "total_ms")


def newer_revisions(updates: DataFrame, current: DataFrame) -> DataFrame:
    """Updates of ledgers whose revision is the next after the known one; others come too late or too early.

    updates: bundle_id, expected_revision. current: bundle_id, revision."""
    return updates.join(current, "bundle_id", "left").filter(F.col("expected_revision") == F.coalesce("revision", F.lit(0))).drop("revision")
