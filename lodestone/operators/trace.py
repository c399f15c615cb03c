"""Query traces as tables: time accounting, overlaps, gaps, constraint checks, answer capsules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import shorten, table_cell
from ..model import ASSET_STATUSES, EVENT_CANDIDATES, EVIDENCE_LEVELS, INACTIVE_ROUTES, TRACE_STATUSES


def elapsed_ms(start: Column, end: Column) -> Column:
    return F.round((F.unix_micros(end) - F.unix_micros(start)) / 1000, 3)


def clean_events(events: DataFrame) -> DataFrame:
    """Events with their candidate lists cut to the audit limit; other columns stay."""
    cut = [c for c in ("candidates", "rejected") if c in events.columns]
    return events.withColumns({c: F.slice(c, 1, EVENT_CANDIDATES) for c in cut})


def account_time(events: DataFrame, by: list[str], total: str | None = None) -> DataFrame:
    """Sums of primary and diagnostic durations (rounded to 3) and, with a total, what primary stages leave of it.

    events: by, duration_ms, accounting."""
    ms = F.coalesce(F.col("duration_ms"), F.lit(0.0))
    sums = events.groupBy(*by).agg(
        F.round(F.sum(F.when(F.col("accounting") == "primary", ms).otherwise(0.0)), 3).alias("primary_ms"),
        F.round(F.sum(F.when(F.col("accounting") == "primary", 0.0).otherwise(ms)), 3).alias("diagnostic_ms"),
        F.count("*").alias("n_events"), *([F.max(total).alias("total_ms")] if total else []))
    return sums.withColumn("unaccounted_ms", F.round(F.greatest(F.lit(0.0), F.col("total_ms") - F.col("primary_ms")), 3)) if total else sums


def routes_in_order(events: DataFrame, by: list[str]) -> DataFrame:
    """Distinct routes by first use: all that were attempted, and those that were effective.

    events: by, ordinal, route, status, hit_count."""
    live = ~F.col("status").isin(*INACTIVE_ROUTES) & (F.coalesce(F.col("hit_count"), F.lit(0)) > 0)
    first = events.filter("route IS NOT NULL").groupBy(*by, "route").agg(F.min("ordinal").alias("at"), F.min(F.when(live, F.col("ordinal"))).alias("live_at"))
    names = lambda at: F.transform(F.array_sort(F.collect_list(F.when(F.col(at).isNotNull(), F.struct(at, "route")))), lambda x: x.route)
    return first.groupBy(*by).agg(names("at").alias("attempted"), names("live_at").alias("effective"))


def interval_overlaps(intervals: DataFrame, by: list[str], start: str = "start_at", end: str = "end_at", id_column: str = "trace_id") -> DataFrame:
    """Each interval with the earlier one that reaches furthest (the first of equals): previous_end, previous_id,
    overlap (in the ends' unit; 0 where there is none). Ends and starts are numbers.

    The running maximum is a window over each group's intervals in order; no pairs are built."""
    order = Window.partitionBy(*by).orderBy(start, end, id_column)
    numbered = intervals.withColumn("__n", F.row_number().over(order))
    before = F.max(F.struct(F.col(end).alias("end"), (-F.col("__n")).alias("n"), F.col(id_column).alias("id"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    found = numbered.withColumn("__before", before).withColumn("previous_end", F.col("__before.end")).withColumn("previous_id", F.col("__before.id"))
    met = F.col(start) < F.col("previous_end")
    return found.withColumn("overlap", F.when(met, F.least(F.col(end), F.col("previous_end")) - F.col(start)).otherwise(F.lit(0))).drop("__n", "__before")


def request_metrics(intervals: DataFrame, by: list[str], start: str = "start_at", end: str = "end_at", id_column: str = "trace_id") -> DataFrame:
    found = interval_overlaps(intervals, by, start, end, id_column)
    return found.groupBy(*by).agg(F.count("*").alias("n_traces"), (F.max(end) - F.min(start)).alias("wall"), F.count_if(F.col("overlap") > 0).alias("n_overlaps"), F.sum("overlap").alias("overlap_total"))


def stage_gaps(events: DataFrame, by: list[str], required: Iterable[str], stage: str = "stage") -> DataFrame:
    """Which required stages a group has no event of."""
    need = F.array(*[F.lit(x) for x in required])
    return events.groupBy(*by).agg(F.array_sort(F.collect_set(stage)).alias("observed")).withColumn("missing", F.array_except(need, F.col("observed")))


def contiguity(rows: DataFrame, by: list[str], index: str, first: int = 1) -> DataFrame:
    """Whether the indices of a group are first, first + 1, ... without gap or repeat."""
    sums = rows.groupBy(*by).agg(F.count("*").alias("n_rows"), F.min(index).alias("low"), F.max(index).alias("high"), F.count_distinct(index).alias("n_distinct"))
    return sums.withColumn("contiguous", (F.col("low") == first) & (F.col("n_distinct") == F.col("high") - first + 1) & (F.col("n_rows") == F.col("n_distinct")))


def consistent(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Whether all recorded values of a group are equal."""
    return rows.groupBy(*by).agg((F.count_distinct(value) <= 1).alias("consistent"))


def pair_stages(events: DataFrame, by: list[str]) -> DataFrame:
    """Opened stages with their closing: by, stage_id, started_at, ended_at, duration_ms; null where still open.

    events: by, stage_id, kind (begin or end), at."""
    sums = events.groupBy(*by, "stage_id").agg(F.min(F.when(F.col("kind") == "begin", F.col("at"))).alias("started_at"), F.max(F.when(F.col("kind") == "end", F.col("at"))).alias("ended_at"))
    return sums.withColumn("duration_ms", elapsed_ms(F.col("started_at"), F.col("ended_at")))


def evidence_violations(evidence: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """trace_id, evidence_id, violation. evidence: trace_id, evidence_id, path, document_version,
    original_asset_status, original_asset_path. files: path, of what exists."""
    twice = F.count("*").over(Window.partitionBy("trace_id", "evidence_id")) > 1
    codes = F.array_compact(F.array(
        F.when(F.col("twice"), "duplicate-evidence-id"), F.when(F.coalesce(F.col("document_version"), F.lit("")) == "", "version-required"),
        F.when(~F.col("original_asset_status").isin(*ASSET_STATUSES), "unknown-asset-status"),
        F.when((F.col("original_asset_status") == "verified") & (F.coalesce(F.col("original_asset_path"), F.lit("")) == ""), "verified-needs-asset")))
    found = evidence.withColumn("twice", twice).select("trace_id", "evidence_id", F.explode(codes).alias("violation"))
    if files is not None:
        found = found.unionByName(evidence.join(files.select("path").distinct(), "path", "left_anti").select("trace_id", "evidence_id", F.lit("path-missing").alias("violation")))
    return found


def claim_violations(claims: DataFrame, evidence: DataFrame) -> DataFrame:
    """trace_id, claim_id, violation: unknown evidence, supported claims without any."""
    used = claims.select("trace_id", "claim_id", F.explode("evidence_ids").alias("evidence_id"))
    unknown = used.join(evidence.select("trace_id", "evidence_id").distinct(), ["trace_id", "evidence_id"], "left_anti").select("trace_id", "claim_id", F.lit("unknown-evidence").alias("violation"))
    bare = claims.filter((F.col("status") == "supported") & (F.size(F.coalesce("evidence_ids", F.array().cast("array<string>"))) == 0)).select("trace_id", "claim_id", F.lit("supported-needs-evidence").alias("violation"))
    return unknown.unionByName(bare).distinct()


def finish_violations(traces: DataFrame, gaps: DataFrame | None = None) -> DataFrame:
    """trace_id, violation: what keeps a trace from being finished. traces: trace_id, status, evidence_level,
    n_open_stages, n_evidence, n_claims. gaps: trace_id, missing."""
    done = F.col("status") == "completed"
    codes = F.array_compact(F.array(
        F.when(~F.col("status").isin(*TRACE_STATUSES), "unknown-status"), F.when(~F.col("evidence_level").isin(*EVIDENCE_LEVELS), "unknown-evidence-level"),
        F.when(F.col("n_open_stages") > 0, "open-stages"), F.when(done & (F.col("evidence_level") != "gap") & (F.col("n_evidence") == 0), "evidence-required"),
        F.when(done & (F.col("n_claims") == 0), "claims-required")))
    found = traces.select("trace_id", F.explode(codes).alias("violation"))
    if gaps is not None:
        found = found.unionByName(gaps.filter(F.size("missing") > 0).select("trace_id", F.concat(F.lit("missing-stages:"), F.array_join("missing", ",")).alias("violation")))
    return found


def numbered_handles(uses: DataFrame, by: list[str], key: str, prefix: str = "S", ordinal: str = "ordinal") -> DataFrame:
    """A handle (S1, S2, ...) for each distinct key of a group, by first use."""
    first = uses.groupBy(*by, key).agg(F.min(ordinal).alias("first_use"))
    return first.withColumn("handle", F.concat(F.lit(prefix), F.row_number().over(Window.partitionBy(*by).orderBy("first_use", key)).cast("string")))


def render_capsules(claims: DataFrame, by: list[str]) -> DataFrame:
    """by, n_claims, n_sources, body: claims as list items with their sources' handles, in order.

    claims: by, ordinal, text, source (null if none)."""
    handles = numbered_handles(claims.filter("source IS NOT NULL"), by, "source")
    cited = claims.join(handles, [*by, "source"], "left")
    item = F.concat(F.lit("- "), table_cell("text"), F.coalesce(F.concat(F.lit(" ["), F.col("handle"), F.lit("]")), F.lit("")))
    listed = F.array_sort(F.collect_list(F.struct("ordinal", item.alias("item"))))
    return cited.groupBy(*by).agg(F.count("*").alias("n_claims"), F.count_distinct("source").alias("n_sources"), F.array_join(F.transform(listed, lambda x: x["item"]), "\n").alias("body"))


def render_events(events: DataFrame, by: list[str]) -> DataFrame:
    """A Markdown table of a trace's events."""
    row = F.concat_ws(" ", F.lit("|"), F.col("ordinal").cast("string"), F.lit("|"), table_cell("stage"), F.lit("|"), table_cell("route"), F.lit("|"), table_cell("status"), F.lit("|"), F.coalesce(F.col("duration_ms").cast("string"), F.lit("")), F.lit("|"))
    head = F.lit("| # | stage | route | status | ms |\n| --- | --- | --- | --- | --- |\n")
    return events.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("ordinal", row.alias("row")))).alias("rows")).select(*by, F.concat(head, F.array_join(F.transform("rows", lambda x: x["row"]), "\n")).alias("markdown"))


def short_claim(claims: DataFrame, most: int = 4000) -> DataFrame:
    """The first of a claim's aliases that isn't blank, as text."""
    names = [c for c in ("text", "claim", "statement", "claim_text") if c in claims.columns]
    return claims.withColumn("text", shorten(F.coalesce(*[F.nullif(F.trim(F.col(c)), F.lit("")) for c in names]), most))


def in_order(*columns: str) -> Window:
    """A window over the rows of the first column, in the order of the others."""
    return Window.partitionBy(columns[0]).orderBy(*columns[1:])


def append_events(traces: DataFrame, events: DataFrame, new: DataFrame, by: str = "trace_id", at: str = "at", id_column: str = "event_id") -> DataFrame:
    """Events after an append: the new ones follow those of their trace, in the order of their times, with candidate lists
    cut to the audit limit. A new event of a trace that was never started has no ordinal but a violation.

    traces: by, of all started ones. events: by, ordinal and the columns of ``new``."""
    last = events.groupBy(by).agg(F.max("ordinal").alias("__last"))
    known = traces.select(by).distinct().withColumn("__known", F.lit(True))
    placed = clean_events(new).join(known, by, "left").join(last, by, "left").withColumn("__n", F.row_number().over(in_order(by, at, id_column)))
    started = F.coalesce(F.col("__known"), F.lit(False))
    fresh = placed.withColumn("ordinal", F.when(started, F.coalesce("__last", F.lit(0)) + F.col("__n"))).withColumn("violation", F.when(~started, "trace-not-started")).drop("__known", "__last", "__n")
    return clean_events(events).withColumn("violation", F.lit(None).cast("string")).unionByName(fresh)


def start_traces(started: DataFrame, new: DataFrame, by: str = "trace_id") -> DataFrame:
    """The new traces, and why one can't be started: its id is taken, or comes twice."""
    twice = F.count("*").over(Window.partitionBy(by)) > 1
    met = new.withColumn("__twice", twice).join(started.select(by).distinct().withColumn("__taken", F.lit(True)), by, "left")
    return met.withColumn("violation", F.when(F.col("__taken"), "trace-exists").when(F.col("__twice"), "trace-id-repeated")).drop("__taken", "__twice")


def newest(events: DataFrame, by: list[str], stage: str) -> DataFrame:
    """The last event of a stage of each group. events: by, ordinal, stage."""
    last = Window.partitionBy(*by).orderBy(F.desc("ordinal"))
    return events.filter(F.col("stage") == stage).withColumn("__n", F.row_number().over(last)).filter("__n = 1").drop("__n")
