"""Stage timers over several batches of a stream."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from lodestone.operators import trace
from lodestone.streaming import timers

SCHEMA = "trace_id string, stage_id string, stage string, route string, kind string, at timestamp"
T0 = datetime(2024, 1, 1)


def event(stage, kind, minute, trace_id="t", name="read"):
    return (trace_id, stage, name, "route", kind, T0 + timedelta(minutes=minute))


def test_stages_are_timed_over_batches(spark, tmp_path):
    batches = [
        [event("a", "begin", 0), event("b", "begin", 1), event("late", "end", 3), event("odd", "pause", 1)],
        [event("a", "end", 2), event("a", "end", 2), event("late", "begin", 1), event("lost", "end", 4), event("back", "begin", 6), event("back", "end", 5)],
        [event("a", "begin", 0), event("a", "end", 9), event("twice", "begin", 8), event("twice", "begin", 7)],
        [event("tick", "begin", 100), event("tick", "end", 101), event("twice", "end", 10)],
        [event("tock", "begin", 200), event("tock", "end", 201)],
        [event("b", "end", 202), event("tuck", "begin", 203)],
    ]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(source)
        stream = spark.readStream.schema(SCHEMA).json(source)
        query = timers.stage_timers(stream, "30 minutes", "5 minutes").writeStream.format("parquet").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(out)
        query.awaitTermination()
    found = spark.read.parquet(out)
    told = {(r.stage_id, r.outcome): r.duration_ms for r in found.collect()}
    assert len(told) == found.count()
    minute = 60_000.0
    want = {("a", "completed"): 2 * minute, ("late", "completed"): 2 * minute, ("back", "completed"): 0.0, ("twice", "completed"): 3 * minute, ("tick", "completed"): minute, ("tock", "completed"): minute, ("b", "never-ended"): None, ("lost", "unknown-open-stage"): None}
    assert told == want
    ends = {r.stage_id: (r.started_at, r.ended_at, r.stage, r.route) for r in found.collect()}
    assert ends["b"] == (T0 + timedelta(minutes=1), None, "read", "route") and ends["lost"][0] is None
    every = spark.createDataFrame([e for b in batches for e in b], SCHEMA).filter(F.col("stage_id").isin("late", "twice", "tick", "tock"))
    paired = {r.stage_id: r.duration_ms for r in trace.pair_stages(every, ["trace_id"]).collect()}
    assert paired == {k: v for (k, o), v in told.items() if k in paired and o == "completed"}


def test_files_are_synced_into_a_store_bucket_by_bucket(spark, tmp_path):
    from lodestone.sources.revisions import Store
    from lodestone.streaming import arrivals

    root, store, seen = tmp_path / "vault", Store(spark, str(tmp_path / "store")), []
    root.mkdir()

    def run():
        arrivals.sync_store(arrivals.markdown_stream(spark, str(root)), store, str(tmp_path / "check"), 8, lambda fresh, _: seen.append(fresh.count())).trigger(availableNow=True).start().awaitTermination()

    for i in range(6):
        (root / f"n{i}.md").write_text(f"text {i}")
    run()
    first = store.manifest(1)["documents"]["parts"]
    (root / "n7.md").write_text("new")
    run()
    second = store.manifest(2)["documents"]["parts"]
    assert seen == [6, 1] and store.head() == 2 and store.read("documents").count() == 7
    assert sum(second.get(k) != v for k, v in first.items()) <= 1
    run()
    assert store.head() == 2 and {r.content for r in store.read("documents").collect()} == {*(f"text {i}" for i in range(6)), "new"}
