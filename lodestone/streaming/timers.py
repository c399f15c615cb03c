"""Stage timers over a stream of begin and end events: state for each open stage, and a timer for those that never end.

Events may come late, twice, or the end before the begin; within the watermark the order doesn't matter. A stage is told
once: as completed when both its ends are known, with its milliseconds; as never-ended when ``patience`` has passed since
its begin; as unknown-open-stage when an end has waited that long for a begin. What is told is remembered until then, so
that a repeated event isn't taken for a new stage; after that the state goes, and state is bounded by the stages of one
``patience``. Of repeated begins the earliest counts, of repeated ends the first that came. As a batch,
``trace.pair_stages`` gives the same durations.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

KEYS = ["trace_id", "stage_id"]
TOLD = "trace_id string, stage_id string, stage string, route string, started_at timestamp, ended_at timestamp, duration_ms double, outcome string"
STATE = "stage string, route string, started_us long, ended_us long, until_us long, told boolean"


def micros(at: pd.Series) -> pd.Series:
    return at.astype("datetime64[us]").astype("int64")


def stage_timers(events: DataFrame, patience: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """trace_id, stage_id, stage, route, started_at, ended_at, duration_ms, outcome, a row for each stage.

    events: a stream of trace_id, stage_id, stage, route, kind (begin or end), at; session time zone UTC."""
    patient = int(pd.Timedelta(patience) / pd.Timedelta("1us"))

    def told(key: tuple, state: tuple, outcome: str) -> pd.DataFrame:
        stage, route, started, ended, _, _ = state
        at = lambda us: pd.NaT if us is None else pd.Timestamp(us, unit="us")
        took = None if started is None or ended is None else round(max(0, ended - started) / 1000, 3)
        return pd.DataFrame({"trace_id": [key[0]], "stage_id": [key[1]], "stage": [stage], "route": [route], "started_at": [at(started)], "ended_at": [at(ended)], "duration_ms": [took], "outcome": [outcome]}).astype({"started_at": "datetime64[us]", "ended_at": "datetime64[us]", "duration_ms": "float64"})

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            held = state.get
            if not held[5]:
                yield told(key, held, "never-ended" if held[2] is not None else "unknown-open-stage")
            state.remove()
            return
        stage, route, started, ended, until, done = state.get if state.exists else (None, None, None, None, None, False)
        for rows in batches:
            at = micros(rows["at"])
            begins, ends = rows["kind"] == "begin", rows["kind"] == "end"
            if begins.any():
                first = at[begins].idxmin()
                if started is None or (not done and at[first] < started):
                    stage, route, started = rows.at[first, "stage"], rows.at[first, "route"], int(at[first])
            if ends.any() and ended is None:
                last = at[ends].idxmin()
                ended = int(at[last])
                if started is None:
                    stage, route = rows.at[last, "stage"], rows.at[last, "route"]
        if started is None and ended is None:  # neither a begin nor an end
            return
        until = (started if started is not None else ended) + patient
        held = (stage, route, started, ended, until, done)
        watermark = state.getCurrentWatermarkMs()
        if not done and started is not None and ended is not None:
            yield told(key, held, "completed")
            held = (*held[:5], True)
        state.update(held)
        state.setTimeoutTimestamp(max(until // 1000, watermark + 1))

    marked = events.withWatermark("at", late).select(*KEYS, "stage", "route", "kind", "at")
    return marked.groupBy(*KEYS).applyInPandasWithState(step, TOLD, STATE, "append", GroupStateTimeout.EventTimeTimeout)
