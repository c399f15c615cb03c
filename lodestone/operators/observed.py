"""Counts that a job collects of its own rows while it runs, told as a trace event when it is done.

The job is whatever the caller does with the rows; there is no second pass for the counts, and trouble with the trace
never stops the job."""

from __future__ import annotations

import time
import warnings
from collections.abc import Callable
from types import TracebackType
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Run:
    """``with Run(...) as run: run.rows(df).write...``: after the block one event goes to ``append``, with status,
    hit_count, duration_ms and the named counts. The first use of ``rows`` is the one that counts. If the block fails,
    the event says so with the error as a warning, and the error goes on, unless ``keep_going``."""

    def __init__(self, stage: str, route: str, append: Callable[[dict[str, Any]], None], counts: dict[str, Column] | None = None, keep_going: bool = False):
        self.event: dict[str, Any] = {"stage": stage, "route": route}
        self.append, self.counts, self.keep_going = append, counts or {}, keep_going
        self.observation: Observation | None = None

    def __enter__(self) -> Run:
        self.began = time.monotonic_ns()
        return self

    def rows(self, df: DataFrame) -> DataFrame:
        if self.observation is not None:
            return df
        self.observation = Observation()
        return df.observe(self.observation, F.count(F.lit(1)).alias("hit_count"), *[c.alias(n) for n, c in self.counts.items()])

    def __exit__(self, kind: type[BaseException] | None, error: BaseException | None, _: TracebackType | None) -> bool:
        self.event["duration_ms"] = round((time.monotonic_ns() - self.began) / 1e6, 3)
        if error is None:
            self.event |= {"status": "ok", **(self.observation.get if self.observation is not None else {})}
        else:
            self.event |= {"status": "unavailable", "hit_count": 0, "warnings": [f"{kind.__name__}: {str(error)[:800]}"]}
        try:
            self.append(dict(self.event))
        except Exception as trouble:
            warnings.warn(f"trace event was not appended: {trouble}", stacklevel=2)
        return self.keep_going and isinstance(error, Exception)
