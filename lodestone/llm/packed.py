"""Exchanges of many small fixed-width records, packed: a Spark row holds, for one bucket, whole numpy columns as
bytes. Millions of records cost the JVM thousands of rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(of: np.ndarray, columns: list[np.ndarray]) -> list[tuple]:
    """(bucket, bytes of each column) for each bucket that occurs."""
    if not len(of):
        return []
    order = np.argsort(of, kind="stable")
    of, columns = of[order], [c[order] for c in columns]
    cuts = np.flatnonzero(np.diff(of)) + 1
    return [(int(of[i]), *[c[i:j].tobytes() for c in columns]) for i, j in zip([0, *cuts], [*cuts, len(of)], strict=True)]


def unpack(table: pa.Table | pa.RecordBatch, column: str, dtype: type) -> np.ndarray:
    """The packed column of all rows, end to end."""
    return np.concatenate([np.frombuffer(x.as_buffer(), dtype) for x in table.column(column) if x.is_valid] or [np.zeros(0, dtype)])


def record_batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
