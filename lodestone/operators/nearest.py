"""The best few vectors of each query within a task, for ``dense`` and ``vector_store``.

A matrix product of directions finds the candidates: whatever comes within ``SLACK`` of a query's k-th best. These alone
are scored by the sums of ``dense.dot``, term by term in its order, and rounded as Spark does, so a result doesn't depend
on how a product was added up. Vectors that a product can't judge (of another length, with a null or a number that isn't
finite, of a norm near the ends of the range) are scored with every query."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: More than a product of directions is off, and what rounding to six decimals can change.
SLACK = 4e-6
#: Scores of one product, and pairs that are scored at once.
PRODUCT, PAIRS = 4 << 20, 1 << 15
#: Where no product can over- or underflow.
LEAST_NORM, MOST_NORM = 1e-100, 1e100
#: Keys of similarities that are null, and that aren't a number: Spark orders these last and first.
NULL_KEY, NAN_KEY = -np.inf, np.inf


@dataclass
class Vectors:
    """ids; length (of a null vector -1); values, end to end in rows of the longest; norm as ``dense.norm`` has it, broken
    where that is null; plain ones have a direction for products."""

    ids: pa.Array
    length: np.ndarray
    values: np.ndarray
    norm: np.ndarray
    broken: np.ndarray
    plain: np.ndarray
    unit: np.ndarray

    @classmethod
    def of(cls, ids: pa.Array, vectors: pa.Array, width: int) -> Vectors:
        n = len(vectors)
        length = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = vectors.flatten()
        nulls = flat.is_null().to_numpy(zero_copy_only=False)
        number = pc.fill_null(flat.cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False)
        most = max(1, int(length.max(initial=0)))
        at = np.arange(most) < np.maximum(length, 0)[:, None]
        values, missing = np.zeros((n, most)), np.zeros((n, most), bool)
        values[at], missing[at] = number, nulls
        with np.errstate(all="ignore"):
            norm = np.sqrt(in_order(values, values))
            broken = (length < 0) | missing.any(axis=1)
            plain = ~broken & np.isfinite(norm) & ((norm == 0) | (norm >= LEAST_NORM) & (norm <= MOST_NORM))
            plain &= ((norm > 0) | ~values.any(axis=1)) & (length == width)
            unit = np.zeros((n, width))
            if plain.any():
                unit[plain] = values[plain, :width] / np.where(norm > 0, norm, 1.0)[plain, None]
        return cls(ids, length, values, norm, broken, plain, unit)

    def take(self, at: np.ndarray) -> Vectors:
        return Vectors(self.ids.take(pa.array(at)), self.length[at], self.values[at], self.norm[at], self.broken[at], self.plain[at], self.unit[at])

    def part(self, i: int, j: int) -> Vectors:
        return Vectors(self.ids[i:j], self.length[i:j], self.values[i:j], self.norm[i:j], self.broken[i:j], self.plain[i:j], self.unit[i:j])


def in_order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums of products of rows, from left to right."""
    total = np.zeros(len(a))
    for j in range(min(a.shape[1], b.shape[1])):
        total += a[:, j] * b[:, j]
    return total


def rounded(x: np.ndarray) -> np.ndarray:
    """To six decimals, half up by the shortest decimal form of the number, as Spark's ``round``."""
    scaled = np.abs(x) * 1e6
    whole = np.floor(scaled + 0.5)
    out = np.copysign(whole, x) / 1e6 + 0.0
    with np.errstate(invalid="ignore"):
        close = np.flatnonzero(np.isfinite(x) & (np.abs(scaled - np.floor(scaled) - 0.5) < 1e-3))
    for i in close:
        out[i] = float(Decimal(repr(float(x[i]))).quantize(Decimal("0.000001"), ROUND_HALF_UP)) + 0.0
    return np.where(np.isfinite(x), out, x)


def scored(queries: Vectors, q: np.ndarray, rows: Vectors, v: np.ndarray) -> np.ndarray:
    """The sort key of each pair: its rounded similarity, ``NULL_KEY`` or ``NAN_KEY``."""
    out = np.empty(len(q))
    for i in range(0, len(q), PAIRS):
        a, b = q[i : i + PAIRS], v[i : i + PAIRS]
        with np.errstate(all="ignore"):
            norms = rows.norm[b] * queries.norm[a]
            similarity = in_order(rows.values[b], queries.values[a]) / norms
        similarity = np.where(np.isnan(similarity), NAN_KEY, rounded(similarity))
        similarity[rows.length[b] != queries.length[a]] = NULL_KEY
        similarity[rows.broken[b] | queries.broken[a] | (norms <= 0)] = 0.0
        out[i : i + PAIRS] = similarity
    return out


class Best:
    """The k best so far of each query, by key and then by id."""

    def __init__(self, queries: Vectors, k: int, include_self: bool, floor: np.ndarray | None = None):
        self.queries, self.k, self.include_self = queries, k, include_self
        n = len(queries.ids)
        self.q, self.key, self.ids = np.zeros(0, np.int64), np.zeros(0), None
        self.floor = np.full(n, NULL_KEY) if floor is None else floor.copy()

    def meet(self, rows: Vectors, asking: np.ndarray | None = None) -> None:
        """Takes rows in; with ``asking``, for these queries only."""
        asking = np.arange(len(self.queries.ids)) if asking is None else asking
        if not len(rows.ids) or not len(asking) or self.k < 1:
            return
        found_q, found_v = [], []
        plain, odd = np.flatnonzero(rows.plain), np.flatnonzero(~rows.plain)
        # A query's own rows don't count.
        enough = self.k + (0 if self.include_self else pc.max(pc.value_counts(rows.ids).field("counts")).as_py())
        step = max(1, PRODUCT // len(rows.ids))
        for i in range(0, len(asking), step):
            mine = asking[i : i + step]
            easy = mine[self.queries.plain[mine]]
            if len(plain) and len(easy):
                product = self.queries.unit[easy] @ rows.unit[plain].T
                least = self.floor[easy]
                if len(plain) > enough and not np.isfinite(least).all():
                    kth = np.partition(product, len(plain) - enough, axis=1)[:, len(plain) - enough]
                    least = np.maximum(least, kth)
                a, b = np.nonzero(product >= (least - SLACK)[:, None])
                found_q.append(easy[a])
                found_v.append(plain[b])
            if len(odd) and len(easy):
                found_q.append(np.repeat(easy, len(odd)))
                found_v.append(np.tile(odd, len(easy)))
            hard = mine[~self.queries.plain[mine]]
            if len(hard):
                found_q.append(np.repeat(hard, len(rows.ids)))
                found_v.append(np.tile(np.arange(len(rows.ids)), len(hard)))
            if sum(map(len, found_q)) > PRODUCT:
                self._merge(rows, np.concatenate(found_q), np.concatenate(found_v))
                found_q, found_v = [], []
        if found_q:
            self._merge(rows, np.concatenate(found_q), np.concatenate(found_v))

    def _merge(self, rows: Vectors, q: np.ndarray, v: np.ndarray) -> None:
        ids = rows.ids.take(pa.array(v))
        if not self.include_self:
            other = pc.fill_null(pc.not_equal(ids, self.queries.ids.take(pa.array(q))), False)
            ids, other = ids.filter(other), other.to_numpy(zero_copy_only=False)
            q, v = q[other], v[other]
        key = scored(self.queries, q, rows, v)
        q, key = np.concatenate((self.q, q)), np.concatenate((self.key, key))
        ids = ids if self.ids is None else pa.concat_arrays([self.ids, ids])
        order = np.lexsort((ordinals(ids), -key, q))
        q, key = q[order], key[order]
        begin = np.searchsorted(q, q)
        place = np.arange(len(q)) - begin
        keep = place < self.k
        self.q, self.key, self.ids = q[keep], key[keep], ids.take(pa.array(order[keep]))
        last = place == self.k - 1
        self.floor[q[last]] = np.maximum(self.floor[q[last]], key[last])


def ordinals(ids: pa.Array) -> np.ndarray:
    if pa.types.is_integer(ids.type) and not ids.null_count:
        return ids.to_numpy(zero_copy_only=False)
    return pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy(zero_copy_only=False).astype(np.int64)


def flat(ids: pa.Array | pa.ChunkedArray) -> pa.Array:
    return ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids


def blocks(queries: DataFrame, block_bytes: int) -> Iterator[DataFrame]:
    """Queries (query_id, embedding) dealt by hash into blocks of about so many bytes, by their counted number."""
    size = queries.agg(F.count("*").alias("n"), F.sum(F.greatest(F.lit(0), F.size("embedding"))).alias("elements")).first()
    n = max(1, -(-(16 * size["n"] + 8 * (size["elements"] or 0)) // block_bytes))
    for block in range(n):
        yield queries.filter(F.pmod(F.xxhash64("query_id"), F.lit(n)) == block)


def block_of(queries: DataFrame) -> tuple[pa.Array, pa.Array]:
    """One block's ids and vectors, for all tasks."""
    got = queries.select("query_id", F.col("embedding").cast("array<double>").alias("embedding")).toArrow()
    return flat(got.column("query_id")), flat(got.column("embedding"))


def width_of(vectors: pa.Array) -> int:
    """The length that most vectors have."""
    length = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    return int(np.bincount(np.maximum(length, 0)).argmax()) if len(length) else 0


def top(vectors: DataFrame, sent: Broadcast, queries: DataFrame, k: int, include_self: bool, meets: Callable[[Best, Vectors, pa.RecordBatch], None] | None = None) -> DataFrame:
    """query_id, vec_id, similarity: of each task the k best rows of each query of a block. vectors: vec_id, embedding, and
    what ``meets`` wants, which shows a batch's rows to the queries; all of them without it. sent: ``block_of`` the
    queries, and maybe a third: the key that each one's matches have at least."""
    types = dict(vectors.dtypes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, raw, *floor = sent.value
        width, best = width_of(raw), None
        for batch in batches:
            if not batch.num_rows or not len(ids):
                continue
            if best is None:
                best = Best(Vectors.of(ids if include_self else ids.cast(batch.column("vec_id").type), raw, width), k, include_self, *floor)
            rows = Vectors.of(batch.column("vec_id"), batch.column("embedding"), width)
            if meets:
                meets(best, rows, batch)
            else:
                best.meet(rows)
        if best is not None and best.ids is not None:
            similarity = pa.array(np.where(best.key == NAN_KEY, np.nan, best.key), mask=best.key == NULL_KEY, from_pandas=False)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(best.q)), best.ids, similarity], names=["query_id", "vec_id", "similarity"])

    return vectors.mapInArrow(run, f"query_id {dict(queries.dtypes)['query_id']}, vec_id {types['vec_id']}, similarity double")
