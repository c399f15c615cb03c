"""Hard-negative mining by a pivot table: inner products as Euclidean distances, bracketed by the triangle inequality.

Each component x becomes floor(256 * x); scores are inner products of these whole numbers, exact in a long. A row gets
one more component, sqrt(M - |x|^2) with M the greatest squared norm, and an anchor gets 0, so that the squared distance
of the two is |a|^2 + M - 2 * score: near means a high score. The pivot table holds the distance of each row to a few
pivots. For an anchor, | d(a, p) - d(x, p) | and d(a, p) + d(x, p) bracket the distance to x and with it the score; what
the bracket can't rule out is scored exactly.

Two searches over the table: the first positives of each anchor (rows of its label), and then, for each positive, the
best rows of other labels within a share of its score. Anchors are a stated query set; they go to the tasks in blocks of
a fixed number of bytes, a search for each block. Rows stay where they lie, sorted by label and nearest pivot, so a tile
of rows has narrow distances and is ruled out for an anchor as a whole where it can be. What a task sends is its best
few rows of each anchor, so no group grows with a hot label or with copies.

Pivots are chosen far apart among ``SAMPLE`` rows (those of least hash); any choice gives the same rows.

Defined results: rows with a null id, label or vector, or with a null or non-finite component, take no part, nor do rows
of a squared norm of 2^62 or more, as a long wouldn't hold their scores. Of vectors of unequal length the missing
components count as 0. Each row is a row of its own: rows that repeat an id are each other's neighbours, and an anchor
id that two rows have is mined twice. Ties go to the smaller vec_id. No rows, or no anchors, give an empty result. Other
columns, whatever their names, aren't read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, shared_folder, table

SAMPLE, PIVOTS = 1024, 8
#: Bytes of a block of anchors, and rows and anchors of a tile.
BLOCK_BYTES, TILE = 32 << 20, 2048
#: What rounding of distances can add, as a share of squares.
SLACK = 1e-9
FOUND = pa.schema([("anchor", pa.int64()), ("slot", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def whole(vectors: DataFrame) -> DataFrame:
    """vec_id, label, x (array of whole doubles), norm2: the rows that take part."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(~odd)
    rows = rows.select("vec_id", "label", F.transform("embedding", lambda x: F.floor(x * 256).cast("double")).alias("x"))
    square = F.aggregate("x", F.lit(0.0), lambda s, x: s + x * x)
    return rows.select("*", square.alias("norm2")).filter(F.col("norm2") < float(1 << 62))


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of an array column as a matrix of ``dims`` columns."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat, at = np.asarray(column.flatten(), dtype=np.float64), np.asarray(column.offsets, dtype=np.int64)
    at = at - at[0] if len(at) else np.zeros(1, np.int64)
    lengths = np.diff(at)
    if (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lengths), dims))
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - at[row]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray, top: float) -> np.ndarray:
    """Exact inner products: in doubles while all sums stay below 2^53, else in longs."""
    return (a @ b.T).astype(np.int64) if top < 2**53 else a.astype(np.int64) @ b.astype(np.int64).T


def lift(norm2: np.ndarray, top: float) -> np.ndarray:
    return np.sqrt(np.maximum(top - norm2, 0))


def distances(x: np.ndarray, last: np.ndarray, pivots: np.ndarray, pivot_last: np.ndarray) -> np.ndarray:
    """Of rows to pivots, both with their last components."""
    return np.stack([np.sqrt(((x - p) ** 2).sum(axis=1) + (last - h) ** 2) for p, h in zip(pivots, pivot_last, strict=True)], axis=1) if len(x) else np.zeros((0, len(pivots)))


def far_apart(x: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """Numbers of rows, each the farthest from those before it."""
    chosen = [0]
    nearest = distances(x, last, x[:1], last[:1])[:, 0]
    while len(chosen) < n and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(x, last, x[chosen[-1:]], last[chosen[-1:]])[:, 0])
    return np.array(chosen)


def add_distances(batches: Iterable[pa.RecordBatch], pivots: np.ndarray, pivot_last: np.ndarray, top: float, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = matrix(batch.column("x"), pivots.shape[1])
        d = distances(x, lift(np.asarray(batch.column("norm2")), top), pivots, pivot_last)
        near = d.argmin(axis=1)
        arrays = [*batch.columns, pa.array(list(d), pa.list_(pa.float64())), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near])]
        yield pa.RecordBatch.from_arrays([a.cast(t) for a, t in zip(arrays, schema.types, strict=True)], schema=schema)


class Anchors:
    """A block of anchors: sorted by label, with their distances to the pivots, which as anchors (with a last component
    of 0) they have others of than as rows."""

    def __init__(self, rows: pa.Table, pivots: np.ndarray, pivot_last: np.ndarray):
        rows = rows.sort_by([("label", "ascending"), ("rid", "ascending")])
        self.rid, self.label, self.norm2 = (rows.column(c).to_numpy() for c in ("rid", "label", "norm2"))
        self.x = matrix(rows.column("x"), pivots.shape[1])
        self.d = distances(self.x, np.zeros(len(self.x)), pivots, pivot_last)


def brackets(anchors: Anchors, of: np.ndarray, d: np.ndarray, top: float) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest possible score of each of these anchors with each row of a tile."""
    near = np.zeros((len(of), len(d)))
    far = np.full((len(of), len(d)), np.inf)
    for j in range(d.shape[1]):
        a, x = anchors.d[of, j][:, None], d[:, j][None, :]
        np.maximum(near, np.abs(a - x), out=near)
        np.minimum(far, a + x, out=far)
    both = anchors.norm2[of][:, None] + top
    slack = SLACK * (both + top)
    return (both - far**2) / 2 - slack, (both - near**2) / 2 + slack


def tile_reach(anchors: Anchors, of: np.ndarray, d: np.ndarray, top: float) -> np.ndarray:
    """The highest possible score of each of these anchors with any row of a tile, from the tile's extreme distances."""
    gap = np.maximum(anchors.d[of] - d.max(axis=0), d.min(axis=0) - anchors.d[of]).max(axis=1)
    both = anchors.norm2[of] + top
    return (both - np.maximum(gap, 0) ** 2) / 2 + SLACK * (both + top)


class Best:
    """The best ``k`` rows of each place (an anchor, or one of its positives) that a task has met: score, then vec_id."""

    def __init__(self, places: int, k: int, least: np.ndarray):
        self.k, self.bound, self.held, self.n = k, least.astype(np.float64), [], 0

    def add(self, of: np.ndarray, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """of: the place of each line of scores; where not allowed, a score doesn't count."""
        masked = np.where(allowed, scores.astype(np.float64), -np.inf)
        if masked.shape[1] > self.k:
            kth = np.partition(masked, -self.k, axis=1)[:, -self.k]
            self.bound[of] = np.maximum(self.bound[of], kth)
        line, row = np.nonzero(allowed & (masked >= self.bound[of][:, None]))
        if len(line):
            self.held.append((of[line], ids[row], scores[line, row]))
            self.n += len(line)
            if self.n > 4 * self.k * len(self.bound) + 100_000:
                self.held = [self.rows()]
                self.n = len(self.held[0][0])

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.held:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        place, ids, score = (np.concatenate(c) for c in zip(*self.held, strict=True))
        order = np.lexsort((ids, -score, place))
        place, ids, score = place[order], ids[order], score[order]
        rank = np.arange(len(place)) - np.searchsorted(place, place)
        return place[rank < self.k], ids[rank < self.k], score[rank < self.k]


def tiles(batches: Iterable[pa.RecordBatch], dims: int, pivots: int) -> Iterator[tuple[np.ndarray, ...]]:
    """rid, vec_id, label, x, d of runs of at most ``TILE`` rows."""
    for batch in batches:
        for i in range(0, batch.num_rows, TILE):
            part = batch.slice(i, TILE)
            yield *(part.column(c).to_numpy() for c in ("rid", "vec_id", "label")), matrix(part.column("x"), dims), matrix(part.column("d"), pivots)


def found(anchors: Anchors, best: Best, slots: int) -> Iterator[pa.RecordBatch]:
    place, ids, score = best.rows()
    for i in range(0, len(place), 50_000):
        p = place[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(anchors.rid[p // slots]), pa.array((p % slots).astype(np.int32)), pa.array(ids[i : i + 50_000]), pa.array(score[i : i + 50_000])], schema=FOUND)


def search_same(batches: Iterable[pa.RecordBatch], anchors: Anchors, k: int, top: float) -> Iterator[pa.RecordBatch]:
    """The best k rows of each anchor's label that this task has, but for the anchor's own row."""
    best = Best(len(anchors.rid), k, np.full(len(anchors.rid), -np.inf))
    for rid, ids, label, x, d in tiles(batches, anchors.x.shape[1], anchors.d.shape[1]):
        for one in np.unique(label):
            rows = np.flatnonzero(label == one)
            mine = np.arange(*np.searchsorted(anchors.label, [one, one + 1]))
            for i in range(0, len(mine), TILE):
                of = mine[i : i + TILE]
                of = of[tile_reach(anchors, of, d[rows], top) >= best.bound[of]]
                if not len(of):
                    continue
                _, high = brackets(anchors, of, d[rows], top)
                open_ = (high >= best.bound[of][:, None]) & (anchors.rid[of][:, None] != rid[rows][None, :])
                of, left, open_ = _survivors(of, rows, open_)
                if len(of):
                    best.add(of, products(anchors.x[of], x[left], top), open_, ids[left])
    yield from found(anchors, best, 1)


def _survivors(of: np.ndarray, rows: np.ndarray, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Without the anchors and the rows that the brackets rule out altogether."""
    line, row = open_.any(axis=1), open_.any(axis=0)
    return of[line], rows[row], open_[np.ix_(line, row)]


def search_other(batches: Iterable[pa.RecordBatch], anchors: Anchors, low: np.ndarray, high: np.ndarray, k: int, top: float) -> Iterator[pa.RecordBatch]:
    """For each anchor and slot (a positive) the best k rows of other labels with low <= score <= high."""
    slots = low.shape[1]
    best = Best(low.size, k, low.ravel())
    least, most = low.min(axis=1), high.max(axis=1)
    for _, ids, label, x, d in tiles(batches, anchors.x.shape[1], anchors.d.shape[1]):
        rows = np.arange(len(ids))
        for i in range(0, len(anchors.rid), TILE):
            of = np.arange(i, min(i + TILE, len(anchors.rid)))
            wanted = np.maximum(least, best.bound.reshape(-1, slots).min(axis=1))
            of = of[(least[of] <= most[of]) & (tile_reach(anchors, of, d, top) >= wanted[of])]
            if not len(of):
                continue
            lower, upper = brackets(anchors, of, d, top)
            open_ = (upper >= wanted[of][:, None]) & (lower <= most[of][:, None]) & (anchors.label[of][:, None] != label[None, :])
            of, left, open_ = _survivors(of, rows, open_)
            if not len(of):
                continue
            score = products(anchors.x[of], x[left], top)
            for slot in range(slots):
                within = open_ & (score >= low[of, slot][:, None]) & (score <= high[of, slot][:, None])
                lines = np.flatnonzero(within.any(axis=1))
                best.add(of[lines] * slots + slot, score[lines], within[lines], ids[left])
    yield from found(anchors, best, slots)


def first(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first k rows of each group by score and vec_id, numbered from 1."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def ranges(positives: pa.Table, anchors: Anchors, slots: int, share: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor and positive the least and the greatest score of a negative; nothing lies in an empty slot."""
    low, high = np.full((len(anchors.rid), slots), np.iinfo(np.int64).max), np.full((len(anchors.rid), slots), np.iinfo(np.int64).min)
    order = np.argsort(anchors.rid)
    place = order[np.searchsorted(anchors.rid, positives.column("anchor").to_numpy(), sorter=order)]
    slot = positives.column("rank").to_numpy() - 1
    score = [int(s) for s in positives.column("score").to_pylist()]
    low[place, slot] = [-((-share[0] * s) // 100) for s in score]
    high[place, slot] = [share[1] * s // 100 for s in score]
    return low, high


def mine_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, share: tuple[int, int] = (50, 95), pivots: int = PIVOTS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and each of its first
    ``positives`` rows of the same label, the first ``negatives`` rows of other labels whose score is within these
    percentages of the positive's. vectors: vec_id, label, embedding; is_anchor is over vec_id and label."""
    spark = vectors.sparkSession
    with Scratch() as scratch:
        rows = scratch.written(whole(vectors).select(F.monotonically_increasing_id().alias("rid"), "*"), "whole-vectors")
        facts = rows.agg(F.max("norm2").alias("top"), F.max(F.size("x")).alias("dims"), F.count(F.when(is_anchor, 1)).alias("anchors")).first()
        out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        if not facts.anchors:
            return spark.createDataFrame([], out)
        top, dims = float(facts.top), int(facts.dims)
        sample = rows.orderBy(F.xxhash64("vec_id", "x"), "rid").limit(SAMPLE).toArrow()
        some, last = matrix(sample.column("x"), dims), lift(sample.column("norm2").to_numpy(), top)
        chosen = far_apart(some, last, pivots)
        pivot, pivot_last = some[chosen], last[chosen]
        names = "rid long, vec_id long, label int, x array<double>, norm2 double, d array<double>, near int, by double"
        schema = pa.schema([("rid", pa.int64()), ("vec_id", pa.int64()), ("label", pa.int32()), ("x", pa.list_(pa.float64())), ("norm2", pa.float64()), ("d", pa.list_(pa.float64())), ("near", pa.int32()), ("by", pa.float64())])
        held = rows.mapInArrow(lambda it: add_distances(it, pivot, pivot_last, top, schema), names).sortWithinPartitions("label", "near", "by")
        pivot_table = scratch.written(held, "pivot-table")
        blocks = max(1, -(-facts.anchors * 8 * (dims + len(chosen) + 4 + 2 * positives) // block_bytes))
        path = f"{shared_folder(spark)}/negatives-{uuid.uuid4().hex}"
        for block in range(blocks):
            asked = pivot_table.filter(is_anchor).filter(F.pmod(F.xxhash64("rid"), F.lit(blocks)) == block)
            anchors = Anchors(asked.toArrow(), pivot, pivot_last)
            if not len(anchors.rid):
                continue
            sent = spark.sparkContext.broadcast(anchors)
            search: Callable[..., DataFrame] = lambda f: pivot_table.mapInArrow(f, "anchor long, slot int, vec_id long, score long")
            same = scratch.written(first(search(lambda it: search_same(it, sent.value, positives, top)), ["anchor"], positives), "positives")
            low, high = ranges(same.select("anchor", "rank", "score").toArrow(), anchors, positives, share)
            limits = spark.sparkContext.broadcast((low, high))
            other = first(search(lambda it: search_other(it, sent.value, *limits.value, negatives, top)), ["anchor", "slot"], negatives)
            same = same.select("anchor", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
            whose = asked.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
            mined = other.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(same, ["anchor", "slot"]).join(whose, "anchor")
            mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").write.mode("append").parquet(path)
            sent.unpersist()
            limits.unpersist()
        return spark.read.schema(out).parquet(path)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"), "embedding")
    return mine_negatives(vectors, F.col("vec_id") % 50 == 0)


SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.rid AS a_rid, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score FROM v a JOIN v b ON a.rid <> b.rid WHERE a.vec_id % 50 = 0),
p AS (SELECT a_rid, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY a_rid ORDER BY score DESC, vec_id) AS slot FROM s WHERE same QUALIFY slot <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.a_rid, p.slot ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.a_rid = s.a_rid WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score QUALIFY rank <= 3)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n
"""
