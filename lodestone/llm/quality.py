"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of ``PASSAGE`` words. A passage is encoded from shares of its bytes and words and from its
words and pairs of neighbours themselves: each is hashed into one of ``BUCKETS`` rows of a learnt projection, whose mean
over the passage joins the shares before a hidden layer. Gated attention (Ilse et al. 2018) learns from document labels
which passages tell, and the weighted mean of the encodings gives the score. So a document with one passage of junk can
be told, without passage labels.

Training reads all passages of at most ``most_docs`` labelled documents, those with the least hashed ids of the labels that
have a document; everything else covers all documents and whole texts. The model is some ten thousand numbers.

Defined results: a null or empty text is one empty passage and gets its score; repeated rows are scored one by one;
labels that repeat an id count once, with the least label; without labels, or with one label only, the score is the
smoothed share of label 1; labels with no document or a null id are ignored, and documents with a null id are scored;
other columns pass, but for score and predicted, which are set here.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import dealt, table
from .kernels import LOWER, U64, mix, slices, span_hashes, word_spans
from .packed import record_batch

PASSAGE = 40
BUCKETS, PROJECTED = 1 << 12, 16
MOST_DOCS = 4000
THRESHOLD = 0.3
HIDDEN, ATTENTION, EPOCHS, BATCH, RATE = 32, 16, 30, 256, 0.01

_BYTE = np.arange(256)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LOWER = (_BYTE >= 97) & (_BYTE <= 122)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_HIGH = _BYTE >= 128
_SIGN = (_BYTE > 32) & (_BYTE < 127) & ~_UPPER & ~_LOWER & ~_DIGIT
#: Classes of bytes that are counted by passage.
CLASSES = [_UPPER, _LOWER, _DIGIT, _HIGH, _SIGN, *[_BYTE == ord(c) for c in "!?.,|:;-_/"], np.isin(_BYTE, [ord(c) for c in "#$%&*@~^+=<>"]), np.isin(_BYTE, [ord(c) for c in "()[]{}\"'"])]
N_FEATURES = len(CLASSES) + 11


@dataclass
class Bags:
    """Passages of some documents: a row of shares for each, for each document (and one past the last) the number of its
    first passage, for each passage (and one past the last) the number of its first word, and for each word the rows of
    the projection that it and its pair with the next word of its passage have (the last word's pair is row BUCKETS)."""

    shares: np.ndarray
    bounds: np.ndarray
    first: np.ndarray
    rows: np.ndarray

    def document(self, i: int) -> Bags:
        p, q = self.bounds[i], self.bounds[i + 1]
        return Bags(self.shares[p:q], np.array([0, q - p]), self.first[p : q + 1] - self.first[p], self.rows[self.first[p] : self.first[q]])

    @staticmethod
    def of(bags: list[Bags]) -> Bags:
        sizes = [b.first[-1] for b in bags]
        first = [b.first[:-1] + n for b, n in zip(bags, np.cumsum([0, *sizes[:-1]]), strict=True)]
        return Bags(np.concatenate([b.shares for b in bags]), np.concatenate(([0], np.cumsum([len(b.shares) for b in bags]))), np.concatenate([*first, [sum(sizes)]]), np.concatenate([b.rows for b in bags]))


def features(data: np.ndarray, at: np.ndarray) -> Bags:
    """The passages of all documents of a slice. A document without words has one passage without words, of zeros."""
    start, end, first = word_spans(data, at)
    n_words = np.diff(first)
    n_passages = np.maximum(1, -(-n_words // PASSAGE))
    bounds = np.concatenate(([0], np.cumsum(n_passages)))
    out = np.zeros((bounds[-1], N_FEATURES), np.float32)
    if not len(start):
        return Bags(out, bounds, np.zeros(len(out) + 1, np.int64), np.zeros((0, 2), np.uint16))
    doc = np.repeat(np.arange(len(n_words)), n_words)
    passage = bounds[doc] + (np.arange(len(start)) - first[doc]) // PASSAGE
    head = np.flatnonzero(np.concatenate(([True], np.diff(passage) != 0)))
    filled = passage[head]
    length = (end - start).astype(np.float64)
    per = lambda x: np.add.reduceat(x, head)
    n, size = per(np.ones(len(start))), per(length)
    columns = []
    upper = None
    for kind in CLASSES:
        sums = np.concatenate(([0], np.cumsum(kind[data], dtype=np.int64)))
        count = (sums[end] - sums[start]).astype(np.float64)
        upper = count if upper is None else upper
        columns.append(per(count) / size)
    words = span_hashes(LOWER[data], start, end)
    same = np.zeros(len(words))
    same[1:] = (words[1:] == words[:-1]) & (passage[1:] == passage[:-1])
    order = np.lexsort((words, passage))
    new = np.concatenate(([True], (np.diff(words[order]) != 0) | (np.diff(passage[order]) != 0)))
    kinds = np.flatnonzero(new)
    times = np.diff(np.concatenate((kinds, [len(order)]))).astype(np.float64)
    most = np.zeros(bounds[-1])
    np.maximum.at(most, passage[order][kinds], times)
    distinct = np.bincount(passage[order][kinds], minlength=bounds[-1])[filled]
    breaks = np.concatenate(([0], np.cumsum(data == 10)))
    line = np.zeros(len(start))
    line[1:] = np.where(doc[1:] == doc[:-1], breaks[start[1:]] - breaks[end[:-1]], 0)
    final = _SIGN[data[end - 1]].astype(np.float64)
    mean = size / n
    columns += [np.log1p(n), mean, np.sqrt(np.maximum(per(length**2) / n - mean**2, 0)), per((upper >= length / 2).astype(np.float64)) / n, per(_UPPER[data[start]].astype(np.float64)) / n, per(same) / n, distinct / n, most[filled] / n, per(line) / n, per(final) / n, per((length <= 3).astype(np.float64)) / n]
    out[filled] = np.stack(columns, axis=1)
    rows = np.full((len(words), 2), BUCKETS, np.uint16)
    rows[:, 0] = words % U64(BUCKETS)
    inner = np.flatnonzero(passage[1:] == passage[:-1])
    rows[inner, 1] = U64(BUCKETS + 1) + mix(words[inner] * U64(3) + words[inner + 1]) % U64(BUCKETS)
    return Bags(out, bounds, np.append(np.searchsorted(passage, np.arange(len(out))), len(words)), rows)


def bag_sums(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, bounds[:-1], axis=0)


@dataclass
class Model:
    """Weights by name; ``constant`` alone where there was nothing to learn."""

    constant: float | None = None
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: dict[str, np.ndarray] | None = None

    def encoded(self, bags: Bags) -> np.ndarray:
        """The input of the hidden layer: scaled shares, and the mean of the projection over each passage's words."""
        projection = self.weights["E"]
        means = np.zeros((len(bags.shares), projection.shape[1]))
        some = np.flatnonzero(np.diff(bags.first))
        if len(some):
            sums = np.add.reduceat(projection[bags.rows[:, 0]] + projection[bags.rows[:, 1]], bags.first[some], axis=0)
            means[some] = sums / np.diff(bags.first)[some, None]
        return np.concatenate(((bags.shares - self.mean) / self.scale, means), axis=1)

    def forward(self, bags: Bags) -> tuple:
        w, bounds, x = self.weights, bags.bounds, self.encoded(bags)
        h = np.tanh(x @ w["W"] + w["b"])
        t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        e = (t * g) @ w["w"]
        sizes = np.diff(bounds)
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, bounds[:-1]), sizes))
        a = e / np.repeat(bag_sums(e, bounds), sizes)
        z = bag_sums(a[:, None] * h, bounds)
        return x, h, t, g, a, z, 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["d"], -30, 30)))

    def scores(self, bags: Bags) -> np.ndarray:
        """Of all documents, rounded, so that equal texts have equal scores whatever else is in their slice."""
        if self.constant is not None:
            return np.full(len(bags.bounds) - 1, self.constant)
        return np.round(self.forward(bags)[-1], 9)

    def gradients(self, bags: Bags, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss."""
        w, bounds, sizes = self.weights, bags.bounds, np.diff(bags.bounds)
        x, h, t, g, a, z, p = self.forward(bags)
        dl = (p - y) / len(y)
        dz = np.repeat(dl[:, None] * w["c"], sizes, axis=0)
        da = (h * dz).sum(axis=1)
        de = a * (da - np.repeat(bag_sums(a * da, bounds), sizes))
        dq = de[:, None] * w["w"]
        dt, dg = dq * g * (1 - t**2), dq * t * g * (1 - g)
        dh = (a[:, None] * dz + dt @ w["V"].T + dg @ w["U"].T) * (1 - h**2)
        n = np.diff(bags.first)
        dm = (dh @ w["W"].T)[:, N_FEATURES:] / np.maximum(n, 1)[:, None]
        each = np.repeat(dm, n, axis=0)
        rows = bags.rows.astype(np.int64)
        projection = np.stack([np.bincount(rows[:, 0], each[:, k], len(w["E"])) + np.bincount(rows[:, 1], each[:, k], len(w["E"])) for k in range(each.shape[1])], axis=1)
        return {"c": z.T @ dl, "d": dl.sum(keepdims=True), "w": (t * g).T @ de, "V": h.T @ dt, "U": h.T @ dg, "W": x.T @ dh, "b": dh.sum(axis=0), "E": projection}


def train(bags: list[Bags], labels: np.ndarray, seed: int = 7) -> Model:
    """Fits by Adam, in a fixed order of examples, with a small penalty on weights."""
    if not len(bags) or len(np.unique(labels)) < 2:
        return Model(constant=float((labels.sum() + 1) / (len(labels) + 2)))
    every = np.concatenate([b.shares for b in bags]).astype(np.float64)
    mean, scale = every.mean(axis=0), every.std(axis=0) + 1e-3
    rng = np.random.default_rng(seed)
    shapes = {"W": (N_FEATURES + PROJECTED, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION), "w": (ATTENTION,), "c": (HIDDEN,), "d": (1,), "E": (2 * BUCKETS + 1, PROJECTED)}
    model = Model(mean=mean, scale=scale, weights={k: rng.normal(0, 0.3 / np.sqrt(s[0]) * (k not in "bd") + 0.0, s) for k, s in shapes.items()})
    m, v, step = {k: np.zeros(s) for k, s in shapes.items()}, {k: np.zeros(s) for k, s in shapes.items()}, 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), BATCH):
            mine = order[i : i + BATCH]
            step += 1
            rate = RATE * (1 - epoch / EPOCHS) + 1e-4
            for k, grad in model.gradients(Bags.of([bags[j] for j in mine]), labels[mine]).items():
                grad = grad + 1e-4 * model.weights[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * grad, 0.999 * v[k] + 0.001 * grad**2
                model.weights[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return model


def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, at in slices(batches):
        bags = features(data, at)
        out = []
        for i, (doc, label) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("quality").to_pylist(), strict=True)):
            one = bags.document(i)
            out.append((doc, label, one.shares.tobytes(), one.first.astype(np.int64).tobytes(), one.rows.tobytes()))
        yield record_batch(out, ["doc_id", "quality", "shares", "first", "rows"], [pa.int64(), pa.int32(), *[pa.binary()] * 3])


def held_out(id_column: str) -> F.Column:
    """Rows that no label is learnt from."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, most_docs: int = MOST_DOCS) -> Model:
    """docs: doc_id, text. labels: doc_id, quality. The number of labelled rows is bounded, so it may be broadcast and collected."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out("doc_id")).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    met = known.join(dealt(given.select("doc_id").filter("doc_id IS NOT NULL").distinct()), "doc_id")
    sample = met.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_docs)
    rows = given.join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "text").mapInArrow(encode, "doc_id long, quality int, shares binary, first binary, rows binary")
    kept = sorted((r["doc_id"], r["quality"], r["least"]) for r in rows.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min(F.struct("shares", "first", "rows")).alias("least")).collect())
    bags = [Bags(np.frombuffer(x, np.float32).reshape(-1, N_FEATURES), np.array([0, len(x) // (4 * N_FEATURES)]), np.frombuffer(y, np.int64), np.frombuffer(z, np.uint16).reshape(-1, 2)) for _, _, (x, y, z) in kept]
    return train(bags, np.array([q for _, q, _ in kept], np.float64))


def score(batches: Iterable[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch, data, at in slices(batches):
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(features(data, at)))], names=[*batch.schema.names, "score"])


def score_quality(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of docs, with score (double, 0 to 1) and predicted (int); docs' own columns of these names go."""
    docs = docs.drop("score", "predicted")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(lambda it: score(it, model), schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


SQL = None
