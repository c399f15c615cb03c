"""Line dedup: documents probe a sharded minimal perfect hash instead of joining their lines.

A line's key is the line without white space at its ends, A-Z lower-cased. Lines of at least ``least_chars`` code
points are counted by a 64-bit hash of the key, with map-side combining, so a line in a third of all documents costs
no task more than its peers. Hashes that reach ``least_docs`` documents go, by shard, into a minimal perfect hash that
indexes three arrays: fingerprints (the 64-bit hash), counts, and the largest document id. Rarer lines decide
nothing, so they aren't indexed; a probe tells them by the fingerprint.

The shards are broadcast while their bytes stay under a checked bound. Beyond it the probes are dealt out by shard and
salt, a shard over as many tasks as the occurrences of its lines ask for, and each task loads one shard at a time.

Defined results: a null or empty text is one empty line; each row is a document of its own, so rows that repeat an id
count one by one and all of them keep the line if theirs is the largest id; rows with a null id keep all lines and
aren't counted; all lines that one document has of a key
stay or go together; a document that loses all lines has the empty text; other columns pass unchanged (but n_lines
and n_dropped, which are set here).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import dealt, forget, table, written
from .kernels import LOWER, SPACE, U64, signed, slices, span_hashes
from .perfect_hash import PerfectHash

SHARD_KEYS = 200_000
BROADCAST_BYTES = 64 << 20
KEY_BYTES = 25
#: Probes that a task of the dealt form takes, but for chance.
PROBES = 2_000_000


def line_keys(data: np.ndarray, at: np.ndarray, least_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each line, for each document (and one past the last) the number of its first line, the hash of
    each line's key and whether the key is long enough."""
    breaks = np.flatnonzero(data == 10)
    start = np.concatenate((at[:-1], breaks + 1))
    owner = np.concatenate((np.arange(len(at) - 1), np.searchsorted(at, breaks, side="right") - 1))
    order = np.lexsort((start, owner))
    start, owner = start[order], owner[order]
    end = _line_ends(start, owner, at)
    solid = np.flatnonzero(~SPACE[data])
    left, right = np.searchsorted(solid, start), np.searchsorted(solid, end)
    full = right > left
    key_start, key_end = start.copy(), start.copy()
    key_start[full], key_end[full] = solid[left[full]], solid[right[full] - 1] + 1
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return start, end, np.searchsorted(owner, np.arange(len(at))), span_hashes(LOWER[data], key_start, key_end), points[key_end] - points[key_start] >= least_chars


def _line_ends(start: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A line ends one byte before the next of its document, or with the document."""
    end = np.empty_like(start)
    end[:-1] = start[1:] - 1
    last = np.ones(len(start), dtype=bool)
    last[:-1] = owner[1:] != owner[:-1]
    end[last] = at[1:][owner[last]]
    return end


def count_lines(batches: Iterable[pa.RecordBatch], least_chars: int) -> Iterator[pa.RecordBatch]:
    """hash, doc_id: a row for each distinct long key of each document."""
    for batch, data, at in slices(batches):
        _, _, first, key, long_ = line_keys(data, at, least_chars)
        owner = np.repeat(np.arange(batch.num_rows), np.diff(first))[long_]
        key = key[long_]
        order = np.lexsort((key, owner))
        key, owner = key[order], owner[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
        if new.any():
            yield pa.RecordBatch.from_arrays([pa.array(signed(key[new])), batch.column("doc_id").cast(pa.int64()).take(pa.array(owner[new]))], names=["hash", "doc_id"])


def build_shard(rows: pa.Table) -> pa.Table:
    """One shard: the perfect hash and its arrays, as one row."""
    keys = rows.column("hash").to_numpy().view(U64)
    index = PerfectHash(keys)
    place = index(keys)
    arrays = [np.empty(index.size, t) for t in (U64, np.int64, np.int64)]
    arrays[0][place] = keys
    arrays[1][place] = rows.column("n_docs").to_numpy()
    arrays[2][place] = rows.column("top").to_numpy()
    counts = np.minimum(arrays[1], 2**32 - 1).astype(np.uint32)
    return pa.table({"shard": pa.array([rows.column("shard")[0].as_py()], pa.int32()), "index": pa.array([pickle.dumps((index, arrays[0], counts, arrays[2]))], pa.binary())})


def probe(shard: tuple, keys: np.ndarray) -> np.ndarray:
    """For each key the largest document id that holds it, where the key is in the shard; else the smallest long."""
    index, prints, _, top = shard
    place = index(keys)
    hit = place >= 0
    hit[hit] = prints[place[hit]] == keys[hit]
    out = np.full(len(keys), np.iinfo(np.int64).min)
    out[hit] = top[place[hit]]
    return out


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """As pmod(shiftright(hash, 8), shards) has it in SQL."""
    return np.mod(signed(keys) >> 8, shards)


def rewrite(batch: pa.RecordBatch, data: np.ndarray, lines: tuple, drop: np.ndarray) -> pa.RecordBatch:
    """The batch with the dropped lines gone, and the counts."""
    start, end, first = lines
    n_lines = np.diff(first)
    gone = np.concatenate(([0], np.cumsum(drop)))
    n_dropped = gone[first[1:]] - gone[first[:-1]]
    text = batch.column("text")
    if n_dropped.any():
        raw, new = data.tobytes(), text.to_pylist()
        for doc in np.flatnonzero(n_dropped):
            new[doc] = b"\n".join(raw[start[i] : end[i]] for i in range(first[doc], first[doc + 1]) if not drop[i]).decode()
        text = pa.array(new, text.type)
    put = {"text": text, "n_lines": pa.array(n_lines.astype(np.int64)), "n_dropped": pa.array(n_dropped.astype(np.int64))}
    names = [*batch.schema.names, *[k for k in ("n_lines", "n_dropped") if k not in batch.schema.names]]
    return pa.RecordBatch.from_arrays([put[c] if c in put else batch.column(c) for c in names], names=names)


def drop_by_probe(batches: Iterable[pa.RecordBatch], shards: list, least_chars: int) -> Iterator[pa.RecordBatch]:
    for batch, data, at in slices(batches):
        start, end, first, key, long_ = line_keys(data, at, least_chars)
        ids = np.repeat(np.asarray(batch.column("doc_id").cast(pa.int64()).fill_null(np.iinfo(np.int64).max)), np.diff(first))
        drop = np.zeros(len(start), dtype=bool)
        if shards:
            of = shard_of(key, len(shards))
            for s in np.unique(of[long_]):
                mine = np.flatnonzero(long_ & (of == s))
                top = probe(shards[s], key[mine])
                drop[mine] = top > ids[mine]
        yield rewrite(batch, data, (start, end, first), drop)


def drop_by_key(batches: Iterable[pa.RecordBatch], least_chars: int) -> Iterator[pa.RecordBatch]:
    """Batches that have in ``__drop`` the hashes of the keys to drop."""
    for batch, data, at in slices(batches):
        start, end, first, key, _ = line_keys(data, at, least_chars)
        drop = np.zeros(len(start), dtype=bool)
        for doc, found in enumerate(batch.column("__drop").to_pylist()):
            if found:
                mine = slice(first[doc], first[doc + 1])
                drop[mine] = np.isin(key[mine], np.array(found, np.int64).view(U64))
        yield rewrite(batch.drop_columns(["__drop"]), data, (start, end, first), drop)


def probe_dealt(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard and salt, the shard's index before its probes; keeps the probes that are to go."""
    held: tuple | None = None
    for batch in batches:
        index = batch.column("index")
        loads = np.flatnonzero(np.asarray(index.is_valid()))
        for begin, stop in zip([-1, *loads], [*loads, batch.num_rows], strict=True):
            if begin >= 0:
                held = pickle.loads(index[int(begin)].as_py())
            part = batch.slice(begin + 1, stop - begin - 1)
            if part.num_rows and held:
                keys, ids = (part.column(c).to_numpy() for c in ("hash", "doc_id"))
                keep = pa.array(probe(held, keys.view(U64)) > ids)
                yield part.select(["hash", "doc_id"]).filter(keep)


def dedup_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Documents without their repeated lines: all columns of docs, with text rewritten, and n_lines (before) and
    n_dropped. docs: doc_id, text and any others."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id IS NOT NULL")
    seen = rows.mapInArrow(lambda it: count_lines(it, least_chars), "hash long, doc_id long")
    counts = written(seen.groupBy("hash").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("top")).filter(F.col("n_docs") >= least_docs), "line-counts")
    n = counts.count()
    shards = max(1, -(-n // SHARD_KEYS))
    schema = T.StructType([f for f in docs.schema.fields if f.name not in ("n_lines", "n_dropped")] + [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    docs = docs.select(*[f"`{f.name}`" for f in schema.fields[:-2]])
    number = F.pmod(F.shiftright("hash", 8), F.lit(shards)).cast("int")
    keyed = counts.withColumn("shard", number)
    indexed = keyed.groupBy("shard").applyInArrow(build_shard, "shard int, index binary")
    if n * KEY_BYTES <= broadcast_bytes:
        found = {r.shard: pickle.loads(r["index"]) for r in indexed.collect()}
        empty = (PerfectHash(np.zeros(0, U64)), np.zeros(0, U64), np.zeros(0, np.uint32), np.zeros(0, np.int64))
        sent = spark.sparkContext.broadcast([found.get(s, empty) for s in range(shards)] if found else [])
        forget(counts)
        return docs.mapInArrow(lambda it: drop_by_probe(it, sent.value, least_chars), schema)
    loads = F.broadcast(keyed.groupBy("shard").agg((1 + F.floor(F.sum("n_docs") / PROBES)).cast("int").alias("salts")))  # a row for each shard
    salt = F.pmod(F.xxhash64("doc_id"), "salts").cast("int")
    probes = seen.withColumn("shard", number).join(loads, "shard").select("hash", "doc_id", "shard", salt.alias("salt"), F.lit(None).cast("binary").alias("index"))
    rows = indexed.join(loads, "shard").select(F.lit(0).cast("long").alias("hash"), F.lit(0).cast("long").alias("doc_id"), "shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "index").unionByName(probes)
    rows = rows.repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("index").isNull())
    gone = rows.mapInArrow(probe_dealt, "hash long, doc_id long").groupBy(F.col("doc_id").alias("__id")).agg(F.collect_set("hash").alias("__drop"))
    return docs.join(dealt(gone), docs.doc_id == gone["__id"], "left").drop("__id").mapInArrow(lambda it: drop_by_key(it, least_chars), schema)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (SELECT r, doc_id, generate_subscripts(a, 1) AS i, unnest(a) AS line FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 40 AND doc_id IS NOT NULL GROUP BY key HAVING count(DISTINCT r) >= 5),
j AS (SELECT k.r, k.doc_id, k.i, k.line, coalesce(c.key IS NOT NULL AND k.doc_id <> c.top, false) AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY r, doc_id
"""
