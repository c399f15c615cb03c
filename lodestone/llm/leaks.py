"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact verification.

Items and texts are lower-cased (A-Z) and split at white space; their shingles are of ``SHINGLE`` words. A document's
windows that have as many words as an item are compared with it by weighted-shingle similarity: the sum of the lesser
of both multiplicities of each shingle over the sum of the greater. A window at or over the threshold is a leak.

1. Windows around an item's rarest shingles are fingerprinted; an item over the threshold has one of them at least in
   its window. Fingerprints of 64 bits are searched in a multi-index of ``BLOCKS`` blocks, each a table of buckets by the
   block's value: two within ``RADIUS`` = BLOCKS - 1 bits are equal in a block, so the lookups find all within the
   radius, and an item's nearest window is verified exactly. Verbatim windows are at distance 0, so they are found here.
2. At the threshold the expected distance is 10 bits, beyond what blocks of a useful width guarantee. So the items that
   share a rarest shingle with a document and have no verbatim window in it are compared with all its windows exactly:
   each occurrence of an item's shingle counts for an interval of windows, and a sweep over the intervals' ends gives
   the greatest overlap, in time that follows the number of occurrences. Nothing over the threshold is missed.

Items are sent to the tasks in parts of ``ITEMS`` at most, one pass over the documents for each, so what is broadcast
is bounded whatever the benchmark's size.

An item of fewer than SHINGLE words is one shingle of its own length, so it has similarity 1 with the runs of the same
words and 0 with all others; these are looked up by hash, by one more pass of shingles for each such length.

Defined results: null and empty texts and items match nothing; a short item leaks wherever its words stand, however
common they are; a document of fewer than SHINGLE words is one shingle; a document shorter than the item is one window;
repeated documents are told one by one, and so are those with a null id; repeated items are told by their own ids, null
too; of equally similar windows the first counts; other columns pass, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .kernels import U64, hashed_words, shingle_hashes, slices
from .packed import record_batch

SHINGLE, THRESHOLD = 5, 0.8
BITS, BLOCKS = 64, 8
RADIUS = BLOCKS - 1
#: Candidates of the multi-index that are compared at a time.
PAIRS = 1 << 20
ITEMS = 20_000
_FILTER_BITS = 20


def fingerprints(shingles: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the windows of ``size`` shingles at the starts: each bit by the majority of its shingles."""
    low = int(starts.min())
    part = shingles[low : int(starts.max()) + size]
    signs = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1
    sums = np.zeros((len(part) + 1, BITS), np.int32)
    np.cumsum(signs, axis=0, out=sums[1:])
    at = starts - low
    return np.packbits(sums[at + size] > sums[at], axis=1, bitorder="little").view(U64).ravel()


class MultiIndex:
    """Finds all of a set of fingerprints within RADIUS bits of a query, by equal blocks of BITS // BLOCKS bits."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        values = prints.view(np.uint8).reshape(-1, BLOCKS)
        #: For each block the fingerprints by its value, and where each value's bucket begins.
        self.order = [np.argsort(values[:, b], kind="stable") for b in range(BLOCKS)]
        self.begin = [np.searchsorted(values[o, b], np.arange(257)) for b, o in enumerate(self.order)]

    def search(self, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of queries and fingerprints that are within the radius, each pair once, in parts of a bounded size."""
        values = queries.view(np.uint8).reshape(-1, BLOCKS)
        sizes = np.stack([np.diff(self.begin[b])[values[:, b]] for b in range(BLOCKS)], axis=1)
        running = np.cumsum(sizes.sum(axis=1))
        low = 0
        while low < len(queries):
            high = max(low + 1, int(np.searchsorted(running, (running[low - 1] if low else 0) + PAIRS, side="right")))
            found = []
            for b in range(BLOCKS):
                n = sizes[low:high, b]
                at = np.repeat(self.begin[b][values[low:high, b]] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                found.append(np.repeat(np.arange(low, high), n) * len(self.prints) + self.order[b][at])
            pairs = np.unique(np.concatenate(found))
            q, f = pairs // len(self.prints), pairs % len(self.prints)
            close = np.bitwise_count(queries[q] ^ self.prints[f]) <= RADIUS
            yield q[close], f[close]
            low = high


def similarity(both: np.ndarray | int, n: int, m: int) -> np.ndarray | float:
    """Of two multisets of n and m shingles that share so many."""
    return both / (n + m - both)


class Item:
    """The shingles of an item: distinct ones, ascending, with their multiplicities."""

    def __init__(self, number: int | None, shingles: np.ndarray):
        self.number, self.size = number, len(shingles)
        self.kinds, self.times = np.unique(shingles, return_counts=True)

    def overlap(self, window: np.ndarray) -> int:
        kinds, times = np.unique(window, return_counts=True)
        at = np.minimum(np.searchsorted(kinds, self.kinds), len(kinds) - 1)
        return int(np.minimum(times[at], self.times)[kinds[at] == self.kinds].sum())

    def best(self, order: np.ndarray, ordered: np.ndarray, width: int) -> tuple[int, int]:
        """The greatest overlap with a window of ``width`` shingles, and the first window that has it. An occurrence
        counts for the windows that hold it and, before it, fewer of its kind than the item has."""
        left, right = np.searchsorted(ordered, self.kinds, side="left"), np.searchsorted(ordered, self.kinds, side="right")
        n = right - left
        if not n.any():
            return 0, 0
        entry = np.repeat(left - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        place, times, first = order[entry], np.repeat(self.times, n), np.repeat(left, n)
        before = entry - times
        low = np.maximum(np.where(before >= first, order[np.maximum(before, 0)] + 1, 0), np.maximum(place - width + 1, 0))
        high = np.minimum(place, len(order) - width) + 1
        some = low < high
        at = np.concatenate((low[some], high[some]))
        if not len(at):
            return 0, 0
        by = np.argsort(at, kind="stable")
        steps = np.concatenate((np.ones(some.sum(), np.int64), np.full(some.sum(), -1)))[by]
        at, total = at[by], np.cumsum(steps)
        last = np.append(at[1:] != at[:-1], True)  # the sum at a place holds after all steps there
        total, at = total[last], at[last]
        top = int(np.argmax(total))
        return int(total[top]), int(at[top])


class Items:
    """Benchmark items, by their number of words, with a multi-index for each, and by their rarest shingles."""

    def __init__(self, rows: list[tuple[int, str | None]], threshold: float = THRESHOLD):
        self.threshold = threshold
        column = pa.array([t for _, t in rows], pa.string())
        #: By number of words, the items of fewer words than a shingle: sorted hashes and the items of each.
        self.short: dict[int, tuple[np.ndarray, list[int]]] = {}
        found: list[tuple[int, int, np.ndarray]] = []
        short: dict[int, list[tuple[int, int]]] = {}
        for batch, data, at in slices([pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), column], names=["item_id", "text"])]):
            words, _, _, first = hashed_words(data, at)
            shingles, bounds = shingle_hashes(words, first, SHINGLE)
            for i, item in enumerate(batch.column("item_id").to_pylist()):
                size = int(first[i + 1] - first[i])
                if size >= SHINGLE:
                    found.append((size, item, shingles[bounds[i] : bounds[i + 1]]))
                elif size:
                    short.setdefault(size, []).append((int(shingle_hashes(words[first[i] : first[i + 1]], np.array([0, size]), size)[0][0]), item))
        for size, pairs in sorted(short.items()):
            pairs.sort(key=lambda x: x[0])
            self.short[size] = (np.array([h for h, _ in pairs], U64), [i for _, i in pairs])
        found.sort(key=lambda x: x[0])
        #: Items by number of words, and of each such group its first item and its multi-index.
        self.items = [Item(number, s) for _, number, s in found]
        self.sizes = np.array([size for size, _, _ in found], np.int64)
        self.groups: dict[int, tuple[int, MultiIndex]] = {}
        for size in np.unique(self.sizes):
            i, j = np.searchsorted(self.sizes, (size, size + 1))
            self.groups[int(size)] = int(i), MultiIndex(np.concatenate([fingerprints(s, np.zeros(1, np.int64), len(s)) for _, _, s in found[i:j]]))
        self._rarest()

    def _rarest(self) -> None:
        """Of each item so many shingles, in the order of how many items have them, that a multiset over the threshold
        shares one: it shares threshold * size of them at least."""
        all_ = np.concatenate([x.kinds for x in self.items]) if self.items else np.zeros(0, U64)
        kinds, common = np.unique(all_, return_counts=True)
        keys, owners = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
        for i, item in enumerate(self.items):
            order = np.argsort(common[np.searchsorted(kinds, item.kinds)], kind="stable")
            spare = item.size - int(np.ceil(self.threshold * item.size - 1e-9))
            held = np.cumsum(item.times[order])
            mine = item.kinds[order][: int(np.searchsorted(held, spare, side="right")) + 1]
            keys.append(mine)
            owners.append(np.full(len(mine), i))
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], owners[order]
        self.filter = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.filter[(self.keys >> U64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def hits(self, shingles: np.ndarray) -> np.ndarray:
        """Places of shingles that are among some item's rarest."""
        place = np.flatnonzero(self.filter[(shingles >> U64(64 - _FILTER_BITS)).astype(np.int64)])
        if not len(self.keys) or not len(place):
            return place[:0]
        at = np.minimum(np.searchsorted(self.keys, shingles[place]), len(self.keys) - 1)
        return place[self.keys[at] == shingles[place]]

    def short_leaks(self, words: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, tuple[int, float, int, int]]]:
        """Document, and item_id, similarity, first word and number of words, of the first run of words that is a short
        item."""
        for size, (keys, ids) in self.short.items():
            shingles, bounds = shingle_hashes(words, first, size)
            place = np.flatnonzero(np.isin(shingles, keys))
            doc = np.searchsorted(bounds, place, side="right") - 1
            order = np.lexsort((place, shingles[place], doc))
            place, doc = place[order], doc[order]
            new = np.ones(len(place), dtype=bool)
            new[1:] = (shingles[place[1:]] != shingles[place[:-1]]) | (doc[1:] != doc[:-1])
            place, doc = place[new], doc[new]
            left, right = (np.searchsorted(keys, shingles[place], side=s) for s in ("left", "right"))
            for d, at, i, j in zip(doc.tolist(), (place - bounds[doc]).tolist(), left.tolist(), right.tolist(), strict=True):
                for k in range(i, j):
                    yield d, (ids[k], 1.0, at, size)

    def leaks(self, shingles: np.ndarray, n_words: int, place: np.ndarray) -> list[tuple[int, float, int, int]]:
        """item_id, similarity, first word and number of words of each item's best window in one document; ``place`` are
        the hits in it."""
        kinds = np.unique(shingles[place])
        left, right = np.searchsorted(self.keys, kinds, side="left"), np.searchsorted(self.keys, kinds, side="right")
        near = np.unique(np.concatenate([self.owners[i:j] for i, j in zip(left, right, strict=True)]))
        best: dict[int, tuple[float, int, int]] = {}
        for size in np.unique(self.sizes[near]):
            words = min(int(size), n_words)
            width = max(1, words - SHINGLE + 1)
            lead, index = self.groups[int(size)]
            if width < self.threshold * self.items[lead].size - 1e-9:
                continue  # the text is too short for items of this size
            self._verified(shingles, place, width, words, lead, index, best)
        order = np.argsort(shingles, kind="stable")
        ordered = shingles[order]
        for i in near.tolist():
            item, words = self.items[i], min(int(self.sizes[i]), n_words)
            width = max(1, words - SHINGLE + 1)
            if width < self.threshold * item.size - 1e-9 or best.get(i, (0.0,))[0] == 1.0:
                continue
            both, at = item.best(order, ordered, width)
            s = similarity(both, width, item.size)
            if s >= self.threshold:
                best[i] = (s, at, words)
        return [(self.items[i].number, *x) for i, x in best.items()]

    def _verified(self, shingles: np.ndarray, place: np.ndarray, width: int, words: int, lead: int, index: MultiIndex, best: dict) -> None:
        """Puts into ``best`` the items of one size of which the window with the nearest fingerprint, the first of such
        ones, is over the threshold."""
        touched = np.zeros(len(shingles) + 1, np.int64)
        np.add.at(touched, np.maximum(place - width + 1, 0), 1)
        np.add.at(touched, place + 1, -1)
        starts = np.flatnonzero(np.cumsum(touched[:-1])[: len(shingles) - width + 1])
        if not len(starts):
            return
        prints = fingerprints(shingles, starts, width)
        nearest = np.full(len(index.prints), np.iinfo(np.int64).max)
        for q, f in index.search(prints):
            np.minimum.at(nearest, f, np.bitwise_count(prints[q] ^ index.prints[f]).astype(np.int64) * len(starts) + q)
        for f in np.flatnonzero(nearest < np.iinfo(np.int64).max).tolist():
            item, at = self.items[lead + f], int(starts[nearest[f] % len(starts)])
            s = similarity(item.overlap(shingles[at : at + width]), width, item.size)
            if s >= self.threshold:
                best[lead + f] = (s, at, words)


def _found(batches: Iterable[pa.RecordBatch], items: Items) -> Iterator[tuple[pa.RecordBatch, dict[int, list]]]:
    """Each slice with the leaks of its documents."""
    for batch, data, at in slices(batches):
        words, _, _, first = hashed_words(data, at)
        shingles, bounds = shingle_hashes(words, first, SHINGLE)
        place = items.hits(shingles)
        cuts = np.searchsorted(place, bounds)
        out: dict[int, list] = {}
        for i in np.flatnonzero(np.diff(cuts)):
            if leaks := items.leaks(shingles[bounds[i] : bounds[i + 1]], int(first[i + 1] - first[i]), place[cuts[i] : cuts[i + 1]] - bounds[i]):
                out[int(i)] = leaks
        for i, leak in items.short_leaks(words, first) if items.threshold <= 1 else ():
            out.setdefault(i, []).append(leak)
        yield batch, out


def _parts(benchmark: DataFrame, threshold: float) -> Iterator[Callable[[], Items]]:
    """The items, in parts of a bounded size; built once in each worker."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).toLocalIterator()
    part: list[tuple] = []
    for row in rows:
        part.append((row["item_id"], row["text"]))
        if len(part) == ITEMS:
            yield _sent(spark, part, threshold)
            part = []
    if part:
        yield _sent(spark, part, threshold)


def _sent(spark: SparkSession, part: list[tuple], threshold: float) -> Callable[[], Items]:
    sent = spark.sparkContext.broadcast(sorted(part, key=lambda r: (r[0] is None, r[0])))
    return lambda: Items(sent.value, threshold)


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, similarity, first_word, n_words: each document's best window for each item that it leaks."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    result = "doc_id long, item_id long, similarity double, first_word long, n_words long"
    out = given.sparkSession.createDataFrame([], result)
    for part in _parts(benchmark, threshold):

        def run(batches: Iterable[pa.RecordBatch], part: Callable[[], Items] = part) -> Iterator[pa.RecordBatch]:
            for batch, found in _found(batches, part()):
                rows = [(batch.column("doc_id")[i].as_py(), *leak) for i, leaks in found.items() for leak in leaks]
                yield record_batch(rows, [x.split()[0] for x in result.split(", ")], [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()])

        out = out.unionByName(given.mapInArrow(run, result))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that leak no item, with all their columns."""
    for part in _parts(benchmark, threshold):

        def run(batches: Iterable[pa.RecordBatch], part: Callable[[], Items] = part) -> Iterator[pa.RecordBatch]:
            for batch, found in _found(batches, part()):
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[list(found)] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = None


def brute_force(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]], threshold: float = THRESHOLD) -> set[tuple[int, int, float, int, int]]:
    """What the operator computes, by comparing every window with every item, for tests."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def split(text: str | None) -> list[str]:
        return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))

    def shingles(words: list[str], n: int) -> list[tuple]:
        return [tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []

    out = set()
    for doc, text in docs:
        words = split(text)
        for item, other in items:
            asked = split(other)
            if not words or not asked:
                continue
            size, n = min(len(asked), len(words)), min(len(asked), SHINGLE)
            target, best, pieces = Counter(shingles(asked, n)), (0.0, 0), shingles(words, n)
            for i in range(len(words) - size + 1):
                window = Counter(pieces[i : i + max(1, size - n + 1)])
                both = sum((window & target).values())
                s = similarity(both, sum(window.values()), sum(target.values()))
                if s > best[0]:
                    best = (s, i)
            if best[0] >= threshold:
                out.add((doc, item, best[0], best[1], size))
    return out
