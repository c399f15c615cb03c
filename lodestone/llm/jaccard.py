"""Exact n-gram Jaccard join: size-banded tiles, bitmap bounds, sorted-array intersection.

A document's set holds the 64-bit hashes of its distinct word shingles. Documents with equal sets form a class; all
further work is on classes, so copies are never paired.

Candidates. Two sets of sizes n and m with a Jaccard of at least t share ``k`` of the ``n - ceil(t n) + k`` and
``m - ceil(t m) + k`` least hashes of each (the prefix filter, exact for any k). k is 1 + n // 20, so documents that
share a line or a passage only are seldom candidates. Prefix hashes are exchanged once, packed in buckets by hash; a
bucket keeps the hashes that two classes share, and a class with fewer of them than its size asks for is done; a bucket
that a common shingle has made large is counted as rows instead, with map-side combining and its hot keys dealt out. Of
the others each drops the k - 1 hashes that most classes have; two that link still share one.

Tiles. Classes that the kept hashes connect form a family, found by stars from each hash's least class. As a corpus grows,
chance connects families, and one of them comes to hold most classes. A crowded family is therefore joined anew, by
those pairs alone that share a kept hash and whose sketches (parities of 512 cells, which differ in no more cells than
the sets differ in elements) allow a link; what nothing joins is done. A family is one tile; one that is crowded still
is cut by size band, where each class meets its own band and the next, and a crowded band by a grid of blocks, as many
as its own classes and guests ask for. Each class goes to its tile with its sorted array, once for a small family.

Within a tile classes are sorted by size, and each is compared with those in its size range only, unless already
linked to it. A hashed bitmap bounds the overlap from above: a bit set in one and not in the other is an element that
they don't share. Only pairs that pass the bound are intersected exactly. Found components leave the tile as stars
around their least class, never as pairs; connected components of all stars are the result. Where links are counted,
all pairs that pass the bound are intersected, and each class leaves its tile with the number of documents that it is
linked to there; every pair of classes meets in one tile only, so the sums are exact.

Defined results: null and empty texts have n_shingles 0 and link with nothing; each row is a document, so rows that
repeat an id are all returned and share what their texts link to; a row with a null id is in the class of its text and
links with nothing else, so a class of null ids only has null as its component; an id with several texts may be the
least of several components, and ``link_key`` tells these apart; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, dealt, forget, input_bytes, table
from .components import components, hubs, salted_join
from .kernels import U64, hashed_words, mix, shingle_hashes, signed, slices
from .packed import unpack

BUCKET_BYTES = 8 << 20
CROWDED = 1024
#: Hashes of a bucket that is counted as rows.
HOT_BUCKET = 4 << 20
SEATS = "array<struct<band: int, own: boolean, side: int>>"
#: Cells of a sketch.
CELLS = 512
#: Rows of sketches that one call compares, if no key has more.
SKETCHES = 1 << 14

SIGNATURES = "doc_id long, text_hash long, n long, s1 long, s2 long, sketch binary, bucket int, keys binary, classes binary, counts binary"


def asked(n: int) -> int:
    """How many prefix hashes two sets of this size share at least, if they link; never falls with n."""
    return 1 + n // 20


def prefix(n: int, percent: int) -> int:
    return min(n, n - -(-percent * n // 100) + asked(n))


def sets(data: np.ndarray, at: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document."""
    words, _, _, first = hashed_words(data, at)
    hashes, bounds = shingle_hashes(words, first, size)
    for i in range(len(at) - 1):
        yield np.unique(hashes[bounds[i] : bounds[i + 1]])


def digest(elements: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two longs."""
    if not len(elements):
        return 0, 0
    s = mix(mix(elements).sum(dtype=U64, keepdims=True) + U64(len(elements)))
    x = mix(mix(elements ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=U64, keepdims=True))
    return int(signed(s)[0]), int(signed(x)[0])


def sketch(elements: np.ndarray) -> bytes:
    """Of each cell of hashes, whether the set has an odd number of them."""
    return np.packbits(np.bincount((elements & U64(CELLS - 1)).astype(np.int64), minlength=CELLS) & 1).tobytes()


def signatures(batches: Iterable[pa.RecordBatch], size: int, percent: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """A row for each document, and packed rows of prefix hashes (6 bytes each) with their classes, one for each
    bucket. Of equal sets in a slice one is sent."""
    types = [pa.int64()] * 5 + [pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    names = [x.split()[0] for x in SIGNATURES.split(", ")]
    for batch, data, at in slices(batches):
        n, s1, s2, sketches, keys, owner = [], [], [], [], [], []
        known: set[int] = set()
        for elements in sets(data, at, size):
            a, b = digest(elements)
            n.append(len(elements))
            s1.append(a)
            s2.append(b)
            sketches.append(sketch(elements))
            if len(elements) and a not in known:
                known.add(a)
                keys.append(elements[: prefix(len(elements), percent)])
                owner.append(a)
        none = pa.nulls(batch.num_rows, pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), *[pa.array(x, pa.int64()) for x in (n, s1, s2)], pa.array(sketches, pa.binary()), pa.nulls(batch.num_rows, pa.int32()), none, none, none], names=names)
        if not keys:
            continue
        key, cls = np.concatenate(keys), np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        owners = np.array(owner, np.int64)
        of = (key % U64(buckets)).astype(np.int32)
        order = np.argsort(of, kind="stable")
        key, cls, of = key[order], cls[order], of[order]
        short = np.ascontiguousarray(key.view(np.uint8).reshape(-1, 8)[:, 2:])
        new = np.flatnonzero(np.concatenate(([True], (np.diff(of) != 0) | (np.diff(cls) != 0))))
        counts = np.diff(np.concatenate((new, [len(key)]))).astype(np.uint32)
        cuts = [0, *(np.flatnonzero(np.diff(of[new])) + 1), len(new)]
        ends = [*new, len(key)]
        rows = [(int(of[new[i]]), short[ends[i] : ends[j]].tobytes(), owners[cls[new[i:j]]].tobytes(), counts[i:j].tobytes()) for i, j in zip(cuts, cuts[1:], strict=False)]
        empty = pa.nulls(len(rows), pa.int64())
        yield pa.RecordBatch.from_arrays([empty] * 5 + [pa.nulls(len(rows), pa.binary())] + [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types[6:], strict=True)], names=names)


def unpacked_keys(rows: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of packed rows, without their two lowest bytes, and the class of each."""
    wide = np.zeros((sum(x.as_buffer().size for x in rows.column("keys")) // 6, 8), np.uint8)
    wide[:, :6] = unpack(rows, "keys", np.uint8).reshape(-1, 6)
    return wide.view(np.int64).ravel(), np.repeat(unpack(rows, "classes", np.int64), unpack(rows, "counts", np.uint32))


def keys_as_rows(batches: Iterable[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            key, cls = unpacked_keys(batch.slice(i, 1))
            yield pa.RecordBatch.from_arrays([pa.array(key * buckets + batch.column("bucket")[i].as_py()), pa.array(cls)], names=["key", "c"])


def shared_keys(rows: pa.Table, buckets: int) -> pa.Table:
    """key, c, m: of one bucket, the hashes that m > 1 classes share, once for each class."""
    key, cls = unpacked_keys(rows)
    order = np.lexsort((cls, key))
    key, cls = key[order], cls[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
    key, cls = key[new], cls[new]
    begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    n = np.diff(np.concatenate((begin, [len(key)])))
    m = np.repeat(n, n)
    keep = m > 1
    return pa.table({"key": key[keep] * buckets + rows.column("bucket")[0].as_py(), "c": cls[keep], "m": m[keep].astype(np.int32)})


def bitmap(elements: np.ndarray) -> np.ndarray:
    """A hashed bitmap of a set, as 64-bit words: a power of two of bits, at least four for each element."""
    bits = max(256, 1 << math.ceil(math.log2(4 * max(1, len(elements)))))
    out = np.zeros(bits, dtype=bool)
    out[(elements & U64(bits - 1)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little").view(U64)


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    """The bitmap that the same set has with fewer bits."""
    return np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


class Tile:
    """Classes sorted by size, with bitmaps of one width for each band of sizes."""

    def __init__(self, n: np.ndarray, bits: list[np.ndarray], percent: int):
        self.n, self.percent = n, percent
        self.last = np.searchsorted(n, n * 100 // percent, side="right")
        self.bits, self.wide = bits, {}
        self.width = np.array([len(b) for b in bits])

    def bitmaps(self, words: int) -> np.ndarray:
        """All bitmaps of at least so many words, folded to it; shorter ones are left empty."""
        if words not in self.wide:
            self.wide[words] = np.stack([fold(b, words) if len(b) >= words else np.zeros(words, U64) for b in self.bits])
        return self.wide[words]

    def candidates(self, i: int, open_: np.ndarray) -> np.ndarray:
        """Of the classes after i in its size band those in ``open_`` that could overlap enough. The sizes ascend, and
        so do the widths, so each is compared at i's own width."""
        j = i + 1 + np.flatnonzero(open_[i + 1 : self.last[i]])
        if not len(j):
            return j
        all_ = self.bitmaps(int(self.width[i]))
        mine, theirs = all_[i], all_[j]
        only_i = np.bitwise_count(mine & ~theirs).sum(axis=1, dtype=np.int64)
        only_j = np.bitwise_count(theirs & ~mine).sum(axis=1, dtype=np.int64)
        most = np.minimum(self.n[i] - only_i, self.n[j] - only_j)
        return j[linked(most, self.n[i], self.n[j], self.percent)]


def linked(both: np.ndarray | int, n: np.ndarray | int, m: np.ndarray | int, percent: int) -> np.ndarray | bool:
    """100 * intersection >= percent * union, in integers."""
    return (100 + percent) * both >= percent * (n + m)


def joined_by_sketches(n: np.ndarray, bits: np.ndarray, percent: int) -> np.ndarray:
    """Of classes in ascending order of size, the components by pairs that sizes and sketches allow to link."""
    last, comp = np.searchsorted(n, n * 100 // percent, side="right"), np.arange(len(n))
    for i in range(len(n)):
        j = i + 1 + np.flatnonzero(comp[i + 1 : last[i]] != comp[i])
        if not len(j):
            continue
        apart = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64)
        j = j[linked((n[i] + n[j] - apart) // 2, n[i], n[j], percent)]
        if len(j):
            comp[np.isin(comp, comp[j])] = comp[i]
            if (comp == comp[i]).all():
                break
    return comp


def link_sketches(rows: pa.Table, percent: int) -> pa.Table:
    """a, b: of the classes of each key and band, stars of those that such pairs connect. Keys of two classes, which are
    most, are compared all at once."""
    rows = rows.sort_by([(x, "ascending") for x in ("key", "band", "n", "c")])
    key, band, c, n = (rows.column(x).to_numpy() for x in ("key", "band", "c", "n"))
    bits, comp = unpack(rows, "sketch", U64).reshape(len(c), -1), np.arange(len(c))
    begin = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (band[1:] != band[:-1]))))
    size = np.diff(np.concatenate((begin, [len(c)])))
    x = begin[size == 2]
    apart = np.bitwise_count(bits[x] ^ bits[x + 1]).sum(axis=1, dtype=np.int64)
    x = x[(n[x + 1] * percent <= n[x] * 100) & linked((n[x] + n[x + 1] - apart) // 2, n[x], n[x + 1], percent)]
    comp[x + 1] = x
    for i, k in zip(begin[size > 2], size[size > 2], strict=True):
        comp[i : i + k] = i + joined_by_sketches(n[i : i + k], bits[i : i + k], percent)
    least = np.full(len(c), np.iinfo(np.int64).max)
    np.minimum.at(least, comp, c)
    stars = np.unique(np.stack((c, least[comp]))[:, c != least[comp]], axis=1)
    return pa.table({"a": stars[0], "b": stars[1]})


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct elements."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def link_tile(rows: pa.Table, percent: int, count: bool = False) -> pa.Table:
    """a, b, links: the components of one tile or cell, as stars around their least class, and with ``count`` for each
    linked class a loop with the number of documents of other classes that link to it. ``own`` marks a band's own classes
    (guests from the band below aren't compared with each other); in a cell off the diagonal (``off``) only different
    blocks are compared."""
    rows = rows.sort_by([("n", "ascending"), ("c", "ascending")])
    c, own, block, off = (rows.column(x).to_numpy() for x in ("c", "own", "block", "off"))
    arrays = [np.frombuffer(x.as_buffer(), U64) for x in rows.column("elements")]
    tile = Tile(rows.column("n").to_numpy(), [bitmap(x) for x in arrays], percent)
    comp, copies, links = np.arange(len(c)), rows.column("copies").to_numpy(), np.zeros(len(c), np.int64)
    for i in range(len(c)):
        open_ = comp != comp[i] if not count else np.ones(len(c), dtype=bool)
        if not own[i]:
            open_ &= own
        if off[i]:
            open_ &= block != block[i]
        for j in tile.candidates(i, open_):
            if (count or comp[i] != comp[j]) and linked(overlap(arrays[i], arrays[j]), len(arrays[i]), len(arrays[j]), percent):
                links[i] += copies[j]
                links[j] += copies[i]
                if comp[i] != comp[j]:
                    comp[comp == comp[j]] = comp[i]
    least = np.full(len(c), np.iinfo(np.int64).max)
    np.minimum.at(least, comp, c)
    keep = c != least[comp]
    told = np.flatnonzero(links > 0) if count else np.zeros(0, np.int64)
    return pa.table({"a": np.concatenate((c[keep], c[told])), "b": np.concatenate((least[comp][keep], c[told])), "links": np.concatenate((np.zeros(keep.sum(), np.int64), links[told]))})


def full_sets(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Sorted arrays of the texts that are of the class that is asked for; of repeated rows, one."""
    seen: set[int] = set()
    for batch, data, at in slices(batches):
        rows, out = [], []
        for i, (c, elements) in enumerate(zip(batch.column("c").to_pylist(), sets(data, at, size), strict=True)):
            if c not in seen and digest(elements)[0] == c:
                seen.add(c)
                rows.append(i)
                out.append((len(elements), elements.tobytes()))
        if rows:
            kept = batch.select(["c", "family", "copies", "seats"]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*kept.columns, *[pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.binary()), strict=True)]], names=["c", "family", "copies", "seats", "n", "elements"])


def similar(docs: DataFrame, size: int = 4, percent: int = 85, id_column: str = "doc_id", text_column: str = "text", links: bool = False) -> DataFrame:
    """doc_id, n_shingles, class_id (least id with the same set), component_id (least id that links reach), text_hash
    (xxhash64 of the row's text), link_key (the same for rows that links connect and for no others; null without
    shingles), and with ``links`` n_links (how many other rows link with it directly)."""
    given = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    buckets = max(8, input_bytes(docs) // BUCKET_BYTES)
    with Scratch() as scratch:
        each, named = _named(scratch, given, buckets, size, percent, links)
    counted = [F.coalesce("n_links", F.lit(0)).alias("n_links")] if links else []
    out = each.join(dealt(named), ["n", "s1", "s2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("component_id", "doc_id").alias("component_id"), "text_hash", "link_key", *counted)


def _candidates(scratch: Scratch, packed: DataFrame, buckets: int) -> DataFrame:
    """key, c, m of all buckets."""
    hot = [r["bucket"] for r in packed.groupBy("bucket").agg(F.sum(F.length("keys")).alias("n")).filter(F.col("n") > 6 * HOT_BUCKET).collect()]
    shared = packed.filter(~F.col("bucket").isin(hot)) if hot else packed
    shared = shared.groupBy("bucket").applyInArrow(lambda t: shared_keys(t, buckets), "key long, c long, m int")
    if hot:
        pairs = scratch.written(packed.filter(F.col("bucket").isin(hot)).mapInArrow(lambda it: keys_as_rows(it, buckets), "key long, c long").distinct(), "hot-keys")
        counts = scratch.written(pairs.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "hot-counts")
        met = salted_join(pairs, counts, "key", "c", hubs(counts, "key", pairs.count()))
        shared = shared.unionByName(met.select("key", "c", F.col("n").cast("int").alias("m")))
    return scratch.written(shared, "tiles")


def _band(percent: int) -> Column:
    """Of sizes: two sets that link are in one band or in neighbouring ones."""
    return F.floor(F.log(F.col("n")) / math.log(100 / percent) + 1e-9).cast("int")


def _sized(scratch: Scratch, families: DataFrame) -> tuple[DataFrame, bool]:
    """c, family, m (classes of the family), and whether there is a crowded family."""
    sizes = scratch.written(families.groupBy("label").agg(F.count("*").alias("n")), "sizes")
    sized = salted_join(families, sizes, "label", "node", hubs(sizes, "label", families.count()))
    return sized.select(F.col("node").alias("c"), F.col("label").alias("family"), F.col("n").cast("int").alias("m")), not sizes.filter(F.col("n") > CROWDED).isEmpty()


def _parted(scratch: Scratch, met: DataFrame, wanted: DataFrame, classes: DataFrame, percent: int, shares: int) -> DataFrame:
    """``wanted`` with each crowded family parted into those that sketches connect. A hash of many classes is cut by
    size band."""
    crowd = wanted.filter(F.col("m") > CROWDED)
    sketched = crowd.select("c", "n").join(dealt(classes.select(F.col("s1").alias("c"), "sketch")), "c")
    bands = F.when(F.col("met") > CROWDED, F.array(_band(percent), _band(percent) + 1)).otherwise(F.array(F.lit(0)))
    groups = met.select("c", "key", "met").join(dealt(sketched), "c").select("key", F.explode(bands).alias("band"), "c", "n", "sketch")
    groups = groups.withColumn("share", F.pmod(F.xxhash64("key", "band"), F.lit(shares)))
    parts, _ = _sized(scratch, components(groups.groupBy("share").applyInArrow(lambda t: link_sketches(t, percent), "a long, b long"), "parts"))
    parted = crowd.drop("family", "m").join(dealt(parts), "c")
    return scratch.written(wanted.filter(F.col("m") <= CROWDED).unionByName(parted), "parted")


def _seated(scratch: Scratch, wanted: DataFrame, percent: int) -> DataFrame:
    """doc_id, c, family, copies, seats: for each class the bands of its family where it is compared, as one of the
    band's own or as a guest from the band below, and over how many blocks each band is cut. A band without classes of
    its own has no guests."""
    columns = ["doc_id", "c", "family", "copies"]
    small = wanted.filter(F.col("m") <= CROWDED).select(*columns, F.array(F.struct(F.lit(0).alias("band"), F.lit(True).alias("own"), F.lit(1).alias("side"))).alias("seats"))
    seat = lambda band, own: F.struct(band.alias("band"), F.lit(own).alias("own"))
    seats = wanted.filter(F.col("m") > CROWDED).withColumn("seat", F.explode(F.array(seat(_band(percent), True), seat(_band(percent) + 1, False))))
    seats = seats.select(*columns, "seat.*").withColumn("cell", F.xxhash64("family", "band"))
    full = scratch.written(seats.groupBy("cell").agg(F.count("*").alias("n"), F.max("own").alias("used")).filter("used AND n > 1").drop("used"), "bands")
    seats = salted_join(seats, full, "cell", "c", hubs(full, "cell", seats.count())).withColumn("side", F.ceil(F.col("n") / (4 * CROWDED)).cast("int"))
    return small.unionByName(seats.groupBy(*columns).agg(F.collect_list(F.struct("band", "own", "side")).alias("seats")).withColumn("seats", F.col("seats").cast(SEATS)))


def _named(scratch: Scratch, given: DataFrame, buckets: int, size: int, percent: int, links: bool) -> tuple[DataFrame, DataFrame]:
    """Two kept tables: each row with its set's digest, and each digest with its class, its component and its links."""
    scan = scratch.written(given.mapInArrow(lambda it: signatures(it, size, percent, buckets), SIGNATURES), "signatures")
    each = scratch.keep(scratch.written(scan.filter("bucket IS NULL").select("doc_id", "text_hash", "n", "s1", "s2"), "each"))
    classes = scratch.written(scan.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("copies"), F.min("sketch").alias("sketch")), "classes")
    tiles = _candidates(scratch, scan.filter("bucket IS NOT NULL").select("bucket", "keys", "classes", "counts"), buckets)
    forget(scratch.keep(scan))

    own = tiles.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("m", "key")), asc=False).alias("t"))
    own = own.join(dealt(classes.select(F.col("s1").alias("c"), F.col("class_id").alias("doc_id"), "n", "copies")), "c").withColumn("asked", (1 + F.floor(F.floor(F.col("n") * percent / 100) / 20)).cast("int"))
    own = own.filter(F.size("t") >= F.col("asked"))
    kept = scratch.written(own.select("c", "doc_id", "n", "copies", F.explode(F.slice("t", F.col("asked"), F.size("t"))).alias("k")).select("c", "doc_id", "n", "copies", "k.key"), "kept")
    stars_of = scratch.written(kept.groupBy("key").agg(F.min("c").alias("least"), F.count("*").alias("met")).filter("met > 1"), "stars-of-keys")
    met = salted_join(kept.select("c", "key"), stars_of, "key", "c", hubs(stars_of.withColumnRenamed("met", "n"), "key", kept.count()))
    sized, crowded = _sized(scratch, components(met.select(F.col("c").alias("a"), F.col("least").alias("b")), "families"))
    wanted = scratch.written(kept.select("c", "doc_id", "n", "copies").distinct().join(dealt(sized), "c"), "wanted")
    if crowded:
        wanted = _parted(scratch, met, wanted, classes, percent, max(8, kept.count() // SKETCHES))

    arrays = given.join(dealt(_seated(scratch, wanted, percent)), "doc_id").select("c", "family", "copies", "seats", "text")
    arrays = arrays.mapInArrow(lambda it: full_sets(it, size), f"c long, family long, copies long, seats {SEATS}, n long, elements binary")
    cells = arrays.withColumn("seat", F.explode("seats")).withColumn("side", F.col("seat.side")).withColumn("block", F.pmod(F.xxhash64("c"), F.col("side")).cast("int"))
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("side") - 1))).withColumn("row", F.least("block", "other")).withColumn("col", F.greatest("block", "other"))
    cells = cells.select("family", "c", "n", "copies", "elements", "seat.band", "seat.own", "block", "row", "col", (F.col("row") != F.col("col")).alias("off"))
    stars = cells.groupBy("family", "band", "row", "col").applyInArrow(lambda t: link_tile(t, percent, links), "a long, b long, links long")
    stars = scratch.written(stars, "stars") if links else stars
    final = components(stars, "links")

    least = scratch.written(final.join(dealt(classes.select(F.col("s1").alias("node"), "class_id")), "node").groupBy("label").agg(F.min("class_id").alias("component_id"), F.count("*").alias("n")), "least")
    ids = salted_join(final, least.drop("n"), "label", "node", hubs(least, "label", final.count())).select(F.col("node").alias("s1"), "label", "component_id")
    named = classes.join(dealt(ids), "s1", "left").select("n", "s1", "s2", "class_id", F.coalesce("component_id", "class_id").alias("component_id"), F.coalesce("label", "s1").alias("link_key"))
    if links:
        near = stars.filter("a = b").groupBy(F.col("a").alias("s1")).agg(F.sum("links").alias("near"))
        sums = classes.join(dealt(near), "s1", "left").select("n", "s1", "s2", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"))
        named = named.join(dealt(sums), ["n", "s1", "s2"])
    return each, scratch.keep(scratch.written(named, "named"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS a FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(a) = 0 THEN [] WHEN len(a) < 4 THEN [array_to_string(a, ' ')] ELSE [array_to_string(a[i:i + 3], ' ') for i in range(1, len(a) - 2)] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id HAVING 185 * count(*) >= 85 * (max(nx.n) + max(ny.n))),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS low FROM r GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(c.low, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""
