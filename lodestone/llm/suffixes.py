"""Exact removal of repeated windows by a depth-limited radix sort of suffixes, most significant digit first.

Only the first ``length`` tokens of a suffix count, so what is equal after the last digit is a repeated window. Tokens are
the bytes of a text, whose repeats are removed, and its words, whose repeats are counted. Each pass keeps the groups of
two or more and drops the rest, so that ever fewer suffixes go on:

1. Core. Each window has an anchor, its leftmost least-hashed gram of ``gram`` tokens, so equal windows have their
   anchors at equal distance. Consecutive windows that share the anchor and the block of ``step`` distances form a run,
   and share a core of tokens fixed relative to the anchor. A core that occurs once holds no repeated window.
2. Run. Runs of one core that are equal from end to end repeat as a whole: all their windows go.
3. Windows. Only where runs of one core differ, at the edges of repeated passages, are single suffixes sorted, by
   ``DIGITS`` digits that cut the window. Of equal runs one is enough.

Digits are compared by their hashes, of 64 bits the first and 32 bits the others, 192 for a window, since the order of
different suffixes decides nothing. Equal runs and windows of a task are combined before they are sent, so copies by the
thousand cost few records; a bucket of runs that a common core has made large is split by run, and then all its runs go
on to the last pass. Single windows stay in the bucket of their core, or are dealt out by the whole window if it was
split. Texts move to meet the open windows, and to meet
the spans that are removed.

Defined results: a null text is empty; texts under ``length`` bytes stay; every row is a document, so a row repeated
with the same id loses what both have; kept bytes may end within a character, so they are binary; rows with a null id
are documents like others; other columns are ignored; an empty table gives an empty result. Rows are told apart by a
64-bit hash of id and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, dealt, input_bytes, table
from .kernels import U64, Rolling, mix, slices, span_hashes, word_spans
from .packed import pack, record_batch, unpack

LENGTH, GRAM, STEP = 400, 32, 112
WORDS = 50
DIGITS = 5
SEGMENT = 2 << 20
#: Tokens whose runs or windows a task combines at a time.
COMBINED = 32 << 20
BUCKET_BYTES = 8 << 20
#: A bucket with more runs than this is split.
CROWDED = 1 << 20
POSITION_BITS = 27


class Depth(NamedTuple):
    """How suffixes of one kind of token are compared."""

    words: bool
    length: int
    gram: int
    step: int

    def tokens(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of a slice, and where each document begins."""
        if not self.words:
            return data, at
        start, end, first = word_spans(data, at)
        return span_hashes(data, start, end), first

    def digits(self) -> list[tuple[int, int]]:
        """Offset and length of each digit of a window; a window of fewer tokens has empty ones."""
        cuts = [self.length * i // DIGITS for i in range(DIGITS + 1)]
        return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


RUNS = "bucket int, part int, core binary, run binary, row binary, start binary, count binary, known binary, row_key long, words boolean, spans binary"
_RUN_NAMES = [x.split()[0] for x in RUNS.split(", ")]
_RUN_TYPES = [pa.int32(), pa.int32(), *[pa.binary()] * 6, pa.int64(), pa.bool_(), pa.binary()]
SPANS = "row_key long, words boolean, spans binary"
_SPAN_TYPES = [pa.int64(), pa.bool_(), pa.binary()]
WINDOWS = f"bucket int, {', '.join(f'digit{i} binary' for i in range(DIGITS))}, row binary, start binary, {SPANS}"
_WINDOW_NAMES = [x.split()[0] for x in WINDOWS.split(", ")]
_WINDOW_TYPES = [pa.int32(), *[pa.binary()] * (DIGITS + 2), *_SPAN_TYPES]


def least_in_windows(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` values: running minima from both ends of blocks of that width."""
    n = len(x) - width + 1
    padded = np.concatenate((x, np.full(-len(x) % width, np.iinfo(x.dtype).max, x.dtype))).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def runs(tokens: np.ndarray, at: np.ndarray, length: int, gram: int, step: int) -> tuple[np.ndarray, ...]:
    """Core hash, run hash, document, first window and count of windows, of each run."""
    total = len(tokens) - length + 1
    lengths = np.diff(at)
    if total <= 0 or not (lengths >= length).any():
        return tuple(np.zeros(0, t) for t in (U64, U64, np.int64, np.int64, np.int64))
    rolling = Rolling(tokens, (gram, length - step + 1, length, length + step - 1))
    grams = mix(rolling.all(gram)) >> U64(POSITION_BITS) << U64(POSITION_BITS)
    grams |= np.arange(len(grams), dtype=U64)
    anchor = (least_in_windows(grams, length - gram + 1) & U64((1 << POSITION_BITS) - 1)).astype(np.int64)
    del grams
    inside = np.zeros(total + 1, np.int8)
    long_ = lengths >= length
    np.add.at(inside, at[:-1][long_], 1)
    np.add.at(inside, at[1:][long_] - length + 1, -1)
    start = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
    anchor = anchor[start]
    block = (anchor - start) // step
    new = np.ones(len(start), dtype=bool)
    new[1:] = (np.diff(start) != 1) | (np.diff(anchor) != 0) | (np.diff(block) != 0)
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate((first, [len(start)])))
    begin, anchor, block = start[first], anchor[first], block[first]
    core = mix(rolling(anchor - block * step, length - step + 1) + block.astype(U64))
    run = mix(rolling(begin, count - 1 + length) + mix((anchor - begin).astype(U64) * U64(length) + count.astype(U64)))
    return core, run, np.searchsorted(at, begin, side="right") - 1, begin, count


def segments(tokens: np.ndarray, at: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """The slice itself, or a long document's overlapping segments, each with its offset; every window is in one."""
    if len(at) != 2 or len(tokens) <= 2 * SEGMENT:
        yield tokens, at, 0
        return
    for base in range(0, len(tokens) - length + 1, SEGMENT):
        part = tokens[base : base + SEGMENT + length - 1]
        yield part, np.array([0, len(part)]), base


def span_rows(rows: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[tuple[int, bytes]]:
    """(row_key, packed starts and ends) of each row; touching and overlapping spans are merged."""
    if not len(rows):
        return []
    order = np.lexsort((start, rows))
    rows, start, end = rows[order], start[order], end[order]
    out = []
    cuts = np.flatnonzero(np.diff(rows)) + 1
    for i, j in zip([0, *cuts], [*cuts, len(rows)], strict=True):
        out.append((int(rows[i]), merged(start[i:j], end[i:j]).tobytes()))
    return out


def merged(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The union of spans sorted by start, as rows of start and end."""
    reach = np.maximum.accumulate(end)
    new = np.concatenate(([True], start[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    return np.stack((start[first], reach[np.concatenate((first[1:] - 1, [len(start) - 1]))]), axis=1)


def equals(*digits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order in which equal records are neighbours, and for each place of it whether it leads a group of equals and
    whether its group has others."""
    order = np.lexsort(digits[::-1])
    same = np.ones(max(0, len(order) - 1), dtype=bool)
    for d in digits:
        same &= np.diff(d[order]) == 0
    return order, np.concatenate(([True], ~same)), np.concatenate((same, [False])) | np.concatenate(([False], same))


def repeated(digits: list[np.ndarray]) -> np.ndarray:
    """The places of records that another is equal to: passes from the most significant digit on, each of which sorts
    within the groups that the ones before have left and drops those of one."""
    alive = np.arange(len(digits[0]))
    group = np.zeros(len(alive), np.int64)
    for digit in digits:
        if not len(alive):
            break
        order = np.lexsort((digit[alive], group))
        alive, group = alive[order], group[order]
        new = np.ones(len(alive), dtype=bool)
        new[1:] = (np.diff(group) != 0) | (np.diff(digit[alive]) != 0)
        group = np.cumsum(new) - 1
        keep = (np.bincount(group) > 1)[group]
        alive, group = alive[keep], group[keep]
    return alive


def combined(parts: Iterable[tuple[int, list[np.ndarray]]]) -> Iterator[list[np.ndarray]]:
    """Columns of records, joined until they are of ``COMBINED`` tokens."""
    held, size = [], 0
    for n, columns in parts:
        size += n
        if len(columns[0]):
            held.append(columns)
        if size >= COMBINED and held:
            yield [np.concatenate(x) for x in zip(*held, strict=True)]
            held, size = [], 0
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def scan(batches: Iterable[pa.RecordBatch], buckets: int, depths: list[Depth]) -> Iterator[pa.RecordBatch]:
    """Packed runs by bucket of the core (those of the second depth in buckets of their own), and the spans that repeat
    among the runs that are combined. Of these equal ones are sent once, marked as known."""

    def found() -> Iterator[tuple[int, list[np.ndarray]]]:
        for batch, data, at in slices(batches, most=SEGMENT):
            keys = batch.column("row_key").to_numpy()
            for d, depth in enumerate(depths):
                tokens, first = depth.tokens(data, at)
                for part, ends, base in segments(tokens, first, depth.length):
                    core, run, doc, begin, count = runs(part, ends, *depth[1:])
                    yield (0 if d else len(part)), [np.full(len(core), d, np.int8), core, run, keys[doc], begin - ends[doc] + base, count.astype(np.uint8)]

    lengths = np.array([x.length for x in depths])
    for depth, core, run, row, start, count in combined(found()):
        order, lead, again = equals(depth, core, run)
        told, sent, known = order[again], order[lead], again[lead]
        end = start[told] + count[told] + lengths[depth[told]] - 1
        spans = [(k, d.words, s) for i, d in enumerate(depths) for k, s in span_rows(*(x[depth[told] == i] for x in (row[told], start[told], end)))]
        of = (core[sent] % U64(buckets)).astype(np.int32) + depth[sent] * np.int32(buckets)
        packs = pack(of, [core[sent], run[sent], row[sent], start[sent].astype(np.int32), count[sent], known.astype(np.uint8)])
        yield record_batch([(b, 0, *p, None, None, None) for b, *p in packs] + [(*[None] * 8, *s) for s in spans], _RUN_NAMES, _RUN_TYPES)


def split(batches: Iterable[pa.RecordBatch], parts: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """The runs of crowded buckets, dealt out by run over so many parts of each."""
    kinds = (U64, U64, np.int64, np.int32, np.uint8, np.uint8)
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            bucket = batch.column("bucket")[i].as_py()
            columns = [np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in zip(_RUN_NAMES[2:8], kinds, strict=True)]
            rows += [(bucket, *p, None, None, None) for p in pack((columns[1] >> U64(20)).astype(np.int64) % parts[bucket] + 1, columns)]
        yield record_batch(rows, _RUN_NAMES, _RUN_TYPES)


def judge_runs(rows: pa.Table, buckets: int, depths: list[Depth]) -> pa.Table:
    """row_key, words, spans, open, home: of one bucket, spans of whole repeated runs, and runs whose windows are still open.
    In a part of a crowded bucket a core's other runs aren't known, so all are open. ``home`` is the bucket, or -1."""
    bucket, part = rows.column("bucket")[0].as_py(), rows.column("part")[0].as_py()
    depth = depths[bucket // buckets]
    core, run = unpack(rows, "core", U64), unpack(rows, "run", U64)
    row, start = unpack(rows, "row", np.int64), unpack(rows, "start", np.int32).astype(np.int64)
    count, known = unpack(rows, "count", np.uint8).astype(np.int64), unpack(rows, "known", np.uint8) > 0
    order = np.lexsort((run, core))
    core, run, row, start, count, known = (x[order] for x in (core, run, row, start, count, known))
    new_core = np.concatenate(([True], core[1:] != core[:-1]))
    new_run = new_core | np.concatenate(([True], run[1:] != run[:-1]))
    of_run, of_core = np.cumsum(new_run) - 1, np.cumsum(new_core) - 1
    whole = (np.bincount(of_run) > 1) | (np.bincount(of_run, weights=known) > 0)
    runs_of_core = np.bincount(of_core[new_run])
    lone = np.bincount(of_core[new_run], weights=~whole) > 0
    done = whole[of_run]
    spans = span_rows(row[done], start[done], start[done] + count[done] - 1 + depth.length)
    open_ = new_run if part else new_run & (runs_of_core > 1)[of_core] & lone[of_core]
    left = span_rows(row[open_], start[open_], start[open_] + count[open_])
    out = [(k, depth.words, s, None, None) for k, s in spans] + [(k, depth.words, None, s, -1 if part else bucket) for k, s in left]
    return pa.Table.from_batches([record_batch(out, ["row_key", "words", "spans", "open", "home"], [*_SPAN_TYPES, pa.binary(), pa.int32()])])


def windows(batches: Iterable[pa.RecordBatch], buckets: int, depths: list[Depth]) -> Iterator[pa.RecordBatch]:
    """Packed digits of the open windows of each text, for the bucket of their core or else dealt out by the whole window,
    and the spans of those that repeat among the ones that are combined; of equal ones one is sent."""

    def found() -> Iterator[tuple[int, list[np.ndarray]]]:
        for batch, data, at in slices(batches, most=SEGMENT):
            keys = batch.column("row_key").to_numpy()
            for d, depth in enumerate(depths):
                pairs = [(i, p["home"], a, b) for i, x in enumerate(batch.column(f"open{d}").to_pylist()) for p in x for a, b in np.frombuffer(p["open"], np.int64).reshape(-1, 2)]
                if not pairs:
                    continue
                tokens, first = depth.tokens(data, at)
                digits = depth.digits()
                for part, _, base in segments(tokens, first, depth.length):
                    rolling = Rolling(part, [n for _, n in digits if n])
                    last = base + SEGMENT if len(part) < len(tokens) else len(tokens)
                    begins = [np.arange(max(a, base), min(b, last)) for _, _, a, b in pairs]
                    doc, home = (np.repeat(np.array([x[k] for x in pairs]), [len(x) for x in begins]) for k in (0, 1))
                    start = np.concatenate(begins)
                    here = start + first[doc] - base
                    hashes = [rolling(here + offset, n) if n else np.zeros(len(here), U64) for offset, n in digits]
                    yield 40 * len(start), [np.full(len(start), d, np.int8), home.astype(np.int32), *hashes[:1], *[(x >> U64(32)).astype(np.uint32) for x in hashes[1:]], keys[doc], start.astype(np.int32)]

    lengths = np.array([x.length for x in depths])
    for depth, home, *digits, row, start in combined(found()):
        order, lead, again = equals(depth, *digits)
        told, sent = order[again], order[lead]
        begin = start[told].astype(np.int64)
        spans = [(k, d.words, s) for i, d in enumerate(depths) for k, s in span_rows(*(x[depth[told] == i] for x in (row[told], begin, begin + lengths[depth[told]])))]
        whole = digits[0][sent]
        for x in digits[1:]:
            whole = mix(whole ^ x[sent])
        of = np.where(home[sent] < 0, (whole % U64(buckets)).astype(np.int32) + depth[sent] * np.int32(buckets), home[sent])
        packs = pack(of, [x[sent] for x in (*digits, row, start)])
        none = [None] * (DIGITS + 2)
        yield record_batch([(*p, None, None, None) for p in packs] + [(k % buckets, *none, k, w, s) for k, w, s in spans], _WINDOW_NAMES, _WINDOW_TYPES)


def judge_windows(rows: pa.Table, buckets: int, depths: list[Depth]) -> pa.Table:
    """Spans of one bucket's windows that are equal in all digits, and those that were told before."""
    before = rows.filter(rows.column("spans").is_valid()).select(["row_key", "words", "spans"])
    rows = rows.filter(rows.column("spans").is_null())
    if not rows.num_rows:
        return before
    depth = depths[rows.column("bucket")[0].as_py() // buckets]
    row, start = unpack(rows, "row", np.int64), unpack(rows, "start", np.int32).astype(np.int64)
    told = repeated([unpack(rows, f"digit{i}", np.uint32 if i else U64) for i in range(DIGITS)])
    out = [(k, depth.words, s) for k, s in span_rows(row[told], start[told], start[told] + depth.length)]
    return pa.concat_tables([before, pa.Table.from_batches([record_batch(out, ["row_key", "words", "spans"], _SPAN_TYPES)]).cast(before.schema)])


def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The kept bytes of each text, how much went, and how many words are in repeats."""
    for batch, data, at in slices(batches):
        out = []
        for i, packs in enumerate(batch.column("spans").to_pylist()):
            text = data[at[i] : at[i + 1]]
            of = {words: _union([p["spans"] for p in packs or () if p["words"] == words]) for words in (False, True)}
            gone = of[False]
            edges = np.concatenate(([0], gone.ravel(), [len(text)])).reshape(-1, 2)
            kept = b"".join(text[a:b].tobytes() for a, b in edges)
            out.append((len(text), len(text) - len(kept), len(gone), int(np.diff(of[True]).sum()), kept))
        yield record_batch([(d, *r) for d, r in zip(batch.column("doc_id").to_pylist(), out, strict=True)], [x.split()[0] for x in RESULT.split(", ")], [*[pa.int64()] * 5, pa.binary()])


def _union(packs: list[bytes]) -> np.ndarray:
    if not packs:
        return np.zeros((0, 2), np.int64)
    pairs = np.concatenate([np.frombuffer(p, np.int64) for p in packs]).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    return merged(pairs[:, 0], pairs[:, 1])


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, n_repeated_words long, kept binary"


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, step: int = STEP, words: int = WORDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), n_repeated_words, kept (the remaining bytes): each byte
    goes that a string of ``length`` bytes covers which starts anywhere else too, in this document or another.
    n_repeated_words counts the words that a run of ``words`` words covers which starts anywhere else too, whatever
    white space is between them; they stay, unless they are in such a string."""
    if not 0 < gram <= length or not 0 < step <= min(255, length) or words < 1:
        raise ValueError("gram may not exceed length, nor step 255")
    given = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")).withColumn("row_key", F.xxhash64("doc_id", "text"))
    buckets = max(8, input_bytes(docs) // BUCKET_BYTES)
    depths = [Depth(False, length, gram, step), Depth(True, words, max(1, words // 6), max(1, words // 4))]
    with Scratch() as scratch:
        scanned = scratch.written(given.select("row_key", "text").mapInArrow(lambda it: scan(it, buckets, depths), RUNS), "runs")
        packed = scanned.filter("bucket IS NOT NULL").drop("row_key", "words", "spans")
        crowded = {r["bucket"]: 1 + r["n"] // CROWDED for r in packed.groupBy("bucket").agg(F.sum(F.length("count")).alias("n")).filter(F.col("n") > CROWDED).collect()}
        if crowded:
            hot = F.col("bucket").isin(list(crowded))
            packed = packed.filter(~hot).unionByName(scanned.filter(hot).mapInArrow(lambda it: split(it, crowded), RUNS).drop("row_key", "words", "spans"))
        judged = scratch.written(packed.groupBy("bucket", "part").applyInArrow(lambda t: judge_runs(t, buckets, depths), f"{SPANS}, open binary, home int"), "judged")
        found = [x.filter("spans IS NOT NULL").select("row_key", "words", "spans") for x in (scanned, judged)]
        left = judged.filter("open IS NOT NULL").groupBy("row_key").agg(*[F.collect_set(F.when(F.col("words") == d.words, F.struct("open", "home"))).alias(f"open{i}") for i, d in enumerate(depths)])
        met = given.join(dealt(left), "row_key").select("row_key", "text", "open0", "open1")
        found.append(met.mapInArrow(lambda it: windows(it, buckets, depths), WINDOWS).groupBy("bucket").applyInArrow(lambda t: judge_windows(t, buckets, depths), SPANS))
        spans = found[0]
        for more in found[1:]:
            spans = spans.unionByName(more)
        spans = scratch.keep(scratch.written(spans.groupBy("row_key").agg(F.collect_set(F.struct("words", "spans")).alias("spans")), "spans"))
    return given.join(dealt(spans), "row_key", "left").select("doc_id", "text", "spans").mapInArrow(cut, RESULT)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_repeated_words is a column after those of the contract: passages of over 50 words may have fewer than 400 bytes."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_repeated_words")


SQL = None


def brute_force(texts: list[bytes], length: int = LENGTH, words: int = WORDS) -> list[tuple[int, int, int, str, int]]:
    """What the operator computes, plainly, for tests."""
    from collections import Counter

    def covered(sequences: list, n: int) -> list[np.ndarray]:
        seen = Counter(t[i : i + n] for t in sequences for i in range(len(t) - n + 1))
        out = []
        for t in sequences:
            gone = np.zeros(len(t), dtype=bool)
            for i in range(len(t) - n + 1):
                if seen[t[i : i + n]] > 1:
                    gone[i : i + n] = True
            out.append(gone)
        return out

    spaces = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
    by_words = covered([tuple(w for w in t.translate(spaces).split(b" ") if w) for t in texts], words)
    out = []
    for t, gone, shared in zip(texts, covered(texts, length), by_words, strict=True):
        n = int((np.diff(np.concatenate(([False], gone)).astype(np.int8)) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((len(t), int(gone.sum()), n, hashlib.sha256(kept).hexdigest(), int(shared.sum())))
    return out
