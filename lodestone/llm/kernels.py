"""Vectorised text kernels over Arrow batches.

Every kernel works on whole UTF-8 texts, as bytes, through numpy; no Python loop runs per byte or per word.
The hash of a byte string depends only on the bytes, never on the batch, the partition or the position, so equal
strings have equal hashes on every executor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes of text that one kernel call works on; a longer document is a call of its own.
SLICE_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """An invertible avalanche of 64-bit words (the splitmix64 finisher)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """n pseudo-random words of a seed."""
    return mix((np.arange(1, n + 1, dtype=U64) + U64(seed)) * U64(0x9E3779B97F4A7C15))


BYTE_CODE = stream(11, 256)
SEED, STEP, TURN = (U64(int(x) | 1) for x in stream(12, 3))
SHINGLE_BASE = U64(int(stream(13, 1)[0]) | 1)
#: Longer spans are hashed one by one.
LONGEST = 512
#: How many low bytes of a word count.
LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=U64)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

def words_at_bytes(data: np.ndarray) -> np.ndarray:
    """The little-endian 64-bit word that begins at each byte, and one past the end; beyond the end all bytes are 0."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes: its length and then its words of eight bytes are taken into a state that is
    avalanched after each, so no algebra on the bytes carries over; spans of over ``LONGEST`` bytes by BLAKE2b."""
    start, length = np.asarray(start, np.int64), np.asarray(end, np.int64) - np.asarray(start, np.int64)
    word = words_at_bytes(data)
    state = mix(length.astype(U64) * STEP + SEED)
    if not len(start):
        return state
    long_ = np.flatnonzero(length > LONGEST)
    left = np.minimum(length, 8)
    state = mix(state ^ (word[start] & LOW_BYTES[left]))
    open_, done = np.flatnonzero((length > 8) & (length <= LONGEST)), 8
    while len(open_):
        left = length[open_] - done
        state[open_] = mix(state[open_] * TURN ^ (word[start[open_] + done] & LOW_BYTES[np.minimum(left, 8)]))
        open_, done = open_[left > 8], done + 8
    for i in long_:
        state[i] = int.from_bytes(hashlib.blake2b(data[start[i] : start[i] + length[i]].tobytes(), digest_size=8).digest(), "little")
    return state


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash for each pair of hashes, in this order; in blocks that stay in the processor's cache."""
    out = np.empty(len(a), U64)
    for i in range(0, len(a), 1 << 15):
        x = np.multiply(b[i : i + (1 << 15)], TURN, out=out[i : i + (1 << 15)])
        x ^= x >> U64(32)
        x += a[i : i + (1 << 15)]
        x *= STEP
        x ^= x >> U64(29)
    return out


class Rolling:
    """Hashes of spans at any place of one sequence of bytes or of word hashes, by doubling: the hash of 2**k tokens joins
    those of its halves, and a span's joins those of the longest such runs at its two ends. ``lengths`` are those of the
    spans that are asked for, and the hash of a sequence depends on them and on the tokens only."""

    def __init__(self, tokens: np.ndarray, lengths: Iterable[int]):
        want = {n.bit_length() - 1 for n in lengths}
        k = 0
        if tokens.dtype != np.uint8:
            now = mix(tokens ^ SEED)
        elif min(want) >= 3:
            now, k = mix(words_at_bytes(tokens)[: max(0, len(tokens) - 7)] ^ SEED), 3
        else:
            now = BYTE_CODE[tokens]
        self.levels = {}
        while True:
            if k in want:
                self.levels[k] = now
            if k >= max(want):
                break
            n = max(0, len(now) - (1 << k))
            now = joined(now[:n], now[1 << k :][:n])
            k += 1

    def all(self, length: int) -> np.ndarray:
        """Of the spans of this length at all places."""
        k = length.bit_length() - 1
        level, n = self.levels[k], max(0, len(self.levels[k]) - length + (1 << k))
        return joined(level[:n], level[length - (1 << k) :][:n])

    def __call__(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        if isinstance(length, int):
            k = length.bit_length() - 1
            return joined(self.levels[k][start], self.levels[k][start + length - (1 << k)])
        out = np.empty(len(start), U64)
        kind = np.frexp(length.astype(np.float64))[1] - 1
        for k in np.unique(kind):
            mine = np.flatnonzero(kind == k)
            out[mine] = joined(self.levels[int(k)][start[mine]], self.levels[int(k)][start[mine] + length[mine] - (1 << int(k))])
        return out


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its n + 1 offsets into them; null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut so that each holds at most ``most`` bytes of text, or one document; with bytes and offsets. A worker
    outlives its task, so at the end Arrow gives back what it holds for later batches."""
    for batch in batches:
        data, at = text_buffers(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(at, at[first] + most, side="right")) - 1)
            yield batch.slice(first, last - first), data[at[first] : at[last]], at[first : last + 1] - at[first]
            first = last
        del batch, data, at
    pa.default_memory_pool().release_unused()


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every maximal run of non-space bytes within a document, and for each document (and one past
    the last) the number of its first word."""
    space = SPACE[data]
    before = np.empty(len(data), dtype=bool)
    after = np.empty(len(data), dtype=bool)
    if len(data):
        before[0] = True
        before[1:] = space[:-1]
        after[-1] = True
        after[:-1] = space[1:]
        inner = at[(at > 0) & (at < len(data))]
        before[inner] = True
        after[inner - 1] = True
    start = np.flatnonzero(~space & before)
    end = np.flatnonzero(~space & after) + 1
    return start, end, np.searchsorted(start, at)


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` word hashes within a document, and for each document (and one past the last)
    the number of its first shingle. A document of fewer words, but one at least, has its whole sequence as one."""
    counts = np.diff(first)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(n)))
    owner = np.repeat(np.arange(len(counts)), n)
    begin = first[:-1][owner] + (np.arange(bounds[-1]) - bounds[:-1][owner])
    span = np.minimum(counts[owner], size)
    padded = np.concatenate((words, np.zeros(size, dtype=U64)))
    total = np.zeros(len(begin), dtype=U64)
    for k in range(size):
        total *= SHINGLE_BASE
        total += np.where(k < span, padded[begin + k], U64(0))
    return mix(total + span.astype(U64)), bounds


def hashed_words(data: np.ndarray, at: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word, and the first word of each document."""
    start, end, first = word_spans(data, at)
    return span_hashes(LOWER[data] if lower else data, start, end), start, end, first


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return np.ascontiguousarray(x, dtype=U64).view(np.int64)
