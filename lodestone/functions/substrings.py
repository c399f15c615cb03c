"""Which of many terms each of many texts has, over Arrow batches, without a loop over texts or terms.

Terms are told by their first eight bytes, as one 64-bit word for each place of a text: terms of one length share a mask,
and a table of bits by a hash of the masked word passes few places on. These are looked up among the sorted words, and
of terms of over eight bytes the rest is compared."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SPREAD = U64(0x9E3779B97F4A7C15)
#: Bytes of text, and marks of a text having a term, that are held at once.
SLICE_BYTES, SLICE_MARKS = 2 << 20, 32 << 20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, with eight more at the end, and where each text begins (and the last one ends)."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.zeros(8, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.concatenate((raw, np.zeros(8, np.uint8))), at - at[0]


class Finder:
    def __init__(self, terms: list[str]):
        self.raw = [t.encode() for t in terms]
        self.groups = []
        bits = max(12, (16 * max(1, len(terms))).bit_length())
        self.shift = U64(64 - bits)
        #: By the first two bytes of a place: whether a term begins so, of one byte, and of more.
        self.begins = np.zeros((2, 1 << 16), bool)
        for length in sorted({len(r) for r in self.raw} - {0}):
            mine = np.array([i for i, r in enumerate(self.raw) if len(r) == length])
            words = np.array([int.from_bytes(self.raw[i][:8], "little") for i in mine], U64)
            order = np.argsort(words, kind="stable")
            table = np.zeros(1 << bits, bool)
            table[self._slot(words)] = True
            if length == 1:
                self.begins[0] |= np.isin(np.arange(1 << 16) & 255, words)
            else:
                self.begins[1][words & U64(0xFFFF)] = True
            self.groups.append((length, U64((1 << 8 * min(8, length)) - 1), table, words[order], mine[order]))

    def _slot(self, words: np.ndarray) -> np.ndarray:
        return (words * SPREAD) >> self.shift

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """text, term: each once, by text and term."""
        texts, terms, first = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        sizes = np.cumsum(pc.fill_null(pc.binary_length(column.cast(pa.large_binary())), 0).to_numpy()) if len(column) else np.zeros(0)
        most = max(1, SLICE_MARKS // max(1, len(self.raw)))
        while first < len(column):
            before = sizes[first - 1] if first else 0
            stop = min(first + most, max(first + 1, int(np.searchsorted(sizes, before + SLICE_BYTES, side="right"))))
            marks = self._marks(*text_bytes(column.slice(first, stop - first)))
            text, term = np.nonzero(marks)
            texts.append(text + first)
            terms.append(term)
            first = stop
        return np.concatenate(texts), np.concatenate(terms)

    def _marks(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        marks = np.zeros((len(at) - 1, len(self.raw)), bool)
        n = len(data) - 8
        pairs = data[:n].astype(np.uint16) | data[1 : n + 1].astype(np.uint16) << 8
        begin = [np.flatnonzero(b[pairs]) for b in self.begins]
        at_place = np.ndarray(n, "<u8", buffer=data, strides=(1,)) if n else np.zeros(0, U64)
        words = [at_place[b].astype(U64) for b in begin]
        whole = data.tobytes()
        for length, mask, table, known, number in self.groups:
            masked = words[length > 1] & mask
            kept = np.flatnonzero(table[self._slot(masked)])
            place, found = begin[length > 1][kept], masked[kept]
            text = np.searchsorted(at, place, side="right") - 1
            inside = place + length <= at[text + 1]
            place, found, text = place[inside], found[inside], text[inside]
            low, high = np.searchsorted(known, found), np.searchsorted(known, found, side="right")
            if length <= 8:
                hit = high > low
                marks[text[hit], number[low[hit]]] = True
                continue
            for p, t, a, b in zip(place, text, low, high, strict=True):
                for i in number[a:b]:
                    if not marks[t, i] and whole[p : p + length] == self.raw[i]:
                        marks[t, i] = True
        return marks
