"""SentencePiece encoding and decoding by a weighted finite-state transducer.

A model file compiles into transducers that are composed with each input:

* the normaliser puts out U+2581 for a space and one before a text; where the model asks for it, it drops spaces at the
  ends and all but one of a run;
* the pieces are a trie whose accepting paths put out a piece at the cost of its negated score;
* byte fallback puts out the UTF-8 bytes (or the unknown id) of a character that no piece is, at ten over the greatest
  cost of a piece;
* for a model of merges (BPE) a filter composes with the pieces: its state is the last piece, and a next piece that
  merging would not leave beside it costs infinity. Segmentations whose neighbours are all stable are exactly what the
  merges give, so one path of finite cost leads to each position.

The composition is a lattice over the positions of the input. Its shortest path in the tropical semiring, least sum, is
found by relaxing the arcs position by position; of equal sums the first relaxed, of the longest last piece, stays. So
unigram models, where the sum decides, and models of merges go the same way.

Compiling finds the pairs of bytes that an arc crosses; inputs are cut at all others, such as before a run of U+2581 or
between a letter and a sign, into words, and a word that was seen before is not composed again: words are told by 64-bit hashes, looked up once for each slice of text,
and their ids are gathered. Texts of any length are encoded whole, in time in proportion to it. Sums start anew at each
word; the library adds over a whole text, which can only differ where two sums are equal but for rounding.

Defined results: a null or empty text has no ids and decodes to the empty text; text that holds U+2581 itself decodes
to a space there, as the model's format has it; repeated rows and rows with a null id are encoded one by one; other columns of the documents
pass unchanged but for ``ids``, which is set; ids out of range raise; byte ids that aren't UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table
from .kernels import U64, mix, slices, span_hashes

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, MERGES = 1, 2
#: Entries of a cache, and ids that the cache of words holds at most between slices.
CACHE, CACHED_IDS = 300_000, 2_000_000
#: Places of the table of pairs of pieces.
PAIRS = 1 << 19
#: Words of at most so many bytes are composed many at a time.
COMPOSED = 40
#: What an unknown character costs over the dearest piece; fixed by the format.
UNKNOWN_COST = 10.0
INFINITY = float("inf")
#: Ids that are decoded at a time.
DECODED = 500_000
#: Columns that encoding and decoding add.
IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))
DECODED_FIELDS = [T.StructField("decoded", T.StringType()), T.StructField("ids_sha256", T.StringType())]


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protocol buffer message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, raw[at : at + size]
            at += size


class Transducer:
    """A compiled model."""

    def __init__(self, model: bytes):
        self.texts: list[str] = []
        self.kinds: list[int] = []
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        kind_of_model, normaliser = UNIGRAM, {}
        for number, value in fields(model):
            if number == 1:
                piece = dict(fields(value))
                text, kind = piece[1].decode(), piece.get(3, NORMAL)
                if kind in (NORMAL, USER):
                    self.ids[text] = len(self.texts)
                    self.score[text] = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                self.texts.append(text)
                self.kinds.append(kind)
            elif number == 2:
                kind_of_model = dict(fields(value)).get(3, kind_of_model)
            elif number == 3:
                normaliser |= dict(fields(value))
        if kind_of_model not in (UNIGRAM, MERGES) or USER in self.kinds:
            raise ValueError("only unigram models and models of merges without user-defined symbols are compiled")
        if normaliser.get(2) or not normaliser.get(5, 1):
            raise ValueError("only the identity normaliser that marks spaces is compiled")
        self.squeeze, self.prefix = bool(normaliser.get(4, 1)), bool(normaliser.get(3, 1))
        self.merges = kind_of_model == MERGES
        self.byte_ids = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(self.texts, self.kinds, strict=True)) if k == BYTE}
        self.unknown = self.kinds.index(UNKNOWN)
        self._edges: dict[str, tuple[list, list]] = {}
        # Of the trie's paths: the cost of the piece that may end there, else None. Merging gives only some pieces.
        self.trie: dict[str, float | None] = {t[:n]: None for t in self.ids for n in range(1, len(t) + 1)}
        self.trie |= {t: -score for t, score in self.score.items() if not self.merges or len(self.merged(t)) == 1}
        self.fallback_cost = UNKNOWN_COST - min(self.score.values(), default=0.0)
        self._cutter()
        self._byte_trie()
        output = [self._bytes(i) for i in range(len(self.texts))]
        self.output = np.frombuffer(b"".join(output), np.uint8)
        self.output_at = np.concatenate(([0], np.cumsum([len(x) for x in output])))
        self._stable: dict[tuple[str, str], bool] = {}
        self.forget()

    def _cutter(self) -> None:
        """Pairs of bytes (a space for U+2581) that some arc crosses. Where no arc crosses, a text may be cut; without byte
        fallback unknown neighbours are one id, so only a known U+2581 may begin a word."""
        self.crossed = np.zeros((256, 256), dtype=bool)
        for t in self.ids:
            raw = np.frombuffer(t.replace(SPACE, " ").encode(), np.uint8)
            self.crossed[raw[:-1], raw[1:]] = True
        self.crossed[:, 0x80:0xC0] = True  # within a character
        if not self.byte_ids:
            self.crossed[:, [b for b in range(256) if b != 32 or SPACE not in self.ids]] = True

    def _byte_trie(self) -> None:
        """The pieces' trie over bytes, with a space for U+2581: an arc's key is its node and byte; nodes are in the order
        of the arcs' keys, and a node at which a piece ends has its id and cost."""
        names = {t.replace(SPACE, " ").encode(): t for t, cost in self.trie.items() if cost is not None}
        prefixes = sorted({t[:n] for t in names for n in range(len(t) + 1)} | {b""}, key=lambda t: (len(t), t))
        number = {t: i for i, t in enumerate(prefixes)}
        keys = np.array([number[t[:-1]] << 8 | t[-1] for t in prefixes[1:]], np.int64)
        order = np.argsort(keys)
        self.arc_keys, self.arc_ends = keys[order], order + 1
        self.node_piece = np.array([self.ids[names[t]] if t in names else -1 for t in prefixes])
        self.node_cost = np.array([self.trie[names[t]] if t in names else INFINITY for t in prefixes])

    def _bytes(self, i: int) -> bytes:
        if self.kinds[i] == BYTE:
            return bytes([int(self.texts[i][3:5], 16)])
        if self.kinds[i] == UNKNOWN:
            return " ⁇ ".encode()
        return b"" if self.kinds[i] == CONTROL else self.texts[i].replace(SPACE, " ").encode()

    def merged(self, text: str) -> list[str]:
        """A short text under the model's merges: always the best pair, of equal ones the first."""
        parts = list(text)
        while len(parts) > 1:
            scores = [self.score.get(a + b, -INFINITY) for a, b in zip(parts, parts[1:], strict=False)]
            best = max(scores)
            if best == -INFINITY:
                break
            i = scores.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def edges(self, piece: str) -> tuple[list, list]:
        """How a piece's two ends grow while it is merged alone: for each merge its score, and the last part after it
        (for the piece as left neighbour) or the first part (as right neighbour); at the start, and at the end with
        no score, the parts as they are."""
        if piece not in self._edges:
            if len(self._edges) > CACHE:
                self._edges.clear()
            parts = list(piece)
            left, right = [parts[-1]], [parts[0]]
            scores = []
            while len(parts) > 1:
                found = [self.score.get(a + b, -INFINITY) for a, b in zip(parts, parts[1:], strict=False)]
                best = max(found)
                i = found.index(best)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                scores.append(best)
                left.append(parts[-1])
                right.append(parts[0])
            scores.append(-INFINITY)
            self._edges[piece] = list(zip(scores, left, strict=True)), list(zip(scores, right, strict=True))
        return self._edges[piece]

    def stable(self, left: str, right: str) -> bool:
        """Whether merging leaves these two pieces side by side: both are merged in step, and no merge over their
        border may ever be the best. Of equal merges the first in the text is taken."""
        known = self._stable.get((left, right))
        if known is None:
            ours, theirs = self.edges(left)[0], self.edges(right)[1]
            i = j = 0
            known = True
            while True:
                (mine, a), (other, b) = ours[i], theirs[j]
                border = self.score.get(a + b)
                if border is not None and border > mine and border >= other:
                    known = False
                    break
                if mine == other == -INFINITY:
                    break
                if mine >= other:
                    i += 1
                else:
                    j += 1
            if len(self._stable) > CACHE * 4:
                self._stable.clear()
            self._stable[left, right] = known
        return known

    def forget(self) -> None:
        """Drops the caches."""
        self._stable, self._edges = {}, {}
        #: Pairs of pieces that the filter was asked for, as one number each, and what it says.
        self._pairs, self._allowed = np.full(PAIRS, -1), np.zeros(PAIRS, dtype=bool)
        #: Number of each word that was seen, the ids of all in turn, and where each word's ids begin.
        self._words: dict[int, int] = {}
        self._pool, self._begin, self._held = [], [], 0

    def arcs(self, text: str, i: int) -> list[tuple[int, str, float]]:
        """End, piece and cost of the arcs that leave a position of the lattice; a character that no piece is has one."""
        trie, out, single = self.trie, [], False
        for j in range(i + 1, len(text) + 1):
            cost = trie.get(text[i:j], INFINITY)
            if cost is not None:
                if cost == INFINITY:
                    break
                out.append((j, text[i:j], cost))
                single |= j == i + 1
        if not single:
            out.append((i + 1, text[i : i + 1], self.fallback_cost))
        return out

    def shortest_path(self, text: str) -> list[str]:
        """The pieces of the least-cost path of one word composed with the transducer: each position keeps its least cost
        and the arc that it came by."""
        n = len(text)
        cost, came, last = [INFINITY] * (n + 1), [0] * (n + 1), [""] * (n + 1)
        cost[0] = 0.0
        known, stable, merges = self._stable, self.stable, self.merges
        for i in range(n):
            if cost[i] == INFINITY:
                continue
            for j, piece, weight in self.arcs(text, i):
                if merges and i:
                    ok = known.get((last[i], piece))
                    if not (stable(last[i], piece) if ok is None else ok):
                        continue  # the filter's weight is infinite
                total = cost[i] + weight
                if total < cost[j]:
                    cost[j], came[j], last[j] = total, i, piece
        path = []
        while n:
            path.append(last[n])
            n = came[n]
        return path[::-1]

    def word_ids(self, word: str) -> list[int]:
        """The ids that a word's path puts out."""
        found: list[int] = []
        for piece in self.shortest_path(word):
            if piece in self.ids:
                found.append(self.ids[piece])
            elif self.byte_ids:
                found.extend(self.byte_ids[b] for b in piece.encode())
            elif not found or found[-1] != self.unknown:
                found.append(self.unknown)
        return found

    def beside(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What the filter says of pairs of pieces. A table holds one pair at each place, so most are looked up at once."""
        pairs = left * len(self.texts) + right
        place = (mix(pairs.astype(U64)) & U64(PAIRS - 1)).astype(np.int64)
        missed = np.flatnonzero(self._pairs[place] != pairs)
        if len(missed):
            asked, first = np.unique(pairs[missed], return_index=True)
            at, n = place[missed][first], len(self.texts)
            said = np.array([self.stable(self.texts[x // n], self.texts[x % n]) for x in asked.tolist()])
            ok = self._allowed[place]
            self._pairs[at], self._allowed[at] = asked, said
            ok[missed] = said[np.searchsorted(asked, pairs[missed])]
            return ok
        return self._allowed[place]

    def compose(self, words: list[bytes]) -> list[np.ndarray | None]:
        """The ids of many short words: the lattices of all are relaxed together, position by position, as in
        ``shortest_path``. None where a path of pieces alone doesn't reach the end, or isn't sure to be the least."""
        n = np.array([len(w) for w in words])
        wide = int(n.max())
        text = np.frombuffer(b"".join(w.ljust(wide, b"\0") for w in words), np.uint8).reshape(len(words), wide)
        cost, came, last = np.full((len(words), wide + 1), INFINITY), np.zeros((len(words), wide + 1), np.int64), np.full((len(words), wide + 1), -1)
        cost[:, 0] = 0.0
        sure = np.ones(len(words), dtype=bool)
        for i in range(wide):
            row = np.flatnonzero((cost[:, i] < INFINITY) & (n > i))
            node, j = np.zeros(len(row), np.int64), i
            single = np.zeros(len(words), dtype=bool)
            first = text[row, i]
            reach = i + 1 + (first >= 0xC0).astype(np.int64) + (first >= 0xE0) + (first >= 0xF0)
            asked = row
            while len(row) and j < wide:
                key = node << 8 | text[row, j]
                at = np.minimum(np.searchsorted(self.arc_keys, key), len(self.arc_keys) - 1)
                j += 1
                found = (self.arc_keys[at] == key) & (n[row] >= j)
                row, node, reach_ = row[found], self.arc_ends[at[found]], reach[found]
                reach = reach_
                ends = self.node_piece[node] >= 0
                mine, piece, weight = row[ends], self.node_piece[node[ends]], self.node_cost[node[ends]]
                single[mine[reach[ends] == j]] = True
                if self.merges and i and len(mine):
                    ok = self.beside(last[mine, i], piece)
                    mine, piece, weight = mine[ok], piece[ok], weight[ok]
                total = cost[mine, i] + weight
                better = total < cost[mine, j]
                mine = mine[better]
                cost[mine, j], came[mine, j], last[mine, j] = total[better], i, piece[better]
            sure[asked[~single[asked]]] = False  # byte fallback takes part here
        place, steps = n.copy(), []
        sure &= cost[np.arange(len(words)), n] < INFINITY
        while (place > 0).any():
            steps.append(np.where(place > 0, last[np.arange(len(words)), place], -1))
            place = came[np.arange(len(words)), place]
        paths = np.stack(steps[::-1], axis=1)
        sizes = (paths >= 0).sum(axis=1)
        return [p[-k:].astype(np.int32) if ok else None for p, k, ok in zip(paths, sizes.tolist(), sure.tolist(), strict=True)]

    def normalise(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The input as the normaliser puts it out, but with one byte, a space, for U+2581."""
        mark = SPACE.encode()
        raw = data.tobytes()
        if self.squeeze or mark in raw:
            texts = [raw[a:b] for a, b in zip(at, at[1:], strict=False)]
            texts = [re.sub(b" +", b" ", t.strip(b" ")) for t in texts] if self.squeeze else texts
            texts = [t.replace(mark, b" ") for t in texts]
            texts = [t.rstrip(b" ") for t in texts] if self.squeeze else texts
            data, at = np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
        if self.prefix:
            some = np.diff(at) > 0
            data, at = np.insert(data, at[:-1][some], 32), at + np.concatenate(([0], np.cumsum(some)))
        return data, at

    def cuts(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the words of normalised texts begin."""
        new = np.zeros(len(data), dtype=bool)
        new[1:] = ~self.crossed[data[:-1], data[1:]]
        new[at[:-1][np.diff(at) > 0]] = True
        return np.flatnonzero(new)

    def encode_batch(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a slice, and where each text's begin."""
        data, at = self.normalise(data, at)
        start = self.cuts(data, at)
        end = np.append(start[1:], len(data))
        hashes, first, inverse = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
        if self._held > CACHED_IDS or len(self._words) > CACHE:
            self.forget()
        numbers = np.array([self._words.get(h, -1) for h in hashes.tolist()], np.int64)
        new = np.flatnonzero(numbers < 0)
        size = (end - start)[first]
        short = new[size[new] <= COMPOSED]
        short = short[np.argsort(size[short], kind="stable")]
        for part in np.array_split(short, 1 + len(short) // 8192) if len(short) else ():
            words = [data[start[i] : end[i]].tobytes() for i in first[part]]
            for k, ids in zip(part.tolist(), self.compose(words), strict=True):
                if ids is not None:
                    numbers[k] = self._learn(hashes[k], ids)
        for k in new[numbers[new] < 0].tolist():
            word = data[start[first[k]] : end[first[k]]].tobytes().decode("utf-8", "replace").replace(" ", SPACE)
            numbers[k] = self._learn(hashes[k], np.array(self.word_ids(word), np.int32))
        if len(self._pool) > 1:
            self._pool = [np.concatenate(self._pool)]
        begin = np.array([*self._begin, self._held])
        pool = self._pool[0] if self._pool else np.zeros(0, np.int32)
        out, ends = gathered(pool, begin, numbers[inverse])
        return out, ends[np.searchsorted(start, at)]

    def _learn(self, key: np.uint64, ids: np.ndarray) -> int:
        number = self._words[int(key)] = len(self._begin)
        self._begin.append(self._held)
        self._pool.append(ids)
        self._held += len(ids)
        return number

    def decode_batch(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        """The texts of runs of ids."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.texts)):
            raise ValueError("an id is out of the model's range")
        out, ends = gathered(self.output, self.output_at, ids)
        raw, cuts = out.tobytes(), ends[at]
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:], strict=False)]
        if not (self.prefix or self.squeeze):
            return texts
        if self.squeeze:  # pieces of a space alone go from the beginning, and one space of the next piece
            lone = self.ids.get(SPACE, -1)
            for i, (a, b) in enumerate(zip(at, at[1:], strict=False)):
                while a < b and ids[a] == lone:
                    a, texts[i] = a + 1, texts[i][1:]
        return [t[1:] if t.startswith(" ") else t for t in texts]

    def encode(self, text: str) -> list[int]:
        data = np.frombuffer(text.encode(), np.uint8)
        return self.encode_batch(data, np.array([0, len(data)]))[0].tolist()

    def decode(self, ids: Iterable[int]) -> str:
        ids = np.array(list(ids), np.int64)
        return self.decode_batch(ids, np.array([0, len(ids)]))[0]


def gathered(pool: np.ndarray, begin: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of a pool with these numbers, end to end, and where each begins (and the last ends)."""
    size = (begin[1:] - begin[:-1])[which]
    ends = np.concatenate(([0], np.cumsum(size)))
    return pool[np.repeat(begin[which] - ends[:-1], size) + np.arange(ends[-1])], ends


_compiled: dict[bytes, Transducer] = {}


def compiled(model: bytes) -> Transducer:
    """A worker compiles a model once, for all its tasks."""
    key = hashlib.sha256(model).digest()
    if key not in _compiled:
        _compiled.clear()
        _compiled[key] = Transducer(model)
    return _compiled[key]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _sent(spark: SparkSession, path: str | None) -> Callable[[], Transducer]:
    with open(path or default_model(), "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())
    return lambda: compiled(sent.value)


def _encoded(model: Transducer, batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch, data, at in slices(batches, column):
        ids, ends = model.encode_batch(data, at)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))], names=[*batch.schema.names, "ids"])


def encode_pieces(docs: DataFrame, model_path: str | None = None, text_column: str = "text") -> DataFrame:
    """All columns of docs, and ids (array of int). The model file, of some megabytes at most, is read by the driver
    and broadcast."""
    get = _sent(docs.sparkSession, model_path)
    docs = docs.drop("ids")
    return docs.mapInArrow(lambda it: _encoded(get(), it, text_column), T.StructType([*docs.schema.fields, IDS]))


def _id_parts(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch of at most ``DECODED`` ids, or one row; with the ids and where each row's begin."""
    lists = batch.column(column).cast(pa.list_(pa.int32()))
    if lists.null_count:
        lists = pa.array([x or [] for x in lists.to_pylist()], pa.list_(pa.int32()))
    at, ids = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy(zero_copy_only=False)
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(at, at[low] + DECODED, side="right")) - 1)
        yield batch.slice(low, high - low), ids[at[low] : at[high]], at[low : high + 1] - at[low]
        low = high


def _decoded(model: Transducer, batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, ids, at in _id_parts(batch, column):
            texts, raw = model.decode_batch(ids, at), ids.astype("<i4").tobytes()
            hashes = [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string()), pa.array(hashes, pa.string())], names=[*part.schema.names, "decoded", "ids_sha256"])


def decode_pieces(encoded: DataFrame, model_path: str | None = None, ids_column: str = "ids") -> DataFrame:
    """All columns of the frame, decoded (string) and ids_sha256 (hex, of the ids as 32-bit little-endian integers)."""
    get = _sent(encoded.sparkSession, model_path)
    encoded = encoded.drop("decoded", "ids_sha256")
    return encoded.mapInArrow(lambda it: _decoded(get(), it, ids_column), T.StructType([*encoded.schema.fields, *DECODED_FIELDS]))


def round_trip(docs: DataFrame, model_path: str | None = None, text_column: str = "text") -> DataFrame:
    """``decode_pieces(encode_pieces(docs))`` in one pass. Two passes in one stage hold two Python workers for each core,
    each with a model and batches of its own, and workers keep their memory for the stages that follow."""
    get = _sent(docs.sparkSession, model_path)
    docs = docs.drop("ids", "decoded", "ids_sha256")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = get()
        return _decoded(model, _encoded(model, batches, text_column), "ids")

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, IDS, *DECODED_FIELDS]))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), same.alias("round_trip"))


SQL = None
