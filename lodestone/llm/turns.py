"""Conversation structure repair as a composition of weighted finite-state machines.

A conversation's rows are an input acceptor; an edit transducer keeps a row (0), gives it another role (3), deletes it
(4) or inserts one without text (3); an acceptor of role initials holds the grammar ``(s?(ua)+)?``. The three are composed
lazily: a state is (rows read, state of the grammar), and only arcs that the next row and the grammar allow are made.
Weights are (cost, edits' initials): the lesser cost wins, then the lesser string. Of two paths between the same states
with one cost neither string is a proper prefix of the other (it would cost an insertion less), so what follows both
can't turn their order round, and the semiring's shortest path may be taken state by state. States are relaxed from the
last row to the first, so a string grows at its front: two strings are then compared by their first initials and the rank
of what follows, never letter by letter. The relaxation of a row depends on its kind and on the weights behind it less
their least, so each such step is worked out once and looked up from then on.

Rows are sorted by range over conversation, turn, role and text, so a conversation of any length is dealt over as many
tasks as its rows ask for, and cut into pieces of at most ``PIECE_ROWS`` rows. A piece that certainly holds a whole
conversation is repaired at once. Of any other the matrix of weights (grammar state before, after) is kept; matrices of a
conversation are multiplied from the last to the first, which gives each piece its edits. What is gathered of a
conversation there is some 20 bytes a row, and SHA-256, which can't be computed in parts, takes its pieces one after the
other, as a stream in bounded memory. Texts said in several pieces are found by an aggregate over (conversation, hash).

Defined results: a null conv_id is a conversation of its own; a null role or text is one space, and in what ``damage``
hashes so are a null conv_id and turn; rows of one turn are ordered by role and then text; rows of all four the same are
adjacent, and those after the first are duplicates; a role of no characters can't be kept. Any turn may be missing or
repeat. An empty table gives an empty one; other columns, whatever their names, aren't read. Equality of role and text
across pieces is equality of SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, dealt, input_bytes, table

#: States of the grammar are its start, and after s, u and a; where each initial leads from each of them.
START, S, U, A = range(4)
STEPS = ({"s": S, "u": U}, {"u": U}, {"a": A}, {"u": U})
ACCEPTS = (START, A)
STEPS_ON = {"s", "u", "a"}
#: What edits cost, and what keeping or renaming a truncated row adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
ROLE = {"u": "user", "a": "assistant"}
#: A row's fault.
FINE, CUT, GONE = range(3)

PIECE_ROWS, PIECE_CHARS = 4096, 4 << 20
#: Rows that a task of the sort takes, as bytes of input.
TASK_BYTES = 32 << 20
#: A weight, less the cost of all others: (cost, rank of its string), or None where no path leads on.
Weight = tuple[int, int]


def _inserts() -> list[list[tuple[int, int]]]:
    """From each state of the grammar, the states that insertions lead to and how few do."""
    out = []
    for state in range(4):
        seen, now, n = {state: 0}, [state], 0
        while now:
            n += 1
            now = [t for s in now for c, t in STEPS[s].items() if c in ROLE and t not in seen]
            seen.update(dict.fromkeys(now, n))
        out.append(sorted(seen.items()))
    return out


INSERTS = _inserts()


@lru_cache(maxsize=1 << 16)
def relax(initial: str, fault: int, after: tuple[Weight | None, ...]) -> tuple[tuple[Weight | None, ...], int, tuple[tuple | None, ...]]:
    """Weights before a row, from those after it: costs less their least, and that least; and for each state of the
    grammar the best arcs: how many insertions, the edit, the state after the row."""
    found: list[tuple | None] = []
    for state in range(4):
        best = None
        for there, n in INSERTS[state]:
            arcs = [("D", DELETE, there)]
            if fault != GONE:
                more = TRUNCATED if fault == CUT else 0
                arcs += [("K", KEEP + more, STEPS[there][initial])] if initial in STEPS[there] else []
                arcs += [("R", REROLE + more, t) for c, t in STEPS[there].items() if c in ROLE]
            for edit, cost, to in arcs:
                if after[to] is not None:
                    way = (n * INSERT + cost + after[to][0], "I" * n + edit, after[to][1], to)
                    best = way if best is None or way < best else best
        found.append(best)
    order = sorted({w[1:3] for w in found if w is not None})
    least = min((w[0] for w in found if w is not None), default=0)
    weights = tuple(None if w is None else (w[0] - least, order.index(w[1:3])) for w in found)
    return weights, least, tuple(None if w is None else (w[1], w[3]) for w in found)


def last_weights() -> tuple[tuple[Weight | None, ...], list[str]]:
    """After the last row insertions may still be made until the grammar accepts."""
    tails = [min(n for t, n in INSERTS[s] if t in ACCEPTS) for s in range(4)]
    return tuple((INSERT * n, n) for n in tails), ["I" * n for n in tails]


def shortest(rows: list[tuple[str, int]], after: tuple[Weight | None, ...]) -> list[tuple[int, str, int] | None]:
    """For each state of the grammar before the rows (initial, fault): cost, edits, and the state after them."""
    layers, base = [], 0
    for initial, fault in reversed(rows):
        after, least, arcs = relax(initial, fault, after)
        base += least
        layers.append(arcs)
    out: list[tuple[int, str, int] | None] = []
    for state in range(4):
        if after[state] is None:
            out.append(None)
            continue
        edits, now = [], state
        for arcs in reversed(layers):
            edit, now = arcs[now]
            edits.append(edit)
        out.append((base + after[state][0], "".join(edits), now))
    return out


def times(rows: list[tuple[str, int]]) -> list[list[tuple[int, str] | None]]:
    """The matrix of a piece: for each state before and after it the best (cost, edits)."""
    columns = [shortest(rows, tuple((0, 0) if s == after else None for s in range(4))) for after in range(4)]
    return [[None if c[before] is None else c[before][:2] for c in columns] for before in range(4)]


def repaired(rows: list[tuple[str, str]], audit: str, state: int) -> tuple[list[str], list[str]]:
    """Roles and texts of the rows that the edits leave or make, from this state of the grammar on."""
    roles, texts, at = [], [], 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else rows[at]
        at += edit != "I"
        if edit == "D":
            continue
        if edit != "K":
            role = ROLE["a" if state == U else "u"]
        state = STEPS[state][role[:1]]
        roles.append(role)
        texts.append(text)
    return roles, texts


LEGAL = {"su", "ua", "au"}


class Piece:
    """Rows of one conversation, in order: turn, role, text; what is counted of them, and which were said before."""

    def __init__(self, rows: list[tuple[int | None, str, str]], before: Iterable[bytes] = ()):
        self.rows, seen = [(r, t) for _, r, t in rows], set(before)
        self.initials = [r[:1] for r, _ in self.rows]
        self.faults, self.blank, self.duplicate, self.truncated = [], 0, 0, 0
        for role, text in self.rows:
            key, shown = said(role, text), text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")
            if not shown:
                fault, self.blank = GONE, self.blank + 1
            elif key in seen:
                fault, self.duplicate = GONE, self.duplicate + 1
            elif shown[-1] not in ".!?":
                fault, self.truncated = CUT, self.truncated + 1
            else:
                fault = FINE
            seen.add(key)
            self.faults.append(fault)
        self.illegal = sum(a + b not in LEGAL for a, b in zip(self.initials, self.initials[1:], strict=False))
        self.turns = [t for t, _, _ in rows if t is not None]
        self.distinct = len(set(self.turns))

    def steps(self) -> list[tuple[str, int]]:
        return [(i if i in STEPS_ON else "", f) for i, f in zip(self.initials, self.faults, strict=True)]


def said(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def damage(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of conversations with faults put in, by crc32 of ``conv_id:turn`` modulo 20; a row that
    is dropped stays as a mark of its conversation, with ``here`` false."""
    words = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.concat_ws(":", words("conv_id"), words("turn")).cast("binary")), F.lit(20))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), words("role").alias("role"), words("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault").isin(0, 1), "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("fault") != 0).alias("here"), "fault")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("fault") == 3).cast("int")))).drop("fault", "copy")


PIECE_SCHEMA = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("whole", pa.bool_()), ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])
PIECES = "conv_id long, piece long, whole boolean, turns array<long>, roles array<string>, texts array<string>"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
#: What is said of a conversation, beside its first piece.
SAID = "".join(f", {c} long" for c in COUNTS) + ", audit string"
SAID_FIELDS = [*[(c, pa.int64()) for c in COUNTS], ("audit", pa.string())]
REPAIRED = "conv_id long, piece long, roles array<string>, texts array<string>" + SAID
REPAIRED_SCHEMA = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), *SAID_FIELDS])
REPORT = "conv_id long" + SAID + ", repaired_sha256 string"
REPORT_SCHEMA = pa.schema([("conv_id", pa.int64()), *SAID_FIELDS, ("repaired_sha256", pa.string())])


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def of_batch(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows one by one, so that only one piece is in Python's memory."""
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in batch.columns)


def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of a sorted partition. One is surely whole if its conversation neither begins nor ends the partition and
    wasn't cut; the numbers of pieces rise in the order of the sort."""
    number, done, held = TaskContext.get().partitionId() << 40, [], 0
    conv, rows, chars, begins, was_cut, some = None, [], 0, True, False, False

    def close(whole: bool) -> None:
        nonlocal number, rows, chars, held
        turns, roles, texts = zip(*rows, strict=True) if rows else ((), (), ())
        done.append((conv, number, whole, turns, roles, texts))
        number, held, rows, chars = number + 1, held + chars, [], 0

    for batch in batches:
        for one, turn, role, text, here in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "here")), strict=True):
            if some and one != conv:
                close(not begins and not was_cut)
                begins = was_cut = False
            conv, some = one, True
            if len(rows) >= PIECE_ROWS or chars > PIECE_CHARS:
                close(False)
                was_cut = True
            if here:
                rows.append((turn, role, text))
                chars += len(text) + len(role)
            if held > PIECE_CHARS or len(done) >= 1000:
                yield batch_of(done, PIECE_SCHEMA)
                done, held = [], 0
    if some:
        close(False)
        yield batch_of(done, PIECE_SCHEMA)


def repair_whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    after, tails = last_weights()
    for batch in batches:
        out = []
        for conv, piece, turns, roles, texts in of_batch(batch):
            p = Piece(list(zip(turns, roles, texts, strict=True)))
            cost, audit, state = shortest(p.steps(), after)[START]
            audit += tails[state]
            gaps = max(p.turns) - min(p.turns) + 1 - p.distinct if p.turns else 0
            out.append((conv, piece, *repaired(p.rows, audit, START), gaps, p.blank, p.duplicate, p.truncated, p.illegal, cost, audit))
        yield batch_of(out, REPAIRED_SCHEMA)


MATRIX = "conv_id long, piece long, blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, n_turns long, costs array<long>, edits array<string>"
MATRIX_SCHEMA = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")], ("first", pa.string()), ("last", pa.string()), *[(c, pa.int64()) for c in ("low", "high", "n_turns")], ("costs", pa.list_(pa.int64())), ("edits", pa.list_(pa.string()))])


def matrices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pieces with ``before``: the hashes that earlier pieces of the conversation have too."""
    for batch in batches:
        out = []
        for conv, piece, turns, roles, texts, before in of_batch(batch):
            if texts:
                p = Piece(list(zip(turns, roles, texts, strict=True)), before or ())
                weights = [w for line in times(p.steps()) for w in line]
                out.append((conv, piece, p.blank, p.duplicate, p.truncated, p.illegal, p.initials[0], p.initials[-1], min(p.turns, default=None), max(p.turns, default=None), p.distinct, [None if w is None else w[0] for w in weights], [None if w is None else w[1] for w in weights]))
            else:
                out.append((conv, piece, 0, 0, 0, 0, None, None, None, None, 0, None, None))
        yield batch_of(out, MATRIX_SCHEMA)


FOLDED = "conv_id long, piece long, state int, edits string" + SAID
FOLDED_SCHEMA = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("state", pa.int32()), ("edits", pa.string()), *SAID_FIELDS])


def fold(rows: pa.Table) -> pa.Table:
    """Matrices of one conversation multiplied; the edits of each piece, and beside the first the whole's numbers."""
    rows = rows.sort_by("piece").to_pylist()
    _, tails = last_weights()
    full = [r for r in rows if r["edits"] is not None]
    best: list[tuple | None] = [(INSERT * len(tail), tail) for tail in tails]
    chosen: list[list[int | None]] = []
    for row in reversed(full):
        ways = [[(row["costs"][4 * a + b] + best[b][0], row["edits"][4 * a + b] + best[b][1], b) for b in range(4) if row["edits"][4 * a + b] is not None and best[b] is not None] for a in range(4)]
        least = [min(w, default=None) for w in ways]
        best, chosen = [w and w[:2] for w in least], [*chosen, [w and w[2] for w in least]]
    cost, audit = best[START]
    state, edits = START, {}
    for row, to in zip(full, reversed(chosen), strict=True):
        edits[row["piece"]] = (state, row["edits"][4 * state + to[state]])
        state = to[state]
    if full:
        last = full[-1]["piece"]
        edits[last] = (edits[last][0], edits[last][1] + tails[state])
    turned = [r for r in full if r["low"] is not None]
    shared = sum(a["high"] == b["low"] for a, b in zip(turned, turned[1:], strict=False))
    gaps = turned[-1]["high"] - turned[0]["low"] + 1 - sum(r["n_turns"] for r in turned) + shared if turned else 0
    joints = sum(a["last"] + b["first"] not in LEGAL for a, b in zip(full, full[1:], strict=False))
    whole = (gaps, *[sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated")], sum(r["illegal"] for r in rows) + joints, cost, audit)
    return pa.Table.from_batches([batch_of([(r["conv_id"], r["piece"], *edits.get(r["piece"], (START, "")), *(whole if i == 0 else (None,) * 7)) for i, r in enumerate(rows)], FOLDED_SCHEMA)])


def repair_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with the edits that the fold has found for them."""
    for batch in batches:
        yield batch_of([(conv, piece, *repaired(list(zip(roles, texts, strict=True)), edits, state), *rest) for conv, piece, roles, texts, state, edits, *rest in of_batch(batch)], REPAIRED_SCHEMA)


def repair(turns: DataFrame, tasks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Two tables of conv_id, piece, roles, texts and, beside the first piece of a conversation, gaps, blank, duplicate,
    truncated, illegal, cost, audit. In the first each row is a whole conversation; in the second a conversation's rows
    follow each other by piece. ``repaired_turns`` makes rows of both.

    turns: conv_id, turn, role, text (the last two without nulls), here (false: the row only names its conversation)."""
    spark = turns.sparkSession
    tasks = tasks or max(int(spark.conf.get("spark.sql.shuffle.partitions")), input_bytes(turns) // TASK_BYTES)
    order = ["conv_id", "turn", "role"]
    with Scratch() as scratch:
        rows = turns.select(*order, "text", "here").repartitionByRange(tasks, *order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
        pieces = scratch.keep(scratch.written(rows.mapInArrow(cut, PIECES), "pieces"))
    whole = pieces.filter("whole").select("conv_id", "piece", "turns", "roles", "texts").mapInArrow(repair_whole, REPAIRED)
    parts = pieces.filter("NOT whole").drop("whole").withColumn("conv", F.struct(F.isnull("conv_id"), F.coalesce("conv_id", F.lit(0))))
    said = F.sha2(F.concat(F.char_length("p.roles").cast("string"), F.lit(":"), F.col("p.roles"), F.col("p.texts")).cast("binary"), 256)
    each = parts.select("conv", "piece", F.explode(F.arrays_zip("roles", "texts")).alias("p")).select("conv", "piece", F.unhex(said).alias("said")).distinct()
    known = each.groupBy("conv", "said").agg(F.min("piece").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    before = each.join(dealt(known), ["conv", "said"]).filter("piece > first").groupBy("piece").agg(F.collect_list("said").alias("before"))
    parts = parts.select("conv_id", "piece", "turns", "roles", "texts")
    folded = parts.join(dealt(before), "piece", "left").select(*parts.columns, "before").mapInArrow(matrices, MATRIX).groupBy("conv_id").applyInArrow(fold, FOLDED)
    ways = parts.drop("turns").join(dealt(folded.drop("conv_id")), "piece").select("conv_id", "piece", "roles", "texts", "state", "edits", *[c for c, _ in SAID_FIELDS])
    return whole, ways.mapInArrow(repair_parts, REPAIRED)


def repaired_turns(whole: DataFrame, parts: DataFrame) -> DataFrame:
    """conv_id, piece, place, role, text: the rows of the repaired conversations, in the order of piece and place."""
    rows = whole.unionByName(parts).select("conv_id", "piece", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "row"))
    return rows.select("conv_id", "piece", "place", F.col("row.roles").alias("role"), F.col("row.texts").alias("text"))


def lines(roles: str = "roles", texts: str = "texts") -> Column:
    """The repaired rows as ``role:text``, newline-joined."""
    return F.array_join(F.zip_with(roles, texts, lambda r, t: F.concat(r, F.lit(":"), t)), "\n")


def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pieces sorted by conversation: one running hash after the other; a piece is all that is held."""
    conv, held, running, wrote = None, None, hashlib.sha256(), False
    for batch in batches:
        out = []
        for one, n, text, *whole in of_batch(batch):
            if whole[0] is not None:  # the first piece of a conversation
                if held is not None:
                    out.append((conv, *held, running.hexdigest()))
                conv, held, running, wrote = one, whole, hashlib.sha256(), False
            if n:
                running.update(("\n" * wrote + text).encode())
                wrote = True
        yield batch_of(out, REPORT_SCHEMA)
    if held is not None:
        yield batch_of([(conv, *held, running.hexdigest())], REPORT_SCHEMA)


def report(whole: DataFrame, parts: DataFrame) -> DataFrame:
    """conv_id, the numbers of ``repair``, audit, and repaired_sha256 of the lines of each conversation."""
    numbers = [c for c, _ in SAID_FIELDS]
    at_once = whole.select("conv_id", *numbers, F.sha2(lines().cast("binary"), 256).alias("repaired_sha256"))
    streams = parts.select("conv_id", "piece", F.size("roles").alias("n"), lines().alias("text"), *numbers).repartition("conv_id").sortWithinPartitions("conv_id", "piece").drop("piece")
    return at_once.unionByName(streams.mapInArrow(digests, REPORT))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(*repair(damage(table(spark, sf_dir, "conversations"))))
