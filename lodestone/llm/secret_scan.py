"""Secret scans: rules are regular expressions, and a trigram index says which documents can match which rule.

From the parse tree of each rule a Boolean query over trigrams is derived that every match must satisfy: ``AKIA[A-Z0-9]+``
needs "aki" and "kia"; an alternation needs all trigrams of one branch. The index holds trigrams of the UTF-8 bytes with
A-Z lower-cased, for rules that ignore case and others alike, and of these only the ones that some rule asks for. Postings
are intersected and united as the query says, and the documents left are verified with the regular expression itself, on
the whole text. A rule that no trigram is mandatory for (a run of hexadecimal digits) scans all documents.

``scan_secrets`` partitions the index by document: each slice of a batch (2 MB of text, or one document) is a shard whose
postings are built, intersected and verified where the text lies. No text and no posting is shuffled, memory is that of
a slice, and a lost executor costs its own tasks only. As one rule of the production set scans every text anyway, an
index that is kept would save no reading there. ``index_grams`` writes the same postings as a table for rules that come
later, and ``candidates`` answers a rule from it.

A match whose group is shorter than the rule's ``least`` is dropped after matching, so it still uses up its characters.
Matches of a rule don't overlap, those of different rules may. Offsets are code points, the end is exclusive.

Defined results: a null text is empty and has no spans; each row is a document of its own, so rows with a null or a
repeated id are scanned one by one; an empty table gives an empty one; other columns pass unchanged, unless they are
called ``spans``, which is set here.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as op
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table
from .kernels import LOWER, slices

#: A set of strings is kept exactly up to this size; a larger one is cut into its parts, which asks for less.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """``group`` is what must have ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    ignore_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


#: The three base kinds in their order, then those added here. Each pattern reads a text in linear time.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=6, ignore_case=True),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)
ADDED = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abeprs]-[A-Za-z0-9-]+", least=20),
    Rule("google", r"AIza[A-Za-z0-9_-]+", least=39),
    Rule("stripe", r"sk_(live|test)_[A-Za-z0-9]+", least=24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+[.]?[A-Za-z0-9_-]*[.]?[A-Za-z0-9_-]*", least=40),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)


class Need:
    """A Boolean query over trigrams: a trigram, or all or any of some queries. None asks for nothing."""

    def __init__(self, how: str, of: frozenset):
        self.how, self.of = how, of

    def grams(self) -> set[bytes]:
        return set().union(*[x.grams() if isinstance(x, Need) else {x} for x in self.of])

    def holds(self, postings: dict[bytes, np.ndarray]) -> np.ndarray:
        """Which documents of a shard can match."""
        parts = [x.holds(postings) if isinstance(x, Need) else postings[x] for x in self.of]
        return reduce(np.logical_and if self.how == "all" else np.logical_or, parts)

    def column(self, grams: Column) -> Column:
        """The same over an array of a document's trigrams."""
        parts = [x.column(grams) if isinstance(x, Need) else F.array_contains(grams, F.lit(x)) for x in self.of]
        return reduce(lambda a, b: a & b if self.how == "all" else a | b, parts)


def both(*needs: Need | None) -> Need | None:
    asked = frozenset(x for x in needs if x is not None)
    return next(iter(asked)) if len(asked) == 1 else Need("all", asked) if asked else None


def either(needs: list[Need | None]) -> Need | None:
    return None if None in needs else needs[0] if len(needs) == 1 else Need("any", frozenset(needs))


def of_strings(strings: Iterable[str]) -> Need | None:
    """One of the strings stands in the text."""
    found = []
    for s in strings:
        raw = _lower(s).encode()
        if len(raw) < 3:
            return None
        found.append(frozenset(raw[i : i + 3] for i in range(len(raw) - 2)))
    weakest = {x for x in found if not any(y < x for y in found)}  # a branch that asks for more than another adds nothing
    return either([Need("all", x) for x in sorted(weakest, key=sorted)])


def _lower(s: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def derive(rule: Rule) -> Need | None:
    """What trigrams each match of the rule needs; None where none is mandatory."""
    strings, need = _derive(_parser.parse(rule.pattern, re.ASCII | (re.IGNORECASE if rule.ignore_case else 0)))
    return need if strings is None else of_strings(strings)


def _derive(items: Iterable) -> tuple[set[str] | None, Need | None]:
    """The strings that a sequence matches, where they are few, else None and what trigrams it needs."""
    strings, need, exact = {""}, None, True
    for code, arg in items:
        some, asked, ends = _item(code, arg)
        if some is not None and len(strings) * len(some) <= MOST_STRINGS:
            strings = {a + b for a, b in product(strings, some)}
        else:
            need, exact = both(need, of_strings(strings)), False
            strings = some if some is not None else {""}
        need = both(need, asked)
        if ends:  # whatever follows doesn't adjoin these strings
            need, strings, exact = both(need, of_strings(strings)), {""}, False
    return (strings, None) if exact else (None, both(need, of_strings(strings)))


def _item(code: object, arg: object) -> tuple[set[str] | None, Need | None, bool]:
    """Strings of one item, what else it needs, and whether more of it may follow these strings."""
    if code is op.LITERAL:
        return {_lower(chr(arg))}, None, False
    if code is op.IN and all(c is op.LITERAL for c, _ in arg):
        return {_lower(chr(x)) for _, x in arg}, None, False
    if code is op.AT:
        return {""}, None, False
    if code is op.SUBPATTERN:
        strings, need = _derive(arg[3])
        return strings, need, False
    if code is op.BRANCH:
        parts = [_derive(x) for x in arg[1]]
        if all(s is not None for s, _ in parts) and sum(len(s) for s, _ in parts) <= MOST_STRINGS:
            return set().union(*[s for s, _ in parts]), None, False
        return None, either([n if s is None else of_strings(s) for s, n in parts]), False
    if code in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        least, most, inner = arg
        strings, need = _derive(inner)
        if least == 0:
            return ({""} | strings, None, False) if strings is not None and most == 1 else (None, None, False)
        if strings is None or len(strings) ** least > MOST_STRINGS:
            return None, need if strings is None else of_strings(strings), False
        return {"".join(x) for x in product(strings, repeat=least)}, None, most != least
    return None, None, False


class Scan:
    """Rules with their queries, and the trigrams that these ask for."""

    def __init__(self, rules: Iterable[Rule]):
        self.rules = [(r, r.compiled(), derive(r)) for r in rules]
        self.grams = sorted(set().union(*[n.grams() for _, _, n in self.rules if n is not None]))
        self.codes = np.array([int.from_bytes(g, "big") for g in self.grams], np.uint32)
        self.pairs = np.zeros(1 << 16, bool)
        self.pairs[self.codes >> 8] = True

    def postings(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """A line of bits for each trigram: the documents of the shard that have it."""
        out = np.zeros((len(self.grams), len(at) - 1), bool)
        if len(data) < 3 or not len(self.grams):
            return out
        low = LOWER[data].astype(np.uint16)
        place = np.flatnonzero(self.pairs[(low[:-2] << 8) | low[1:-1]])
        code = low[place].astype(np.uint32) << 16 | low[place + 1].astype(np.uint32) << 8 | low[place + 2]
        number = np.searchsorted(self.codes, code)
        owner = np.searchsorted(at, place, side="right") - 1
        hit = (self.codes[np.minimum(number, len(self.codes) - 1)] == code) & (place + 3 <= at[owner + 1])
        out[number[hit], owner[hit]] = True
        return out

    def spans(self, data: np.ndarray, at: np.ndarray, texts: list[str | None]) -> list[list[tuple[int, int, int]]]:
        """(start, number of the rule, end) of each match of each document."""
        bits = dict(zip(self.grams, self.postings(data, at), strict=True))
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for number, (rule, pattern, need) in enumerate(self.rules):
            for doc in range(len(texts)) if need is None else np.flatnonzero(need.holds(bits)):
                for m in pattern.finditer(texts[doc] or ""):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        out[doc].append((m.start(), number, m.end()))
        for found in out:
            found.sort()
        return out


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def scan_secrets(docs: DataFrame, rules: Iterable[Rule] = BASE + ADDED) -> DataFrame:
    """All columns of docs and ``spans``: kind, start and end of each match, by start and then by the rules' order.

    docs: text, and any others."""
    scan = Scan(rules)
    names = [c for c in docs.columns if c != "spans"]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in slices(batches):
            found = scan.spans(data, at, batch.column("text").to_pylist())
            spans = pa.array([[{"kind": scan.rules[n][0].kind, "start": a, "end": b} for a, n, b in x] for x in found], kind)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], spans], names=[*names, "spans"])

    return docs.select(*[f"`{c}`" for c in names]).mapInArrow(run, T.StructType([*[docs.schema[c] for c in names], T.StructField("spans", SPANS)]))


def index_grams(docs: DataFrame, rules: Iterable[Rule] = BASE + ADDED) -> DataFrame:
    """gram, doc_ids: postings of the trigrams that the rules ask for, a row for each trigram of each shard."""
    scan = Scan(rules)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, at in slices(batches):
            ids, bits = np.asarray(batch.column("doc_id").cast(pa.int64())), scan.postings(data, at)
            full = np.flatnonzero(bits.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array([scan.grams[i] for i in full], pa.binary()), pa.array([ids[bits[i]] for i in full], pa.list_(pa.int64()))], names=["gram", "doc_ids"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("doc_id IS NOT NULL").mapInArrow(run, "gram binary, doc_ids array<long>")


def candidates(index: DataFrame, rule: Rule) -> DataFrame | None:
    """doc_id of the documents that can match, from an index whose rules had this one's trigrams; None: all of them."""
    need = derive(rule)
    if need is None:
        return None
    asked = index.filter(F.col("gram").isin(*[F.lit(g) for g in sorted(need.grams())]))
    each = asked.select(F.explode("doc_ids").alias("doc_id"), "gram").groupBy("doc_id").agg(F.collect_set("gram").alias("grams"))
    return each.filter(need.column(F.col("grams"))).select("doc_id")


def written_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op12_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id", *[F.size(of(r.kind)).cast("long").alias(f"n_{r.kind}") for r in BASE],
        F.sha2(written_spans(of(*[r.kind for r in BASE])).cast("binary"), 256).alias("base_sha256"), written_spans(F.col("spans")).alias("spans"),
    )


def _any_case(pattern: str) -> str:
    """Letters outside of brackets in either case, for SQL, whose flag for this takes in letters beyond ASCII."""
    return re.sub(r"\[[^\]]*\]|\\x..|[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]" if len(m[0]) == 1 else m[0], pattern)


def _sql(rules: tuple[Rule, ...]) -> str:
    found = [
        f"SELECT r, {n} AS n, '{x.kind}' AS kind, {x.least} AS least, regexp_extract_all(t, $${p}$$) AS a, regexp_extract_all(t, $${p}$$, {x.group}) AS g, string_split_regex(t, $${p}$$) AS b FROM d"
        for n, x in enumerate(rules)
        for p in [_any_case(x.pattern) if x.ignore_case else x.pattern]
    ]
    base = "', '".join(r.kind for r in BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(found)}),
e AS (SELECT r, n, kind, least, unnest(a) AS a, unnest(g) AS g, unnest(b[:len(a)]) AS b, generate_subscripts(a, 1) AS i FROM m WHERE len(a) > 0),
p AS (SELECT *, sum(length(a) + length(b)) OVER (PARTITION BY r, n ORDER BY i) AS stop FROM e),
s AS (SELECT r, n, kind, (stop - length(a))::BIGINT AS start, kind || ':' || (stop - length(a))::BIGINT || ':' || stop::BIGINT AS span FROM p WHERE length(g) >= least)
SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)},
  sha256(coalesce(string_agg(span, ',' ORDER BY start, n) FILTER (kind IN ('{base}')), '')) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY start, n), '') AS spans
FROM d LEFT JOIN s USING (r) GROUP BY r, doc_id
"""


SQL = _sql(BASE + ADDED)
