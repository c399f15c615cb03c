"""Outlines, owned line ranges, mapping chunks to sections, and locating sections for a question."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.substrings import Finder
from ..functions.text import casefold, content_lines, query_terms, read_ranges, span, valid_ranges

WEIGHTS = {"document": 5, "title": 9, "path": 4, "content": 2}
UNSETTLED = ("stale", "pending", "in_progress")
#: Questions that one pass over documents and sections answers.
MOST_QUESTIONS = 10_000
#: Pairs of a section and a question that are scored at once.
SLICE_PAIRS = 50_000
NONE = pa.list_(pa.string())


class Asked:
    """A block of questions turned round: for each distinct term, which questions have it, where in their list, and its
    weight."""

    def __init__(self, questions: pa.Table):
        self.ids = questions.column("query_id").combine_chunks()
        lists = questions.column("terms").to_pylist()
        self.words = sorted({t for terms in lists for t in terms})
        number = {w: i for i, w in enumerate(self.words)}
        self.weight = np.array([max(1, len(w) - 1) for w in self.words], np.float64)
        word = np.array([number[t] for terms in lists for t in terms], np.int64)
        order = np.argsort(word, kind="stable")
        self.question = np.repeat(np.arange(len(lists)), [len(x) for x in lists])[order]
        self.place = np.array([i for terms in lists for i in range(len(terms))], np.int64)[order]
        self.start = np.searchsorted(word[order], np.arange(len(self.words) + 1))
        self.find = Finder(self.words)

    def __len__(self) -> int:
        return len(self.ids)

    def hits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """text, question, place of the term in the question's list, term; for each term of a question in a text."""
        text, word = self.find(texts)
        n = self.start[word + 1] - self.start[word]
        at = np.repeat(self.start[word] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.repeat(text, n), self.question[at], self.place[at], np.repeat(word, n)

    def lists(self, of: np.ndarray, place: np.ndarray, word: np.ndarray, n: int) -> pa.Array:
        """For each of n owners its terms, in the order of the question's list."""
        order = np.lexsort((place, of))
        ends = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=n)))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(self.words, pa.string()).take(pa.array(word[order])))


def best_documents(batches: Iterable[pa.RecordBatch], asked: Asked, top: int) -> Iterator[pa.RecordBatch]:
    """question, document_path, document_score, document_terms: of each batch the best documents of each question that
    have a term of it, and, as question -1, the least paths, for questions that too few documents have a term of."""
    names = ["question", "document_path", "document_score", "document_terms"]
    for batch in batches:
        least = sorted(batch.column("document_path").drop_null().to_pylist())[: 2 * top]
        yield pa.RecordBatch.from_arrays([pa.array([-1] * len(least), pa.int32()), pa.array(least, pa.string()), pa.array([0] * len(least), pa.int32()), pa.array([[]] * len(least), NONE)], names=names)
        text, question, place, word = asked.hits(batch.column("routing"))
        pair, of = np.unique(question * max(1, batch.num_rows) + text, return_inverse=True)
        if not len(pair):
            continue
        score = WEIGHTS["document"] * np.bincount(of, asked.weight[word]).astype(np.int64)
        paths = np.array(batch.column("document_path").to_pylist(), dtype=object)
        rank_of_path = np.argsort(np.argsort(paths, kind="stable"), kind="stable")
        q, d = pair // batch.num_rows, pair % batch.num_rows
        order = np.lexsort((rank_of_path[d], -score, q))
        kept = order[np.arange(len(order)) - np.searchsorted(q[order], q[order]) < top]
        terms = asked.lists(of, place, word, len(pair)).take(pa.array(kept))
        yield pa.RecordBatch.from_arrays([pa.array(q[kept].astype(np.int32)), pa.array(paths[d[kept]], pa.string()), pa.array(score[kept].astype(np.int32)), terms], names=names)


class Routes:
    """Which questions a document is among the best of, by document."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by([("document_path", "ascending"), ("question", "ascending")])
        paths = rows.column("document_path").to_pylist()
        self.question, self.score = rows.column("question").to_numpy(), rows.column("document_score").to_numpy()
        self.terms = rows.column("document_terms").combine_chunks() if rows.num_rows else pa.array([], NONE)
        self.slices: dict[str, tuple[int, int]] = {}
        for i, p in enumerate(paths):
            self.slices[p] = (self.slices.get(p, (i, i))[0], i + 1)


FIELDS = ("title", "path", "content")


def score_sections(batches: Iterable[pa.RecordBatch], asked: Asked, routes: Routes, terms: bool) -> Iterator[pa.RecordBatch]:
    """A row for each section and question that its document is among the best of, if the score is over 0."""
    for batch in batches:
        slices = [routes.slices.get(p, (0, 0)) for p in batch.column("document_path").to_pylist()]
        ends = np.cumsum([b - a for a, b in slices])
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + SLICE_PAIRS, side="right")))
            found = _scored(batch.slice(at, stop - at), slices[at:stop], asked, routes, terms)
            if found is not None:
                yield found
            at = stop


def _scored(batch: pa.RecordBatch, slices: list[tuple[int, int]], asked: Asked, routes: Routes, terms: bool) -> pa.RecordBatch | None:
    n = np.array([b - a for a, b in slices])
    if not n.sum():
        return None
    section = np.repeat(np.arange(len(n)), n)
    route = np.repeat(np.array([a for a, _ in slices]) - (np.cumsum(n) - n), n) + np.arange(n.sum())
    pairs = section * len(asked) + routes.question[route]  # ascending, as a document's routes are
    total, met = routes.score[route].astype(np.int64), {}
    for field in FIELDS:
        text, question, place, word = asked.hits(batch.column(field))
        key = text * len(asked) + question
        of = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
        hit = pairs[of] == key
        of, place, word = of[hit], place[hit], word[hit]
        total += WEIGHTS[field] * np.bincount(of, asked.weight[word], len(pairs)).astype(np.int64)
        met[field] = of, place, word
    kept = np.flatnonzero(total > 0)
    take = lambda column, rows: column.take(pa.array(rows))
    arrays = [take(asked.ids, routes.question[route[kept]])]
    arrays += [take(batch.column(c), section[kept]) for c in ("document_path", "section_id", "source_filename", "ingest_status")]
    arrays += [pa.array(total[kept].astype(np.int32)), pa.array(routes.score[route[kept]].astype(np.int32))]
    names = ["query_id", "document_path", "section_id", "source_filename", "ingest_status", "score", "document_score"]
    if terms:
        arrays += [take(routes.terms, route[kept]), *[take(asked.lists(*met[f], len(pairs)), kept) for f in FIELDS]]
        names += ["document_terms", *[f"{f}_terms" for f in FIELDS]]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def outline(headings: DataFrame, document: str = "document_path") -> DataFrame:
    """Scopes of headings: adds end_line, parent (id) and path (ids from the top to the own one).

    headings: document, section_id, start_line, level, total_lines. A section ends before the next heading of its own
    level or above; its parent is the nearest heading before it of a lower level. Each document's headings are
    folded in order as one array."""
    listed = headings.groupBy(document).agg(F.max("total_lines").alias("total"), F.array_sort(F.collect_list(F.struct("start_line", "section_id", "level"))).alias("hs"))
    start = F.array().cast("array<struct<id:string,level:int>>")

    def step(acc: Column, h: Column) -> Column:
        above = F.filter(F.when(F.size(acc) > 0, F.element_at(acc, -1)).otherwise(start), lambda s: s.level < h.level)
        # Of the stack only headings of a lower level stay; each step's stack is kept, so that it can be read off.
        return F.concat(acc, F.array(F.concat(above, F.array(F.struct(h.section_id.cast("string").alias("id"), h.level.cast("int").alias("level"))))))

    stacks = F.aggregate("hs", F.array().cast("array<array<struct<id:string,level:int>>>"), step)
    each = listed.select(document, "total", "hs", F.posexplode(stacks).alias("i", "stack"))
    own = F.get("hs", F.col("i"))
    later = F.filter(F.slice("hs", F.col("i") + 2, F.size("hs")), lambda h: h.level <= own.level)
    end = F.coalesce(F.get(later, F.lit(0)).start_line - 1, F.col("total"))
    found = each.select(document, own.section_id.alias("section_id"), end.alias("end_line"), F.when(F.size("stack") > 1, F.element_at("stack", -2).id).alias("parent"), F.transform("stack", lambda s: s.id).alias("path"))
    return headings.join(found, [document, "section_id"])


def owned_ranges(sections: DataFrame, document: str = "document_path") -> DataFrame:
    """Adds content_ranges (the scope without direct children's), ingest_unit (whether any line is owned) and
    misplaced (children that aren't within the scope).

    sections: document, section_id, parent, start_line, end_line."""
    children = sections.filter("parent IS NOT NULL").groupBy(document, F.col("parent").alias("section_id")).agg(F.array_sort(F.collect_list(F.struct("start_line", "end_line", F.col("section_id").alias("id")))).alias("__children"))
    joined = sections.join(children, [document, "section_id"], "left").withColumn("__children", F.coalesce("__children", F.array().cast("array<struct<start_line:int,end_line:int,id:string>>")))
    none = F.array().cast("array<struct<start_line:int,end_line:int>>")
    piece = lambda a, b: F.struct(a.cast("int").alias("start_line"), b.cast("int").alias("end_line"))

    def step(acc: Column, c: Column) -> Column:
        gap = F.when(acc.cursor < c.start_line, F.concat(acc.owned, F.array(piece(acc.cursor, c.start_line - 1)))).otherwise(acc.owned)
        return F.struct(F.greatest(acc.cursor, c.end_line + 1).cast("int").alias("cursor"), gap.alias("owned"))

    end = F.col("end_line")
    ranges = F.aggregate("__children", F.struct(F.col("start_line").cast("int").alias("cursor"), none.alias("owned")), step, lambda acc: F.when(acc.cursor <= end, F.concat(acc.owned, F.array(piece(acc.cursor, end)))).otherwise(acc.owned))
    misplaced = F.transform(F.filter("__children", lambda c: (c.start_line < F.col("start_line")) | (c.end_line > F.col("end_line"))), lambda c: c.id)
    return joined.withColumn("content_ranges", ranges).withColumn("misplaced", misplaced).withColumn("ingest_unit", F.size("content_ranges") > 0).drop("__children")


def chunk_sections(chunks: DataFrame, sections: DataFrame, document: str = "document_path", keys: tuple[str, ...] = ("chunk_id",)) -> DataFrame:
    """Each chunk with the section that owns lines of it: of those that overlap the one with the fewest owned lines,
    then the deepest, then the least id; null columns where none does.

    The join has the document as an equality key, so it hashes or merges; the overlap is its residual condition."""
    owned = sections.withColumn("__ranges", valid_ranges(F.col("content_ranges"), F.col("start_line"), F.col("end_line")))
    owned = owned.select(F.col(document).alias("__doc"), "section_id", span(F.col("__ranges")).alias("owned_span"), F.size("path_titles").alias("depth"), F.explode("__ranges").alias("__r"))
    hit = (F.col(document) == F.col("__doc")) & (F.col("line_start") <= F.col("__r.end_line")) & (F.col("line_end") >= F.col("__r.start_line"))
    best = Window.partitionBy(document, *keys).orderBy(F.col("owned_span").asc_nulls_last(), F.desc("depth"), "section_id")
    met = chunks.join(owned, hit, "left").drop("__doc", "__r").withColumn("__n", F.row_number().over(best))
    return met.filter("__n = 1").drop("__n")


def deepest_container(points: DataFrame, sections: DataFrame, document: str = "document_path", line: str = "line", keys: tuple[str, ...] = ("block_id",)) -> DataFrame:
    """Each point (a block's or an asset's line) with the deepest section whose scope holds it; the first of equals."""
    scopes = sections.select(F.col(document).alias("__doc"), "section_id", "level", "start_line", "end_line")
    hit = (F.col(document) == F.col("__doc")) & F.col(line).between(F.col("start_line"), F.col("end_line"))
    best = Window.partitionBy(document, *keys).orderBy(F.col("level").desc_nulls_last(), "start_line", "section_id")
    return points.join(scopes, hit, "left").withColumn("__n", F.row_number().over(best)).filter("__n = 1").drop("__n", "__doc", "start_line", "end_line", "level")


def locate(queries: DataFrame, documents: DataFrame, sections: DataFrame, top_documents: int = 8, content: bool = True, terms: bool = True, most: int = MOST_QUESTIONS) -> DataFrame:
    """Scores sections for questions by terms in the document's routing text, the title, the path and the content.

    queries: query_id, text; each id once. documents: document_path, routing, and text if ``content``. sections:
    document_path, section_id, title, path_titles, content_ranges, ingest_status, source_filename; or content itself for
    the ranges, and then documents need no text. The best ``top_documents`` of each question are scored further, even at
    0; a section needs a score over 0, and an unsettled one loses 3 after that. Returns query_id, document_path,
    section_id, score, document_score, matched terms (unless ``terms`` is False), rank.

    Questions are a stated set, taken in blocks of ``most``. A block's terms, turned into postings, go to all tasks; each
    routing text, title, path and content is read once, and what it has of all questions' terms is added up question by
    question where it lies. Between the two passes only a block's pairs of question and document come to the driver."""
    asked = queries.select("query_id", query_terms("text").alias("terms"))
    few = asked.limit(most + 1).toArrow()
    n = few.num_rows if few.num_rows <= most else asked.count()
    blocks = max(1, -(-n // most))
    top = max(1, top_documents)
    folded = documents.select("document_path", casefold("routing").alias("routing"))
    bodies = sections.withColumnRenamed("content", "__content") if "content" in sections.columns else sections
    if content and "content" not in sections.columns:
        texts = documents.select("document_path", content_lines("text").alias("__lines"))
        bodies = sections.join(texts, "document_path").withColumn("__content", read_ranges(F.col("__lines"), F.col("content_ranges"))).drop("__lines")
    body = casefold("__content") if content else F.lit("")
    bodies = bodies.select("document_path", "section_id", "source_filename", "ingest_status", casefold(F.coalesce("title", F.lit(""))).alias("title"), casefold(F.array_join("path_titles", " / ")).alias("path"), body.alias("content"))
    lists = ["document_terms", *[f"{f}_terms" for f in FIELDS]] if terms else []
    schema = T.StructType([T.StructField("query_id", queries.schema["query_id"].dataType), *[bodies.schema[c] for c in ("document_path", "section_id", "source_filename", "ingest_status")], T.StructField("score", T.IntegerType()), T.StructField("document_score", T.IntegerType()), *[T.StructField(c, T.ArrayType(T.StringType())) for c in lists]])
    scored = None
    for block in range(blocks):
        mine = Asked(few if blocks == 1 else asked.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block).toArrow())
        sent = queries.sparkSession.sparkContext.broadcast(mine)
        found = folded.mapInArrow(lambda it, sent=sent: best_documents(it, sent.value, top), "question int, document_path string, document_score int, document_terms array<string>")
        best = found.withColumn("__n", F.row_number().over(Window.partitionBy("question").orderBy(F.desc("document_score"), "document_path"))).filter(F.col("__n") <= F.when(F.col("question") < 0, 2 * top).otherwise(top)).drop("__n")
        routes = queries.sparkSession.sparkContext.broadcast(Routes(_with_spare(best.toArrow(), len(mine), top)))
        hits = bodies.mapInArrow(lambda it, sent=sent, routes=routes: score_sections(it, sent.value, routes.value, terms), schema)
        scored = hits if scored is None else scored.unionByName(hits)
    scored = scored.withColumn("score", F.col("score") - F.when(F.col("ingest_status").isin(*UNSETTLED), 3).otherwise(0))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "source_filename", "section_id")
    return scored.select("query_id", "document_path", "section_id", "source_filename", "score", "document_score", *lists).withColumn("rank", F.row_number().over(order))


def _with_spare(best: pa.Table, questions: int, top: int) -> pa.Table:
    """The best documents of each question, filled up to ``top`` by others at 0, in the order of their paths."""
    has: dict[int, set[str]] = {}
    for q, p in zip(best.column("question").to_pylist(), best.column("document_path").to_pylist(), strict=True):
        has.setdefault(q, set()).add(p)
    spare = sorted(has.pop(-1, ()))
    more = [(q, p) for q in range(questions) if len(has.get(q, ())) < top for p in [x for x in spare if x not in has.get(q, ())][: top - len(has.get(q, ()))]]
    filled = pa.table({"question": pa.array([q for q, _ in more], pa.int32()), "document_path": pa.array([p for _, p in more], pa.string()), "document_score": pa.array([0] * len(more), pa.int32()), "document_terms": pa.array([[]] * len(more), NONE)})
    return pa.concat_tables([best.filter(pc.greater_equal(best.column("question"), 0)).cast(filled.schema), filled])
