"""Heading-aware sections and overlapping windows of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import UNIT, chunk_type, empty, heading_level, heading_title, lines, sha256, text, token_count

SECTION = "struct<start_line:int,end_line:int,path:array<string>,lines:array<string>>"


def fence_mask(body_lines: Column) -> Column:
    """For each line whether it is within a code fence."""
    marks = F.transform(body_lines, lambda x: x.rlike(r"^\s*(```|~~~)").cast("int"))
    return F.transform(marks, lambda m, i: (F.aggregate(F.slice(marks, F.lit(1), i), F.lit(0), lambda a, b: a + b) % 2 == 1) | (m == 1))


def parent_sections(docs: DataFrame, source: str = "source", body: str = "content", digest: str | None = None, skip_fences: bool = False) -> DataFrame:
    """A row for each heading's section, preamble included: source, source_sha256, parent_number, start_line,
    end_line, heading (titles joined by `` > ``), parent_text, parent_id.

    A heading's path is that of the one before it, cut to its level less one, and its own title; so after a skipped
    level siblings nest. One fold over the lines of a document, no shuffle."""
    all_lines = lines(body)
    level = lambda x: heading_level(x)
    marked = F.transform(all_lines, lambda x: F.struct(x.alias("line"), level(x).alias("level"), heading_title(x).alias("title")))
    if skip_fences:
        inside = fence_mask(all_lines)
        marked = F.transform(marked, lambda x, i: F.struct(x.line.alias("line"), F.when(F.get(inside, i), 0).otherwise(x.level).alias("level"), x.title.alias("title")))
    start = F.array().cast(f"array<struct<at:int,path:array<string>>>")

    def step(acc: Column, x: Column) -> Column:
        path = F.when(F.size(acc.heads) > 0, F.element_at(acc.heads, -1).path).otherwise(empty())
        new = F.struct((acc.n + 1).alias("at"), F.concat(F.slice(path, F.lit(1), F.greatest(F.lit(0), x.level - 1)), F.array(x.title)).alias("path"))
        return F.struct((acc.n + 1).alias("n"), F.when(x.level > 0, F.concat(acc.heads, F.array(new))).otherwise(acc.heads).alias("heads"))

    heads = F.aggregate(marked, F.struct(F.lit(0).alias("n"), start.alias("heads")), step, lambda acc: acc.heads)
    heads = F.when((F.size(heads) == 0) | (F.get(heads, F.lit(0)).at > 1), F.concat(F.array(F.struct(F.lit(1).alias("at"), empty().alias("path"))), heads)).otherwise(heads)
    kept = docs.select(F.col(source).alias("source"), (F.col(digest) if digest else sha256(body)).alias("source_sha256"), all_lines.alias("__lines"), heads.alias("__heads"))
    each = kept.select("source", "source_sha256", "__lines", "__heads", F.posexplode("__heads").alias("__i", "__head"))
    end = F.coalesce(F.get("__heads", F.col("__i") + 1).at - 1, F.size("__lines"))
    each = each.select("source", "source_sha256", "__i", F.col("__head.at").alias("start_line"), end.alias("end_line"), F.array_join("__head.path", " > ").alias("heading"), F.array_join(F.slice("__lines", F.col("__head.at"), end - F.col("__head.at") + 1), "\n").alias("__text"))
    each = each.withColumn("parent_text", F.regexp_replace("__text", r"(?U)^\s+|\s+$", "")).filter("parent_text <> ''")
    return each.select("source", "source_sha256", F.col("__i").alias("parent_number"), "start_line", "end_line", "heading", "parent_text", chunk_id("source", "start_line", "end_line", "heading", "parent_text").alias("parent_id"))


def chunk_id(*parts: Column | str) -> Column:
    return sha256(F.concat_ws("|", *[text(p).cast("string") for p in parts]))


def windows(units: Column, size: int, overlap: float) -> Column:
    """Windows of ``size`` units that start at every step below the length; the last ones may lie within others."""
    step = max(1, int(size * (1 - overlap)))
    starts = F.sequence(F.lit(0), F.size(units) - 1, F.lit(step))
    return F.when(F.size(units) > 0, F.transform(starts, lambda s: F.slice(units, s + 1, F.lit(size))))


def child_chunks(parents: DataFrame, size: int = 800, overlap: float = 0.15, unit: str = UNIT) -> DataFrame:
    """Chunks of the engine's schema: a short parent whole, a longer one as windows over words, spaces and signs. The
    default unit keeps accented letters."""
    units = F.regexp_extract_all("parent_text", F.lit(unit), F.lit(0))
    cut = F.transform(windows(units, size, overlap), lambda w: F.trim(F.array_join(w, "")))
    pieces = F.when(token_count("parent_text") <= size, F.array("parent_text")).otherwise(cut)
    each = parents.select("*", F.posexplode(pieces).alias("chunk_no", "text")).filter("text <> ''")
    return each.select(chunk_id("source", "start_line", "end_line", "heading", "text").alias("id"), "chunk_no", chunk_type("parent_text", "source").alias("chunk_type"), "text", "parent_id", "parent_text", "source", "source_sha256", "start_line", "end_line", "heading", token_count("text").alias("tokens"))


def chunk_documents(docs: DataFrame, source: str = "source", body: str = "content", size: int = 800, overlap: float = 0.15) -> DataFrame:
    return child_chunks(parent_sections(docs, source, body), size, overlap)
