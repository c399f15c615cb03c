"""Levels and ids of headings, and ids of figures and tables, by what their texts say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How a table of contents, an appendix, list items and numbered headings begin.
CONTENTS = r"^目\s*录$"
APPENDIX = r"^附录\s*([0-9一二三四五六七八九十]+)"
LIST_ITEM = r"^[（(]\s*\d+\s*[）)]|^\d+\s*[）)]"
NUMBERED = r"^(\d+(?:\.\d+)*)(\.?)\s*"
FIGURE = r"(?i)(?:图|figure|fig\.?)\s*([0-9A-Za-z]+(?:[.\-][0-9A-Za-z]+)*)"
TABLE = r"(?i)(?:表|table)\s*([0-9A-Za-z]+(?:[.\-][0-9A-Za-z]+)*)"


def plain_id(x: Column) -> Column:
    """Letters and digits in lower case, joined by underscores; ``item`` where there are none."""
    joined = F.lower(F.regexp_replace(F.regexp_replace(x, r"[^0-9A-Za-z]+", "_"), "^_+|_+$", ""))
    return F.coalesce(F.nullif(joined, F.lit("")), F.lit("item"))


def level(title: Column, raw: Column, current: Column) -> Column:
    """A heading's level by its text, where ``current`` is that of the one before, 0 for the first; 0 for no heading."""
    t = F.trim(title)
    number, dot = F.regexp_extract(t, NUMBERED, 1), F.regexp_extract(t, NUMBERED, 2)
    depth = F.size(F.split(number, r"\."))
    return (
        F.when(current == 0, 1).when(t.rlike(CONTENTS) | t.rlike(APPENDIX), 2).when(t.rlike(LIST_ITEM), 0)
        .when(number != "", F.when((depth == 1) & (dot != ""), 0).otherwise(F.least(depth + 1, F.lit(6))))
        .when(raw > 0, F.least(F.greatest(current + 1, F.lit(2)), F.lit(6))).otherwise(0)
    )


def structural_levels(blocks: DataFrame, document: str = "file") -> DataFrame:
    """document, ordinal, level of text blocks in order: document, ordinal, text, text_level. One fold a document, as
    a level depends on the one before."""
    listed = blocks.groupBy(document).agg(F.array_sort(F.collect_list(F.struct("ordinal", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("text_level", F.lit(0)).alias("raw")))).alias("bs"))
    none = F.array().cast("array<struct<ordinal:int,level:int>>")

    def step(acc: Column, b: Column) -> Column:
        own = level(b.text, b.raw, acc.current).cast("int")
        return F.struct(F.when(own > 0, own).otherwise(acc.current).cast("int").alias("current"), F.concat(acc.out, F.array(F.struct(b.ordinal.cast("int").alias("ordinal"), own.alias("level")))).alias("out"))

    out = F.aggregate("bs", F.struct(F.lit(0).alias("current"), none.alias("out")), step, lambda acc: acc.out)
    return listed.select(document, F.inline(out))


def base_id(title: Column, index: Column) -> Column:
    t = F.trim(title)
    appendix, number = F.regexp_extract(t, APPENDIX, 1), F.regexp_extract(t, NUMBERED, 1)
    return F.when(appendix != "", F.concat(F.lit("appendix-"), plain_id(appendix))).when(number != "", number).when(t.rlike(CONTENTS), "toc").otherwise(F.format_string("section-%04d", index))


def unique_ids(bases: Column, joint: str = "-") -> Column:
    """An array of ids, in order: the base, or the base with the first number from 2 that isn't taken."""

    def step(taken: Column, base: Column) -> Column:
        numbered = F.transform(F.sequence(F.lit(2), F.size(taken) + 2), lambda k: F.concat(base, F.lit(joint), k.cast("string")))
        free = F.get(F.filter(numbered, lambda c: ~F.array_contains(taken, c)), F.lit(0))
        return F.concat(taken, F.array(F.when(F.array_contains(taken, base), free).otherwise(base)))

    return F.aggregate(bases, F.array().cast("array<string>"), step)


def asset_base(caption: Column, kind: Column, page: Column, sequence: Column) -> Column:
    """fig_... or table_... by the number in a caption (a figure may be captioned as a table), else by place."""
    figure, table = F.regexp_extract(caption, FIGURE, 1), F.regexp_extract(caption, TABLE, 1)
    return (
        F.when((figure != "") & (kind == "fig"), F.concat(F.lit("fig_"), plain_id(figure))).when((table != "") & kind.isin("table", "fig"), F.concat(F.lit("table_"), plain_id(table)))
        .otherwise(F.concat(kind, F.lit("_p"), page.cast("string"), F.lit("_n"), sequence.cast("string")))
    )


def asset_ids(assets: DataFrame, document: str = "file") -> DataFrame:
    """document, ordinal, id of assets in order: document, ordinal, caption, kind, page, sequence."""
    base = asset_base(F.coalesce("caption", F.lit("")), F.col("kind"), F.col("page"), F.col("sequence"))
    listed = assets.groupBy(document).agg(F.array_sort(F.collect_list(F.struct("ordinal", base.alias("base")))).alias("xs"))
    ids = unique_ids(F.transform("xs", lambda x: x.base), "_")
    return listed.select(document, F.inline(F.arrays_zip(F.transform("xs", lambda x: x.ordinal).alias("ordinal"), ids.alias("id"))))


def projection_name(directory: Column) -> Column:
    """The file name of a bundle's projection."""
    safe = F.regexp_replace(F.regexp_replace(F.regexp_replace(directory, "(_image)?_document_bundle$", ""), r"[^A-Za-z0-9._\-㐀-鿿]+", "-"), "^-+|-+$", "")
    return F.concat(F.coalesce(F.nullif(safe, F.lit("")), F.lit("document")), F.lit(".section-query-index.json"))
