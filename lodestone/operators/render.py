"""Content blocks to Markdown documents, and outlines and assets of what was rendered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import OUTLINE_HEADING, content_lines, page_number, prettify_tables
from ..model import AUXILIARY_BLOCKS
from .headings import asset_base, base_id, level, unique_ids

# Kinds of images, suffixes that copies keep, and two labels of rendered documents.
IMAGE_BLOCKS = ("image", "chart")
COPIED_SUFFIXES = (".png", ".jpg", ".jpeg", ".webp", ".bmp", ".gif")
TABLE_LINK, PAGE_EVIDENCE = "查看表格", "页面证据"


def continued_tables(blocks: DataFrame) -> DataFrame:
    """Adds table_no: a table without a caption that follows a table on the same or the next page continues it."""
    order = Window.partitionBy("file").orderBy("ordinal")
    is_table = F.col("type") == "table"
    before = blocks.withColumn("__page", page_number("page_idx")).withColumn("__type", F.lag("type").over(order)).withColumn("__before", F.lag("__page").over(order))
    bare = F.size(F.coalesce("table_caption", F.array().cast("array<string>"))) == 0
    joins = is_table & (F.col("__type") == "table") & bare & (F.col("__page") <= F.col("__before") + 1)
    return before.withColumn("table_no", F.when(is_table, F.sum((is_table & ~F.coalesce(joins, F.lit(False))).cast("int")).over(order))).drop("__page", "__type", "__before")


def stripped(x: Column) -> Column:
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f of x, where x is computed once however often f uses it."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def first_said(blocks: DataFrame, *names: str) -> Column:
    """The first of these columns that says something: a text without space around it, or a list's joined by spaces."""
    said = []
    for name in names:
        if name in blocks.columns:
            kind = blocks.schema[name].dataType
            each = F.array_join(F.filter(F.transform(name, lambda x: stripped(x.cast("string"))), lambda x: x != ""), " ") if isinstance(kind, T.ArrayType) else stripped(F.col(name).cast("string"))
            said.append(F.nullif(each, F.lit("")))
    return F.coalesce(*said, F.lit(""))


def folded(blocks: DataFrame) -> DataFrame:
    """file, ordinal, level, section_path, id, continues, page_end of a file's blocks, from what came before each.

    The blocks of a file are folded in order, as one array. Carried along are the stack of open headings, the ids that
    are taken, and the last table with its last page: a table without a body and a caption on that page or the next one
    continues it."""
    parts = ["ordinal", "kind", "said", "raw", "page", "bare", "base"]
    listed = blocks.groupBy("file").agg(F.array_sort(F.collect_list(F.struct(*parts))).alias("bs"))
    stack = "array<struct<title:string,level:int>>"
    out = "array<struct<ordinal:int,level:int,section_path:array<string>,id:string,continues:boolean,page_end:int>>"
    none = F.struct(F.array().cast(stack).alias("stack"), F.array().cast("array<string>").alias("taken"), F.lit(None).cast("string").alias("table"), F.lit(None).cast("int").alias("until"), F.array().cast(out).alias("out"))

    def step(acc: Column, b: Column) -> Column:
        current = F.coalesce(F.get(acc.stack, F.size(acc.stack) - 1).level, F.lit(0))
        own = F.when((b.kind == "text") & (b.raw > 0) & (b.said != ""), level(b.said, b.raw, current)).otherwise(0).cast("int")
        continues = b.bare & acc.table.isNotNull() & (b.page <= acc.until + 1)
        numbered = F.transform(F.sequence(F.lit(2), F.size(acc.taken) + 2), lambda k: F.concat(b.base, F.lit("_"), k.cast("string")))
        fresh = F.when(F.array_contains(acc.taken, b.base), F.get(F.filter(numbered, lambda c: ~F.array_contains(acc.taken, c)), F.lit(0))).otherwise(b.base)

        def with_these(x: Column) -> Column:
            opened = F.when(x.own > 0, F.concat(F.filter(acc.stack, lambda h: h.level < x.own), F.array(F.struct(b.said.alias("title"), x.own.alias("level"))))).otherwise(acc.stack).cast(stack)
            is_table = b.kind == "table"
            until = F.when(~is_table, acc.until).when(x.continues, F.greatest(acc.until, b.page)).otherwise(b.page).cast("int")
            table = F.when(is_table & ~x.continues, x.id).otherwise(acc.table)
            taken = F.when(x.id.isNotNull() & ~x.continues, F.concat(acc.taken, F.array(x.id))).otherwise(acc.taken)
            row = F.struct(b.ordinal.cast("int").alias("ordinal"), x.own.alias("level"), F.transform(opened, lambda h: h.title).alias("section_path"), F.when(x.continues, acc.table).otherwise(x.id).alias("id"), x.continues.alias("continues"), F.when(is_table, until).alias("page_end"))
            return F.struct(opened.alias("stack"), taken.alias("taken"), table.alias("table"), until.alias("until"), F.concat(acc.out, F.array(row).cast(out)).alias("out"))

        return let(F.struct(own.alias("own"), F.coalesce(continues, F.lit(False)).alias("continues"), F.when(b.base.isNotNull(), fresh).alias("id")), with_these)

    return listed.select("file", F.inline(F.aggregate("bs", none, step, lambda acc: acc.out)))


def laid_out(blocks: DataFrame, assets: DataFrame | None = None) -> DataFrame:
    """Blocks that are rendered, each with its lines and the line that it begins on.

    blocks: file, ordinal, type, page_idx and what the type asks for: text, text_level, content, latex, img_path,
    captions, table_body, list_items, code_body. assets: file, img_path of the images that are there (none is known
    of: none is). Adds block_id, kind, page, caption, level, section_path, id, continues, page_end, there, anchor,
    lines, line. Auxiliary blocks go; texts, equations and others that say nothing have no lines, but open a page."""
    order = Window.partitionBy("file").orderBy("ordinal")
    kind = stripped(F.coalesce("type", F.lit("")))
    rows = blocks.withColumns({"kind": kind, "page": page_number("page_idx")}).filter(~F.col("kind").isin(*AUXILIARY_BLOCKS))
    is_image, is_table = F.col("kind").isin(*IMAGE_BLOCKS), F.col("kind") == "table"
    counted = lambda test: F.sum(test.cast("int")).over(order)
    raw = F.coalesce(F.col("text_level").try_cast("int"), F.lit(0)) if "text_level" in blocks.columns else F.lit(0)
    path = first_said(blocks, "img_path", "image_path", "path")
    rows = rows.withColumns({"n_image": counted(is_image), "n_table": counted(is_table), "n_equation": counted(F.col("kind") == "equation"), "before": F.lag("page").over(order), "raw": raw, "img": path, "block_id": F.format_string("block_%05d", F.col("ordinal") + 1)})
    place = lambda label, n: F.concat(label, F.lit(" p"), F.col("page").cast("string"), F.lit("-"), F.col(n).cast("string"))
    or_else = lambda x, y: F.coalesce(F.nullif(x, F.lit("")), y)
    drawn = or_else(first_said(blocks, "image_caption", "chart_caption", "caption", "title", "text"), place(F.when(F.col("kind") == "chart", "Chart").otherwise("Figure"), "n_image"))
    over = first_said(blocks, "table_caption", "caption")
    body = first_said(blocks, "table_body", "html", "text", "content")
    said = F.when(is_table, body).when(F.col("kind") == "equation", first_said(blocks, "text", "latex", "content")).when(F.col("kind") == "code", first_said(blocks, "code_body", "text", "content")).otherwise(first_said(blocks, "text", "content"))
    rows = rows.withColumns({"said": said, "caption": F.when(is_image, drawn).when(is_table, or_else(over, place(F.lit("Table"), "n_table"))), "bare": is_table & (over == "") & (body == "")})
    base = F.when(is_image, asset_base(F.col("caption"), F.lit("fig"), F.col("page"), F.col("n_image"))).when(is_table, asset_base(F.col("caption"), F.lit("table"), F.col("page"), F.col("n_table")))
    rows = rows.withColumn("base", base)
    if assets is None:
        rows = rows.withColumn("there", F.lit(False))
    else:
        rows = rows.join(assets.select("file", F.col("img_path").alias("img"), F.lit(True).alias("there")).distinct(), ["file", "img"], "left").withColumn("there", F.coalesce("there", F.lit(False)))
    met = rows.join(folded(rows), ["file", "ordinal"])
    items = F.col("list_items") if "list_items" in blocks.columns else F.lit(None).cast("array<string>")
    listed = F.filter(F.transform(items, lambda x: F.concat(F.lit("- "), stripped(x.cast("string")))), lambda x: x != "- ")
    listed = F.when(items.isNull(), F.when(F.col("said") != "", F.array("said")).otherwise(F.array().cast("array<string>"))).otherwise(listed)
    note = lambda *parts: F.concat(F.lit("<!-- "), *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts], F.lit(" -->"))
    blank, page = F.lit(""), F.col("page")
    quality = F.when(F.col("said") != "", "pass").otherwise("warn")
    lines = (
        F.when(is_image, F.array(F.concat(F.lit("!["), "caption", F.lit("]("), image_path(), F.lit(")")), blank))
        .when(F.col("continues"), F.array(note("table-continuation: ", F.col("id"), "; source-page: ", page, "; qa: warn"), blank))
        .when(is_table, F.array(F.concat(F.lit("**"), "caption", F.lit("**")), blank, F.concat(F.lit(f"[{TABLE_LINK}]("), table_path(), F.lit(")")), blank, note("table-id: ", F.col("id"), "; source-page: ", page, "; qa: ", quality), blank))
        .when(F.col("kind") == "list", F.when(F.size(listed) > 0, F.concat(listed, F.array(blank))).otherwise(listed))
        .when(F.col("said") == "", F.array().cast("array<string>"))
        .when(F.col("kind") == "equation", F.array(note("block-id: eq_p", page, "_n", F.col("n_equation"), "; source-page: ", page, "; qa: review"), blank, F.col("said"), blank))
        .when(F.col("kind") == "code", F.array(F.lit("```"), F.col("said"), F.lit("```"), blank))
        .when((F.col("kind") == "text") & (F.col("level") > 0), F.array(F.concat(F.repeat(F.lit("#"), F.col("level")), F.lit(" "), "said"), blank))
        .when((F.col("kind") == "text") & (F.col("raw") > 0), F.array(F.concat(F.lit("**"), "said", F.lit("**")), blank))
        .otherwise(F.array(F.col("said"), blank))
    )
    anchor = F.when(page.eqNullSafe(F.col("before")), F.array().cast("array<string>")).otherwise(F.array(note("source-page: ", page), blank))
    shown = met.withColumns({"lines": lines, "anchor": anchor})
    length = F.size("anchor") + F.size("lines")
    return shown.withColumn("line", (F.sum(length).over(order) - F.size("lines") + 1).cast("int")).drop("before", "base")


def suffix(known: tuple[str, ...]) -> Column:
    own = F.lower(F.regexp_extract("img", r"[^./\\](\.[^./\\]+)$", 1))
    return F.when(own.isin(*known), own).otherwise(".png")


def image_path() -> Column:
    return F.concat(F.lit("images/"), "id", suffix(COPIED_SUFFIXES))


def table_path() -> Column:
    return F.concat(F.lit("tables/"), "id", F.lit(".md"))


def render(blocks: DataFrame, assets: DataFrame | None = None) -> DataFrame:
    """file, markdown, n_lines, n_blocks, max_page: one Markdown document for each file."""
    return documents(laid_out(blocks, assets))


def documents(laid: DataFrame) -> DataFrame:
    each = F.array_sort(F.collect_list(F.struct("ordinal", F.concat("anchor", "lines").alias("ls"))))
    joined = F.concat(stripped(F.array_join(F.flatten(F.transform("ls", lambda x: x.ls)), "\n")), F.lit("\n"))
    found = laid.groupBy("file").agg(each.alias("ls"), F.count("*").cast("int").alias("n_blocks"), F.max("page").alias("max_page"))
    found = found.select("file", joined.alias("markdown"), "n_blocks", "max_page")
    return found.select("file", "markdown", F.regexp_count("markdown", F.lit("\n")).alias("n_lines"), "n_blocks", "max_page")


def images(laid: DataFrame) -> DataFrame:
    """file, id, caption, page, section_path, path, type, line, quality of images and charts."""
    shown = laid.filter(F.col("kind").isin(*IMAGE_BLOCKS))
    return shown.select("file", "id", "caption", "page", "section_path", image_path().alias("path"), F.col("kind").alias("type"), "line", F.when(F.col("there"), "pass").otherwise("fail").alias("quality"))


def tables(laid: DataFrame) -> DataFrame:
    """file, id, caption, page_start, page_end, section_path, path, evidence_path, line, quality, markdown: tables, each
    with the document of its own; one that goes on over pages is one, and to be checked."""
    own = laid.filter("kind = 'table'")
    known = own.filter("NOT continues")
    goes_on = own.filter("continues").groupBy("file", "id").agg(F.max("page_end").alias("__until"))
    met = known.join(goes_on, ["file", "id"], "left")
    evidence = F.when(F.col("there"), F.concat(F.lit("tables/"), "id", F.lit("_source"), suffix(COPIED_SUFFIXES)))
    name = F.element_at(F.split(evidence, "/"), -1)
    body = F.when(F.col("said") != "", prettify_tables("said")).otherwise("<!-- table-body-unavailable -->")
    shown = F.when(F.col("there"), F.concat(F.lit(f"## {PAGE_EVIDENCE}\n\n!["), "caption", F.lit("]("), name, F.lit(")\n"))).otherwise("")
    markdown = F.concat(F.lit("# "), "caption", F.lit("\n\n<!-- table-id: "), "id", F.lit("; source-page: "), F.col("page").cast("string"), F.lit(" -->\n\n"), body, F.lit("\n"), F.when(F.col("there"), "\n").otherwise(""), shown)
    quality = F.when((F.col("said") == "") | F.col("__until").isNotNull(), "warn").otherwise("pass")
    return met.select("file", "id", "caption", F.col("page").alias("page_start"), F.greatest("page", F.coalesce("__until", "page")).alias("page_end"), "section_path", table_path().alias("path"), evidence.alias("evidence_path"), "line", quality.alias("quality"), markdown.alias("markdown"))


def issues(laid: DataFrame) -> DataFrame:
    """file, code, severity, page, id of what a reviewer should look at."""
    said = lambda test, code, severity: F.when(test, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity")))
    is_table = F.col("kind") == "table"
    each = F.array_compact(F.array(
        said(F.col("kind").isin(*IMAGE_BLOCKS) & ~F.col("there"), "missing-image-asset", "fail"), said(is_table & F.col("continues"), "cross-page-table-continuation-unresolved", "warn"),
        said(is_table & ~F.col("continues") & (F.col("said") == ""), "table-body-unavailable", "warn")))
    own = laid.select("file", F.explode(each).alias("i"), "page", "id").select("file", "i.code", "i.severity", "page", "id")
    titled = (F.col("kind") == "text") & (F.col("raw") > 0) & (F.col("said") != "")
    flat = laid.filter(titled).groupBy("file").agg(F.count_distinct("raw").alias("levels"), F.count("*").alias("n")).filter("levels = 1 AND n > 10")
    return own.unionByName(flat.select("file", F.lit("heading-levels-reconstructed").alias("code"), F.lit("info").alias("severity"), F.lit(None).cast("int").alias("page"), F.lit(None).cast("string").alias("id")))


def headings(docs: DataFrame, source: str = "document_path", body: str = "markdown") -> DataFrame:
    """document, section_id, start_line, level, title, total_lines: what an outline is built from."""
    each = docs.select(F.col(source).alias("document_path"), content_lines(body).alias("ls")).select("document_path", F.size("ls").alias("total_lines"), F.posexplode("ls").alias("i", "line"))
    found = each.withColumn("level", F.length(F.regexp_extract("line", OUTLINE_HEADING, 1))).filter("level > 0")
    listed = found.groupBy("document_path").agg(F.array_sort(F.collect_list(F.struct("i", "level", F.regexp_extract("line", OUTLINE_HEADING, 2).alias("title"), "total_lines"))).alias("hs"))
    ids = unique_ids(F.transform("hs", lambda h, k: base_id(h.title, k + 1)))
    each = listed.select("document_path", F.inline(F.arrays_zip(F.col("hs").alias("h"), ids.alias("section_id"))))
    return each.select("document_path", "section_id", (F.col("h.i") + 1).alias("start_line"), "h.level", "h.title", "h.total_lines")


def section_pages(docs: DataFrame, sections: DataFrame, source: str = "document_path", body: str = "markdown") -> DataFrame:
    """Distinct page anchors within each section's scope, with the page that is open at its start."""
    anchors = docs.select(F.col(source).alias("document_path"), F.posexplode(content_lines(body)).alias("i", "line")).withColumn("page", F.regexp_extract("line", r"<!-- source-page:\s*(\d+)\s*-->", 1)).filter("page <> ''").select("document_path", (F.col("i") + 1).alias("line"), F.col("page").cast("int").alias("page"))
    order = Window.partitionBy("document_path").orderBy("line")
    spans = anchors.withColumn("until", F.coalesce(F.lead("line").over(order) - 1, F.lit(2**31 - 1)))
    spans = spans.withColumnRenamed("document_path", "__doc")
    met = sections.join(spans, (F.col("document_path") == F.col("__doc")) & (F.col("line") <= F.col("end_line")) & (F.col("until") >= F.col("start_line")), "left")
    return met.groupBy("document_path", "section_id").agg(F.array_sort(F.collect_set("page")).alias("pages"))
