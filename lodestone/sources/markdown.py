"""Markdown folders as DataFrames: scans, front matter, bodies, tables, links, tasks. All parsing is Catalyst folds
over a document's lines; files are read whole by Spark's own reader, from any file system it knows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.paths import is_visible_markdown
from ..functions.text import WIKILINK, content_lines, empty, sha256
from .files import folders

DEFAULT_PATTERNS = (r"\.md$",)


def scan(spark: SparkSession, root: str, patterns: tuple[str, ...] = DEFAULT_PATTERNS) -> DataFrame:
    """source (path below the root), content, sha256, of visible Markdown files that any pattern finds; each once."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").text(folders(spark, root), wholetext=True)
    path = F.regexp_replace(F.url_decode(F.col("_metadata.file_path")), r"^[a-z]+:/*(?=/)", "")
    base = root.rstrip("/").removeprefix("file://")
    found = files.select(F.regexp_replace(F.replace(path, F.lit(base), F.lit("")), "^/+", "").alias("source"), F.regexp_replace("value", "^﻿", "").alias("content"))
    wanted = F.exists(F.array(*[F.lit(p) for p in patterns]), lambda p: F.rlike(F.col("source"), p))
    return found.filter(is_visible_markdown("source") & wanted).dropDuplicates(["source"]).withColumn("sha256", sha256("content"))


def _unquote(x: Column) -> Column:
    return F.regexp_replace(F.trim(x), r"""^(["'])(.*)\1$""", "$2")


def front_matter(body: Column | str) -> Column:
    """map<string, array<string>> of a document's front matter; null where it has none or doesn't close it."""
    all_lines = content_lines(body)
    closing = F.array_position(F.slice(all_lines, 2, F.size(all_lines)), F.lit("---"))
    inner = F.slice(all_lines, F.lit(2), (closing - 1).cast("int"))
    state = F.struct(empty("struct<k:string,v:array<string>>").alias("pairs"))

    def step(acc: Column, line: Column) -> Column:
        key, rest = F.regexp_extract(line, r"^([A-Za-z0-9_.-]+)\s*:(.*)$", 1), F.regexp_extract(line, r"^([A-Za-z0-9_.-]+)\s*:(.*)$", 2)
        item = F.regexp_extract(line, r"^\s*-\s+(.*)$", 1)
        inline = F.regexp_extract(F.trim(rest), r"^\[(.*)\]$", 1)
        values = F.when(F.trim(rest) == "", empty()).when(inline != "", F.transform(F.split(inline, ","), _unquote)).otherwise(F.array(_unquote(rest)))
        last = F.element_at(acc.pairs, -1)
        grown = F.concat(F.slice(acc.pairs, F.lit(1), F.size(acc.pairs) - 1), F.array(F.struct(last.k.alias("k"), F.concat(last.v, F.array(_unquote(item))).alias("v"))))
        pairs = (
            F.when(F.trim(line).startswith("#") | (F.trim(line) == ""), acc.pairs)
            .when(key != "", F.concat(acc.pairs, F.array(F.struct(key.alias("k"), values.alias("v")))))
            .when((item != "") & (F.size(acc.pairs) > 0), grown).otherwise(acc.pairs)
        )
        return F.struct(pairs.alias("pairs"))

    parsed = F.aggregate(inner, state, step, lambda acc: acc.pairs)
    # Of a key that comes twice the last counts.
    unique = F.filter(parsed, lambda p, i: ~F.exists(F.slice(parsed, i + 2, F.size(parsed)), lambda q: q.k == p.k))
    return F.when((F.get(all_lines, F.lit(0)) == "---") & (closing > 0), F.map_from_entries(unique))


def body_text(body: Column | str) -> Column:
    """The text after the front matter; the whole where there is none, and nothing where it isn't closed."""
    all_lines = content_lines(body)
    closing = F.array_position(F.slice(all_lines, 2, F.size(all_lines)), F.lit("---"))
    rest = F.array_join(F.slice(all_lines, (closing + 2).cast("int"), F.size(all_lines)), "\n")
    return F.when(F.get(all_lines, F.lit(0)) != "---", F.col(body) if isinstance(body, str) else body).when(closing > 0, rest).otherwise("")


def _cells(line: Column) -> Column:
    return F.transform(F.split(F.regexp_replace(F.trim(line), r"^\||\|$", ""), r"(?<!\\)\|"), lambda x: F.trim(x))


def tables(docs: DataFrame, source: str = "source", body: str = "content") -> DataFrame:
    """source, table_no, headers, rows: a header line, a separator, and the rows after it of equal width."""
    lines = docs.select(F.col(source).alias("source"), F.posexplode(content_lines(body)).alias("i", "line"))
    order = Window.partitionBy("source").orderBy("i")
    marked = lines.withColumn("is_row", F.trim("line").startswith("|")).withColumn("next", F.lead("line").over(order))
    head = F.col("is_row") & F.col("next").rlike(r"^\s*\|?\s*:?-{3,}:?\s*(\|\s*:?-{3,}:?\s*)*\|?\s*$")
    breaks = (~F.col("is_row")) | head
    grouped = marked.withColumn("head", head).withColumn("block", F.sum(breaks.cast("int")).over(order)).filter("is_row")
    rows = grouped.groupBy("source", "block").agg(F.array_sort(F.collect_list(F.struct("i", "head", _cells(F.col("line")).alias("cells")))).alias("ls")).filter(F.get("ls", F.lit(0)).head)
    headers = F.get("ls", F.lit(0)).cells
    kept = F.filter(F.transform(F.slice("ls", 3, F.size("ls")), lambda x: x.cells), lambda c: F.size(c) == F.size(headers))
    return rows.select("source", F.row_number().over(Window.partitionBy("source").orderBy("block")).alias("table_no"), headers.alias("headers"), kept.alias("rows"))


#: Headers of evidence tables.
EVIDENCE = {"bundle": ("bundle", "bundle id", "source bundle id"), "section": ("section", "section id", "source section id"), "pages": ("pages", "source pages"), "lines": ("lines", "owned lines", "source lines")}


def evidence_rows(found: DataFrame) -> DataFrame:
    """source, bundle, section, pages, lines: rows of tables that have all four columns, and name a bundle."""
    tick = lambda c: F.regexp_replace(F.trim(c), "^`+|`+$", "")
    headers = F.transform("headers", lambda h: F.regexp_replace(F.lower(tick(h)), r"[\s_-]+", " "))

    def column(names: tuple[str, ...]) -> Column:
        return F.array_position(F.transform(headers, lambda h: h.isin(*names)), F.lit(True))

    place = {k: column(names) for k, names in EVIDENCE.items()}
    each = found.select("source", "table_no", *[p.cast("int").alias(f"at_{k}") for k, p in place.items()], F.posexplode("rows").alias("row_no", "r"))
    each = each.filter(" AND ".join(f"at_{k} > 0" for k in EVIDENCE))
    values = each.select("source", "table_no", "row_no", *[tick(F.element_at("r", F.col(f"at_{k}"))).alias(k) for k in EVIDENCE])
    return values.withColumn("bundle", F.regexp_extract("bundle", r"bundle-v2-[0-9a-fA-F]{16,64}", 0)).filter("bundle <> ''")


def links(body: Column | str) -> Column:
    """Targets of wikilinks, without label and anchor; distinct, in order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.col(body) if isinstance(body, str) else body, F.lit(WIKILINK), F.lit(1)), lambda x: F.trim(x)))


def tasks(docs: DataFrame, source: str = "source", body: str = "content") -> DataFrame:
    """source, line, completed, task: list items with a check box."""
    each = docs.select(F.col(source).alias("source"), F.posexplode(content_lines(body)).alias("i", "text")).filter(F.col("text").rlike(r"^\s*[-*]\s+\[[ xX]\]\s"))
    return each.select("source", (F.col("i") + 1).alias("line"), F.col("text").rlike(r"\[[xX]\]").alias("completed"), F.regexp_replace("text", r"^\s*[-*]\s+\[[ xX]\]\s+", "").alias("task"))


def governed(docs: DataFrame, source: str = "source", body: str = "content") -> DataFrame:
    """path, frontmatter, body, links of Markdown files."""
    return docs.select(F.col(source).alias("path"), front_matter(body).alias("frontmatter"), body_text(body).alias("body"), links(body).alias("links"))


def stem_links(docs: DataFrame) -> DataFrame:
    """Degree of each note: path, inlinks, outlinks, by stems of link targets, casefolded. docs: path, links."""
    stem = lambda c: F.lower(F.regexp_replace(F.element_at(F.split(c, "/"), -1), r"\.md$", ""))
    edges = docs.select("path", F.explode("links").alias("t")).select("path", stem(F.col("t")).alias("stem")).distinct()
    inlinks = edges.groupBy("stem").agg(F.count("*").alias("inlinks"))
    return docs.select("path", F.size("links").alias("outlinks"), stem(F.col("path")).alias("stem")).join(inlinks, "stem", "left").select("path", F.coalesce("inlinks", F.lit(0)).alias("inlinks"), "outlinks")


def unresolved_links(docs: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """path, target: links whose target is no file's path or stem, casefolded. docs: path, links."""
    files = (names if names is not None else docs).select("path")
    clean = F.lower(F.regexp_replace("path", r"\.md$", ""))
    known = files.select(clean.alias("name")).unionByName(files.select(F.element_at(F.split(clean, "/"), -1).alias("name"))).distinct()
    asked = docs.select("path", F.explode("links").alias("target")).withColumn("name", F.lower(F.regexp_replace("target", r"\.md$", "")))
    return asked.join(known, "name", "left_anti").select("path", "target")
