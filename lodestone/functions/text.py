"""Scalar text functions as Catalyst expressions; nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of tokens, terms, headings and links.
TOKEN = r"[a-z0-9_]+|[㐀-鿿]"
TERM = r"(?U)[\w㐀-鿿]+"
QUERY_TOKEN = r"[A-Za-z]+\d*[A-Za-z0-9._/-]*|\d+[A-Za-z][A-Za-z0-9._/-]*|\d+(?:\.\d+)?|[㐀-鿿]+"
UNIT = r"(?U)[㐀-鿿]|[\w&&[^㐀-鿿]]+|\s+|[^\w\s]"
CJK_RUN = r"^[㐀-鿿]+$"
HEADING = r"^(#{1,6})\s+(.*)"
OUTLINE_HEADING = r"^(#{1,6})\s+(.+?)\s*$"
WIKILINK = r"\[\[([^\]|#]+)"
UNRESERVED = r"[^A-Za-z0-9._-]+"


def text(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def empty(kind: str = "string") -> Column:
    return F.array().cast(f"array<{kind}>")


#: What full case folding changes in lower-case letters, but for the common ß, by Unicode's own table.
FOLDS = {chr(c): chr(c).casefold() for c in range(0x110000) if chr(c).casefold() != chr(c) == chr(c).lower() and chr(c) != "ß"}
RARE = "[" + "".join(sorted(FOLDS)) + "]"


def casefold(x: Column | str, full: bool = False) -> Column:
    """Lower case with ß as ss; with ``full``, Unicode's full case folding, at the price of a search for the rare letters
    that only folding changes. Index and questions are folded alike, so tokens use the plain form."""
    low = F.replace(F.lower(text(x)), F.lit("ß"), F.lit("ss"))
    if not full:
        return low
    folds = F.map_from_arrays(F.array(*map(F.lit, FOLDS)), F.array(*map(F.lit, FOLDS.values())))
    return F.when(low.rlike(RARE), F.array_join(F.transform(F.split(low, ""), lambda c: F.coalesce(folds[c], c)), "")).otherwise(low)


def tokens(x: Column | str) -> Column:
    """Index tokens: runs of a-z, digits and underscore, or single CJK characters, of the casefolded text."""
    return F.regexp_extract_all(casefold(x), F.lit(TOKEN), F.lit(0))


def terms(x: Column | str) -> Column:
    """Distinct words of the casefolded text, by Unicode's notion of a word; for similarity."""
    return F.array_distinct(F.regexp_extract_all(casefold(x), F.lit(TERM), F.lit(0)))


def token_count(x: Column | str) -> Column:
    return F.size(F.regexp_extract_all(text(x), F.lit(r"[A-Za-z0-9_]+|[㐀-鿿]"), F.lit(0)))


def longest_first(words: Column) -> Column:
    return F.array_sort(words, lambda a, b: F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1).when(a < b, -1).when(a > b, 1).otherwise(0))


def query_terms(x: Column | str) -> Column:
    """Distinct terms of a question: codes and words whole, CJK runs as all their 2- to 4-grams; longest first."""
    found = F.regexp_extract_all(casefold(x), F.lit(QUERY_TOKEN), F.lit(0))

    def grams(token: Column) -> Column:
        n = F.length(token)
        sizes = F.sequence(F.lit(2), F.least(F.lit(4), n))
        return F.flatten(F.transform(sizes, lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(token, i, k))))

    split = F.transform(found, lambda t: F.when(~t.rlike(CJK_RUN), F.array(t)).when(F.length(t) >= 2, grams(t)).otherwise(empty()))
    return longest_first(F.array_distinct(F.flatten(split)))


def matched(words: Column, folded: Column) -> Column:
    """The terms that a casefolded text has as substrings. Fold a column below a join or an exchange: within the
    lambda it would be folded for each term."""
    return F.filter(words, lambda t: F.contains(folded, t))


def match_score(found: Column, weight: int) -> Column:
    """weight * max(1, length - 1), summed over matched terms."""
    return F.aggregate(found, F.lit(0), lambda total, t: total + F.lit(weight) * F.greatest(F.lit(1), F.length(t) - 1))


def compact_terms(words: Column, limit: int = 8) -> Column:
    """Longest first; a term within a kept one goes; the first ``limit`` stay."""
    kept = F.aggregate(longest_first(F.array_distinct(words)), empty(), lambda acc, t: F.when(F.exists(acc, lambda k: F.contains(k, t)), acc).otherwise(F.concat(acc, F.array(t))))
    return F.slice(kept, 1, limit)


def title_key(x: Column | str) -> Column:
    return F.regexp_replace(casefold(F.coalesce(text(x), F.lit(""))), r"(?U)\s+", "")


def heading_level(line: Column | str) -> Column:
    return F.length(F.regexp_extract(text(line), HEADING, 1))


def heading_title(line: Column | str) -> Column:
    return F.trim(F.regexp_extract(text(line), HEADING, 2))


def chunk_type(body: Column | str, path: Column | str) -> Column:
    body, name = text(body), F.lower(F.element_at(F.split(text(path), "/"), -1))
    links = (F.length(body) - F.length(F.replace(body, F.lit("[["), F.lit("")))) / 2
    return (
        F.when(F.contains(casefold(body), F.lit("backlinks")) | F.contains(body, F.lit("反向链接")), "backlink")
        .when((links > 5) & (F.length(body) < 300), "navigation")
        .when(F.endswith(name, F.lit(".source-map.md")) | F.endswith(name, F.lit(".spec-index.md")), "index")
        .when(F.startswith(body, F.lit("---")), "metadata")
        .otherwise("normal")
    )


def lines(x: Column | str) -> Column:
    """Lines as an editor counts them: line ends unified, a trailing one adds an empty line."""
    return F.split(F.regexp_replace(text(x), r"\r\n|\r", "\n"), "\n")


def content_lines(x: Column | str) -> Column:
    """Lines of the content: a trailing line end adds none, and the empty text has none."""
    unified = F.regexp_replace(text(x), r"\r\n|\r", "\n")
    return F.when(unified == "", empty()).otherwise(F.split(F.regexp_replace(unified, r"\n$", ""), "\n"))


def read_ranges(body_lines: Column, ranges: Column, marks: bool = False, most_chars: int | None = None) -> Column:
    """Text of line ranges, joined by line ends; with a comment before each range, and cut, if asked for."""

    def part(r: Column) -> Column:
        start = F.greatest(F.lit(1), r.start_line)
        n = F.greatest(F.lit(0), F.least(F.size(body_lines), r.end_line) - start + 1)
        own = F.slice(body_lines, start, n)
        return F.concat(F.array(F.format_string("<!-- lines %d-%d -->", r.start_line, r.end_line)), own) if marks else own

    joined = F.array_join(F.flatten(F.transform(ranges, part)), "\n")
    return F.substring(joined, 1, most_chars) if most_chars else joined


def sha256(x: Column | str) -> Column:
    return F.sha2(text(x).cast("binary"), 256)


def safe_id(x: Column | str, most: int = 120) -> Column:
    """Letters, digits, dot, underscore and hyphen; other runs become one hyphen; trimmed and cut."""
    return F.substring(F.regexp_replace(F.regexp_replace(text(x), UNRESERVED, "-"), r"^[-.]+|[-.]+$", ""), 1, most)


def shorten(x: Column | str, n: int) -> Column:
    t = F.trim(text(x))
    return F.when(F.length(t) > n, F.concat(F.substring(t, 1, n - 1), F.lit("…"))).otherwise(t)


def table_cell(x: Column | str) -> Column:
    return F.regexp_replace(F.replace(F.coalesce(text(x).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")), r"\s*\n\s*", " ")


def truthy(x: Column | str) -> Column:
    return F.lower(F.trim(text(x).cast("string"))).isin("1", "true", "yes", "y", "on")


def first_text(*xs: Column) -> Column:
    """The first that isn't blank."""
    return F.coalesce(*[F.nullif(F.trim(x), F.lit("")) for x in xs])


def reason_split(x: Column | str) -> tuple[Column, Column]:
    """``path::reason``; a default reason where there is none."""
    parts = F.split(text(x), "::", 2)
    return parts[0], F.coalesce(F.nullif(F.get(parts, F.lit(1)), F.lit("")), F.lit("not selected"))


def prettify_tables(x: Column | str) -> Column:
    return F.when(F.lower(text(x)).contains("<table"), F.regexp_replace(text(x), r">\s*<", ">\n<")).otherwise(text(x))


def page_number(index: Column | str) -> Column:
    """A 0-based page index as a 1-based page; what is no number is page 1."""
    return F.coalesce(F.expr(f"try_cast({index} AS INT)") if isinstance(index, str) else index.try_cast("int"), F.lit(0)) + 1


def clean_pages(pages: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(pages, lambda p: p >= 1)))


def ranges_id(ranges: Column) -> Column:
    return F.concat(F.lit("lines-"), F.array_join(F.transform(ranges, lambda r: F.concat_ws("-", r.start_line.cast("string"), r.end_line.cast("string"))), "+"))


def span(ranges: Column) -> Column:
    """Number of lines of all ranges."""
    return F.aggregate(ranges, F.lit(0), lambda total, r: total + r.end_line - r.start_line + 1)


def valid_ranges(ranges: Column, start: Column, end: Column) -> Column:
    """The ranges that are in order, else the whole scope."""
    good = F.filter(F.coalesce(ranges, empty("struct<start_line:int,end_line:int>")), lambda r: (r.start_line >= 1) & (r.end_line >= r.start_line))
    whole = F.when((start >= 1) & (end >= start), F.array(F.struct(start.cast("int").alias("start_line"), end.cast("int").alias("end_line")))).otherwise(empty("struct<start_line:int,end_line:int>"))
    return F.when(F.size(good) > 0, good).otherwise(whole)


def questions(x: Column | str) -> Column:
    """How many questions a text holds: question marks, or numbered lines if more."""
    return F.greatest(F.regexp_count(text(x), F.lit(r"[?？]")), F.regexp_count(text(x), F.lit(r"(?m)^\s*\d+[.)、．]\s*\S")))
