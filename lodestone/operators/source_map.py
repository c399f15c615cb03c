"""Markdown renderings of ledgers: a source map of each, a row for each section."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import ranges_id, table_cell


def render(sections: DataFrame, by: str = "bundle_id") -> DataFrame:
    """by, markdown. sections: by, id, title, level, start_line, content_ranges, pages, quality, status, outputs."""
    pages = F.array_join(F.transform("pages", lambda p: p.cast("string")), ", ")
    cells = [table_cell("id"), F.concat(F.repeat(F.lit("  "), F.greatest(F.lit(0), F.col("level") - 1)), table_cell("title")), F.regexp_replace(ranges_id(F.col("content_ranges")), "^lines-", ""), pages, table_cell("quality"), table_cell("status"), F.array_join(F.transform("outputs", table_cell), "<br>")]
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(c, F.lit("")) for c in cells]), F.lit(" |"))
    head = "| Section | Title | Lines | Pages | Quality | Status | Outputs |\n| --- | --- | --- | --- | --- | --- | --- |\n"
    listed = F.array_sort(F.collect_list(F.struct("start_line", "id", row.alias("row"))))
    counts = F.concat(F.lit("sections: "), F.count("*").cast("string"), F.lit("\n\n"))
    return sections.groupBy(by).agg(F.concat(F.lit("---\ntype: source-map\n"), F.lit(f"{by}: "), F.first(by).cast("string"), F.lit("\n---\n\n"), counts, F.lit(head), F.array_join(F.transform(listed, lambda x: x["row"]), "\n"), F.lit("\n")).alias("markdown"))
