"""Saved dashboard queries: the small language of note dashboards, compiled to DataFrames over a table of notes.

    table <expression> as <Name>, ... | task
    from "<folder>"
    where <condition>
    sort <expression> [asc|desc]
    limit <n>

Expressions are names of front matter fields, file.folder, file.mtime, file.name, file.path, file.inlinks and
file.outlinks, and length(), startswith(), =, !=, ! over them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Dashboards that a new folder starts with.
SAVED = {
    "raw_sources": 'table file.folder as Folder, file.mtime as Modified\nfrom "10_Raw"\nsort file.mtime desc',
    "knowledge_cards": 'table source as Source, status as Status, domains as Domains, file.mtime as Modified\nfrom "30_Cards"\nwhere type = "knowledge-card"\nsort file.mtime desc',
    "recent_changes": 'table file.folder as Folder, file.mtime as Modified\nfrom ""\nwhere !startswith(file.path, ".obsidian")\nsort file.mtime desc\nlimit 20',
    "concepts": 'table status as Status, domains as Domains, file.inlinks as Inlinks, file.outlinks as Outlinks\nfrom "40_Concepts"\nwhere type = "concept"\nsort length(file.inlinks) desc',
    "projects": 'table status as Status, domains as Domains, source as Source, file.mtime as Modified\nfrom "50_Projects"\nwhere type = "project-note"\nsort file.mtime desc',
    "system": 'table status as Status, scope as Scope, file.mtime as Modified\nfrom "_system"\nsort file.mtime desc',
    "meetings": 'table meeting_date as Date, topic as Topic, participants as Participants, projects as Projects, status as Status, source as Source\nfrom "20_Notes/Meetings"\nwhere type = "meeting-note"\nsort meeting_date desc',
    "open_tasks": 'task\nfrom ""\nwhere !completed',
}


def expression(text: str) -> Column:
    """A column over notes: path, mtime, frontmatter, inlinks, outlinks (arrays), and completed for tasks."""
    text = text.strip()
    for sign, op in ((" != ", lambda a, b: ~a.eqNullSafe(b)), (" = ", lambda a, b: a.eqNullSafe(b))):
        if sign in text:
            left, right = text.split(sign, 1)
            return op(expression(left), expression(right))
    if text.startswith("!"):
        return ~F.coalesce(expression(text[1:]), F.lit(False))
    if m := re.fullmatch(r'"([^"]*)"', text):
        return F.lit(m[1])
    if re.fullmatch(r"\d+", text):
        return F.lit(int(text))
    if m := re.fullmatch(r"length\((.*)\)", text):
        return F.size(expression(m[1]))
    if m := re.fullmatch(r"startswith\((.*),(.*)\)", text):
        return F.startswith(expression(m[1]), expression(m[2]))
    file = {"folder": F.regexp_extract("path", r"^(.*)/[^/]*$", 1), "name": F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.md$", ""), "path": F.col("path"), "mtime": F.col("mtime"), "inlinks": F.col("inlinks"), "outlinks": F.col("outlinks")}
    if m := re.fullmatch(r"file\.(\w+)", text):
        return file[m[1]]
    if text == "completed":
        return F.col("completed")
    if re.fullmatch(r"\w+", text):
        return F.array_join(F.col("frontmatter")[text], ", ")
    raise ValueError(f"can't read the expression {text!r}")


def run(query: str, notes: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """The rows of a dashboard query, in its order. Equal keys are ordered by path."""
    parts: dict[str, str] = {}
    for line in filter(None, map(str.strip, query.strip().splitlines())):
        word, _, rest = line.partition(" ")
        if word not in ("table", "task", "from", "where", "sort", "limit"):
            raise ValueError(f"can't read the line {line!r}")
        parts[word] = rest
    rows = tasks if "task" in parts else notes
    if rows is None:
        raise ValueError("a task query needs tasks")
    folder = parts.get("from", '""').strip().strip('"')
    if folder:
        rows = rows.filter(F.startswith("path", F.lit(folder.rstrip("/") + "/")))
    if "where" in parts:
        rows = rows.filter(expression(parts["where"]))
    if "sort" in parts:
        key, _, way = parts["sort"].rpartition(" ")
        key, way = (key, way) if way in ("asc", "desc") else (parts["sort"], "asc")
        column = expression(key)
        rows = rows.orderBy(column.desc_nulls_last() if way == "desc" else column.asc_nulls_last(), "path")
    if "limit" in parts:
        rows = rows.limit(int(parts["limit"]))
    if "task" in parts:
        return rows.select("path", "line", "completed", "task")
    named = [re.fullmatch(r"(.+?)\s+as\s+(\w+)", p.strip()) or re.fullmatch(r"((\S+))", p.strip()) for p in re.split(r",(?![^()]*\))", parts["table"])]
    return rows.select("path", *[expression(m[1]).alias(m[2]) for m in named])
