"""Paths in a governed folder, as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import text


def normalised(x: Column | str) -> Column:
    return F.regexp_replace(F.replace(F.coalesce(text(x), F.lit("")), F.lit("\\"), F.lit("/")), "^/+|/+$", "")


def is_relative(x: Column | str) -> Column:
    """Within the folder: not empty, not absolute, no drive, no dot alone, no step upwards."""
    path = F.replace(F.coalesce(text(x), F.lit("")), F.lit("\\"), F.lit("/"))
    return ~path.isin("", ".") & ~path.rlike(r"^/|^[A-Za-z]:") & ~F.array_contains(F.split(path, "/"), "..")


def is_visible_markdown(x: Column | str) -> Column:
    path = text(x)
    return F.lower(path).endswith(".md") & ~F.exists(F.split(path, "/"), lambda p: p.startswith(".") | p.startswith("~"))


def name(x: Column | str) -> Column:
    return F.element_at(F.split(text(x), "/"), -1)


def stem(x: Column | str) -> Column:
    return F.regexp_replace(name(x), r"(?<=.)\.[^.]*$", "")


def suffix(x: Column | str) -> Column:
    return F.lower(F.regexp_extract(name(x), r".(\.[^.]*)$", 1))


def below(x: Column | str, folders: tuple[str, ...]) -> Column:
    return F.exists(F.array(*[F.lit(f.rstrip("/") + "/") for f in folders]), lambda f: F.startswith(text(x), f))
