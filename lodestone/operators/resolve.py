"""Finding what records point at: original sources, assets, converter outputs, sidecar texts, governed outputs; and the
counts and flags of converted blocks. Files are tables of paths, so a whole collection is resolved by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import below, is_relative, name
from .fusion import first_of

# The folder of originals, folders of governed outputs, kinds of blocks that are counted, and what asks for review.
RAW, CONVERTED = "10_Raw", "converted"
GOVERNED_OUTPUTS = ("30_Cards", "40_Concepts", "50_Projects")
COUNTED_BLOCKS = ("text", "image", "chart", "table", "equation", "list", "code")
REVIEW = {"formula-semantics": ("equation",), "table-and-cross-page-structure": ("table",), "figure-internals-when-used-as-evidence": ("image", "chart")}


def resolve_sources(wanted: DataFrame, files: DataFrame, key: str = "document_path") -> DataFrame:
    """key, source_path, found_by: the original of each document, null where none can be trusted.

    wanted: key, recorded_path, manifest_path, source_filename, source_sha256. files: path, sha256. The recorded paths
    count first, then the folder of originals, then a file of that name anywhere below it but in converted folders, if
    there is just one. A file is trusted if its hash is the one that is known, or none is."""
    known = F.lower(F.coalesce("source_sha256", F.lit("")))
    trusted = (known == "") | (F.lower("sha256") == known)
    paths = F.array("recorded_path", "manifest_path", F.concat(F.lit(RAW + "/"), F.nullif("source_filename", F.lit(""))))
    named = wanted.select(key, "source_sha256", F.posexplode(paths).alias("place", "path")).filter(is_relative("path"))
    direct = named.join(files, "path").filter(trusted).groupBy(key).agg(F.min_by("path", "place").alias("direct"))
    parts = F.transform(F.split("path", "/"), lambda p: F.lower(p))
    inner = files.filter(below("path", (RAW,)) & ~F.array_contains(F.slice(parts, F.lit(2), F.size(parts) - 2), CONVERTED)).withColumn("source_filename", name("path"))
    loose = wanted.select(key, "source_filename", "source_sha256").join(inner, "source_filename").filter(trusted).groupBy(key).agg(F.count("*").alias("n"), F.min("path").alias("only")).filter("n = 1")
    met = wanted.select(key).join(direct, key, "left").join(loose.select(key, "only"), key, "left")
    return met.select(key, F.coalesce("direct", "only").alias("source_path"), F.when(F.col("direct").isNotNull(), "path").when(F.col("only").isNotNull(), "name").otherwise("unresolved").alias("found_by"))


def resolve_assets(assets: DataFrame, files: DataFrame, roots: list[str], key: str = "asset_id") -> DataFrame:
    """key, found: an absolute path that is there, else the path below the first root that has it, else a file of that
    name below the first root that has one. assets: key, path. files: path."""
    given = assets.filter(F.coalesce("path", F.lit("")) != "")
    places = [F.when(F.startswith("path", F.lit("/")), F.col("path")), *[F.concat(F.lit(r.rstrip("/") + "/"), F.col("path")) for r in roots]]
    named = given.select(key, F.posexplode(F.array(*places)).alias("place", "at")).join(files.select(F.col("path").alias("at")).distinct(), "at").select(key, "place", "at")
    rooted = F.coalesce(*[F.when(F.startswith("at", F.lit(r.rstrip("/") + "/")), F.lit(len(places) + i)) for i, r in enumerate(roots)])
    loose = given.select(key, name("path").alias("name")).join(files.select(F.col("path").alias("at"), name("path").alias("name")).distinct(), "name").withColumn("place", rooted).filter("place IS NOT NULL AND name <> ''")
    best = first_of(named.unionByName(loose.select(key, "place", "at")).withColumn("__o", F.struct("place", "at")), [key], "__o").select(key, F.col("at").alias("found"))
    return assets.select(key).distinct().join(best, key, "left")


def choose_outputs(files: DataFrame, by: list[str], stem: str = "stem", suffix: str = "suffix") -> DataFrame:
    """by, path, score: of each group's files the best: ten for the stem in the path, five for the ending, fewer folders,
    and then the first by path. files: by, path, stem, suffix."""
    low = F.lower("path")
    score = F.when(F.contains(low, F.lower(stem)), 10).otherwise(0) + F.when(F.endswith(F.lower(name("path")), F.col(suffix)), 5).otherwise(0)
    order = F.struct((-score).alias("s"), F.size(F.split("path", "/")).alias("n"), "path")
    return first_of(files.withColumn("score", score).withColumn("__o", order), by, "__o").select(*by, "path", "score")


def sidecars(images: DataFrame, texts: DataFrame, by: list[str]) -> DataFrame:
    """by, ordinal, path, text, violation: texts read beside images, by position; a group with another number of texts
    than of images has none. images: by, ordinal, path. texts: by, ordinal, text."""
    place = Window.partitionBy(*by).orderBy("ordinal")
    whole = Window.partitionBy(*by)
    a = images.select(*by, "ordinal", "path").withColumns({"__at": F.row_number().over(place), "__images": F.count("*").over(whole)})
    b = texts.select(*by, F.row_number().over(place).alias("__at"), "text", F.count("*").over(whole).alias("__texts"))
    n = b.select(*by, "__texts").distinct()
    met = a.join(n, by, "left").join(b.drop("__texts"), [*by, "__at"], "left")
    differs = F.col("__texts").isNotNull() & (F.col("__texts") != F.col("__images"))
    return met.select(*by, "ordinal", "path", F.when(~differs, F.col("text")).alias("text"), F.when(differs, "sidecar-count").alias("violation"))


def governed_outputs(sections: DataFrame, files: DataFrame, keys: list[str], most_chars: int = 12000) -> DataFrame:
    """keys, path, content, content_truncated: what a section's ledger names in the governed folders and is there.
    sections: keys, outputs. files: path, text."""
    named = sections.select(*keys, F.explode("outputs").alias("path")).filter(below("path", GOVERNED_OUTPUTS))
    return named.join(files, "path").select(*keys, "path", F.substring("text", 1, most_chars).alias("content"), (F.length("text") > most_chars).alias("content_truncated"))


def provenance(packets: DataFrame, ledgers: DataFrame, manifests: DataFrame, key: str = "document_path") -> DataFrame:
    """Adds source_sha256, document_version, and whether a ledger and a manifest are there. The version is the ledger's
    hash of the document, else the source's, else the file's own. packets: key, file_sha256. ledgers: key,
    document_hash. manifests: key, source_sha256."""
    met = packets.join(ledgers.select(key, "document_hash", F.lit(True).alias("__l")), key, "left").join(manifests.select(key, "source_sha256", F.lit(True).alias("__m")), key, "left")
    filled = lambda c: F.nullif(F.col(c), F.lit(""))
    version = F.coalesce(filled("document_hash"), filled("source_sha256"), F.col("file_sha256"))
    return met.select(*packets.columns, "source_sha256", version.alias("document_version"), F.coalesce("__l", F.lit(False)).alias("has_ledger"), F.coalesce("__m", F.lit(False)).alias("has_manifest"))


def block_counts(blocks: DataFrame, by: list[str]) -> DataFrame:
    """by, a count of each kind of block, and review_required: what these counts ask a reader to check. blocks: by, type."""
    sums = blocks.groupBy(*by).agg(*[F.count_if(F.col("type") == k).alias(f"n_{k}") for k in COUNTED_BLOCKS])
    asks = [F.when(sum((F.col(f"n_{k}") for k in kinds), F.lit(0)) > 0, F.lit(code)) for code, kinds in REVIEW.items()]
    return sums.withColumn("review_required", F.array_compact(F.array(*asks)))


def spec_index_paths(sections: DataFrame, by: list[str]) -> DataFrame:
    """by, paths: the indexes of specifications that a ledger's sections name, in the order of first use. sections: by,
    ordinal, outputs."""
    each = sections.select(*by, "ordinal", F.posexplode("outputs").alias("at", "path")).filter(F.endswith("path", F.lit(".spec-index.md")))
    first = each.groupBy(*by, "path").agg(F.min(F.struct("ordinal", "at")).alias("first"))
    return first.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "path"))), lambda x: x.path).alias("paths"))


def request_guard(asked: DataFrame, states: DataFrame) -> DataFrame:
    """Adds violation, the first reason why a question of a request can't begin now.

    asked: request_id, question_index, question_count. states: request_id, status, question_index, expected_count, of
    the request's traces."""
    sums = states.groupBy("request_id").agg(
        F.count_if(F.col("status") == "in_progress").alias("__open"), F.collect_set("question_index").alias("__taken"),
        F.count_distinct("expected_count").alias("__counts"), F.max("expected_count").alias("__count"))
    index, count = F.col("question_index"), F.col("question_count")
    taken = F.coalesce("__taken", F.array().cast(states.select(F.array("question_index").alias("x")).schema["x"].dataType))
    before = F.when(index > 1, F.sequence(F.lit(1), index.cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    gap = F.exists(before, lambda i: ~F.array_contains(taken, i))
    rules = [
        (count < 1, "count-invalid"), (count.isNotNull() & F.col("request_id").isNull(), "count-needs-request"), (count.isNotNull() & index.isNull(), "count-needs-index"), (index > count, "index-over-count"),
        (F.col("__open") > 0, "open-trace"), (F.array_contains(taken, index), "index-taken"), (gap, "index-not-sequential"), (F.col("__counts") > 1, "counts-inconsistent"), ((F.col("__counts") == 1) & (count != F.col("__count")), "count-conflict"),
    ]
    violation = F.lit(None).cast("string")
    for test, code in reversed(rules):
        violation = F.when(test, code).otherwise(violation)
    return asked.join(sums, "request_id", "left").withColumn("violation", violation).select(*asked.columns, "violation")
