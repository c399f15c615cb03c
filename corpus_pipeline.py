"""A training-data pipeline over documents: quality, repeated lines, near duplicates, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before kept; all but the last return
the columns of documents, with n_chars set anew where a text changed. Rejected documents go:

1. quality: those that the classifier predicts as 0 go (labels of sf_dir are what it learns from);
2. lines: long lines of five documents or more go from all but one; a document may end up empty, and stays;
3. near duplicates: of documents that links of 5-word shingles at a Jaccard of 0.8 connect, the least id stays; rows
   that repeat an id and its text are one document; an id with different texts is several documents, and of those that
   are connected one stays; a document with a null id goes if one with an id has the same shingles, is linked with
   nothing else, and of null ids with the same shingles one stays; empty documents are linked with nothing;
4. leaks: documents that leak a benchmark item go;
5. tokens: ids, n_tokens, and whether decoding gives the text back, are added.

Documents may have other columns, of any names: each stage works under names of its own and gives them back as they were;
a column that the last stage adds and that a document has already gets an underscore more. An empty table passes all
stages and stays empty.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm import jaccard, leaks, lines, pieces, quality
from lodestone.llm.common import dealt, forget, table, written

SHINGLE, PERCENT = 5, 80
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def apart(stage: Stage) -> Stage:
    """The stage, with the documents' other columns under names that nothing in it uses, and back under their own."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        hidden = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c not in COLUMNS}
        shown = {h: c for c, h in hidden.items()}
        out = stage(spark, docs.select(*[F.col(quoted(c)).alias(hidden.get(c, c)) for c in docs.columns]), sf_dir)
        taken, names = {c.lower() for c in docs.columns}, []
        for c in out.columns:
            name = shown.get(c, c)
            while c not in shown and c not in COLUMNS and name.lower() in taken:
                name += "_"
            names.append(name)
        return out.select(*[F.col(quoted(c)).alias(n) for c, n in zip(out.columns, names, strict=True)])

    return run


@apart
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).filter("predicted = 1").select(docs.columns)


@apart
def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(docs)
    return kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).select(docs.columns)


@apart
def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row = lambda text: (F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("__id"), F.isnull("doc_id").alias("__null"), text.alias("__text"))
    least = jaccard.similar(docs, SHINGLE, PERCENT).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    empty = F.col("n_shingles") == 0
    found = least.groupBy("doc_id", empty.alias("empty"), F.when(empty, F.col("text_hash")).otherwise(F.col("link_key")).alias("of")).agg(F.min("text_hash").alias("text_hash"))
    kept = docs.select("*", *row(F.xxhash64("text"))).join(dealt(found.select(*row(F.col("text_hash")))), ["__id", "__null", "__text"])
    first = Window.partitionBy("__id", "__null", "__text").orderBy("doc_id")
    return kept.withColumn("__row", F.row_number().over(first)).filter("__row = 1").select(docs.columns)


@apart
def leaks_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return leaks.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


@apart
def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pieces.round_trip(docs)
    return out.select(*docs.columns, "ids", F.size("ids").alias("n_tokens"), F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", lines_stage),
    ("n-gram Jaccard join", near_duplicates_stage),
    ("benchmark decontamination", leaks_stage),
    ("SentencePiece encoding and decoding", tokens_stage),
]

#: A learnt classifier and a tokenizer's path can't be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each read back from Parquet in the shared folder."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
        if before is not None:
            forget(before)
        before = docs
    return docs
