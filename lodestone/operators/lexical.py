"""BM25 over relational index tables: document tokens and term statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tokens

K1, B, EPSILON = 1.5, 0.75, 0.25
#: Pairs of a question and a term of it that are sent to all tasks; more are joined by key.
MOST_TERMS = 1_000_000


@dataclass(frozen=True)
class LexicalIndex:
    """documents: doc_id, dl, terms (all tokens, in order). stats: term, df, n_tokens; the term null stands for all
    documents that have a token, and there n_tokens is the number of all tokens. epsilon: what a term in over half of the
    documents gets, as a share of the mean of all terms' plain idf."""

    documents: DataFrame
    stats: DataFrame
    epsilon: float = EPSILON

    def totals(self) -> DataFrame:
        """n, avgdl: one row, none for an empty corpus."""
        return self.stats.filter("term IS NULL").select(F.col("df").alias("n"), (F.col("n_tokens") / F.col("df")).alias("avgdl"))

    def idf(self, asked: DataFrame | None = None) -> DataFrame:
        """term, df, idf, n, avgdl; with ``asked`` (a column term) of these terms only."""
        totals = F.broadcast(self.totals())
        plain = F.log(F.col("n") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
        each = self.stats.filter("term IS NOT NULL").join(totals).select("term", "df", "n", "avgdl", plain.alias("plain"))
        mean = each.agg(F.round(F.avg("plain"), 9).alias("mean"))
        each = each if asked is None else each.join(asked, "term", "left_semi")
        return each.join(F.broadcast(mean)).select("term", "df", F.when(F.col("plain") < 0, self.epsilon * F.col("mean")).otherwise(F.col("plain")).alias("idf"), "n", "avgdl")


def build(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", epsilon: float = EPSILON) -> LexicalIndex:
    """Index of all documents that have a token. One pass counts each term's documents with map-side combining, and no
    posting moves; the statistics, of one row a term, are kept for the searches."""
    split = docs.select(F.col(id_column).alias("doc_id"), tokens(text_column).alias("terms")).filter(F.size("terms") > 0).select("doc_id", F.size("terms").alias("dl"), "terms")
    # A null besides the distinct terms counts the document itself.
    each = split.select("dl", F.explode(F.concat(F.array_distinct("terms"), F.array(F.lit(None).cast("string")))).alias("term"))
    stats = each.groupBy("term").agg(F.count("*").alias("df"), F.sum("dl").alias("n_tokens"))
    return LexicalIndex(split, stats.persist(StorageLevel.MEMORY_AND_DISK), epsilon)


def search(index: LexicalIndex, queries: DataFrame, k: int = 20, k1: float = K1, b: float = B, positive: bool = True) -> DataFrame:
    """query_id, doc_id, score (6 decimals), rank: the best k documents of each query, then those of them that score
    above 0. queries: query_id, text; a token that a query repeats counts each time.

    The query's terms meet the tokens where these lie, so only occurrences of asked terms are counted and move; stop
    words of the corpus move only if asked for."""
    asked = queries.select("query_id", F.explode(tokens("text")).alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("qtf"))
    words = asked.select("term").distinct()
    few = asked.limit(MOST_TERMS + 1).count() <= MOST_TERMS
    sent = F.broadcast if few else (lambda df: df)
    tf = index.documents.select("doc_id", "dl", F.explode("terms").alias("term")).join(sent(words), "term").groupBy("doc_id", "dl", "term").agg(F.count("*").alias("tf"))
    weighed = asked.join(sent(index.idf(words)), "term")
    hits = tf.join(sent(weighed), "term")
    part = F.col("qtf") * F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.col("avgdl")))
    scored = hits.groupBy("query_id", "doc_id").agg(F.round(F.sum(part), 6).alias("score"))
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))).filter(F.col("rank") <= k)
    return ranked.filter("score > 0") if positive else ranked


def write(index: LexicalIndex, path: str) -> None:
    """Tokens and statistics as Parquet, so that an index is built once and searched often."""
    index.documents.write.mode("overwrite").parquet(f"{path}/documents")
    index.stats.write.mode("overwrite").parquet(f"{path}/stats")


def read(spark, path: str, epsilon: float = EPSILON) -> LexicalIndex:
    return LexicalIndex(spark.read.parquet(f"{path}/documents"), spark.read.parquet(f"{path}/stats"), epsilon)
