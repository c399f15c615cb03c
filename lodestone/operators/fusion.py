"""Fusing ranked routes: reciprocal ranks, greedy removal of near duplicates, parent caps, scopes, diversity."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import casefold, terms
from ..model import IGNORED_CHUNK_TYPES

RRF_K = 60


def rank_within(rows: DataFrame, partition: list[str], *order: Column | str, name: str = "rank") -> DataFrame:
    """1-based row numbers; the order must be total for the result to be the same each time."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))


def reciprocal_rank_fusion(routes: DataFrame, key: list[str], k: int = RRF_K, route_order: dict[str, int] | None = None) -> DataFrame:
    """query_id, key, score (8 decimals), routes, first_seen, rank. routes: query_id, route, rank (from 1), key.

    A key's score is the sum of 1 / (k + rank) over its rows; ties go to the key that comes first, route by route."""
    place = F.create_map(*[F.lit(x) for pair in route_order.items() for x in pair])[F.col("route")] if route_order else F.lit(0)
    seen = F.min(F.struct(place.alias("place"), "route", "rank"))
    fused = routes.groupBy("query_id", *key).agg(F.round(F.sum(1 / (k + F.col("rank"))), 8).alias("score"), F.array_sort(F.collect_set("route")).alias("routes"), seen.alias("first_seen"))
    return rank_within(fused, ["query_id"], F.desc("score"), "first_seen", *key)


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / (F.size(a) + F.size(b) - both)).otherwise(F.lit(0.0))


def drop_near_duplicates(ranked: DataFrame, threshold: float = 0.7, ignored: Iterable[str] = IGNORED_CHUNK_TYPES, keep_text: bool = True) -> DataFrame:
    """The rows that stay when each, in rank order, goes if its text equals an earlier one or its words' Jaccard with
    any kept one reaches the threshold. A dropped row suppresses none.

    ranked: query_id, rank, text, and chunk_type or not. One fold for each query over its ranked list, which top-k
    has bounded; the list carries the rows themselves, so that what ranked them is computed once, without their texts
    if these aren't asked for."""
    rows = ranked.filter(F.coalesce(F.col("text"), F.lit("")) != "")
    if "chunk_type" in ranked.columns:
        rows = rows.filter(~F.coalesce(F.col("chunk_type"), F.lit("normal")).isin(*ignored))
    row = F.struct(*[c for c in ranked.columns if keep_text or c != "text"])
    item = F.struct("rank", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), terms("text").alias("terms"), row.alias("row"))
    listed = rows.groupBy("query_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    none = F.array().cast("array<struct<rank:int,digest:string,terms:array<string>>>")

    def step(kept: Column, x: Column) -> Column:
        same = F.exists(kept, lambda k: (k.digest == x.digest) | (jaccard(k.terms, x.terms) >= threshold))
        return F.when(same, kept).otherwise(F.concat(kept, F.array(F.struct(x["rank"].cast("int").alias("rank"), x.digest.alias("digest"), x.terms.alias("terms")))))

    kept = listed.select("items", F.transform(F.aggregate("items", none, step), lambda k: k["rank"]).alias("kept"))
    return kept.select(F.explode(F.filter("items", lambda x: F.array_contains("kept", x["rank"]))).alias("x")).select("x.row.*")


def cap_by_parent(ranked: DataFrame, most: int = 1, parent: str = "parent_id") -> DataFrame:
    """At most so many rows of each parent, the best ranked; Catalyst cuts the groups before the shuffle."""
    return rank_within(ranked, ["query_id", parent], "rank", name="__n").filter(F.col("__n") <= most).drop("__n")


def rerank(ranked: DataFrame, scorer: Callable[[pd.Series, pd.Series], pd.Series] | None = None, query: str = "query", body: str = "context") -> DataFrame:
    """Adds rerank_score and orders anew. Without a scorer, the Jaccard of words; a scorer is a vectorised function
    of questions and contexts, run as a pandas UDF."""
    score = F.pandas_udf(scorer, "double")(F.col(query), F.col(body)) if scorer else jaccard(terms(query), terms(body))
    return rank_within(ranked.withColumn("rerank_score", F.round(score, 6)), ["query_id"], F.desc("rerank_score"), "rank", name="rerank")


def fuse_same_sections(routes: DataFrame, k: int = RRF_K, rank_policy: str = "last") -> DataFrame:
    """Fuses rows that name the same section: query_id, document_path, section_id, retrieval_routes, route_ranks,
    fusion_score (8 decimals), rank. routes: query_id, ordinal, route, rank, document_path, section_id.

    rank_policy: of several rows of a route the last one's rank counts (``last``) or the best (``best``)."""
    pick = F.max_by("rank", "ordinal") if rank_policy == "last" else F.min("rank")
    per_route = routes.groupBy("query_id", "document_path", "section_id", "route").agg(pick.alias("rank"))
    fused = per_route.groupBy("query_id", "document_path", "section_id").agg(
        F.array_sort(F.collect_set("route")).alias("retrieval_routes"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("route", "rank")))).alias("route_ranks"),
        F.round(F.sum(1 / (k + F.col("rank"))), 8).alias("fusion_score"), F.min("rank").alias("best_rank"))
    return rank_within(fused, ["query_id"], F.desc("fusion_score"), "best_rank", "document_path", "section_id")


FUSED = "query_id long, document_path string, section_id string, title string, retrieval_routes array<string>, route_ranks map<string,int>, route_scores map<string,double>, content_ranges array<struct<start_line:int,end_line:int>>, fusion_score double, best_rank int"


def fuse_scopes(candidates: DataFrame, k: int = RRF_K, rank_policy: str = "last") -> DataFrame:
    """The general fusion: rows that name the same section, or have the same title and overlapping lines, or name no
    section and overlap, are one; each row meets the kept ones in order and joins the first that matches.

    candidates: query_id, ordinal, route, rank, score, document_path, section_id, title, content_ranges. The fold
    depends on the order, so it runs in one group for each query; a query has as many rows as its routes return."""
    folded = candidates.withColumn("title_key", F.regexp_replace(casefold(F.coalesce("title", F.lit(""))), r"(?U)\s+", ""))

    def overlap(a: list, b: list) -> bool:
        return any(x["start_line"] <= y["end_line"] and x["end_line"] >= y["start_line"] for x in a for y in b)

    def fuse(rows: pd.DataFrame) -> pd.DataFrame:
        kept: list[dict] = []
        for r in rows.sort_values("ordinal").to_dict("records"):
            ranges = [dict(x) if isinstance(x, dict) else x.asDict() for x in (r["content_ranges"] if r["content_ranges"] is not None else [])]
            own = next((c for c in kept if c["document_path"] == r["document_path"] and (
                (c["section_id"] and c["section_id"] == r["section_id"])
                or (overlap(c["content_ranges"], ranges) and ((c["title_key"] and c["title_key"] == r["title_key"]) or not (c["section_id"] or r["section_id"]))))), None)
            if own is None:
                own = {c: r[c] for c in ("query_id", "document_path", "section_id", "title", "title_key")} | {"routes": set(), "route_ranks": {}, "route_scores": {}, "content_ranges": []}
                kept.append(own)
            own["routes"].add(r["route"])
            if rank_policy == "last" or r["rank"] < own["route_ranks"].get(r["route"], 1 << 30):
                own["route_ranks"][r["route"]], own["route_scores"][r["route"]] = int(r["rank"]), float(r["score"])
            own["section_id"], own["title"] = own["section_id"] or r["section_id"], own["title"] or r["title"]
            pairs = {(x["start_line"], x["end_line"]) for x in [*own["content_ranges"], *ranges]}
            own["content_ranges"] = [{"start_line": a, "end_line": b} for a, b in sorted(pairs)]
        out = [{"query_id": c["query_id"], "document_path": c["document_path"], "section_id": c["section_id"], "title": c["title"], "retrieval_routes": sorted(c["routes"]), "route_ranks": c["route_ranks"], "route_scores": c["route_scores"], "content_ranges": c["content_ranges"], "fusion_score": round(sum(1 / (k + x) for x in c["route_ranks"].values()), 8), "best_rank": min(c["route_ranks"].values())} for c in kept]
        return pd.DataFrame(out, columns=[f.split()[0] for f in ("query_id", "document_path", "section_id", "title", "retrieval_routes", "route_ranks", "route_scores", "content_ranges", "fusion_score", "best_rank")])

    fused = folded.groupBy("query_id").applyInPandas(fuse, FUSED)
    return rank_within(fused, ["query_id"], F.desc("fusion_score"), "best_rank", "document_path", "section_id")


def diversify(ranked: DataFrame, limit: int = 20, documents: int = 3, strict_limit: bool = False) -> DataFrame:
    """The best section of each of the first few documents, then the others by rank, up to the limit.

    ranked: query_id, rank, document_path, section_id. Unless ``strict_limit``, one row more than the limit returns
    where the documents' best sections alone fill it, as they are counted before one more is added."""
    first = rank_within(ranked, ["query_id", "document_path"], "rank", name="__in_doc")
    heads = F.row_number().over(Window.partitionBy("query_id", F.col("__in_doc") == 1).orderBy("rank"))
    lead = (F.col("__in_doc") == 1) & (heads <= min(documents, max(1, limit)))
    placed = first.withColumn("__lead", lead)
    placed = rank_within(placed, ["query_id"], F.desc("__lead"), "rank", name="position")
    leads = F.sum(F.col("__lead").cast("int")).over(Window.partitionBy("query_id"))
    most = F.lit(max(1, limit)) if strict_limit else F.greatest(F.lit(max(1, limit)), leads + 1)
    kept = placed.withColumn("__most", most).filter(F.col("position") <= F.col("__most"))
    return kept.drop("__in_doc", "__lead", "__most")


def first_of(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row for each key, the first in order."""
    return rank_within(rows, keys, order, name="__n").filter(F.col("__n") == 1).drop("__n")
