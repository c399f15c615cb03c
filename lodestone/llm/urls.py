"""URL filters as a sort-merge range join.

A host is canonicalised by reversing its labels (``www.example.net`` becomes ``net.example.www.``), so that a rule for
a host and all its subdomains is the interval of keys that begin with the rule's own key. Pages and rules are cut by
the same key boundaries; each part is sorted and swept once, with a stack of the nested host rules that are active.
A rule that spans several parts is repeated in each of them; a page is read once and never multiplied.

Defined results: a null url, or one without ``://``, has empty host and path; no rule fits an empty host (but for
rules with an empty host, which fit every url); equal rules collapse and block wins over allow; of different rules of
one length the longer host wins; repeated pages are judged one by one, and so are those with a null id; no rules give the
default verdict; other columns of either table are ignored, whatever their names.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RESULT = "row_id long, host string, path string, rule string, verdict string"
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty where the url is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """The labels in reverse order, each followed by a dot; empty for the empty host."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


class HostRules:
    """The path rules of one host: each path knows the longest other path that it extends."""

    def __init__(self, prefix: str):
        self.prefix, self.rules = prefix, {}

    def close(self) -> None:
        self.paths = sorted(self.rules)
        self.parent: list[int] = []
        chain: list[int] = []
        for i, path in enumerate(self.paths):
            while chain and not path.startswith(self.paths[chain[-1]]):
                chain.pop()
            self.parent.append(chain[-1] if chain else -1)
            chain.append(i)

    def longest(self, path: str) -> tuple[str, str] | None:
        i = bisect_right(self.paths, path) - 1
        while i >= 0 and not path.startswith(self.paths[i]):
            i = self.parent[i]
        return self.rules[self.paths[i]] if i >= 0 else None


def sweep(batches: Iterable[pa.RecordBatch], default: str) -> Iterator[pa.RecordBatch]:
    """Walks rows sorted by part and key, rules before pages, and judges each page by the stack of active rules."""
    part, stack, fresh = None, [], []
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("part", "key", "row_id", "host", "path", "rule", "verdict")]
        out: list[tuple] = []
        for p, key, row_id, host, path, rule, verdict in zip(*cols, strict=True):
            if p != part:
                part, stack = p, []
            while stack and not key.startswith(stack[-1].prefix):
                stack.pop()
            if rule is not None:
                if not stack or stack[-1].prefix != key:
                    stack.append(HostRules(key))
                    fresh.append(stack[-1])
                if stack[-1].rules.get(path, ("", ""))[1] != "block":
                    stack[-1].rules[path] = (rule, verdict)
                continue
            for entry in fresh:
                entry.close()
            fresh = []
            found = [x for entry in stack if (x := entry.longest(path))]
            best = max(reversed(found), key=lambda x: len(x[0]), default=(None, default))
            out.append((row_id, host, path, *best))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), *[pa.string()] * 4), strict=True)], names=["row_id", "host", "path", "rule", "verdict"])


def places_before(bounds: list, x: Column) -> Column:
    """How many of the ascending bounds (k, s) are at most x: first among every so many of them, and then within these."""
    if not bounds:
        return F.lit(0)
    size = math.isqrt(len(bounds) - 1) + 1
    cut = lambda bs: F.array(*[F.struct(F.lit(b.k).alias("k"), F.lit(b.s).alias("s")) for b in bs])
    chunks = [bounds[i : i + size] for i in range(0, len(bounds), size)]
    chunk = F.size(F.filter(cut([c[0] for c in chunks[1:]]), lambda c: c <= x)) if len(chunks) > 1 else F.lit(0)
    return chunk * size + F.size(F.filter(F.get(F.array(*[cut(c) for c in chunks]), chunk), lambda c: c <= x))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_column: str = "page_id", url_column: str = "url", parts: int | None = None) -> DataFrame:
    """Judges every page by the longest rule that fits its url.

    rules: host, path, verdict. A rule fits its host and all subdomains of it where the url's path starts with the
    rule's; the longest rule (host and path together) wins. Returns id, host, path, rule (null if none), verdict.

    The boundaries of the parts come from a few hundred keys that reach the driver, however large the input is; equal
    urls are told apart by the row's id, so a hot host or url spreads over as many parts as its share asks for.
    """
    spark = pages.sparkSession
    parts = parts or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    host, path = url_parts(F.col(url_column))
    judged = pages.select(F.col(id_column).cast("long").alias("row_id"), host.alias("host"), path.alias("path"))
    judged = judged.withColumn("key", host_key(F.col("host"))).withColumn("spread", F.xxhash64("row_id", "path"))
    place = lambda key, spread: F.struct(key.alias("k"), spread.alias("s"))
    sample = judged.select("key", "spread").orderBy(F.xxhash64("spread"), "key", "spread").limit(4 * parts)
    picked = sorted((r.key, r.spread) for r in sample.collect())[3::4]
    cuts = sorted(set(picked))
    bounds = spark.range(1).select(F.array(*[place(F.lit(k), F.lit(s).cast("long")) for k, s in cuts]) if cuts else F.expr("cast(array() as array<struct<k:string,s:bigint>>)")).first()[0]
    part = lambda x: places_before(bounds, x)
    lowest, highest = F.lit(-(2**63)), F.lit(2**63 - 1)
    ruled = rules.select(F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").distinct().withColumn("key", host_key(F.col("host")))
    ruled = ruled.withColumn("part", F.explode(F.sequence(part(place(F.col("key"), lowest)), part(place(F.concat("key", F.lit("\U0010ffff")), highest)))))
    rows = judged.select(part(place(F.col("key"), F.col("spread"))).alias("part"), "key", F.lit(1).alias("is_page"), "row_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    rows = rows.unionByName(ruled.select("part", "key", F.lit(0).alias("is_page"), F.lit(None).cast("long").alias("row_id"), "host", "path", F.concat("host", "path").alias("rule"), "verdict"))
    rows = rows.repartition(parts, "part").sortWithinPartitions("part", "key", "is_page")
    return rows.mapInArrow(lambda it: sweep(it, default), RESULT).withColumnRenamed("row_id", id_column)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return filter_urls(table(spark, sf_dir, "pages"), rules)


SQL = r"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(rhost, rpath, rverdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
best AS (SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(rverdict, length(rhost || rpath)) AS verdict
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict FROM parts p LEFT JOIN best b USING (page_id)
"""
