"""Connected components of an edge table, by alternating large and small stars; each round is written to the shared
folder, so lineage stays short and lost executors cost one round at most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, dealt, written

#: A key of fewer rows than this is never salted.
HUB = 1000


def hubs(counts: DataFrame, key: str, total: int) -> dict[int, int]:
    """Of key, n (its rows): the keys with more than a quarter of a partition's share of all rows, at most four for each
    partition, and over how many tasks the rows of each are dealt."""
    share = max(HUB, total // (4 * int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return {r[key]: 1 + r["n"] // share for r in counts.filter(F.col("n") > share).select(key, "n").collect()}


def salted_join(rows: DataFrame, side: DataFrame, key: str, by: str, hot: dict[int, int], how: str = "inner") -> DataFrame:
    """rows joined with side, which has one row for each key: the rows of a hot key are dealt by another column over
    several tasks, and its row of the side goes to each of these."""
    if not hot:
        return rows.join(dealt(side), key, how)
    parts = F.coalesce(F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])[F.col(key)], F.lit(1))
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(by), parts).cast("int"))
    copies = side.withColumn("__salt", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))))
    return salted.join(dealt(copies), [key, "__salt"], how).drop("__salt")


def _least(edges: DataFrame, hot: dict[int, int]) -> DataFrame:
    """a, b, least: each directed edge with the least of a and all its neighbours. The minimum is an aggregate with
    map-side combining, and the edges of a hub meet it in several tasks."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("least"))
    return salted_join(edges, least, "a", "b", hot)


def components(edges: DataFrame, name: str = "components", rounds: int = 60) -> DataFrame:
    """edges: a, b (long). Returns node, label: for each node of an edge the least node that it reaches.

    Loops and repeated edges are harmless; an empty table gives an empty one."""
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), name)
    print_before, total = None, now.count()
    with Scratch() as scratch:
        for _ in range(rounds):
            both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
            large = _least(both, hubs(both.groupBy("a").agg(F.count("*").alias("n")), "a", 2 * total)).filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
            large = large.filter("a <> b").distinct()
            small = _least(large, {})  # here each node has few smaller neighbours
            small = small.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(small.select("a", F.col("least").alias("b")))
            scratch.tables.append(now)
            now = written(small.filter("a <> b").distinct(), name)
            print_now = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
            if print_now == print_before:
                break
            print_before, total = print_now, print_now[0]
        else:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
