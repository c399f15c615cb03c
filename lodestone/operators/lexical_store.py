"""A BM25 index that is kept up to date: what a change adds to and takes from the statistics, instead of a new index.

Of a term the index keeps the documents that have it and their tokens; of the corpus the same under the null term. Each
is a sum over documents, so a change is a table of signed sums: minus for each document that goes or is replaced, plus
for each that comes. These deltas are parts of the table of statistics, which reading adds up; after ``MOST_DELTAS`` of
them one part is made of all. Tokens lie in buckets by document, and only buckets of changed documents are written
again. Both tables change in one revision, so a search sees an index before or after a change, never between.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..sources.revisions import WHOLE, Store
from .lexical import EPSILON, LexicalIndex

BUCKETS = 64
MOST_DELTAS = 16
#: Ids of touched documents that are sent to all tasks at once.
MOST_SENT = 500_000


def bucket(of: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(of), F.lit(buckets)).cast("int")


def postings(docs: DataFrame) -> DataFrame:
    """doc_id, dl, terms of the documents that have a token. docs: doc_id, text."""
    return docs.select("doc_id", tokens("text").alias("terms")).filter(F.size("terms") > 0).select("doc_id", F.size("terms").alias("dl"), "terms")


def signed(documents: DataFrame, sign: int) -> DataFrame:
    """term, df, n_tokens that these documents add to, or take from, the statistics; the null term counts themselves."""
    terms = F.concat(F.array_distinct("terms"), F.array(F.lit(None).cast("string")))
    return documents.select(F.explode(terms).alias("term"), F.lit(sign).cast("long").alias("df"), (sign * F.col("dl")).cast("long").alias("n_tokens"))


def summed(parts: DataFrame) -> DataFrame:
    """Statistics of signed rows; what they leave nothing of goes."""
    return parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("n_tokens").alias("n_tokens")).filter("df <> 0 OR n_tokens <> 0")


def create(store: Store, docs: DataFrame, buckets: int = BUCKETS) -> int:
    """A new index of these documents, in place of any that is there; its revision."""
    change = store.change()
    rows = postings(docs)
    change.put_parts("lexical_documents", rows.withColumn("bucket", bucket("doc_id", buckets)), "bucket")
    change.put("lexical_stats", summed(signed(change.staged("lexical_documents"), 1)))
    change.put("lexical_settings", store.spark.range(1).select(F.lit(buckets).alias("buckets")))
    return change.publish()


def update(store: Store, fresh: DataFrame, gone: DataFrame | None = None, base: int | None = None) -> int:
    """The index after documents came or changed (fresh: doc_id, text) and others went (gone: doc_id); its revision.

    ``base`` is the revision that the change was worked out from: if the index has moved on since, ``Conflict`` is
    raised. A document in both is fresh; one that isn't there can't go, and nothing changes for it."""
    change = store.change(base)
    buckets = store.read("lexical_settings", change.base).first()["buckets"]
    ids = fresh.select("doc_id") if gone is None else fresh.select("doc_id").unionByName(gone.select("doc_id"))
    touched = scratch(store, ids.distinct().withColumn("bucket", bucket("doc_id", buckets)))
    groups = groups_of(touched)
    hit = sorted(str(b) for group, _ in groups for b in group)
    if not hit:
        return change.base
    met = [(store.read("lexical_documents", change.base, [str(b) for b in group]), sent(touched.filter(F.col("bucket").isin(group)).select("doc_id"), few)) for group, few in groups]
    joined = lambda how: reduce(DataFrame.unionByName, [old.join(these, "doc_id", how) for old, these in met])
    new = postings(fresh)
    after = joined("left_anti").unionByName(new)
    delta = signed(joined("left_semi"), -1).unionByName(signed(new, 1))
    parts = change.tables["lexical_stats"]["parts"]
    if len(parts) >= MOST_DELTAS:
        change.put("lexical_stats", summed(store.read("lexical_stats", change.base).unionByName(delta)))
    else:
        change.put("lexical_stats", summed(delta), f"{change.base + 1}", keep=True)
    change.put_parts("lexical_documents", after.withColumn("bucket", bucket("doc_id", buckets)), "bucket", hit)
    return change.publish()


def scratch(store: Store, rows: DataFrame) -> DataFrame:
    """Rows that are used several times, written beside the store's tables; named by no revision, so ``sweep`` takes them."""
    path = f"{store.path}/tables/{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").parquet(path)
    return store.spark.read.schema(rows.schema).parquet(path)


def groups_of(touched: DataFrame) -> list[tuple[list[int], bool]]:
    """Buckets in groups of at most ``MOST_SENT`` touched documents, and whether they keep to that: one bucket of more is a
    group of its own. touched: doc_id, bucket."""
    out: list[tuple[list[int], bool]] = []
    room = 0
    for r in touched.groupBy("bucket").agg(F.count("*").alias("n")).orderBy("bucket").collect():  # a row for each bucket
        if out and r.n <= room:
            out[-1][0].append(r.bucket)
            room -= r.n
        else:
            out.append(([r.bucket], r.n <= MOST_SENT))
            room = MOST_SENT - r.n
    return out


def sent(ids: DataFrame, few: bool) -> DataFrame:
    """The small side of a join with documents: sent to these where they lie, so that no text or token moves."""
    return F.broadcast(ids) if few else ids.hint("merge")


def sync(store: Store, docs: DataFrame, changes: DataFrame, base: int | None = None) -> int:
    """``update`` by what ``sync.difference`` found. docs: doc_id, text; changes: source_id, change."""
    buckets = store.read("lexical_settings", store.head() if base is None else base).first()["buckets"]
    told = scratch(store, changes.filter("change <> 'same'").select(F.col("source_id").alias("doc_id"), "change").withColumn("bucket", bucket("doc_id", buckets)))
    come = told.filter("change IN ('added', 'changed')")
    mine = lambda group: docs.filter(bucket("doc_id", buckets).isin(group)).select("doc_id", "text")
    fresh = [mine(group).join(sent(come.filter(F.col("bucket").isin(group)).select("doc_id"), few), "doc_id", "left_semi") for group, few in groups_of(come)]
    return update(store, reduce(DataFrame.unionByName, fresh or [docs.select("doc_id", "text").limit(0)]), told.filter("change = 'removed'").select("doc_id"), base)


def load(store: Store, revision: int | None = None, epsilon: float = EPSILON) -> LexicalIndex:
    """The index as of a revision, for ``lexical.search``."""
    revision = store.head() if revision is None else revision
    stats = store.read("lexical_stats", revision)
    whole = list(store.manifest(revision)["lexical_stats"]["parts"]) == [WHOLE]
    return LexicalIndex(store.read("lexical_documents", revision), stats if whole else summed(stats), epsilon)
