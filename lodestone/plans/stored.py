"""Driver queries over stores that change by revisions, and over rendered blocks, with their SQL.

Each builds a store below the shared folder from the given tables, changes it, and reads the result; the SQL knows only
the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import empty, sha256
from ..operators import commits, decisions, headings, image_bundles, lexical, lexical_store, lint, observed, render, session, sync, trace, vector_store
from ..session import work_folder
from ..sources.revisions import Store
from .audit_sql import SQL as AUDIT_SQL
from .audits import ledger_rows, mod
from .oracle import ORACLE
from .queries import asked, query, t

SQL: dict[str, str] = {}


def new_store(spark: SparkSession, name: str) -> Store:
    return Store(spark, work_folder(spark, name))


# ---- indexes that are kept up to date


@query
def bm25_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of another corpus (a tenth of the documents missing, others with an older text, and all pages besides),
    brought to the documents by what a comparison of fingerprints finds."""
    d = t(spark, sf_dir, "documents").select("doc_id", "text")
    pages = t(spark, sf_dir, "pages").select((F.col("page_id") + 10**9).alias("doc_id"), F.col("html").alias("text"))
    before = d.filter("doc_id % 10 <> 0").withColumn("text", F.when(mod("doc_id", 7), F.concat(F.lit("older words "), "text")).otherwise(F.col("text"))).unionByName(pages)
    store = new_store(spark, "bm25")
    lexical_store.create(store, before, buckets=16)
    prints = lambda rows: sync.fingerprints(rows, "doc_id", "text")
    lexical_store.sync(store, d, sync.difference(prints(d), prints(before)))
    return lexical.search(lexical_store.load(store), asked(spark, sf_dir)).select("query_id", "doc_id", "score", "rank")


SQL["bm25_maintained"] = ORACLE["bm25_topk"]


def vectors_in_store(spark: SparkSession, sf_dir: str) -> tuple[Store, DataFrame]:
    """A store of two thirds of the vectors and of strangers, then brought to all vectors and no stranger."""
    vectors = t(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    strangers = vectors.select((F.col("vec_id") + 10**9).alias("vec_id"), F.reverse("embedding").alias("embedding"))
    store = new_store(spark, "vectors")
    vector_store.create(store, vectors.filter("vec_id % 3 <> 0").unionByName(strangers), 64)
    vector_store.delete(store, strangers.select("vec_id"))
    vector_store.upsert(store, vectors.filter("vec_id % 3 <> 1"))
    return store, vectors.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


@query
def knn_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_store.search(*vectors_in_store(spark, sf_dir))[0]


SQL["knn_indexed"] = ORACLE["knn_topk"]


# ---- writes that become visible together


@query
def ledger_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledgers that are there, then a snapshot's in one revision: heads, or why a bundle was refused, with sections."""
    manifests, sections, held, old = ledger_rows(spark, sf_dir)
    store = new_store(spark, "ledgers")
    first = store.change()
    first.put("ledger_heads", held.select("directory", "bundle_id", F.lit(None).cast("string").alias("source_sha256"), F.col("revision").cast("long").alias("revision"), "created_at"))
    first.put("ledger_sections", old.withColumns({"orphaned": F.lit(False), "removed_at": F.lit(None).cast("timestamp")}))
    first.publish()
    revision, refused = commits.init_ledgers(store, manifests, sections, F.lit("2022-01-01").cast("timestamp"))
    counts = store.read("ledger_sections", revision).groupBy("directory").agg(F.count("*").alias("n_sections"), F.count_if("orphaned").alias("n_orphaned"))
    heads = store.read("ledger_heads", revision).select("directory", "bundle_id", "revision").join(counts, "directory", "left").fillna(0, ["n_sections", "n_orphaned"])
    return heads.join(refused.withColumnRenamed("key", "directory"), "directory", "full_outer").select("directory", "bundle_id", "revision", "n_sections", "n_orphaned", "violation")


SQL["ledger_commit"] = f"""
WITH b AS ({AUDIT_SQL["ledger_heads"]}), s AS ({AUDIT_SQL["ledger_documents"]}),
c AS (SELECT c_custkey AS k, c_custkey::VARCHAR AS directory, sha256(c_name) AS sha FROM customer),
g AS (SELECT directory, bundle_id, revision FROM b WHERE violation IS NULL),
h AS (SELECT * FROM g UNION ALL SELECT directory, CASE WHEN k % 10 = 0 THEN 'bundle-v2-other' ELSE 'bundle-v2-' || sha[1:16] END, k % 6 FROM c WHERE k % 4 <> 0 AND directory NOT IN (SELECT directory FROM g)),
a AS (SELECT directory, orphaned FROM s WHERE directory IN (SELECT directory FROM g)
  UNION ALL SELECT o_custkey::VARCHAR, false FROM orders WHERE o_orderkey % 13 <> 0 AND o_custkey % 4 <> 0 AND o_custkey::VARCHAR NOT IN (SELECT directory FROM g)),
n AS (SELECT directory, count(*) AS n_sections, count(*) FILTER (orphaned) AS n_orphaned FROM a GROUP BY directory),
v AS (SELECT directory, violation FROM b WHERE violation IS NOT NULL
  UNION ALL SELECT directory, CASE WHEN k % 19 = 0 THEN 'bundle-v2-required' ELSE 'source-sha-required' END FROM c WHERE k % 23 <> 0 AND (k % 19 = 0 OR k % 17 = 0)),
j AS (SELECT h.directory, bundle_id, revision, coalesce(n_sections, 0) AS n_sections, coalesce(n_orphaned, 0) AS n_orphaned FROM h LEFT JOIN n ON n.directory = h.directory)
SELECT coalesce(j.directory, v.directory) AS directory, bundle_id, revision, n_sections, n_orphaned, violation FROM j FULL JOIN v ON v.directory = j.directory"""


@query
def ledger_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of status changes over ledgers, in one revision: the state of each section, and why a change was refused."""
    o = t(spark, sf_dir, "orders")
    own = F.col("o_custkey").cast("string").alias("directory")
    none = empty()
    store = new_store(spark, "moves")
    first = store.change()
    first.put("ledger_heads", o.select(own).distinct().select("directory", F.lit("b").alias("bundle_id"), F.lit("s").alias("source_sha256"), F.lit(3).cast("long").alias("revision"), F.lit("2020-01-01").cast("timestamp").alias("created_at")))
    status = F.when(F.col("o_orderstatus") == "F", "ingested").when(F.col("o_orderstatus") == "O", "in_progress").otherwise("qa_required")
    stamp = F.lit("2021-01-01").cast("timestamp")
    first.put("ledger_sections", o.select(own, F.col("o_orderkey").cast("string").alias("id"), F.lit("h").alias("content_sha256"), status.alias("status"), F.lit(None).cast("string").alias("previous_status"), none.alias("outputs"), none.alias("qa_items"), none.alias("notes"), stamp.alias("started_at"), F.lit(None).cast("timestamp").alias("completed_at"), stamp.alias("updated_at"), F.lit(False).alias("orphaned"), F.lit(None).cast("timestamp").alias("removed_at")))
    first.publish()
    to = F.when(mod("o_orderkey", 3), "in_progress").when(mod("o_orderkey", 5), "skipped").otherwise("ingested")
    key = F.concat(F.when(mod("o_orderkey", 13), "lost-").otherwise(""), F.col("o_orderkey").cast("string"))
    changes = o.select(own, key.alias("id"), to.alias("to_status"), (F.lit(3) - F.when(mod("o_orderkey", 11), 1).otherwise(0)).alias("expected_revision"), F.when(~mod("o_orderkey", 7), F.array(F.lit("out"))).alias("outputs"), F.when(mod("o_orderkey", 4), F.array(F.lit("n"))).alias("notes"))
    changes = changes.unionByName(changes.filter("try_cast(id AS LONG) % 17 = 0"))
    revision, refused = commits.change_sections(store, changes, F.lit("2024-01-01").cast("timestamp"))
    why = refused.groupBy("directory", "id").agg(F.min("violation").alias("violation"))
    heads = store.read("ledger_heads", revision).select("directory", "revision")
    sections = store.read("ledger_sections", revision).select("directory", "id", "status", "previous_status").join(heads, "directory")
    return sections.join(why, ["directory", "id"], "full_outer").select("directory", "id", "status", "previous_status", "revision", "violation")


SQL["ledger_moves"] = """
WITH o AS (SELECT o_custkey::VARCHAR AS directory, o_orderkey AS k, CASE o_orderstatus WHEN 'F' THEN 'ingested' WHEN 'O' THEN 'in_progress' ELSE 'qa_required' END AS status,
  CASE WHEN o_orderkey % 3 = 0 THEN 'in_progress' WHEN o_orderkey % 5 = 0 THEN 'skipped' ELSE 'ingested' END AS goal FROM orders),
c AS (SELECT *, CASE WHEN k % 13 = 0 THEN 'unknown-section' WHEN k % 17 = 0 THEN 'several-changes' WHEN k % 11 = 0 THEN 'revision-conflict'
  WHEN (status, goal) NOT IN (('in_progress', 'in_progress'), ('in_progress', 'ingested'), ('in_progress', 'skipped'), ('ingested', 'ingested'), ('qa_required', 'in_progress'), ('qa_required', 'skipped')) THEN 'invalid-transition'
  WHEN goal = 'ingested' AND k % 7 = 0 THEN 'output-required' WHEN goal = 'skipped' AND k % 4 <> 0 THEN 'note-required' END AS violation FROM o),
r AS (SELECT directory, 3 + max(CASE WHEN violation IS NULL THEN 1 ELSE 0 END) AS revision FROM c GROUP BY directory)
SELECT directory, k::VARCHAR AS id, CASE WHEN violation IS NULL THEN goal ELSE status END AS status, CASE WHEN violation IS NULL THEN status END AS previous_status, revision, CASE WHEN k % 13 <> 0 THEN violation END AS violation FROM c JOIN r USING (directory)
UNION ALL SELECT directory, 'lost-' || k, NULL, NULL, NULL, violation FROM c WHERE k % 13 = 0"""


@query
def trace_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traces of users, finished in two batches; each one's state, or what stands against it, and its capsule."""
    e = t(spark, sf_dir, "events")
    trace = F.col("user_id").cast("string").alias("trace_id")
    evidence = e.filter("event_type = 'purchase'").select(trace, (F.col("event_id") % 1009).cast("string").alias("evidence_id"), F.when(F.col("event_id") % 211 != 1, "v1").alias("document_version"), F.lit("not-checked").alias("original_asset_status"), F.lit(None).cast("string").alias("original_asset_path"))
    claims = e.filter("event_type = 'signup'").select(trace, F.col("event_id").cast("string").alias("claim_id"), F.lit("gap").alias("status"), empty().alias("evidence_ids"), F.col("event_id").alias("ordinal"), F.concat(F.lit("claim "), F.col("event_id").cast("string")).alias("text"))
    users = e.select("user_id").distinct()
    state = lambda rows: rows.select(trace, F.when(mod("user_id", 7), "odd").otherwise("completed").alias("status"), F.when(mod("user_id", 4), "gap").otherwise("clear").alias("evidence_level"), F.when(mod("user_id", 5), 1).otherwise(0).alias("n_open_stages"))
    store = new_store(spark, "traces")
    stamp = F.lit("2024-01-01").cast("timestamp")
    commits.finish_traces(store, state(users.filter("user_id % 2 = 0")), evidence, claims, stamp)
    revision, refused = commits.finish_traces(store, state(users), evidence, claims, stamp)
    codes = refused.groupBy(F.col("key").alias("trace_id")).agg(F.array_join(F.array_sort(F.collect_set("violation")), ",").alias("violations"))
    done = store.read("traces", revision).select("trace_id", "status", "n_evidence", "n_claims")
    bodies = store.read("trace_capsules", revision).select("trace_id", sha256("body").alias("body_sha256"))
    return done.join(codes, "trace_id", "full_outer").join(bodies, "trace_id", "left").select("trace_id", "status", "n_evidence", "n_claims", "violations", "body_sha256")


SQL["trace_commit"] = """
WITH e AS (SELECT user_id AS u, event_id % 1009 AS i, event_id % 211 = 1 AS bare FROM events WHERE event_type = 'purchase'),
c AS (SELECT user_id AS u, count(*) AS n, string_agg('- claim ' || event_id, chr(10) ORDER BY event_id) AS body FROM events WHERE event_type = 'signup' GROUP BY u),
n AS (SELECT u, count(*) AS n, count(*) > count(DISTINCT i) AS twice, bool_or(bare) AS bare FROM e GROUP BY u),
s AS (SELECT user_id AS u, coalesce(n.n, 0) AS n_evidence, coalesce(c.n, 0) AS n_claims, coalesce(twice, false) AS twice, coalesce(bare, false) AS bare, body, CASE WHEN user_id % 7 = 0 THEN 'odd' ELSE 'completed' END AS status
  FROM (SELECT DISTINCT user_id FROM events) x LEFT JOIN n ON n.u = user_id LEFT JOIN c ON c.u = user_id),
v AS (SELECT *, [x for x in [CASE WHEN twice THEN 'duplicate-evidence-id' END, CASE WHEN status = 'completed' AND n_claims = 0 THEN 'claims-required' END, CASE WHEN status = 'completed' AND u % 4 <> 0 AND n_evidence = 0 THEN 'evidence-required' END,
  CASE WHEN u % 5 = 0 THEN 'open-stages' END, CASE WHEN status = 'odd' THEN 'unknown-status' END, CASE WHEN bare THEN 'version-required' END] if x IS NOT NULL] AS codes FROM s),
w AS (SELECT *, len(codes) = 0 AS done, CASE WHEN len(codes) = 0 AND u % 2 = 0 THEN ['already-finished'] ELSE codes END AS told FROM v)
SELECT u::VARCHAR AS trace_id, CASE WHEN done THEN status END AS status, CASE WHEN done THEN n_evidence END AS n_evidence, CASE WHEN done THEN n_claims END AS n_claims, CASE WHEN len(told) > 0 THEN array_to_string(list_sort(told), ',') END AS violations, CASE WHEN done THEN sha256(body) END AS body_sha256 FROM w"""


# ---- rendered blocks


def block_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Conversations as lists of content blocks: a turn is a block whose kind and page follow from its number."""
    c = t(spark, sf_dir, "conversations")
    n = (F.col("conv_id") * 7 + F.col("turn") * 5) % 13
    kinds = ("text", "text", "image", "chart", "table", "table", "equation", "list", "code", "header", "text", "other", "table")
    kind = F.element_at(F.array(*[F.lit(k) for k in kinds]), (n + 1).cast("int"))
    heads = F.element_at(F.array(F.lit("Plain head"), F.lit("2 Scope"), F.lit("3.1.4 Deep"), F.lit("(2) item"), F.lit("4. item")), (F.col("turn") % 5 + 1).cast("int"))
    said = F.concat(F.lit(" "), F.replace(F.substring("text", 1, 60), F.lit("\n"), F.lit(" ")), F.lit("x "))
    blocks = c.select(
        F.col("conv_id").cast("string").alias("file"), F.col("turn").cast("int").alias("ordinal"), kind.alias("type"), F.when(n == 0, heads).when(n.isin(1, 6, 7, 11), said).when(n == 10, " \n").alias("text"),
        F.when(n == 0, 1 + F.col("conv_id") % 2).cast("int").alias("text_level"), F.when(F.col("turn") % 9 == 8, "bad").otherwise(F.floor(F.col("turn") / 2).cast("string")).alias("page_idx"),
        F.when(n.isin(2, 3, 4), F.concat(F.lit("img/"), F.col("turn").cast("string"), F.when(mod("turn", 3), ".JPG").otherwise(".tiff"))).alias("img_path"),
        F.when(n.isin(2, 3) & mod("turn", 3), F.array(F.lit(" Figure 7 "), F.lit(""))).when(n == 2, empty()).alias("image_caption"),
        F.when((n == 4) & mod("conv_id", 2), F.array(F.lit("Table A-1"))).when(n == 5, empty()).when((n == 12) & mod("turn", 2), F.array(F.lit("Table 9"))).alias("table_caption"),
        F.when(n == 4, "<table><tr> <td>1</td></tr></table>").alias("table_body"), F.when((n == 7) & mod("turn", 2), F.array(F.lit("a "), F.lit(" "), F.lit("b"))).alias("list_items"), F.when(n == 8, "x = 1\n").alias("code_body"))
    assets = c.filter("turn % 4 <> 1").select(F.col("conv_id").cast("string").alias("file"), F.concat(F.lit("img/"), F.col("turn").cast("string"), F.when(mod("turn", 3), ".JPG").otherwise(".tiff")).alias("img_path"))
    return blocks, assets


@query
def render_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    laid = render.laid_out(*block_rows(spark, sf_dir))
    codes = render.issues(laid).groupBy("file").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("@", "code", F.coalesce(F.col("page").cast("string"), F.lit("-"))))), ",").alias("issues"))
    images = render.images(laid).groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", F.concat_ws("|", "id", "path", "quality").alias("x")))), lambda r: r.x), ",").alias("images"))
    tables = render.tables(laid).groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", F.concat_ws("|", "id", F.col("page_start").cast("string"), F.col("page_end").cast("string"), "quality", F.coalesce("evidence_path", F.lit("-"))).alias("x")))), lambda r: r.x), ",").alias("tables"))
    found = render.documents(laid).select("file", sha256("markdown").alias("markdown_sha256"), "n_lines", "n_blocks", "max_page")
    for more in (codes, images, tables):
        found = found.join(more, "file", "left")
    return found.fillna("", ["issues", "images", "tables"])


SQL["render_documents"] = r"""
WITH RECURSIVE c AS (SELECT conv_id, turn, text, (conv_id * 7 + turn * 5) % 13 AS n FROM conversations),
a AS (SELECT conv_id::VARCHAR AS file, turn, n, ['text', 'text', 'image', 'chart', 'table', 'table', 'equation', 'list', 'code', 'header', 'text', 'other', 'table'][n + 1] AS kind,
  CASE WHEN turn % 9 = 8 THEN 1 ELSE turn // 2 + 1 END AS page, CASE WHEN n = 0 THEN 1 + conv_id % 2 ELSE 0 END AS raw, conv_id % 2 = 0 AS even,
  regexp_replace(CASE WHEN n = 0 THEN ['Plain head', '2 Scope', '3.1.4 Deep', '(2) item', '4. item'][turn % 5 + 1] WHEN n IN (1, 6, 7, 11) THEN replace(text[1:60], chr(10), ' ') || 'x' WHEN n = 8 THEN 'x = 1' WHEN n = 4 THEN '<table><tr> <td>1</td></tr></table>' ELSE '' END, '^\s+', '') AS said,
  CASE WHEN n = 0 THEN ['next', '2', '4', '0', '0'][turn % 5 + 1] END AS rule, CASE WHEN turn % 3 = 0 THEN '.jpg' ELSE '.png' END AS suffix, n IN (2, 3, 4) AND turn % 4 <> 1 AS there FROM c WHERE n <> 9),
b AS (SELECT *, row_number() OVER w AS k, lag(page) OVER w AS before, sum(CASE WHEN kind IN ('image', 'chart') THEN 1 ELSE 0 END) OVER w AS i_no, sum(CASE WHEN kind = 'table' THEN 1 ELSE 0 END) OVER w AS t_no, sum(CASE WHEN kind = 'equation' THEN 1 ELSE 0 END) OVER w AS e_no FROM a WINDOW w AS (PARTITION BY file ORDER BY turn)),
d AS (SELECT *, CASE WHEN n IN (2, 3) AND turn % 3 = 0 THEN 'Figure 7' WHEN n = 2 THEN 'Figure p' || page || '-' || i_no WHEN n = 3 THEN 'Chart p' || page || '-' || i_no WHEN n = 4 AND even THEN 'Table A-1' WHEN n = 12 AND turn % 2 = 0 THEN 'Table 9' WHEN kind = 'table' THEN 'Table p' || page || '-' || t_no END AS caption,
  CASE WHEN n IN (2, 3) AND turn % 3 = 0 THEN 'fig_7' WHEN n = 2 THEN 'fig_p' || page || '_' || i_no WHEN n = 3 THEN 'fig_p' || page || '_n' || i_no WHEN n = 4 AND even THEN 'table_a_1' WHEN n = 12 AND turn % 2 = 0 THEN 'table_9' WHEN kind = 'table' THEN 'table_p' || page || '_' || t_no END AS base,
  n = 5 OR (n = 12 AND turn % 2 <> 0) AS bare FROM b),
r AS (SELECT DISTINCT file, 0::BIGINT AS k, 0 AS cur, []::VARCHAR[] AS taken, NULL::VARCHAR AS tid, NULL::BIGINT AS until, 0 AS lvl, false AS cont, NULL::VARCHAR AS id FROM d
  UNION ALL SELECT file, k, CASE WHEN lvl > 0 THEN lvl ELSE cur END, CASE WHEN fresh IS NOT NULL AND NOT cont THEN list_append(taken, fresh) ELSE taken END, CASE WHEN kind = 'table' AND NOT cont THEN fresh ELSE tid END,
    CASE WHEN kind <> 'table' THEN until WHEN cont THEN greatest(until, page) ELSE page END, lvl, cont, CASE WHEN cont THEN tid ELSE fresh END
  FROM (SELECT d.file, d.k, r.cur, r.taken, r.tid, r.until, d.kind, d.page, CASE WHEN d.n <> 0 THEN 0 WHEN r.cur = 0 THEN 1 WHEN d.rule = 'next' THEN least(greatest(r.cur + 1, 2), 6) WHEN d.rule = '2' THEN 2 ELSE d.rule::INT END AS lvl, coalesce(d.bare AND r.tid IS NOT NULL AND d.page <= r.until + 1, false) AS cont,
    CASE WHEN d.base IS NULL THEN NULL WHEN NOT list_contains(r.taken, d.base) THEN d.base ELSE d.base || '_' || list_filter(range(2, len(r.taken) + 3), lambda x: NOT list_contains(r.taken, d.base || '_' || x))[1] END AS fresh FROM r JOIN d ON d.file = r.file AND d.k = r.k + 1) x),
m AS (SELECT d.*, r.lvl, r.cont, r.id, r.until FROM d JOIN r ON r.file = d.file AND r.k = d.k),
l AS (SELECT *, CASE WHEN page IS DISTINCT FROM before THEN '<!-- source-page: ' || page || ' -->' || chr(10) || chr(10) ELSE '' END || CASE
  WHEN kind IN ('image', 'chart') THEN '![' || caption || '](images/' || id || suffix || ')' || chr(10) || chr(10)
  WHEN cont THEN '<!-- table-continuation: ' || id || '; source-page: ' || page || '; qa: warn -->' || chr(10) || chr(10)
  WHEN kind = 'table' THEN '**' || caption || '**' || chr(10) || chr(10) || '[查看表格](tables/' || id || '.md)' || chr(10) || chr(10) || '<!-- table-id: ' || id || '; source-page: ' || page || '; qa: ' || CASE WHEN n = 4 THEN 'pass' ELSE 'warn' END || ' -->' || chr(10) || chr(10)
  WHEN n = 7 AND turn % 2 = 0 THEN '- a' || chr(10) || '- b' || chr(10) || chr(10) WHEN said = '' THEN '' WHEN kind = 'equation' THEN '<!-- block-id: eq_p' || page || '_n' || e_no || '; source-page: ' || page || '; qa: review -->' || chr(10) || chr(10) || said || chr(10) || chr(10)
  WHEN kind = 'code' THEN '```' || chr(10) || said || chr(10) || '```' || chr(10) || chr(10) WHEN lvl > 0 THEN repeat('#', lvl) || ' ' || said || chr(10) || chr(10) WHEN raw > 0 THEN '**' || said || '**' || chr(10) || chr(10) ELSE said || chr(10) || chr(10) END AS ls FROM m),
t AS (SELECT x.file, x.turn, x.id, x.page AS p1, greatest(x.page, coalesce(max(y.until), x.page)) AS p2, CASE WHEN x.n <> 4 OR count(y.id) > 0 THEN 'warn' ELSE 'pass' END AS q, CASE WHEN x.there THEN 'tables/' || x.id || '_source' || x.suffix ELSE '-' END AS ev FROM m x LEFT JOIN m y ON y.file = x.file AND y.cont AND y.id = x.id WHERE x.kind = 'table' AND NOT x.cont GROUP BY x.file, x.turn, x.id, x.page, x.n, x.there, x.suffix),
i AS (SELECT file, 'missing-image-asset@' || page AS x FROM m WHERE kind IN ('image', 'chart') AND NOT there UNION ALL SELECT file, CASE WHEN cont THEN 'cross-page-table-continuation-unresolved@' ELSE 'table-body-unavailable@' END || page FROM m WHERE kind = 'table' AND n <> 4
  UNION ALL SELECT file, 'heading-levels-reconstructed@-' FROM m WHERE raw > 0 GROUP BY file HAVING count(DISTINCT raw) = 1 AND count(*) > 10),
f AS (SELECT file, regexp_replace(regexp_replace(string_agg(ls, '' ORDER BY turn), '^\s+', ''), '\s+$', '') || chr(10) AS md, count(*)::INT AS n_blocks, max(page)::INT AS max_page FROM l GROUP BY file)
SELECT f.file, sha256(md) AS markdown_sha256, (length(md) - length(replace(md, chr(10), '')))::INT AS n_lines, n_blocks, max_page, coalesce((SELECT string_agg(x, ',' ORDER BY x) FROM i WHERE i.file = f.file), '') AS issues,
  coalesce((SELECT string_agg(id || '|images/' || id || suffix || '|' || CASE WHEN there THEN 'pass' ELSE 'fail' END, ',' ORDER BY turn) FROM m WHERE m.file = f.file AND kind IN ('image', 'chart')), '') AS images,
  coalesce((SELECT string_agg(id || '|' || p1 || '|' || p2 || '|' || q || '|' || ev, ',' ORDER BY turn) FROM t WHERE t.file = f.file), '') AS tables FROM f"""


# ---- decisions, and counts of a run

DECISIONS = (
    '{"status":"completed","claims":[{"text":" A "},{"claim":"B","evidence_refs":["P1","P2"]}],"unresolved_items":["u"]}', '{"status":', "[1,2]", '{"status":"x","zeta":1,"alpha":2}', '{"unresolved":["a"],"unresolved_items":["b"]}', '{"unresolved":["","x"]}', '{"claims":{}}',
    '{"claims":[{"text":"ok"},7]}', '{"claims":[{"text":" ","statement":5}]}', '{"claims":[{"claim_text":"t","evidence_refs":"P1"}]}', '{"events":[{"stage":"s","extensions":{"route":1}}]}', '{"claims":[],"verified_evidence_refs":["P3"],"events":[{"stage":"s","note":"n"}]}',
)


@query
def decision_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions of all shapes, one for each turn; both outputs, as they are written."""
    which = ((F.col("conv_id") * 3 + F.col("turn")) % len(DECISIONS) + 1).cast("int")
    rows = t(spark, sf_dir, "conversations").select("conv_id", "turn", F.element_at(F.array(*[F.lit(d) for d in DECISIONS]), which).alias("decision"))
    store = new_store(spark, "decisions")
    decisions.record_decisions(store, rows)
    claim = F.get("claims", F.size("claims") - 1)
    return store.read("decisions").select("conv_id", "turn", F.size("claims").alias("n_claims"), claim.text.alias("last_text"), F.array_join(claim.evidence_refs, "+").alias("refs"), F.array_join("unresolved", "+").alias("unresolved"), F.size("verified_evidence_refs").alias("n_verified"), "n_events", "reason", "recommendation")


SQL["decision_fold"] = """
WITH c AS (SELECT conv_id, turn, (conv_id * 3 + turn) % 12 AS k FROM conversations), g AS (SELECT *, k IN (0, 11) AS ok FROM c)
SELECT conv_id, turn, CASE WHEN ok THEN CASE k WHEN 0 THEN 2 ELSE 0 END END::INT AS n_claims, CASE k WHEN 0 THEN 'B' END AS last_text, CASE k WHEN 0 THEN 'P1+P2' END AS refs, CASE k WHEN 0 THEN 'u' WHEN 11 THEN '' END AS unresolved,
  CASE k WHEN 0 THEN 0 WHEN 11 THEN 1 END::INT AS n_verified, CASE k WHEN 0 THEN 0 WHEN 11 THEN 1 END::INT AS n_events,
  CASE k WHEN 1 THEN 'broken-json' WHEN 2 THEN 'not-an-object' WHEN 3 THEN 'unsupported-fields:alpha,zeta' WHEN 4 THEN 'unresolved-conflict' WHEN 5 THEN 'unresolved-not-texts' WHEN 6 THEN 'claims-not-a-list' WHEN 7 THEN 'claim-2-not-an-object'
    WHEN 8 THEN 'claim-1-without-text' WHEN 9 THEN 'claim-1-refs-not-a-list' WHEN 10 THEN 'event-1-reserved-extensions:route' END AS reason,
  CASE WHEN k IN (1, 2) THEN 'send-the-decision-again' WHEN k = 3 THEN 'drop-or-rename-fields' WHEN NOT ok THEN 'correct-and-finalize-again' END AS recommendation FROM g"""


@query
def lint_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a lint run over all pages counts as it goes, beside the issues that it writes."""
    p = t(spark, sf_dir, "pages")
    path = F.concat(F.when(mod("page_id", 3), "v/30_Cards/").otherwise("v/n/"), F.col("page_id").cast("string"), F.when(mod("page_id", 7), ".source-map.md").otherwise(".md"))
    matter = F.when(~mod("page_id", 5), F.create_map(F.lit("type"), F.array(F.when(mod("page_id", 2), "knowledge-card").otherwise("note"))))
    notes = p.select(path.alias("path"), matter.alias("frontmatter"), F.when(mod("page_id", 4), F.array(F.lit("x"))).otherwise(empty()).alias("links"))
    events: list[dict] = []
    with observed.Run("lint", "rules", events.append, lint.metrics()) as run:
        found = lint.front_matter_rules(run.rows(notes))
        found.write.parquet(work_folder(spark, "issues"))
    return spark.createDataFrame([tuple(events[0][k] for k in ("hit_count", *lint.metrics()))], "hit_count long, governed_markdown_files long, knowledge_cards long, linked_knowledge_cards long")


SQL["lint_metrics"] = """
SELECT count(*) AS hit_count, count(*) AS governed_markdown_files, count(*) FILTER (page_id % 3 = 0) AS knowledge_cards, count(*) FILTER (page_id % 7 <> 0 AND page_id % 5 <> 0 AND page_id % 2 = 0 AND page_id % 4 = 0) AS linked_knowledge_cards FROM pages"""


# ---- small operators that other queries don't reach


@query
def corpus_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = t(spark, sf_dir, "documents")
    return sync.corpus_fingerprint(sync.fingerprints(d, "doc_id", "text"))


SQL["corpus_prints"] = """
SELECT count(*) AS n_sources, sha256(coalesce(sum(('0x' || sha256(doc_id || '|' || sha256(text))[1:15])::BIGINT), 0)::HUGEINT::VARCHAR) AS corpus_fingerprint FROM documents"""


@query
def claim_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first alias of a claim that says something, cut to length."""
    c = t(spark, sf_dir, "conversations")
    claims = c.select("conv_id", "turn", F.when(mod("turn", 2), " ").alias("text"), F.when(mod("turn", 3), F.col("text")).alias("claim"), F.when(mod("turn", 5), "").otherwise(F.col("role")).alias("statement"), F.lit("last").alias("claim_text"))
    return trace.short_claim(claims, 90).select("conv_id", "turn", "text")


SQL["claim_texts"] = """
WITH c AS (SELECT conv_id, turn, trim(CASE WHEN turn % 3 = 0 AND trim(text) <> '' THEN text WHEN turn % 5 <> 0 THEN role ELSE 'last' END) AS x FROM conversations)
SELECT conv_id, turn, CASE WHEN length(x) <= 90 THEN x ELSE x[1:89] || '…' END AS text FROM c"""


@query
def unknown_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = t(spark, sf_dir, "orders")
    given = F.map_from_arrays(F.array(F.lit("answer"), F.concat(F.lit("k"), (F.col("o_orderkey") % 3).cast("string")), F.when(mod("o_orderkey", 2), "claims").otherwise("zeta")), F.array(F.lit(1), F.lit(2), F.lit(3)))
    return o.select("o_orderkey", F.array_join(session.unknown_keys(given, (*session.DECISION_KEYS, "k1")), ",").alias("unknown"))


SQL["unknown_fields"] = """
SELECT o_orderkey, array_to_string([x for x in [CASE WHEN o_orderkey % 3 <> 1 THEN 'k' || (o_orderkey % 3) END, CASE WHEN o_orderkey % 2 <> 0 THEN 'zeta' END] if x IS NOT NULL], ',') AS unknown FROM orders"""


@query
def projection_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t(spark, sf_dir, "part")
    name = F.concat(F.regexp_replace("p_name", " ", F.lit(" & ")), F.when(mod("p_partkey", 3), "_image_document_bundle").when(mod("p_partkey", 2), "_document_bundle").otherwise("!"))
    return p.select("p_partkey", headings.projection_name(F.when(mod("p_partkey", 7), "!?").otherwise(name)).alias("name"))


SQL["projection_names"] = """
SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'document' ELSE regexp_replace(regexp_replace(replace(p_name, ' ', ' & '), '[^A-Za-z0-9._-]+', '-', 'g'), '^-+|-+$', '', 'g') END || '.section-query-index.json' AS name FROM part"""


@query
def heading_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels of headings, and ids of figures and tables, of each conversation in order."""
    c = t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("file"), F.col("turn").cast("int").alias("ordinal"))
    said = F.element_at(F.array(F.lit("Plain"), F.lit("2 Scope"), F.lit("3.1.4 Deep"), F.lit("(2) item"), F.lit("4. item"), F.lit("目 录"), F.lit("附录 2")), ((F.col("file") + F.col("ordinal") * 3) % 7 + 1).cast("int"))
    levels = headings.structural_levels(c.withColumns({"text": said, "text_level": F.when(mod("ordinal", 4), 0).otherwise(1)}))
    caption = F.element_at(F.array(F.lit("Figure 2.1 x"), F.lit("Table 3"), F.lit(None).cast("string"), F.lit("none")), ((F.col("file") + F.col("ordinal")) % 4 + 1).cast("int"))
    ids = headings.asset_ids(c.withColumns({"caption": caption, "kind": F.when(mod("ordinal", 3), "table").otherwise("fig"), "page": (F.col("ordinal") / 2).cast("int") + 1, "sequence": F.col("ordinal") + 1}))
    return levels.join(ids, ["file", "ordinal"])


SQL["heading_levels"] = """
WITH RECURSIVE c AS (SELECT conv_id AS file, turn::INT AS ordinal, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, (conv_id + turn * 3) % 7 AS h, (conv_id + turn) % 4 AS q, turn % 3 = 0 AS is_table, turn % 4 = 0 AS bare FROM conversations),
b AS (SELECT *, CASE WHEN q = 0 AND NOT is_table THEN 'fig_2_1' WHEN q = 1 THEN 'table_3' ELSE CASE WHEN is_table THEN 'table' ELSE 'fig' END || '_p' || (ordinal // 2 + 1) || '_n' || (ordinal + 1) END AS base FROM c),
r AS (SELECT DISTINCT file, 0::BIGINT AS k, NULL::INT AS ordinal, 0 AS level, 0 AS cur, NULL::VARCHAR AS id, []::VARCHAR[] AS taken FROM b
  UNION ALL SELECT file, k, ordinal, level, CASE WHEN level > 0 THEN level ELSE cur END, id, list_append(taken, id) FROM (SELECT b.file, b.k, b.ordinal, r.cur, r.taken,
    CASE WHEN r.cur = 0 THEN 1 WHEN h IN (5, 6) THEN 2 WHEN h = 3 THEN 0 WHEN h = 1 THEN 2 WHEN h = 2 THEN 4 WHEN h = 4 THEN 0 WHEN bare THEN 0 ELSE least(greatest(r.cur + 1, 2), 6) END AS level,
    CASE WHEN NOT list_contains(r.taken, base) THEN base ELSE base || '_' || list_filter(range(2, len(r.taken) + 3), lambda x: NOT list_contains(r.taken, base || '_' || x))[1] END AS id FROM r JOIN b ON b.file = r.file AND b.k = r.k + 1) x)
SELECT file, ordinal, level, id FROM r WHERE k > 0"""


@query
def event_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate lists of trace events, cut to what an audit keeps."""
    e = t(spark, sf_dir, "events")
    some = F.transform(F.sequence(F.lit(1), (F.col("event_id") % 40 + 1).cast("int")), lambda i: i.cast("string"))
    found = trace.clean_events(e.select("event_id", some.alias("candidates"), F.slice(some, 1, 3).alias("rejected")))
    return found.select("event_id", F.size("candidates").alias("n_candidates"), F.array_join("rejected", ",").alias("rejected"))


SQL["event_cuts"] = """
SELECT event_id, least(event_id % 40 + 1, 20)::INT AS n_candidates, array_to_string([x for x in range(1, least(event_id % 40 + 1, 3) + 1)], ',') AS rejected FROM events"""


# ---- bundles of images


@query
def image_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as images in sets of one to five, some with a text: documents, digests and where the last section lies."""
    p = t(spark, sf_dir, "pages")
    size = F.when(F.floor(F.col("page_id") / 5) % 4 == 0, F.col("page_id")).otherwise(F.floor(F.col("page_id") / 5) + 10**9)
    images = p.select(size.alias("bundle"), F.col("page_id").alias("ordinal"), F.concat(F.lit("in/a b"), F.col("page_id").cast("string"), F.lit(".PNG")).alias("path"), sha256("html").alias("sha256"), F.when(~mod("page_id", 3), F.concat(F.lit(" "), F.substring("html", 1, 30), F.lit("x\n"))).alias("ocr_text"))
    placed = image_bundles.pages(images)
    ends = image_bundles.sections(placed).groupBy("bundle").agg(F.max("start_line").alias("last_start"), F.max("end_line").alias("last_end"))
    found = image_bundles.bundles(placed, "table-image").join(ends, "bundle")
    return found.select("bundle", sha256("document").alias("document_sha256"), "source_filename", "source_sha256", "n_images", "n_texts", F.size("issues").alias("n_issues"), F.array_join("review_required", ",").alias("review_required"), "last_start", "last_end")


SQL["image_sets"] = """
WITH p AS (SELECT CASE WHEN (page_id // 5) % 4 = 0 THEN page_id ELSE page_id // 5 + 1000000000 END AS bundle, page_id, sha256(html) AS sha, CASE WHEN page_id % 3 <> 0 THEN regexp_replace(html[1:30] || 'x', '^\\s+', '') ELSE '' END AS said FROM pages),
n AS (SELECT *, row_number() OVER (PARTITION BY bundle ORDER BY page_id) AS page FROM p),
l AS (SELECT *, CASE WHEN said = '' THEN 10 ELSE 12 END AS n, '<!-- source-page: ' || page || ' -->' || chr(10) || chr(10) || '# Image page ' || page || chr(10) || chr(10) || '![Image page ' || page || '](images/page_' || lpad(page::VARCHAR, 3, '0') || '.png)' || chr(10) || chr(10)
  || CASE WHEN said = '' THEN '<!-- image-only-source: true; qa: review -->' || chr(10) || chr(10) || 'OCR text is unavailable. Treat this page as visual evidence until targeted OCR or manual review is completed.' ELSE '<!-- ocr-derived: true; qa: review -->' || chr(10) || chr(10) || '## OCR Text' || chr(10) || chr(10) || said END AS ls FROM n),
g AS (SELECT bundle, string_agg(ls, chr(10) || chr(10) ORDER BY page) || chr(10) AS doc, string_agg(sha, '' ORDER BY page) AS shas, min(page_id) AS first, count(*) AS n_images, count(*) FILTER (said <> '') AS n_texts, sum(n)::INT AS total, arg_max(n, page) AS last_n FROM l GROUP BY bundle)
SELECT bundle, sha256(doc) AS document_sha256, CASE WHEN n_images = 1 THEN 'a b' || first || '.PNG' ELSE 'a-b' || first || '-image-set' END AS source_filename, CASE WHEN n_images = 1 THEN shas ELSE sha256(shas) END AS source_sha256, n_images, n_texts, (n_images - n_texts + 1)::INT AS n_issues,
  'image-source-visual-review' || CASE WHEN n_texts > 0 THEN ',ocr-text-verification' ELSE '' END || ',table-structure' AS review_required, total - last_n + 3 AS last_start, total - 1 AS last_end FROM g"""
