"""JSON sources of bundles: manifests, outlines, ledgers, projections, block lists, traces; and their sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.paths import normalised
from ..model import RANGES
from .files import folders

SECTION_DDL = f"id string, section_id string, title string, level int, parent string, path array<string>, path_titles array<string>, start_line int, end_line int, content_ranges {RANGES}, pages array<int>, assets array<string>, quality string, status string, ingest_status string, content_sha256 string, content_hash string, ingest_unit boolean, outputs array<string>, qa_items array<string>, notes array<string>"
MANIFEST_DDL = "schema_version string, source struct<filename:string,sha256:string>, document struct<path:string>, outline struct<path:string>, validation struct<status:string>"
OUTLINE_DDL = f"sections array<struct<{', '.join(f.replace(' ', ':', 1) for f in ('id string', 'title string', 'level int', 'parent string', 'path array<string>', 'start_line int', 'end_line int', 'pages array<int>', 'assets array<string>', 'quality string'))}>>"


def json_files(spark: SparkSession, root: str, glob: str, schema: str, drop_broken: bool = True) -> DataFrame:
    """One row for each JSON file below the root: path, directory, the schema's columns. Broken files are skipped, or
    kept with their text in _corrupt_record."""
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(folders(spark, root), wholetext=True)
    path = F.url_decode(F.col("_metadata.file_path"))
    clean = F.regexp_replace("value", "^\ufeff", "")
    whole = F.try_parse_json(clean).isNotNull() & F.ltrim(clean).startswith("{")
    found = rows.select(path.alias("file"), F.element_at(F.split(path, "/"), -2).alias("directory"), F.from_json(clean, schema).alias("j"), F.when(~whole, clean).alias("_corrupt_record")).select("file", "directory", "j.*", "_corrupt_record")
    return found.filter("_corrupt_record IS NULL").drop("_corrupt_record") if drop_broken else found


def discover_bundles(spark: SparkSession, root: str, flat: bool = False) -> DataFrame:
    """directory, folder of bundles: where manifest, outline and document are all there; ``flat`` takes only direct
    children with a bundle's suffix, complete or not."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    listing = listing if flat else listing.option("pathGlobFilter", "{manifest.json,outline.json,document.md}")
    files = listing.load(root).select(F.url_decode("path").alias("path"))
    parts = files.select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("folder"), F.element_at(F.split("path", "/"), -1).alias("name"))
    if flat:
        base = root.rstrip("/").removeprefix("file://")
        parts = parts.filter(F.regexp_extract("folder", r"([^/]+)$", 1).rlike("_(image_)?document_bundle$") & F.regexp_extract("folder", r"^(.*)/[^/]+$", 1).endswith(base))
    have = parts.groupBy("folder").agg(*[F.bool_or(F.col("name") == n).alias(n.partition(".")[0]) for n in ("manifest.json", "outline.json", "document.md")])
    have = have if flat else have.filter("manifest AND outline AND document")
    return have.withColumn("directory", F.element_at(F.split("folder", "/"), -1))


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    return json_files(spark, root, "manifest.json", MANIFEST_DDL)


def read_outlines(spark: SparkSession, root: str) -> DataFrame:
    """directory and its sections, one row each."""
    found = json_files(spark, root, "outline.json", OUTLINE_DDL)
    return found.select("directory", F.posexplode("sections").alias("ordinal", "s")).select("directory", "ordinal", "s.*")


def read_ledgers(spark: SparkSession, root: str, keep_broken: bool = False) -> DataFrame:
    schema = f"bundle_id string, revision int, state string, control struct<bundle_path:string,source_map_path:string>, validation struct<status:string>, source struct<sha256:string,filename:string>, sections array<struct<{', '.join(f.strip().replace(' ', ':', 1) for f in SECTION_DDL.replace(RANGES, 'RANGES').split(', '))}>>".replace("RANGES", RANGES)
    return json_files(spark, root, "*.section-ledger.json", schema, drop_broken=not keep_broken)


def last_of(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key, the last in order."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).filter("__n = 1").drop("__n")


def read_projections(spark: SparkSession, root: str) -> DataFrame:
    """The projected sections of all documents, one row each; of two files for one document the last by name."""
    section = "section_id:string,title:string,level:int,parent:string,path:array<string>,path_titles:array<string>,start_line:int,end_line:int,content_ranges:" + RANGES + ",pages:array<int>,assets:array<string>,quality:string,ingest_status:string,content_hash:string"
    schema = f"document struct<document_path:string,source_filename:string,bundle_path:string,routing_terms:array<string>>, sections array<struct<{section}>>"
    found = json_files(spark, root, "*.section-query-index.json", schema).withColumn("document_path", normalised("document.document_path")).filter("document_path <> ''")
    return last_of(found, "document_path", "file").select("document_path", "document.source_filename", "document.bundle_path", "document.routing_terms", F.explode("sections").alias("s")).select("document_path", "source_filename", "bundle_path", "routing_terms", "s.*")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Content blocks of a list, or of an object that holds one under content_list, data or items; in order. A list of
    lists, as files grouped by page have it, and any other shape raise."""
    block = "struct<type:string,text:string,text_level:int,page_idx:string,bbox:array<double>,img_path:string,image_caption:array<string>,table_caption:array<string>,table_body:string,list_items:array<string>,code_body:string>"
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    keyed = F.coalesce(*[F.from_json("value", f"struct<{k}:array<{block}>>")[k] for k in ("content_list", "data", "items")])
    lists = F.when(F.ltrim("value").startswith("["), F.from_json("value", f"array<{block}>")).otherwise(keyed)
    parts = F.from_json("value", "array<string>")
    grouped = F.ltrim("value").startswith("[") & (F.size(parts) > 0) & F.forall(parts, lambda p: F.startswith(p, F.lit("[")))
    error = lambda what: F.raise_error(F.concat(F.lit(f"{what}: "), "file")).cast(f"array<{block}>")
    lists = F.when(grouped, error("content list is grouped by page")).when(lists.isNull(), error("content list of an unknown shape")).otherwise(lists)
    return raw.select("file", F.posexplode(lists).alias("ordinal", "b")).select("file", "ordinal", "b.*")


def build_projection(manifests: DataFrame, outlines: DataFrame, ledgers: DataFrame) -> DataFrame:
    """The read model: sections of outlines with the state of their ledgers. Bundles meet ledgers by directory name,
    sections by id; a section without a ledger is untracked and owns its whole scope."""
    held = ledgers.select("directory", F.explode("sections").alias("l")).select("directory", F.col("l.id").alias("id"), F.col("l.status").alias("__status"), F.col("l.content_ranges").alias("__ranges"), F.col("l.content_sha256").alias("__hash"))
    whole = F.array(F.struct("start_line", "end_line"))
    titles = outlines.groupBy("directory").agg(F.map_from_entries(F.collect_list(F.struct("id", "title"))).alias("__titles"))
    joined = outlines.join(held, ["directory", "id"], "left").join(titles, "directory").join(manifests.select("directory", F.col("source.filename").alias("source_filename"), F.col("source.sha256").alias("source_sha256")), "directory")
    named = F.filter(F.transform("path", lambda p: F.element_at(F.col("__titles"), p)), lambda t: t.isNotNull())
    return joined.select(F.concat("directory", F.lit("/document.md")).alias("document_path"), "source_filename", "source_sha256", F.col("id").alias("section_id"), "title", "level", "parent", "path", named.alias("path_titles"), "start_line", "end_line", F.coalesce("__ranges", whole).alias("content_ranges"), "pages", "assets", "quality", F.coalesce("__status", F.lit("untracked")).alias("ingest_status"), F.col("__hash").alias("content_hash"))


def routing_terms(terms: DataFrame, by: str) -> DataFrame:
    """Distinct terms of a group by lower case, the first spelling kept, in order. terms: by, ordinal, term."""
    first = terms.groupBy(by, F.lower("term").alias("__t")).agg(F.min_by("term", "ordinal").alias("term"), F.min("ordinal").alias("ordinal"))
    return first.groupBy(by).agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "term"))), lambda x: x.term).alias("routing_terms"))


def write_json(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines by Spark's commit protocol; refuses a folder that is there unless told otherwise."""
    rows.write.mode(mode).json(path)
