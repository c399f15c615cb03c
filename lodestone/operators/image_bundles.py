"""Bundles of images: one page and one section an image, its OCR text for review, and a digest over the whole set.

A bundle's images are its pages in the order of ``ordinal``. Line numbers count what is emitted, piece by piece, so an OCR
text is one piece however many lines it has. All is relational: running sums place a page in its document, and a bundle is
put together by one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Lines of a page, and what is said of one without OCR text.
UNAVAILABLE = "OCR text is unavailable. Treat this page as visual evidence until targeted OCR or manual review is completed."
REVIEWS = {"table-image": "table-structure", "figure-image": "figure-internals-when-used-as-evidence"}


def lines(said: Column, page: Column, path: Column) -> Column:
    n, blank = page.cast("string"), F.lit("")
    head = [F.concat(F.lit("<!-- source-page: "), n, F.lit(" -->")), blank, F.concat(F.lit("# Image page "), n), blank, F.concat(F.lit("![Image page "), n, F.lit("]("), path, F.lit(")")), blank]
    read = F.array(*head, F.lit("<!-- ocr-derived: true; qa: review -->"), blank, F.lit("## OCR Text"), blank, said, blank)
    return F.when(said != "", read).otherwise(F.array(*head, F.lit("<!-- image-only-source: true; qa: review -->"), blank, F.lit(UNAVAILABLE), blank))


def pages(images: DataFrame) -> DataFrame:
    """bundle, page, id, path, source_path, source_sha256, ocr_text, lines, start_line, end_line, line of each image.

    images: bundle, ordinal, path, sha256, ocr_text (null: none)."""
    order = Window.partitionBy("bundle").orderBy("ordinal", "path")
    said = F.regexp_replace(F.coalesce("ocr_text", F.lit("")), r"(?U)^\s+|\s+$", "")
    rows = images.select("bundle", F.row_number().over(order).alias("page"), F.col("path").alias("source_path"), F.col("sha256").alias("source_sha256"), said.alias("ocr_text"))
    rows = rows.withColumn("id", F.format_string("page_%03d", "page"))
    rows = rows.withColumn("path", F.concat(F.lit("images/"), "id", F.lower(F.regexp_extract("source_path", r"[^./\\](\.[^./\\]+)$", 1))))
    rows = rows.withColumn("lines", lines(F.col("ocr_text"), F.col("page"), F.col("path")))
    after = F.sum(F.size("lines")).over(Window.partitionBy("bundle").orderBy("page")).cast("int")
    return rows.withColumns({"end_line": after - 1, "start_line": after - F.size("lines") + 3, "line": after - F.size("lines") + 5})


def bundles(placed: DataFrame, material: str = "image") -> DataFrame:
    """bundle, document, source_filename, source_sha256, n_images, n_texts, status, issues (code, page) and
    review_required. placed: of ``pages``. Of one image the digest is its own, of several that of all digests in order."""
    row = F.struct("page", F.col("lines").alias("ls"), "source_sha256", "source_path", F.when(F.col("ocr_text") == "", F.struct(F.lit("ocr-text-unavailable").alias("code"), F.col("page").cast("int").alias("page"))).alias("issue"))
    sums = placed.groupBy("bundle").agg(F.array_sort(F.collect_list(row)).alias("ps"), F.count("*").alias("n_images"), F.count_if(F.col("ocr_text") != "").alias("n_texts"))
    document = F.concat(F.regexp_replace(F.array_join(F.flatten(F.transform("ps", lambda p: p.ls)), "\n"), r"(?U)\s+$", ""), F.lit("\n"))
    name = F.element_at(F.split(F.col("ps")[0].source_path, r"[/\\]"), -1)
    stem = F.regexp_replace(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""), r"[^A-Za-z0-9._\-㐀-鿿]+", "-")
    one = F.col("n_images") == 1
    digest = F.sha2(F.array_join(F.transform("ps", lambda p: p.source_sha256), "").cast("binary"), 256)
    closing = F.struct(F.lit("standalone-image-source-review-required").alias("code"), F.lit(None).cast("int").alias("page"))
    reviews = F.array_compact(F.array(F.lit("image-source-visual-review"), F.when(F.col("n_texts") > 0, "ocr-text-verification"), F.lit(REVIEWS.get(material))))
    return sums.select(
        "bundle", document.alias("document"), F.when(one, name).otherwise(F.concat(stem, F.lit("-image-set"))).alias("source_filename"), F.when(one, F.col("ps")[0].source_sha256).otherwise(digest).alias("source_sha256"),
        "n_images", "n_texts", F.lit("warn").alias("status"), F.concat(F.array_compact(F.transform("ps", lambda p: p.issue)), F.array(closing)).alias("issues"), reviews.alias("review_required"))


def sections(placed: DataFrame) -> DataFrame:
    """bundle, section_id, title, level, start_line, end_line, pages, assets, quality: the outline."""
    return placed.select("bundle", F.col("id").alias("section_id"), F.concat(F.lit("Image page "), F.col("page").cast("string")).alias("title"), F.lit(1).alias("level"), "start_line", "end_line", F.array("page").alias("pages"), F.array("id").alias("assets"), F.lit("warn").alias("quality"))
